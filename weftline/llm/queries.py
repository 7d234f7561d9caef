"""The operators' queries by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import op1_chunk_store, op2_html_blocks, op3_mcd_rules, op4_line_windows, op5_crf_quality, op6_grace_dedup, op7_suffix_tree_lm, op8_linear_grouping, op9_tree_bpe, op10_simhash_mih, op11_zip_archives, op12_token_alignment, op13_suffix_resample


def queries() -> dict:
    return {
        "op1_chunk_store": op1_chunk_store.query,
        "op2_html_blocks": op2_html_blocks.query,
        "op3_mcd_rules": op3_mcd_rules.query,
        "op4_line_windows": op4_line_windows.query,
        "op5_crf_quality": op5_crf_quality.query,
        "op6_grace_dedup": op6_grace_dedup.query,
        "op7_suffix_tree_lm": op7_suffix_tree_lm.query,
        "op8_linear_grouping": op8_linear_grouping.query,
        "op9_tree_bpe": op9_tree_bpe.query,
        "op10_simhash_mih": op10_simhash_mih.query,
        "op11_zip_archives": op11_zip_archives.query,
        "op12_token_alignment": op12_token_alignment.query,
        "op13_suffix_resample": op13_suffix_resample.query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_line_windows": op4_line_windows.ORACLE_SQL, "op6_grace_dedup": op6_grace_dedup.ORACLE_SQL, "op11_zip_archives": op11_zip_archives.ORACLE_SQL, "op13_suffix_resample": op13_suffix_resample.ORACLE_SQL}
