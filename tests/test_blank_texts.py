"""Queries against their SQL on documents whose texts are empty, blank, null, or have white space at their ends."""

import duckdb
import pytest
from test_queries import QUERIES, SQL, rows


@pytest.fixture(scope="module")
def odd(data, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    text = "CASE doc_id % 9 WHEN 4 THEN '' WHEN 3 THEN ' ' || chr(10) WHEN 2 THEN chr(160) || text || chr(28) || ' ' WHEN 1 THEN NULL ELSE text END"
    duckdb.sql(f"COPY (SELECT * REPLACE ({text} AS text) FROM '{data}/documents.parquet') TO '{folder}/documents.parquet' (FORMAT parquet)")
    return folder


@pytest.mark.parametrize("name", ["flexible_parquet_rows", "jsonl_numbered", "stream_mixture"])
def test_all_documents_and_whole_texts(spark, odd, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{odd}/documents.parquet'")
    assert rows(QUERIES[name](spark, odd).toPandas()) == rows(con.sql(SQL[name]).df())


def test_lines_of_documents_that_tie_alternate(spark, data, tmp_path):
    """Documents with one id in a language have consecutive places, whichever comes first."""
    duckdb.sql(f"COPY (SELECT * REPLACE (doc_id // 3 AS doc_id) FROM '{data}/documents.parquet') TO '{tmp_path}/documents.parquet' (FORMAT parquet)")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    assert rows(QUERIES["jsonl_numbered"](spark, str(tmp_path)).toPandas()) == rows(con.sql(SQL["jsonl_numbered"]).df())
