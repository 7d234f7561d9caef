"""The catalogue of queries for the engine's own operators, each with its SQL.

Test documents are short, so thresholds are parameters: tiers here use the
bounds of the first preset by 16, and one query uses the preset itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import arrays as A
from .functions import text as T
from .functions import tokenize as tok
from .operators import evaluation, languages, lengths, listing, mixture, packing, retrieval, sampling, tiers, vectors
from .operators.ordered import hash_key
from .session import table
from .streaming import tiers as streaming

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql.replace("{DOCS}", _DOCS).replace("{TIER}", _TIER).replace("{SIZES}", _SIZES).replace("{PAIRS}", _PAIRS).replace("{SHARDS}", _SHARDS).replace("{TRIALS}", _TRIALS).replace("{SPEC}", _SPEC)
        return f

    return add


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# ---- inputs that several queries share ------------------------------------

_DOCS = "(SELECT doc_id, text, lang, source, greatest(1, length(text) // 4)::BIGINT AS tc FROM documents)"
_TIER = "CASE WHEN tc >= 1024 THEN '1k_plus' WHEN tc >= 256 THEN '256_1k' ELSE 'under256' END"
_SIZES = "(SELECT lang, sum(octet_length(encode(text)))::BIGINT AS bin_bytes FROM documents GROUP BY lang)"
_PAIRS = f"(SELECT lang, {_TIER} AS tier, sum(octet_length(encode(text)))::BIGINT AS bin_bytes FROM {_DOCS.replace('lang, source', 'lang, source')} GROUP BY ALL)"
_SPEC = "(VALUES ('1k_plus', 0.5::DOUBLE), ('256_1k', 0.3::DOUBLE), ('under256', 0.2::DOUBLE)) AS s(tier, w)"
_SHARDS = "(SELECT lang, source AS path, row_number() OVER (PARTITION BY lang ORDER BY source) - 1 AS shard, sum(n_chars)::BIGINT AS size FROM documents GROUP BY lang, source)"
_TRIALS = """(SELECT doc_id, lang, CASE doc_id % 3 WHEN 0 THEN 'main' WHEN 1 THEN 'no_context' ELSE 'shuffled' END AS condition,
  (2048 * (1 + doc_id % 4))::BIGINT AS target_tokens, (doc_id % 5) / 4.0::DOUBLE AS depth, (doc_id // 60)::BIGINT AS trial,
  [(length(text) % 7)::DOUBLE, (length(text) % 5)::DOUBLE, (length(text) % 3)::DOUBLE, 2.0::DOUBLE] AS scores, (doc_id % 4)::INT AS true_idx FROM documents)"""
SPEC = tiers.normalize(tiers.SMALL)


def docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").withColumn("tc", T.approx_tokens("text"))


def tiered(spark, d) -> DataFrame:
    return docs(spark, d).withColumn("tier", tiers.assign("tc", SPEC))


def sizes(spark, d) -> DataFrame:
    return table(spark, d, "documents").groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bin_bytes"))


def pairs(spark, d) -> DataFrame:
    return tiered(spark, d).groupBy("lang", "tier").agg(F.sum(F.octet_length("text")).alias("bin_bytes"))


def shards(spark, d) -> DataFrame:
    from pyspark.sql.window import Window

    rows = table(spark, d, "documents").groupBy("lang", F.col("source").alias("path")).agg(F.sum("n_chars").alias("size"))
    return rows.withColumn("shard", F.row_number().over(Window.partitionBy("lang").orderBy("path")) - 1)


def trials(spark, d) -> DataFrame:
    n, i = F.length("text"), F.col("doc_id")
    return table(spark, d, "documents").select(
        "doc_id", "lang", F.when(i % 3 == 0, "main").when(i % 3 == 1, "no_context").otherwise("shuffled").alias("condition"), (2048 * (1 + i % 4)).alias("target_tokens"), ((i % 5) / 4.0).alias("depth"),
        F.floor(i / 60).alias("trial"), F.array((n % 7).cast("double"), (n % 5).cast("double"), (n % 3).cast("double"), F.lit(2.0)).alias("scores"), (i % 4).cast("int").alias("true_idx"),
    )


def r9(c) -> F.Column:
    return F.round(c, 9)


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Documents, tokens and characters by language and tier, and each one's share of its tier's weight."""
    sums = tiered(spark, d).groupBy("lang", "tier").agg(F.count("*").alias("docs"), F.sum("tc").alias("tokens"), F.sum("n_chars").alias("bin_bytes"))
    return mixture.tier_proportional(sums, tiers.frame(spark, SPEC)).select("lang", "tier", "docs", "tokens", F.col("bin_bytes").alias("chars"), r9("natural_p").alias("natural_p"), r9("weight").alias("weight"))


# ---- canonical documents, lengths ------------------------------------------


@query("""SELECT lang, tier, docs, tokens, chars, round(chars / sum(chars) OVER (), 9) AS natural_p, round(w * chars / sum(chars) OVER (PARTITION BY tier), 9) AS weight
FROM (SELECT lang, {TIER} AS tier, count(*) AS docs, sum(tc)::BIGINT AS tokens, sum(length(text))::BIGINT AS chars FROM {DOCS} GROUP BY ALL) JOIN {SPEC} USING (tier)""")
def tier_mixture(spark, d):
    return flagship(spark, d)


@query("""SELECT doc_id, lang, t AS text, greatest(1, length(t) // 4)::BIGINT AS token_count
FROM (SELECT doc_id, lang, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS t FROM documents) WHERE length(t) >= 50""")
def canonicalize_docs(spark, d):
    return lengths.canonicalize(table(spark, d, "documents"), min_chars=50).select("doc_id", "lang", "text", "token_count")


@query("""WITH s AS (SELECT lang, count(*) AS docs, sum(tc)::BIGINT AS tokens, round(sum(octet_length(encode(text))) / 1e6, 6) AS mb, grouping(lang)::TINYINT AS is_total FROM {DOCS} GROUP BY ROLLUP (lang))
SELECT *, round(tokens / (SELECT tokens FROM s WHERE is_total = 1), 9) AS share FROM s""")
def conversion_summary(spark, d):
    return lengths.conversion_summary(docs(spark, d).withColumn("n_bytes", F.octet_length("text")), tokens="tc")


@query("SELECT doc_id, lang, tc FROM {DOCS} WHERE tc BETWEEN 512 AND 2048")
def filter_long(spark, d):
    return lengths.filter_long(docs(spark, d), "tc", 512, 2048).select("doc_id", "lang", "tc")


@query("""SELECT lang, count(*) AS in_docs, count(*) FILTER (WHERE tc >= 512) AS out_docs, sum(tc)::BIGINT AS in_tokens, coalesce(sum(tc) FILTER (WHERE tc >= 512), 0)::BIGINT AS out_tokens,
round(100 * count(*) FILTER (WHERE tc >= 512) / count(*), 6) AS kept_pct FROM {DOCS} GROUP BY lang""")
def filter_summary(spark, d):
    return lengths.filter_summary(docs(spark, d), "lang", "tc", 512)


@query("SELECT doc_id, tc, {TIER} AS tier, CASE WHEN tc >= 16384 THEN '16k_plus' WHEN tc >= 4096 THEN '4_16k' ELSE 'under4k' END AS preset_tier FROM {DOCS}")
def tier_assign(spark, d):
    return tiered(spark, d).select("doc_id", "tc", "tier", tiers.assign("tc", tiers.normalize(tiers.PRESETS["lc16k"])).alias("preset_tier"))


@query("""SELECT lang, count(*) AS docs, count_if(tc >= 1024)::BIGINT AS "1k_plus", count_if(tc >= 256 AND tc < 1024)::BIGINT AS "256_1k", count_if(tc < 256)::BIGINT AS under256,
round(100 * count_if(tc >= 1024) / count(*), 6) AS "1k_plus_pct", round(100 * count_if(tc >= 256 AND tc < 1024) / count(*), 6) AS "256_1k_pct", round(100 * count_if(tc < 256) / count(*), 6) AS under256_pct FROM {DOCS} GROUP BY lang""")
def tier_counts_by_lang(spark, d):
    return tiers.counts_by_lang(tiered(spark, d), "lang", "tier", list(SPEC))


@query("""SELECT preset, tier, min_tokens::BIGINT AS min_tokens, max_tokens::BIGINT AS max_tokens, round(w / sum(w) OVER (PARTITION BY preset), 9) AS weight, (SELECT count(*) FROM {DOCS} WHERE tc * 64 >= min_tokens AND (max_tokens IS NULL OR tc * 64 < max_tokens)) AS docs
FROM (VALUES
('lc16k','16k_plus',16384,NULL,0.5::DOUBLE),('lc16k','4_16k',4096,16384,0.3),('lc16k','under4k',0,4096,0.2),
('lc128k','128k_plus',131072,NULL,0.25),('lc128k','64_128k',65536,131072,0.25),('lc128k','32_64k',32768,65536,0.2),('lc128k','16_32k',16384,32768,0.15),('lc128k','4_16k',4096,16384,0.1),('lc128k','under4k',0,4096,0.05),
('lc256k','256k_plus',262144,NULL,0.2),('lc256k','128_256k',131072,262144,0.25),('lc256k','64_128k',65536,131072,0.2),('lc256k','32_64k',32768,65536,0.15),('lc256k','16_32k',16384,32768,0.1),('lc256k','4_16k',4096,16384,0.07),('lc256k','under4k',0,4096,0.03)) t(preset, tier, min_tokens, max_tokens, w)""")
def tier_spec_normalized(spark, d):
    """Each preset's tiers, and how many documents of 64 times their length fall into them."""
    specs = {p: tiers.normalize(spec) for p, spec in tiers.PRESETS.items()}
    rows = spark.createDataFrame([(p, n, a, b, round(w, 9)) for p, spec in specs.items() for n, (a, b, w) in spec.items()], "preset string, tier string, min_tokens long, max_tokens long, weight double")
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("preset"), tiers.assign("n", spec).alias("tier")) for p, spec in specs.items()]))
    counts = docs(spark, d).select((F.col("tc") * 64).alias("n")).select(each.alias("x")).groupBy("x.preset", "x.tier").agg(F.count("*").alias("docs"))
    return rows.join(counts, ["preset", "tier"], "left").withColumn("docs", F.coalesce("docs", F.lit(0)))


@query("""SELECT lang, count(*) AS docs, sum(tc)::BIGINT AS total_tokens, min(tc) AS min_tokens, list_sort(list(tc))[least(count(*) * 50 // 100, count(*) - 1) + 1] AS p50,
list_sort(list(tc))[least(count(*) * 90 // 100, count(*) - 1) + 1] AS p90, max(tc) AS max_tokens FROM {DOCS} GROUP BY lang""")
def length_stats_nearest_rank(spark, d):
    return lengths.nearest_rank(docs(spark, d), "lang", "tc")


@query("""SELECT lang, {TIER} AS tier, count(*) AS docs, sum(tc)::BIGINT AS total_tokens, min(tc) AS min_tokens, trunc(quantile_cont(tc, 0.5))::BIGINT AS p50, trunc(quantile_cont(tc, 0.9))::BIGINT AS p90, max(tc) AS max_tokens FROM {DOCS} GROUP BY ALL""")
def length_stats_interpolated(spark, d):
    return lengths.interpolated(tiered(spark, d), ["lang", "tier"], "tc")


@query("""SELECT lang, t::BIGINT AS context, count(*) FILTER (WHERE tc >= t) AS docs, round(100 * count(*) FILTER (WHERE tc >= t) / count(*), 6) AS docs_pct, coalesce(sum(tc) FILTER (WHERE tc >= t), 0)::BIGINT AS tokens,
(coalesce(sum(tc) FILTER (WHERE tc >= t), 0) // t)::BIGINT AS sequences FROM {DOCS}, (VALUES (256), (512), (1024), (2048), (4096), (8192)) v(t) GROUP BY lang, t""")
def context_coverage(spark, d):
    return lengths.coverage(docs(spark, d), "lang", "tc", (256, 512, 1024, 2048, 4096, 8192))


@query("""SELECT *, round(100 * docs / sum(docs) OVER (), 6) AS docs_pct FROM (SELECT CASE WHEN tc < 128 THEN '0-128' WHEN tc < 512 THEN '128-512' WHEN tc < 4096 THEN '512-4096' ELSE '>=4096' END AS bucket, count(*) AS docs, sum(tc)::BIGINT AS tokens FROM {DOCS} GROUP BY 1)""")
def length_histogram(spark, d):
    return lengths.histogram(docs(spark, d), "tc", [0, 128, 512, 4096])


@query("""SELECT source, round(coalesce(sum(tc) FILTER (WHERE tc >= 1024), 0) / sum(tc), 9) AS share_1024, round(coalesce(sum(tc) FILTER (WHERE tc >= 2048), 0) / sum(tc), 9) AS share_2048 FROM {DOCS} GROUP BY source""")
def long_token_share(spark, d):
    return lengths.long_share(docs(spark, d), "source", "tc", (1024, 2048)).select("source", r9("share_1024").alias("share_1024"), r9("share_2048").alias("share_2048"))


@query("""WITH s AS (SELECT lang, coalesce(sum(tc) FILTER (WHERE tc >= 1024), 0) / sum(tc) AS f FROM {DOCS} GROUP BY lang), w AS (SELECT * FROM (VALUES ('de', 0.3::DOUBLE), ('en', 0.4::DOUBLE), ('es', 0.1::DOUBLE), ('none', 0.2::DOUBLE)) v(lang, weight))
SELECT round(sum(weight * coalesce(f, 0)) / sum(weight), 9) AS fraction_1024 FROM w LEFT JOIN s USING (lang)""")
def effective_mix_fraction(spark, d):
    weights = spark.createDataFrame([("de", 0.3), ("en", 0.4), ("es", 0.1), ("none", 0.2)], "lang string, weight double")
    return lengths.effective_fraction(lengths.long_share(docs(spark, d), "lang", "tc", (1024,)), weights, "lang", (1024,))


@query("""SELECT policy, sum(n)::BIGINT AS tokens, min(n)::BIGINT AS least FROM (SELECT unnest(['filter', 'source', 'bundle', 'sum']) AS policy, unnest([
CASE WHEN c > 0 THEN c ELSE greatest(1, length(text) // 4) END, CASE WHEN coalesce(nullif(c, 0), o) > 0 THEN coalesce(nullif(c, 0), o) ELSE greatest(1, length(text) // 4) END,
coalesce(c, o, greatest(1, floor(length(text) / 3.8::DOUBLE)::BIGINT)), coalesce(c, 0)]) AS n
FROM (SELECT text, CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN -3 ELSE doc_id END AS c, CASE doc_id % 4 WHEN 0 THEN NULL ELSE doc_id % 9 END AS o FROM documents)) GROUP BY policy""")
def token_policies(spark, d):
    i = F.col("doc_id")
    rows = table(spark, d, "documents").select("text", F.when(i % 5 == 0, None).when(i % 5 == 1, 0).when(i % 5 == 2, -3).otherwise(i).alias("c"), F.when(i % 4 == 0, None).otherwise(i % 9).alias("o"))
    each = F.array(*[F.struct(F.lit(p).alias("policy"), T.resolve_tokens("text", "c", "o", p).alias("n")) for p in ("filter", "source", "bundle", "sum")])
    return rows.select(F.inline(each)).groupBy("policy").agg(F.sum("n").alias("tokens"), F.min("n").alias("least"))


# ---- mixtures ----------------------------------------------------------------


@query("""WITH g AS (SELECT a, f, s.* FROM {SIZES} s, (VALUES (0.3::DOUBLE, 0.005::DOUBLE), (0.0, 0.0), (1.0, 0.2)) v(a, f)), p AS (SELECT *, bin_bytes / sum(bin_bytes) OVER (PARTITION BY a, f) AS q FROM g),
r AS (SELECT *, pow(q, a) / sum(pow(q, a)) OVER (PARTITION BY a, f) AS w FROM p), x AS (SELECT *, CASE WHEN f > 0 THEN greatest(w, f) ELSE w END AS z FROM r)
SELECT a AS alpha, lang, bin_bytes, round(q, 9) AS natural_p, round(CASE WHEN f > 0 THEN z / sum(z) OVER (PARTITION BY a, f) ELSE w END, 9) AS weight FROM x""")
def mix_tempered(spark, d):
    out = None
    for alpha, floor in ((0.3, 0.005), (0.0, 0.0), (1.0, 0.2)):
        part = mixture.tempered(sizes(spark, d), alpha=alpha, floor=floor).select(F.lit(alpha).alias("alpha"), "lang", "bin_bytes", r9("natural_p").alias("natural_p"), r9("weight").alias("weight"))
        out = part if out is None else out.unionByName(part)
    return out


@query("SELECT lang, tier, bin_bytes, round(bin_bytes / sum(bin_bytes) OVER (), 9) AS natural_p, round(w * bin_bytes / sum(bin_bytes) OVER (PARTITION BY tier), 9) AS weight FROM {PAIRS} JOIN {SPEC} USING (tier)")
def mix_tier_proportional(spark, d):
    return mixture.tier_proportional(pairs(spark, d), tiers.frame(spark, SPEC)).select("lang", "tier", "bin_bytes", r9("natural_p").alias("natural_p"), r9("weight").alias("weight"))


@query("SELECT lang, tier, round(w / count(*) OVER (PARTITION BY tier), 9) AS weight FROM {PAIRS} JOIN {SPEC} USING (tier)")
def mix_uniform_present(spark, d):
    return mixture.uniform_present(pairs(spark, d), tiers.frame(spark, SPEC)).select("lang", "tier", r9("weight").alias("weight"))


@query("SELECT lang, tier, round(x / sum(x) OVER (), 9) AS weight FROM (SELECT lang, tier, w / (SELECT count(DISTINCT lang) FROM documents) AS x FROM {PAIRS} JOIN {SPEC} USING (tier) WHERE NOT (lang = 'es' AND tier = '1k_plus'))")
def mix_uniform_all(spark, d):
    entries = pairs(spark, d).where(~((F.col("lang") == "es") & (F.col("tier") == "1k_plus")))
    return mixture.uniform_all(entries, tiers.frame(spark, SPEC)).select("lang", "tier", r9("weight").alias("weight"))


@query("""WITH e AS (SELECT lang || '_' || tier AS name, 0.8 * w / (SELECT count(DISTINCT lang) FROM documents) AS x FROM {PAIRS} JOIN {SPEC} USING (tier)
UNION ALL SELECT source, 0.1 * sum(length(text)) / (SELECT sum(length(text)) FROM documents WHERE source IN ('src1', 'src2')) FROM documents WHERE source IN ('src1', 'src2') GROUP BY source UNION ALL SELECT 'code', 0.1)
SELECT name, round(x / sum(x) OVER (), 9) AS weight FROM e""")
def mix_families(spark, d):
    langs = mixture.uniform_all(pairs(spark, d), tiers.frame(spark, SPEC), 0.8, renormalize=False).select(F.concat_ws("_", "lang", "tier").alias("name"), "weight")
    sub = table(spark, d, "documents").where(F.col("source").isin("src1", "src2")).groupBy(F.col("source").alias("name")).agg(F.sum(F.length("text")).alias("n"))
    code = spark.createDataFrame([("code", 0.1)], "name string, weight double")
    return mixture.families([langs, mixture.proportional(sub, "n", 0.1), code]).select("name", r9("weight").alias("weight"))


@query("""WITH n AS (SELECT lang AS name, bin_bytes / sum(bin_bytes) OVER () AS w FROM {SIZES}), l AS (SELECT lang AS name, sum(tc) FILTER (WHERE tc >= 512) AS t FROM {DOCS} GROUP BY lang)
SELECT name, round(0.65 * coalesce(t, 0) / (SELECT sum(t) FROM l) + 0.35 * w, 9) AS weight FROM n JOIN l USING (name)""")
def mix_blend(spark, d):
    long = docs(spark, d).groupBy(F.col("lang").alias("name")).agg(F.coalesce(F.sum(F.when(F.col("tc") >= 512, F.col("tc"))), F.lit(0)).alias("t"))
    natural = mixture.proportional(sizes(spark, d), "bin_bytes").select(F.col("lang").alias("name"), "weight")
    return mixture.blend(mixture.proportional(long, "t"), natural, 0.65).select("name", r9("weight").alias("weight"))


@query("WITH p AS (SELECT lang, greatest(bin_bytes / sum(bin_bytes) OVER () * CASE WHEN lang = 'en' THEN 20 ELSE 1 END, 0.02) AS x FROM {SIZES}) SELECT lang, round(x / sum(x) OVER (), 9) AS weight FROM p")
def mix_boosted(spark, d):
    return mixture.boosted(mixture.proportional(sizes(spark, d), "bin_bytes"), "lang", "en", 20.0, 0.02).select("lang", r9("weight").alias("weight"))


@query("SELECT source, tokens, round(tokens / sum(tokens) OVER (), 9) AS weight FROM (SELECT source, sum(tc)::BIGINT AS tokens FROM {DOCS} GROUP BY source)")
def mix_token_proportional(spark, d):
    return mixture.proportional(docs(spark, d).groupBy("source").agg(F.sum("tc").alias("tokens")), "tokens").select("source", "tokens", r9("weight").alias("weight"))


@query("SELECT lang, round(CASE lang WHEN 'en' THEN 3 WHEN 'de' THEN 1 ELSE 0 END / 4, 9) AS weight FROM {SIZES}")
def mix_explicit(spark, d):
    return mixture.explicit(sizes(spark, d), "lang", {"en": 3.0, "de": 1.0, "xx": 5.0}).select("lang", r9("weight").alias("weight"))


@query("SELECT string_agg(printf('%.6f', p) || ' bin/' || lang, ' ' ORDER BY p DESC, lang) AS data_path FROM (SELECT lang, bin_bytes / sum(bin_bytes) OVER () AS p FROM {SIZES})")
def mix_data_path(spark, d):
    return mixture.data_path(mixture.proportional(sizes(spark, d), "bin_bytes").withColumn("prefix", F.concat(F.lit("bin/"), "lang")))


@query("SELECT (row_number() OVER (ORDER BY p DESC, lang) - 1)::INT AS pos, round(p, 6) AS weight, 'bin/' || lang AS prefix FROM (SELECT lang, bin_bytes / sum(bin_bytes) OVER () AS p FROM {SIZES})")
def mix_data_path_decode(spark, d):
    script = mix_data_path(spark, d).select(F.concat(F.lit('#!/bin/sh\nDATA="'), "data_path", F.lit('"\n')).alias("data_path"))
    return mixture.parse_data_path(script)


@query("SELECT lang, 'moved/' || lang || '_text_document' AS prefix, bin_bytes, round(bin_bytes / sum(bin_bytes) OVER (), 6) AS weight FROM {SIZES}")
def mix_manifest_rewrite(spark, d):
    weights = mixture.proportional(sizes(spark, d), "bin_bytes").withColumns({"prefix": F.concat(F.lit("bin/"), "lang"), "natural_p": F.col("weight")})
    moved = mixture.rewrite_paths(mixture.manifest(weights), "moved")
    parsed = moved.select(F.explode(F.from_json("manifest", "languages map<string, struct<prefix string, bin_bytes bigint, weight double>>")["languages"]).alias("lang", "m"))
    return parsed.select("lang", "m.prefix", "m.bin_bytes", F.round("m.weight", 6).alias("weight"))


# ---- listings, samples and limits ----------------------------------------------


@query("SELECT lang, path, size FROM {SHARDS} WHERE shard < 3")
def shard_limit(spark, d):
    return listing.select_shards(shards(spark, d), 3).select("lang", "path", "size")


@query("SELECT lang, shard::INT AS shard, path FROM {SHARDS} WHERE NOT ((lang = 'fr' AND shard = 2) OR (lang = 'en' AND shard BETWEEN 1 AND 4))")
def skip_shards(spark, d):
    return listing.without_skipped(shards(spark, d), "fr:2,en:s1-s4").select("lang", "shard", "path")


@query("""SELECT lang, count(*) AS files, sum(size)::BIGINT AS bytes, min_by(size, (path, lang)) AS first_bytes, round(sum(size) / 1e9, 9) AS gb, round(sum(size) * 1.1::DOUBLE / 1e9, 9) AS need_gb,
CASE WHEN sum(size) >= 1e9 THEN printf('%.1f GB', sum(size) / 1e9) WHEN sum(size) >= 1e6 THEN printf('%.1f MB', sum(size) / 1e6) ELSE printf('%.1f KB', sum(size) / 1e3) END AS readable FROM {SHARDS} GROUP BY ROLLUP (lang)""")
def shard_estimate(spark, d):
    return listing.estimate(shards(spark, d))


@query("SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM documents) WHERE rn <= 20")
def docs_cap_per_lang(spark, d):
    return sampling.first_per_group(table(spark, d, "documents").select("doc_id", "lang"), "lang", "doc_id", 20)


@query("SELECT doc_id, lang, source FROM documents ORDER BY lang, source, doc_id LIMIT 150")
def global_doc_cap(spark, d):
    return sampling.first(table(spark, d, "documents").select("doc_id", "lang", "source"), ["lang", "source", "doc_id"], 150)


@query("""WITH e AS (SELECT doc_id, tc, coalesce(sum(tc) OVER (ORDER BY sha256('7|' || doc_id::VARCHAR) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS tokens_before FROM {DOCS} WHERE tc BETWEEN 64 AND 4096)
SELECT doc_id, tc, tokens_before FROM e WHERE tokens_before < 50000""")
def token_budget_sample(spark, d):
    return sampling.token_budget(docs(spark, d).select("doc_id", "tc"), "doc_id", "tc", 50_000, 7, 64, 4096).select("doc_id", "tc", "tokens_before")


@query("SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256('3|' || doc_id::VARCHAR)) AS rn FROM {DOCS} WHERE tc >= 256) WHERE rn <= 10")
def proxy_sample(spark, d):
    return sampling.per_group(docs(spark, d).where("tc >= 256").select("doc_id", "lang"), "lang", "doc_id", 10, 3)


@query("SELECT doc_id, chars_before FROM (SELECT doc_id, coalesce(sum(length(text)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS chars_before FROM documents) WHERE chars_before <= 200000")
def char_budget_prefix(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.length("text").cast("long").alias("n"))
    return sampling.char_prefix(rows, "doc_id", "n", 200_000).select("doc_id", "chars_before")


@query("SELECT source, tokens FROM (SELECT source, sum(tc)::BIGINT AS tokens FROM {DOCS} GROUP BY source) ORDER BY tokens DESC, source LIMIT 12")
def top_sources(spark, d):
    return sampling.top(docs(spark, d).groupBy("source").agg(F.sum("tc").alias("tokens")), "tokens", 12, "source")


# ---- chunks and bundles -----------------------------------------------------------

_CHUNKS = "(SELECT *, ((row_number() OVER (PARTITION BY lang, source, tier ORDER BY doc_id) - 1) // 10)::INT AS chunk FROM (SELECT *, {TIER} AS tier FROM {DOCS}))"


def chunked(spark, d) -> DataFrame:
    rows = tiered(spark, d).withColumn("shard", F.regexp_extract("source", r"(\d+)$", 1).cast("int"))
    return packing.chunks(rows, ["lang", "shard", "tier"], "doc_id", 10)


@query(f"SELECT doc_id, lang, tier, chunk FROM {_CHUNKS}")
def chunk_assign(spark, d):
    return chunked(spark, d).select("doc_id", "lang", "tier", "chunk")


@query(f"""SELECT printf('%s_s%04d_c%05d_%s', lang, regexp_extract(source, '([0-9]+)$', 1)::INT, chunk, tier) AS name, count(*) AS docs, sum(tc)::BIGINT AS source_token_count, sum(octet_length(encode(text)))::BIGINT AS bin_bytes FROM {_CHUNKS} GROUP BY lang, source, tier, chunk""")
def chunk_manifest(spark, d):
    return packing.chunk_manifest(chunked(spark, d), tokens="tc").select("name", "docs", "source_token_count", "bin_bytes")


@query(f"""WITH c AS (SELECT lang, source, tier, chunk FROM {_CHUNKS} GROUP BY ALL) SELECT printf('%s_s%04d_c%05d_%s', lang, regexp_extract(source, '([0-9]+)$', 1)::INT, chunk, tier) AS name FROM c WHERE chunk > 0""")
def resume_chunks(spark, d):
    made = packing.chunk_manifest(chunked(spark, d), tokens="tc")
    files = made.where(F.col("name").contains("_c00000_")).select(F.concat(F.lit("/out/manifests/chunks/"), "name", F.lit(".json")).alias("path"))
    return packing.pending(made, listing.completed_names(files)).select("name")


_FOLD = """WITH RECURSIVE o AS (SELECT lang, doc_id, tc, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM {DOCS}),
f AS (SELECT lang, doc_id, tc, rn, tc AS total, 0::BIGINT AS bundle FROM o WHERE rn = 1 UNION ALL
SELECT o.lang, o.doc_id, o.tc, o.rn, CASE WHEN f.total >= 8192 THEN o.tc ELSE f.total + o.tc END, CASE WHEN f.total >= 8192 THEN f.bundle + 1 ELSE f.bundle END FROM f JOIN o ON o.lang = f.lang AND o.rn = f.rn + 1)"""


@query(_FOLD + " SELECT lang, doc_id, tc, bundle FROM (SELECT *, max(total) OVER (PARTITION BY lang, bundle) AS filled FROM f) WHERE filled >= 8192")
def bundle_greedy(spark, d):
    return packing.bundles(docs(spark, d), "lang", "doc_id", "tc", 8192).select("lang", "doc_id", "tc", "bundle")


@query(_FOLD + """ SELECT lang, printf('pack_train_%s_%d_%06d', lang, 8192, bundle) AS pack_id, count(*) AS source_doc_count, sum(tc)::BIGINT AS estimated_tokens, round(sum(tc) / 8192, 9) AS fill_ratio, sum(tc) < 8192 AS partial FROM f GROUP BY lang, bundle""")
def bundle_rows(spark, d):
    rows = docs(spark, d)
    assigned = packing.bundles(rows, "lang", "doc_id", "tc", 8192, partial=True)
    return packing.bundle_rows(assigned, rows, "lang", "doc_id", "tc", 8192).select("lang", "pack_id", "source_doc_count", "estimated_tokens", r9("fill_ratio").alias("fill_ratio"), "partial")


@query(_FOLD + r""" , p AS (SELECT f.lang, bundle, f.doc_id, chr(10) || chr(10) || '===== DOCUMENT BOUNDARY =====' || chr(10) || 'language: ' || f.lang || chr(10) || 'source: ' || source || chr(10) || 'doc_id: ' ||
substr(sha1(source || chr(10) || f.doc_id || chr(10) || substr(text, 1, 256)), 1, 16) || chr(10) || 'source_tokens: ' || f.tc || chr(10) || '===== CONTENT =====' || chr(10) || regexp_replace(text, '^\s+|\s+$', '', 'g') AS part FROM f JOIN documents USING (doc_id))
SELECT lang, bundle, regexp_replace(string_agg(part, chr(10) ORDER BY doc_id), '^\s+|\s+$', '', 'g') || chr(10) AS text FROM p GROUP BY lang, bundle""")
def bundle_text(spark, d):
    rows = docs(spark, d)
    made = packing.bundle_rows(packing.bundles(rows, "lang", "doc_id", "tc", 8192, partial=True), rows, "lang", "doc_id", "tc", 8192)
    return made.select("lang", F.regexp_extract("pack_id", r"(\d{6})$", 1).cast("long").alias("bundle"), "text")


@query("""WITH RECURSIVE o AS (SELECT lang, doc_id, tc, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM {DOCS}),
f AS (SELECT lang, 0::BIGINT AS rn, NULL::BIGINT AS doc_id, 0::BIGINT AS tc, [0, 0, 0]::BIGINT[] AS made, [0, 0, 0]::BIGINT[] AS held, 0::BIGINT AS turn, 0 AS k, 0::BIGINT AS bundle FROM (SELECT DISTINCT lang FROM o)
UNION ALL SELECT lang, rn, doc_id, tc, list_transform([1, 2, 3], lambda i: made[i] + CASE WHEN i = k AND held[i] + tc >= [2048, 4096, 8192][i] THEN 1 ELSE 0 END),
list_transform([1, 2, 3], lambda i: CASE WHEN i <> k THEN held[i] WHEN held[i] + tc >= [2048, 4096, 8192][i] THEN 0 ELSE held[i] + tc END), turn + 1, k, made[k]
FROM (SELECT f.lang, o.rn, o.doc_id, o.tc, f.made, f.held, f.turn, list_filter([1, 2, 3], lambda i: f.made[i] < 3)[(f.turn % len(list_filter([1, 2, 3], lambda i: f.made[i] < 3)))::BIGINT + 1] AS k
FROM f JOIN o ON o.lang = f.lang AND o.rn = f.rn + 1 WHERE len(list_filter([1, 2, 3], lambda i: f.made[i] < 3)) > 0))
SELECT f.lang, doc_id, tc, [2048, 4096, 8192][k]::BIGINT AS target_tokens, bundle, bundle < m.made[k] AS "full" FROM f JOIN (SELECT lang, max_by(made, rn) AS made FROM f GROUP BY lang) m ON m.lang = f.lang WHERE f.rn > 0""")
def bundle_multi_target(spark, d):
    return packing.bundles_many(docs(spark, d), "lang", "doc_id", "tc", [2048, 4096, 8192], 3, partial=True)


@query("""WITH RECURSIVE o AS (SELECT lang || '/' || path AS path, size, row_number() OVER (ORDER BY lang || '/' || path) AS rn FROM {SHARDS}),
f AS (SELECT path, size, rn, 1 AS n, size AS b, 0::BIGINT AS batch FROM o WHERE rn = 1 UNION ALL
SELECT o.path, o.size, o.rn, CASE WHEN f.n >= 7 OR f.b >= 200000 THEN 1 ELSE f.n + 1 END, CASE WHEN f.n >= 7 OR f.b >= 200000 THEN o.size ELSE f.b + o.size END, CASE WHEN f.n >= 7 OR f.b >= 200000 THEN f.batch + 1 ELSE f.batch END FROM f JOIN o ON o.rn = f.rn + 1)
SELECT path, size, batch FROM f""")
def upload_batches(spark, d):
    return packing.batches(shards(spark, d).withColumn("path", F.concat_ws("/", "lang", "path")), "path", "size", 7, 200_000)


# ---- strings, hashes and parsing -----------------------------------------------------


@query("SELECT doc_id, substr(sha1(source || chr(10) || doc_id || chr(10) || substr(text, 1, 256)), 1, 16) AS sid, sha256(text) AS sha256 FROM documents")
def doc_hashes(spark, d):
    return table(spark, d, "documents").select("doc_id", T.doc_id("source", "doc_id", "text").alias("sid"), F.sha2("text", 256).alias("sha256"))


@query("""SELECT doc_id, ('0x' || substr(sha256('42|' || lang || '|' || condition || '|' || target_tokens || '|' || printf('%.8f', depth) || '|' || trial), 1, 16))::UBIGINT::VARCHAR AS seed FROM {TRIALS}""")
def case_seed(spark, d):
    return trials(spark, d).select("doc_id", T.case_seed(42, "lang", "condition", "target_tokens", "depth", "trial").cast("string").alias("seed"))


@query("SELECT lang, max(CASE lang WHEN 'de' THEN 'deu_Latn' WHEN 'en' THEN 'eng_Latn' WHEN 'es' THEN 'spa_Latn' WHEN 'fr' THEN 'fra_Latn' END) AS code, max(CASE lang WHEN 'de' THEN 'german' WHEN 'en' THEN 'english' WHEN 'es' THEN 'spanish' WHEN 'fr' THEN 'french' END) AS sentence_name, count(*) AS docs FROM documents GROUP BY lang")
def lang_lookup(spark, d):
    per = table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("docs"))
    return per.join(F.broadcast(languages.frame(spark)), "lang", "left").select("lang", "code", "sentence_name", "docs")


@query("SELECT lang, sum(n)::BIGINT AS docs, CASE WHEN lang = 'xx' THEN []::VARCHAR[] ELSE ['clean', 'web'] END AS adapters FROM (SELECT lang, 1 AS n FROM documents UNION ALL SELECT unnest(['ga', 'sq', 'lb', 'xx']), 0) GROUP BY lang")
def lang_coverage(spark, d):
    """Of the documents' languages, and of those that the primary source lacks, the adapters that have them."""
    have = languages.frame(spark).select("lang", F.explode("adapters").alias("adapter"))
    asked = spark.createDataFrame([(x,) for x in [*languages.MISSING, "xx"]], "lang string").select("lang", F.lit(0).alias("n"))
    wanted = table(spark, d, "documents").select("lang", F.lit(1).alias("n")).unionByName(asked).groupBy("lang").agg(F.sum("n").alias("docs"))
    return listing.missing_coverage(wanted, have)


@query("SELECT event_id, map_from_entries([{'k': 'type', 'v': event_type}, {'k': 'user', 'v': user_id::VARCHAR}]) AS kv, [event_type, user_id::VARCHAR] AS items FROM events")
def parse_lists(spark, d):
    events = table(spark, d, "events")
    rows = events.select("event_id", F.concat(F.lit("type="), "event_type", F.lit(" , user="), F.col("user_id").cast("string")).alias("s"), F.concat(F.col("event_type"), F.lit(" ,, "), F.col("user_id").cast("string"), F.lit(",")).alias("l"))
    return rows.select("event_id", T.pairs("s").alias("kv"), T.csv("l").alias("items"))


_END = r"^[\s\x{1c}-\x{1f}]+|[\s\x{1c}-\x{1f}]+$"
_ASKED = r"CASE turn % 4 WHEN 0 THEN text WHEN 1 THEN text || chr(10) || 'Answer: ' || text WHEN 2 THEN text || chr(10) || 'Please answer in one word.' || chr(10) || 'Answer: yes <Answer>no</Answer>' ELSE text || ' <Answer>' || text || '</Answer> ' END"


@query(rf"""SELECT conv_id, turn, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(q, '{_END}', '', 'g'), '(?s)<Answer>.*', ''), '{_END}', '', 'g'), '(?s)\nAnswer:.*$', ''), '{_END}', '', 'g'), '(?s)\nPlease answer.*$', ''), '{_END}', '', 'g') || chr(10) || 'The answer is:' AS prefix
FROM (SELECT conv_id, turn, {_ASKED} AS q FROM conversations)""")
def prompt_prefix(spark, d):
    """All turns, without an end, or with an answer's line, a plea or a tag."""
    t, text = F.col("turn") % 4, F.col("text")
    asked = F.when(t == 0, text).when(t == 1, F.concat(text, F.lit("\nAnswer: "), text)).when(t == 2, F.concat(text, F.lit("\nPlease answer in one word.\nAnswer: yes <Answer>no</Answer>"))).otherwise(F.concat(text, F.lit(" <Answer>"), text, F.lit("</Answer> ")))
    return table(spark, d, "conversations").select("conv_id", "turn", T.completion_prefix(asked).alias("prefix"))


@query("SELECT doc_id, octet_length(encode(text)) + 1 AS n_ids, text AS back FROM documents")
def byte_tokens(spark, d):
    ids = table(spark, d, "documents").select("doc_id", tok.ids("text").alias("ids"))
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_ids"), tok.texts("ids").alias("back"))


# ---- retrieval texts -------------------------------------------------------------------


@query("""SELECT doc_id, list_concat(list_concat(w[1:k], ['NEEDLE']), w[k + 1:]) AS context, list_concat(l[2:], l[1:1]) AS rotated FROM (SELECT doc_id, l, floor(n * d)::INT AS k, [l[i % len(l) + 1] FOR i IN range(0, n)] AS w FROM
(SELECT doc_id, l, d, greatest(len(l), 9) AS n FROM (SELECT doc_id, string_split(text, ' ') AS l, (doc_id % 5) / 4.0::DOUBLE AS d FROM documents)))""")
def needle_insert(spark, d):
    """A needle among all words of a text, repeated to nine at least."""
    rows = table(spark, d, "documents").select("doc_id", F.split("text", " ").alias("l"), ((F.col("doc_id") % 5) / 4.0).alias("d"))
    return rows.select("doc_id", retrieval.needle_context("l", "d", F.lit("NEEDLE"), F.greatest(F.size("l"), F.lit(9))).alias("context"), A.rotated("l").alias("rotated"))


@query("""WITH f AS (SELECT doc_id, string_split(text, chr(10)) AS l, (doc_id % 5) / 4.0::DOUBLE AS d, 'The code of ' || source || ' is ' || doc_id || '.' AS needle FROM documents),
c AS (SELECT *, [octet_length(encode(x)) + 1 FOR x IN l] AS c, greatest(4096 - octet_length(encode(needle)) - 1, 0) AS room FROM f),
s AS (SELECT *, list_sum(c) AS total, [list_sum(c[1:i]) FOR i IN range(1, len(c) + 1)] AS sums FROM c),
n AS (SELECT *, (room // total * len(l) + len(list_filter(sums, lambda x: x <= room % total)))::INT AS n FROM s),
w AS (SELECT *, floor(n * d)::INT AS k, [l[i % len(l) + 1] FOR i IN range(0, n)] AS w FROM n)
SELECT doc_id, n AS n_lines, array_to_string(list_concat(list_concat(w[1:k], [needle]), w[k + 1:]), chr(10)) AS context FROM w""")
def needle_budget(spark, d):
    """Whole texts' lines as filler around a fact, as many as go into 4096 byte tokens with it."""
    needle = F.concat(F.lit("The code of "), "source", F.lit(" is "), F.col("doc_id").cast("string"), F.lit("."))
    rows = table(spark, d, "documents").select("doc_id", F.split("text", "\n").alias("l"), ((F.col("doc_id") % 5) / 4.0).alias("d"), needle.alias("needle"))
    return retrieval.budget_context(rows, "l", "d", F.col("needle"), 4096).select("doc_id", "n_lines", F.array_join("context", "\n").alias("context"))


@query("""SELECT doc_id, [x + off FOR x IN range(0, n)]::INT[] AS ids FROM (SELECT doc_id, 3 + doc_id % 6 AS n, floor(0.5 * (64 - (3 + doc_id % 6) + 1))::INT AS off FROM documents)""")
def position_offsets(spark, d):
    rows = table(spark, d, "documents").select("doc_id", (3 + F.col("doc_id") % 6).cast("int").alias("n"))
    return rows.select("doc_id", A.position_ids("n", 64, "offset", draw=F.lit(0.5)).alias("ids"))


# ---- evaluation ---------------------------------------------------------------------------


@query("SELECT doc_id, list_position(scores, list_max(scores)) - 1 AS pred_idx, list_position(scores, list_max(scores)) - 1 = true_idx AS correct FROM {TRIALS}")
def forced_choice(spark, d):
    return evaluation.forced_choice(trials(spark, d)).select("doc_id", "pred_idx", "correct")


_CHOSEN = "(SELECT *, list_position(scores, list_max(scores)) - 1 = true_idx AS correct FROM {TRIALS})"


def chosen(spark, d) -> DataFrame:
    return evaluation.forced_choice(trials(spark, d))


@query(f"SELECT lang, target_tokens, count(*) AS n, count_if(correct)::BIGINT AS n_correct, round(count_if(correct) / count(*), 9) AS accuracy FROM {_CHOSEN} GROUP BY ALL")
def accuracy_by_lang_ctx(spark, d):
    return evaluation.accuracy(chosen(spark, d), "lang", "target_tokens").withColumn("accuracy", r9("accuracy"))


@query(f"""SELECT target_tokens, round(count_if(correct AND depth = 0) / nullif(count_if(depth = 0), 0), 9) AS "acc_0.0", round(count_if(correct AND depth = 0.5) / nullif(count_if(depth = 0.5), 0), 9) AS "acc_0.5", round(count_if(correct AND depth = 0.9) / nullif(count_if(depth = 0.9), 0), 9) AS "acc_0.9" FROM {_CHOSEN} GROUP BY ALL""")
def accuracy_grid(spark, d):
    grid = evaluation.accuracy_grid(chosen(spark, d), "target_tokens", "depth", [0.0, 0.5, 0.9])
    return grid.select("target_tokens", *[r9(f"`{c}`").alias(c) for c in grid.columns[1:]])


@query(f"SELECT lang, target_tokens, condition, count(*) AS n, count_if(correct)::BIGINT AS n_correct FROM {_CHOSEN} GROUP BY GROUPING SETS ((lang, target_tokens), (lang, condition))")
def accuracy_by_condition(spark, d):
    return evaluation.accuracy_sets(chosen(spark, d))


_TASKS = "(SELECT CASE doc_id % 4 WHEN 0 THEN 'niah_single' WHEN 1 THEN 'niah_multikey' WHEN 2 THEN 'vt' ELSE 'cwe' END AS task, (4096 * (1 + doc_id % 3))::BIGINT AS ctx, (length(text) % 10) / 10.0::DOUBLE AS score FROM documents)"


@query(f"""SELECT category, ctx, round(avg(score), 9) AS mean_score FROM (SELECT unnest([CASE task WHEN 'niah_single' THEN 'single' WHEN 'niah_multikey' THEN 'multikey' WHEN 'vt' THEN 'multi' ELSE 'aggregation' END, 'overall']) AS category, ctx, score FROM {_TASKS}) GROUP BY ALL""")
def category_means(spark, d):
    i = F.col("doc_id")
    scores = table(spark, d, "documents").select(F.when(i % 4 == 0, "niah_single").when(i % 4 == 1, "niah_multikey").when(i % 4 == 2, "vt").otherwise("cwe").alias("task"), (4096 * (1 + i % 3)).alias("ctx"), ((F.length("text") % 10) / 10.0).alias("score"))
    return evaluation.category_means(scores, {"niah_single": "single", "niah_multikey": "multikey", "vt": "multi", "cwe": "aggregation"})


@query(f"SELECT lang, round(count_if(correct) / count(*), 9) AS accuracy, (row_number() OVER (ORDER BY count_if(correct) / count(*), lang))::INT AS rank FROM {_CHOSEN} WHERE target_tokens = 4096 GROUP BY lang")
def rank_cell(spark, d):
    cells = evaluation.accuracy(chosen(spark, d), "lang", "target_tokens")
    return evaluation.rank_at(cells, "target_tokens", 4096, "accuracy", "lang").select("lang", r9("accuracy").alias("accuracy"), "rank")


@query("""SELECT seq_len, count(*) AS windows, round(sum(loss * (seq_len - 1)) / sum(seq_len - 1), 6) AS loss, round(exp(least(20, sum(loss * (seq_len - 1)) / sum(seq_len - 1))), 6) AS ppl
FROM (SELECT (64 * (1 + doc_id % 3))::BIGINT AS seq_len, 1 + (length(text) % 100) / 40.0::DOUBLE AS loss FROM documents) GROUP BY seq_len""")
def windowed_ppl(spark, d):
    rows = table(spark, d, "documents").select((64 * (1 + F.col("doc_id") % 3)).alias("seq_len"), (1 + (F.length("text") % 100) / 40.0).alias("loss"))
    return evaluation.windowed_loss(rows).select("seq_len", "windows", F.round("loss", 6).alias("loss"), F.round("ppl", 6).alias("ppl"))


@query("SELECT doc_id, (unnest(range(0, least(greatest(0, (length(text) - 1) // 128), 5))) * 128)::INT AS start FROM documents")
def windows_nonoverlap(spark, d):
    return table(spark, d, "documents").select("doc_id", F.explode(A.windows(F.length("text"), 128, 5)).alias("start"))


@query("SELECT max(doc_id) AS doc_id, condition, target_tokens, depth, trial FROM {TRIALS} GROUP BY ALL")
def dedupe_last(spark, d):
    return evaluation.last_per_case(trials(spark, d), "doc_id").select("doc_id", "condition", "target_tokens", "depth", "trial")


@query("""SELECT c AS condition, t::BIGINT AS target_tokens, dp::DOUBLE AS depth, k::BIGINT AS trial FROM (VALUES ('main'), ('no_context'), ('shuffled')) a(c), (VALUES (2048), (4096), (16384)) b(t), (VALUES (0.0), (0.25), (0.5)) e(dp), (VALUES (0), (1), (2)) f(k)
WHERE NOT EXISTS (SELECT 1 FROM {TRIALS} x WHERE x.condition = c AND x.target_tokens = t AND round(x.depth, 8) = round(dp, 8) AND x.trial = k)""")
def resume_pending_cases(spark, d):
    grid = evaluation.spine(spark, condition=["main", "no_context", "shuffled"], target_tokens=[2048, 4096, 16384], depth=[0.0, 0.25, 0.5], trial=[0, 1, 2]).withColumns({"target_tokens": F.col("target_tokens").cast("long"), "trial": F.col("trial").cast("long")})
    return evaluation.pending_cases(grid, trials(spark, d).select(*evaluation.CASE))


# ---- embeddings -----------------------------------------------------------------------------

_DOT = "(SELECT q.vec_id AS query, k.vec_id AS key, list_dot_product(q.embedding::DOUBLE[], k.embedding::DOUBLE[]) AS score FROM embeddings q JOIN embeddings k ON k.vec_id <= q.vec_id WHERE q.vec_id % 50 = 0)"


@query(f"SELECT query, rank::INT AS rank, key, round(score, 4) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, key) AS rank FROM {_DOT}) WHERE rank <= 8")
def causal_topk(spark, d):
    return vectors.topk(table(spark, d, "embeddings"), "vec_id", "embedding", 8, every=50).select("query", "rank", "key", F.round("score", 4).alias("score"))


@query(f"""WITH p AS (SELECT *, exp(score - max(score) OVER (PARTITION BY query)) / sum(exp(score)) OVER (PARTITION BY query) * exp(max(score) OVER (PARTITION BY query)) AS p, row_number() OVER (PARTITION BY query ORDER BY score DESC, key) AS rank FROM {_DOT}), n AS (SELECT count(*) AS n FROM embeddings),
q AS (SELECT p, rank, unnest([-1, (CASE WHEN query >= n // 4 THEN 1 ELSE 0 END + CASE WHEN query >= 2 * n // 4 THEN 1 ELSE 0 END + CASE WHEN query >= 3 * n // 4 THEN 1 ELSE 0 END)]) AS quarter FROM p, n)
SELECT quarter::INT AS quarter, round(sum(CASE WHEN rank <= 8 THEN p ELSE 0 END) / sum(p), 4) AS recall, count(*) AS pairs FROM q GROUP BY quarter""")
def topk_recall(spark, d):
    e = table(spark, d, "embeddings")
    out = vectors.recall_by_quarter(vectors.masses(e, "vec_id", "embedding", 8, every=50), e.count())
    return out.select("quarter", F.round("recall", 4).alias("recall"), "pairs")


@query(f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, key) AS a, row_number() OVER (PARTITION BY query ORDER BY key DESC) AS b FROM {_DOT})
SELECT count(DISTINCT query) AS queries, round(count_if(a <= 8 AND b <= 8) / 8 / count(DISTINCT query), 9) AS overlap FROM r""")
def topk_overlap(spark, d):
    e = table(spark, d, "embeddings")
    recent = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query"), F.explode(F.sequence(F.greatest(F.lit(0), F.col("vec_id") - 7), F.col("vec_id"))).alias("key"))
    return vectors.overlap(vectors.topk(e, "vec_id", "embedding", 8, every=50), recent, 8)


@query(f"""WITH p AS (SELECT query, exp(score - max(score) OVER (PARTITION BY query)) AS e, row_number() OVER (PARTITION BY query ORDER BY score DESC, key) AS r, count(*) OVER (PARTITION BY query) AS n FROM {_DOT})
SELECT round(avg(m), 4) AS mass FROM (SELECT query, sum(CASE WHEN r <= ceil(n * 0.1::DOUBLE) THEN e ELSE 0 END) / sum(e) AS m FROM p GROUP BY query)""")
def compressibility(spark, d):
    return vectors.compressibility(table(spark, d, "embeddings"), "vec_id", "embedding", 0.1, every=50).select(F.round("mass", 4).alias("mass"))


# ---- events, and relations of the star schema ---------------------------------------------------


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def events_hourly(spark, d):
    return streaming.event_windows(table(spark, d, "events")).withColumn("total", F.round("total", 4))


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n FROM s GROUP BY user_id, k""")
def event_sessions(spark, d):
    return streaming.sessions(table(spark, d, "events"))


@query("""SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000) AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def star_semi_anti(spark, d):
    c, o = table(spark, d, "customer"), table(spark, d, "orders")
    rich, open_ = o.where("o_totalprice > 200000"), o.where("o_orderstatus = 'P'")
    return c.join(rich, c.c_custkey == rich.o_custkey, "left_semi").join(open_, c.c_custkey == open_.o_custkey, "left_anti").select("c_custkey", "c_name")


@query("""SELECT r_name, n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)""")
def star_rollup(spark, d):
    c, n, r = (table(spark, d, x) for x in ("customer", "nation", "region"))
    return c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).rollup("r_name", "n_name").agg(F.count("*").alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("SELECT DISTINCT lang FROM documents WHERE source = 'src1' INTERSECT SELECT DISTINCT lang FROM documents WHERE source = 'src2'")
def set_intersect(spark, d):
    of = lambda s: table(spark, d, "documents").where(F.col("source") == s).select("lang")
    return of("src1").intersect(of("src2"))


@query("SELECT source FROM documents EXCEPT SELECT source FROM documents WHERE lang = 'es' AND length(text) > 3000")
def set_except(spark, d):
    s = table(spark, d, "documents")
    return s.select("source").subtract(s.where((F.col("lang") == "es") & (F.length("text") > 3000)).select("source"))


from . import more_queries, text_queries  # noqa: E402, F401  (add their queries to the catalogue)
