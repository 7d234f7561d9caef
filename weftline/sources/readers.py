"""Readers: Parquet with whatever columns there are, tolerant and strict JSON Lines, listings, manifests, specifications."""

from __future__ import annotations

import re
import warnings
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from . import files

CANONICAL = "lang string, text string, token_count bigint"
#: Columns that a flexible row may have.
FLEXIBLE = ("text", "content", "token_count", "tokens", "lang", "language", "id", "doc_id")


def parquet(spark: SparkSession, paths, columns=("text", "token_count"), ignore_corrupt: bool = True, schema: str | None = "text string, token_count bigint") -> DataFrame:
    """Only the named columns are read; files that cannot be read are passed over unless told otherwise. Without a schema that of a readable file is taken."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.option("ignoreCorruptFiles", str(ignore_corrupt).lower())
    return (reader.schema(schema) if schema else reader).parquet(*paths).select(*columns)


def jsonl(spark: SparkSession, paths, schema: str = CANONICAL, strict: bool = False) -> DataFrame:
    """JSON Lines: blank lines are passed over; malformed ones are too, or are an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(paths)


def flexible(df: DataFrame, known_langs: list[str], path: str | None = None, default_source: str = "local", row: str | None = None, whole: bool = False) -> DataFrame:
    """(text, lang, token_count, source, local_id, doc_id) from rows with any of FLEXIBLE; without a text column, an empty table. Rows without an id of their own have the value of column ``row``, their place over all files.

    Texts are stripped, and rows whose text is blank are left out; with ``whole``, texts are as they are and all rows stay.
    """
    have = set(df.columns)
    pick = lambda *names: [F.col(n) for n in names if n in have]
    texts = pick("text", "content")
    if not texts:
        return df.sparkSession.createDataFrame([], "text string, lang string, token_count long, source string, local_id string, doc_id string")
    place = F.col(path) if path else F.lit("")
    lang = T.first_true(*pick("lang", "language"), T.lang_from_path(place, known_langs))
    own = T.first_true(*texts)
    text = F.coalesce(own, *texts) if whole else T.strip(F.coalesce(own, F.lit("")))
    counts = (pick("token_count", "tokens") + [None, None])[:2]
    local = T.first_true(*[c.cast("string") for c in pick("id", "doc_id")])
    local = local if row is None else F.coalesce(local, F.col(row).cast("string"))
    source = F.coalesce(F.col("source"), F.lit(default_source)) if "source" in have else F.lit(default_source)
    rows = df.select(text.alias("text"), lang.alias("lang"), T.resolve_tokens(text if whole else T.strip(own), *counts, policy="bundle").alias("token_count"), source.alias("source"), local.alias("local_id"))
    kept = rows if whole else rows.where(F.length("text") > 0)
    return kept.withColumn("doc_id", T.doc_id("source", "local_id", "text"))


def _footers(batches):
    """(path, rows, columns and their types) of Parquet files, from their footers."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    for batch in batches:
        for uri in batch.column("path").to_pylist():
            system, path = files.opened(uri)
            with system.open_input_file(path) as f:
                meta = pq.ParquetFile(f)
                yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([meta.metadata.num_rows], pa.int64()), pa.array([[f"{f.name}\t{f.type}" for f in meta.schema_arrow]])], ["path", "rows", "columns"])


def _spark_footers(spark: SparkSession, paths: list[str]) -> dict[str, dict]:
    """The same by Spark's own reader, for stores that only Spark opens: rows in one job, which reads no column, and a schema for each file."""
    with ThreadPoolExecutor(8) as pool:
        schemas = dict(zip(paths, pool.map(lambda p: spark.read.parquet(p).schema, paths)))
    counted = spark.read.schema("none string").parquet(*paths).groupBy(_read_path().alias("path")).count().collect()
    rows = {r["path"]: r["count"] for r in counted}
    name = lambda p: re.sub(r"^file:/+", "/", p)
    return {p: {"rows": rows.get(name(p), 0), "columns": [f"{f.name}\t{f.dataType.simpleString()}" for f in schemas[p]]} for p in paths}


def row_offsets(spark: SparkSession, paths: list[str]) -> list[tuple[str, int, tuple[str, ...]]]:
    """(path, rows of all files before it, columns with a tab and their type) of each file in the order given; footers are read in one job, a row for each file of the argument comes back."""
    n = min(len(paths), int(spark.conf.get("spark.sql.shuffle.partitions")))
    distinct = list(dict.fromkeys(paths))
    if all(map(files.opens, distinct)):
        named = spark.createDataFrame([(p,) for p in distinct], "path string").repartition(max(1, n))
        found = {r["path"]: r for r in named.mapInArrow(_footers, "path string, rows long, columns array<string>").collect()}
    else:
        found = _spark_footers(spark, distinct)
    out, first = [], 0
    for path in paths:
        out.append((path, first, tuple(sorted(set(found[path]["columns"])))))
        first += found[path]["rows"]
    return out


def _plain(path: F.Column) -> F.Column:
    """A file's path without a local scheme, which readers and listings spell in two ways."""
    return F.regexp_replace(path, r"^file:/+", "/")


def _read_path() -> F.Column:
    """The path of the file that a row was read from, its characters as they are: readers escape them, but for plus signs."""
    return _plain(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))


def flexible_parquet(spark: SparkSession, paths: list[str], known_langs: list[str], default_source: str = "local", whole: bool = False) -> DataFrame:
    """Flexible rows of Parquet files, each with the columns it has; rows are numbered over all files in the order given, whatever their partitions. ``whole`` as in ``flexible``.

    Files with the same columns of the same types are one scan, so there are no
    more branches than such sets; where a file's numbers begin is looked up by
    its path.
    """
    if not paths:
        return flexible(spark.createDataFrame([], "none string"), known_langs)
    kinds: dict[tuple, list[tuple[str, int]]] = {}
    for path, first, columns in row_offsets(spark, paths):
        kinds.setdefault(tuple(c for c in columns if c.partition("\t")[0] in (*FLEXIBLE, "source")), []).append((path, first))
    out = None
    for names, own in kinds.items():
        # A row for each file of the argument.
        table = F.broadcast(spark.createDataFrame(own, "_path string, _first long").select("_path", _plain(F.col("_path")).alias("_p"), "_first"))
        rows = spark.read.parquet(*dict.fromkeys(p for p, _ in own)).select(*[f"`{c.partition(chr(9))[0]}`" for c in names], _read_path().alias("_p"), F.col("_metadata.row_index").alias("_index"))
        part = flexible(rows.join(table, "_p").withColumn("_row", F.col("_first") + F.col("_index")), known_langs, "_path", default_source, "_row", whole)
        out = part if out is None else out.unionByName(part)
    return out


def numbered_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, line, value) of text files; lines are numbered from 0 in their file, blank ones as well, and go on over the parts of a file that is a folder of its name.

    A reader's task has stretches of files. Lines are numbered in their stretch
    by their order in the task; how many lines of the file come before it is
    summed up over its stretches, a row each.
    """
    rows = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"))
    stretches = rows.groupBy("path", "_block").agg(F.min("_id").alias("_least"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(whole(F.col("path"))).orderBy("path", "_block").rowsBetween(Window.unboundedPreceding, -1))
    stretches = stretches.withColumn("_before", F.coalesce(before, F.lit(0))).withColumnsRenamed({"path": "_p", "_block": "_b"})
    # A row for each stretch; a join by stretches would bring all lines of one together.
    met = rows.join(F.broadcast(stretches), (F.col("path") == F.col("_p")) & (F.col("_block") == F.col("_b")))
    return met.select(whole(F.col("path")).alias("path"), (F.col("_before") + F.col("_id") - F.col("_least")).alias("line"), "value")


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def discover(spark: SparkSession, patterns: list[str]) -> list[str]:
    """Files and folders that match each pattern, sorted, in the order of the patterns; a pattern without a match gives a warning."""
    jvm, found = spark.sparkContext._jvm, []
    for pattern in patterns:
        where = jvm.org.apache.hadoop.fs.Path(pattern)
        statuses = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where)
        paths = sorted(s.getPath().toString() for s in statuses or ())
        if not paths:
            warnings.warn(f"nothing matches {pattern}", stacklevel=2)
        found += paths
    return found


def parts(spark: SparkSession, paths: list[str]) -> list[str]:
    """The same with the files below it, by their names, in place of each folder; what begins with _ or . is none of them."""
    jvm, found = spark.sparkContext._jvm, []
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        status = system.getFileStatus(where)
        if status.isFile():
            found.append(path)
            continue
        inside = [s for s in system.listStatus(where) if not s.getPath().getName().startswith(("_", "."))]
        found += parts(spark, sorted(s.getPath().toString() for s in inside))
    return found


def documents(spark: SparkSession, kind: str, patterns: list[str], known_langs: list[str], lang: str | None = None, source: str | None = None, whole: bool = False) -> DataFrame:
    """Flexible rows of a kind of source: ``jsonl``, ``parquet`` or ``shards`` (Parquet whose language and source are given, not read); ``whole`` as in ``flexible``."""
    if kind == "jsonl":
        schema = "text string, content string, token_count bigint, tokens bigint, lang string, language string, id string, doc_id string, source string, _bad string"
        parsed = numbered_lines(spark, discover(spark, patterns)).where("trim(value) <> ''").select("path", "line", F.from_json("value", schema, {"columnNameOfCorruptRecord": "_bad"}).alias("_r"))
        rows = parsed.select(F.col("path").alias("_path"), F.col("line").alias("_row"), "_r.*").where("_bad is null").drop("_bad")
        # Rows without an id of their own have their line's number.
        return flexible(rows, known_langs, "_path", row="_row", whole=whole)
    if kind in ("parquet", "shards"):
        rows = flexible_parquet(spark, parts(spark, discover(spark, patterns)), known_langs, whole=whole)
        if kind == "parquet":
            return rows
        rows = rows.withColumns({"lang": F.lit(lang), "source": F.lit(source)})
        return rows.withColumn("doc_id", T.doc_id("source", "local_id", "text"))
    raise ValueError(f"no kind of source {kind!r}; there are jsonl, parquet, shards")


def valid_rows(lines: DataFrame, schema: str, required: list[str], value: str = "value") -> DataFrame:
    """Rows of JSON Lines that parse and have all required fields, of the schema's types; others are passed over."""
    parsed = lines.select(F.from_json(value, schema).alias("_r"), F.col(value).alias("_v")).select("_r.*")
    for name in required:
        parsed = parsed.where(F.col(name).isNotNull())
    return parsed


def bundle_eligible(df: DataFrame, langs: list[str], least: int, most: int) -> DataFrame:
    """Known languages among those asked for (none: all), of least to most tokens (0: no limit)."""
    keep = (F.col("lang") != "unknown") & (F.col("token_count") >= least)
    keep = keep & F.col("lang").isin(langs) if langs else keep
    return df.where(keep & (F.col("token_count") <= most) if most > 0 else keep)


def listing(spark: SparkSession, folder: str, pattern: str | None = None) -> DataFrame:
    """(path, name, size) of the files below a folder; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = (reader.option("pathGlobFilter", pattern) if pattern else reader).load(folder)
    return files.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.col("length").alias("size"))


def checksums(spark: SparkSession, folder: str, skip: tuple = (".cache/",), own: str = "checksums.json") -> DataFrame:
    """(path, bytes, sha256) of the files below a folder, without caches and the table of checksums itself; files are read in pieces, of any size."""
    names = listing(spark, folder).where(~F.col("path").endswith(f"/{own}"))
    for part in skip:
        names = names.where(~F.col("path").contains(f"/{part}"))
    # Largest files apart from one another.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return names.select("path").repartition(parts, "path").mapInArrow(files.digests(), "path string, bytes long, sha256 string")


def whole(path: F.Column) -> F.Column:
    """The file that a path is, or is a part of: parts of a file lie in a folder of its name, as Spark writes them, in the order of their names."""
    own = F.regexp_extract(path, files.ENDINGS, 0)
    return F.when(own == "", path).otherwise(own)


def text_digests(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """(path, bytes, chars, sha256) of the texts below a folder, each a file or a folder with its parts; read in pieces, so that a text of any size takes the memory of one."""
    found = listing(spark, folder, pattern).groupBy(whole(F.col("path")).alias("path")).agg(F.array_sort(F.collect_list("path")).alias("parts"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return found.repartition(parts, "path").mapInArrow(files.text_digests(), "path string, bytes long, chars long, sha256 string")


MANIFEST = "name string, language string, tier string, source string, docs bigint, source_token_count bigint, bin_bytes bigint, idx_bytes bigint, bin_sha256 string, idx_sha256 string"


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """Chunk manifests, one JSON document a file; those that cannot be parsed are left out."""
    rows = spark.read.schema(MANIFEST + ", _corrupt string").option("multiLine", "true").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return rows.where("name is not null").drop("_corrupt")


def whole_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)
