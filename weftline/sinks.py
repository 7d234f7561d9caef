"""Sinks: JSON Lines by language or tier, manifests, data paths, cards, packages, metrics."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sources import chunk_files, files, readers


def jsonl(df: DataFrame, path: str, by: tuple = ("lang",), mode: str = "errorifexists") -> None:
    """A folder for each value; characters beyond ASCII stay as they are."""
    df.write.mode(mode).partitionBy(*by).json(path)


#: Folders of chunks' texts, and the types of their values.
CHUNKS = {"lang": "string", "tier": "string", "shard": "long", "chunk": "int"}


def chunk_texts(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Texts alone, by language, tier, shard and chunk; blank ones go. Files are written by pyarrow where it knows the file system."""
    from .functions.text import strip

    rows = df.where(F.length(strip("text")) > 0).select(*CHUNKS, "text")
    if mode == "overwrite" or not files.opens(path):
        rows.write.mode(mode).partitionBy(*CHUNKS).json(path)
    elif mode == "append" or not files.exists(path):
        chunk_files.write(rows, path, tuple(CHUNKS))
    elif mode != "ignore":
        raise FileExistsError(f"{path} exists already")


def chunk_rows(spark: SparkSession, path: str) -> DataFrame:
    """(text, lang, tier, shard, chunk) of the files that ``chunk_texts`` wrote."""
    if files.opens(path):
        return chunk_files.read(spark, path, CHUNKS)
    return spark.read.schema(", ".join(f"{c} {t}" for c, t in {"text": "string", **CHUNKS}.items())).json(path)


def manifest(document: dict, path: str) -> None:
    """One document, indented, whole or not at all, on any file system."""
    files.put(path, (json.dumps(document, indent=2, ensure_ascii=False) + "\n").encode())


def lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A report: few lines, in one file."""
    df.coalesce(1).write.mode(mode).text(path)


def append_rows(df: DataFrame, path: str) -> None:
    """A log of results: what a failed run had written before stays."""
    df.write.mode("append").json(path)


def card(chunks: DataFrame, title: str) -> str:
    """A description of a tokenised set with its totals."""
    t = chunks.agg(F.count("*").alias("n"), F.sum("docs").alias("docs"), F.sum("bin_bytes").alias("bytes"), F.array_sort(F.collect_set("language")).alias("langs")).first()
    return f"# {title}\n\n* chunks: {t['n']:,}\n* documents: {t['docs'] or 0:,}\n* bytes: {t['bytes'] or 0:,}\n* languages: {', '.join(t['langs'])}\n"


def package(spark: SparkSession, bin_dir: str, mix_dir: str, out: str, info: dict) -> dict:
    """Copy token files and mixture into one folder, with build information and checksums; files are copied by tasks, in pieces."""
    pairs = [(uri, f"{out.rstrip('/')}/{part}{uri.removeprefix(src.rstrip('/'))}") for part, src in (("bin", bin_dir), ("mix", mix_dir)) for uri in files.below(src)]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.createDataFrame(pairs, "path string, to string").repartition(n, "path").mapInArrow(files.copies(), "path string, to string, bytes long").write.format("noop").mode("overwrite").save()
    manifest(info, f"{out}/manifests/build_info.json")
    rows = readers.checksums(spark, out).collect()  # a row for each file of the package
    at = out.rstrip("/").removeprefix("file://").removeprefix("file:") + "/"
    table = {r["path"].removeprefix("file://").removeprefix("file:").partition(at)[2]: {"bytes": r["bytes"], "sha256": r["sha256"]} for r in rows}
    manifest(dict(sorted(table.items())), f"{out}/manifests/checksums.json")
    return table


# Messages worth another try, the step in seconds that each failure adds, and the longest wait.
RETRIES = (
    (r"500 Internal Server Error|502 Bad Gateway|503 Service Unavailable|504 Gateway Timeout", 120, 900),
    (r"429|(?i:rate limit)", 60, 600),
)
# Messages that name a time, and the seconds to add to the number they give, or to wait if they give none.
NAMED = ((r"Retry after (\d+) seconds", 30), (r"about 1 hour", 3700))


def wait_seconds(message: str, attempt: int) -> int | None:
    """How long to wait before another try: a time that the message names, else in steps; null if no kind of RETRIES fits."""
    kinds = [(step, longest) for pattern, step, longest in RETRIES if re.search(pattern, message)]
    named = [sum(map(int, m.groups()), extra) for pattern, extra in NAMED if (m := re.search(pattern, message))]
    steps = [min(longest, step * attempt) for step, longest in kinds]
    return next(iter(named + steps)) if kinds else None


def waits(message, attempt) -> F.Column:
    """The same for columns, null where another try is of no use."""
    message = F.col(message) if isinstance(message, str) else message
    kind = F.lit(None).cast("int")
    for pattern, step, longest in reversed(RETRIES):
        kind = F.when(message.rlike(pattern), F.least(F.lit(longest), F.lit(step) * attempt).cast("int")).otherwise(kind)
    named = F.lit(None).cast("int")
    for pattern, extra in reversed(NAMED):
        number = F.regexp_extract(message, pattern, 1).cast("int") if "(" in pattern else F.lit(0)
        named = F.when(message.rlike(pattern), number + extra).otherwise(named)
    return F.when(kind.isNotNull(), F.coalesce(named, kind))


def commit(upload: Callable[[], None], tries: int = 5, sleep: Callable[[float], None] = time.sleep) -> int:
    """Run a commit until it succeeds; returns the tries it took. What waiting cannot mend is raised at once."""
    for attempt in range(1, tries + 1):
        try:
            upload()
            return attempt
        except Exception as error:
            wait = wait_seconds(str(error), attempt)
            if wait is None or attempt == tries:
                raise
            sleep(wait)
    raise ValueError("tries must be at least 1")


def bundle_files(rows: DataFrame, path: str, prefix: str, split: str, facts: dict) -> dict:
    """Bundles as JSON Lines in a folder for each target, and a manifest with their numbers by language and target."""
    rows.write.mode("overwrite").partitionBy("target_tokens").json(f"{path}/{prefix}_{split}")
    counts = rows.groupBy("lang", "target_tokens").agg(F.count("*").alias("n")).collect()  # a row for each cell of the grid
    document = {"created_at_unix": int(time.time()), "prefix": prefix, "split": split, **facts, "counts": {f"{r['lang']}_{r['target_tokens']}": r["n"] for r in counts}}
    manifest(document, f"{path}/{prefix}_{split}_manifest.json")
    return document


def merged(tokens: DataFrame, path: str, parts: int | None = 1) -> None:
    """All tokens of a table as so many pairs of index and token files; without a number each task writes a pair, so that more rows take no longer in any one."""
    rows = tokens.select("tokens")
    (rows.coalesce(parts) if parts else rows).write.format("indexed_tokens").option("path", path).mode("append").save()


def merged_by(tokens: DataFrame, path: str, by: tuple = ("lang", "tier")) -> list[str]:
    """Token files in a folder for each value of ``by``, in one pass over the rows; values whose folder holds an index already are left alone. Returns the new folders.

    Rows of a value are brought together, one with many of them in several
    tasks, and each task writes its values one after the other.
    """
    folders = lambda: {p.removeprefix(path.rstrip("/") + "/").partition("/")[0] for p in files.below(path, ".idx")}
    have = folders()
    name = F.concat_ws("_", *[F.coalesce(F.url_encode(F.col(c).cast("string")), F.lit("null")) for c in by])
    rows = tokens.select(name.alias("folder"), "tokens")
    rows = rows.where(~F.col("folder").isin(sorted(have))) if have else rows
    rows.hint("rebalance", "folder").sortWithinPartitions("folder").write.format("indexed_tokens").option("path", path).option("folder", "folder").mode("append").save()
    return sorted(folders() - have)
