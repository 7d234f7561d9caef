"""Synthetic retrieval texts. Values come from hashes of a seed and the row, so every engine and every retry makes the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions.text import approx_tokens, byte_ids, col

#: Our own wording for some languages; a table with these columns extends them.
TEMPLATES = {
    "en": ("Read the records below. One of them answers the question at the end.\n", "Record {idx}: the code of {key} is {value}.\n", "Note {idx}: nothing about {key} was written down that day.\n", "\nQuestion: what is the code of {key}?\nAnswer: {answer}\n"),
    "de": ("Lies die Einträge unten. Einer beantwortet die Frage am Ende.\n", "Eintrag {idx}: der Code von {key} lautet {value}.\n", "Notiz {idx}: zu {key} wurde an dem Tag nichts festgehalten.\n", "\nFrage: wie lautet der Code von {key}?\nAntwort: {answer}\n"),
    "fr": ("Lisez les fiches ci-dessous. L'une répond à la question finale.\n", "Fiche {idx} : le code de {key} est {value}.\n", "Note {idx} : rien n'a été consigné ce jour-là sur {key}.\n", "\nQuestion : quel est le code de {key} ?\nRéponse : {answer}\n"),
    "es": ("Lee las fichas siguientes. Una responde a la pregunta final.\n", "Ficha {idx}: el código de {key} es {value}.\n", "Nota {idx}: ese día no se anotó nada sobre {key}.\n", "\nPregunta: ¿cuál es el código de {key}?\nRespuesta: {answer}\n"),
}
TASKS = ("single_key", "multi_key", "aggregation", "no_answer")
#: Depths of the evidence, and places of a trace's fact.
DEPTHS, PLACES = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0), ("start", "middle", "end")
NAMES = ("amber", "cobalt", "falcon", "harbor", "juniper", "lantern", "meadow", "onyx", "quartz", "willow")


def template_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, *v) for k, v in TEMPLATES.items()], "lang string, preamble string, fact string, filler string, question string")


def draw(seed: int, low: int, high: int, *parts) -> Column:
    """An integer from low to high - 1 by the hash of a seed and parts."""
    text = F.concat_ws("|", F.lit(str(seed)), *[col(p).cast("string") if not isinstance(p, (int, float)) else F.lit(str(p)) for p in parts])
    return (F.lit(low) + F.pmod(F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint"), F.lit(high - low))).cast("bigint")


def code(seed: int, *parts) -> Column:
    return draw(seed, 1_000_000, 9_999_999, *parts).cast("string")


def key(seed: int, *parts) -> Column:
    return F.concat(F.element_at(F.array(*map(F.lit, NAMES)), (draw(seed, 0, len(NAMES), *parts, F.lit("name")) + 1).cast("int")), F.lit("-"), draw(seed, 1000, 9999, *parts, F.lit("number")).cast("string"))


def fill(template, **values) -> Column:
    """The template with {names} replaced."""
    out = col(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), col(value).cast("string"))
    return out


def grid(spark: SparkSession, n: int, langs: list[str], targets: list[int], tasks=TASKS, depths=DEPTHS) -> DataFrame:
    """Rows with language, task and depth in turn, for each target length."""
    pick = lambda values, i: F.element_at(F.array(*map(F.lit, values)), (i % len(values) + 1).cast("int"))
    i = F.col("i")
    rows = spark.range(n).withColumnRenamed("id", "i").select("i", pick(langs, i).alias("lang"), pick(tasks, F.floor(i / len(langs))).alias("task"), pick(depths, i).alias("depth"), pick(PLACES, i).alias("place"))
    return rows.withColumn("target_tokens", F.explode(F.array(*[F.lit(t).cast("long") for t in targets])))


def cases(df: DataFrame, number: str, targets: list[int], tasks=TASKS, depths=DEPTHS) -> DataFrame:
    """The same for rows that have a number and a language of their own."""
    pick = lambda values, i: F.element_at(F.array(*map(F.lit, values)), (i % len(values) + 1).cast("int"))
    i = F.col("i")
    rows = df.select(F.col(number).alias("i"), "lang").select("i", "lang", pick(tasks, F.floor(i / len(tasks))).alias("task"), pick(depths, i).alias("depth"), pick(PLACES, i).alias("place"))
    return rows.withColumn("target_tokens", F.explode(F.array(*[F.lit(t).cast("long") for t in targets])))


def _lines(n, line) -> Column:
    return F.when(n <= 0, F.lit("")).otherwise(F.array_join(F.transform(F.sequence(F.lit(1), n.cast("int")), line), ""))


def curriculum(cases: DataFrame, templates: DataFrame, seed: int = 0, split: str = "train", span: int = 2_097_152) -> DataFrame:
    """Texts with evidence for a question at a depth, distractors beside it and filler around it, near a target length."""
    rows = cases.join(F.broadcast(templates), "lang")  # a row for each language
    k, v = key(seed, "i", "target_tokens"), code(seed, "i", "target_tokens", F.lit("a"))
    rows = rows.withColumns({"needle_key": k, "_a": v, "_b": code(seed, "i", "target_tokens", F.lit("b")), "_n": draw(seed, 3, 9, "i", "target_tokens", F.lit("n"))})
    fact = lambda idx, name, value: fill("fact", idx=idx, key=name, value=value)
    other = lambda tag: lambda j: fact(j, key(seed, "i", "target_tokens", F.lit(tag), j), code(seed, "i", "target_tokens", F.lit(tag), j, F.lit("v")))
    event = lambda name, what: lambda j: F.concat(fill("filler", idx=j, key=name(j)), F.lit(f"[{what}]\n"))
    alerts = F.transform(F.sequence(F.lit(1), F.col("_n").cast("int")), event(lambda j: F.col("needle_key"), "ALERT"))
    notices = F.transform(F.sequence(F.lit(11), F.lit(18)), event(lambda j: key(seed, "i", "target_tokens", F.lit("notice"), j), "NOTICE"))
    task = F.col("task")
    evidence = (
        F.when(task == "single_key", fact(F.lit(0), F.col("needle_key"), F.col("_a")))
        .when(task == "multi_key", F.concat(fact(F.lit(0), F.concat(F.col("needle_key"), F.lit(" A")), F.col("_a")), fact(F.lit(1), F.concat(F.col("needle_key"), F.lit(" B")), F.col("_b"))))
        .when(task == "aggregation", F.array_join(A.hash_order(F.concat(alerts, notices), seed), ""))
        .when(task == "no_answer", F.array_join(F.transform(F.sequence(F.lit(0), F.lit(15)), other("absent")), ""))
        .otherwise(F.raise_error(F.concat(F.lit("no task "), task)))
    )
    answer = F.when(task == "single_key", F.col("_a")).when(task == "multi_key", F.concat(F.lit("A="), F.col("_a"), F.lit("; B="), F.col("_b"))).when(task == "aggregation", F.col("_n").cast("string")).otherwise("NOT_FOUND")
    distractors = F.array_join(F.transform(F.sequence(F.lit(100), F.lit(111)), other("near")), "")
    rows = rows.withColumns({"answer": answer, "evidence": F.concat(evidence, distractors)})
    rows = rows.withColumns({"query": fill("question", key="needle_key", answer="answer"), "_line": approx_tokens(fill("filler", idx=F.lit(999999), key=F.lit("onyx-9999")), 3.8)})
    rows = rows.withColumn("_fixed", approx_tokens(F.concat("preamble", "evidence", "query"), 3.8))
    rows = rows.withColumn("fillers", F.greatest(F.lit(0), F.floor((F.col("target_tokens") - F.col("_fixed")) / F.col("_line")) + 2))
    rows = rows.withColumn("before", F.least("fillers", F.greatest(F.lit(0), F.bround(F.col("fillers") * F.col("depth")).cast("bigint"))))
    filler = lambda start: lambda j: fill("filler", idx=j + start, key=key(seed, "i", F.lit("filler"), j + start))
    text = F.concat("preamble", _lines(F.col("before"), filler(F.lit(0))), "evidence", _lines(F.col("fillers") - F.col("before"), filler(F.col("before").cast("int"))), "query")
    rows = rows.withColumns({"text": text, "estimated_tokens": F.col("_fixed") + F.col("fillers") * F.col("_line")})
    meta = F.map_filter(F.create_map(F.lit("meta_alert_count"), F.when(task == "aggregation", F.col("_n").cast("string")), F.lit("meta_values"), F.when(task == "multi_key", F.to_json(F.struct(F.col("_a").alias("A"), F.col("_b").alias("B"))))), lambda _, x: x.isNotNull())
    pose = F.struct(F.col("target_tokens").alias("physical_context_tokens"), F.lit(span).cast("long").alias("max_position_tokens"), F.lit("sample_skip_offsets_during_training").alias("position_id_strategy"))
    return rows.select("i", "text", "lang", F.lit(split).alias("split"), "task", "target_tokens", "estimated_tokens", F.lit(None).cast("long").alias("actual_tokens"), "depth", "answer", "needle_key", pose.alias("pose"), meta.alias("meta"), "fillers", "before")


def traces(cases: DataFrame, templates: DataFrame, seed: int = 0) -> DataFrame:
    """Texts with one true fact among 15 others, at the start, in the middle or near the end of filler."""
    rows = cases.join(F.broadcast(templates), "lang").withColumns({"needle_key": key(seed, "i", "target_tokens", F.lit("t")), "answer": code(seed, "i", "target_tokens", F.lit("t"))})
    rows = rows.withColumns({"query": fill("question", key="needle_key", answer="answer"), "fact_text": fill("fact", idx=F.lit(0), key="needle_key", value="answer")})
    others = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(15)), lambda j: fill("fact", idx=j, key=key(seed, "i", F.lit("other"), j), value=code(seed, "i", F.lit("other"), j))), "")
    rows = rows.withColumns({"others": others, "_line": approx_tokens(fill("filler", idx=F.lit(0), key=F.lit("onyx-9999")), 3.8)})
    need = F.greatest(F.lit(0), F.col("target_tokens") - approx_tokens(F.concat("preamble", "fact_text", "others", "query"), 3.8))
    rows = rows.withColumn("fillers", F.floor(need / F.col("_line")) + 2)
    at = F.when(F.col("place") == "start", 0).when(F.col("place") == "middle", F.floor(F.col("fillers") / 2)).otherwise(F.floor(F.col("fillers") * 0.85))
    line = lambda start: lambda j: fill("filler", idx=j + start, key=key(seed, "i", F.lit("filler"), j + start))
    text = F.concat("preamble", _lines(at, line(F.lit(0))), "fact_text", "others", _lines(F.col("fillers") - at, line(at.cast("int"))), "query")
    return rows.select("i", text.alias("text"), "lang", F.lit("anti_cropping_trace").alias("task"), F.col("place").alias("fact_position"), "target_tokens", "fillers", "needle_key", "answer")


def needle_context(lines, depth, needle, n) -> Column:
    """Filler lines repeated to n, with the needle at int(n * depth)."""
    return A.inserted(A.cycled(lines, n), depth, needle)


def lines_within(counts, room) -> Column:
    """How many lines, taken in turn and from the first again, have no more than ``room`` tokens together: whole rounds, then a search in the prefix sums of one."""
    counts = col(counts)
    sums = F.aggregate(counts, F.array().cast("array<bigint>"), lambda a, x: F.concat(a, F.array(F.coalesce(F.element_at(a, F.when(F.size(a) > 0, F.lit(-1)).otherwise(F.lit(None))), F.lit(0).cast("bigint")) + x)))
    total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, x: a + x)
    left = F.greatest(room, F.lit(0)).cast("bigint")
    whole = F.floor(left / total)
    return F.when((F.size(counts) == 0) | (total <= 0), F.lit(0)).otherwise(whole * F.size(counts) + F.size(F.filter(sums, lambda x: x <= left - whole * total))).cast("int")


def budget_context(df: DataFrame, lines: str, depth: str, needle: Column, budget: int, count=None, most: int = 0) -> DataFrame:
    """Column context: filler lines, repeated as needed, with the needle at int(n * depth), of as many lines as go with it into a budget of tokens; column n_lines says how many.

    ``count`` gives a line's tokens, bytes and a line feed without one. Lines
    without tokens would be repeated without end, so each counts for one at
    least; ``most`` bounds the lines.
    """
    count = count or (lambda x: F.octet_length(x) + 1)
    sized = df.withColumn("_counts", F.transform(lines, lambda x: F.greatest(count(x), F.lit(1)).cast("bigint")))
    n = lines_within("_counts", F.lit(budget) - count(needle))
    n = F.least(n, F.lit(most)) if most else n
    rows = sized.withColumn("n_lines", n)
    # Filler without lines is the needle alone.
    return rows.withColumn("context", F.when(F.col("n_lines") > 0, needle_context(lines, depth, needle, F.col("n_lines"))).otherwise(F.array(needle))).drop("_counts")


def trial(values, truth, seed: int, n: int = 4, swapped: bool = False) -> Column:
    """Candidates and the place of the true one; swapped, the truth is another key's value and the asked one a distractor."""
    others = F.filter(col(values), lambda x: x != col(truth))
    true = F.get(others, F.lit(0)) if swapped else col(truth)
    wrong = F.slice(F.concat(F.array(col(truth)), F.slice(others, 2, n)), 1, n - 1) if swapped else F.slice(others, 1, n - 1)
    candidates = A.hash_order(F.concat(F.array(true), F.array_distinct(wrong)), seed)
    return F.struct(candidates.alias("candidates"), (F.array_position(candidates, true) - 1).cast("int").alias("true_idx"), true.alias("true_value"))


def byte_example(before, evidence, after, query, n: int) -> Column:
    """Byte ids of an example cut or padded with blanks, in its filler, to exactly n."""
    head, mid, tail, end = (byte_ids(x, end=None) for x in (before, evidence, after, query))
    room = F.greatest(F.lit(n - 1) - F.size(mid) - F.size(end), F.lit(0))
    first = F.slice(head, 1, F.least(F.size(head), F.floor(room / 2).cast("int")))
    second = F.slice(tail, 1, room - F.size(first))
    pad = F.array_repeat(F.lit(ord(" ") + 2), (room - F.size(first) - F.size(second)).cast("int"))
    return F.slice(F.concat(first, mid, second, pad, end, F.array(F.lit(1))), 1, n)


def meta_columns(df: DataFrame, values: str, without: tuple = ("lang", "language")) -> DataFrame:
    """A map's entries but two, each key after ``meta_``."""
    kept = F.map_filter(values, lambda k, _: ~k.isin(*without))
    return df.withColumn(values, F.transform_keys(kept, lambda k, _: F.concat(F.lit("meta_"), k)))


def exact_budget(lines, tail, n: int) -> Column:
    """Byte ids of exactly n: lines as long as there is room before the tail, the last one cut, and blanks if they do not fill it."""
    room = F.greatest(F.lit(n) - F.size(byte_ids(tail)), F.lit(0))
    head = F.slice(F.flatten(F.transform(col(lines), lambda x: byte_ids(x, end=None))), 1, room)
    pad = F.array_repeat(F.lit(ord(" ") + 2), room - F.size(head))
    return F.slice(F.concat(head, pad, byte_ids(tail)), 1, n)


def shard_stats(examples: DataFrame) -> DataFrame:
    n = F.coalesce("actual_tokens", "estimated_tokens")
    return examples.groupBy("target_tokens").agg(F.count("*").alias("examples"), F.min(n).alias("min_tokens"), F.max(n).alias("max_tokens"), F.round(F.avg(n), 6).alias("mean_tokens"))
