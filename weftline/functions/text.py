"""String, hash and parsing functions as column expressions. Lengths are code points throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What ends an instruction prompt, in the order in which it goes, and the stub that is put in its place.
PROMPT_ENDS = (r"(?s)<Answer>.*", r"(?s)\nAnswer:.*$", r"(?s)\nPlease answer.*$")
STUB = "\nThe answer is:"

_EDGE = r"(?U)^[\s\x{1C}-\x{1F}]+|[\s\x{1C}-\x{1F}]+$"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Without Unicode white space, and the four ASCII separators, at either end; ``trim`` would take blanks only."""
    return F.regexp_replace(col(c), _EDGE, "")


def approx_tokens(c, chars_per_token: float = 4) -> Column:
    """Characters by characters a token, rounded down, at least 1."""
    n = F.length(col(c))
    whole = F.floor(n / F.lit(int(chars_per_token))) if chars_per_token == int(chars_per_token) else F.floor(n / F.lit(float(chars_per_token)))
    return F.greatest(F.lit(1), whole).cast("long")


def resolve_tokens(text, count=None, other=None, policy: str = "filter") -> Column:
    """The token count of a row by one of four policies.

    ``filter``: a positive count, else a quarter of the whole text's length.
    ``source``: the first of two counts that is not 0 or null, if positive, else a quarter of the stripped text's length.
    ``bundle``: the first of two counts that is not null, 0 included, else the length by 3.8.
    ``sum``: the count, null as 0.
    """
    null = F.lit(None).cast("long")
    count, other = (null if c is None else col(c).cast("long") for c in (count, other))
    if policy == "filter":
        return F.when(count > 0, count).otherwise(approx_tokens(text))
    if policy == "source":
        first = F.coalesce(F.nullif(count, F.lit(0)), other)
        return F.when(first > 0, first).otherwise(approx_tokens(strip(text)))
    if policy == "bundle":
        return F.coalesce(count, other, approx_tokens(text, 3.8))
    if policy == "sum":
        return F.coalesce(count, F.lit(0).cast("long"))
    raise ValueError(f"no token policy {policy!r}")


def first_true(*columns) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(F.lit(None), *[F.when(F.length(col(c).cast("string")) > 0, col(c)) for c in columns])


def csv(c, kind: str = "string") -> Column:
    """Items of a list separated by commas, stripped, without empty ones."""
    items = F.filter(F.transform(F.split(col(c), ","), strip), lambda x: x != "")
    return items if kind == "string" else F.transform(items, lambda x: x.cast(kind))


def pairs(c) -> Column:
    """A map from a list of key=value items."""
    return F.map_from_entries(F.transform(csv(c), lambda x: F.struct(strip(F.split_part(x, F.lit("="), F.lit(1))).alias("key"), strip(F.split_part(x, F.lit("="), F.lit(2))).alias("value"))))


def skip_ranges(c) -> Column:
    """Rows (lang, shard) as an array, from items such as ``fr:24`` or ``en:s20-s22``; a reversed or malformed range is an error."""
    bad = lambda x: F.raise_error(F.concat(F.lit("bad shard range: "), x))

    def rows(x: Column) -> Column:
        lang, lo, hi = (F.regexp_extract(x, r"^\s*([^:\s]+):\s*s?(\d+)(?:-s?(\d+))?\s*$", k) for k in (1, 2, 3))
        first = lo.cast("int")
        last = F.when(hi == "", lo).otherwise(hi).cast("int")
        return F.when((lang == "") | (last < first), bad(x)).otherwise(F.transform(F.sequence(first, last), lambda k: F.struct(lang.alias("lang"), k.alias("shard"))))

    return F.flatten(F.transform(csv(c), rows))


def lang_from_path(path, known: list[str]) -> Column:
    """The part of the file's name, or else of its folder's, before the first _ or ., if it is a known language; else ``unknown``."""
    head = lambda part: F.regexp_extract(part, r"^([^_.\-]+)", 1)
    parts = F.split(col(path), "/")
    stem, folder = head(F.element_at(parts, -1)), head(F.try_element_at(parts, F.lit(-2)))
    return F.when(stem.isin(known), stem).when(folder.isin(known), folder).otherwise(F.lit("unknown"))


def doc_id(source, local_id, text) -> Column:
    """The first 16 hex digits of the SHA-1 of source, local id and the first 256 characters, joined by line feeds."""
    return F.substring(F.sha1(F.concat_ws("\n", col(source), col(local_id).cast("string"), F.substring(col(text), 1, 256)).cast("binary")), 1, 16)


def case_seed(seed: int, lang, condition, tokens, depth, trial) -> Column:
    """The first 8 bytes of the SHA-256 of a case's parts joined by |, as a decimal."""
    text = F.concat_ws("|", F.lit(str(seed)), col(lang), col(condition), col(tokens).cast("string"), F.format_string("%.8f", col(depth).cast("double")), col(trial).cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 16), 16, 10).cast("decimal(20,0)")


def chunk_name(lang, shard, chunk, tier, run_id: str = "") -> Column:
    name = F.format_string("%s_s%04d_c%05d_%s", col(lang), col(shard), col(chunk), col(tier))
    return F.concat(F.lit(f"{run_id}_"), name) if run_id else name


def pack_id(prefix: str, split: str, lang, target, n) -> Column:
    return F.format_string(f"{prefix}_{split}_%s_%d_%06d", col(lang), col(target), col(n))


def human_bytes(c) -> Column:
    """Decimal units with one digit."""
    n = col(c).cast("double")
    of = lambda unit, name: F.format_string(f"%.1f {name}", n / unit)
    return F.when(n >= 1e12, of(1e12, "TB")).when(n >= 1e9, of(1e9, "GB")).when(n >= 1e6, of(1e6, "MB")).otherwise(of(1e3, "KB"))


def completion_prefix(prompt, stub: str = STUB) -> Column:
    """An instruction prompt without what follows its answer tag, answer line or plea, with a stub to complete."""
    text = strip(prompt)
    for pattern in PROMPT_ENDS:
        text = strip(F.regexp_replace(text, pattern, ""))
    return F.concat(text, F.lit(stub))


def byte_ids(c, shift: int = 2, end: int | None = 1) -> Column:
    """Each UTF-8 byte plus ``shift``, and an end id: a tokenizer without a vocabulary."""
    # Each byte is a character of this charset, and a split at nothing has one item a character, without a regular expression.
    signs = F.decode(F.encode(col(c), "UTF-8"), "ISO-8859-1")
    ids = F.when(signs == "", F.array().cast("array<int>")).otherwise(F.transform(F.split(signs, ""), lambda x: F.ascii(x) + shift))
    return ids if end is None else F.concat(ids, F.array(F.lit(end)))


def byte_text(ids, shift: int = 2) -> Column:
    """The text of byte ids; ids below the shift are marks and go."""
    signs = F.transform(col(ids), lambda x: F.when(x >= shift, F.char(x - shift)).otherwise(""))
    return F.decode(F.encode(F.array_join(signs, ""), "ISO-8859-1"), "UTF-8")
