"""Main text of web pages from flat text blocks.

A page becomes a flat list of text blocks. Each has its number of words, the
share of them within links, the same of the blocks beside it, and whether it
stands within a container of content or of boilerplate. A decision tree,
trained on a small labelled table of such blocks, says which to keep.

Character references are decoded, white space within a block becomes one
space, and kept blocks are joined in page order by an empty line. A line break
element is white space. Scripts, styles, forms' controls, comments and the
head are never text.

Names of classes, ids and roles mark containers. Words that name boilerplate and
articles alike are weak marks: such a container is taken for what it holds if
next to nothing that could be content stands outside of it.

Defined results: a null page is empty, and an empty page has empty text; a tag
that does not end is text; elements that are not closed end with what holds
them; a very long page is extracted whole, in time in proportion to it; of
equally good splits of the tree that on the container counts; repeated rows are
extracted alike; an empty table gives no rows;
further columns are ignored, whatever their names.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .op1_chunk_store import _arrow

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PARTS = re.compile(r"[A-Za-z]+")

#: Elements without text of their own; the first four end only at their own end tag.
RAW = ("script", "style", "textarea", "title")
SILENT = {*RAW, "head", "noscript", "template", "svg", "iframe", "object", "select", "button", "math", "canvas", "audio", "video", "datalist"}
BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
VOID = set("area base br col embed hr img input link meta source track wbr".split())
CONTENT, FRAME = {"article", "main"}, {"nav", "footer", "aside", "form", "menu", "dialog"}
#: Words in class, id or role that mark boilerplate, and those that mark content.
FRAME_WORDS = set("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar nav navbar navigation menu breadcrumb breadcrumbs footer masthead notice notices cookie cookies consent gdpr popup modal overlay related share sharing social comment comments respond newsletter subscribe subscription login signup widget complementary contentinfo search alert disclaimer teaser recommended trending toolbar topbar pagination pager adbox adslot adunit adcontainer".split())
#: Of these, words that also name what holds an article: they do not count where nearly all that could be content stands within.
WEAK_WORDS = set("ad ads promo promotion banner sponsor sponsored notice notices alert disclaimer popup modal overlay related share sharing social newsletter teaser recommended trending toolbar topbar widget pager pagination".split())
CONTENT_WORDS = {"article", "main", "story"}
#: Words that mark content where a page has no container of the others.
MAYBE_WORDS = {"content", "entry", "post", "text"}

#: The labelled table: words, link share, those of the block before and of the block after, within content, within boilerplate, whether the page has content containers; whether to keep.
FIELDS = ("words", "links", "words_before", "links_before", "words_after", "links_after", "content", "frame", "contents", "keep")
LABELLED = (
    (8, 0.0, 0, 0.0, 60, 0.0, 1, 0, 1, 1), (60, 0.0, 8, 0.0, 45, 0.0, 1, 0, 1, 1), (1, 0.0, 40, 0.0, 30, 0.0, 1, 0, 1, 1), (3, 1.0, 50, 0.0, 20, 0.1, 1, 0, 1, 1),
    (25, 0.4, 12, 0.0, 2, 0.0, 1, 0, 1, 1), (2, 0.0, 1, 0.0, 1, 1.0, 1, 0, 1, 1), (140, 0.05, 60, 0.0, 0, 0.0, 1, 0, 1, 1), (12, 0.0, 5, 1.0, 6, 0.0, 1, 0, 1, 1),
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 1, 1, 0), (12, 0.0, 1, 1.0, 9, 0.0, 0, 1, 1, 0), (40, 0.0, 80, 0.0, 0, 0.0, 0, 1, 1, 0), (15, 0.0, 30, 0.0, 12, 0.0, 1, 1, 1, 0),
    (60, 0.1, 4, 1.0, 50, 0.0, 1, 1, 1, 0), (2, 1.0, 25, 0.0, 2, 1.0, 1, 1, 1, 0), (30, 0.0, 12, 0.0, 3, 0.0, 0, 0, 1, 0), (4, 0.5, 20, 0.0, 1, 1.0, 0, 0, 1, 0),
    (10, 0.0, 2, 1.0, 8, 0.0, 0, 0, 1, 0), (90, 0.0, 10, 0.0, 5, 0.8, 0, 0, 1, 0), (55, 0.0, 6, 0.0, 40, 0.0, 0, 0, 0, 1), (40, 0.05, 55, 0.0, 35, 0.0, 0, 0, 0, 1),
    (7, 0.0, 2, 1.0, 60, 0.0, 0, 0, 0, 1), (9, 0.0, 45, 0.0, 50, 0.02, 0, 0, 0, 1), (120, 0.1, 3, 0.0, 4, 1.0, 0, 0, 0, 1), (18, 0.0, 60, 0.0, 2, 1.0, 0, 0, 0, 1),
    (3, 1.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0), (2, 0.0, 3, 1.0, 2, 1.0, 0, 0, 0, 0), (30, 0.9, 5, 1.0, 6, 0.9, 0, 0, 0, 0), (5, 0.0, 4, 0.0, 3, 0.0, 0, 0, 0, 0),
    (60, 0.0, 0, 0.0, 3, 0.0, 0, 0, 0, 1), (50, 0.0, 3, 0.0, 4, 1.0, 0, 0, 0, 1), (3, 0.0, 60, 0.0, 50, 0.0, 0, 0, 0, 1), (35, 0.1, 1, 1.0, 2, 1.0, 0, 0, 0, 1), (25, 0.0, 2, 0.0, 1, 0.5, 0, 0, 0, 1),
    (60, 0.0, 60, 0.0, 60, 0.0, 0, 0, 1, 0), (110, 0.0, 55, 0.0, 30, 0.0, 0, 0, 1, 0), (6, 0.0, 5, 0.0, 70, 0.0, 0, 0, 1, 0), (20, 0.1, 70, 0.0, 40, 0.0, 0, 0, 1, 0), (35, 0.0, 3, 0.0, 2, 1.0, 0, 0, 1, 0),
    (2, 1.0, 45, 0.0, 2, 1.0, 0, 0, 0, 0), (4, 0.8, 2, 0.9, 60, 0.0, 0, 0, 0, 0), (5, 0.0, 2, 0.9, 4, 0.5, 0, 0, 0, 0),
    (6, 0.0, 50, 0.0, 4, 0.6, 0, 0, 0, 1), (6, 0.0, 3, 0.8, 4, 0.6, 0, 0, 0, 0), (8, 0.3, 40, 0.0, 30, 0.0, 0, 0, 0, 1), (8, 0.3, 3, 1.0, 30, 0.0, 0, 0, 0, 0), (9, 0.0, 35, 0.0, 3, 1.0, 0, 0, 0, 1), (9, 0.0, 2, 0.9, 3, 1.0, 0, 0, 0, 0),
    (14, 0.7, 40, 0.0, 10, 0.8, 0, 0, 0, 0), (4, 0.6, 20, 0.0, 0, 0.0, 0, 0, 0, 0), (80, 0.0, 30, 0.0, 20, 0.0, 0, 1, 0, 0), (6, 0.0, 60, 0.0, 3, 0.9, 0, 1, 0, 0),
)


def grow(rows: list[tuple], depth: int = 10):
    """A tree of (field, threshold, low, high) by Gini impurity; leaves are the majority's label."""
    labels = [r[-1] for r in rows]
    if depth == 0 or len(set(labels)) < 2:
        return int(2 * sum(labels) >= len(labels))
    impurity = lambda part: len(part) * (1 - sum((sum(r[-1] == y for r in part) / len(part)) ** 2 for y in (0, 1))) if part else 0.0
    best = None
    for field in range(len(rows[0]) - 1):
        values = sorted({r[field] for r in rows})
        for a, b in zip(values, values[1:]):
            at = (a + b) / 2
            low, high = [r for r in rows if r[field] <= at], [r for r in rows if r[field] > at]
            # Of equal splits, that on the containers, which stand last.
            score = (round(impurity(low) + impurity(high), 9), -field)
            if best is None or score < best[0]:
                best = score, field, at, low, high
    if best is None:
        return int(2 * sum(labels) >= len(labels))
    _, field, at, low, high = best
    return field, at, grow(low, depth - 1), grow(high, depth - 1)


def decide(tree, row: tuple) -> bool:
    while isinstance(tree, tuple):
        field, at, low, high = tree
        tree = low if row[field] <= at else high
    return bool(tree)


def _named(attributes: str) -> set[str]:
    """The words in the values of class, id and role; the first attribute of a name counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attributes):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return {w.lower() for name in ("class", "id", "role") for w in _PARTS.findall(found.get(name, ""))}


def _role(tag: str, attributes: str, content: int) -> int:
    """1 for a container of content, 3 for what may be one, -1 for one of boilerplate and -2 for one that only weak words say is, else 0."""
    if tag in ("html", "body"):
        return 0
    words = _named(attributes) if "=" in attributes else set()
    frames = words & FRAME_WORDS
    if tag in FRAME or (tag == "header" and not content) or frames - WEAK_WORDS:
        return -1
    if frames:
        return -2
    return 1 if tag in CONTENT or words & CONTENT_WORDS else 3 if words & MAYBE_WORDS else 0


def blocks(page: str) -> list[tuple[str, int, int, int, bool, tuple[int, ...]]]:
    """(text, words, words within links, 2 within content or 1 within what may be, within boilerplate, weakly marked containers by number) of the page's text blocks."""
    out: list = []
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, int]] = []
    opened: dict[str, int] = {}
    content = maybe = frame = silent = numbers = 0
    weak: list[int] = []
    link = False

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append((text, text.count(" ") + 1, len(" ".join(linked).split()), 2 if content else int(maybe > 0), frame > 0, tuple(weak)))
            parts.clear()
            linked.clear()

    def pop() -> None:
        nonlocal content, maybe, frame, silent
        tag, role = stack.pop()
        opened[tag] -= 1
        content, maybe, frame, silent = content - (role == 1), maybe - (role == 3), frame - (role == -1), silent - (role == 2)
        if role == -2:
            weak.pop()

    at, last = 0, page.rfind(">")
    while at < len(page):
        m = _TOKEN.search(page, at) if at <= last else None  # what does not end is no tag
        piece = page[at : m.start()] if m else page[at:]
        if piece and not silent:
            piece = entities.unescape(piece)
            parts.append(piece)
            if link:
                linked.append(piece)
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in RAW and not closing:
            end = re.compile(f"</{tag}[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in BLOCK:
            flush()
        elif tag == "br" and not silent:
            parts.append(" ")
        if tag == "a":
            link = not closing
        if tag in VOID:
            continue
        if closing:
            if opened.get(tag):
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if stack and ((stack[-1][0] == "p" and tag in BLOCK) or (tag == stack[-1][0] and tag in ("li", "dd", "dt", "td", "tr", "option"))):
            pop()
        role = 2 if tag in SILENT else _role(tag, m[3] or "", content)
        if (role or tag in BLOCK) and not (m[3] or "").endswith("/"):
            stack.append((tag, role))
            opened[tag] = opened.get(tag, 0) + 1
            content, maybe, frame, silent = content + (role == 1), maybe + (role == 3), frame + (role == -1), silent + (role == 2)
            if role == -2:
                numbers += 1
                weak.append(numbers)
    flush()
    return out


def framed(found: list) -> list[bool]:
    """Whether each block stands within boilerplate. A weakly marked container counts as such unless next to nothing that could be content stands outside of it."""
    out = [frame or bool(weak) for *_, frame, weak in found]
    most = max((c for _, _, _, c, frame, _ in found if not frame), default=0)
    ignored: set[int] = set()
    for _ in range(8):
        outside, within = 0, {}
        for (_, n, linked, content, frame, weak), hidden in zip(found, out):
            if frame or content < most:
                continue
            if not hidden:
                outside += n - linked
            elif (left := [w for w in weak if w not in ignored]) and 3 * linked < n:
                within[left[0]] = within.get(left[0], 0) + n
        number, words = max(within.items(), key=lambda x: x[1], default=(0, 0))
        if words < 20 or outside > max(12, words // 20):
            break
        ignored.add(number)
        out = [frame or any(w not in ignored for w in weak) for *_, frame, weak in found]
    return out


def main_text(page: str, tree) -> str:
    """The blocks that the tree keeps."""
    found = blocks(page)
    hidden = framed(found)
    size = [(n, min(1.0, k / n)) for _, n, k, *_ in found]
    most, none = max((x[3] for x, frame in zip(found, hidden) if not frame), default=0), (0, 0.0)
    kept = []
    for k, ((text, _, _, content, _, _), frame) in enumerate(zip(found, hidden)):
        row = (*size[k], *(size[k - 1] if k else none), *(size[k + 1] if k + 1 < len(size) else none), int(content == most > 0), int(frame), int(most > 0))
        if decide(tree, row):
            kept.append(text)
    return "\n\n".join(kept)


def _extracted(tree, kinds: list[pa.DataType]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p or "", tree) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(n).cast(k) for n, k in zip(("key", "url"), kinds)], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["key", "url", "text", "n_chars"])

    return run


def extract(df: DataFrame, key: str, url: str, page: str, labelled=LABELLED) -> DataFrame:
    """(key, url, text, n_chars) of every row; ``labelled`` is the table that the tree is trained on."""
    fields = [df.schema[key], df.schema[url]]
    schema = T.StructType([T.StructField("key", fields[0].dataType), T.StructField("url", fields[1].dataType), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    rows = df.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(page).alias("html"))
    return rows.mapInArrow(_extracted(grow(list(labelled)), [_arrow(f.dataType) for f in fields]), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id", "url", "html").withColumnRenamed("key", "page_id")
