"""Byte-pair encoding of whole texts with the tokenizers library, by pieces whose encodings do not depend on their surroundings.

A piece is a stretch of text between single blanks. Pre-tokenisation never
joins characters across such a place, so the encoding of a text is that of its
pieces in order, and a piece is encoded once for all its occurrences. The
cache holds two generations of at most ``KEPT`` bytes together, so its memory
is bounded however many distinct pieces a corpus, or a single text, has. Other
operators' tasks give it up. ``Slices`` does the same for many texts at once:
their pieces are told apart in Arrow, and the distinct words among them go to
the library's model in a few long strings.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Bytes that a cache may hold, length from which a piece is not kept, pieces looked up at once, bytes that an entry takes besides its piece and value, and of how many plain words one is encoded by the whole tokenizer as well.
KEPT, LONG, BLOCK, ENTRY, CHECKED = 192 << 20, 256, 32_768, 190, 1000
#: Words whose ids are kept besides, for the marks that may follow them.
WORDS = 60_000
_TWO_BLANKS = re.compile(r"\s\s")
_SINGLE_SPACE = re.compile(r"(?<=\S)(?= \S)")


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file is; any other path may be given to the operators instead."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def load(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def spaced_pieces(text: str) -> list[str]:
    """Pieces for vocabularies in which a token may begin with the blank before a word.

    A single blank between two other characters always begins a token. A line
    feed between two others is a token of its own. Elsewhere the text is cut
    only before such single blanks.
    """
    if "\x00" in text or _TWO_BLANKS.search(text):
        return _SINGLE_SPACE.split(text)
    return text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00")


def bare_pieces(text: str) -> list[str]:
    """Pieces for vocabularies whose tokens never hold white space: blanks and line feeds go."""
    return text.replace("\n", " ").split(" ")


#: A word of Latin letters, which normalisation at most lower-cases, and marks after it: pre-tokenisation parts them and keeps each whole. No apostrophe, which may begin a contraction.
_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_SPACE = ord(" ")


class Pieces:
    """Values of pieces, made from the ids of their encodings; two generations are kept, of ``kept`` bytes together."""

    def __init__(self, path: str, make: Callable[[list[int]], object], kept: int = KEPT, encode: Callable[[str], list[int]] | None = None, weigh: Callable[[object], int] = len):
        self.tokenizer, self.make, self.kept, self.long, self.weigh = load(path), make, kept, encode, weigh
        self.young: dict = {}
        self.old: dict = {}
        self.held = self.learnt = 0
        self.marks: dict = {"": []}
        self.words: dict[str, list[int]] = {}
        self.word = self._words()

    def _words(self) -> Callable[[str], str] | None:
        """How a word of Latin letters is spelt in the vocabulary, if the library's model alone then gives what the whole tokenizer gives."""
        lower = self.tokenizer.normalizer is not None
        table = {x: (x if 33 <= x <= 126 or 161 <= x <= 172 or x >= 174 else 256 + k) for x, k in ((x, sum(not (33 <= y <= 126 or 161 <= y <= 172 or y >= 174) for y in range(x))) for x in range(256))}
        blank = table[_SPACE]

        def spelt(word: str) -> str:
            word = word.lower() if lower else word
            if word.isascii():
                return chr(blank) + word[1:] if word[0] == " " else word
            return word.encode().decode("latin-1").translate(table)

        self.word = spelt
        samples = ["a", "The", "Thention", "èvÉÿß", "Ñiño", "qxz.", "ÀÖØöø,", "ERTION!!", "aaaaaaaaaa", "the&&&", "Ñ$$$", "on*** "[:-1], "er,%%%", "st|>"]
        samples += [] if lower else [" " + x for x in samples]
        same = all(self._plain(x) == self.tokenizer.encode(x, add_special_tokens=False).ids for x in samples)
        return spelt if same else None

    def _ids(self, word: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(word)]

    def _plain(self, piece: str) -> list[int] | None:
        """The ids of a word with marks after it, by the library's model; null if the piece is something else."""
        if piece.isascii() and (piece[1:].isalpha() and piece[0] == " " or piece.isalpha()):
            return [t.id for t in self.tokenizer.model.tokenize(self.word(piece))]
        m = _WORD.fullmatch(piece, 1 if piece[:1] == " " else 0)
        if m is None:
            return None
        marks = m[2]
        if not marks:
            return self._ids(self.word(piece))
        word = piece[: m.end(1)]
        # A word that is met without marks, or with others, is known already.
        if (ids := self.words.get(word)) is None:
            if len(self.words) >= WORDS:
                self.words = {}
            ids = self.words[word] = self._ids(self.word(word))
        if (after := self.marks.get(marks)) is None:
            after = self._ids(marks)
            if len(marks) <= 16:
                if len(self.marks) > 10_000:
                    self.marks = {"": []}
                self.marks[marks] = after
        return ids + after

    def _whole(self, pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def encoded(self, pieces: list[str]) -> list[list[int]]:
        """The ids of each piece: plain words by the library's model alone, others by the whole tokenizer."""
        if self.word is None:
            return self._whole(pieces)
        ids = list(map(self._plain, pieces))
        rest = [k for k, x in enumerate(ids) if x is None]
        # A sample goes both ways. A difference ends the task: ids that went out before it may be wrong as well.
        first = -self.learnt % CHECKED
        self.learnt += len(pieces)
        for piece, own in zip(pieces[first::CHECKED], ids[first::CHECKED]):
            if own is not None and self._whole([piece])[0] != own:
                raise ValueError(f"the vocabulary's model alone does not encode {piece!r} as the whole tokenizer does")
        if rest:
            for k, x in zip(rest, self._whole([pieces[k] for k in rest])):
                ids[k] = x
        return ids

    def _encoded(self, pieces: list[str]) -> list:
        return list(map(self.make, self.encoded(pieces)))

    def learn(self, missing: Iterable[str]) -> dict:
        """Values of pieces that the young generation lacks; those too long to keep are returned only."""
        extra, new, weigh = {}, [], self.weigh
        for piece in missing:
            if (value := self.old.get(piece)) is not None:
                self.young[piece] = value
                self.held += ENTRY + len(piece) + weigh(value)
            elif len(piece) > LONG:
                extra[piece] = self.make(self.long(piece)) if self.long else self._encoded([piece])[0]
            else:
                new.append(piece)
        if new:
            values = self._encoded(new)
            self.young.update(zip(new, values))
            self.held += ENTRY * len(new) + sum(map(len, new)) + sum(map(weigh, values))
        return extra

    def of(self, pieces: list[str]) -> list:
        """The values of one text's pieces."""
        if len(pieces) > BLOCK:
            return [v for lo in range(0, len(pieces), BLOCK) for v in self.of(pieces[lo : lo + BLOCK])]
        if 2 * self.held > self.kept:
            self.old, self.young, self.held = self.young, {}, 0
        values = list(map(self.young.get, pieces))
        missing = [k for k, v in enumerate(values) if v is None]
        if missing:
            extra = self.learn({pieces[k] for k in missing})
            get = self.young.get
            for k in missing:
                v = get(pieces[k])
                values[k] = extra[pieces[k]] if v is None else v
        return values


_shared: dict = {}


def shared(key: tuple, build: Callable):
    """One object for each Python worker process and key, kept while the worker is reused."""
    if key not in _shared:
        _shared[key] = build()
    return _shared[key]


def release() -> None:
    """Give up what this worker keeps; tasks that do not tokenize call it first."""
    _shared.clear()


def ids_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def raw_ids(path: str, split: Callable[[str], list[str]]) -> Callable[[str], bytes]:
    """A function from a text to its ids as little-endian 32-bit integers."""
    pieces = shared((path, split.__name__, "raw"), lambda: Pieces(path, ids_bytes))
    return lambda text: b"".join(pieces.of(split(text)))


#: Bytes of texts whose pieces are told apart together, a longer text being encoded by itself; words in one string for the model.
SLICE, TOGETHER = 20 << 20, 1000
_BLANKS = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
#: What ``spaced_pieces`` cuts otherwise, and a word with marks after it, for Arrow.
_ODD = f"[{_BLANKS}]{{2}}|\\x00"
_MARKED = f"^(?P<word> ?{_WORD.pattern[1 : _WORD.pattern.index(')')]})(?P<marks>{_WORD.pattern[_WORD.pattern.index(')') + 2 : -1]})$"


class Slices:
    """Ids of whole texts as little-endian 32-bit integers, by the pieces of ``spaced_pieces``; nothing is kept from slice to slice but what ``Pieces`` keeps of the pieces that are no words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.pieces = Pieces(path, ids_bytes)
        self.plain = self.pieces.word is not None and self.pieces.tokenizer.normalizer is None
        if self.plain:
            self.words = Tokenizer(self.pieces.tokenizer.model)
            self.words.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
            vocab = self.pieces.tokenizer.get_vocab()
            self.sizes = np.zeros(max(vocab.values()) + 1, np.int64)
            self.sizes[list(vocab.values())] = [len(t) for t in vocab]
            others = [x for x in range(256) if not (33 <= x <= 126 or 161 <= x <= 172 or x >= 174)]
            self.spelt = np.arange(256, dtype="<u4")
            self.spelt[others] = range(256, 256 + len(others))
            self.spelt[ord("\n")] = ord("\n")

    def _modelled(self, words: pa.Array) -> pa.Array:
        """The ids of words by the library's model: many in one string, parted where as many bytes have been spelt as each has."""
        rows = words.to_pylist()
        strings = []
        for lo in range(0, len(rows), TOGETHER):
            raw = np.frombuffer("\n".join(rows[lo : lo + TOGETHER]).encode(), np.uint8)
            strings.append(self.spelt[raw].tobytes().decode("utf-32-le"))
        ids = [np.array(e.ids, "<u4") for lo in range(0, len(strings), 16) for e in self.words.encode_batch_fast(strings[lo : lo + 16], add_special_tokens=False)]
        ids = np.concatenate(ids) if ids else np.zeros(0, "<u4")
        spelt = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.sizes[ids])])
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(pc.binary_length(words).to_numpy())])
        at = np.searchsorted(spelt, ends)
        if spelt[-1] != ends[-1] or (spelt[at] != ends).any():
            raise ValueError("the vocabulary's model does not spell words byte by byte")
        return pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(4 * at), pa.py_buffer(ids)])

    def _values(self, pieces: pa.Array) -> pa.Array:
        """The ids of distinct pieces."""
        parts = pc.extract_regex(pieces, _MARKED)
        plain = pc.is_valid(parts)
        mine = pieces.filter(plain)
        word, marks = (x.dictionary_encode() for x in parts.filter(plain).flatten())
        found = pc.binary_join_element_wise(*(self._modelled(x.dictionary).take(x.indices) for x in (word, marks)), pa.scalar(b"", pa.large_binary()))
        # A sample goes both ways, as in ``Pieces``.
        first = -self.pieces.learnt % CHECKED
        self.pieces.learnt += len(mine)
        sample = pa.array(range(first, len(mine), CHECKED), pa.int64())
        for piece, own in zip(mine.take(sample).to_pylist(), found.take(sample).to_pylist()):
            if ids_bytes(self.pieces._whole([piece])[0]) != own:
                raise ValueError(f"the vocabulary's model alone does not encode {piece!r} as the whole tokenizer does")
        rest = pa.array(self.pieces.of(pieces.filter(pc.invert(plain)).to_pylist()), pa.large_binary())
        return pc.replace_with_mask(pc.replace_with_mask(pa.nulls(len(pieces), pa.large_binary()), plain, found), pc.invert(plain), rest)

    def _slice(self, texts: pa.Array) -> list[bytes]:
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        feeds = raw == ord("\n")
        begins = feeds | (raw == _SPACE)
        begins[1:] |= feeds[:-1]
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        at = np.append(np.flatnonzero(begins), len(raw))
        del feeds, begins
        pieces = pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(raw)]).dictionary_encode()
        ids = self._values(pieces.dictionary).take(pieces.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[np.searchsorted(at, offsets)].tolist()
        whole = memoryview(ids.buffers()[2] or b"")
        return [bytes(whole[a:b]) for a, b in zip(ends, ends[1:])]

    def of(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text, a null one being empty."""
        texts = texts.cast(pa.large_string()).fill_null("")
        sizes = pc.binary_length(texts).to_numpy()
        alone = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False) | (sizes > SLICE) | (not self.plain)
        lo = 0
        while lo < len(texts):
            if alone[lo]:
                yield b"".join(self.pieces.of(spaced_pieces(texts[lo].as_py())))
                lo += 1
                continue
            hi, held = lo, 0
            while hi < len(texts) and not alone[hi] and (hi == lo or held + sizes[hi] <= SLICE):
                held += sizes[hi]
                hi += 1
            yield from self._slice(texts.slice(lo, hi - lo))
            lo = hi


def raw_ids_of_all(path: str) -> Callable[[pa.Array], Iterator[bytes]]:
    """A function from an Arrow array of texts to the ids of each as little-endian 32-bit integers."""
    return shared((path, "slices"), lambda: Slices(path)).of
