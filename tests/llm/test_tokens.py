"""Encoding by pieces and by trees, the store, and packing, against the library and plain versions."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from weftline.llm import op1_chunk_store as store
from weftline.llm import op8_linear_grouping as pack
from weftline.llm import op9_tree_bpe as tree
from weftline.llm import tokens
from weftline.llm.common import work_folder

NAMES = {"byte_bpe_50k.json": tokens.spaced_pieces, "word_bpe_49k.json": tokens.bare_pieces}


def texts():
    rng = random.Random(4)
    hard = ["", " ", "\n", "  a  b ", "\ta\x0bb", "x<|endoftext|>y <|endoftext|> z", "it's they'll !!'s", "éa ́b", "a b", "\x1cf\x1c", "日本語" * 40, "🙂 👨‍👩‍👧" * 20, "\x00a b", "ΑΣ İI ÿŸß", "q\r\nz", "Yé!" * 200]
    return hard + ["".join(rng.choice("abÉST.,-'st !\ńé日1🙂 ") for _ in range(rng.randint(1, 80))) for _ in range(800)]


@pytest.mark.parametrize("name", NAMES)
def test_pieces_are_exact(name):
    path = tokens.vocabulary(name)
    encode, whole = tokens.raw_ids(path, NAMES[name]), tokens.load(path)
    for text in texts():
        assert encode(text) == tokens.ids_bytes(whole.encode(text, add_special_tokens=False).ids), text


@pytest.mark.parametrize("most", [1 << 20, 300])
def test_slices_are_exact(most, monkeypatch):
    """All texts at once: odd ones, those beyond a slice, nulls, and slices of nothing."""
    monkeypatch.setattr(tokens, "SLICE", most)
    path = tokens.vocabulary("byte_bpe_50k.json")
    whole, rows = tokens.load(path), [None, "", "a\nb c,\nÉa!! d", "\n", " x", "x\n", "long word " * 90, *texts(), "end", None]
    slices = tokens.Slices(path)
    assert slices.plain
    for array in (pa.array(rows), pa.array(rows, pa.large_string()).slice(3), pa.array([None, ""], pa.string()), pa.array([], pa.string())):
        for text, got in zip(array.to_pylist(), slices.of(array), strict=True):
            assert got == tokens.ids_bytes(whole.encode(text or "", add_special_tokens=False).ids), text


def test_slices_model_each_word_once(monkeypatch):
    """What repeats within a slice, with other marks too, goes to the model once."""
    slices, seen = tokens.Slices(tokens.vocabulary("byte_bpe_50k.json")), []
    real = slices._modelled
    monkeypatch.setattr(slices, "_modelled", lambda words: (seen.extend(words.to_pylist()), real(words))[1])
    list(slices.of(pa.array(["one two, two. two", "one two!\nÉté two"] * 50)))
    assert sorted(x for x in seen if x.strip(",.!")) == [" two", "one", "Été"] and not slices.pieces.young.keys() - {"\n"}


@pytest.mark.parametrize("name", NAMES)
def test_trees_are_exact(name):
    rng, tokenizer = random.Random(7), tokens.load(tokens.vocabulary(name))
    for _ in range(250):
        text = "".join(rng.choice(["er", "th", "xq", "é", "日", "!!", "'s", "1", "é", "🙂", " ", "ing"][: rng.choice([3, 6, 12])]) for _ in range(rng.randint(20, 300)))
        assert tree.tree_encode(tokenizer, text, rng.choice([7, 16, 40])) == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_digests_and_apart(spark):
    tokenizer, path = tokens.load(tokens.vocabulary("word_bpe_49k.json")), tokens.vocabulary("word_bpe_49k.json")
    rows = [(1, "ab c é" * 3000), (2, None), (3, "日本語" * 2000), (4, "short one"), (4, "ab c é" * 3000)]
    got = tree.encode_digests(spark.createDataFrame(rows, "i long, t string"), "i", "t", path, apart=1000, leaf=301).collect()
    want = []
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(tuple(r)[:4] for r in got) == sorted(want)
    assert sorted((r["key"], r["leaves"]) for r in got) == [(1, 128), (2, 1), (3, 32), (4, 1), (4, 128)]


MARKS = "\u0301\u0323\u0327\u0338\u0307\u05b0\u3099\u0345"


def stacked(rng: random.Random, most: int, length: int) -> str:
    """Letters under stacks of up to ``most`` combining marks in any order, and characters that compose backwards."""
    out = []
    while sum(map(len, out)) < length:
        out.append(rng.choice("aéİσク각ᄀxব<' ") + "".join(rng.choice(MARKS + "ᅡᆨ\u09be\u200d") for _ in range(rng.choice([0, 0, 1, 2, rng.randint(0, most)]))))
    return "".join(out)


@pytest.mark.parametrize("leaf", [16, 64, 512, 4096])
@pytest.mark.parametrize("name", NAMES)
def test_trees_under_stacked_marks(name, leaf):
    rng, tokenizer = random.Random(leaf), tokens.load(tokens.vocabulary(name))
    for k in range(120 if leaf < 512 else 4):
        text = stacked(rng, [3, 14, 60, 200][k % 4], rng.randint(1, 12) * leaf)
        assert tree.tree_encode(tokenizer, text, leaf) == tokenizer.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("leaf", [5, 40, 300])
def test_leaves_of_pieces(leaf):
    """Trees over pieces between blanks, their leaves cut anywhere, against the library's ids and decoding."""
    path = tokens.vocabulary("word_bpe_49k.json")
    tokenizer, rng = tokens.load(path), random.Random(leaf)
    words = ["the", "Token", "it's", "ization", "é́", "'", "'s", "日本", "1234", "!!", "<|endoftext|>", "<|endo", "ftext|>", "x" * 30, "", " ", "\n", "\t", "İ"]
    for _ in range(400):
        text = rng.choice([" ", "  ", "\n"]).join(rng.choice(words) + rng.choice(["", rng.choice(words)]) for _ in range(rng.randint(0, 120)))
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        n, joined, decoded, own = tree.digest_text(path, text, leaf)
        assert (n, joined, decoded) == (len(ids), " ".join(map(str, ids)), tokenizer.decode(ids, skip_special_tokens=False)), text
        assert own > 1 or len(text) <= leaf + 8


def test_long_texts_of_marks_apart(spark):
    """Texts beyond the default limits, whose leaves are encoded in tasks of their own, and a run of marks longer than a leaf."""
    rng, path = random.Random(3), tokens.vocabulary("word_bpe_49k.json")
    rows = [(k, stacked(rng, most, 40_000)) for k, most in enumerate([3, 14, 200])]
    rows += [(3, "".join(rng.choice("aé\u0301\u0323\u0327") for _ in range(40_000))), (4, "b" * 9000 + "\u0323\u0301" * 6000 + "c" * 9000)]
    got = {r["key"]: (r["n_tokens"], r["ids_sha256"], r["leaves"] > 1) for r in tree.encode_digests(spark.createDataFrame(rows, "i long, t string"), "i", "t", path).collect()}
    for i, t in rows:
        ids = tokens.load(path).encode(t, add_special_tokens=False).ids
        assert got[i] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), True), i


def test_store_round_trip(spark, data):
    path = tokens.vocabulary("byte_bpe_50k.json")
    docs = spark.read.parquet(f"{data}/documents.parquet")
    docs = docs.unionByName(docs.where("doc_id < 20").withColumn("doc_id", docs.doc_id + 1_000_000))
    folder = work_folder(spark)
    manifest = store.write_store(docs, "doc_id", "text", folder, path)
    got = {r["doc"]: r for r in store.read_digests(manifest, folder).collect()}
    restored = {r["doc"]: r["ids"] for r in store.documents_ids(manifest, folder).collect()}
    at, tokenizer, addresses = 0, tokens.load(path), set()
    for r in sorted(docs.collect(), key=lambda r: r["doc_id"]):
        ids = np.array(tokenizer.encode(r["text"], add_special_tokens=False).ids + [0], "<u4")
        g = got[r["doc_id"]]
        assert (g["start"], g["n_tokens"], g["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes())) and bytes(restored[r["doc_id"]]) == ids.tobytes()
        assert (np.concatenate(store.chunk(ids)) == ids).all()
        addresses |= {store.address(c.tobytes()) for c in store.chunk(ids)}
        at += len(ids)
    stored = [bytes(r["key"]) for r in store.chunks(spark, folder).collect()]
    assert len(stored) == len(set(stored)) and set(stored) == addresses


def test_cuts_follow_content():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 50_000, 20_000), rng.integers(0, 50_000, 777)
    one, two = ({store.address(c.astype("<u4").tobytes()) for c in store.chunk(x)} for x in (a, np.concatenate([b, a])))
    assert len(one & two) > 0.8 * len(one)
    assert all(len(c) <= store.MOST for c in store.chunk(np.zeros(30_000, np.int64)))


def test_crc_shift():
    rng = random.Random(1)
    parts = [rng.randbytes(rng.randint(0, 50)) for _ in range(40)]
    after = np.cumsum([0, *map(len, parts[::-1])])[:-1][::-1]
    moved = store.crc_shift(np.array([zlib.crc32(p) for p in parts]), after.copy())
    assert int(np.bitwise_xor.reduce(moved)) == zlib.crc32(b"".join(parts))


@pytest.mark.parametrize("n", [0, 1, 50, 3000])
def test_packing_solution(n):
    lengths = np.clip(np.exp(np.random.default_rng(n).normal(6.4, 1.3, n)).astype(int), 1, 4096).tolist()
    histogram = {x: lengths.count(x) for x in set(lengths)}
    runs, counted = pack.solve(histogram), {}
    for bins, items in runs:
        assert sum(a * m for a, m in items) <= pack.CAPACITY
        for a, m in items:
            counted[a] = counted.get(a, 0) + bins * m
    assert counted == histogram
    assert sum(b for b, _ in runs) <= 1.02 * -(-sum(lengths) // 4096) + 2


def test_packed_sequences_are_gapless(spark, data):
    got = pack.query(spark, data).toPandas()
    for _, rows in got.sort_values("offset").groupby("sequence_id"):
        assert rows["offset"].tolist() == [0, *rows["length"].cumsum().tolist()[:-1]] and rows["length"].sum() <= 4096
    tokenizer, found = tokens.load(tokens.vocabulary("word_bpe_49k.json")), got.set_index(["doc_id", "piece"])
    for r in spark.read.parquet(f"{data}/documents.parquet").collect()[:60]:
        ids = tokenizer.encode(r["text"], add_special_tokens=False).ids + [1]
        for k, a in enumerate(range(0, len(ids), 4096)):
            part, row = ids[a : a + 4096], found.loc[(r["doc_id"], k)]
            assert (row["start"], row["length"], row["ids_crc32"]) == (a, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))


def test_recipes_fit_their_roots(spark):
    from pyspark.sql import functions as F

    rows = [(k, " ".join(f"{k} word {j * j % 977}" for j in range(1500))) for k in range(2)]
    folder = work_folder(spark)
    manifest = store.write_store(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", folder, tokens.vocabulary("byte_bpe_50k.json"))
    assert store.read_digests(manifest, folder).count() == 2
    a, n = store.ADDRESS, F.octet_length("addresses")
    # The first chunk's address goes to the end: as many chunks and ids as before, in another order.
    swapped = manifest.withColumn("addresses", F.concat(F.expr(f"substring(addresses, {a + 1})"), F.expr(f"substring(addresses, 1, {a})")))
    assert manifest.where(n > a).count() == 2
    with pytest.raises(Exception, match="Merkle root"):
        store.read_digests(swapped, folder).collect()


def test_cache_is_bounded_by_bytes():
    path = tokens.vocabulary("word_bpe_49k.json")
    pieces = tokens.Pieces(path, tokens.ids_bytes, 8 << 20)
    text = " ".join(f"w{k}" for k in range(2_000_000 // 20))
    most = 0
    for lo in range(0, len(text), 100_000):
        pieces.of(tokens.bare_pieces(text[lo : lo + 100_000]))
        most = max(most, pieces.held)
    whole = pieces.of(tokens.bare_pieces("a " * 70_000 + text[:1000]))
    assert b"".join(whole) == tokens.ids_bytes(tokens.load(path).encode("a " * 70_000 + text[:1000], add_special_tokens=False).ids)
    one = sum(tokens.ENTRY + len(k) + len(v) for k, v in pieces.young.items())
    assert one == pieces.held and most <= (4 << 20) + tokens.BLOCK * 300
    # A difference between the two ways of encoding ends the task, so that nothing wrong stays.
    wrong = tokens.Pieces(path, tokens.ids_bytes)
    wrong.word = lambda word: "x"
    with pytest.raises(ValueError, match="alone"):
        wrong.of(["alpha", "beta"])


def test_packing_is_as_good_as_best_fit_decreasing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pieces = pack.cut_pieces(docs, "doc_id", "text", tokens.vocabulary("word_bpe_49k.json"))
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plain = pack.Bins(pack.CAPACITY)
    for n in sorted(histogram, reverse=True):
        plain.fit(n, histogram[n])
    fewest = sum(n for runs in plain.room.values() for n, _ in runs)
    got = pack.solve(dict(histogram))
    assert sum(n for n, _ in got) <= fewest
    assert sum(n * sum(a * b for a, b in items) for n, items in got) == sum(a * b for a, b in histogram.items())
