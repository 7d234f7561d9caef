"""ZIP packages of web archives against the standard library's ZIP files, and read back in all forms."""

import gzip
import hashlib
import io
import random
import zipfile

import pytest

from weftline.llm import op11_zip_archives as zips
from weftline.llm.common import work_folder


def sha(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


def test_writer_and_standard_library():
    out, rng = io.BytesIO(), random.Random(1)
    members = {f"archive/é{k}.bin": rng.randbytes(k * 1000) for k in range(5)}
    writer = zips.PackageWriter(out)
    for name, data in members.items():
        writer.begin(name)
        for lo in range(0, len(data), 300):
            writer.write(data[lo : lo + 300])
        writer.end()
    writer.close()
    with zipfile.ZipFile(out) as z:
        assert {n: z.read(n) for n in z.namelist()} == members and z.testzip() is None
    for name, method, local, stored, full in zips.directory(out, len(out.getvalue())):
        at = zips.data_start(out, local)
        assert method == 0 and stored == full and out.getvalue()[at : at + full] == members[name]


@pytest.mark.parametrize("before", [b"", b"#!/bin/sh\n" * 50])
@pytest.mark.parametrize("comment", [b"", b"PK\x05\x06 and more" * 20])
def test_directories_of_the_standard_library(before, comment):
    """Without ZIP64 records, with a comment that holds the end mark, and behind other bytes."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a/x.warc", b"abc" * 100)
        z.writestr(zipfile.ZipInfo("b/y"), b"")
        z.writestr("c/z", b"q" * 5000, zipfile.ZIP_DEFLATED)
        z.comment = comment
    raw = before + out.getvalue()
    found = zips.directory(io.BytesIO(raw), len(raw))
    assert [(n, m, f) for n, m, _, _, f in found] == [("a/x.warc", 0, 300), ("b/y", 0, 0), ("c/z", 8, 5000)]
    at = zips.data_start(io.BytesIO(raw), found[0][2])
    assert raw[at : at + 300] == b"abc" * 100
    with pytest.raises(ValueError):
        zips.directory(io.BytesIO(raw[:-4] + b"\x00" * 40), len(raw) + 36)


PAYLOADS = [b"", b"short", b"short", "né 日本🙂".encode() * 20, b"x" * 100, b"x" * 100, b"y" * 99, b"y" * 99, b"\r\n\r\nWARC/1.1\r\n" * 400]


def test_round_trip_in_small_members(spark):
    """Many members and packages, whole payloads, addresses with blanks, and ids that are null or repeat."""
    rng = random.Random(2)
    rows = [(k, f"http://a.example/{k} x?é=1", rng.choice(PAYLOADS).decode()) for k in range(300)] + [(None, None, "z" * 200), (None, "u", "z" * 200), (7, "again", None), (400, None, "x" * 100), (400, None, "x" * 100), (500, "big", "big " * 2_000_000)]
    df = spark.createDataFrame(rows, "id long, u string, h string")
    folder = work_folder(spark)
    packages = zips.write_archives(df.repartition(3), "id", "u", "h", folder, package=8_000, member=2_000)
    assert packages.count() > 3 and sum(r["records"] for r in packages.collect()) == len(rows)
    got = zips.checked(zips.read_archives(packages, span=3000), folder).collect()
    first: dict[str, int] = {}
    for i, _, h in rows:
        if len((h or "").encode()) >= 100 and i is not None:
            first[h] = min(i, first.get(h, i))
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        to = first.get(h) if len(raw) >= 100 and first.get(h) != i else None
        want.append((str(i), len(raw), sha(raw), "revisit" if to is not None else "response", str(to)))
    assert sorted((str(r["key"]), r["n"], r["digest"], r["record_type"], str(r["refers"])) for r in got) == sorted(want)
    bodies = zips.read_archives(packages).where("record_type = 'response'").collect()
    assert all(sha(r["payload"]) == r["digest"] and r["payload"] in {(h or "").encode() for _, _, h in rows} for r in bodies)


def test_foreign_packages(spark, tmp_path):
    """Archives without an index, compressed or not, next to other records; a compressed member and a wrong digest are errors."""
    records = [zips.record(k, None, p, len(p), sha(p)) for k, p in enumerate(PAYLOADS)]
    info = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    path = f"{tmp_path}/p.wacz"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("archive/a.warc.gz", b"".join(gzip.compress(x) for x in [info, *records]))
        z.writestr("archive/b.warc", info + b"".join(records))
        z.writestr("pages/pages.jsonl", b"{}", zipfile.ZIP_DEFLATED)
    read = lambda p: zips.read_archives(spark.createDataFrame([(f"file://{p}",)], "package string")).collect()
    got = read(path)
    assert sorted((r["key"], bytes(r["payload"])) for r in got) == sorted(2 * list(enumerate(PAYLOADS)))
    for name, data, method in (("a.warc.gz", b"x", zipfile.ZIP_DEFLATED), ("a.warc", zips.record(1, None, b"other", 5, sha(b"these")), zipfile.ZIP_STORED)):
        with zipfile.ZipFile(path, "w") as z:
            z.writestr(f"archive/{name}", data, method)
        with pytest.raises(Exception, match="compressed|digest"):
            read(path)


def test_lost_responses_are_errors(spark):
    rows = [(1, None, "response", b"", 5, "d", None), (2, None, "revisit", None, 5, "d", 1), (3, None, "revisit", None, 5, "e", 1)]
    df = spark.createDataFrame(rows, "key long, url string, record_type string, payload binary, n long, digest string, refers long")
    assert zips.checked(df.where("key < 3"), work_folder(spark)).count() == 2
    with pytest.raises(ValueError, match="revisits"):
        zips.checked(df, work_folder(spark))


def test_empty_table(spark):
    none = spark.createDataFrame([], "id long, u string, h string")
    packages = zips.write_archives(none, "id", "u", "h", work_folder(spark))
    assert packages.count() == 0 and zips.read_archives(packages).count() == 0
