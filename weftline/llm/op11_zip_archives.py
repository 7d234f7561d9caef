"""Web archives packed in ZIP files, and a reader that never unpacks them.

A package is a ZIP file of stored members: archives of gzipped WARC records
(``archive/*.warc.gz``) and an index of where each record is
(``indexes/index.cdxj``). As members are stored, a record is a range of the
package itself: its member's place plus its offset there.

Writing: payloads are told apart by SHA-256. Of equal ones of at least LEAST
bytes the row with the smallest id is a response, and others revisit it,
without the payload. Tasks stream packages into the shared folder under names
of their own; the table of packages lists those of tasks that ended, so what a
lost task has left is never read.

Reading, step by step: the end of a package gives its central directory, by
way of the ZIP64 records where there are any; the directory gives the members,
of which the indexes are read whole; their lines become blocks of neighbouring
records. Blocks are dealt out to all tasks, each read in one range request,
and every payload's digest is worked out again. An archive without an index is
read from its start in pieces, compressed or not.

Folders may be on any file system that pyarrow opens by its URI.

Defined results: a null payload is empty; a null id is that of no row, so equal
payloads among null ids alone are all responses, and others revisit the
smallest id; rows that repeat the smallest id of their group are all responses;
a very long payload is a record like others; a null address is left out of the
record, and control characters and blanks in one are percent-encoded; an empty
table makes no packages; further columns are ignored, whatever their names. A
member that is compressed by ZIP, a record whose digest does not fit and a
revisit without its response are errors.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import work_folder, written

#: Least bytes of a payload that others may revisit; bytes and records after which an archive member ends, and bytes after which a package does.
LEAST, MEMBER, RECORDS, PACKAGE = 100, 64 << 20, 50_000, 512 << 20
#: Bytes of neighbouring records that a task reads in one request.
RANGE = 4 << 20
#: Groups with more than this share of all repeated rows are hot; there can be no more than so many of them.
HOT = 2000
#: Records carry no clock time, so that a task that runs again writes the same.
DATE = "2000-01-01T00:00:00Z"

# ---- ZIP: fixed values of the format -------------------------------------------

LOCAL, DESCRIPTOR, CENTRAL, END64, LOCATOR, END = 0x04034B50, 0x08074B50, 0x02014B50, 0x06064B50, 0x07064B50, 0x06054B50
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
#: Sizes after the data, and names in UTF-8.
FLAGS, VERSION64, MIDNIGHT_1980 = 0x0808, 45, 0x21


class PackageWriter:
    """A ZIP file of stored members, written to a stream from front to back, with ZIP64 records throughout."""

    def __init__(self, out):
        self.out, self.at, self.members = out, 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        raw = name.encode()
        self.name, self.start, self.crc, self.size = raw, self.at, 0, 0
        self._put(struct.pack("<IHHHHHIIIHH", LOCAL, VERSION64, FLAGS, 0, 0, MIDNIGHT_1980, 0, FULL32, FULL32, len(raw), 20) + raw + struct.pack("<HHQQ", 1, 16, 0, 0))

    def write(self, data: bytes) -> None:
        self.crc, self.size = zlib.crc32(data, self.crc), self.size + len(data)
        self._put(data)

    def end(self) -> None:
        self._put(struct.pack("<IIQQ", DESCRIPTOR, self.crc, self.size, self.size))
        self.members.append((self.name, self.start, self.crc, self.size))

    def close(self) -> None:
        directory = self.at
        for name, start, crc, size in self.members:
            self._put(struct.pack("<IHHHHHHIIIHHHHHII", CENTRAL, VERSION64, VERSION64, FLAGS, 0, 0, MIDNIGHT_1980, crc, FULL32, FULL32, len(name), 28, 0, 0, 0, 0, FULL32) + name + struct.pack("<HHQQQ", 1, 24, size, size, start))
        ending, n = self.at, len(self.members)
        self._put(struct.pack("<IQHHIIQQQQ", END64, 44, VERSION64, VERSION64, 0, 0, n, n, ending - directory, directory))
        self._put(struct.pack("<IIQI", LOCATOR, 0, ending, 1))
        self._put(struct.pack("<IHHHHIIH", END, 0, 0, FULL16, FULL16, FULL32, FULL32, 0))


def opened(uri: str):
    """(file system, path) of a folder or file, by pyarrow."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+", "file:///", uri)))


def ranged(file, at: int, n: int) -> bytes:
    file.seek(at)
    data = file.read(n)
    if len(data) != n:
        raise ValueError(f"a package ends before {at + n}")
    return data


def directory(file, size: int) -> list[tuple[str, int, int, int, int]]:
    """(name, method, start of the local header, stored size, size) of every member, from the central directory."""
    tail = ranged(file, size - min(size, 22 + FULL16), min(size, 22 + FULL16))
    at = len(tail) - 22
    while True:
        at = tail.rfind(struct.pack("<I", END), 0, at + 4)
        if at < 0:
            raise ValueError("no ZIP file: it has no end record")
        if len(tail) - at >= 22 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
        at -= 1
    end = size - len(tail) + at
    n, length, start = struct.unpack_from("<HII", tail, at + 10)
    stop = end
    if end >= 20:
        mark, _, ending, _ = struct.unpack("<IIQI", ranged(file, end - 20, 20))
        if mark == LOCATOR:
            if struct.unpack("<I", ranged(file, ending, 4))[0] != END64:
                raise ValueError("the ZIP64 locator does not lead to an end record")
            n, length, start = struct.unpack("<QQQ", ranged(file, ending + 32, 24))
            stop = ending
    # What stands before the archive, if anything, moves all its places.
    moved = stop - length - start
    raw, at, members = ranged(file, stop - length, length), 0, []
    for _ in range(n):
        mark, method, stored, full = *struct.unpack_from("<I6xH8x", raw, at), *struct.unpack_from("<II", raw, at + 20)
        if mark != CENTRAL:
            raise ValueError("a damaged central directory")
        name_n, extra_n, comment_n = struct.unpack_from("<HHH", raw, at + 28)
        local = struct.unpack_from("<I", raw, at + 42)[0]
        name, extra = raw[at + 46 : at + 46 + name_n], raw[at + 46 + name_n : at + 46 + name_n + extra_n]
        while len(extra) >= 4:
            kind, long = struct.unpack_from("<HH", extra)
            if kind == 1:
                # Only fields that are full in the directory have a place here, in this order.
                values = iter(struct.unpack(f"<{long // 8}Q", extra[4 : 4 + long // 8 * 8]))
                full = next(values) if full == FULL32 else full
                stored = next(values) if stored == FULL32 else stored
                local = next(values) if local == FULL32 else local
            extra = extra[4 + long :]
        members.append((name.decode("utf-8", "replace"), method, local + moved, stored, full))
        at += 46 + name_n + extra_n + comment_n
    return members


def data_start(file, local: int) -> int:
    """Where a member's bytes begin: behind its local header, whose name and extra fields have lengths of their own."""
    head = ranged(file, local, 30)
    if struct.unpack_from("<I", head)[0] != LOCAL:
        raise ValueError("the directory leads to no member")
    return local + 30 + sum(struct.unpack_from("<HH", head, 26))


# ---- WARC records ---------------------------------------------------------------

_NAME = "urn:weftline:page:"
_IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(key: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers: int | None = None, revisit: bool = False) -> bytes:
    """A response with its payload, or a revisit, which has the answer's header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = lambda k: f"<{_NAME}{'' if k is None else k}>"
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(key)}", f"WARC-Date: {DATE}"]
    lines += [f"WARC-Target-URI: {quote(url, safe='%:/?#[]@!$&()*+,;=~' + chr(39))}"] if url is not None else []
    lines += [f"WARC-Refers-To: {name(refers)}", f"WARC-Profile: {_IDENTICAL}"] if revisit else []
    lines += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def parse(raw: bytes):
    """(id, url, type, payload or null, its bytes, its digest, id of what it refers to) of a record; null of other kinds of records."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("no WARC record")
    h = headers(head)
    if h.get("warc-type") not in ("response", "revisit"):
        return None
    block = rest[: int(h["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    named = lambda x: int(x.strip("<>").removeprefix(_NAME)) if x and x.strip("<>") != _NAME else None
    digest, key = h["warc-payload-digest"].removeprefix("sha256:"), named(h["warc-record-id"])
    if h["warc-type"] == "revisit":
        return key, h.get("warc-target-uri"), "revisit", None, int(headers(http)["content-length"]), digest, named(h["warc-refers-to"])
    if hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"record {h['warc-record-id']} does not fit its digest")
    return key, h.get("warc-target-uri"), "response", payload, len(payload), digest, None


# ---- writing --------------------------------------------------------------------


def _packages(folder: str, package: int, member: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.release()
        system, root = opened(folder)
        task = TaskContext.get()
        done, writer, stream, index, at, n, members, total = [], None, None, [], 0, 0, 0, 0

        def name() -> str:
            return f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{len(done):03d}.wacz"

        def end_member() -> None:
            nonlocal at, n, members
            if n:
                writer.end()
                members, at, n = members + 1, 0, 0

        def end_package() -> None:
            nonlocal writer, index, members, total
            if writer is None:
                return
            end_member()
            writer.begin("indexes/index.cdxj")
            for lo in range(0, len(index), 4096):
                writer.write("".join(index[lo : lo + 4096]).encode())
            writer.end()
            writer.begin("datapackage.json")
            writer.write(json.dumps({"profile": "data-package", "resources": [{"path": x[0].decode(), "bytes": x[3]} for x in writer.members]}).encode())
            writer.end()
            writer.close()
            stream.close()
            done.append((f"{folder}/{name()}", total, writer.at))
            writer, index, members, total = None, [], 0, 0

        for batch in batches:
            for key, url, payload, size, digest, refers, revisit in zip(*[batch.column(c).to_pylist() for c in ("key", "url", "payload", "n", "digest", "refers", "revisit")]):
                if writer is None:
                    system.create_dir(root, recursive=True)
                    stream = system.open_output_stream(f"{root}/{name()}", compression=None)
                    writer = PackageWriter(stream)
                if n == 0:
                    writer.begin(f"archive/data-{members:05d}.warc.gz")
                press = zlib.compressobj(6, zlib.DEFLATED, 31)
                raw = press.compress(record(key, url, payload, size, digest, refers, revisit)) + press.flush()
                writer.write(raw)
                index.append(f"{digest} {DATE} " + json.dumps({"type": "revisit" if revisit else "response", "filename": f"data-{members:05d}.warc.gz", "offset": at, "length": len(raw)}) + "\n")
                at, n, total = at + len(raw), n + 1, total + 1
                if at >= member or n >= RECORDS:
                    end_member()
                if writer.at >= package or len(index) >= 8 * RECORDS:
                    end_package()
        end_package()
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64()), pa.array([x[2] for x in done], pa.int64())], ["package", "records", "bytes"])

    return run


def write_archives(df: DataFrame, key: str, url: str, payload: str, folder: str, least: int = LEAST, package: int = PACKAGE, member: int = MEMBER) -> DataFrame:
    """Pack every row as a record; (package, records, bytes) of the packages."""
    text = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), F.encode(text, "utf-8").alias("payload")).withColumns({"n": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    groups = rows.where(F.col("n") >= least).groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("rows")).where("rows > 1")
    groups = written(groups, f"{folder}/groups")
    # A payload with over a HOT-th of the repeated rows is looked up in a table of fewer than HOT rows; others share a task with no more rows than that.
    repeated = groups.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    hot = groups.where(F.col("rows") > repeated / HOT).select("digest", F.col("first").alias("hot"), F.lit(True).alias("known"))
    rest = groups.where(F.col("rows") <= repeated / HOT).select(F.col("digest").alias("same"), "first")
    found = rows.join(F.broadcast(hot), "digest", "left")
    own = F.when(F.col("known"), F.concat_ws("-", F.lit("known"), F.xxhash64("key", "url"))).otherwise(F.col("digest"))
    met = found.withColumn("own", own).join(rest, F.col("own") == F.col("same"), "left")
    refers = F.coalesce("hot", "first")
    revisit = F.coalesce((F.col("n") >= least) & ~F.col("key").eqNullSafe(refers) & refers.isNotNull(), F.lit(False))
    made = met.select("key", "url", F.when(~revisit, F.col("payload")).alias("payload"), "n", "digest", F.when(revisit, refers).alias("refers"), revisit.alias("revisit"))
    return written(made.mapInArrow(_packages(f"{folder}/packages", package, member), "package string, records long, bytes long"), f"{folder}/manifest")


# ---- reading --------------------------------------------------------------------

_BLOCK = "package string, member string, start long, stop long, offsets binary"


def _blocks(span: int):
    """Blocks of neighbouring records of each package; offsets are where they begin behind ``start``, null if there is no index."""

    def of(package: str) -> Iterator[tuple]:
        system, path = opened(package)
        with system.open_input_file(path) as file:
            members, lines = directory(file, file.size()), {}
            archives = {}
            for name, method, local, stored, full in members:
                wanted = re.search(r"\.(warc|warc\.gz|cdxj?|cdxj?\.gz)$", name)
                if wanted and method != 0:
                    raise ValueError(f"{package}: {name} is compressed, so its records are no ranges of the package")
                if wanted and wanted[1].startswith("warc"):
                    archives[name.rpartition("/")[2]] = (name, data_start(file, local), stored)
                elif wanted:
                    raw = ranged(file, data_start(file, local), stored)
                    for line in (zlib.decompress(raw, 47) if wanted[1].endswith(".gz") else raw).splitlines():
                        at = line.find(b"{")
                        if at >= 0:
                            found = json.loads(line[at:])
                            lines.setdefault(found["filename"].rpartition("/")[2], {})[int(found["offset"])] = int(found["length"])
            for short, (name, start, size) in archives.items():
                if short not in lines:
                    yield package, name, start, start + size, None
                    continue
                own = sorted(lines[short].items())
                if own[-1][0] + own[-1][1] > size:
                    raise ValueError(f"{package}: the index goes beyond {name}")
                lo = 0
                for k in range(len(own)):
                    end = own[k][0] + own[k][1]
                    if k + 1 == len(own) or end - own[lo][0] >= span or own[k + 1][0] != end:
                        yield package, name, start + own[lo][0], start + end, np.array([o - own[lo][0] for o, _ in own[lo : k + 1]], "<i8").tobytes()
                        lo = k + 1

    def run(batches):
        for batch in batches:
            for package in batch.column("package").to_pylist():
                rows = list(of(package))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()))], ["package", "member", "start", "stop", "offsets"])

    return run


def inflated(read, start: int, stop: int, piece: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members between two places, one after the other, each inflated."""
    left, at = b"", start
    while at < stop or left:
        press, out = zlib.decompressobj(31), []
        while not press.eof:
            if not left:
                if at >= stop:
                    raise ValueError("an archive ends within a record")
                left = read(at, min(piece, stop - at))
                at += len(left)
            out.append(press.decompress(left))
            left = press.unused_data
        yield b"".join(out)


def plain(read, start: int, stop: int, piece: int = 1 << 20) -> Iterator[bytes]:
    """The records of an archive that is not compressed, by their lengths."""
    at = start
    while at < stop:
        n = min(piece, stop - at)
        while (cut := (head := read(at, n)).find(b"\r\n\r\n")) < 0:
            if n == stop - at:
                raise ValueError("an archive ends within a record's header")
            n = min(2 * n, stop - at)
        size = cut + 4 + int(headers(head[:cut])["content-length"])
        yield head[:size] if size <= len(head) else read(at, size)
        at += size + 4


def _records(bodies: bool):
    kinds = [("key", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()), ("n", pa.int64()), ("digest", pa.string()), ("refers", pa.int64())]

    def run(batches):
        for batch in batches:
            for package, member, start, stop, offsets in zip(*[batch.column(c).to_pylist() for c in ("package", "member", "start", "stop", "offsets")]):
                system, path = opened(package)
                with system.open_input_file(path) as file:
                    read = lambda a, n: ranged(file, a, n)  # noqa: B023, E731
                    if offsets is not None:
                        held, marks = read(start, stop - start), [*np.frombuffer(offsets, "<i8").tolist(), stop - start]
                        parts = (held[a:b] for a, b in zip(marks, marks[1:]))
                        raws = (zlib.decompress(x, 31) for x in parts) if member.endswith(".gz") else parts
                    else:
                        raws = (inflated if member.endswith(".gz") else plain)(read, start, stop)
                    rows, size = [], 0
                    for raw in raws:
                        if (row := parse(raw)) is not None:
                            rows.append(row if bodies else (*row[:3], None, *row[4:]))
                            size += len(row[3] or b"") if bodies else 0
                        if size > RANGE or len(rows) >= 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), kinds)], [k for k, _ in kinds])
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), kinds)], [k for k, _ in kinds])

    return run


def read_archives(packages: DataFrame, bodies: bool = True, span: int = RANGE) -> DataFrame:
    """(key, url, record_type, payload, n, digest, refers) of the responses and revisits in the packages that column ``package`` names."""
    n = int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = packages.select("package").repartition(n, "package").mapInArrow(_blocks(span), _BLOCK).repartition(n, "package", "start")
    return blocks.mapInArrow(_records(bodies), "key long, url string, record_type string, payload binary, n long, digest string, refers long")


def checked(records: DataFrame, folder: str) -> DataFrame:
    """The records, written; an error if a revisit's response is not among them with its digest and size."""
    records = written(records.drop("payload"), f"{folder}/records")
    asked = records.where("record_type = 'revisit'").select(F.col("refers").alias("key"), "digest", "n").distinct()
    lost = asked.join(records.where("record_type = 'response'"), ["key", "digest", "n"], "left_anti").first()
    if lost is not None:
        raise ValueError(f"no response {lost['key']} of digest {lost['digest']}, which a record revisits")
    return records


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark)
    packages = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id", "url", "html", folder)
    records = checked(read_archives(packages, bodies=False), folder)
    return records.select(F.col("key").alias("page_id"), F.col("n").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", F.col("refers").alias("refers_to"))


ORACLE_SQL = f"""WITH page AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS n, sha256(coalesce(html, '')) AS digest FROM pages),
  least AS (SELECT digest, min(page_id) AS first FROM page WHERE n >= {LEAST} GROUP BY digest)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM page LEFT JOIN least USING (digest)"""
