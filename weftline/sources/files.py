"""Files on any file system that pyarrow opens by a URI, read and written by tasks."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa


def opened(uri: str):
    """(file system, path). Paths are taken as they are, with blanks and signs that a URI would escape, as listings give them."""
    from pyarrow import fs

    parts = re.match(r"^(\w[\w+.-]*):(?://([^/]*))?(/.*)?$", uri)
    if parts is None or parts[1] == "file":
        return fs.LocalFileSystem(), uri if parts is None else parts[3]
    system, root = fs.FileSystem.from_uri(f"{re.sub('^s3[an]$', 's3', parts[1])}://{parts[2] or ''}")
    return system, root.rstrip("/") + (parts[3] or "")


def opens(uri: str) -> bool:
    """Whether pyarrow knows the file system of a URI; there are stores that only Spark reads."""
    try:
        opened(uri)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def below(uri: str, suffix: str = "") -> list[str]:
    """The files below a folder in the order of their names, as URIs of the same kind; none if there is no such folder."""
    from pyarrow import fs

    system, path = opened(uri)
    found = system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
    names = sorted(x.path for x in found if x.type == fs.FileType.File and x.path.endswith(suffix))
    root = uri.rstrip("/")
    return [root + name[len(path.rstrip("/")) :] for name in names]


#: What a whole file's name ends with, also where it is a folder with the file's parts, as Spark writes them.
ENDINGS = r"^.*?\.(?:parquet|jsonl|json|txt)(?=/)"


def whole(uri: str, root: str = "") -> str:
    """The file that one below ``root`` is: itself, or the folder of a file's name that holds it as a part."""
    root = root.rstrip("/")
    found = re.match(ENDINGS, uri[len(root) :])
    return root + found[0] if found else uri


def exists(uri: str) -> bool:
    from pyarrow import fs

    system, path = opened(uri)
    return system.get_file_info(path).type != fs.FileType.NotFound


def put(uri: str, data: bytes) -> None:
    """A whole file or none: written under another name first."""
    system, path = opened(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(path + ".tmp", compression=None) as f:
        f.write(data)
    system.move(path + ".tmp", path)


def get(uri: str) -> bytes:
    system, path = opened(uri)
    with system.open_input_stream(path, compression=None) as f:
        return f.read()


def digests(piece: int = 1 << 20):
    """For ``mapInArrow``: (path, bytes, sha256) of the files that column ``path`` names, read in pieces, so that a file of any size takes the memory of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                system, path = opened(uri)
                digest, size = hashlib.sha256(), 0
                with system.open_input_stream(path, compression=None) as f:
                    while data := f.read(piece):
                        digest.update(data)
                        size += len(data)
                yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([size], pa.int64()), pa.array([digest.hexdigest()])], ["path", "bytes", "sha256"])

    return run


def text_digests(piece: int = 1 << 20):
    """For ``mapInArrow``: (path, bytes, chars, sha256) of texts whose files are ``parts``, one after the other, read in pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for uri, parts in zip(batch.column("path").to_pylist(), batch.column("parts").to_pylist()):
                digest, size, chars = hashlib.sha256(), 0, 0
                for part in parts:
                    system, path = opened(part)
                    with system.open_input_stream(path, compression=None) as f:
                        while data := f.read(piece):
                            digest.update(data)
                            size += len(data)
                            # Bytes of UTF-8 that begin a character.
                            chars += int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))
                yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([size], pa.int64()), pa.array([chars], pa.int64()), pa.array([digest.hexdigest()])], ["path", "bytes", "chars", "sha256"])

    return run


def copies(piece: int = 1 << 20):
    """For ``mapInArrow``: copy the files of column ``path`` to those of ``to``, each under another name until it is whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, to in zip(batch.column("path").to_pylist(), batch.column("to").to_pylist()):
                (source, path), (target, where), size = opened(uri), opened(to), 0
                target.create_dir(where.rpartition("/")[0], recursive=True)
                # Attempts of one task may run side by side.
                part = f"{where}.{uuid.uuid4().hex}.tmp"
                with source.open_input_stream(path, compression=None) as f, target.open_output_stream(part, compression=None) as out:
                    while data := f.read(piece):
                        out.write(data)
                        size += len(data)
                target.move(part, where)
                yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([to]), pa.array([size], pa.int64())], ["path", "to", "bytes"])

    return run


def renamed(folder: str, target: str, old: str, new: str) -> list[str]:
    """Move files with one ending to the same places below another folder, with another ending."""
    made = []
    for uri in below(folder, old):
        to = target.rstrip("/") + uri.removeprefix(folder.rstrip("/")).removesuffix(old) + new
        system, path = opened(to)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        system.move(opened(uri)[1], path)
        made.append(to)
    return made
