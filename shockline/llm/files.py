"""Files in any store that pyarrow reaches (file, hdfs, s3, gs ...), for binary formats Spark has no writer for."""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def make_folder(uri: str) -> None:
    store, path = opened(uri)
    store.create_dir(path, recursive=True)


def put(uri: str, data: bytes) -> None:
    """Write whole, under another name first: a task that is lost or runs twice leaves no partial file."""
    store, path = opened(uri)
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(part, compression=None) as f:
        f.write(data)
    store.move(part, path)


def read_range(uri: str, start: int = 0, length: int | None = None) -> bytes:
    store, path = opened(uri)
    with store.open_input_file(path) as f:
        size = f.size()
        if start >= size:
            return b""
        return f.read_at(min(size - start, size if length is None else length), start)
