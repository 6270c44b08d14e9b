"""Files in the shared folder, read and written inside tasks through pyarrow's file systems."""

from __future__ import annotations

import uuid

from pyarrow import fs as arrow_fs


def open_store(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a folder or file named by a URI or an absolute path, and its path there."""
    return arrow_fs.FileSystem.from_uri(uri)


def attempt_name(folder: str, stem: str) -> str:
    """A path no other task attempt writes: of repeated attempts only the one that Spark counts is listed later."""
    return f"{folder.rstrip('/')}/{stem}-{uuid.uuid4().hex}"


def read_range(uri: str, start: int, end: int) -> bytes:
    """Bytes [start, end) of a file."""
    fs, path = open_store(uri)
    with fs.open_input_file(path) as f:
        return f.read_at(end - start, start)
