"""Files that tasks write to and read from the shared scratch folder, on any store that pyarrow can open.

A task writes under a name of its own attempt; which files count is in the rows it returns, and Spark keeps those of one
attempt only. So a repeated or lost task leaves at most files that nobody reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return fs.LocalFileSystem(), path


def attempt_path(folder: str, ending: str) -> str:
    return f"{folder}/{uuid.uuid4().hex}{ending}"


def output(path: str):
    """A stream for writing; folders above it are made."""
    store, inside = opened(path)
    store.create_dir(inside.rpartition("/")[0], recursive=True)
    return store.open_output_stream(inside, compression=None)


def chunks(path: str, size: int = 1 << 20) -> Iterator[bytes]:
    """The file from start to end, a chunk at a time."""
    store, inside = opened(path)
    with store.open_input_stream(inside, compression=None) as stream:
        while chunk := stream.read(size):
            yield bytes(chunk)


def random_access(path: str):
    store, inside = opened(path)
    return store.open_input_file(inside)
