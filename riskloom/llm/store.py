"""Files that tasks write themselves: one per task attempt, below a folder all executors share.

A task writes under a name of its own attempt and returns that name in its
rows; only names in the rows of successful attempts are read, so a retried
or duplicated task leaves at most an unread file.
"""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs


def _at(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def attempt_uri(folder: str, stem: str, ending: str) -> str:
    return f"{folder.rstrip('/')}/{stem}-{uuid.uuid4().hex[:16]}{ending}"


def create(uri: str):
    """Output stream; missing parent folders are made."""
    fs, path = _at(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    return fs.open_output_stream(path, compression=None)


def random_access(uri: str):
    fs, path = _at(uri)
    return fs.open_input_file(path)


def mapped(uri: str):
    """Memory map where the store is a local or mounted folder, else a random-access file."""
    fs, path = _at(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        import pyarrow as pa
        return pa.memory_map(path)
    return fs.open_input_file(path)
