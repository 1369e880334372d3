"""Files that tasks write and read themselves, in any store pyarrow can open.

A task writes under a name of its own attempt and reports it in a manifest row.
Only files of the manifest count, so a lost executor or a second attempt leaves
at most an unused file behind.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; a plain path is local."""
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri.removeprefix("file:")


def attempt_name(folder: str, part: int, suffix: str) -> str:
    return f"{folder.rstrip('/')}/part-{part:06d}-{uuid.uuid4().hex}{suffix}"


def create(uri: str):
    """An output stream; folders are made as needed."""
    store, path = opened(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    return store.open_output_stream(path, compression=None)


def read(uri: str):
    """A seekable input file."""
    store, path = opened(uri)
    return store.open_input_file(path)
