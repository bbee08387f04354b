"""Small files in a folder that all machines see: written in one step, read whole, listed, removed."""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse


def opened(uri: str):
    """(file system, path) of a URI or plain path."""
    from pyarrow import fs

    u = urlparse(uri)
    return (fs.LocalFileSystem(), u.path) if u.scheme in ("", "file") else fs.FileSystem.from_uri(uri)


def put(uri: str, data: bytes, new: bool = False) -> None:
    """The file appears whole or not at all; with `new`, FileExistsError where it is there already."""
    store, path = opened(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    beside = f"{path}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(beside) as f:
        f.write(data)
    if new and store.type_name == "local":
        try:
            os.link(beside, path)  # fails where the name is taken, also between two writers
        finally:
            os.unlink(beside)
        return
    if new and exists(uri):
        store.delete_file(beside)
        raise FileExistsError(uri)
    store.move(beside, path)


def get(uri: str) -> bytes:
    store, path = opened(uri)
    with store.open_input_stream(path) as f:
        return f.read()


def exists(uri: str) -> bool:
    from pyarrow import fs

    store, path = opened(uri)
    return store.get_file_info(path).type != fs.FileType.NotFound


def names(uri: str) -> list[str]:
    """Names of the files in a folder, sorted; none where it isn't there."""
    from pyarrow import fs

    store, path = opened(uri)
    found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == fs.FileType.File and not f.base_name.endswith(".tmp"))


def remove(uri: str) -> None:
    store, path = opened(uri)
    if exists(uri):
        store.delete_file(path)
