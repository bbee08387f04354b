"""Named flat arrays in one file: mapped into memory where the file is on a mount, else read whole."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np

from .common import local_path, open_input

ALIGN = 64


def dump(arrays: dict[str, np.ndarray]) -> Iterator[bytes]:
    """A file's bytes: length of the head, head (name -> type, place, length), then the arrays, aligned."""
    head, at = {}, 0
    for name, a in arrays.items():
        head[name] = (a.dtype.str, at, len(a))
        at += -(-a.nbytes // ALIGN) * ALIGN
    text = json.dumps(head).encode()
    text = text.ljust(-(-(len(text) + 8) // ALIGN) * ALIGN - 8)
    yield struct.pack("<Q", len(text)) + text
    for a in arrays.values():
        yield a.tobytes() + bytes(-a.nbytes % ALIGN)


def load(uri: str) -> dict[str, np.ndarray]:
    path = local_path(uri)
    if path is not None:
        data = np.memmap(path, np.uint8, "r")
    else:
        with open_input(uri) as f:
            data = np.frombuffer(f.read(), np.uint8)
    n = 8 + int(data[:8].view("<u8")[0])
    head = json.loads(data[8:n].tobytes())
    return {name: data[n + at : n + at + size * np.dtype(kind).itemsize].view(kind) for name, (kind, at, size) in head.items()}
