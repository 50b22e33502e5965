"""Arrays in files of the shared folder, memory-mapped by workers.

A path without a scheme or with ``file:`` is mapped where it lies. Other stores are read
through `pyarrow.fs` into an unnamed temporary file of the worker and mapped from there.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid

import numpy as np
import zstandard
from pyarrow import fs

_MAPPED: dict[str, np.ndarray] = {}


def _local(uri: str) -> str | None:
    if uri.startswith("file:"):
        return "/" + uri[len("file:"):].lstrip("/")
    return uri if "://" not in uri else None


def put(uri: str, array: np.ndarray) -> None:
    """Write an array; a retried task replaces the file by an equal one in one step."""
    path, half = _local(uri), f"{uri}.{uuid.uuid4().hex}"
    if path is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        array.tofile(_local(half))
        os.replace(_local(half), path)
        return
    store, name = fs.FileSystem.from_uri(half)
    with store.open_output_stream(name) as out:
        out.write(np.ascontiguousarray(array).tobytes())
    store.move(name, fs.FileSystem.from_uri(uri)[1])


def mapped(uri: str, dtype) -> np.ndarray:
    """The array in a file, mapped read-only and kept for the worker's life."""
    got = _MAPPED.get(uri)
    if got is None:
        path = _local(uri)
        if path is not None:
            got = np.memmap(path, dtype=dtype, mode="r") if os.path.getsize(path) else np.zeros(0, dtype)
        else:
            store, name = fs.FileSystem.from_uri(uri)
            copy = tempfile.TemporaryFile()
            with store.open_input_stream(name) as src:
                while part := src.read(1 << 24):
                    copy.write(part)
            copy.flush()
            got = np.memmap(copy, dtype=dtype, mode="r") if copy.tell() else np.zeros(0, dtype)
        _MAPPED[uri] = got
    return got


def pack(values: np.ndarray, ascending: bool = False) -> bytes:
    """Integers as compressed byte planes; of ascending ones, the steps."""
    v = values.astype(np.uint64)
    if ascending and len(v):
        v = np.concatenate([v[:1], v[1:] - v[:-1]])
    planes = np.ascontiguousarray(v.view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes, ascending: bool = False) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(blob)).read()
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(8, -1)
    v = np.ascontiguousarray(planes.T).reshape(-1).view(np.uint64)
    return np.cumsum(v, dtype=np.uint64) if ascending else v
