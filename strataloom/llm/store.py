"""Files in the shared folder, and the store's tables (see ``strataloom.store``)."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa

from ..store import drop, filesystem, free_shuffles, materialize, scope, shared_base, shared_dir

__all__ = ["drop", "filesystem", "free_shuffles", "materialize", "read_file", "scope", "shared_base", "shared_dir", "write_file"]


def write_file(uri: str, chunks: Iterator[bytes]) -> int:
    """Write a file under a temporary name and move it in place; returns its size."""
    fs, path = filesystem(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    part, size = f"{path}.{uuid.uuid4().hex}.tmp", 0
    with fs.open_output_stream(part) as out:
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    fs.move(part, path)
    return size


def read_file(uri: str) -> pa.Buffer:
    fs, path = filesystem(uri)
    with fs.open_input_file(path) as f:
        return f.read_buffer()
