"""Files of one job in the shared folder: written whole by tasks, mapped by others.

On a folder that is mounted everywhere (``file:`` or a plain path) a file is
mapped where it lies.  On another store it is fetched once by each Python worker
into an unnamed temporary file and mapped there.
"""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np


def local_path(folder: str) -> str | None:
    if folder.startswith("file:"):
        return "/" + folder[len("file:"):].lstrip("/")
    return folder if "://" not in folder else None


def _store(folder: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(folder)


def put(folder: str, name: str, array: np.ndarray) -> None:
    """Write an array; a repeated task replaces it by the same bytes."""
    here = local_path(folder)
    raw = np.ascontiguousarray(array)
    if here:
        os.makedirs(here, exist_ok=True)
        part = os.path.join(here, f".{name}.{uuid.uuid4().hex}")
        raw.tofile(part)
        os.replace(part, os.path.join(here, name))
        return
    fs, at = _store(folder)
    part = f"{at}/.{name}.{uuid.uuid4().hex}"
    fs.create_dir(at, recursive=True)
    with fs.open_output_stream(part) as f:
        f.write(raw.tobytes())
    fs.move(part, f"{at}/{name}")


def mapped(folder: str, name: str, dtype) -> np.ndarray:
    """The array of a file, memory-mapped read-only."""
    here = local_path(folder)
    if here:
        path = os.path.join(here, name)
        return np.memmap(path, dtype, mode="r") if os.path.getsize(path) else np.empty(0, dtype)
    fs, at = _store(folder)
    with fs.open_input_stream(f"{at}/{name}") as f, tempfile.TemporaryFile() as copy:
        while block := f.read(1 << 22):
            copy.write(block)
        copy.flush()
        return np.memmap(copy, dtype, mode="r") if copy.tell() else np.empty(0, dtype)
