"""Sorted arrays of a job, written in shards and read from a fixed number of files.

Tasks write one file a shard (``shared_files.put``), shards being ranges of a key.
``join`` puts those of neighbouring shards one behind the other into ``FILES`` files
for each array, block by block, so a reader needs a few maps however large the
array is, and finds sorted keys by one search a file.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

from tidewatch.llm import shared_files as files

#: Files of one array; bytes copied at a time.
FILES, COPY = 16, 4 << 20


def file_of(shard, shards: int):
    """The file that a shard's part goes to: rising with the shard."""
    return shard * FILES // shards


def _shards_of(k: int, shards: int) -> range:
    return range(-(-k * shards // FILES), -(-(k + 1) * shards // FILES))


def _blocks(folder: str, name: str):
    here = files.local_path(folder)
    if here:
        with open(os.path.join(here, name), "rb") as f:
            while block := f.read(COPY):
                yield block
        return
    fs, at = files._store(folder)
    with fs.open_input_stream(f"{at}/{name}") as f:
        while block := f.read(COPY):
            yield block


def _there(folder: str, name: str) -> bool:
    here = files.local_path(folder)
    if here:
        return os.path.exists(os.path.join(here, name))
    fs, at = files._store(folder)
    return fs.get_file_info(f"{at}/{name}").type.name == "File"


def _drop(folder: str, name: str) -> None:
    here = files.local_path(folder)
    if here:
        os.remove(os.path.join(here, name))
    else:
        fs, at = files._store(folder)
        fs.delete_file(f"{at}/{name}")


def _size(folder: str, name: str) -> int:
    here = files.local_path(folder)
    if here:
        return os.path.getsize(os.path.join(here, name))
    fs, at = files._store(folder)
    return fs.get_file_info(f"{at}/{name}").size


def _joined(folder: str, name: str, k: int, shards: int) -> int:
    """Write file ``k`` of an array, whole and once; its bytes."""
    target, parts = f"{name}.{k}", [f"{name}-{s}" for s in _shards_of(k, shards)]
    if not _there(folder, target):
        here, part = files.local_path(folder), f".{target}.{uuid.uuid4().hex}"
        if here:
            os.makedirs(here, exist_ok=True)
            out = open(os.path.join(here, part), "wb")
        else:
            fs, at = files._store(folder)
            fs.create_dir(at, recursive=True)
            out = fs.open_output_stream(f"{at}/{part}")
        with out:
            for p in parts:
                if _there(folder, p):   # a shard without rows may have no file
                    for block in _blocks(folder, p):
                        out.write(block)
        if here:
            os.replace(os.path.join(here, part), os.path.join(here, target))
        else:
            fs.move(f"{at}/{part}", f"{at}/{target}")
    for p in parts:   # a task that is tried again finds the file and only ends this
        if _there(folder, p):
            _drop(folder, p)
    return _size(folder, target)


def join(spark: SparkSession, folder: str, name: str, shards: int) -> list[int]:
    """Join the shards' files of an array; the bytes of each file."""
    def run(batches):
        for b in batches:
            for k in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([_joined(folder, name, k, shards)])], names=["file", "size"])

    made = spark.range(0, FILES, 1, FILES).mapInArrow(run, "file long, size long").collect()   # a row a file
    return [size for _, size in sorted(tuple(r) for r in made)]


class Arrays:
    """Joined arrays that run in step: ``names`` with their types, the first one sorted."""

    def __init__(self, folder: str, names: dict[str, object], shards: int, width: dict[str, int] | None = None):
        self.folder, self.names, self.shards, self.width = folder, names, shards, width or {}
        self.held: dict[int, list[np.ndarray]] = {}

    def file(self, k: int) -> list[np.ndarray]:
        if k not in self.held:   # mapped when it is first asked for
            self.held[k] = [a.reshape(-1, self.width[n]) if n in self.width else a
                            for n, a in ((n, files.mapped(self.folder, f"{n}.{k}", t)) for n, t in self.names.items())]
        return self.held[k]

    def parts(self, shard: np.ndarray):
        """``(file number, first, behind the last)`` of the runs of rising shards that lie in one file."""
        of = file_of(shard, self.shards)
        cut = np.searchsorted(of, np.arange(FILES + 1))
        for k in np.flatnonzero(np.diff(cut)).tolist():
            yield k, int(cut[k]), int(cut[k + 1])
