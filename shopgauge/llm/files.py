"""Files that tasks write to and read from the folder that all executors share."""

from __future__ import annotations

import os
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file named by URI or absolute path."""
    if uri.startswith("file:"):
        uri = "/" + uri[len("file:"):].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def _task() -> tuple[int, int]:
    from pyspark import TaskContext

    task = TaskContext.get()
    return (task.partitionId(), task.taskAttemptId()) if task else (0, 0)


def partition_id() -> int:
    return _task()[0]


@contextmanager
def written(uri: str):
    """A file opened for writing under a name of this attempt, renamed when complete.

    A second attempt of the same task writes the same bytes and replaces the file as a whole, so a
    reader never sees half of one.
    """
    store, path = resolve(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    own = f"{path}.attempt-{_task()[1]}"
    out = store.open_output_stream(own, compression=None)
    try:
        yield out
    except BaseException:
        out.close()
        store.delete_file(own)
        raise
    out.close()
    store.move(own, path)


def opened(uri: str) -> pa.NativeFile:
    """Random access to a file; memory-mapped if it is on a local or mounted file system."""
    store, path = resolve(uri)
    if isinstance(store, fs.LocalFileSystem):
        return pa.memory_map(path) if os.path.getsize(path) else pa.BufferReader(b"")
    return store.open_input_file(path)
