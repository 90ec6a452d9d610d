"""Files that tasks write to and read from the shared folder themselves."""

from __future__ import annotations

import mmap
import os
import tempfile
import uuid

import pyarrow.fs as pafs

from .common import local_path


def put(path: str, data: list[bytes]) -> None:
    """Write a file whole: under another name first, then renamed, so that a task that runs again does no harm."""
    aside = f"{path}.{uuid.uuid4().hex[:8]}.tmp"
    if local := local_path(path):
        aside = local_path(aside)
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(aside, "wb") as f:
            f.writelines(data)
        os.replace(aside, local)
        return
    fs, target = pafs.FileSystem.from_uri(path)
    other = f"{target}.{aside.rsplit('.', 2)[1]}.tmp"
    with fs.open_output_stream(other) as f:
        for part in data:
            f.write(part)
    fs.move(other, target)


def remove(path: str) -> None:
    """Delete a file that nothing reads any more."""
    if local := local_path(path):
        os.remove(local)
        return
    fs, target = pafs.FileSystem.from_uri(path)
    fs.delete_file(target)


def mapped(path: str) -> mmap.mmap:
    """A read-only memory map. Where the folder is no plain path, of a local copy that goes with the map."""
    if local := local_path(path):
        with open(local, "rb") as f:
            return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    fs, source = pafs.FileSystem.from_uri(path)
    with tempfile.TemporaryFile() as f, fs.open_input_stream(source) as remote:
        while part := remote.read(1 << 22):
            f.write(part)
        f.flush()
        return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
