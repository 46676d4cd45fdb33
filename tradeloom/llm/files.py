"""Binary files below the shared folder, written whole or not at all.

Paths are those of ``spark.checkpoint.dir``: any scheme that Arrow's file systems know,
or a plain path. A task writes under a name of its own and renames, so a repeated or
speculative attempt never leaves half a file under the final name.
"""

from __future__ import annotations

import mmap
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow.fs as pafs


def locate(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def write_whole(path: str, write: Callable[[object], None]) -> None:
    fs, name = locate(path)
    fs.create_dir(name.rsplit("/", 1)[0], recursive=True)
    own = f"{name}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(own, compression=None) as out:
        write(out)
    fs.move(own, name)


def mapped(path: str, dtype: str) -> np.ndarray:
    """The file as an array: memory-mapped if it is local, else read."""
    fs, name = locate(path)
    kind = np.dtype(dtype)
    if isinstance(fs, pafs.LocalFileSystem):
        with open(name, "rb") as f:
            f.seek(0, 2)
            if not f.tell():
                return np.empty(0, kind)
            return np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), kind)
    with fs.open_input_file(name) as f:
        return np.frombuffer(f.read(), kind)
