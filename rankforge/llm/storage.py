"""Files that tasks write beside Spark's own formats, in the folder that the cluster shares.

A task writes each file under a name of its own and reports it in a row. That row counts only if the task
succeeds, so files of lost or repeated attempts are never read.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """(file system, path) of a folder named by a path or URI that pyarrow can reach."""
    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


def own_name(part: int, ending: str) -> str:
    return f"part-{part:06d}-{uuid.uuid4().hex}.{ending}"
