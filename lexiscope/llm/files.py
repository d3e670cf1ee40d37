"""Files in the shared folder, for tasks that write or read byte ranges.

A task writes to a name of its own and reports that name in its rows, so a task that runs again, or
twice at a time, never touches files that rows of another attempt point to.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI, or of a local path, and the path in it."""
    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def new_file(uri: str, suffix: str) -> tuple[fs.FileSystem, str]:
    files, path = open_folder(uri)
    files.create_dir(path, recursive=True)
    return files, f"{path}/{uuid.uuid4().hex}{suffix}"
