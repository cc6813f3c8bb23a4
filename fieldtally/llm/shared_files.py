"""Plain files in the cluster's shared folder, opened by tasks through pyarrow's file systems.

Inputs are always read by Spark. These helpers are for the library's own binary files, which lie below
``spark.checkpoint.dir`` (``file:``, ``hdfs:``, ``s3:`` and whatever else pyarrow knows). A task writes under a name that no
other attempt uses, and only the names that Spark's committed rows report are ever read, so a task that
is repeated or lost halfway leaves no trace in the result.
"""

from __future__ import annotations

import os
import uuid

from pyarrow import fs


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), os.path.abspath(uri)
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def create(folder: str, suffix: str):
    """(uri, open output stream) of a new file."""
    system, path = resolve(folder)
    system.create_dir(path, recursive=True)
    name = f"{uuid.uuid4().hex}{suffix}"
    return f"{folder.rstrip('/')}/{name}", system.open_output_stream(f"{path}/{name}", compression=None)


def open_file(uri: str):
    """A seekable input file."""
    system, path = resolve(uri)
    return system.open_input_file(path)
