"""Binary files in the shared folder, written and read by executors through pyarrow's file systems."""

from __future__ import annotations

import re

from pyarrow import fs
from pyspark import TaskContext


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or an absolute path, and the path in it."""
    uri = re.sub(r"^file:/+", "file:///", uri)
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def attempt_name(prefix: str, suffix: str) -> str:
    """A file name that no other task or attempt uses; what a lost attempt leaves is never referred to."""
    task = TaskContext.get()
    part, attempt = (task.partitionId(), task.taskAttemptId()) if task else (0, 0)
    return f"{prefix}-{part:06d}-{attempt}{suffix}"


def make_dir(uri: str) -> None:
    where, path = filesystem(uri)
    where.create_dir(path, recursive=True)


def coalesced(spans, gap: int, most: int):
    """Lists of neighbouring (offset, length, tag) spans, sorted by offset, that one read covers."""
    group: list = []
    begin = end = 0
    for span in spans:
        if group and (span[0] - end > gap or span[0] + span[1] - begin > most):
            yield begin, end, group
            group = []
        if not group:
            begin = end = span[0]
        group.append(span)
        end = max(end, span[0] + span[1])
    if group:
        yield begin, end, group
