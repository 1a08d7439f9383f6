"""Versioned folders: overwriting without renaming or deleting what readers use.

A rename is a copy on object stores, and a copy can be killed half way.  Here
every write is a new folder below the target, put there by Spark's own commit
protocol, and becomes the current one by a single empty file::

    target/v-3f2a.../part-...            a version
    target/_versions/0000000002.v-3f2a... its commit: number and folder

The commit's name says all, so it is there as a whole or not at all on any
file system.  Readers take the version of the last commit (``current``); a
folder without commits is read as it is.  A writer that dies leaves at most a
folder that no commit names: the version before stays what readers get.
Spark passes over ``_versions`` itself.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from tessera.sources.staging import _fs

COMMITS = "_versions"
PREFIX = "v-"


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (none where it does not exist)."""
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _under(path: str, *names: str) -> str:
    return "/".join([path.rstrip("/"), *names])


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def history(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, folder name) of the committed versions, oldest first.

    Writers that commit at the same moment may get one number; the names order them.
    """
    marks = [n.split(".", 1) for n in _names(spark, _under(path, COMMITS)) if n[:1].isdigit()]
    return sorted((int(number), folder) for number, folder in marks)


def current(spark: SparkSession, path: str, version: int | None = None) -> str:
    """The folder to read: that of the last commit, or of commit number ``version``.

    A folder without commits, a file and a pattern are returned as they are.
    """
    versions = history(spark, path)
    if version is not None:
        versions = [v for v in versions if v[0] == version]
        if not versions:
            raise ValueError(f"{path} has no version {version}")
    return _under(path, versions[-1][1]) if versions else path


def commit(spark: SparkSession, path: str, folder: str) -> int:
    """Make ``folder`` (below ``path``) the current version; returns its number."""
    number = max((n for n, _ in history(spark, path)), default=0) + 1
    fs, p = _fs(spark, _under(path, COMMITS, f"{number:010d}.{folder}"))
    fs.create(p, False).close()
    return number


def versioned_write(df: DataFrame, path: str, write: Callable[[DataFrameWriter, str], None],
                    keep: int = 2) -> str:
    """Run ``write(df.write, folder)`` into a new version of ``path`` and commit it.

    ``df`` may read from ``path``.  The last ``keep`` versions stay, so that
    readers that began before the commit finish; older ones go (``prune``).
    """
    spark = df.sparkSession
    fs, p = _fs(spark, path)
    if fs.exists(p) and not fs.getFileStatus(p).isDirectory():
        raise ValueError(f"{path} is a file: versions need a folder")
    folder = f"{PREFIX}{uuid.uuid4().hex}"
    write(df.write.mode("errorifexists"), _under(path, folder))
    commit(spark, path, folder)
    prune(spark, path, keep)
    return path


def prune(spark: SparkSession, path: str, keep: int = 2, abandoned_hours: float | None = None) -> None:
    """Delete all but the last ``keep`` versions (one at least stays).

    A version's commit goes before its data.  Files that lay in the folder
    before its first commit count as the version before it.  With
    ``abandoned_hours``, folders of writers that never committed and that are
    older than this go too (a writer may take as long as that).
    """
    versions, keep = history(spark, path), max(keep, 1)
    for number, folder in versions[:-keep]:
        _delete(spark, _under(path, COMMITS, f"{number:010d}.{folder}"))
        _delete(spark, _under(path, folder))
    if len(versions) >= keep:
        for name in _names(spark, path):
            if name != COMMITS and not name.startswith(PREFIX):
                _delete(spark, _under(path, name))
    if abandoned_hours is not None:
        fs, p = _fs(spark, path)
        named = {folder for _, folder in history(spark, path)}
        oldest = (time.time() - 3600 * abandoned_hours) * 1000
        for status in fs.listStatus(p):
            name = status.getPath().getName()
            if name.startswith(PREFIX) and name not in named and status.getModificationTime() <= oldest:
                fs.delete(status.getPath(), True)
