"""Folders that are replaced as a whole or not at all.

A result is written to a hidden folder beside its target.  Only when it is
complete and accepted does it take the target's place: the earlier folder steps aside
by a rename, the new one steps in by another, and then the earlier one is removed.
Whatever fails before, in a task, on the driver or in the check, leaves the earlier
result as it was.

Between the two renames the target does not exist.  A driver that ends just there
leaves the earlier folder under its hidden name; the next write, or ``settle``, puts
it back.  Stores whose renames are copies are as safe but slower.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


class _Folder:
    """A target and the hidden names beside it."""

    def __init__(self, spark: SparkSession, path: str):
        context = spark.sparkContext
        self._new = context._jvm.org.apache.hadoop.fs.Path
        given = self._new(path)
        self.files = given.getFileSystem(context._jsc.hadoopConfiguration())
        self.target = self.files.makeQualified(given)
        self.parent, self.name = self.target.getParent(), self.target.getName()
        if self.parent is None:
            raise ValueError(f"{path} cannot be replaced")

    def beside(self, kind: str, mark: str):
        return self._new(self.parent, f".{self.name}.{kind}-{mark}")

    def replaced(self) -> list:
        """Earlier results that have stepped aside."""
        if not self.files.exists(self.parent):
            return []
        start = f".{self.name}.before-"
        found = [s for s in self.files.listStatus(self.parent) if s.getPath().getName().startswith(start)]
        return [s.getPath() for s in sorted(found, key=lambda s: (s.getModificationTime(), s.getPath().getName()))]

    def rename(self, source, target) -> None:
        if not self.files.rename(source, target):
            raise OSError(f"cannot rename {source} to {target}")


def settle(spark: SparkSession, path: str) -> None:
    """Puts an earlier result back if a write ended between its two renames; else removes what such a write left."""
    folder = _Folder(spark, path)
    aside = folder.replaced()
    if aside and not folder.files.exists(folder.target):
        folder.rename(aside.pop(), folder.target)
    for left in aside:
        folder.files.delete(left, True)


@contextmanager
def staged(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder to write to, which takes the place of ``path`` if the block ends well.

    One writer at a time; a second one that ends later replaces the first one's result.
    """
    settle(spark, path)
    folder = _Folder(spark, path)
    mark = uuid.uuid4().hex
    stage, before = folder.beside("staged", mark), folder.beside("before", mark)
    try:
        yield stage.toString()
        if not folder.files.exists(stage):
            raise OSError(f"nothing was written for {path}")
        had = folder.files.exists(folder.target)
        if had:
            folder.rename(folder.target, before)
        try:
            folder.rename(stage, folder.target)
        except BaseException:
            if had:
                folder.rename(before, folder.target)
            raise
        folder.files.delete(before, True)
    finally:
        folder.files.delete(stage, True)
