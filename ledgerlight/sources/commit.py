"""Tables and models are replaced as a whole: readers see the old one or the new one.

A write goes to a folder beside the target. When it is complete, the folder is renamed to say so; then the old target
steps aside and the new one takes its name. What a crash leaves behind tells how far the write had come, and the
next reader or writer brings it to its end: a complete new version goes into place, an incomplete one never does.
Names begin with a dot, so that a listing of the parent folder does not show them. All calls go through the Hadoop file
system of the path. Renames are atomic on HDFS and local disks; an object store copies, so there a reader may find
the target missing for a moment, but never mixed or half written.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

ATTEMPTS = 5
PART, READY, OLD = "part", "ready", "old"


class Place:
    """A target path and the versions beside it."""

    def __init__(self, spark: SparkSession, path: str):
        self.java, self.gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self.settings = spark.sparkContext._jsc.hadoopConfiguration()
        given = self.java.org.apache.hadoop.fs.Path(path.rstrip("/"))
        self.files = given.getFileSystem(self.settings)
        self.target = self.files.makeQualified(given)
        self.parent, self.name = self.target.getParent(), self.target.getName()

    def beside(self, version: str, state: str):
        return self.java.org.apache.hadoop.fs.Path(self.parent, f".{self.name}.{version}.{state}")

    def versions(self, state: str) -> list[str]:
        """Ids of the versions in that state, the latest last."""
        pattern = self.java.org.apache.hadoop.fs.Path(self.parent, f".{escaped(self.name)}.*.{state}")
        found = self.files.globStatus(pattern) or []
        by_time = sorted((s.getModificationTime(), s.getPath().getName()) for s in found)
        return [name[len(self.name) + 2 : -len(state) - 1] for _, name in by_time]

    def exists(self, path=None) -> bool:
        return self.files.exists(path or self.target)

    def move(self, source, target) -> None:
        """Rename, and fail where the target exists: a plain rename would move the source into it."""
        context = self.java.org.apache.hadoop.fs.FileContext.getFileContext(self.parent.toUri(), self.settings)
        kinds = getattr(self.java.org.apache.hadoop.fs, "Options$Rename")
        context.rename(source, target, self.gateway.new_array(kinds, 0))

    def drop(self, path) -> None:
        self.files.delete(path, True)

    def commit(self, version: str) -> None:
        """Put a complete version in the target's place."""
        ready, old = self.beside(version, READY), self.beside(version, OLD)
        for attempt in range(1, ATTEMPTS + 1):
            if not self.exists(ready):
                break  # a reader has put it in place
            try:
                if self.exists():
                    self.drop(old)
                    self.move(self.target, old)
                self.move(ready, self.target)
                break
            except Py4JJavaError:
                # another writer or a reader was faster
                if attempt == ATTEMPTS and self.exists(ready):
                    if self.exists(old) and not self.exists():
                        self.move(old, self.target)
                    raise
        self.drop(old)

    def settle(self) -> None:
        """Bring a write that broke off to its end. A target in place is left as it is."""
        if self.exists():
            for version in self.versions(OLD):
                self.drop(self.beside(version, OLD))
            return
        for state in (READY, OLD):
            waiting = self.versions(state)
            if waiting:
                self.move(self.beside(waiting[-1], state), self.target)
                return self.settle()


def escaped(name: str) -> str:
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in name)


def settled(spark: SparkSession, path: str) -> str:
    """The path, after a write to it that broke off has been brought to its end."""
    Place(spark, path).settle()
    return path


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a fresh folder, then put it in the place of path. If it fails, path stays what it was.

    The new table may be made from the old one. Of two writers at once the later commit wins; neither mixes with the other.
    """
    place, version = Place(spark, path), uuid.uuid4().hex
    place.settle()
    part = place.beside(version, PART)
    try:
        write(part.toString())
        place.move(part, place.beside(version, READY))
        place.commit(version)
    finally:
        for state in (PART, READY):
            place.drop(place.beside(version, state))
    spark.catalog.refreshByPath(path)
