"""Folders of a table on the file system Spark writes to, whatever store that is."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folders:
    """List, remove and rename below one path, through Spark's own file system classes."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.base = spark, path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.base).getFileSystem(spark._jsc.hadoopConfiguration())

    def matching(self, pattern: str) -> list[str]:
        """Relative paths that fit a glob pattern, in order."""
        found = self._files.globStatus(self._path(f"{self.base}/{pattern}")) or []
        depth = pattern.count("/") + 1
        return sorted("/".join(f.getPath().toString().split("/")[-depth:]) for f in found)

    def remove(self, name: str) -> None:
        self._files.delete(self._path(f"{self.base}/{name}"), True)

    def remove_all(self) -> None:
        self._files.delete(self._path(self.base), True)

    def rename(self, old: str, new: str) -> None:
        parent = self._path(f"{self.base}/{new}").getParent()
        self._files.mkdirs(parent)
        if not self._files.rename(self._path(f"{self.base}/{old}"), self._path(f"{self.base}/{new}")):
            raise OSError(f"{self.base}/{old} was not renamed to {new}")

    def write_line_file(self, name: str, lines: list[str]) -> None:
        """A small text file that appears whole or not at all."""
        aside = f"{name}.part"
        out = self._files.create(self._path(f"{self.base}/{aside}"), True)
        try:
            out.write("".join(f"{line}\n" for line in lines).encode())
        finally:
            out.close()
        self.rename(aside, name)
