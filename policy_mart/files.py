"""Files and folders in whatever store Spark reads, through its own file systems."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession


class Files:
    def __init__(self, spark: SparkSession, path: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[tuple[str, bool]]:
        """What a folder holds: (name, whether it is a folder), by name. Nothing where there is no folder."""
        if not self.exists(path):
            return []
        return sorted((s.getPath().getName(), s.isDirectory()) for s in self._fs.listStatus(self._path(path)))

    def size(self, path: str) -> int:
        """Bytes of a file, or of all that a folder holds. Nothing where there is none."""
        return self._fs.getContentSummary(self._path(path)).getLength() if self.exists(path) else 0

    def make(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def move(self, path: str, target: str) -> None:
        if not self._fs.rename(self._path(path), self._path(target)):
            raise OSError(f"{path} could not be moved to {target}")

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def file_bytes(df: DataFrame, enough: int) -> int:
    """Bytes of the files that a frame reads, counted up to `enough`."""
    total = 0
    for name in map(unquote, df.inputFiles()):
        total += Files(df.sparkSession, name).size(name)
        if total >= enough:
            break
    return total
