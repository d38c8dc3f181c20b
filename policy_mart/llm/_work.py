"""Written intermediate tables in the shared folder, removed once they are no longer read."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workdir import work_dir


class Shelf:
    """Tables of one operator run below a folder of its own in the shared folder.

    `put` writes a frame and reads it back, which cuts its lineage: a lost executor costs the
    current step only. `drop` removes tables that no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = work_dir(spark, name)
        self._n = 0
        self._paths: dict[int, str] = {}
        self._frames: list[DataFrame] = []

    def put(self, df: DataFrame, compression: str | None = None) -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n}"
        df.write.parquet(path, compression=compression)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        self._frames.append(out)
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            path = self._paths.pop(id(df), None)
            if path:
                jvm = self.spark.sparkContext._jvm
                target = jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)

    def last(self, df: DataFrame) -> DataFrame:
        """Write the table that a result reads, and remove all others."""
        out = self.put(df)
        self.drop(*[f for f in self._frames if f is not out])
        return out


def name(column: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col(f"`{column}`")


def others(df: DataFrame, *replaced: str) -> list[Column]:
    """All columns but those an operator writes itself."""
    gone = {r.lower() for r in replaced}
    return [name(c) for c in df.columns if c.lower() not in gone]


def runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """The runs of rows that agree in `keys`, of rows sorted by them, across batches."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        values = list(zip(*[batch.column(k).to_pylist() for k in keys], strict=True))
        start = 0
        for i in range(batch.num_rows):
            if values[i] != current:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, current, start = [], values[i], i
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)
