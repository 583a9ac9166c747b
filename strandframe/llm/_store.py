"""Intermediate tables in the folder that the cluster shares.

Iterative operators cut their lineage by writing a table under
``spark.checkpoint.dir`` and reading it back: the files outlive any executor,
so a lost executor costs the tasks it was running and nothing else.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from strandframe.scratch import shared_dir
from strandframe.sources.package import ship

_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_roots: dict[str, list[str]] = {}
_DEFAULT_BATCH = ("64MB", "64m", "67108864b", "67108864")


def ready(spark: SparkSession) -> None:
    """Send the package to the workers, and keep their text batches small where the session has no own limit."""
    ship(spark)
    if spark.conf.get(_BATCH_BYTES, None) in _DEFAULT_BATCH:
        spark.conf.set(_BATCH_BYTES, "16m")


class Scratch:
    """A set of named tables of one operator call, each written once and read back.

    Operators drop the tables that their result does not read. The others stay,
    as the result is lazy: whoever has used it deletes the folder ``root``, or
    all of them at once with ``sweep``.
    """

    def __init__(self, spark: SparkSession, name: str):
        ready(spark)
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        _roots.setdefault(spark.sparkContext.applicationId, []).append(self.root)
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Delete tables that no later plan reads."""
        for df in frames:
            path = getattr(df, "_scratch_path", None)
            if path:
                delete(self.spark, path)


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def sweep(spark: SparkSession) -> None:
    """Delete all tables that operators of this session have left; their results cannot be read afterwards."""
    for root in _roots.pop(spark.sparkContext.applicationId, ()):
        delete(spark, root)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables that operators write inside, once what is computed from them has been saved elsewhere."""
    roots = _roots.setdefault(spark.sparkContext.applicationId, [])
    before = len(roots)
    yield
    for root in roots[before:]:
        delete(spark, root)
    del roots[before:]
