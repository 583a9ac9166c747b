"""Tables that an operator writes once and reads several times, in the folder that the cluster shares.

Files outlive any executor: a lost one costs the tasks it was running, and no
chain of earlier rounds is computed anew.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_roots: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session, spark.checkpoint.dir.

    Where none is set a local session (tests) gets a folder of its own; on a
    cluster that is an error, as no folder is known to be shared.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="strandframe-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


class Scratch:
    """The tables of one operator call. Those that its lazy result reads stay until sweep."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self._n = spark, 0
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        _roots.setdefault(spark.sparkContext.applicationId, []).append(self.root)

    def save(self, df: DataFrame) -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n:03d}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, last: int) -> None:
        """Delete all tables but the last ones, when no later plan reads them."""
        for k in range(1, self._n + 1 - last):
            _delete(self.spark, f"{self.root}/{k:03d}")


def sweep(spark: SparkSession) -> None:
    """Delete all tables of this session; results computed from them cannot be read afterwards."""
    for root in _roots.pop(spark.sparkContext.applicationId, ()):
        _delete(spark, root)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
