"""Intermediate tables in the folder that all executors share.

Iterative operators cut their lineage here. A parquet table is used rather than a persisted RDD, as it survives the loss
of an executor, is compressed, and gives the optimiser sizes to plan with.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
_OPEN: list[Scratch] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's `spark.checkpoint.dir`; a temporary folder only where it is unset and the session is local."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    option = spark.sparkContext._jsc.sc().getCheckpointDir()
    if option.isDefined():
        return option.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _OWN.setdefault(spark.sparkContext.applicationId, f"file://{tempfile.mkdtemp(prefix='loomspan-')}")


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    with contextlib.suppress(Exception):
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


class Scratch:
    """Tables of one operator run. `save` writes and reads back; `drop` frees one that is no longer read."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root, self._n = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", 0
        _OPEN.append(self)

    def save(self, df: DataFrame, old: DataFrame | None = None) -> DataFrame:
        """Materialise df; `old`, a table saved before that nothing reads any more, is deleted afterwards."""
        self._n += 1
        path = f"{self.root}/{self._n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        if old is not None:
            self.drop(old)
        return out

    def drop(self, df: DataFrame) -> None:
        if path := getattr(df, "_scratch_path", None):
            _delete(self.spark, path)

    def close(self) -> None:
        if self.spark.sparkContext._jsc is not None:
            _delete(self.spark, self.root)
        if self in _OPEN:
            _OPEN.remove(self)


def mark() -> int:
    """A place to free back to."""
    return len(_OPEN)


@atexit.register
def free(since: int = 0) -> None:
    """Delete the tables of all operator runs since a mark. Call it once their results have been read: a result that is
    read later finds its tables gone."""
    for scratch in _OPEN[since:]:
        scratch.close()
