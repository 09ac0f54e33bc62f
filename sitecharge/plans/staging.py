"""Intermediate tables that several branches of a pipeline read.

They are written to a folder that all executors share: lineage ends there, a lost executor costs no
recomputation of the fact, and each reader prunes columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a folder of its warehouse.

    Both are shared by all executors of a cluster. The session's settings are read, never written.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_staging").rstrip("/")


class Staging:
    """Tables of one run, below one new folder that exists from the first ``store`` on.

    Whoever makes a ``Staging`` owns its folder and calls ``clear`` once nothing reads its tables any more,
    as ``run_report`` does. Results that are returned lazily still read them: the caller of such a plan
    clears it after use, or leaves that to whoever empties the shared folder.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self._parent = folder
        self._folder: str | None = None
        self._stored = 0

    @property
    def folder(self) -> str:
        if self._folder is None:
            parent = self._parent or shared_folder(self.spark)
            self._folder = f"{parent.rstrip('/')}/run-{uuid.uuid4().hex}"
        return self._folder

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as a table of its own and return a reader of what was written."""
        self._stored += 1
        path = f"{self.folder}/{name}-{self._stored}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Delete the run's tables; frames that read them are no longer usable."""
        if self._folder is None:
            return
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self._folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
