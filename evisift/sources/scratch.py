"""Scratch tables in the folder that the driver and all executors share: how lineage is cut.

They are written as Parquet below ``spark.checkpoint.dir`` and read again.  A lost executor then costs the tasks it was
running, not the steps before.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.

    Only where that is unset and the master is local, as in tests, a local folder of our own; on a cluster executors
    would write where nobody else reads, so there it raises.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="evisift-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: What holds while a scratch table is written.
WRITING = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "65536",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings that hold for what is executed within, and are as before afterwards.

    They belong to the session, so queries that other threads run meanwhile see them too; none changes any result.
    """
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class Scratch:
    """A folder of its own in the shared directory for one operator call.

    Results are read from it as they are used, so it goes when the driver ends, or by clear() before.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        files, path = self._place("")
        files.deleteOnExit(path)

    def _place(self, name: str):
        """The Java file system and path of a table, or of the folder."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Writes df and returns it as a scan; all of df's shuffle files are then free to go.

        What goes to Python at once while it is written is bounded by bytes, so thin rows travel by the ten thousand
        and long texts by the hundred.
        """
        with _settings(self.spark, WRITING):
            df.write.mode("overwrite").parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, *names: str) -> None:
        """Removes tables that no later step reads."""
        for name in names:
            files, path = self._place(name)
            files.delete(path, True)

    def clear(self) -> None:
        """Removes the folder: for callers that have used the result."""
        files, path = self._place("")
        files.delete(path, True)
