"""Streams: keyed replacement per micro-batch, and event-time windows (an extension).  Operators: K6 X4 X5."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import latest, upsert


def read_files(spark: SparkSession, path: str, schema: str, files: int = 8) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def current(spark: SparkSession, target: str, schema: str | None = None, before: int | None = None) -> DataFrame:
    """A target's rows, with their bucket: of each bucket those of its newest version, or of the newest before one."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path) or not len(files.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target}/upsert_version=*/upsert_bucket=*"))):
        return spark.createDataFrame([], f"{schema}, upsert_bucket int")
    reader = spark.read.option("basePath", target)
    rows = (reader.schema(f"{schema}, upsert_version int, upsert_bucket int") if schema else reader).parquet(f"{target}/upsert_version=*")
    rows = rows if before is None else rows.where(F.col("upsert_version") < before)
    newest = rows.select("upsert_version", "upsert_bucket").distinct().groupBy("upsert_bucket").agg(F.max("upsert_version").alias("upsert_version"))
    return rows.join(F.broadcast(newest), ["upsert_version", "upsert_bucket"]).drop("upsert_version")  # as many rows as there are buckets


def upsert_sink(target: str, key: list[str], order: list[str], buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """X4, K6 for foreachBatch: each batch's latest rows replace the target's rows of the same keys.

    Keys are dealt into buckets by a hash, and a batch writes a new version, named by its number, of the buckets that it
    touches only; the others stay as they are.  A batch that is tried again writes the same folder from the same input,
    as versions are dropped only when two newer ones are there.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema)
        new = latest(batch, key, [F.col(c) for c in order]).select(*batch.columns).withColumn("upsert_bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
        touched = new.select("upsert_bucket").distinct()
        old = current(spark, target, kinds, number).join(F.broadcast(touched), "upsert_bucket", "left_semi").select(*new.columns)  # buckets rows at most
        upsert(old, new, key).repartition("upsert_bucket").write.mode("overwrite").partitionBy("upsert_bucket").parquet(f"{target}/upsert_version={number}")
        drop_superseded(spark, target, number)

    return write


def drop_superseded(spark: SparkSession, target: str, number: int) -> None:
    """Removes the versions of each bucket that a newer one before this number replaces."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(target)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there: dict[str, list[int]] = {}
    for status in files.globStatus(jvm.org.apache.hadoop.fs.Path(f"{target}/upsert_version=*/upsert_bucket=*")):  # folders, not rows
        path = status.getPath()
        there.setdefault(path.getName(), []).append(int(path.getParent().getName().removeprefix("upsert_version=")))
    for bucket, versions in there.items():
        before = sorted(v for v in versions if v < number)
        for v in before[:-1]:
            files.delete(jvm.org.apache.hadoop.fs.Path(f"{target}/upsert_version={v}/{bucket}"), True)


def event_windows(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums per tumbling window and type; the same expression over a stream or a table."""
    # A watermark needs an instant; local times go through the session's zone and back.
    source = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if events.isStreaming else events
    return source.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))


def pending(planned: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What a resumed run still has to do."""
    return planned.join(done.select(key).distinct(), key, "left_anti")
