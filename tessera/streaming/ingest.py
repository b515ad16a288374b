"""Continuous form of the incremental steps: new files are taken up once, records are upserted batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def new_files(spark: SparkSession, path: str, glob: str = "*.ab", content: bool = False) -> DataFrame:
    """A stream of path, size, modified (and content) of files as they appear below path."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    df = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return df.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), *(["content"] if content else []))


def fold_in(batch: DataFrame, record: DataFrame | None, keys: list[str], order: str | None = None) -> DataFrame:
    """The record with the batch's rows in place of its own of the same key; of a key's rows in the batch the last by order, if there is one."""
    if order is None:
        batch = batch.dropDuplicates(keys)
    else:
        batch = batch.groupBy(*keys).agg(F.max_by(F.struct(*batch.columns), F.col(order)).alias("_row")).select("_row.*")
    return batch if record is None else record.join(batch.select(*keys), keys, "left_anti").unionByName(batch, allowMissingColumns=True)


def upsert_stream(
    stream: DataFrame, path: str, checkpoint: str, keys: list[str], prepare: Callable[[DataFrame], DataFrame] = lambda df: df, available_now: bool = True, order: str | None = None, keep: int = 2
) -> StreamingQuery:
    """Keep a Parquet record at path up to date with the stream.

    Every batch writes a new version beside the old ones (path/v=<batch>); readers take the latest complete one, so a
    batch that is run again after a failure overwrites its own version and changes nothing. The newest ``keep`` versions stay.
    A version is the whole record: meant for records of files, that change by batches far apart.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        old = latest(spark, path, before=number)
        fold_in(prepare(batch), old, keys, order).write.mode("overwrite").parquet(f"{path}/v={number}")
        fs, versions = _versions(spark, path)
        for n in sorted(versions)[: -max(2, keep)]:
            fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/v={n}"), True)

    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _versions(spark: SparkSession, path: str):
    """The file system, and the numbers of the versions that were written to the end."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [(s.getPath().getName(), s.getPath()) for s in fs.listStatus(root)] if fs.exists(root) else []
    return fs, [int(n[2:]) for n, p in names if n.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]


def latest(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The newest version of the record that was written to the end; None without any."""
    _, done = _versions(spark, path)
    done = [n for n in done if before is None or n < before]
    return spark.read.parquet(f"{path}/v={max(done)}") if done else None


def counts_by_window(events: DataFrame, time: str, keys: list[str], width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events by tumbling window and key, late ones within the watermark counted."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.count(F.lit(1)).alias("n"))
