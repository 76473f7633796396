"""Overlapping daily runs over an event stream; batch and streaming share the same transformation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY, OVERLAP = "24 hours", "24 hours 15 minutes"


def runs(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Counts and sums per run and type; a run covers a day and the 15 minutes before it, so boundary rows count twice."""
    w = F.window(F.col(ts), OVERLAP, DAY, "23 hours 45 minutes")
    return events.groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.end").alias("run_end"), "event_type", "n", "total")


def stream_runs(spark: SparkSession, source: str, schema, checkpoint: str, table: str, watermark: str = "15 minutes", dedup: bool = False) -> None:
    """The same over all files now in ``source``, kept in ``table``: each micro-batch sends the runs it has changed, so runs that are
    still open are there too (see ``current``). Ids are dropped within the watermark only if asked, as two runs may hold the same row."""
    events = spark.readStream.schema(schema).parquet(source).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    if dedup:
        events = events.dropDuplicatesWithinWatermark(["event_id"])
    keep_latest(runs(events), ["run_end", "event_type"], "n", table, checkpoint, "update")


def latest_by_key(spark: SparkSession, updates: DataFrame, key: str, order: str, table: str, checkpoint: str) -> None:
    """A keyed cache fed by a stream: each micro-batch is merged into the table, the newest entry per key staying."""
    keep_latest(updates, [key], order, table, checkpoint)


def keep_latest(stream: DataFrame, keys: list[str], order: str, table: str, checkpoint: str, mode: str = "append") -> None:
    """Merges a stream's micro-batches into a table: per key the row of greatest ``order`` stays. A batch writes a version of its
    own number, so one that is run again replaces only itself; the version before stays until the next is whole."""

    def merge(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        before = [v for v in versions(spark, table) if v < epoch]
        known = batch.limit(0) if not before else spark.read.schema(batch.schema).parquet(f"{table}/{before[-1]}")
        rest = [c for c in batch.columns if c not in keys]
        merged = known.union(batch).groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("v")).select(*keys, *[F.col("v")[c].alias(c) for c in rest])
        merged.select(*batch.columns).write.mode("overwrite").parquet(f"{table}/{epoch}")
        for old in before[:-1]:
            _folder(spark, table)[0].delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table}/{old}"), True)

    stream.writeStream.foreachBatch(merge).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _folder(spark: SparkSession, path: str):
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), root


def versions(spark: SparkSession, table: str) -> list[int]:
    """The whole versions of a table, oldest first."""
    fs, root = _folder(spark, table)
    names = [f.getPath().getName() for f in fs.listStatus(root)] if fs.exists(root) else []
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return sorted(int(n) for n in names if n.isdigit() and fs.exists(done(f"{table}/{n}/_SUCCESS")))


def current(spark: SparkSession, table: str) -> DataFrame:
    """The table as the last whole micro-batch left it."""
    return spark.read.parquet(f"{table}/{versions(spark, table)[-1]}")
