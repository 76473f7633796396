"""Helpers shared by the corpus operators: shared-folder tables, split rules and connected components."""

from __future__ import annotations

import atexit
import os
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """The name, with underscores added until df has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the session's ``spark.checkpoint.dir``; only where that is unset in local mode (tests) is a
    folder under /tmp/checkpoints chosen and written back to the session. On a cluster it must be set.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = f"file:///tmp/checkpoints/{os.getpid()}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


_live: dict[str, SparkSession] = {}


def _drop_all() -> None:
    for path, spark in list(_live.items()):
        try:
            _delete(spark, path)
        except Exception:  # the session has ended before the interpreter
            return


atexit.register(_drop_all)


def most_frequent(counts: DataFrame, n: str, limit: int) -> DataFrame:
    """The rows of greatest n, as many as fit ``limit`` without parting rows of about equal n (within 1/16 of a power of two).

    A histogram of at most about a thousand classes gives the least class that fits, so nothing is sorted and tasks send no
    candidate lists."""
    rank = F.floor(F.log2(n) * 16)
    least, total = None, 0
    for r in sorted(counts.groupBy(rank.alias("k")).count().collect(), key=lambda r: -r["k"]):
        total += r["count"]
        if total > limit:
            break
        least = r["k"]
    return counts.where(rank >= least) if least is not None else counts.limit(0)


@contextmanager
def small_batches(spark: SparkSession, size: int = BATCH_BYTES):
    """Python workers get their rows in batches of about ``size`` bytes while this holds, however long the texts are."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


class Scratch:
    """Tables written to the shared folder; they cut lineage and survive lost executors.

    ``keep`` writes a table and returns a reader of it. ``drop`` deletes what no later plan reads.
    What a returned result still reads goes when the interpreter ends.
    """

    def __init__(self, spark: SparkSession, tag: str):
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/tables/{tag}-{uuid.uuid4().hex[:12]}", 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        _live[path] = self.spark
        with small_batches(self.spark):
            df.write.mode("overwrite").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            path = getattr(t, "_scratch_path", None)
            if path and _live.pop(path, None):
                _delete(self.spark, path)


def id_hash_mod(doc_id: str, m: int) -> Column:
    """crc32 of the id as text, modulo m; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % m


def components(scratch: Scratch, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of the undirected edges (a, b): rows (node, component), the smallest node naming each.

    Alternating large-star and small-star rounds; every round is a grouped minimum and a join, written
    to the shared folder, so no component is ever gathered in one task. Nodes without edges have no row.
    """
    cur = scratch.keep(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        met = both.join(low, "u")
        if large:
            out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = met.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = mark(cur)
    while before[0]:
        nxt = scratch.keep(star(star(cur, True), False))
        scratch.drop(cur)
        cur, now = nxt, mark(nxt)
        if now == before:
            break
        before = now
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).union(cur.select(F.col("v"), F.col("v")).distinct())
