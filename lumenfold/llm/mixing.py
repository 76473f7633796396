"""Mixing sources to target weights with hash-threshold histograms; DataFrame functions only.

Every document gets a 60-bit hash of its id. Per source, sizes are summed in hash buckets; the bucket
in which the cumulative size meets the remaining budget is found, and only that bucket is split again,
until one hash value is left. Documents below the threshold are taken once more than the others: no
sort of documents, and larger budgets always contain what smaller budgets take.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, Scratch

BITS, LEVELS, HASH_BITS = 12, 3, 60
BROADCAST_SOURCES = 50_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_hash(doc_id: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, share: float = 1.0) -> DataFrame:
    """Rows (source, source_size, target) from rows (source, source_size).

    Sources in code-point order, null last, weigh ``weights`` in turn and share ``share`` of all sizes. A
    target stops at ``cap`` times its source's size; the excess goes to the others by weight until none is
    above. That fixed point is found directly: in order of cap/weight, the first k sources are capped
    where the common level for the rest stays below the next source's own.
    """
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1).cast("int"))
    full = F.col("source_size") * cap
    by = Window.orderBy(full / F.col("w"), F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("w", turn).withColumns({
        "w_left": F.sum("w").over(by.rowsBetween(0, Window.unboundedFollowing)),
        "full_before": F.coalesce(F.sum(full).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "total": F.sum("source_size").over(Window.partitionBy()),
    })
    level = (F.col("total") * F.lit(share) - F.col("full_before")) / F.col("w_left")
    levels = ranked.withColumn("level", level).withColumn("open", F.col("level") * F.col("w") <= full)
    final = F.min(F.when(F.col("open"), F.struct((full / F.col("w")).alias("o"), F.col("level").alias("l")))).over(Window.partitionBy())["l"]
    return levels.withColumn("final", final).select("source", "source_size", F.least(full.cast("double"), F.coalesce(F.col("final") * F.col("w"), full.cast("double"))).alias("target"))


def _with(rows: DataFrame, side: DataFrame, small: bool, how: str = "inner") -> DataFrame:
    """Joined by source, null matching null. The side is broadcast only if its counted rows are few; else Spark splits hot sources."""
    side = side.withColumnRenamed("source", "_s")
    return rows.join(F.broadcast(side) if small else side, F.col("source").eqNullSafe(F.col("_s")), how).drop("_s")


def thresholds(scratch: Scratch, narrow: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, share: float = 1.0) -> tuple[DataFrame, bool]:
    """Rows (source, source_size, target, times, edge, edge_in) from rows (source, size, h); whether they are few.

    Each document is taken ``times`` times, once more if its hash is below ``edge`` (or equal, if edge_in).
    """
    goal = scratch.keep(targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap, share)
                        .withColumn("times", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
                        .withColumn("rest", F.col("target") - F.col("times") * F.col("source_size")))
    small = goal.count() <= BROADCAST_SOURCES
    state = goal.where("rest > 0").select("source", "rest", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"))
    for level in range(1, LEVELS + 2):
        shift = HASH_BITS - BITS * level if level <= LEVELS else 0
        inside = _with(narrow, state, small)
        if level > 1:
            inside = inside.where(F.shiftright("h", HASH_BITS - BITS * (level - 1)) == F.col("prefix"))
        hist = inside.withColumn("bucket", F.shiftright("h", shift)).groupBy("source", "bucket").agg(F.sum("size").alias("s"), F.first("rest").alias("rest"), F.first("below").alias("below"))
        cum = hist.withColumn("upto", F.col("below") + F.sum("s").over(Window.partitionBy("source").orderBy("bucket")))
        state = (cum.where("upto >= rest and upto - s < rest").select("source", "rest", F.col("bucket").alias("prefix"), (F.col("upto") - F.col("s")).alias("below"), "s"))
    edge = state.select("source", F.col("prefix").alias("edge"), ((F.col("rest") - F.col("below")) * 2 >= F.col("s")).alias("edge_in"))
    return scratch.keep(_with(goal, edge, small, "left").drop("rest")), small


def apply(rows: DataFrame, found: DataFrame, small: bool) -> DataFrame:
    """rows with (source, size, h) and the thresholds of their source, and ``repeats``: how often each is taken."""
    more = F.coalesce((F.col("h") < F.col("edge")) | ((F.col("h") == F.col("edge")) & F.col("edge_in")), F.lit(False))
    return _with(rows, found, small).withColumn("repeats", F.col("times") + more.cast("long"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, share: float = 1.0, size: Column | None = None) -> DataFrame:
    """Every document with size, source_size, target, repeats and taken (size x repeats).

    Null texts have size 0; a null source is a source of its own; repeated ids share one hash and are taken
    alike; an empty table gives an empty result. Columns of docs other than doc_id and source are left out.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    narrow = scratch.keep(docs.select("doc_id", F.col("source").cast("string").alias("source"), (word_count(F.col("text")) if size is None else size).alias("size"), id_hash(F.col("doc_id")).alias("h")))
    return apply(narrow, *thresholds(scratch, narrow, weights, cap, share)).select("doc_id", "source", "size", "source_size", "target", "repeats", (F.col("size") * F.col("repeats")).alias("taken"))


def mixed_rows(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, share: float = 1.0) -> DataFrame:
    """The mix itself: each document as many times as it is taken, with the columns of docs."""
    scratch, names = Scratch(docs.sparkSession, "mix"), docs.columns
    packed = docs.select(F.struct(*names).alias("_row"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), id_hash(F.col("doc_id")).alias("h"))
    narrow = scratch.keep(packed.drop("_row"))
    found = thresholds(scratch, narrow, weights, cap, share)
    return apply(packed, *found).where("repeats > 0").select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats"))).alias("_n")).select("_row.*")


ORACLE = """
WITH d AS (
  SELECT doc_id, source, CAST(length(regexp_replace(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+', 'x', 'g'))
           - length(regexp_replace(coalesce(text, ''), '[^\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
s AS (SELECT source, sum(size) AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY source),
r AS (SELECT *, sum(w) OVER (ORDER BY source_size * 3 / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left,
        coalesce(sum(source_size * 3) OVER (ORDER BY source_size * 3 / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
        sum(source_size) OVER () AS total FROM s),
l AS (SELECT *, CAST(total - full_before AS DOUBLE) / CAST(w_left AS DOUBLE) AS level FROM r),
f AS (SELECT arg_min(level, source_size * 3 / w) AS final FROM l WHERE level * w <= source_size * 3),
t AS (SELECT source, CAST(source_size AS BIGINT) AS source_size, least(CAST(source_size * 3 AS DOUBLE), coalesce(final * w, CAST(source_size * 3 AS DOUBLE))) AS target FROM l, f),
g AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS times FROM t),
c AS (SELECT d.doc_id, d.size, d.h, g.*, target - times * source_size AS rest,
        sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS upto, sum(d.size) OVER (PARTITION BY d.source, d.h) AS own
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, CAST(size * (times + CASE WHEN rest > 0 AND
   (upto < rest OR (upto - own < rest AND upto >= rest AND (rest - (upto - own)) * 2 >= own)) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM c
"""
