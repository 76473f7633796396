"""Importance resampling towards a target: documents drawn in proportion to how much their words look like the target's.

Features are hashed runs of one and two words. Identical texts are grouped by their full text first, so features and the
weight of a text are computed once; bucket counts are multiplied by how often the text occurs, and weights are joined back
to documents before each gets noise of its own (the Gumbel trick: the greatest noisy weights are a draw without replacement).
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, fresh

BUCKETS, MIN_WORDS, PERCENT, SEED = 10_000, 20, 25, 7
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")  # in UTF-8: all but ASCII marks, upper case gone
HOT = 1000  # texts that occur in a thousandth of all rows or more are joined by a broadcast of at most this many rows
COARSE = 256


def buckets(text: str | None, width: int = BUCKETS) -> tuple[int, np.ndarray]:
    """(number of words, the bucket of every word and of every two words in a row) of a text, A-Z lower-cased."""
    words = WORDS.findall((text or "").encode("utf-8", "surrogatepass").lower())
    one = [zlib.crc32(w) for w in words]
    two = [zlib.crc32(b" " + w, c) for c, w in zip(one, words[1:], strict=False)]
    return len(words), (np.array(one + two, dtype=np.int64) % width).astype(np.int32)


def featured(texts: DataFrame, width: int = BUCKETS) -> DataFrame:
    """Rows (key, n, n_words, buckets) from rows (key, n, text)."""

    def run(batches):
        for b in batches:
            made = [buckets(t, width) for t in b.column("text").to_pylist()]
            ends = np.cumsum([0, *(len(x) for _, x in made)]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.int32), *(x for _, x in made)])
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("n"), pa.array([n for n, _ in made], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["key", "n", "n_words", "buckets"])

    return texts.select("key", "n", "text").mapInArrow(run, "key binary, n long, n_words long, buckets array<int>")


def key_of(text: Column) -> Column:
    """A text's name in joins: the 32 bytes of its SHA-256; null is named as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def distinct_texts(df: DataFrame) -> DataFrame:
    """Rows (key, n, text): each text once, with how many rows have it. Copies meet before the shuffle wherever one task has several."""
    full = F.coalesce(F.col("text"), F.lit(""))
    return df.select(full.alias("text")).groupBy("text").agg(F.count("*").alias("n")).select(key_of(F.col("text")).alias("key"), "n", "text")


def bucket_counts(rows: DataFrame, width: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows (n, buckets), repeats counted; ``width`` numbers reach the driver."""
    out = np.zeros(width, dtype=np.int64)
    for r in rows.select("n", F.explode("buckets").alias("b")).groupBy("b").agg(F.sum("n").alias("n")).collect():
        out[r["b"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, a thousand times the logarithm of target share over source share (one added to each count), rounded down."""
    s, t = (float(x.sum() + len(x)) for x in (source, target))
    return np.array([math.floor(1000 * math.log((b + 1) * s / ((a + 1) * t))) for a, b in zip(source.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def weighted(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """Rows (key, n, n_words, n_features, weight): the mean gain of a text's features, rounded down; 0 without features."""
    shared = rows.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        for b in batches:
            lists = b.column("buckets")
            ends = lists.offsets.to_numpy()
            total = np.append(0, np.cumsum(shared.value[lists.values.to_numpy()[: ends[-1]]]))
            many = np.diff(ends).astype(np.int64)
            weight = (total[ends[1:]] - total[ends[:-1]]) // np.maximum(many, 1)
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("n"), b.column("n_words"), pa.array(many), pa.array(weight)], ["key", "n", "n_words", "n_features", "weight"])

    return rows.mapInArrow(run, "key binary, n long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise of a document in thousandths, rounded down, from the SHA-256 of seed and id; a null id counts as the empty text."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.ln(-F.ln((h + 0.5) / 4294967296)) * -1000).cast("long")


def joined(ids: DataFrame, weights: DataFrame, total: int) -> DataFrame:
    """ids with the columns of their text's weights. Texts in a thousandth of all rows or more are at most HOT, which bounds
    what is broadcast; no other key has more rows than that, so the shuffle for the rest is even."""
    hot = F.col("n") * HOT >= total
    often = F.broadcast(weights.where(hot))
    return ids.join(often, "key").unionByName(ids.join(often.select("key"), "key", "left_anti").join(weights.where(~hot), "key"))


def ranked(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """scored with ``rank``: 1, 2, 3, ... down the scores of the drawn rows, null for the others.

    Scores are whole numbers, so their histogram gives each score's first rank and the lowest score drawn; rows of equal score
    are numbered by doc_id (null last, then key), and no task sorts more than those.
    """
    eligible = F.col("n_words") >= min_words
    by_score = scored.where(eligible).groupBy("score").agg(F.count("*").alias("c")).withColumn("coarse", F.floor(F.col("score") / COARSE))
    above = Window.orderBy(F.desc("coarse")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = by_score.groupBy("coarse").agg(F.sum("c").alias("b")).withColumn("before_block", F.coalesce(F.sum("b").over(above), F.lit(0)))  # a few hundred rows
    inside = Window.partitionBy("coarse").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    total = scored.where(eligible).count()
    want = total * percent // 100
    first = (by_score.withColumn("before", F.coalesce(F.sum("c").over(inside), F.lit(0))).join(F.broadcast(blocks.select("coarse", "before_block")), "coarse")
             .select(F.col("score").alias("_s"), (F.col("before") + F.col("before_block")).alias("_before")).where(F.col("_before") < want))
    order = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "key")
    top = scored.where(eligible).join(first, F.col("score") == F.col("_s")).withColumn("rank", (F.col("_before") + F.row_number().over(order)).cast("long"))
    top = top.withColumn("rank", F.when(F.col("rank") <= want, F.col("rank"))).select(*scored.columns, "rank")
    rest = scored.join(first.select("_s"), eligible & (F.col("score") == F.col("_s")), "left_anti")
    return top.unionByName(rest.withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED, width: int = BUCKETS) -> DataFrame:
    """Every row of docs with key, n_words, n_features, weight, score and rank; the rows with a rank are the draw.

    The draw is floor(percent / 100) of the rows with at least ``min_words`` words. Null and empty texts have no words and
    weight 0; repeated rows count each and take ranks one after the other; ties go to the smaller doc_id, null last; an empty
    table gives an empty result, an empty target adds one to every count like any other. Only doc_id and text are read.
    """
    scratch = Scratch(docs.sparkSession, "resample")
    ids = scratch.keep(docs.select("doc_id", key_of(F.col("text")).alias("key")))
    texts = scratch.keep(featured(distinct_texts(docs), width))
    wanted = bucket_counts(featured(distinct_texts(target), width), width)
    weights = scratch.keep(weighted(texts, gains(bucket_counts(texts, width), wanted)))
    scratch.drop(texts)
    scored = joined(ids, weights, ids.count()).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = scratch.keep(scored.select("doc_id", "key", "n_words", "n_features", "weight", "score"))
    scratch.drop(ids, weights)
    return ranked(scored, percent, min_words)


def drawn_rows(docs: DataFrame, target: DataFrame, **how: int) -> DataFrame:
    """The drawn documents themselves, with the columns of docs; of equal rows as many as are drawn."""
    row, key, many = (fresh(docs, c) for c in ("_row", "_key", "_many"))
    drawn = resample(docs, target, **how).where("rank is not null").groupBy("doc_id", "key").agg(F.count("*").alias(many))
    rows = docs.select(F.struct(*docs.columns).alias(row), "doc_id", key_of(F.col("text")).alias(key))
    met = rows.join(drawn.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col(key) == F.col("key")))
    place = F.row_number().over(Window.partitionBy("doc_id", key).orderBy(F.xxhash64(F.to_json(row))))
    return met.withColumn("_place", place).where(F.col("_place") <= F.col(many)).select(f"{row}.*")


ORACLE = """
WITH tab AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(i AS BIGINT)) ORDER BY i) AS v FROM range(256) r(i)),
lower_case AS (SELECT true AS doc, doc_id AS id, coalesce(text, '') AS text FROM documents UNION ALL SELECT false, item_id, coalesce(text, '') FROM benchmark),
w AS (SELECT doc, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM lower_case),
f AS (SELECT doc, id, unnest(w) AS x FROM w UNION ALL SELECT doc, id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w),
c AS (SELECT doc, id, x, count(*) AS n FROM f GROUP BY doc, id, x),
h AS (SELECT x, hex(encode(x)) AS h FROM (SELECT DISTINCT x FROM c)),
b AS (SELECT x, xor(list_reduce(list_transform(range(1, len(h), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT)),
   lambda a, y: xor(a >> 8, v[(xor(a, y) & 255) + 1]), 4294967295), 4294967295) % 10000 AS b FROM h, tab),
t AS (SELECT b, sum(n) FILTER (doc) AS s, sum(n) FILTER (NOT doc) AS t FROM c JOIN b USING (x) GROUP BY b),
z AS (SELECT coalesce(sum(s), 0) + 10000 AS s_all, coalesce(sum(t), 0) + 10000 AS t_all FROM t),
g AS (SELECT b, floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * s_all / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * t_all))) AS gain FROM t, z),
m AS (SELECT id, CAST(floor(CAST(sum(gain * n) AS DOUBLE) / sum(n)) AS BIGINT) AS weight FROM c JOIN b USING (x) JOIN g USING (b) WHERE doc GROUP BY id),
d AS (SELECT id AS doc_id, len(w) AS n_words, greatest(2 * len(w) - 1, 0) AS n_features, coalesce(weight, 0) AS weight FROM w LEFT JOIN m USING (id) WHERE doc),
s AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_words >= 20) OVER () AS total FROM s)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CASE WHEN n_words >= 20 AND place <= 25 * total // 100 THEN CAST(place AS BIGINT) END AS rank FROM r
"""
