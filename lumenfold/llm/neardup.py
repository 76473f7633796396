"""Near-duplicate documents by BagMinHash over multisets of five-word shingles."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch
from .shingles import WordHash, bag_minhash, bands, six_bytes, units, word_shingles
from .similar import SLOTS, linked, marks

SHINGLE, THRESHOLD = 5, 0.8
ROWS, BANDS = 4, 16
GROUP_WORDS = 300_000


def words(text: str) -> list[str]:
    """Lower-case words between white space."""
    return text.lower().split()


def _groups(texts: list[str]):
    """Runs of texts of bounded size together: (first, their words)."""
    first, part, size = 0, [], 0
    for k, t in enumerate(texts):
        part.append(words(t))
        size += len(part[-1])
        if size >= GROUP_WORDS:
            yield first, part
            first, part, size = k + 1, [], 0
    if part:
        yield first, part


def with_node(docs: DataFrame) -> DataFrame:
    """Equal texts share a node, a 64-bit hash of the text; a null text equals the empty one."""
    return docs.withColumn("_node", F.xxhash64(F.coalesce("text", F.lit(""))))


def signatures(batches):
    known = WordHash()
    for pdf in batches:
        texts = [t if isinstance(t, str) else "" for t in pdf["text"]]
        size, found = np.zeros(len(texts), dtype=np.int64), []
        for first, part in _groups(texts):
            doc, h = word_shingles(part, known, SHINGLE)
            size[first : first + len(part)] = np.bincount(doc, minlength=len(part))
            found.append(bands(bag_minhash(doc, h, len(part), ROWS * BANDS), ROWS))
        rows = np.concatenate(found) if found else np.zeros((0, BANDS), dtype=np.int64)
        yield pd.DataFrame({"node": pdf["_node"].to_numpy(), "doc_id": pdf["doc_id"], "size": size, "bands": [six_bytes(r).tobytes() if n else b"" for r, n in zip(rows, size, strict=True)]})


def shingle_sets(batches):
    known = WordHash()
    for pdf in batches:
        texts = [t if isinstance(t, str) else "" for t in pdf["text"]]
        for first, part in _groups(texts):
            doc, value = units(*word_shingles(part, known, SHINGLE))
            at = np.searchsorted(doc, np.arange(len(part) + 1))
            yield pd.DataFrame({"node": pdf["_node"].to_numpy()[first : first + len(part)], "units": [value[a:b].view(np.int64) for a, b in zip(at[:-1], at[1:], strict=True)], "marks": marks(doc, value, len(part))})


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[Scratch, DataFrame]:
    """Rows (node, doc_id, component, class_id, class_size) per row of docs, and the scratch that holds them.

    Two texts are linked if the weighted Jaccard similarity of their multisets of five-word shingles is at
    least ``threshold``; classes are the components of those links. component is a text hash and the class's key. class_id is the smallest
    doc_id of a class, which other classes may share where ids are repeated or null.
    A text of fewer than five words is one shingle; texts without words (null, empty, blank) have none and
    are linked to equal texts only. Repeated rows share a class; null ids are in their class but never name
    it unless all ids there are null.
    """
    scratch = Scratch(docs.sparkSession, "neardup")
    base = with_node(docs.select("doc_id", "text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = scratch.keep(base.mapInPandas(signatures, f"node long, doc_id {kind}, size long, bands binary"))
    nodes = rows.where("size > 0").groupBy("node").agg(F.min("bands").alias("bands"))

    def sets_of(asked: DataFrame) -> DataFrame:
        one = rows.join(asked, "node", "left_semi").groupBy("node").agg(F.min(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("_id"))
        texts = base.withColumn("_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
        met = texts.join(one.withColumnRenamed("node", "_node"), ["_node", "_id"], "left_semi")
        return met.select("_node", "text").mapInPandas(shingle_sets, "node long, units array<long>, marks array<long>").dropDuplicates(["node"]).select("node", F.col("units").alias("item"), F.size("units").alias("size"), "marks")

    nodes = scratch.keep(nodes)
    comp = linked(scratch, nodes, BANDS, SLOTS, sets_of, threshold)
    scratch.drop(nodes)
    named = rows.select("node", "doc_id").join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ids = scratch.keep(named.groupBy("component").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size")))
    return scratch, named.join(ids, "component").select("node", "doc_id", "component", "class_id", "class_size")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, component, class_id, class_size, kept (whether the row's id names its class) per row of docs; see ``classes``."""
    _, found = classes(docs, threshold)
    return found.select("doc_id", "component", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def without_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of docs per class, with its columns: a row whose id names the class."""
    _, found = classes(docs, threshold)
    keep = found.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("component").agg(F.min("node").alias("_n"), F.first("class_id").alias("class_id"))
    names = docs.columns
    rows = with_node(docs.select(F.struct(*names).alias("_row"), "doc_id", "text")).drop("text")
    key = F.col("_node").eqNullSafe(F.col("_n")) & F.col("doc_id").eqNullSafe(F.col("class_id"))
    met = rows.join(keep, key, "left_semi")
    once = met.withColumn("_k", F.row_number().over(Window.partitionBy("_node", "doc_id").orderBy(F.xxhash64("_row")))).where("_k = 1")
    return once.select("_row.*")
