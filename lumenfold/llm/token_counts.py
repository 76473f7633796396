"""Token counts by pre-token: pieces once per distinct pre-token, joined to each document's frequencies."""

from __future__ import annotations

import os
from collections import Counter

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, most_frequent
from .tokens import WordSplitter

TOKENIZER, LIMIT = "word_bpe_49k.json", 2048
COMMON, COMMON_CHARS, FLUSH = 100_000, 48, 100_000


def count_tokens(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT, common: int = COMMON) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of docs.

    The corpus is split into pre-tokens once to gather the distinct ones; each is encoded once. A second
    split gives each document's frequencies. The ``common`` most frequent pre-tokens of at most 48
    characters, a bound that does not grow with the data, travel to the tasks as a map; all other
    (document, pre-token) frequencies meet their counts in a shuffled join. The split between the two only
    routes work: both give the same numbers. Null texts count as empty (0 tokens); repeated rows and ids give
    one row each; an empty table gives an empty result. No token ids are kept.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    spark, scratch, splitter = docs.sparkSession, Scratch(docs.sparkSession, "count"), WordSplitter(tokenizer)

    def rows(seen):
        return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["word", "n"])

    def gather(batches):
        seen = Counter()
        for batch in batches:
            for cell in batch.column("text"):
                if (text := cell.as_py()) is not None:
                    seen.update(splitter.words(text)[0])
                if len(seen) >= FLUSH:
                    yield rows(seen)
                    seen.clear()
        yield rows(seen)

    def encode(batches):
        count = splitter.counter()
        for pdf in batches:
            yield pdf.assign(pieces=pd.Series(count(pdf["word"].tolist()), dtype="int64", index=pdf.index))

    words = docs.select("text").mapInArrow(gather, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = scratch.keep(words.mapInPandas(encode, "word string, n long, pieces long"))
    top = most_frequent(counted.where(F.length("word") <= COMMON_CHARS), "n", common).select("word", "pieces").toPandas()
    shared = spark.sparkContext.broadcast(dict(zip(top["word"], top["pieces"].astype(int), strict=True)))

    def frequencies(batches):
        known = shared.value
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                text = text if isinstance(text, str) else ""
                found, total = splitter.words(text)
                pieces = list(map(known.get, found))
                rare: dict[str, int] = {}
                if None in pieces:
                    rare = Counter(w for w, p in zip(found, pieces, strict=True) if p is None)
                    pieces = [p for p in pieces if p is not None]
                rows.append((len(text.encode("utf-8", "surrogatepass")), total + sum(pieces), list(rare), list(rare.values())))
            yield pd.concat([pdf[["doc_id"]].reset_index(drop=True), pd.DataFrame(rows, columns=["n_bytes", "n_tokens", "rare", "times"])], axis=1)

    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = scratch.keep(docs.select("doc_id", "text").mapInPandas(frequencies, f"doc_id {kind}, n_bytes long, n_tokens long, rare array<string>, times array<int>").withColumn("row", F.monotonically_increasing_id()))
    shared.destroy()  # parts are stored; workers that live on let the map go
    rare = parts.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    more = rare.join(counted.select("word", "pieces"), "word").groupBy("row").agg(F.sum(F.col("pieces") * F.col("times")).alias("more"))
    total = F.col("n_tokens") + F.coalesce("more", F.lit(0))
    return parts.select("doc_id", "row", "n_bytes", "n_tokens").join(more, "row", "left").select("doc_id", "n_bytes", total.alias("n_tokens"), (total > limit).alias("over_limit"))
