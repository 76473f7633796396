"""Language-model scores by a hidden Markov model trained with Baum-Welch over partitions.

Tokens are ASCII-lower-cased words between ASCII white space, then one end token. The unigram base counts all
training tokens. The HMM's alphabet is the ``top`` most frequent words, the end token and one class for all
other words; a word of that class is drawn from the class by its base probability, so the model gives every token
sequence a probability. Expected counts of each pass are summed over partitions; only they, a table bounded
by the alphabet, come to the driver.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, id_hash_mod, most_frequent, small_batches

STATES, TOP, COMMON, COMMON_BYTES = 8, 16_384, 150_000, 48
ROUNDS, PRIOR = 3, 100.0
SEED_DOCS, SEED_STEPS = 600, 10
FLUSH, CHUNK = 150_000, 400_000


def tokens(text: str | None) -> list[bytes]:
    """The words; bytes.lower and bytes.split know ASCII letters and ASCII white space only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if isinstance(text, str) else []


@dataclass
class Params:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # symbols x states, columns sum to 1


def _chunks(docs: list[np.ndarray], limit: int = CHUNK):
    """Runs of documents of similar length, longest first, padded time-major: (their numbers, symbols, how many are that long)."""
    order = sorted(range(len(docs)), key=lambda k: -len(docs[k]))
    at = 0
    while at < len(order):
        longest = len(docs[order[at]])
        part = order[at : at + max(1, limit // longest)]
        sizes = np.array([len(docs[k]) for k in part])
        ids = np.zeros((longest, len(part)), dtype=np.int32)
        for j, k in enumerate(part):
            ids[: sizes[j], j] = docs[k]
        yield part, ids, np.searchsorted(-sizes, -np.arange(longest), side="left")
        at += len(part)


def log_likelihood(p: Params, docs: list[np.ndarray]) -> np.ndarray:
    """Natural logarithm of each sequence's probability, by the scaled forward recursion."""
    out = np.zeros(len(docs))
    for part, ids, live in _chunks(docs, 4 * CHUNK):
        total = np.zeros(len(part))
        alpha = p.start * p.emit[ids[0]]
        for t in range(len(ids)):
            n = live[t]
            if t:
                alpha = (alpha[:n] @ p.move) * p.emit[ids[t, :n]]
            c = alpha.sum(axis=1)
            alpha = alpha / c[:, None]
            total[:n] += np.log(c)
        out[part] = total
    return out


class Stats:
    """Expected counts of Baum-Welch."""

    def __init__(self, states: int, symbols: int):
        self.start, self.move, self.emit, self.log = np.zeros(states), np.zeros((states, states)), np.zeros((symbols, states)), 0.0

    def add(self, p: Params, docs: list[np.ndarray]) -> None:
        for _, ids, live in _chunks(docs):
            length, wide = ids.shape
            k = len(p.start)
            alpha, scale = np.zeros((length, wide, k)), np.ones((length, wide))
            for t in range(length):
                n = live[t]
                a = (alpha[t - 1, :n] @ p.move if t else p.start) * p.emit[ids[t, :n]]
                c = a.sum(axis=1)
                alpha[t, :n], scale[t, :n] = a / c[:, None], c
            self.log += float(np.log(scale).sum())
            beta, pair = np.ones((wide, k)), np.zeros((k, k))
            for t in range(length - 1, -1, -1):
                if t < length - 1:
                    n = live[t + 1]
                    w = p.emit[ids[t + 1, :n]] * beta[:n] / scale[t + 1, :n, None]
                    pair += alpha[t, :n].T @ w
                    alpha[t + 1, :n] *= beta[:n]
                    beta[:n] = w @ p.move.T
            alpha[0] *= beta
            self.start += alpha[0].sum(axis=0)
            self.move += p.move * pair
            flat = ids.ravel()
            for j in range(k):
                self.emit[:, j] += np.bincount(flat, weights=alpha[:, :, j].ravel(), minlength=len(self.emit))

    def params(self, base: np.ndarray) -> Params:
        """Maximum a posteriori: emissions drawn towards the base distribution, moves towards staying."""
        k = len(self.start)
        emit = self.emit + PRIOR * base[:, None]
        move = self.move + 0.1 + np.eye(k)
        return Params((self.start + 1) / (self.start + 1).sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def first_params(docs: list[np.ndarray], base: np.ndarray, states: int) -> Params:
    """A start for Baum-Welch: states drawn apart at random by document, then passes over the seed documents."""
    rng = np.random.default_rng(7)
    emit = np.zeros((len(base), states))
    for d in docs:
        np.add.at(emit, (d, np.full(len(d), rng.integers(states))), 1.0)
    emit = emit * rng.uniform(0.5, 1.5, emit.shape) + PRIOR * base[:, None] * rng.uniform(0.5, 1.5, emit.shape)
    move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    p = Params(np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    for _ in range(SEED_STEPS if docs else 0):
        s = Stats(states, len(base))
        s.add(p, docs)
        p = s.params(base)
    return p


def expected_counts(texts: DataFrame, sequence, params: Params) -> Stats:
    """The Baum-Welch counts of all rows of ``texts`` (its first column), each of weight 1, summed over partitions.

    ``sequence`` turns a cell into its array of symbols. The result is bounded by the alphabet."""
    symbols, states = params.emit.shape
    names = [f"s{j}" for j in range(states)]
    now = texts.sparkSession.sparkContext.broadcast(params)

    def expect(batches):
        s, held, size = Stats(states, symbols), [], 0
        for batch in batches:
            for cell in batch.column(0):
                held.append(sequence(cell.as_py()))
                size += len(held[-1])
                if size >= 2 * CHUNK:
                    s.add(now.value, held)
                    held, size = [], 0
        if held:
            s.add(now.value, held)
        every = np.concatenate([s.start[None], s.move, s.emit])
        used = np.flatnonzero(every.any(axis=1))
        yield pa.RecordBatch.from_arrays([*(pa.array(every[used, j]) for j in range(states)), pa.array(used)], [*names, "at"])

    summed = texts.mapInArrow(expect, ", ".join(f"{x} double" for x in names) + ", at long").groupBy("at").agg(*[F.sum(x).alias(x) for x in names])
    with small_batches(texts.sparkSession):
        got = summed.toPandas()
    every = np.zeros((1 + states + symbols, states))
    every[got["at"].to_numpy()] = got[names].to_numpy()
    out = Stats(states, symbols)
    out.start, out.move, out.emit = every[0], every[1 : 1 + states], every[1 + states :]
    now.destroy()
    return out


def score(docs: DataFrame, folds: int = 10, states: int = STATES, top: int = TOP, common: int = COMMON) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of docs.

    Training rows are those whose crc32(doc_id) mod ``folds`` is not 0. Each of ROUNDS passes of Baum-Welch takes the expected
    counts over all training rows with equal weight. The start comes from about SEED_DOCS of them. After the counts, texts are split
    once more: their symbols are stored, and the passes and the scores read those. The
    ``common`` most frequent words of at most 48 bytes go to the tasks as a map, a bound that does not grow with
    the data; all rarer words meet their counts in a shuffled join. Null texts are empty: only the end token. Repeated
    rows give a row each. Without training rows score equals base_score; an empty table gives an empty result.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "hmm")
    base_docs = docs.select("doc_id", "text", (id_hash_mod("doc_id", folds) == 0).alias("held_out"))
    training = base_docs.where(~F.col("held_out"))

    def count(batches):
        seen, rows = Counter(), 0
        for pdf in batches:
            for text in pdf["text"]:
                seen.update(tokens(text))
                if len(seen) >= FLUSH:
                    yield pd.DataFrame({"word": list(seen), "n": list(seen.values()), "rows": 0})
                    seen.clear()
            rows += len(pdf)
        yield pd.DataFrame({"word": pd.Series([*seen, b""], dtype="object"), "n": pd.Series([*seen.values(), 0], dtype="int64"), "rows": pd.Series([0] * len(seen) + [rows], dtype="int64")})

    counts = scratch.keep(training.select("text").mapInPandas(count, "word binary, n long, rows long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows")))
    n_words, n_types, n_docs = (int(x or 0) for x in counts.agg(F.sum("n"), F.sum((F.length("word") > 0).cast("long")), F.sum("rows")).first())
    counts = counts.where(F.length("word") > 0)
    total, types = n_words + n_docs, n_types + (n_docs > 0)
    below = total + 0.1 * (types + 1)
    frequent = most_frequent(counts.where(F.length("word") <= COMMON_BYTES), "n", common).select("word", "n").toPandas()
    frequent = frequent.assign(word=frequent["word"].map(bytes)).sort_values(["n", "word"], ascending=[False, True])
    words = dict(zip(frequent["word"], range(len(frequent)), strict=True))
    n = frequent["n"].to_numpy(dtype=float)
    top = min(top, len(n))
    end, rare = top, top + 1
    prob = (n + 0.1) / below
    p_end = (n_docs + 0.1) / below
    rare_mass = max(1e-12, 1 - prob[:top].sum() - p_end)
    base = np.append(prob[:top], [p_end, rare_mass])
    symbol = np.append(np.minimum(np.arange(len(n)), rare), rare).astype(np.int32)
    symbol[top : len(n)] = rare
    shared = spark.sparkContext.broadcast((words, symbol, np.append(np.log10(prob), 0.0)))
    unknown = len(n)

    def sequence(text):
        get, known, _ = shared.value[0].get, shared.value[1], None
        found = tokens(text)
        at = np.fromiter((get(w, unknown) for w in found), dtype=np.int64, count=len(found))
        return found, at, np.append(known[at], np.int32(end))

    wide = "<u2" if rare < 1 << 16 else "<i4"  # of the stored symbols

    def split(batches):
        log_base, log_rare = shared.value[2], np.log10(rare_mass)
        for pdf in batches:
            out = []
            for text in pdf["text"]:
                found, at, seq = sequence(text)
                own = log_base[at]
                in_class = seq[:-1] == rare
                more = Counter(w for w, k in zip(found, at.tolist(), strict=True) if k == unknown) if (at == unknown).any() else {}
                out.append((seq.astype(wide).tobytes(), len(seq), int((at != unknown).sum()) + int(n_docs > 0), own.sum() + np.log10(p_end), own[in_class].sum() - in_class.sum() * log_rare, list(more), list(more.values())))
            part = pd.DataFrame(out, columns=["seq", "n_tokens", "n_known", "base_score", "in_class", "rare", "times"])
            yield pd.concat([pdf[["doc_id", "held_out"]].reset_index(drop=True), part], axis=1)

    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = scratch.keep(base_docs.select("doc_id", "held_out", "text").mapInPandas(split, f"doc_id {kind}, held_out boolean, seq binary, n_tokens long, n_known long, base_score double, in_class double, rare array<binary>, times array<int>").withColumn("row", F.monotonically_increasing_id()))
    read = lambda cell: np.frombuffer(cell, dtype=wide)
    params = None
    if n_docs:
        # a row's own hash picks the seeds and orders them, so reruns agree; equal rows count once
        seeds = training.select(F.xxhash64("doc_id", "text").alias("h"), "text").where(F.pmod(F.col("h"), F.lit(1 << 20)) < int(min(1.0, SEED_DOCS / n_docs) * (1 << 20))).dropDuplicates(["h"])
        params = first_params([sequence(r["text"])[2] for r in sorted(seeds.collect(), key=lambda r: r["h"])], base, states)
        for _ in range(ROUNDS):
            params = expected_counts(parts.where(~F.col("held_out")).select("seq"), read, params).params(base)
    last = spark.sparkContext.broadcast(params)

    def final(batches):
        p = last.value
        for pdf in batches:
            seqs = [read(x) for x in pdf["seq"]]
            part = pdf.drop(columns=["seq", "in_class"])
            if p is None:
                part["score"] = part["base_score"]
            else:
                found = [log_likelihood(p, seqs[at : at + 2000]) for at in range(0, len(seqs), 2000)]
                part["score"] = pdf["in_class"] + (np.concatenate(found) / np.log(10) if found else 0.0)
            yield part

    known = f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    scored = scratch.keep(parts.select("row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "in_class", "seq").mapInPandas(final, known))
    spread = parts.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    met = spread.join(counts.select("word", "n"), "word", "left")
    log = F.log10((F.coalesce("n", F.lit(0)) + 0.1) / below) * F.col("times")
    more = met.groupBy("row").agg(F.sum(log).alias("log"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known"))
    zero = F.lit(0.0)
    return scored.join(more, "row", "left").select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), (F.col("base_score") + F.coalesce("log", zero)).alias("base_score"), (F.col("score") + F.coalesce("log", zero)).alias("score"))
