"""Document quality by ordinal regression: a cumulative-link model with one weight per hashed feature and ordered thresholds.

The grades g_0 < ... < g_K are the distinct ratings. P(grade <= g_k) = s(t_k - w.x), s the logistic function, with the same
weights w for every k and t_0 < ... < t_(K-1). x holds 1 + log(count) of the words, hashed with a sign to WIDTH places, and of
a few marks of the text's shape, scaled to length 1.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, id_hash_mod
from .shingles import U, WordHash

WIDTH, L2 = 1 << 18, 3e-4
STEPS, FLAT = 500, 1e-5  # steps at most; largest part of the mean gradient at the end
GROUP_WORDS = 300_000


def words_of(text: str | None) -> list[str]:
    """The lower-case words, and marks of the shape: size, share of distinct words, of letters and of repeated lines."""
    low = text.lower() if isinstance(text, str) else ""
    words = low.split()
    lines = [x for x in low.split("\n") if x.strip()]
    letters = sum(map(len, filter(str.isalpha, words)))
    eighth = lambda part, whole: 8 * part // max(1, whole)
    return [*words, f"\n size {len(words).bit_length()}", f"\n distinct {eighth(len(set(words)), len(words))}", f"\n letters {eighth(letters, sum(map(len, words)))}", f"\n lines {eighth(len(set(lines)), len(lines))}"]


def features(texts, known: WordHash):
    """(text number, place, value) of the features of runs of texts: (how many texts, three arrays)."""
    part, size = [], 0
    for k, t in enumerate(texts):
        part.append(words_of(t))
        size += len(part[-1])
        if size >= GROUP_WORDS or k + 1 == len(texts):
            sizes = np.fromiter(map(len, part), dtype=np.int64, count=len(part))
            h = np.fromiter((known[w] for ws in part for w in ws), dtype=U, count=size)
            key, times = np.unique((np.repeat(np.arange(len(part)), sizes).astype(U) << U(32)) | (h >> U(32)), return_counts=True)
            doc, at = (key >> U(32)).astype(np.int64), (key & U(WIDTH - 1)).astype(np.int32)
            value = 1 + np.log(times)
            norm = np.sqrt(np.bincount(doc, weights=value**2, minlength=len(part)))
            yield len(part), doc, at, (np.where(key & U(1 << 31), -1.0, 1.0) * value / norm[doc]).astype(np.float32)
            part, size = [], 0


def sigmoid(z: np.ndarray) -> np.ndarray:
    return np.exp(-np.logaddexp(0, -z))


def loss(z: np.ndarray, grade: np.ndarray, cuts: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(negative log-likelihood, its derivative by each z, by each threshold) of grades given as numbers from 0."""
    ends = np.concatenate([[-np.inf], cuts, [np.inf]])
    low, high = ends[grade] - z, ends[grade + 1] - z
    gap = -np.expm1(low - high)
    total = np.logaddexp(0, -high) + np.logaddexp(0, low) - np.log(gap)
    by_high, by_low = sigmoid(-high) / (sigmoid(-low) * gap), sigmoid(low) / (sigmoid(high) * gap)
    n = len(ends)
    by_cut = np.bincount(grade, weights=by_low, minlength=n)[1 : n - 1] - np.bincount(grade + 1, weights=by_high, minlength=n)[1 : n - 1]
    return float(total.sum()), 1 - sigmoid(high) - sigmoid(low), by_cut


def minimise(value_of, x: np.ndarray, memory: int = 8) -> np.ndarray:
    """L-BFGS with halved steps until the value falls enough; ends where the gradient is flat or the value no longer falls."""
    value, grad = value_of(x)
    pairs: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(STEPS):
        if np.abs(grad).max() <= FLAT:
            break
        move, kept = -grad, []
        for s, y, sy in reversed(pairs):
            kept.append(s @ move / sy)
            move = move - kept[-1] * y
        move = move * (pairs[-1][2] / (pairs[-1][1] @ pairs[-1][1]) if pairs else 1 / np.linalg.norm(grad))
        for (s, y, sy), a in zip(pairs, reversed(kept), strict=True):
            move = move + (a - y @ move / sy) * s
        slope, step = float(grad @ move), 1.0
        new, new_grad = value_of(x + move)
        while not new <= value + 1e-4 * step * slope and step > 1e-6:
            step /= 2
            new, new_grad = value_of(x + step * move)
        if not new < value:
            break
        s, y = step * move, new_grad - grad
        x, value, grad = x + s, new, new_grad
        if s @ y > 1e-12 * (y @ y):
            pairs = [*pairs, (s, y, float(s @ y))][-memory:]
    return x


@dataclass
class Model:
    grades: list[float]
    cuts: np.ndarray  # ordered, one less than grades
    weights: np.ndarray

    def tails(self, z: np.ndarray) -> np.ndarray:
        """P(grade >= g) for every grade but the lowest, a column each."""
        return sigmoid(z[:, None] - self.cuts[None])


def cuts_of(free: np.ndarray) -> np.ndarray:
    """The first threshold, then the logarithms of the steps from one to the next."""
    return free[0] + np.append(0.0, np.cumsum(np.exp(free[1:])))


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, rating: str = "quality") -> Model:
    """The model of least mean loss + L2/2 |w|^2 over all ratings of documents whose crc32(doc_id) mod ``folds`` is not 0.

    Every rating counts, also several of one document. Each step of L-BFGS sums loss and gradient over the whole
    table of features, which is written once; the driver holds WIDTH numbers a vector.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "quality")
    rated = labels.select("doc_id", F.col(rating).cast("double").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~F.isnan("y") & (id_hash_mod("doc_id", folds) != 0))
    met = docs.select("doc_id", "text").join(rated, "doc_id").select("text", "y")

    def build(batches):
        known = WordHash()
        for pdf in batches:
            first, y = 0, pdf["y"].to_numpy()
            for n, doc, at, value in features(pdf["text"].tolist(), known):
                ends = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(y[first : first + n]), pa.ListArray.from_arrays(pa.array(ends), pa.array(at)), pa.ListArray.from_arrays(pa.array(ends), pa.array(value))], ["y", "at", "value"])
                first += n

    def built(batches):
        return build(b.to_pandas() for b in batches)

    table = scratch.keep(met.mapInArrow(built, "y double, at array<int>, value array<float>"))
    sizes = {r["y"]: r["count"] for r in table.groupBy("y").count().collect()}
    grades, rows = sorted(sizes), sum(sizes.values())
    steps = len(grades) - 1
    if steps < 1:
        scratch.drop(table)
        return Model(grades, np.zeros(0), np.zeros(WIDTH))

    def value_of(x: np.ndarray) -> tuple[float, np.ndarray]:
        shared = spark.sparkContext.broadcast((x[:WIDTH], cuts_of(x[WIDTH:]), np.array(grades)))

        def part(batches):
            w, cuts, known = shared.value
            grad, last = np.zeros(WIDTH), np.zeros(steps + 1)
            for b in batches:
                at, value = b.column("at"), b.column("value").flatten().to_numpy(zero_copy_only=False).astype(float)
                row = np.repeat(np.arange(len(b)), np.diff(at.offsets.to_numpy()))
                at = at.flatten().to_numpy(zero_copy_only=False)
                z = np.bincount(row, weights=w[at] * value, minlength=len(b))
                total, by_z, by_cut = loss(z, np.searchsorted(known, b.column("y").to_numpy(zero_copy_only=False)), cuts)
                grad += np.bincount(at, weights=by_z[row] * value, minlength=WIDTH)
                last += np.append(by_cut, total)
            every = np.append(grad, last)
            used = np.flatnonzero(every)
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(every[used])], ["at", "g"])

        got = table.mapInArrow(part, "at int, g double").groupBy("at").agg(F.sum("g").alias("g")).toPandas()
        shared.destroy()
        every = np.zeros(WIDTH + steps + 1)
        every[got["at"].to_numpy()] = got["g"].to_numpy()
        every /= rows
        by_cut = every[WIDTH:-1]
        by_free = np.cumsum(by_cut[::-1])[::-1] * np.append(1.0, np.exp(x[WIDTH + 1 :]))
        return every[-1] + L2 / 2 * float(x[:WIDTH] @ x[:WIDTH]), np.append(every[:WIDTH] + L2 * x[:WIDTH], by_free)

    below = np.cumsum([sizes[g] for g in grades])[:-1] / rows
    start = np.log(below / (1 - below))
    x0 = np.concatenate([np.zeros(WIDTH), start[:1], np.log(np.diff(start))])
    x = minimise(value_of, x0)
    scratch.drop(table)
    return Model(grades, cuts_of(x[WIDTH:]), x[:WIDTH])


def grade(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, expected, tails, predicted for every row of docs, over its whole text; null texts count as empty.

    expected is the expected grade, tails has P(grade >= g) for each grade g but the lowest, in order, and predicted is the
    highest grade reached with probability 0.5. Without ratings expected and predicted are null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, folds))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        model, known = shared.value, WordHash()
        grades = np.array(model.grades or [np.nan])
        for pdf in batches:
            z = [np.bincount(doc, weights=model.weights[at] * value, minlength=n) for n, doc, at, value in features(pdf["text"].tolist(), known)]
            tails = model.tails(np.concatenate(z) if z else np.zeros(0))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "expected": grades[0] + tails @ np.diff(grades), "tails": list(tails), "predicted": grades[(tails >= 0.5).sum(axis=1)]})

    out = docs.select("doc_id", (id_hash_mod("doc_id", folds) == 0).alias("held_out"), "text").mapInPandas(run, f"doc_id {kind}, held_out boolean, expected double, tails array<double>, predicted double")
    return out.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in ("expected", "predicted")})
