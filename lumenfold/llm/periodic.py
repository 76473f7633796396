"""Periodic runs of words: maximal stretches that repeat a period at least three times.

All (period, grid point) pairs of a text are tried together. A run of period p and length at least max(24, 3p) has
more than max(24 - p, 2p) - 1 places i whose word equals the word p further on, so it holds a multiple of that
step: the grid of a period has n / step points, and those of all periods are a harmonic sum, O(n log n). Where a grid
point's word and the word p further on are equal, the longest common extensions to both sides are found for all pairs at
once by binary search over prefix hashes in NumPy. Every run so found is verified word by word; the least period of
equal stretches names the run.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, Scratch

LEAST, TIMES = 24, 3  # a run has at least max(LEAST, TIMES x period) words
BLOCK = 1 << 16  # grid points tried together; bounds memory, not what is found
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
WORDS = re.compile(WORD)

Run = tuple[int, int, int]  # start, length, period


class PrefixHashes:
    """Hashes modulo 2^64 of any stretches of words: equal stretches have equal hashes."""

    def __init__(self, ids: np.ndarray):
        n, one = len(ids), np.ones(1, np.uint64)
        self.power = one
        with np.errstate(over="ignore"):
            step = BASE
            while len(self.power) <= n:
                self.power = np.concatenate([self.power, self.power * step])
                step = step * step
            mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03)
            mixed ^= mixed >> np.uint64(29)
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * self.power[:n])])

    def equal(self, a: np.ndarray, shift: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the stretches from a and from a + shift have equal hashes."""
        b = a + shift
        with np.errstate(over="ignore"):
            return (self.sums[a + length] - self.sums[a]) * self.power[shift] == self.sums[b + length] - self.sums[b]

    def extensions(self, at: np.ndarray, shift: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """For each pair, how many words from ``at`` on (or before it, if back) equal those ``shift`` further on, ``most`` at most."""
        low, high = np.zeros_like(at), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.equal(at - middle if back else at, shift, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def _grid(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (period, grid point), by period."""
    period = np.arange(1, n // TIMES + 1)
    step = np.maximum((TIMES - 1) * period, LEAST - period)
    points = (n - period - 1) // step + 1
    ends = np.cumsum(points)
    first = 0
    while first < len(period):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + BLOCK, side="right")))
        many = points[first:last]
        begin = np.repeat(np.cumsum(many) - many, many)
        yield np.repeat(period[first:last], many), (np.arange(many.sum()) - begin) * np.repeat(step[first:last], many)
        first = last


def _exact(ids: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The stretch around ``at`` that has the period, word by word: (start, end)."""
    same = ids[:-period] == ids[period:]
    after, before = np.flatnonzero(~same[at:]), np.flatnonzero(~same[:at])
    return int(before[-1]) + 1 if len(before) else 0, (at + int(after[0]) if len(after) else len(same)) + period


def runs_of(ids: np.ndarray) -> list[Run]:
    """All maximal runs of a sequence of word numbers, by start, then period."""
    n = len(ids)
    if n < LEAST:
        return []
    hashes, least = PrefixHashes(ids), {}
    inside, until = np.ones(n, np.int64), np.zeros(n, np.int64)  # a run that holds the place: its period and end
    for period, at in _grid(n):
        hit = (ids[at] == ids[at + period]) & ((at + period >= until[at]) | (period % inside[at] != 0))  # a multiple of a run's period gives the same run
        period, at = period[hit], at[hit]
        ahead = hashes.extensions(at, period, n - at - period, False)
        behind = hashes.extensions(at, period, at, True)
        length = ahead + behind + period
        long = length >= np.maximum(LEAST, TIMES * period)
        found = np.unique(np.stack([(at - behind)[long], length[long], period[long], at[long]]), axis=1)
        for s, size, p, i in found.T.tolist():
            e = s + size
            if least.get((s, e), p + 1) <= p:
                continue
            if not np.array_equal(ids[s : e - p], ids[s + p : e]):
                s, e = _exact(ids, i, p)
            if e - s >= max(LEAST, TIMES * p) and least.get((s, e), p) >= p:
                least[s, e] = p
                inside[s:e], until[s:e] = p, e
    return sorted(((s, e - s, p) for (s, e), p in least.items()), key=lambda r: (r[0], r[2]))


def numbered(words: list[str]) -> np.ndarray:
    """Equal words get equal numbers."""
    return pd.factorize(np.array(words, dtype=object))[0].astype(np.int64) if words else np.zeros(0, np.int64)


def kept(n: int, runs: list[Run]) -> np.ndarray:
    """Which words stay when each run keeps its first period only."""
    depth = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return np.cumsum(depth[:n]) == 0


def strongest(runs: list[Run]) -> Run | None:
    """The run of greatest length / period, compared exactly; ties go to the smallest start, then period."""
    best = None
    for r in runs:
        if best is None or (r[1] * best[2], -r[0], -r[2]) > (best[1] * r[2], -best[0], -best[2]):
            best = r
    return best


def _read(batches, rewrite: Callable | None):
    for pdf in batches:
        rows = []
        for doc_id, text in zip(pdf["_id"], pdf["text"], strict=True):
            words = WORDS.findall(text) if isinstance(text, str) else []
            words = rewrite(words, doc_id) if rewrite else words
            rows.append((words, runs_of(numbered(words))))
        yield pdf, rows


def _rows(docs: DataFrame) -> tuple[DataFrame, str]:
    """doc_id, its decimal text (empty for null) and text; doc_id's type."""
    return docs.select("doc_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), "text"), docs.schema["doc_id"].dataType.simpleString()


def runs(docs: DataFrame) -> DataFrame:
    """doc_id, start, length, period (word numbers from 0) and the text of the first period, a row for each run of each row of docs."""
    rows, kind = _rows(docs)

    def run(batches):
        for pdf, found in _read(batches, None):
            made = [(k, s, n, p, " ".join(words[s : s + p])) for k, (words, all_runs) in enumerate(found) for s, n, p in all_runs]
            out = pd.DataFrame(made, columns=["at", "start", "length", "period", "words"])
            out.insert(0, "doc_id", pdf["doc_id"].iloc[out.pop("at").astype(int)].reset_index(drop=True))
            yield out

    return rows.mapInPandas(run, f"doc_id {kind}, start long, length long, period long, words string")


def collapsed(docs: DataFrame) -> DataFrame:
    """docs with each text that has runs replaced by its kept words, joined by one space; other texts and null stay as they are."""

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            out = []
            for text in s:
                words = WORDS.findall(text) if isinstance(text, str) else []
                all_runs = runs_of(numbered(words))
                out.append(" ".join(w for w, k in zip(words, kept(len(words), all_runs), strict=True) if k) if all_runs else text)
            yield pd.Series(out, dtype=object)

    fix = F.pandas_udf(run, "string")
    return docs.select(*[fix("text").alias("text") if c.lower() == "text" else c for c in docs.columns])


def digest(docs: DataFrame, rewrite: Callable[[list[str], str], list[str]] | None = None) -> DataFrame:
    """Per row of docs: n_runs, its strongest run, and digests of all runs and of the collapsed text.

    ``rewrite`` may change the words first, given the id in decimal (empty for null). Null, empty and blank texts have no
    words and no runs; repeated rows give equal rows; ties as in ``strongest``; an empty table gives an empty result; only
    doc_id and text are read. No row is shuffled; memory is bounded by one Arrow batch and its longest text.
    """
    rows, kind = _rows(docs)

    def run(batches):
        for pdf, found in _read(batches, rewrite):
            made = []
            for words, all_runs in found:
                best = strongest(all_runs)
                listed = "".join(f"{s},{n},{p}\n" for s, n, p in all_runs)
                text = " ".join(w for w, k in zip(words, kept(len(words), all_runs), strict=True) if k) if all_runs else " ".join(words)
                made.append((len(all_runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *(hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in (listed, text))))
            out = pd.DataFrame(made, columns=["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])
            for c in ("start", "length", "period", "exponent_milli"):
                out[c] = out[c].astype("Int64")
            out.insert(0, "doc_id", pdf["doc_id"].reset_index(drop=True))
            yield out

    scratch = Scratch(docs.sparkSession, "runs")
    return scratch.keep(rows.mapInPandas(run, f"doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"))
