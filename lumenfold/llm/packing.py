"""Packing documents into fixed-length sequences by a configuration linear program over the length histogram.

Only lengths matter to a packing, so the problem is the histogram of at most ``capacity`` lengths, however
many documents there are. A configuration is a multiset of lengths that fits one sequence. The covering
program over all configurations is solved by multiplicative weights over lengths; knapsack dynamic programs price
configurations and give dual bounds. The solution is rounded, the rest is solved again, and best fit packs
what remains. Pieces then find their place by their rank among pieces of equal length.
"""

from __future__ import annotations

import math
import os
import struct
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch
from .tokens import ByteIds

TOKENIZER, END_ID, CAPACITY = "byte_bpe_50k.json", 2, 1024
RATES = (0.1, 0.05, 0.02, 0.01, 0.005)  # of the program
STEPS, AGAIN = 30_000, 0.7  # steps after which no finer rate is tried; the share of items left up to which they are solved again
SALT_ROWS = 20_000

Config = tuple[tuple[int, int], ...]  # (length, how many), longest first


class Knapsack:
    """The most value that fits each capacity when value[k] is that of length k, any number of times; value[0] is unused."""

    def __init__(self, value: np.ndarray):
        capacity, each = len(value) - 1, value[1:]
        best, taken = np.zeros(capacity + 1), [0] * (capacity + 1)
        for c in range(1, capacity + 1):
            made = each[:c] + best[c - 1 :: -1]
            k = int(made.argmax())
            best[c], taken[c] = (made[k], k + 1) if made[k] > best[c - 1] else (best[c - 1], 0)
        self.best, self.taken = best, taken

    def config(self, room: int) -> Counter:
        """The lengths of the best filling of that room."""
        out: Counter = Counter()
        while room > 0:
            k = self.taken[room]
            if k:
                out[k] += 1
            room -= k or 1
        return out

    def around(self, k: int) -> Config:
        """The best configuration of those that hold length k."""
        found = self.config(len(self.taken) - 1 - k)
        found[k] += 1
        return tuple(sorted(found.items(), reverse=True))


def program(demand: np.ndarray, rate: float = RATES[1]) -> tuple[dict[Config, float], float, int]:
    """(amounts of configurations that cover the demand, a lower bound of the program's value, steps), by multiplicative weights.

    A length's weight falls by exp(-rate) each time its whole demand is covered once more, and is 0 once it is covered 2 / rate times.
    A step adds as much of a configuration as covers one of its lengths once; every configuration within a share ``rate`` of the
    greatest weight may be taken. The greatest weight comes from a knapsack over all lengths, which gives the best
    configuration around every length at once; weights only fall, so it stands until none of the configurations known is near it. Weights w
    give the dual bound demand.w / (greatest weight of a configuration), and the best bound counts. At last all amounts are divided
    by the least coverage. It ends when every length is covered, whatever their number.
    """
    at = (np.flatnonzero(demand[1:]) + 1).tolist()
    capacity, target = len(demand) - 1, 2 / rate
    d = {k: float(demand[k]) for k in at}
    w, cover, amount, pool, lower, steps = {k: k / capacity for k in at}, dict.fromkeys(at, 0.0), Counter(), {}, 0.0, 0
    value = np.zeros(capacity + 1)
    while any(w.values()):
        value[at] = [w[k] for k in at]
        sack = Knapsack(value)
        most = float(sack.best[capacity])
        lower = max(lower, sum(d[k] * w[k] for k in at) / most)
        least = most * (1 - rate)
        ks = np.array(at)
        for k in ks[(value[ks] > 0) & (value[ks] + sack.best[capacity - ks] >= least)].tolist():
            pool[sack.around(k)] = None
        for config in pool:
            while sum(w[k] * a for k, a in config) >= least:
                step = min(d[k] / a for k, a in config if w[k] > 0)
                amount[config] += step
                steps += 1
                for k, a in config:
                    cover[k] += a * step / d[k]
                    w[k] = w[k] * math.exp(-rate * a * step / d[k]) if cover[k] < target else 0.0
    return {c: x / min(cover.values()) for c, x in amount.items()}, lower, steps


def _fill(left: np.ndarray, room: int) -> list[int]:
    """Lengths to put beside others into room: one or two that fill it, else the longest that fits, and so on."""
    out: list[int] = []
    has = left > 0
    while room > 0:
        if has[room]:
            return [*out, room]
        pair = has[1:room] & has[room - 1 : 0 : -1]
        if pair.any():
            k = int(np.flatnonzero(pair)[-1]) + 1
            if k != room - k or left[k] >= 2:
                return [*out, k, room - k]
        fits = np.flatnonzero(has[: room + 1])
        if not len(fits) or not fits[-1]:
            return out
        k = int(fits[-1])
        out.append(k)
        room -= k
    return out


def best_fit(left: np.ndarray) -> list[tuple[Config, int]]:
    """Whole configurations holding all that is left, longest first; left is used up."""
    capacity, out = len(left) - 1, []
    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        left[longest] -= 1
        config = Counter(_fill(left, capacity - longest))
        left[longest] += 1
        config[longest] += 1
        while any(left[k] < a for k, a in config.items()):  # best fit may ask for more of a length than there is
            config = Counter({k: min(a, int(left[k])) for k, a in config.items()})
        made = tuple(sorted(config.items(), reverse=True))
        times = min(int(left[k]) // a for k, a in made)
        out.append((made, times))
        for k, a in made:
            left[k] -= a * times
    return out


def whole_parts(x: dict[Config, float], left: np.ndarray, up: bool = False) -> list[tuple[Config, int]]:
    """The amounts rounded down, or up for configurations that fill their sequence, largest first, as far as items are left; left loses them."""
    out, full = [], lambda c: sum(k * a for k, a in c)
    for config, n in sorted(x.items(), key=lambda i: (-full(i[0]) if up else 0, -i[1], i[0])):
        if up and full(config) < len(left) - 1:
            break
        times = min(math.ceil(n - 1e-9) if up else int(n + 1e-9), *(int(left[k]) // a for k, a in config))
        if times > 0:
            out.append((config, times))
            for k, a in config:
                left[k] -= a * times
    return out


def rounded(demand: np.ndarray) -> tuple[list[tuple[Config, int]], float]:
    """(whole numbers of configurations holding every item, a lower bound): the best rounding of the programs of several rates.

    A program's amounts are rounded down; what is left is solved again as a smaller program while that still gives many whole
    configurations, or full configurations are rounded up; best fit holds the rest. Rates fall until a rounding reaches the bound or STEPS
    have been taken; the first program is always whole."""
    whole = demand.astype(np.int64).copy()
    whole[0] = 0
    best, lower, taken = [], 0.0, 0
    for rate in RATES if whole.any() else ():
        x, bound, steps = program(whole, rate)
        lower, taken = max(lower, bound), taken + steps
        left, again, made = whole.copy(), x, []
        while again:
            before = left.sum()
            made += whole_parts(again, left)
            again = program(left, rate)[0] if left.any() and left.sum() <= AGAIN * before else {}
        up, filled = whole.copy(), []
        for rounding in (False, True):
            filled += whole_parts(x, up, rounding)
        best = min([m for m in (best, made + best_fit(left), filled + best_fit(up)) if m], key=lambda m: sum(n for _, n in m))
        if sum(n for _, n in best) <= math.ceil(lower - 1e-6) or taken > STEPS:
            break
    return best, lower


class Plan:
    """Where the pieces of each length go: segments of ranks, found by binary search."""

    def __init__(self, demand: np.ndarray):
        made, self.bound = rounded(demand)
        used, first, rows = Counter(), 0, []
        for config, times in made:
            at = 0
            for k, a in config:
                rows.append((k, used[k], a, first, at))
                used[k] += a * times
                at += k * a
            first += times
        self.sequences = first
        table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
        self.length, self.rank, self.per, self.first, self.at = table.T
        self.key = (self.length << 48) + self.rank

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the piece with that rank among those of its length."""
        seg = np.searchsorted(self.key, (length << 48) + rank, side="right") - 1
        i = rank - self.rank[seg]
        return self.first[seg] + i // self.per[seg], self.at[seg] + i % self.per[seg] * length


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of each piece: all of ``capacity``, but the first, which takes the remainder."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every row."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    end = struct.pack("<I", end_id)

    def run(batches):
        ids = ByteIds(tokenizer)
        for pdf in batches:
            at, rows = [], []
            texts = [t if isinstance(t, str) else "" for t in pdf["text"]]
            for first in range(0, len(texts), 256):
                for d, raw in enumerate(ids.batch(texts[first : first + 256]), first):
                    raw += end
                    view = memoryview(raw)
                    for k, (s, n) in enumerate(cut(len(raw) // 4, capacity)):
                        at.append(d)
                        rows.append((k, s, n, zlib.crc32(view[4 * s : 4 * (s + n)])))
            out = pd.DataFrame(rows, columns=["piece", "start", "length", "ids_crc32"])
            out.insert(0, "doc_id", pdf["doc_id"].iloc[at].reset_index(drop=True))
            yield out

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """All rows of docs packed: one row per piece with its sequence_id and its gapless offset there.

    Null and empty texts are the end token alone; repeated rows are packed as often as they occur; an empty
    table gives an empty result. The driver holds the histogram only. Ranks are taken within salted groups of
    a length and shifted by the counts of the groups before, so no length is gathered in one task.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "pack")
    cutting = scratch.keep(pieces(docs, tokenizer, end_id, capacity))
    hist = cutting.groupBy("length").count().collect()  # at most ``capacity`` rows
    demand = np.zeros(capacity + 1, dtype=np.int64)
    for r in hist:
        demand[r["length"]] = r["count"]
    salts = int(demand.sum()) // SALT_ROWS + 1
    salted = cutting.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    groups = salted.groupBy("length", "salt").count()
    before = groups.withColumn("shift", F.sum("count").over(Window.partitionBy("length").orderBy("salt")) - F.col("count")).drop("count")
    inside = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32"))
    ranked = salted.withColumn("inside", inside - 1).join(before, ["length", "salt"]).withColumn("rank", F.col("shift") + F.col("inside"))
    plan = spark.sparkContext.broadcast(Plan(demand))

    def run(batches):
        for pdf in batches:
            seq, at = plan.value.place(pdf["length"].to_numpy(), pdf["rank"].to_numpy())
            yield pdf.drop(columns="rank").assign(sequence_id=seq, offset=at)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return ranked.select(*names, "rank").mapInPandas(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
