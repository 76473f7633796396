"""Caches, batches and the checks on generated lines."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pandas as pd
import yaml
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..sources.tables import written

RULES = yaml.safe_load((Path(__file__).parent.parent / "functions" / "line_contract.yml").read_text(encoding="utf-8"))
BULLET, PREAMBLE, MARKDOWN, TAIL, END = (RULES[k] for k in ("bullet", "preamble", "markdown", "tail", "end"))
UNUSABLE = tuple(RULES["unusable"])
OVERHEAD = 64


def cache_key(*parts: Column) -> Column:
    return F.left(F.sha2(F.concat_ws("\x1f", *parts), 256), F.lit(32))


def lookup(df: DataFrame, cache: DataFrame, key: str, now: Column, ttl_days: int = 14) -> DataFrame:
    """df with cached value and cache_state hit, stale or miss; the cache has (key, value, created_at). Spark broadcasts a
    small cache by its size."""
    fresh = F.col("created_at").isNotNull() & (now - F.col("created_at") <= F.expr(f"interval {ttl_days} days")) & (now >= F.col("created_at"))
    met = df.join(cache, key, "left")
    return met.withColumn("cache_state", F.when(F.col("value").isNull(), "miss").when(F.coalesce(fresh, F.lit(False)), "hit").otherwise("stale"))


def trim_cache(cache: DataFrame, order: str, keep: int) -> DataFrame:
    """The last ``keep`` inserted entries: a top-k, never a full sort."""
    return cache.orderBy(F.desc(order)).limit(keep)


def merge_cache(old: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """One entry per key, the last inserted."""
    both = old.unionByName(new)
    return both.groupBy(key).agg(F.max_by(F.struct(*[c for c in both.columns if c != key]), order).alias("v")).select(key, "v.*")


def fixed_batches(df: DataFrame, order: str, size: int, group: str) -> DataFrame:
    """Batches of at most ``size`` rows of each group in order."""
    return df.withColumn("batch_no", F.floor((F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1) / size).cast("int"))


def fitted(text: Column, max_chars: int = 146_000, overhead: int = 2_000, least_body: int = 200) -> Column:
    """The text with white space collapsed, cut to what one request can hold at a sentence or word; null if that is less than ``least_body``."""
    room = max_chars - overhead - OVERHEAD
    return tx.cut_at_sentence(tx.collapse(F.coalesce(text, F.lit(""))), room) if room >= least_body else F.lit(None).cast("string")


class Closing:
    """Where batches close in a stretch of rows, given the sizes of up to ``max_items`` rows before it, which an open batch may hold."""

    def __init__(self, before: list[int], sizes: np.ndarray, max_items: int, room: int):
        self.lead = len(before)
        total = np.append(0, np.cumsum(np.append(np.array(before, dtype=np.int64), sizes)))
        self.n = len(total) - 1
        at = np.arange(self.n)
        full = np.searchsorted(total, total[:-1] + room, side="right") - 1
        self.next = np.maximum(at + 1, np.minimum(at + max_items, full))

    def starts(self, held: int) -> list[int]:
        """Where batches start, from the one that holds the last ``held`` rows before the stretch on."""
        out = [self.lead - held]
        while out[-1] < self.n and self.next[out[-1]] < self.n:
            out.append(int(self.next[out[-1]]))
        return out

    def through(self) -> tuple[list[int], list[int]]:
        """For 0, 1, ... rows held before: how many are held after, and how many batches have closed."""
        ends = [self.starts(held) for held in range(self.lead + 1)]
        return [self.n - x[-1] for x in ends], [len(x) - 1 for x in ends]

    def numbers(self, held: int, first: int) -> np.ndarray:
        """The batch of each row of the stretch, the open one before it being ``first``."""
        return first + np.searchsorted(self.starts(held), np.arange(self.lead, self.n), side="right") - 1


def budget_batches(df: DataFrame, order: str, chars: str, group: str, max_items: int = 25, max_chars: int = 146_000, overhead: int = 2_000, least_body: int = 200) -> DataFrame:
    """(group, order, fitted_chars, batch_no): batches in order within each group, closed by whichever comes first, the number of rows or of
    characters; a row too large alone counts as cut to the budget (``fitted`` cuts it), and has no batch if the budget leaves less than ``least_body``.

    Rows are dealt by ranges of (group, order), so a large group is many stretches, each in a task of its own. What a stretch does is a
    small table: for every number of rows that an open batch may hold when it begins, how many are held at its end and how many batches have
    closed. These tables are applied one after the other in each group, a row a stretch, and each stretch then numbers its batches.
    ``order`` has no ties within a group."""
    room = max_chars - overhead
    size = F.least(F.coalesce(F.col(chars), F.lit(0)).cast("long"), F.lit(room - OVERHEAD).cast("long")) + OVERHEAD
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    dealt = written(df.select(group, order, key.alias("_g"), size.alias("_size")).repartitionByRange("_g", order).withColumn("_part", F.spark_partition_id()))
    last = F.row_number().over(Window.partitionBy("_g", "_part").orderBy(F.desc(order)))
    tails = dealt.withColumn("_n", last).where(F.col("_n") <= max_items).groupBy("_g", "_part").agg(F.transform(F.array_sort(F.collect_list(F.struct(order, "_size"))), lambda x: x["_size"]).alias("_tail"))
    few = F.flatten(F.collect_list("_tail").over(Window.partitionBy("_g").orderBy("_part").rowsBetween(-max_items, -1)))
    before = written(tails.select("_g", "_part", F.slice(few, F.greatest(F.size(few) - max_items + 1, F.lit(1)), max_items).alias("_before")))

    def closing(own: pd.DataFrame, side: pd.DataFrame) -> Closing:
        return Closing(list(side["_before"].iloc[0]), own["_size"].to_numpy(), max_items, room)

    def through(own: pd.DataFrame, side: pd.DataFrame) -> pd.DataFrame:
        held, closed = closing(own.sort_values(order), side).through()
        return pd.DataFrame({"_g": [own["_g"].iloc[0]], "_part": [own["_part"].iloc[0]], "held": [held], "closed": [closed]})

    def entered(pdf: pd.DataFrame) -> pd.DataFrame:
        held, first, out = 0, 0, []
        for part, after, closed in pdf.sort_values("_part")[["_part", "held", "closed"]].itertuples(index=False):
            out.append((part, held, first))
            held, first = int(after[held]), first + int(closed[held])
        return pd.DataFrame(out, columns=["_part", "held", "first"]).assign(_g=pdf["_g"].iloc[0])[["_g", "_part", "held", "first"]]

    types = {f.name: f.dataType.simpleString() for f in df.schema}
    keys = ["_g", "_part"]
    stretches = dealt.groupBy(*keys).cogroup(before.groupBy(*keys)).applyInPandas(through, "_g string, _part int, held array<int>, closed array<long>")
    entries = written(before.join(stretches.groupBy("_g").applyInPandas(entered, "_g string, _part int, held int, first long"), keys))

    def number(own: pd.DataFrame, side: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(order)
        made = closing(own, side).numbers(int(side["held"].iloc[0]), int(side["first"].iloc[0]))
        return pd.DataFrame({group: own[group], order: own[order], "fitted_chars": own["_size"] - OVERHEAD, "batch_no": made if room - OVERHEAD >= least_body else [None] * len(own)})

    return dealt.groupBy(*keys).cogroup(entries.groupBy(*keys)).applyInPandas(number, f"{group} {types[group]}, {order} {types[order]}, fitted_chars long, batch_no int")


def line_flags(line: Column, max_chars: int = 90) -> dict[str, Column]:
    """Which rules of the line contract a line breaks."""
    s = F.trim(F.coalesce(line, F.lit("")))
    head = F.regexp_replace(s, TAIL, "")
    return {
        "is_empty": s == "", "has_break": F.coalesce(line, F.lit("")).rlike(r"[\n\r\t]"), "too_long": F.length(s) > max_chars,
        "has_bullet": tx.mask_dots(s).rlike(BULLET), "has_markdown": s.rlike(MARKDOWN), "has_preamble": s.rlike(PREAMBLE),
        "no_end": ~s.rlike(TAIL), "many_sentences": tx.mask_dots(head).rlike(END),
    }


def valid_lines(lines: Column, title: Column, max_chars: int = 90) -> Column:
    """Whether an array of lines is three sound, different sentences, none of them the title."""

    def bad(x):
        out = F.lit(False)
        for f in line_flags(x, max_chars).values():
            out = out | f
        return out

    key = lambda x: tx.plain_title(F.regexp_replace(x, r"[^\p{L}\p{N}]+", " "))
    keys = F.transform(lines, key)
    return F.coalesce((F.size(lines) == 3) & ~F.exists(lines, bad) & (F.size(F.array_distinct(keys)) == 3) & ~((key(title) != "") & F.array_contains(keys, key(title))), F.lit(False))


def check_responses(requested: DataFrame, responses: DataFrame, max_chars: int = 90) -> DataFrame:
    """(batch, id, outcome) per requested id and per rejected entry.

    requested: (batch, id, title); responses: (batch, body) with JSON {"summaries": [{id, usable, reason, lines}]}. Outcomes:
    accepted, content_rejected, or the first contract the entry breaks; ids without a resolved entry are missing_id."""
    shape = "struct<summaries: array<struct<id: string, usable: boolean, reason: string, lines: array<string>>>>"
    parsed = responses.select("batch", F.from_json("body", shape).alias("j"))
    entries = parsed.select("batch", F.posexplode("j.summaries").alias("pos", "e")).select("batch", "pos", F.trim("e.id").alias("id"), "e.usable", F.trim("e.reason").alias("reason"), "e.lines")
    met = entries.join(requested.select("batch", "id", "title", F.lit(True).alias("asked")), ["batch", "id"], "left")
    base = (F.when(F.col("id").isNull(), "id_not_string").when(F.col("asked").isNull(), "unknown_id").when(F.col("usable").isNull() | F.col("reason").isNull(), "usable_contract")
            .when(~F.col("usable") & ~F.col("reason").isin(*UNUSABLE), "unusable_reason_conflict").when(~F.col("usable") & (F.size(F.coalesce("lines", F.array().cast("array<string>"))) > 0), "unusable_lines_present")
            .when(~F.col("usable"), "content_rejected").when(F.col("reason") != "ok", "usable_reason_conflict").when(~valid_lines(F.col("lines"), F.col("title"), max_chars), "line_contract").otherwise("accepted"))
    ranked = met.withColumn("outcome", base).withColumn("solved", F.col("outcome").isin("accepted", "content_rejected"))
    before = F.max(F.col("solved").cast("int")).over(Window.partitionBy("batch", "id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    done = ranked.withColumn("outcome", F.when((F.col("asked")) & (F.coalesce(before, F.lit(0)) == 1), "duplicate_id").otherwise(F.col("outcome")))
    answered = done.where(F.col("outcome").isin("accepted", "content_rejected")).select("batch", "id")
    entries_of = done.select("batch", "id", "outcome")
    seen = done.where("asked").select("batch", "id").distinct()
    missing = requested.select("batch", "id").join(answered, ["batch", "id"], "left_anti").join(seen, ["batch", "id"], "left_anti").withColumn("outcome", F.lit("missing_id"))
    return entries_of.union(missing)


def split_ladder(n: int, ladder: tuple[int, ...] = (25, 10, 1)) -> list[int]:
    """The batch sizes tried for n failed items: the steps of the ladder below n, and at last one by one."""
    return [s for s in ladder if s < n] or [1]
