"""What one run decides and records: which articles are summarised and from what, what is shown, gates, counters and settings."""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from .contracts import UNUSABLE

# The least characters of a snippet that is shown or kept, and reasons that stop a run before its first request.
LEAST_SNIPPET = 24
BEFORE_REQUESTS = ("disabled", "missing_api_key", "no_targets")
ATTEMPT_COUNTERS = ("batches", "requests", "normal_requests", "recovery_requests", "sent_articles", "sent_chars", "content_rejected", *UNUSABLE, "items_rejected", "api_error", "rate_limit_hits", "splits")


def sound_lines(lines: Column) -> Column:
    """Three lines, none blank, trimmed; else null."""
    return F.when((F.size(lines) == 3) & F.forall(lines, lambda x: F.trim(x) != ""), F.transform(lines, lambda x: F.trim(x)))  # F.trim itself would take the index as the characters to trim


def summary_state(lines: Column, rejection: Column) -> Column:
    """ai with three sound lines, content_rejected where they were refused, else preview."""
    return F.when(sound_lines(lines).isNotNull(), "ai").when(F.coalesce(rejection, F.lit("")) != "", "content_rejected").otherwise("preview")


def display_text(lines: Column, rejection: Column, source: Column, description: Column) -> Column:
    """The sound lines, else the source's own snippet if the text was refused and the snippet is long enough, else the description."""
    snippet, own = (F.trim(F.coalesce(c, F.lit(""))) for c in (source, description))
    refused = (F.coalesce(rejection, F.lit("")) != "") & (F.length(snippet) >= LEAST_SNIPPET)
    return F.coalesce(F.array_join(sound_lines(lines), " "), F.when(refused, snippet), own)


def summary_plan(df: DataFrame, max_done: int, max_attempts: int, url: str = "link", by: str = "pub_date", cached: str = "cached", works: str = "works") -> DataFrame:
    """Adds action: cached, summarised, failed, skipped (no attempts left), duplicate (no url, or one seen before) or done (enough summaries).

    Newest first, each url once; a cached text costs no attempt; works says whether an attempt gives a text. Only the first
    max_done + max_attempts cached rows and attempts can matter, so the running counts are over few rows of one task."""
    base = df.withColumn("_first", F.row_number().over(Window.partitionBy(url).orderBy(F.desc(by), "ingest_seq"))).withColumn("_u", (F.coalesce(url, F.lit("")) != "") & (F.col("_first") == 1))
    kinds = F.when(F.coalesce(cached, F.lit(False)), "hit").otherwise("try")
    order = [F.desc(by), F.asc("ingest_seq")]
    rows = base.where("_u").select("ingest_seq", by, kinds.alias("_k"), F.coalesce(works, F.lit(False)).alias("_w"))
    few = rows.where("_k = 'hit'").orderBy(*order).limit(max_done).union(rows.where("_k = 'try'").orderBy(*order).limit(max_attempts))
    run = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    gives = (F.col("_k") == "hit") | F.col("_w")
    acted = few.withColumn("_done", F.coalesce(F.sum(gives.cast("int")).over(run), F.lit(0))).where(F.col("_done") < max_done)
    last = acted.withColumn("action", F.when(F.col("_k") == "hit", "cached").when(F.col("_w"), "summarised").otherwise("failed")).select("ingest_seq", "action")
    end = few.where(gives).orderBy(*order).limit(max_done).agg(F.count("*").alias("_c"), F.max_by(F.struct(by, "ingest_seq"), F.struct((-F.unix_micros(F.col(by).cast("timestamp"))).alias("a"), "ingest_seq")).alias("_e"))
    met = base.join(last, "ingest_seq", "left").join(F.broadcast(end), F.lit(True), "left")
    beyond = (F.col("_c") >= max_done) & ((F.col(by) < F.col("_e")[by]) | ((F.col(by) == F.col("_e")[by]) & (F.col("ingest_seq") > F.col("_e.ingest_seq"))))
    action = F.when(F.coalesce(beyond, F.lit(False)), "done").when(~F.col("_u"), "duplicate").otherwise(F.coalesce("action", F.lit("skipped")))
    return met.withColumn("action", action).drop("_first", "_u", "_c", "_e")


def targets(first: DataFrame, rest: DataFrame, key: str, order: str, limit: int) -> DataFrame:
    """(key, place) of at most ``limit`` distinct rows: those of ``first`` in order, then those of ``rest``."""
    both = first.select(key, F.lit(0).alias("part"), order).union(rest.select(key, F.lit(1).alias("part"), order))
    best = both.groupBy(key).agg(F.min(F.struct("part", order)).alias("at")).orderBy("at").limit(limit)
    return best.withColumn("place", F.row_number().over(Window.orderBy("at"))).select(key, "place")


def input_body(df: DataFrame, least: int, budget: int, body: str = "body", fetched: str = "fetched", description: str = "description", order: str = "place") -> DataFrame:
    """Adds input and cacheable: the body at hand, else a fetched one while the fetch budget lasts, else the description, not to be cached.

    A text shorter than ``least`` is none. Every row without a body uses one fetch, in order; only the first ``budget`` of them get it."""
    at_hand = F.trim(F.coalesce(body, F.lit("")))
    asks = df.where(at_hand == "").select(order).orderBy(order).limit(budget).withColumn("_may", F.lit(True))
    got = df.join(asks, order, "left").withColumn("_b", F.when(at_hand != "", at_hand).when(F.col("_may"), F.trim(F.coalesce(fetched, F.lit("")))).otherwise(""))
    own = F.trim(F.coalesce(description, F.lit("")))
    full = F.length("_b") >= least
    return got.withColumns({"cacheable": full, "input": F.when(full, F.col("_b")).when(F.length(own) >= least, own).otherwise("")}).drop("_may", "_b")


def prompts(items: DataFrame, batch: str, instruction: str, line_chars: int = 90) -> DataFrame:
    """(batch, n_items, prompt, response_schema) per batch of (batch, place, id, title, body): instruction, then each item between its marks, brackets
    widened so that no text can close them. The schema asks for an entry per item at most."""
    item = F.concat(F.lit("<article id=\""), F.col("id"), F.lit("\">\n"), tx.widen_brackets(F.col("title")), F.lit("\n"), tx.widen_brackets(F.col("body")), F.lit("\n</article>"))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("place", item.alias("t")))), lambda x: x["t"])
    shape = json.dumps({"type": "object", "properties": {"summaries": {"type": "array", "maxItems": -1, "items": {"type": "object", "properties": {"id": {"type": "string"}, "usable": {"type": "boolean"}, "reason": {"enum": ["ok", *UNUSABLE]}, "lines": {"type": "array", "maxItems": 3, "items": {"type": "string", "maxLength": line_chars}}}, "required": ["id", "usable", "reason", "lines"]}}}, "required": ["summaries"]}, sort_keys=True)
    made = items.groupBy(batch).agg(F.count("*").alias("n_items"), F.concat(F.lit(instruction + "\n"), F.array_join(texts, "\n")).alias("prompt"))
    return made.withColumn("response_schema", F.replace(F.lit(shape), F.lit("-1"), F.col("n_items").cast("string")))


def retry_rounds(requested: DataFrame, outcomes: DataFrame, ladder: tuple[int, ...] = (25, 10, 1), size: int = 25) -> DataFrame:
    """(round, batch_no, id) of the batches sent again: ids of a failed batch, or of entries not solved, in batches of the ladder's next size.

    requested: (round, batch_no, place, id); outcomes: (round, batch_no, id, outcome), outcome failed, accepted or content_rejected."""
    met = requested.join(outcomes, ["round", "batch_no", "id"], "left")
    left = met.where(~F.coalesce("outcome", F.lit("missing_id")).isin("accepted", "content_rejected"))
    of = left.groupBy("round", "batch_no").agg(F.count("*").alias("n"))
    steps = F.filter(F.array(*map(F.lit, ladder)), lambda x: x < F.col("n"))
    step = F.when(F.size(steps) > 0, F.element_at(steps, 1)).otherwise(1)
    place = F.row_number().over(Window.partitionBy("round", "batch_no").orderBy("place")) - 1
    small = left.join(of.withColumn("step", step), ["round", "batch_no"]).withColumn("part", F.floor(place / F.col("step")))
    return small.select((F.col("round") + 1).alias("round"), F.concat_ws(".", "batch_no", "part").alias("batch_no"), "id")


def attempt_counters(log: DataFrame) -> DataFrame:
    """One row of sums over an attempt log (counter, n): every counter of the run, 0 where there is none."""
    return log.agg(*[F.coalesce(F.sum(F.when(F.col("counter") == c, F.col("n"))), F.lit(0)).cast("long").alias(c) for c in ATTEMPT_COUNTERS])


def run_summary(log: DataFrame, **facts) -> DataFrame:
    """The counters with the facts of the run (numbers, flags and names only), and the rows left to extractive summaries."""
    out = attempt_counters(log)
    for k, v in facts.items():
        out = out.withColumn(k, F.lit(v))
    return out.withColumn("extractive_fallback", F.col("targets") - F.col("applied"))


def run_gate(summary: DataFrame) -> DataFrame:
    """Adds status (ok, skipped, failed) and reason, from the counters of a run.

    Cached texts do not count as applied. A run switched off before any request is skipped, one that died later failed; sending
    nothing is only sound if the cache served every target; rejections excuse a run only if they cover all that was asked."""
    c = {k: F.coalesce(F.col(k), F.lit(0)) for k in ("targets", "sent_articles", "applied", "content_rejected", "cache_hits", "cache_miss", "skipped_no_body", "api_error")}
    off, fresh = F.coalesce(F.col("disabled_reason"), F.lit("")), F.greatest(c["applied"] - c["cache_hits"], F.lit(0))
    asked = F.when(c["cache_miss"] > 0, c["cache_miss"]).otherwise(c["sent_articles"])
    ladder = ((off.isin(*BEFORE_REQUESTS), "skipped", "disabled_before_requests"), (off != "", "failed", "disabled_mid_run"), (c["targets"] <= 0, "skipped", "no_targets"),
              ((c["sent_articles"] <= 0) & (c["cache_hits"] >= c["targets"]), "ok", "all_cached"), ((c["sent_articles"] <= 0) & (c["skipped_no_body"] >= c["targets"]), "skipped", "no_bodies"), (c["sent_articles"] <= 0, "skipped", "nothing_sent"),
              (fresh > 0, "ok", "applied"), ((c["content_rejected"] > 0) & (c["api_error"] == 0) & (c["content_rejected"] >= asked), "ok", "all_rejected"), (c["content_rejected"] > 0, "failed", "rejections_do_not_cover"))
    pick = F.coalesce(*[F.when(test, F.struct(F.lit(s).alias("status"), F.lit(r).alias("reason"))) for test, s, r in ladder], F.struct(F.lit("failed").alias("status"), F.lit("nothing_applied").alias("reason")))
    return summary.withColumn("_g", pick).withColumns({"status": F.col("_g.status"), "reason": F.col("_g.reason")}).drop("_g")


def undelivered(runs: DataFrame, markers: DataFrame, key: str = "report_date") -> DataFrame:
    """Runs without a delivery marker of their date."""
    return runs.join(markers.select(key), key, "left_anti")


def setting(name: str, default: float, low: float | None = None, high: float | None = None, env: dict[str, str] | None = None):
    """A number from the environment; the default where it is missing, unreadable, not finite or out of range."""
    raw = (os.environ if env is None else env).get(name, "").strip()
    try:
        value = type(default)(raw)
    except ValueError:
        return default
    sound = value == value and abs(value) != float("inf") and (low is None or value >= low) and (high is None or value <= high)
    return value if sound else default
