"""Facets, interactive search, retention, report files and the run funnel."""

from __future__ import annotations

import datetime as dt
import html

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx


def facets(tagged: DataFrame) -> DataFrame:
    """(facet, name, n): sectors, topics and rows without topic."""
    names = F.when(F.size("topics") > 0, F.col("topics")).otherwise(F.array(F.lit("none")))
    both = F.concat(F.array(F.struct(F.lit("sector").alias("facet"), F.col("sector").alias("name"))), F.transform(names, lambda x: F.struct(F.lit("topic").alias("facet"), x.alias("name"))))
    return tagged.select(F.explode(both).alias("x")).groupBy("x.facet", "x.name").agg(F.count("*").alias("n"))


def search(tagged: DataFrame, query: str = "", sector: str | None = None, topic: str | None = None, sort: str = "newest", page: int = 1, per_page: int = 20, top: DataFrame | None = None, favourites: DataFrame | None = None) -> DataFrame:
    """A page of rows holding any of the query's words in title, description or topics; of top (ingest_seq) or of favourites (link) only, if given."""
    if top is not None:
        tagged = tagged.join(top.select("ingest_seq"), "ingest_seq", "left_semi")
    if favourites is not None:
        tagged = tagged.join(favourites.select("link"), "link", "left_semi")
    out = tagged.withColumn("hay", F.lower(F.concat_ws(" ", "title", "description", F.array_join("topics", " "))))
    if words := query.lower().split():
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains("hay", F.lit(w))
        out = out.where(hit)
    if sector:
        out = out.where(F.col("sector") == sector)
    if topic:
        out = out.where(F.array_contains("topics", topic))
    order = [F.desc("pub_date"), F.asc("ingest_seq")] if sort == "newest" else [F.desc("score"), F.desc("pub_date"), F.asc("ingest_seq")]
    return out.orderBy(*order).offset((page - 1) * per_page).limit(per_page).drop("hay")


def file_date(name: Column) -> Column:
    """The date in a file name; null if there is none or it is no date."""
    return F.try_to_date(F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1))


def eligible_files(files: DataFrame, report_date: dt.date, lookback_days: int = 91, max_files: int = 91, needed: list[str] = ()) -> DataFrame:
    """files (name, and columns if known) with file_date and reason: included, no_date, current_or_future, outside_lookback, missing_columns
    (where ``needed`` ones lack) or beyond_max_files."""
    day = F.lit(report_date)
    out = files.withColumn("file_date", file_date(F.col("name")))
    lacking = F.size(F.array_except(F.array(*map(F.lit, needed)), "columns")) > 0 if needed else F.lit(False)
    reason = F.when(F.col("file_date").isNull(), "no_date").when(F.col("file_date") >= day, "current_or_future").when(F.col("file_date") < F.date_sub(day, lookback_days), "outside_lookback").when(lacking, "missing_columns").otherwise("included")
    out = out.withColumn("reason", reason)
    rank = F.row_number().over(Window.partitionBy("reason").orderBy(F.desc("file_date"), F.desc("name")))
    return out.withColumn("reason", F.when((F.col("reason") == "included") & (rank > max_files), "beyond_max_files").otherwise(F.col("reason")))


def retained(files: DataFrame, today: dt.date, days: int = 180, artefact_days: int = 90, artefact: str = r"^_") -> DataFrame:
    """Files to keep: undated ones and those not older than ``days``, or ``artefact_days`` where the name is that of an artefact."""
    day = file_date(F.col("name"))
    limit = F.when(F.col("name").rlike(artefact), F.date_sub(F.lit(today), artefact_days)).otherwise(F.date_sub(F.lit(today), days))
    return files.where(day.isNull() | (day >= limit))


def markdown(tagged: DataFrame, title: str, per_sector: int = 10) -> DataFrame:
    """(section_no, item_no, line) of a report: sectors by first appearance, newest rows first; write ordered by the numbers."""
    first = tagged.groupBy("sector").agg(F.min("ingest_seq").alias("first")).withColumn("section_no", F.row_number().over(Window.orderBy("first")))
    rank = F.row_number().over(Window.partitionBy("sector").orderBy(F.desc("pub_date"), "ingest_seq"))
    items = tagged.withColumn("item_no", rank).where(F.col("item_no") <= per_sector).join(F.broadcast(first), "sector")
    body = items.select("section_no", "item_no", F.concat(F.lit("- ["), tx.markdown_escape(tx.shorten(F.col("title"), 90)), F.lit("]("), F.col("link"), F.lit(")")).alias("line"))
    heads = first.select("section_no", F.lit(0).alias("item_no"), F.concat(F.lit("## "), tx.markdown_escape(F.col("sector"))).alias("line"))
    top = tagged.sparkSession.createDataFrame([(0, 0, f"# {title}")], "section_no int, item_no int, line string")
    return top.union(heads).union(body)


def html_report(rows: list[dict], title: str, facet_rows: list[dict] = ()) -> str:
    """The report page over at most a few hundred collected rows, with facets (facet, name, n) by number, then name."""
    e = lambda x: html.escape(str(x if x is not None else ""), quote=True)
    cards = "\n".join(f'<article class="card" data-sector="{e(r["sector"])}" data-topics="{e(";".join(r["topics"]))}" data-score="{e(r["score"])}"><a href="{e(r["link"])}">{e(r["title"])}</a><p>{e(r["description"])}</p></article>' for r in rows)
    named = lambda kind: " ".join(f'<button data-{kind}="{e(f["name"])}">{e(f["name"])} ({f["n"]})</button>' for f in sorted(facet_rows, key=lambda f: (-f["n"], f["name"])) if f["facet"] == kind)
    sides = "\n".join(f'<nav class="{kind}">{named(kind)}</nav>' for kind in ("sector", "topic"))
    return f"<!doctype html><html><head><meta charset=utf-8><title>{e(title)}</title></head><body><h1>{e(title)}</h1>\n{sides}\n{cards}\n</body></html>"


def write_report(tagged: DataFrame, title: str, folder: str, name: str, most: int = 400) -> None:
    """The report of the newest ``most`` rows, as name.md and name.html, both written by Spark to the folder."""
    lines = markdown(tagged, title)
    lines.orderBy("section_no", "item_no").select("line").coalesce(1).write.mode("overwrite").text(f"{folder}/{name}.md")
    rows = [r.asDict() for r in tagged.orderBy(F.desc("pub_date"), "ingest_seq").limit(most).select("link", "title", "description", "sector", "topics", "score").collect()]
    page = html_report(rows, title, [r.asDict() for r in facets(tagged).collect()])
    tagged.sparkSession.createDataFrame([(page,)], "page string").coalesce(1).write.mode("overwrite").option("lineSep", "\n").text(f"{folder}/{name}.html")


def newest_reports(names: DataFrame, n: int = 14) -> DataFrame:
    return names.orderBy(F.desc("name")).limit(n)


def funnel(raw: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """One row of stage counts in one pass; a stage is a condition over raw rows."""
    return raw.agg(F.count("*").alias("raw"), *[F.count_if(c).alias(k) for k, c in stages.items()])


# The counts that a run reports, in order.
RUN_COUNTS = ("raw_items", "normalized_articles", "deduped_articles", "rule_filtered_articles", "relevance_filtered_articles", "tagged_before_cluster", "final_tagged_representatives", "displayed_articles")


def run_counts(recorded: DataFrame, before_cluster: DataFrame, final: DataFrame) -> DataFrame:
    """One row of RUN_COUNTS: what was recorded (rows stage, n; the last by n of a stage, 0 where it is no whole number), else what the
    articles before and after clustering tell, else 0. Shown are the final ones unless recorded."""
    told = recorded.groupBy().agg(*[F.max(F.when(F.col("stage") == k, F.coalesce(F.col("n").cast("string").try_cast("long"), F.lit(0)))).alias(k) for k in RUN_COUNTS])
    seen = before_cluster.agg(F.count("*").alias("_before")).crossJoin(final.agg(F.count("*").alias("_final")))  # a row each
    inferred = {"tagged_before_cluster": F.col("_before"), "final_tagged_representatives": F.col("_final"), "displayed_articles": F.col("_final")}
    return told.crossJoin(seen).select(*[F.coalesce(k, inferred.get(k, F.lit(0))).cast("long").alias(k) for k in RUN_COUNTS])
