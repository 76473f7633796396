"""Article records: projection, collection windows, duplicates by title and their representatives."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..sources.tables import checkpointed

KST = dt.timezone(dt.timedelta(hours=9))


def from_documents(docs: DataFrame) -> DataFrame:
    """Articles over the documents table: the whole first line is the title, all that follows it the description."""
    cut = F.instr("text", "\n")
    rest = F.when(cut > 0, F.substr("text", cut + 1)).otherwise("")
    return docs.where(F.col("text").isNotNull()).select(
        "doc_id", F.col("doc_id").alias("ingest_seq"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"), rest.alias("description"),
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("link"), F.col("lang").alias("query"), F.col("source").alias("press"),
        F.timestamp_add("MINUTE", F.col("doc_id").cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("pub_date"),
        ((F.col("doc_id") * 7919) % 1000 / 1000.0).alias("prob"), "text")


def normalize(raw: DataFrame) -> DataFrame:
    """Rows with a title and a link, trimmed; the description is kept as source_description."""
    out = raw.withColumns({c: F.trim(c) for c in ("title", "link", "description") if c in raw.columns})
    return out.where((F.coalesce("title", F.lit("")) != "") & (F.coalesce("link", F.lit("")) != "")).withColumn("source_description", F.col("description"))


def rule_text(title: Column, description: Column, query: Column) -> Column:
    return tx.normalize(F.concat_ws(" ", title, description, query))


def score_text(title: Column, summary: Column) -> Column:
    return tx.normalize(F.concat_ws("\n", F.trim(title), F.trim(summary)))


def model_text(title: Column, summary: Column) -> Column:
    return F.concat_ws("\n", title, title, summary)


def collection_window(date: str, hour_minute: str = "09:00", hours: float = 24, overlap_minutes: int = 15, now: dt.datetime | None = None) -> tuple[dt.datetime, dt.datetime]:
    """[start, end) of a run: end is date at hour_minute (a day earlier if that is later than now)."""
    if not (len(hour_minute) == 5 and hour_minute[2] == ":"):
        raise ValueError("the time must be HH:MM")
    end = dt.datetime.strptime(f"{date} {hour_minute}", "%Y-%m-%d %H:%M").replace(tzinfo=KST)
    if now is not None and end > now:
        end -= dt.timedelta(days=1)
    return end - dt.timedelta(hours=hours) - dt.timedelta(minutes=overlap_minutes), end


def in_window(df: DataFrame, column: str, start, end) -> DataFrame:
    return df.where((F.col(column) >= F.lit(start)) & (F.col(column) < F.lit(end)))


def newest_per_query(df: DataFrame, query: str, ts: str, tie: str, n: int) -> DataFrame:
    """At most n newest rows per query; Spark prunes within partitions before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(query).orderBy(F.desc(ts), tie))
    return df.withColumn("_n", rank).where(F.col("_n") <= n).drop("_n")


def first_per(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def dedup_exact(articles: DataFrame) -> DataFrame:
    """First occurrence by lower-case title and link."""
    return first_per(articles.withColumn("_k", F.concat(F.lower("title"), F.lit("|"), F.col("link"))), ["_k"], ["ingest_seq"]).drop("_k")


def title_groups(articles: DataFrame) -> DataFrame:
    """Articles with cluster_key, cluster_size, rank in the group and first_seq, the group's first sequence number.

    The representative (rank 1) is the newest, then the one with the longest description, then one with a link,
    then the first."""
    keyed = with_key(articles)
    best = Window.partitionBy("cluster_key").orderBy(F.desc("pub_date"), F.desc(F.length(F.trim(F.coalesce("description", F.lit(""))))), F.desc(F.coalesce("link", F.lit("")) != ""), "ingest_seq")
    whole = Window.partitionBy("cluster_key")
    return keyed.withColumns({"rank": F.row_number().over(best), "cluster_size": F.count("*").over(whole), "first_seq": F.min("ingest_seq").over(whole)})


def with_key(articles: DataFrame) -> DataFrame:
    """Articles with normalized_title and cluster_key, by which titles count as the same."""
    keyed = articles.withColumn("normalized_title", tx.title_key(F.col("title")))
    return keyed.withColumn("cluster_key", F.when(F.col("normalized_title") != "", F.col("normalized_title")).otherwise(F.concat(F.lit("title:"), F.lower(F.trim("title")))))


def representatives(articles: DataFrame) -> DataFrame:
    """One row per title group with its cluster_size and first_seq; only keys are grouped, the chosen rows are joined back by their number."""
    keyed = with_key(articles)
    order = F.struct(F.col("pub_date").alias("p"), F.length(F.trim(F.coalesce("description", F.lit("")))).alias("l"), (F.coalesce("link", F.lit("")) != "").alias("k"), (-F.col("ingest_seq")).alias("s"))
    groups = keyed.select("cluster_key", "ingest_seq", order.alias("o")).groupBy("cluster_key").agg(F.max_by("ingest_seq", "o").alias("ingest_seq"), F.count("*").alias("cluster_size"), F.min("ingest_seq").alias("first_seq"))
    return keyed.join(groups.drop("cluster_key"), "ingest_seq")


def absorbed(articles: DataFrame, reps: DataFrame) -> DataFrame:
    """(cluster_key, ingest_seq, title, link, press, pub_date) of the rows that a representative stands for, a row each."""
    return with_key(articles).select("cluster_key", "ingest_seq", "title", "link", "press", F.col("pub_date").cast("string").alias("pub_date")).join(reps.select("ingest_seq"), "ingest_seq", "left_anti")


def with_absorbed(articles: DataFrame) -> DataFrame:
    """The representatives with their absorbed rows as duplicate_sources, in order."""
    reps = representatives(articles)
    source = F.struct("ingest_seq", "title", "link", "press", "pub_date")
    lists = absorbed(articles, reps).groupBy("cluster_key").agg(F.array_sort(F.collect_list(source)).alias("l"))
    empty = F.array().cast("array<struct<title:string,link:string,press:string,pub_date:string>>")
    return reps.join(lists, "cluster_key", "left").withColumn("duplicate_sources", F.coalesce(F.transform("l", lambda x: x.dropFields("ingest_seq")), empty)).drop("l")


def with_group_number(reps: DataFrame) -> DataFrame:
    """cluster_id c1, c2, … by first appearance: groups are dealt by ranges of first_seq and numbered within a range, after those of the ranges before."""
    ranged = checkpointed(reps.select("cluster_key", "first_seq").repartitionByRange("first_seq").withColumn("range", F.spark_partition_id()))
    counts = ranged.groupBy("range").agg(F.count("*").alias("n"))  # a row per partition
    before = counts.withColumn("before", F.sum("n").over(Window.orderBy("range")) - F.col("n")).drop("n")
    place = F.row_number().over(Window.partitionBy("range").orderBy("first_seq"))
    numbers = ranged.withColumn("place", place).join(F.broadcast(before), "range").select("cluster_key", F.concat(F.lit("c"), (F.col("before") + F.col("place")).cast("string")).alias("cluster_id"))
    return reps.join(numbers, "cluster_key")


def fetch_queries(fetch: DataFrame) -> DataFrame:
    """Distinct terms of (term, pos) in order of first position."""
    return fetch.groupBy("term").agg(F.min("pos").alias("pos")).orderBy("pos")
