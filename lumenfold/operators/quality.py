"""Metrics of a run: decision counts under their published names, suspect drops, samples and the make-up of the top list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Published names of decision counts, each the sum of these reasons.
REASON_NAMES = {
    "model_keep": ["model_keep_prob_ge_threshold_with_domain_anchor"],
    "model_keep_with_domain_anchor": ["model_keep_prob_ge_threshold_with_domain_anchor"],
    "model_drop": ["model_drop_prob_le_threshold"],
    "gray_rule_keep": ["gray_keep_domain_score_ge_threshold"],
    "gray_keep_domain": ["gray_keep_domain_score_ge_threshold"],
    "gray_rule_drop": ["gray_drop_score_lt_threshold"],
    "gray_drop_no_domain_anchor": ["gray_drop_no_domain_anchor"],
    "gray_drop_generic_anchor_only": ["gray_drop_generic_anchor_only"],
    "strong_rule_keep": ["keep_strong_domain_rule_anchor"],
    "keep_strong_domain_rule_anchor": ["keep_strong_domain_rule_anchor"],
    "keep_overseas_korean_market_impact": ["keep_overseas_korean_market_impact"],
    "keep_overseas_global_reference": ["keep_overseas_global_reference"],
    "drop_corporate_macro_noise": ["drop_corporate_macro_noise"],
    "drop_generic_market_or_ipo_noise": ["drop_generic_market_or_ipo_noise"],
    "drop_low_value_overseas_market_noise": ["drop_low_value_overseas_market_noise"],
    "no_model_keep_domain": ["no_model_keep_domain_score_ge_threshold"],
    "no_model_drop": ["no_model_drop_no_domain_anchor", "no_model_drop_score_lt_threshold"],
    "negative_drop": ["drop_negative_signal"],
}


def decision_metrics(decided: DataFrame) -> DataFrame:
    """One row: inputs, kept and dropped rows, rows with and without probability, and every published reason count, in one pass."""
    counts = [F.count_if(F.col("decision_reason").isin(*[f"candidate_hybrid_{r}" for r in reasons])).alias(f"candidate_hybrid_{name}") for name, reasons in REASON_NAMES.items()]
    prob = F.col("prob").isNotNull()
    return decided.agg(F.count("*").alias("input_count"), F.count_if("keep").alias("kept_count"), F.count_if(~F.col("keep")).alias("dropped_count"), F.count_if(prob).alias("model_prob_available_count"), F.count_if(~prob).alias("model_prob_missing_count"), *counts)


def first_rows(df: DataFrame, n: int, *order) -> DataFrame:
    """The first n rows with their place."""
    return df.orderBy(*order).limit(n).withColumn("place", F.row_number().over(Window.orderBy(*order)))


def suspect_drops(decided: DataFrame, loose: Column, n: int = 10) -> DataFrame:
    """(place, title, url, suspects): the first n dropped rows without hard terms in which an anchor occurs if boundaries are
    ignored, with the number of all such rows."""
    rows = decided.where(~F.col("keep") & (F.size("matched_hard") == 0) & loose)
    total = rows.agg(F.count("*").alias("suspects"))
    return first_rows(rows, n, "ingest_seq").select("place", "title", F.col("link").alias("url")).crossJoin(total)  # one row


def sample(df: DataFrame) -> DataFrame:
    """The columns that samples of metrics show."""
    return df.select("place", "title", F.col("link").alias("url"), "sector", F.col("score").alias("relevance_score"), F.col("prob").alias("relevance_prob"), "cluster_size")


def no_topic_samples(tagged: DataFrame, n: int = 10) -> DataFrame:
    """Newest rows without topic, then by title and link."""
    return sample(first_rows(tagged.where(F.size("topics") == 0), n, F.desc("pub_date"), "title", "link"))


def mega_samples(tagged: DataFrame, least: int = 50, n: int = 10) -> DataFrame:
    """Rows of the largest clusters of at least ``least`` articles."""
    return sample(first_rows(tagged.where(F.col("cluster_size") >= least), n, F.desc("cluster_size"), "title", "link"))


def top_composition(top: DataFrame) -> DataFrame:
    """(kind, name, n) of a top list: its size, its sectors, its topics and its rows without topic."""
    entry = lambda kind, name: F.struct(F.lit(kind).alias("kind"), name.alias("name"))
    each = F.concat(F.array(entry("count", F.lit("all")), entry("sector", F.col("sector"))), F.transform("topics", lambda t: entry("topic", t)), F.when(F.size("topics") == 0, F.array(entry("topic", F.lit("none")))).otherwise(F.array().cast("array<struct<kind:string,name:string>>")))
    return top.select(F.explode(each).alias("x")).groupBy("x.kind", "x.name").agg(F.count("*").alias("n"))


def metrics_record(**parts: DataFrame) -> DataFrame:
    """One row with a nested array of structs per part; parts are small aggregates."""
    out = None
    for name, df in parts.items():
        one = df.agg(F.array_sort(F.collect_list(F.struct(*df.columns))).alias(name))
        out = one if out is None else out.crossJoin(one)  # one row each
    return out
