"""Pseudo-labels, sampling, validation, threshold evaluation and the character n-gram classifier."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..sources.tables import checkpointed


@dataclass(frozen=True)
class LabelRules:
    """Words by which rows are labelled: sure topics (anchors, signals, reason; no signals: the anchor is enough), words that are never wanted, and
    macro, industry, finance, regulator, action and vague words."""

    sure: tuple[tuple[list[str], list[str], str], ...]
    never: list[str]
    macro: list[str]
    industry: list[str]
    finance: list[str]
    regulators: list[str]
    actions: list[str]
    vague: list[str]


_ACTIONS = ["검사", "제재", "과징금", "시정명령", "행정처분", "제도개선", "제도 개선", "제도", "정책", "규제", "감독", "발표", "조치"]
# The words of Korean finance news.
KOREAN_LABELS = LabelRules(
    sure=(
        (["저축은행"], ["연체율", "PF", "부실채권"], "strong_keep_savings_bank_risk"),
        (["은행"], ["가계대출", "예대금리차", "연체"], "strong_keep_bank_consumer_credit"),
        ("보험사 보험업계 손해보험 생명보험 손보사 생보사 실손보험 자동차보험 킥스 K-ICS".split(), "킥스 K-ICS 실손 건전성 비율".split(), "strong_keep_insurance_risk"),
        (["카드론", "카드사"], ["연체", "수수료"], "strong_keep_card_credit"),
        (["금감원", "금융위"], _ACTIONS, "strong_keep_regulatory_action"),
        (["대부업", "불법사금융", "채권추심", "최고금리"], [], "strong_keep_lending_consumer_protection"),
    ),
    never="연예 스포츠 축구 야구 드라마 영화 맛집 여행 쇼핑 패션".split(),
    macro="환율 금리 유가 달러 원자재".split(),
    industry="영업이익 매출 순이익 실적 원가 원재료 수출 수주 항공 조선 식품 바이오 게임 자동차 반도체 해운 철강".split(),
    finance="은행 저축은행 보험 카드 카드사 카드론 금융 금융위 금감원 증권 여신 캐피탈 대부 사금융 채권추심 PF 부실채권 가계대출".split(),
    regulators=["금융위", "금감원"], actions=_ACTIONS, vague=["회사채", "환율", "금리"],
)
KEEP_LEAST, KEEP_SURE, SHORT_TITLE, SHORT_SUMMARY = 6, 8, 6, 12


def pseudo_label(rules: LabelRules, title: Column, summary: Column, score: Column, hard: Column, negative: Column, keep: Column, decision_reason: Column) -> Column:
    """struct(label, confidence, reason) of a decided row: 1, 0, or review where signals conflict or none is firm enough.

    A sure topic, or a kept row of enough points with hard and without negative terms, speaks for 1; unwanted words, negative terms, a lack of
    anchors, a company's results amid macro words or few points for 0."""
    text = F.lower(F.concat_ws("\n", title, summary))
    on = lambda terms: reduce(or_, [F.contains(text, F.lit(t.lower())) for t in terms], F.lit(False))
    first = lambda *cases: F.coalesce(*[F.when(test, F.lit(name)) for test, name in cases])
    for_it = first(*[(on(anchors) & (on(signals) if signals else F.lit(True)), name) for anchors, signals, name in rules.sure])
    ruled = keep & (score >= KEEP_LEAST) & (F.size(hard) > 0) & (F.size(negative) == 0)
    against = first((on(rules.never), "drop_obvious_non_finance"), ((F.size(negative) > 0) | (decision_reason == "rule_drop_negative_signal"), "drop_negative_signal"), (decision_reason == "rule_drop_no_financial_anchor", "drop_no_financial_anchor"),
                    (on(rules.macro) & on(rules.industry) & ~on(rules.finance), "drop_corporate_macro_noise"), (~keep & (score <= 2), "drop_score_le_2"))
    sure_of = F.when(against.isin("drop_negative_signal", "drop_obvious_non_finance"), 0.95).when(against == "drop_corporate_macro_noise", 0.85).otherwise(0.75)
    short = (F.length(F.trim(F.coalesce(title, F.lit("")))) < SHORT_TITLE) & (F.length(F.trim(F.coalesce(summary, F.lit("")))) < SHORT_SUMMARY)
    doubt = F.coalesce(first((short, "review_text_too_short"), (score.between(3, 5), "review_mid_score_ambiguous"), (on(rules.macro) & ~on(rules.finance), "review_generic_macro_only"), (on(rules.regulators) & ~on(rules.actions), "review_regulator_without_action_context"), (on(rules.vague), "review_ambiguous_market_context")), F.lit("review_no_conservative_rule_matched"))
    pick = lambda label, conf, why: F.struct(F.lit(label).alias("label"), conf.cast("double").alias("confidence"), why.alias("reason"))
    kept_by = F.coalesce(for_it, F.when(ruled, F.lit("rule_keep")))
    return (F.when(kept_by.isNotNull() & against.isNotNull(), pick("review", F.lit(0.0), F.concat_ws(":", F.lit("review_conflicting_signals"), kept_by, against)))
            .when(for_it.isNotNull(), pick("1", F.lit(0.95), for_it)).when(ruled, pick("1", F.when(score >= KEEP_SURE, 0.85).otherwise(0.75), F.lit("rule_keep_score_ge_6_with_hard_match")))
            .when(against.isNotNull(), pick("0", sure_of, against)).otherwise(pick("review", F.lit(0.0), doubt)))


def stratified(df: DataFrame, strata: list[str], key: str, n: int, seed: str = "42") -> DataFrame:
    """n rows drawn from the strata in turn, shuffled within each by a hash of seed and key."""
    h = F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")).cast("binary"))
    turn = F.row_number().over(Window.partitionBy(*strata).orderBy("_h", key))
    return df.withColumn("_h", h).withColumn("turn", turn).where(F.col("turn") <= n).orderBy("turn", *strata).limit(n).drop("_h")


def validate(df: DataFrame, label: str = "label", url: str = "url") -> DataFrame:
    """Counts of blank, invalid, usable and review labels and of rows beyond the first per url."""
    v = F.trim(F.coalesce(F.col(label).cast("string"), F.lit("")))
    dup = df.where(F.col(url).isNotNull()).groupBy(url).agg((F.count("*") - 1).alias("d")).agg(F.coalesce(F.sum("d"), F.lit(0)).alias("duplicates"))
    one = df.agg(F.count("*").alias("n_rows"), F.count_if(v == "").alias("blank"), F.count_if(~v.isin("", "0", "1", "review")).alias("invalid"), F.count_if(v.isin("0", "1")).alias("usable"), F.count_if(v == "review").alias("review"), F.count_if(F.col(url).isNull()).alias("missing_url"))
    return one.crossJoin(dup)


def threshold_metrics(df: DataFrame, prob: str, label: str, thresholds: tuple[float, ...] = (0.35, 0.5, 0.6, 0.65, 0.7, 0.8)) -> DataFrame:
    """Confusion counts and rates per threshold in one pass: conditional sums, then one row per threshold."""
    y, p = F.col(label) == 1, F.col(prob)
    sums = [F.struct(F.lit(t).alias("threshold"), F.count_if((p >= t) & y).alias("tp"), F.count_if((p >= t) & ~y).alias("fp"), F.count_if((p < t) & y).alias("fn"), F.count_if((p < t) & ~y).alias("tn")).alias(f"t{k}") for k, t in enumerate(thresholds)]
    flat = df.agg(*sums).select(F.explode(F.array(*[f"t{k}" for k in range(len(thresholds))])).alias("x")).select("x.*")
    rate = lambda a, b: F.round(F.coalesce(F.try_divide(a, b), F.lit(0.0)), 6)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return flat.withColumns({"accuracy": rate(tp + tn, tp + fp + fn + tn), "precision": rate(tp, tp + fp), "recall": rate(tp, tp + fn), "f1": rate(2 * tp, 2 * tp + fp + fn)})


def disagreements(df: DataFrame, prob: str, label: str, confidence: str, n: int, threshold: float = 0.65) -> DataFrame:
    """The n rows of most confidence whose predicted class differs from the label."""
    wrong = (F.col(prob) >= threshold).cast("int") != F.col(label)
    return df.where(wrong).withColumn("gap", F.round(F.abs(F.col(prob) - threshold), 6)).orderBy(F.desc(confidence), F.desc("gap"), "doc_id").limit(n)


def char_ngrams(text: str | None, low: int = 2, high: int = 5) -> list[str]:
    """Character n-grams of the lower-case text with white space collapsed."""
    t = " ".join((text or "").lower().split())
    return [t[i : i + n] for n in range(low, high + 1) for i in range(len(t) - n + 1)]


def vocabulary(texts: DataFrame, size: int, least_docs: int = 1) -> DataFrame:
    """(g, n, d) of the ``size`` most frequent grams of the column ``text`` that at least ``least_docs`` rows hold: how often, in how many rows.

    Ties go to the lesser gram. Counts are combined within Arrow batches and tasks before they are shuffled. A histogram of the
    counts by sixteenths of a power of two, a thousand rows at most, tells above which class all grams are in; only the class at
    the border is sorted, for the places that are left."""

    def count(batches):
        for pdf in batches:
            n, d = Counter(), Counter()
            for text in pdf["text"]:
                found = Counter(char_ngrams(text))
                n.update(found)
                d.update(found.keys())
            yield pd.DataFrame({"g": list(n), "n": list(n.values()), "d": [d[g] for g in n]})

    counts = texts.select("text").mapInPandas(count, "g string, n long, d long").groupBy("g").agg(F.sum("n").alias("n"), F.sum("d").alias("d")).where(F.col("d") >= least_docs)
    counts = checkpointed(counts.withColumn("c", F.floor(F.log2("n") * 16)))
    sure, border, left = None, None, size
    for r in sorted(counts.groupBy("c").count().collect(), key=lambda r: -r["c"]):
        if r["count"] > left:
            border = r["c"]
            break
        sure, left = r["c"], left - r["count"]
    found = counts.where(F.col("c") >= sure) if sure is not None else counts.limit(0)
    if border is not None:
        found = found.unionByName(counts.where(F.col("c") == border).orderBy(F.desc("n"), "g").limit(left))
    return found.select("g", "n", "d")


class CharModel:
    """Probabilities of class 1 from character n-grams: a weight per gram of the vocabulary over unit tf-idf vectors; made by ``fit_classifier``."""

    def __init__(self, grams: list[str], idf: np.ndarray, weights: np.ndarray, intercept: float):
        self.place, self.idf, self.weights, self.intercept = {g: k for k, g in enumerate(grams)}, idf, weights, intercept

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(places, values) of a text's unit tf-idf vector."""
        found = Counter(k for k in map(self.place.get, char_ngrams(text)) if k is not None)
        at = np.array(sorted(found), dtype=np.int32)
        value = np.array([found[k] for k in at.tolist()], dtype=float) * self.idf[at]
        return at, value / (np.sqrt(value @ value) or 1.0)

    def add(self, rows: DataFrame, text: str = "text") -> DataFrame:
        """rows with ``prob``."""
        model = rows.sparkSession.sparkContext.broadcast(self)

        def prob(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            m = model.value
            for s in texts:
                z = [m.intercept + float(m.weights[at] @ value) for at, value in map(m.vector, s)]
                yield pd.Series(1 / (1 + np.exp(-np.array(z, dtype=float))))

        return rows.withColumn("prob", F.pandas_udf(prob, "double")(F.col(text)))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(g, k, float(self.idf[k]), float(self.weights[k])) for g, k in self.place.items()] + [(None, -1, 0.0, float(self.intercept))]
        spark.createDataFrame(rows, "g string, k int, idf double, weight double").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> CharModel:
        rows = sorted(spark.read.parquet(path).collect(), key=lambda r: r["k"])  # the vocabulary, which has a bound
        return cls([r["g"] for r in rows[1:]], np.array([r["idf"] for r in rows[1:]]), np.array([r["weight"] for r in rows[1:]]), rows[0]["weight"])


TOLERANCE = 1e-6  # of the greatest slope of the mean loss, at which fitting ends


def minimise(value_of, x: np.ndarray, steps: int, tolerance: float = TOLERANCE, memory: int = 10) -> tuple[np.ndarray, int]:
    """(x, steps taken): limited-memory quasi-Newton descent with halved steps, until no slope exceeds ``tolerance``. value_of(x) gives value and slopes."""
    value, slope = value_of(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for step in range(steps):
        if np.abs(slope).max() <= tolerance:
            return x, step
        way, told = slope.copy(), []
        for dx, dg in reversed(past):
            told.append((dx @ way) / (dx @ dg))
            way -= told[-1] * dg
        if past:
            dx, dg = past[-1]
            way *= (dx @ dg) / (dg @ dg)
        for (dx, dg), a in zip(past, reversed(told), strict=True):
            way += (a - (dg @ way) / (dx @ dg)) * dx
        size = 1.0 if past else 1.0 / max(1.0, float(np.linalg.norm(slope)))
        while True:
            new = x - size * way
            v, g = value_of(new)
            if v <= value - 1e-4 * size * float(slope @ way) or size < 1e-10:
                break
            size /= 2
        if size < 1e-10:
            return x, step  # no step lowers the value any more
        if (new - x) @ (g - slope) > 1e-14:
            past = [*past, (new - x, g - slope)][-memory:]
        x, value, slope = new, v, g
    return x, steps


def fit_classifier(df: DataFrame, text: str, label: str, weight: str | None = None, features: int = 50_000, max_iter: int = 2000, least_docs: int = 1) -> CharModel:
    """Character 2- to 5-grams, smoothed tf-idf of unit length, logistic regression balanced over the classes and penalised by half the squared weights.

    Sparse vectors are written once; every step sums loss and slopes over that table within tasks, and one number per gram reaches the
    driver. Steps end where no slope of the mean loss exceeds ``TOLERANCE``, or after ``max_iter``."""
    spark = df.sparkSession
    rows = df.select(F.col(text).alias("text"), F.col(label).cast("double").alias("y"), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w"))
    by = {int(r["y"]): (r["n"], r["w"]) for r in rows.groupBy("y").agg(F.count("*").alias("n"), F.sum("w").alias("w")).collect()}  # two classes
    total = sum(n for n, _ in by.values())
    found = sorted(vocabulary(rows, features, least_docs).collect(), key=lambda r: (-r["n"], r["g"]))
    width = len(found)
    empty = CharModel([r["g"] for r in found], np.array([math.log((1 + total) / (1 + r["d"])) + 1 for r in found]), np.zeros(width), 0.0)
    balance = {y: total / (2 * n) for y, (n, _) in by.items()}
    mass = sum(balance[y] * w for y, (_, w) in by.items()) or 1.0
    shared = spark.sparkContext.broadcast((empty, balance))

    def vectors(batches):
        model, scale = shared.value
        for b in batches:
            made = [model.vector(t) for t in b.column("text").to_pylist()]
            y = b.column("y").to_numpy()
            w = b.column("w").to_numpy() * np.array([scale[int(v)] for v in y])
            ends = pa.array(np.cumsum([0, *(len(at) for at, _ in made)]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, kind), *(m[k] for m in made)]).astype(kind))) for k, kind in ((0, np.int32), (1, np.float64))]
            yield pa.RecordBatch.from_arrays([pa.array(y), pa.array(w), *lists], ["y", "w", "at", "value"])

    table = checkpointed(rows.mapInArrow(vectors, "y double, w double, at array<int>, value array<double>"))

    def value_of(x: np.ndarray) -> tuple[float, np.ndarray]:
        now = spark.sparkContext.broadcast(x)

        def part(batches):
            x, out = now.value, np.zeros(width + 2)
            for b in batches:
                lists, y, w = b.column("at"), b.column("y").to_numpy(), b.column("w").to_numpy()
                row = np.repeat(np.arange(len(b)), np.diff(lists.offsets.to_numpy()))
                at, value = lists.flatten().to_numpy(), b.column("value").flatten().to_numpy()
                z = x[width] + np.bincount(row, weights=x[at] * value, minlength=len(b))
                off = w * (1 / (1 + np.exp(-z)) - y)
                out[:width] += np.bincount(at, weights=off[row] * value, minlength=width)
                out[width:] += off.sum(), float(w @ (np.logaddexp(0, z) - y * z))
            used = np.flatnonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(out[used])], ["k", "v"])

        got = table.mapInArrow(part, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).toPandas()
        now.destroy()
        every = np.zeros(width + 2)
        every[got["k"].to_numpy()] = got["v"].to_numpy()
        pull = np.append(x[:width], 0.0)
        return (every[-1] + float(pull @ pull) / 2) / mass, (every[:-1] + pull) / mass

    x, _ = minimise(value_of, np.zeros(width + 1), max_iter)
    return CharModel(list(empty.place), empty.idf, x[:width], float(x[width]))


def usable(rows: DataFrame, label: str = "auto_label", text: str = "text") -> DataFrame:
    """rows with ``use``: used, review or blank_or_invalid; only rows labelled 1 or 0 that have a text are used."""
    v = F.trim(F.coalesce(F.col(label).cast("string"), F.lit("")))
    return rows.withColumn("use", F.when(v == "review", "review").when(v.isin("0", "1") & (F.trim(F.coalesce(text, F.lit(""))) != ""), "used").otherwise("blank_or_invalid"))


def first_by_key(rows: DataFrame, url: str = "url", title: str = "title", order: str = "ingest_seq") -> DataFrame:
    """The first row per url, or, where there is none, per title without case and repeated blanks."""
    key = F.coalesce(F.concat(F.lit("u:"), F.nullif(F.trim(url), F.lit(""))), F.concat(F.lit("t:"), tx.plain_title(F.col(title))))
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_n = 1").drop("_n")


def hashed_sample(rows: DataFrame, key: str, n: int, *order: str, seed: str = "42") -> DataFrame:
    """n rows by least hash of seed and key, in the given order; the same rows whatever the order of the input."""
    h = F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")).cast("binary"))
    return rows.orderBy(h, key).limit(n).orderBy(*order)


def stratified_holdout(rows: DataFrame, label: str, key: str, share: float = 0.25, seed: str = "42") -> tuple[DataFrame, str]:
    """(rows with ``part``: train or test, why there is no test part, else empty): ``share`` of each class by hash.

    Needs 4 rows, 2 of each class, and both classes in both parts; else all rows are for training."""
    by = {r[label]: r["n"] for r in rows.groupBy(label).agg(F.count("*").alias("n")).collect()}  # two classes
    if sum(by.values()) < 4 or min(by.get(0, 0), by.get(1, 0)) < 2:
        return rows.withColumn("part", F.lit("train")), "too_few_rows"
    sizes = {k: round(n * share) for k, n in by.items()}
    if not all(0 < sizes[k] < by[k] for k in (0, 1)):
        return rows.withColumn("part", F.lit("train")), "class_missing_in_a_part"
    h = F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")).cast("binary"))
    # the hash below which a class has its share of rows: a top-k of hashes per class, joined back as two literals
    cut = {k: rows.where(F.col(label) == k).select(h.alias("h"), F.col(key).alias("k")).orderBy("h", "k").limit(n).agg(F.max(F.struct("h", "k")).alias("c")).first()["c"] for k, n in sizes.items()}
    inside = F.lit(False)
    for k, c in cut.items():
        inside = inside | ((F.col(label) == k) & ((h < c["h"]) | ((h == c["h"]) & (F.col(key) <= c["k"]))))
    return rows.withColumn("part", F.when(inside, "test").otherwise("train")), ""


def label_lookup(rows: DataFrame, labels: DataFrame, url: str = "url") -> DataFrame:
    """Rows whose url is labelled, with the label; the first label of a url counts."""
    return rows.join(labels.groupBy(url).agg(F.min_by("label", "ingest_seq").alias("label")), url)


def manual_model(labelled: DataFrame, text: str = "text", label: str = "label", least: int = 40) -> CharModel:
    """The model of hand-made labels; fewer than ``least`` are an error. Grams must occur in two documents."""
    n = labelled.count()
    if n < least:
        raise ValueError(f"{least} labelled rows are needed, there are {n}")
    return fit_classifier(labelled, text, label, least_docs=2)


FORBIDDEN_MODEL = "models/relevance"  # the operating model, which a refresh never writes


def refresh(spark, files: DataFrame, rows_of, model_path: str, least_files: int = 2, least_class: int = 50, threshold: float = 0.65, max_iter: int = 2000) -> tuple[str, str, DataFrame | None]:
    """(status, reason, threshold metrics) of a guarded refresh of the candidate model.

    files: (name, reason) of ``reports.eligible_files``; rows_of(names) gives (doc_id, text, auto_label, train_weight). Skipped without files,
    without eligible ones, with too few, without usable rows or with too few of a class; failed if the path is the operating
    model's; else refreshed: the model of all usable rows is saved, and judged by one that has not seen a quarter of them."""
    if FORBIDDEN_MODEL in model_path and "candidate" not in model_path:
        return "failed", "forbidden_model_path", None
    names = [r["name"] for r in files.where("reason = 'included'").select("name").collect()]  # at most the file cap
    for reason, bad in (("no_candidate_files", files.isEmpty()), ("no_eligible_candidate_files", not names), ("insufficient_eligible_candidate_files", len(names) < least_files)):
        if bad:
            return "skipped", reason, None
    used = usable(rows_of(names)).where("use = 'used'").withColumn("y", F.col("auto_label").cast("int"))
    by = {r["y"]: r["n"] for r in used.groupBy("y").agg(F.count("*").alias("n")).collect()}
    for reason, bad in (("no_usable_rows", not by), ("one_class_only", len(by) < 2), ("too_few_positive", by.get(1, 0) < least_class), ("too_few_negative", by.get(0, 0) < least_class)):
        if bad:
            return "skipped", reason, None
    parts, why = stratified_holdout(used, "y", "doc_id")
    metrics = None
    if not why:
        judged = fit_classifier(parts.where("part = 'train'"), "text", "y", "train_weight", max_iter=max_iter).add(parts.where("part = 'test'"))
        metrics = threshold_metrics(judged, "prob", "y", (0.35, 0.5, 0.6, threshold, 0.7, 0.8))
    fit_classifier(used, "text", "y", "train_weight", max_iter=max_iter).save(spark, model_path)
    return "refreshed", why, metrics
