"""Registered queries over the driver tables, each with its SQL twin where SQL can express it."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.terms import SYNTHETIC as P
from ..functions.terms import among, with_scans
from ..functions.terms import some as some_found
from ..functions.terms import found_by_sql as has
from ..operators import articles as ar
from ..operators import contracts as ct
from ..operators import events as ev
from ..operators import labels as lb
from ..operators import ranking as rk
from ..operators import relevance as rv
from ..operators import reports as rp
from ..operators import summaries as sm
from ..operators import tagging as tg
from ..sources import paged
from ..sources.tables import checkpoint_root, read
from ..streaming import cache as cc
from ..streaming import windows as wn

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# --- shared parts of the SQL twins

SPACE = r"[\s\x0B\x{00A0}]+"


def norm(x: str) -> str:
    return f"trim(regexp_replace(lower(regexp_replace({x}, '<[^>]+>', ' ', 'g')), '{SPACE}', ' ', 'g'))"


ART = """art AS (SELECT doc_id, split_part(text, chr(10), 1) AS title,
 CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END AS description,
 'doc/' || doc_id AS link, lang AS query, source AS press, TIMESTAMP '2024-01-01' + to_minutes(CAST(doc_id AS INTEGER)) AS pub_date,
 CAST((doc_id * 7919) % 1000 AS DOUBLE) / 1000 AS prob, text FROM documents WHERE text IS NOT NULL)"""
TXT = f"{ART}, txt AS (SELECT *, {norm('concat_ws(chr(32), title, description, query)')} AS rt, {norm('concat_ws(chr(10), trim(title), trim(description))')} AS st, {norm('title')} AS tt, {norm('description')} AS bt FROM art)"


def some(text: str, terms) -> str:
    terms = P.lists[terms] if isinstance(terms, str) else terms
    return "(" + " OR ".join(has(text, t) for t in terms) + ")" if terms else "FALSE"


def count(text: str, terms) -> str:
    terms = P.lists[terms] if isinstance(terms, str) else terms
    return "(" + " + ".join(f"CASE WHEN {has(text, t)} THEN 1 ELSE 0 END" for t in terms) + ")" if terms else "0"


def listed(text: str, terms, extra: dict[str, str] | None = None) -> str:
    return "concat_ws(';', " + ", ".join(f"CASE WHEN {has(text, t)}{' AND ' + extra[t] if extra and t in extra else ''} THEN '{t}' END" for t in terms) + ")"


def anywhere(column: str, parts) -> str:
    return "(" + " OR ".join(f"contains({column}, '{x.lower()}')" for x in parts) + ")"


W = P.weights
_guard = {t: some("st", "entities") for t in P.lists["enforcement"]}


def _sum(weights: dict[str, int], guard=None) -> str:
    return "(" + " + ".join(f"CASE WHEN {has('st', t)}{' AND ' + guard[t] if guard and t in guard else ''} THEN {w} ELSE 0 END" for t, w in weights.items()) + ")"


_neg_extra = [t for t in W["negative"] if t not in P.lists["capped"]]
SCORED = f"""{TXT}, sc0 AS (SELECT *, {_sum(W['hard'], _guard)} AS h, {_sum(W['soft'])} AS s, {_sum(W['negative'])} AS n,
 {listed('st', W['hard'], _guard)} AS matched_hard, {listed('st', W['soft'])} AS matched_soft, {listed('st', W['negative'])} AS matched_negative FROM txt),
sc1 AS (SELECT *, CASE WHEN n > 1 AND NOT {some('st', _neg_extra)} AND {some('st', 'context_strong')} AND {some('st', 'risk')} THEN 1 ELSE n END AS ng FROM sc0),
sc AS (SELECT *, CAST(CASE WHEN {anywhere('lower(link)', P.lists['blocked_domains'])} THEN -50 WHEN st = '' THEN 0 WHEN h <= 0 THEN least(h + s - ng, 2) ELSE h + s - ng END AS INTEGER) AS score FROM sc1)"""
_both = lambda a, b: f"({some('st', a)} AND {some('st', b)})"
SIGNALS = f"""{SCORED}, sg0 AS (SELECT *, ({some('st', 'domain')} OR {_both('enforcement', 'entities')}) AS dom, {_both('impact_trigger', 'impact_home')} AS imp, {some('st', 'global_macro')} AS mac,
 {some('st', 'generic')} AS gen0, ({some('st', 'enforcement_always')} OR {_both('enforcement', 'entities')}) AS enf, {_both('context_strong', 'risk')} AS strg,
 (n > 0 AND NOT {some('st', _neg_extra)}) AS cap FROM sc),
sg1 AS (SELECT *, mac AND {some('st', 'global_market')} AS glo, NOT imp AND NOT mac AND ({some('st', 'low_value')} OR {_both('mood_market', 'mood')}) AS low FROM sg0),
sg2 AS (SELECT *, NOT dom AND NOT imp AND NOT glo AND gen0 AS gen, NOT dom AND NOT imp AND NOT glo AND {_both('corporate_macro', 'corporate')} AS corp FROM sg1),
sg AS (SELECT *, NOT dom AND NOT enf AND NOT imp AND NOT (glo AND NOT low) AND gen AND {some('st', 'market_ipo')} AS mkt FROM sg2),
dec AS (SELECT *, 'candidate_hybrid_' || CASE WHEN n > 0 AND score >= 5 AND cap AND strg THEN 'keep_strong_finance_anchor_neg_cap' WHEN n > 0 THEN 'drop_negative_signal'
 WHEN low THEN 'drop_low_value_overseas_market_noise' WHEN imp THEN 'keep_overseas_korean_market_impact' WHEN glo AND NOT dom THEN 'keep_overseas_global_reference'
 WHEN corp THEN 'drop_corporate_macro_noise' WHEN mkt THEN 'drop_generic_market_or_ipo_noise' WHEN score >= 8 AND h > 0 AND dom THEN 'keep_strong_domain_rule_anchor'
 WHEN prob >= 0.65 AND (dom OR (score >= 5 AND NOT gen) OR enf) THEN 'model_keep_prob_ge_threshold_with_domain_anchor' WHEN prob >= 0.65 THEN 'drop_model_keep_without_domain_anchor'
 WHEN prob <= 0.35 THEN 'model_drop_prob_le_threshold' WHEN score < 6 THEN 'gray_drop_score_lt_threshold' WHEN NOT dom AND gen THEN 'gray_drop_generic_anchor_only'
 WHEN NOT dom THEN 'gray_drop_no_domain_anchor' ELSE 'gray_keep_domain_score_ge_threshold' END AS reason FROM sg),
decided AS (SELECT *, contains(reason, '_keep_') AND NOT contains(reason, 'drop_model_keep') AS keep FROM dec)"""
def _steps(x: str, steps) -> str:
    for what, instead in steps:
        x = f"regexp_replace({x}, '{what.replace(chr(39), chr(39) * 2)}', '{instead}', 'g')"
    return x


GROUPS = f"""{ART}, k0 AS (SELECT *, {_steps('lower(trim(title))', tx.KEY_STEPS)} AS t0 FROM art), k1 AS (SELECT *, trim(regexp_replace(t0, '{tx.OUTLET}', '', 'g')) AS less FROM k0),
k2 AS (SELECT *, trim(regexp_replace(regexp_replace(coalesce(nullif(less, ''), t0), '[.,;:·/\\\\|-]+', ' ', 'g'), '{SPACE}', ' ', 'g')) AS nt FROM k1),
grp AS (SELECT *, CASE WHEN nt <> '' THEN nt ELSE 'title:' || lower(trim(title)) END AS cluster_key FROM k2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY cluster_key ORDER BY pub_date DESC, length(trim(description)) DESC, doc_id) AS rnk, count(*) OVER (PARTITION BY cluster_key) AS cluster_size,
 min(doc_id) OVER (PARTITION BY cluster_key) AS first_seq FROM grp)"""


def _sector_sql(s: tg.Sector) -> str:
    t = lambda w: has("tt", w)
    b = lambda w: has("bt", w)
    parts_t = [f"CASE WHEN {t(w)} THEN {p} ELSE 0 END" for k, p in tg.SECTOR_POINTS["title"].items() for w in getattr(s, k)]
    parts_b = [f"CASE WHEN {b(w)}{'' if k == 'negative' else f' AND NOT {t(w)}'} THEN {p} ELSE 0 END" for k, p in tg.SECTOR_POINTS["body"].items() for w in getattr(s, k)]
    adj, adj_t = [], []
    for a in tg.SYNTHETIC_ADJUSTMENTS:
        if a.sector == s.name:
            adj.append(f"CASE WHEN ({some('tt', a.terms)} OR {some('bt', a.terms)}) AND NOT ({some('tt', a.unless)} OR {some('bt', a.unless)}) THEN {a.total} ELSE 0 END")
            adj_t.append(f"CASE WHEN {some('tt', a.terms)} AND NOT {some('tt', a.unless)} THEN {a.title} ELSE 0 END")
    title = " + ".join([*parts_t, *adj_t])
    total = " + ".join([*parts_t, *parts_b, *adj])
    return f"CAST({title} AS DOUBLE) AS ts, CAST({total} AS DOUBLE) AS sc"


SECTORS = f"""{SCORED}, sx AS ({' UNION ALL '.join(f"SELECT doc_id, '{s.name}' AS name, {k} AS ord, {_sector_sql(s)} FROM sc" for k, s in enumerate(tg.SYNTHETIC_SECTORS))}),
sy AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ts DESC, sc DESC, ord) AS rn FROM sx),
sec AS (SELECT sc.*, sy.name AS best_sector, CASE WHEN sy.sc >= 4 THEN sy.name ELSE 'misc' END AS sector, sy.sc AS sector_score, sy.ts AS sector_title_score FROM sc JOIN sy USING (doc_id) WHERE sy.rn = 1)"""


def _topic_sql(t: tg.Topic) -> str:
    T, B, Q = (lambda c: (lambda w: has(c, w)))("tt"), (lambda c: (lambda w: has(c, w)))("bt"), (lambda c: (lambda w: has(c, w)))("lower(query)")
    pt, pb = tg.TOPIC_POINTS["title"], tg.TOPIC_POINTS["body"]
    x = [f"CASE WHEN {T(w)} THEN {pt['strong']} WHEN {B(w)} THEN {pb['strong']} ELSE 0 END" for w in t.strong]
    x += [f"CASE WHEN {T(w)} THEN {pt['weak']} WHEN {B(w)} THEN {pb['weak']} ELSE 0 END" for w in t.weak]
    x += [f"CASE WHEN {T(w)} THEN {pt['context']} ELSE 0 END" for w in t.title_context] + [f"CASE WHEN {B(w)} THEN {pb['context']} ELSE 0 END" for w in t.body_context]
    x += [f"CASE WHEN {Q(w)} AND NOT {T(w)} AND NOT {B(w)} THEN {tg.QUERY_POINTS} ELSE 0 END" for w in [*t.strong, *t.weak]]
    x += [f"CASE WHEN {T(w)} THEN {pt['negative']} ELSE 0 END + CASE WHEN {B(w)} THEN {pb['negative']} ELSE 0 END" for w in t.negative]
    near = [*t.strong, *t.weak, *t.title_context]
    if t.sectors and near:
        x.append(f"CASE WHEN best_sector IN ({', '.join(repr(s) for s in t.sectors)}) AND {some('tt', near)} THEN {tg.AFFINITY_POINTS} ELSE 0 END")
    body = [*t.strong, *t.weak, *t.body_context]
    hit = f"({some('tt', near)} OR {some('bt', body)})"
    return f"({' + '.join(x)}) >= {t.least} - 1e-9 AND {hit}"


def _fallback_sql(f: tg.Fallback) -> str:
    where = f" AND sector IN ({', '.join(repr(s) for s in f.sectors)})" if f.sectors else ""
    return f"({some('(tt || chr(32) || bt)', f.terms)}{where})"


_raw_topic = {t.name: _topic_sql(t) for t in tg.SYNTHETIC_TOPICS}
_all_topic = {n: "(" + " OR ".join([f"({x})", *(_fallback_sql(f) for f in tg.SYNTHETIC_FALLBACKS if f.topic == n)]) + ")" for n, x in _raw_topic.items()}
TAGGED = f"""{SECTORS}, tagged AS (SELECT *, {', '.join(f'{x} AS topic_{n}, ({_raw_topic[n]}) AS raw_{n}' for n, x in _all_topic.items())} FROM sec),
top AS (SELECT *, concat_ws(';', {', '.join(f"CASE WHEN topic_{n} THEN '{n}' END" for n in sorted(_all_topic))}) AS topics FROM tagged)"""
_topic_rows = " UNION ALL ".join(f"SELECT doc_id, '{n}' AS name FROM tagged WHERE topic_{n}" for n in _all_topic)


def _trend_sql() -> str:
    """(doc_id, keyword, pos): the hits of the best sector, then those of the topics, each list in its order."""
    rows = []

    def add(where: str, field: str, words: list[str]) -> None:
        rows.extend(f"SELECT doc_id, '{w}' AS keyword, {len(rows) + k} AS pos FROM tagged WHERE {where} AND {has(field, w)}" for k, w in enumerate(words))

    for s in tg.SYNTHETIC_SECTORS:
        for field in ("tt", "bt"):
            add(f"best_sector = '{s.name}'", field, [*s.strong, *s.weak])
    for t in tg.SYNTHETIC_TOPICS:
        for field, words in (("tt", [*t.strong, *t.weak]), ("bt", [*t.strong, *t.weak]), ("tt", t.title_context), ("bt", t.body_context)):
            add(f"raw_{t.name}", field, words)
    return " UNION ALL ".join(rows)


def articles(spark, d):
    return ar.from_documents(read(spark, d, "documents"))


def scored(spark, d):
    return rv.scored(read(spark, d, "documents"), P)


def tagged(spark, d):
    df = scored(spark, d).withColumns({"title_text": tx.normalize(F.col("title")), "body_text": tx.normalize(F.col("description")), "query_text": F.lower(F.coalesce("query", F.lit("")))})
    taxonomy = (tg.SYNTHETIC_SECTORS, tg.SYNTHETIC_ADJUSTMENTS, tg.SYNTHETIC_TOPICS, tg.SYNTHETIC_FALLBACKS)
    return tg.assign_topics(tg.assign_sector(tg.with_found(df, P, *taxonomy), *taxonomy[:2]), *taxonomy[2:])


# --- projections, windows and duplicates

@query(f"WITH {TXT} SELECT doc_id, title, link, press, prob, rt AS rule_text, st AS score_text, md5(concat_ws(chr(10), title, title, description)) AS model_md5 FROM txt")
def article_projection(spark, d):
    base = articles(spark, d)
    return base.select("doc_id", "title", "link", "press", "prob", ar.rule_text(F.col("title"), F.col("description"), F.col("query")).alias("rule_text"), ar.score_text(F.col("title"), F.col("description")).alias("score_text"), F.md5(ar.model_text(F.col("title"), F.col("description")).cast("binary")).alias("model_md5"))


@query("SELECT event_id, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-09 23:45:00' AND ts < TIMESTAMP '2024-01-11 00:00:00'")
def collection_window(spark, d):
    start, end = ar.collection_window("2024-01-11", "09:00", 24, 15)
    utc = lambda x: x.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return ar.in_window(read(spark, d, "events"), "ts", utc(start), utc(end)).select("event_id", "event_type", "value")


@query("SELECT event_type, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) AS n FROM events) WHERE n <= 100")
def paged_scan_cap(spark, d):
    return ar.newest_per_query(read(spark, d, "events"), "event_type", "ts", "event_id", 100).select("event_type", "event_id", "ts")


@query(f"""WITH {ART}, z AS (SELECT max(pub_date) AS last FROM art), r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY pub_date DESC, doc_id) - 1 AS place FROM art)
SELECT query, link, pub_date, CAST(place // 100 * 100 + 1 AS INTEGER) AS start FROM r, z WHERE place < 500 AND pub_date >= last - INTERVAL 8 HOUR AND pub_date < last - INTERVAL 1 HOUR""")
def paged_scan(spark, d):
    """Articles as a search service would answer them, read back page by page within a window."""
    found = articles(spark, d)
    folder = _new_folder(spark, "pages")
    paged.record(found.select("doc_id", "query", "pub_date", "title", "description", "link", F.lit(None).cast("string").alias("originallink")), folder, 100, "doc_id")
    last = found.agg(F.max("pub_date")).first()[0]
    rows = paged.search(spark, folder, last - dt.timedelta(hours=8), last - dt.timedelta(hours=1))
    return rows.select("query", "link", F.col("pub_date").cast("timestamp_ntz").alias("pub_date"), "start")


@query("SELECT p_brand AS term, CAST(min(p_partkey) AS INTEGER) AS pos FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand")
def fetch_query_list(spark, d):
    terms = read(spark, d, "part").where(F.col("p_brand").isNotNull()).select(F.col("p_brand").alias("term"), F.col("p_partkey").cast("int").alias("pos"))
    return ar.fetch_queries(terms).select("term", "pos")


@query(f"WITH {ART} SELECT doc_id, title FROM (SELECT *, row_number() OVER (PARTITION BY lower(title) || '|' || press ORDER BY doc_id) AS n FROM art) WHERE n = 1")
def dedup_exact(spark, d):
    return ar.dedup_exact(articles(spark, d).where(F.col("press").isNotNull()).withColumn("link", F.col("press"))).select("doc_id", "title")


@query(f"WITH {GROUPS} SELECT cluster_key, doc_id, title, cluster_size, first_seq FROM ranked WHERE rnk = 1")
def dedup_title_representative(spark, d):
    return ar.representatives(articles(spark, d)).select("cluster_key", "doc_id", "title", "cluster_size", "first_seq")


@query(f"WITH {GROUPS} SELECT cluster_key, count(*) - 1 AS absorbed, coalesce(string_agg(link, ';' ORDER BY doc_id) FILTER (WHERE rnk > 1), '') AS links FROM ranked GROUP BY cluster_key")
def dedup_absorbed_sources(spark, d):
    reps = ar.with_absorbed(articles(spark, d))
    return reps.select("cluster_key", F.size("duplicate_sources").cast("long").alias("absorbed"), F.array_join(F.transform("duplicate_sources", lambda x: x["link"]), ";").alias("links"))


@query(f"WITH {GROUPS}, g AS (SELECT cluster_key, min(first_seq) AS f FROM ranked GROUP BY 1) SELECT cluster_key, 'c' || dense_rank() OVER (ORDER BY f) AS cluster_id FROM g")
def dedup_group_numbers(spark, d):
    return ar.with_group_number(ar.representatives(articles(spark, d))).select("cluster_key", "cluster_id")


# --- relevance

@query(f"""WITH {TXT} SELECT doc_id, CASE WHEN {anywhere('link', P.lists['blocked_domains'])} THEN 'blocked_domain' WHEN {some('rt', 'sports')} THEN 'sports'
 WHEN {some('rt', 'politics')} AND NOT {some('rt', 'finance')} THEN 'politics_only' WHEN {some('rt', 'lease')} AND NOT {some('rt', 'strong')} THEN 'public_lease'
 WHEN NOT {some('rt', 'strong')} AND {some('rt', 'show_strong')} THEN 'entertainment_strong' WHEN NOT {some('rt', 'strong')} AND {count('rt', 'show_weak')} >= 2 THEN 'entertainment_weak' END AS drop_reason FROM txt""")
def prefilter_drop_reason(spark, d):
    return scored(spark, d).select("doc_id", rv.drop_reason(P, F.col("rule_found"), F.col("link")).alias("drop_reason"))


@query(f"WITH {TXT} SELECT doc_id, {listed('st', W['hard'])} AS hits, {count('st', list(W['hard']))} AS n_hits FROM txt")
def lexicon_hits(spark, d):
    hits = among(F.col("found"), list(W["hard"]))
    base = articles(spark, d).withColumn("score_text", ar.score_text(F.col("title"), F.col("description")))
    return with_scans(base, P, list(W["hard"]), found="score_text").select("doc_id", F.array_join(hits, ";").alias("hits"), F.size(hits).alias("n_hits"))


@query(f"WITH {TXT} SELECT CAST(count(*) AS BIGINT) AS suspects FROM txt WHERE {anywhere('st', P.lists['domain'])} AND NOT {some('st', 'domain')}")
def loose_vs_strict_hits(spark, d):
    t = F.col("score_text")
    return scored(spark, d).agg(F.count_if(rv.loose_hits(P, t) & ~some_found(F.col("score_found"), P.lists["domain"])).alias("suspects"))


@query(f"WITH {SCORED} SELECT doc_id, score, matched_hard, matched_soft, matched_negative, CASE WHEN score >= 8 THEN 'high' WHEN score >= 4 THEN 'med' ELSE 'low' END AS relevance_label FROM sc")
def relevance_score(spark, d):
    return scored(spark, d).select("doc_id", "score", *[F.array_join(c, ";").alias(c) for c in ("matched_hard", "matched_soft", "matched_negative")], rv.label(F.col("score")).alias("relevance_label"))


@query(f"WITH {SCORED} SELECT doc_id, score >= 5 AS keep, CASE WHEN score >= 5 THEN 'rule_keep_score_ge_threshold' WHEN n > 0 THEN 'rule_drop_negative_signal' WHEN h = 0 THEN 'rule_drop_no_financial_anchor' ELSE 'rule_drop_score_lt_threshold' END AS decision_reason FROM sc")
def decision_rule_only(spark, d):
    return rv.decide(scored(spark, d), P, "rule_only").select("doc_id", "keep", "decision_reason")


@query(f"WITH {SIGNALS} SELECT doc_id, keep, reason AS decision_reason FROM decided")
def decision_hybrid(spark, d):
    return rv.decide(scored(spark, d), P).select("doc_id", "keep", "decision_reason")


@query(f"WITH {SCORED} SELECT doc_id, prob >= 0.55 AS keep, CASE WHEN prob >= 0.55 THEN 'model_keep_prob_ge_threshold' ELSE 'model_drop_prob_lt_threshold' END AS decision_reason FROM sc")
def decision_authoritative(spark, d):
    return rv.decide(scored(spark, d), P, "authoritative").select("doc_id", "keep", "decision_reason")


@query(f"WITH {SIGNALS} SELECT reason AS decision_reason, keep, count(*) AS n FROM decided GROUP BY ALL")
def decision_reason_counts(spark, d):
    return rv.reason_counts(rv.decide(scored(spark, d), P))


# --- tags

@query(f"WITH {SECTORS} SELECT doc_id, sector, best_sector, sector_score, sector_title_score FROM sec")
def sector_assignment(spark, d):
    return tagged(spark, d).select("doc_id", "sector", "best_sector", "sector_score", "sector_title_score")


@query(f"WITH {TAGGED} SELECT doc_id, topics FROM top")
def topic_assignment(spark, d):
    return tagged(spark, d).select("doc_id", F.array_join(F.array_sort("topics"), ";").alias("topics"))


@query(f"WITH {TAGGED} SELECT keyword, count(*) AS n_rows FROM (SELECT doc_id, keyword, min(pos) AS pos FROM ({_trend_sql()}) GROUP BY ALL) GROUP BY keyword ORDER BY n_rows DESC, min(row(doc_id, pos)) LIMIT 10")
def keyword_trends(spark, d):
    return tg.keyword_trends(tagged(spark, d))


@query(f"WITH {TAGGED} SELECT 'sector' AS kind, sector AS name, count(*) AS n FROM tagged GROUP BY sector UNION ALL SELECT 'topic', name, count(*) FROM ({_topic_rows}) GROUP BY name")
def taxonomy_counts(spark, d):
    return tg.taxonomy_counts(tagged(spark, d))


@query(f"WITH {TAGGED} SELECT count(*) FILTER (WHERE topics = '') AS no_topic, count(*) AS n_rows, coalesce(round(CAST(count(*) FILTER (WHERE topics = '') AS DOUBLE) / nullif(count(*), 0), 4), 0.0) AS ratio FROM top")
def no_topic_ratio(spark, d):
    return tg.no_topic(tagged(spark, d))


@query("SELECT coalesce(nullif(regexp_extract(lower(url), '^[a-z]+://(?:www\\.)?([^/?#]*)', 1), ''), 'missing') AS publisher, count(*) AS n FROM pages GROUP BY 1")
def publisher_counts(spark, d):
    return read(spark, d, "pages").groupBy(F.coalesce(F.nullif(tx.host(F.col("url")), F.lit("")), F.lit("missing")).alias("publisher")).agg(F.count("*").alias("n"))


@query(f"WITH {SIGNALS} SELECT count(*) AS raw, count(*) FILTER (WHERE score > 0) AS scored, count(*) FILTER (WHERE keep) AS kept, count(*) FILTER (WHERE keep AND score >= 8) AS strong FROM decided")
def funnel_counts(spark, d):
    out = rv.decide(scored(spark, d), P)
    return rp.funnel(out, {"scored": F.col("score") > 0, "kept": F.col("keep"), "strong": F.col("keep") & (F.col("score") >= 8)})


@query(f"""WITH {GROUPS} SELECT (SELECT count(*) FROM documents) AS raw_items, (SELECT count(*) FROM art) AS normalized_articles, (SELECT count(DISTINCT cluster_key) FROM ranked) AS deduped_articles, CAST(0 AS BIGINT) AS rule_filtered_articles,
 CAST(0 AS BIGINT) AS relevance_filtered_articles, (SELECT count(*) FROM art) AS tagged_before_cluster, (SELECT count(*) FROM ranked WHERE rnk = 1) AS final_tagged_representatives, (SELECT count(*) FROM ranked WHERE rnk = 1 AND doc_id % 2 = 0) AS displayed_articles""")
def run_counts(spark, d):
    every, found = read(spark, d, "documents"), articles(spark, d)
    reps = ar.representatives(found)
    count = lambda df, stage: df.agg(F.lit(stage).alias("stage"), F.count("*").cast("string").alias("n"))
    shown = ar.title_groups(found).where("rank = 1 and doc_id % 2 = 0")
    recorded = count(every, "raw_items").union(count(found, "normalized_articles")).union(count(reps, "deduped_articles")).union(count(shown, "displayed_articles"))
    return rp.run_counts(recorded.union(count(found, "relevance_filtered_articles").withColumn("n", F.lit("many"))), found, reps)


# --- ranking

_LT, _LB = "lower(title)", "lower(description)"
_LX = f"concat_ws(' ', {_LT}, {_LB})"
_c = P.content
_reg = f"({anywhere(_LX, _c['regulator'])} AND {anywhere(_LX, _c['action'])})"
_loud = f"(({anywhere(_LT, _c['regulator'])} AND {anywhere(_LT, _c['action'])}) OR {anywhere(_LT, _c['risk'])})"
CONTENT = f"""CASE WHEN {anywhere(_LX, _c['opinion'])} THEN 'opinion' WHEN {anywhere(_LT, _c['schedule'])} AND NOT {_loud} THEN 'schedule'
 WHEN {anywhere(_LX, _c['profile'])} AND NOT ({anywhere(_LX, _c['action'])} OR {anywhere(_LX, _c['risk'])}) THEN 'profile' WHEN {_reg} THEN 'regulatory' WHEN {anywhere(_LX, _c['risk'])} THEN 'risk'
 WHEN {anywhere(_LX, _c['local_social'])} THEN 'local_social' WHEN {anywhere(_LT, _c['briefing'])} THEN 'briefing' WHEN {anywhere(_LX, _c['event'])} THEN 'event' WHEN {anywhere(_LX, _c['pr'])} THEN 'pr'
 WHEN {anywhere(_LX, _c['price_quote'])} THEN 'price_quote' WHEN {anywhere(_LX, _c['product'])} THEN 'product' WHEN {anywhere(_LX, _c['market'])} THEN 'market' ELSE 'hard_news' END"""
_s = P.source
_strong = f"({_reg} OR {anywhere(_LX, _c['risk'])})"
_pub = "lower(coalesce(press, ''))"
QUALITY = f"""CASE WHEN {anywhere(_LX, _s['regulatory'])} THEN 'regulatory' WHEN {anywhere(_pub, _s['primary_publisher'])} OR {anywhere(_LX, _s['primary'])} THEN 'primary'
 WHEN {anywhere(_LX, _s['promo_or_stock_snippet'])} THEN 'promo_or_stock_snippet' WHEN {anywhere(_LX, _s['press_release_like'])} AND NOT {_strong} THEN 'press_release_like'
 WHEN {anywhere(_LX, _s['low_information'])} AND NOT {_strong} THEN 'low_information' WHEN {_pub} = '' THEN 'unknown' WHEN {anywhere(_pub, _s['major_finance'])} THEN 'major_finance'
 WHEN {anywhere(_pub, _s['major_general'])} THEN 'major_general' WHEN {anywhere(_pub, _s['specialist'])} THEN 'specialist' WHEN {anywhere(_pub, _s['regional'])} THEN 'regional' ELSE 'unknown' END"""


def parts(df):
    return rk.with_parts(df, rk.rank_terms(P), title_parts=F.lower("title"), text_parts=F.lower(F.concat_ws(" ", "title", "description")))


@query(f"WITH {ART} SELECT doc_id, {CONTENT} AS content_type FROM art")
def content_type(spark, d):
    return parts(articles(spark, d)).select("doc_id", rk.content_type(P, F.col("title_parts"), F.col("text_parts")).alias("content_type"))


@query(f"WITH {ART} SELECT doc_id, {QUALITY} AS source_quality FROM art")
def source_quality(spark, d):
    return parts(articles(spark, d)).select("doc_id", rk.source_quality(P, F.col("text_parts"), F.col("press")).alias("source_quality"))


SECTOR_POINTS = {"german": 2.1, "french": 1.6, "spanish": 1.5, "english": 0.9}
ANCHORS = [(["license", "copyright"], 2.0), (["der", "les"], 1.5), (["thsh", "legal"], 0.9)]
NOISE = [(["worthless", "trash"], -1.2), (["###"], -1.3)]
TOPIC_PENALTIES = {"insult": -1.8, "article": -0.4}
RULES = rk.RankRules(SECTOR_POINTS, ANCHORS, NOISE, TOPIC_PENALTIES, "romance", ["this", "clown"], ["copyright", "rights"])


def ranked(spark, d):
    df = tagged(spark, d)
    keyed = ar.title_groups(df).drop("rank")
    return rk.rank_score(keyed, P, RULES)


def _case(column: str, table: dict[str, float]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in table.items()) + " ELSE 0 END"


RANKED = f"""{TAGGED}, gk AS (WITH {GROUPS} SELECT doc_id, cluster_key, cluster_size FROM ranked), rk0 AS (SELECT top.*, gk.cluster_key, gk.cluster_size, {CONTENT} AS content_type, {QUALITY} AS source_quality FROM top JOIN gk USING (doc_id)),
rk AS (SELECT *, CASE WHEN score > 1 THEN score ELSE score * 7.5::DOUBLE END + least(greatest(cluster_size, 1), 5) * 0.28::DOUBLE + {_case('sector', SECTOR_POINTS)}::DOUBLE
 + {' + '.join(f"CASE WHEN {anywhere(_LX, t)} THEN {w} ELSE 0 END::DOUBLE + CASE WHEN {anywhere('topics', t)} THEN {w} * 0.7 ELSE 0 END::DOUBLE" for t, w in ANCHORS)}
 + {' + '.join(f"CASE WHEN {anywhere(_LX, t)} THEN {w} ELSE 0 END::DOUBLE" for t, w in NOISE)} + {' + '.join(f"CASE WHEN topic_{t} THEN {w} ELSE 0 END::DOUBLE" for t, w in TOPIC_PENALTIES.items())}
 + {_case('content_type', rk.CONTENT_POINTS)}::DOUBLE + CASE WHEN source_quality = 'unknown' AND content_type IN ('regulatory', 'risk') THEN -0.1 ELSE {_case('source_quality', P.source_adjustments)} END::DOUBLE
 + CASE WHEN content_type = 'price_quote' AND topic_romance THEN -0.4 ELSE 0 END::DOUBLE + CASE WHEN {anywhere(_LX, RULES.notices)} THEN CASE WHEN {anywhere(_LX, RULES.policy)} THEN -0.8 ELSE -1.4 END ELSE 0 END::DOUBLE
 + epoch(pub_date) / 1e12 AS rank_score FROM rk0)"""


@query(f"WITH {RANKED} SELECT doc_id, content_type, source_quality, round(rank_score, 6) AS rank_score FROM rk")
def rank_score(spark, d):
    return ranked(spark, d).select("doc_id", "content_type", "source_quality", F.round("rank_score", 6).alias("rank_score"))


@query(f"WITH {SECTORS} SELECT sector, doc_id, CAST(place AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY sector ORDER BY pub_date DESC, doc_id) AS place FROM sec) WHERE place <= 10")
def sector_newest_10(spark, d):
    return tg.newest_per_sector(tagged(spark, d)).select("sector", "doc_id", "rank")


@query(f"WITH {SECTORS} SELECT doc_id, prob FROM sec WHERE sector = 'misc' AND prob >= 0.8 ORDER BY pub_date DESC, doc_id LIMIT 10")
def misc_newest_10(spark, d):
    return rk.misc_newest(tagged(spark, d)).select("doc_id", "prob")


@query()
def capped_top_10(spark, d):
    return rk.capped_top(ranked(spark, d))


@query(f"WITH {TAGGED} SELECT 'sector' AS facet, sector AS name, count(*) AS n FROM top GROUP BY sector UNION ALL SELECT 'topic', name, count(*) FROM ({_topic_rows} UNION ALL SELECT doc_id, 'none' FROM top WHERE topics = '') GROUP BY name")
def facet_counts(spark, d):
    return rp.facets(tagged(spark, d))


@query(f"WITH {TAGGED} SELECT doc_id, sector, score FROM top WHERE (contains(lower(concat_ws(' ', title, description, topics)), 'license') OR contains(lower(concat_ws(' ', title, description, topics)), 'clown')) ORDER BY score DESC, pub_date DESC, doc_id LIMIT 20")
def search_page(spark, d):
    return rp.search(tagged(spark, d), "license clown", sort="relevance").select("doc_id", "sector", "score")


# --- events and clusters

@query(f"""WITH {ART}, tk AS (SELECT min(doc_id) AS doc_id, tokens FROM (SELECT doc_id, list_sort(list_distinct(regexp_extract_all(trim(regexp_replace(lower(title), '{SPACE}', ' ', 'g')), '[\\p{{L}}\\p{{N}}]{{2,}}'))) AS tokens FROM art) WHERE len(tokens) > 0 GROUP BY tokens)
SELECT a.doc_id AS doc_a, b.doc_id AS doc_b, round(CAST(len(list_intersect(a.tokens, b.tokens)) AS DOUBLE) / len(list_distinct(list_concat(a.tokens, b.tokens))), 6) AS jaccard FROM tk a JOIN tk b ON a.doc_id < b.doc_id
 WHERE CAST(len(list_intersect(a.tokens, b.tokens)) AS DOUBLE) / len(list_distinct(list_concat(a.tokens, b.tokens))) >= 0.5""")
def title_pair_jaccard(spark, d):
    return ev.title_pairs(articles(spark, d), 0.5)


@query()
def title_pair_ratio(spark, d):
    return ev.ratio_pairs(articles(spark, d), 0.88)


ENTITIES = ["idiot", "clown", "license"]
ISSUES = {"art": ["the", "der", "les"], "link": ["and", "und", "et"], "of": ["of", "des", "del"],  # words that most titles hold, and rare ones
          "law": ["license", "copyright", "software"], "insult": ["worthless", "disgusting", "pathetic", "trash"], "odd": ["thsh", "enth", "ondble"]}


@query()
def event_clusters(spark, d):
    base = tagged(spark, d).withColumn("report_date", F.to_date(F.date_trunc("day", "pub_date")))
    feats = ev.features(base, ENTITIES, ISSUES, ["trash"], [("law:license", ["license", "under"])])
    return ev.event_clusters(feats).select("report_date", "ingest_seq", "cluster_id", "cluster_size")


@query(f"WITH {GROUPS}, g AS (SELECT cluster_key, count(*) AS n FROM ranked GROUP BY 1) SELECT count(*) AS clusters, CAST(quantile_disc(n, 0.5) AS BIGINT) AS p50, CAST(quantile_disc(n, 0.95) AS BIGINT) AS p95, max(n) AS largest FROM g")
def cluster_size_percentiles(spark, d):
    return ev.size_percentiles(ar.representatives(articles(spark, d)).select("cluster_size"))


@query(f"WITH {GROUPS} SELECT cluster_key, count(*) AS n FROM ranked GROUP BY 1 HAVING count(*) >= 4 ORDER BY n DESC, cluster_key LIMIT 10")
def mega_clusters(spark, d):
    return ar.representatives(articles(spark, d)).select("cluster_key", F.col("cluster_size").alias("n")).where("n >= 4").orderBy(F.desc("n"), "cluster_key").limit(10)


@query(f"""WITH {GROUPS}, c AS (SELECT cluster_key, press, count(*) AS n FROM grp GROUP BY ALL), h AS (SELECT CAST(sum(n * (n - 1) // 2) AS BIGINT) AS hit FROM c),
g AS (SELECT CAST(sum(n * (n - 1) // 2) AS BIGINT) AS predicted, sum(most) AS most, sum(n) AS nr FROM (SELECT sum(n) AS n, max(n) AS most FROM c GROUP BY cluster_key)),
e AS (SELECT CAST(sum(n * (n - 1) // 2) AS BIGINT) AS actual FROM (SELECT sum(n) AS n FROM c GROUP BY press))
SELECT hit, predicted, actual, coalesce(round(CAST(hit AS DOUBLE) / nullif(predicted, 0), 6), 0.0) AS precision, coalesce(round(CAST(hit AS DOUBLE) / nullif(actual, 0), 6), 0.0) AS recall, coalesce(round(CAST(most AS DOUBLE) / nullif(nr, 0), 6), 0.0) AS purity FROM h, g, e""")
def cluster_pair_quality(spark, d):
    return ev.pair_quality(ar.title_groups(articles(spark, d)), "cluster_key", "press")


@query(f"""WITH {GROUPS}, c AS (SELECT lower(trim(title)) AS o, cluster_key AS n, count(*) AS k FROM grp GROUP BY ALL),
s AS (SELECT CAST(sum(k * (k - 1) // 2) AS BIGINT) AS kept FROM c), w AS (SELECT CAST(sum(k * (k - 1) // 2) AS BIGINT) AS was FROM (SELECT sum(k) AS k FROM c GROUP BY o)), v AS (SELECT CAST(sum(k * (k - 1) // 2) AS BIGINT) AS now FROM (SELECT sum(k) AS k FROM c GROUP BY n))
SELECT now - kept AS merged, was - kept AS split, kept FROM s, w, v""")
def cluster_membership_diff(spark, d):
    g = ar.title_groups(articles(spark, d))
    return ev.membership_diff(g.select("doc_id", F.lower(F.trim("title")).alias("grp")), g.select("doc_id", F.col("cluster_key").alias("grp")))


# --- summaries

_low = r"""(l = '' OR regexp_matches(l, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}') OR regexp_matches(l, '^[^\p{L}\p{N}]+$') OR (length(l) <= 12 AND NOT regexp_matches(l, '\p{L}{2,}|[0-9]{2,}')) OR (regexp_matches(l, 'https?://|www\.') AND length(l) < 50) OR regexp_matches(l, '^[0-9\s:./-]{5,}$'))"""
LINES = f"ln AS (SELECT doc_id, unnest(string_split(replace(text, chr(13), chr(10)), chr(10))) AS raw, generate_subscripts(string_split(replace(text, chr(13), chr(10)), chr(10)), 1) - 1 AS pos FROM documents WHERE text IS NOT NULL), l1 AS (SELECT doc_id, pos, trim(regexp_replace(raw, '{SPACE}', ' ', 'g')) AS l FROM ln), l2 AS (SELECT doc_id, lower(l) AS k, min(pos) AS pos FROM l1 WHERE NOT {_low} GROUP BY 1, 2)"


@query(f"WITH {LINES} SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, md5(string_agg(k, chr(10) ORDER BY pos)) AS digest FROM l2 GROUP BY doc_id")
def boilerplate_line_dedup(spark, d):
    lines = read(spark, d, "documents").where(F.col("text").isNotNull()).select("doc_id", F.inline(F.array(F.struct(F.transform(sm.clean_lines(F.col("text")), F.lower).alias("lines")))))
    return lines.where(F.size("lines") > 0).select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.md5(F.array_join("lines", "\n").cast("binary")).alias("digest"))


@query("WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]{2,}')) AS w FROM documents) SELECT w, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM t GROUP BY w HAVING count(*) >= 20")
def corpus_term_frequency(spark, d):
    words = F.regexp_extract_all(F.lower("text"), F.lit(tx.TOKEN), F.lit(0))
    per_doc = read(spark, d, "documents").select("doc_id", F.explode(words).alias("w")).groupBy("doc_id", "w").agg(F.count("*").alias("k"))
    return per_doc.groupBy("w").agg(F.sum("k").alias("n"), F.count("*").alias("n_docs")).where("n >= 20")


# a document's clean lines as one text, its sentences, and the terms of the first 80
SENT = f"""{LINES}, l3 AS (SELECT doc_id, pos, arg_min(l, pos) AS l FROM l1 SEMI JOIN l2 USING (doc_id, pos) GROUP BY ALL), ct AS (SELECT doc_id, string_agg(l, ' ' ORDER BY pos) AS t FROM l3 GROUP BY doc_id),
sp AS (SELECT doc_id, string_split(regexp_replace(t, '([.!?])\\s+', '\\1' || chr(31), 'g'), chr(31)) AS parts FROM ct), st AS (SELECT doc_id, unnest(parts) AS s, generate_subscripts(parts, 1) AS pos FROM sp),
sn AS (SELECT doc_id, trim(s) AS s, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS n FROM st WHERE length(trim(s)) >= 16)"""


@query(f"WITH {SENT}, w AS (SELECT doc_id, unnest(regexp_extract_all(s, '[\\p{{L}}\\p{{N}}]{{2,}}')) AS term FROM sn WHERE n <= 80) SELECT doc_id, term, count(*) AS n FROM w GROUP BY ALL")
def sentence_term_frequency(spark, d):
    return sm.term_frequency(read(spark, d, "documents").where(F.col("text").isNotNull()))


WORDS = sm.SummaryWords(figure=r"\d", action="license|copyright", types={"law": (frozenset(["License", "license", "copyright"]), "license|rights"), "insult": (frozenset(["idiot", "worthless"]), "pathetic|trash")}, junk=("###",))


@query()
def extractive_summary(spark, d):
    return sm.summarize(articles(spark, d), WORDS)


@query()
def main_text_extraction(spark, d):
    out = sm.main_texts(read(spark, d, "pages"))
    return out.select("page_id", "main_text", F.length("main_text").alias("n_chars"))


# --- caches, batches, contracts

@query(f"""WITH {ART}, c AS (SELECT left(sha256(coalesce(text, '')), 16) AS key, min(doc_id) AS value, min(TIMESTAMP '2024-01-01' + to_hours(CAST(doc_id AS INTEGER))) AS created_at FROM documents WHERE doc_id % 3 = 0 GROUP BY 1)
SELECT a.doc_id, c.value, CASE WHEN c.value IS NULL THEN 'miss' WHEN TIMESTAMP '2024-01-31' - c.created_at <= INTERVAL 14 DAY AND TIMESTAMP '2024-01-31' >= c.created_at THEN 'hit' ELSE 'stale' END AS cache_state FROM art a LEFT JOIN c ON left(sha256(a.text), 16) = c.key""")
def cache_lookup(spark, d):
    docs = read(spark, d, "documents")
    created = F.timestamp_add("HOUR", F.col("doc_id").cast("int"), F.lit("2024-01-01").cast("timestamp_ntz"))
    cache = docs.where(F.col("doc_id") % 3 == 0).groupBy(tx.fingerprint(F.col("text")).alias("key")).agg(F.min("doc_id").alias("value"), F.min(created).alias("created_at"))
    return ct.lookup(articles(spark, d).withColumn("key", tx.fingerprint(F.col("text"))), cache, "key", F.lit("2024-01-31").cast("timestamp_ntz")).select("doc_id", "value", "cache_state")


@query("SELECT page_id, url FROM pages ORDER BY page_id DESC LIMIT 100")
def cache_trim(spark, d):
    return ct.trim_cache(read(spark, d, "pages").select("page_id", "url"), "page_id", 100)


@query("SELECT doc_id, source, CAST(floor((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) / 25) AS INTEGER) AS batch_no FROM documents")
def fixed_batches(spark, d):
    return ct.fixed_batches(read(spark, d, "documents"), "doc_id", 25, "source").select("doc_id", "source", "batch_no")


@query()
def budget_batches(spark, d):
    return ct.budget_batches(read(spark, d, "documents"), "doc_id", "n_chars", "source")




@query(r"""SELECT conv_id, turn, trim(coalesce(text, '')) = '' AS is_empty, regexp_matches(coalesce(text, ''), '[\n\r\t]') AS has_break, length(trim(coalesce(text, ''))) > 90 AS too_long,
 regexp_matches(trim(coalesce(text, '')), '\*\*|__|~~|`') AS has_markdown, NOT regexp_matches(trim(coalesce(text, '')), '[.!?。]["''’”』」)\]]*$') AS no_end FROM conversations""")
def line_contract_flags(spark, d):
    f = ct.line_flags(F.col("text"))
    return read(spark, d, "conversations").select("conv_id", "turn", *[f[k].alias(k) for k in ("is_empty", "has_break", "too_long", "has_markdown", "no_end")])


@query()
def batch_response_validation(spark, d):
    docs = articles(spark, d).withColumn("batch", (F.col("doc_id") / 25).cast("long"))
    asked = docs.select("batch", F.concat(F.lit("article_"), F.col("doc_id").cast("string")).alias("id"), "title")
    three = F.array(*[F.concat(F.lit(f"Line {k} of "), F.col("doc_id").cast("string"), F.lit(" says so.")) for k in "ABC"])
    entry = F.struct(F.concat(F.lit("article_"), F.col("doc_id").cast("string")).alias("id"), (F.col("doc_id") % 7 != 0).alias("usable"), F.when(F.col("doc_id") % 7 == 0, F.lit("multi_topic")).when(F.col("doc_id") % 11 == 0, F.lit("odd")).otherwise(F.lit("ok")).alias("reason"), F.when(F.col("doc_id") % 7 == 0, F.array().cast("array<string>")).when(F.col("doc_id") % 5 == 0, F.slice(three, 1, 2)).otherwise(three).alias("lines"))
    sent = docs.where(F.col("doc_id") % 13 != 0).groupBy("batch").agg(F.to_json(F.struct(F.array_sort(F.collect_list(entry)).alias("summaries"))).alias("body"))
    return ct.check_responses(asked, sent)


# the twin writes the same responses as JSON, reads them again and applies the rules to what it reads
ORACLE_SQL["batch_response_validation"] = r"""WITH asked AS (SELECT doc_id // 25 AS batch, 'article_' || doc_id AS id, split_part(text, chr(10), 1) AS title, doc_id FROM documents WHERE text IS NOT NULL),
entry AS (SELECT batch, doc_id, struct_pack(id := id, usable := doc_id % 7 <> 0, reason := CASE WHEN doc_id % 7 = 0 THEN 'multi_topic' WHEN doc_id % 11 = 0 THEN 'odd' ELSE 'ok' END,
 lines := CASE WHEN doc_id % 7 = 0 THEN []::VARCHAR[] ELSE list_transform(['A', 'B', 'C'][1:CASE WHEN doc_id % 5 = 0 THEN 2 ELSE 3 END], lambda k: 'Line ' || k || ' of ' || doc_id || ' says so.') END) AS e FROM asked WHERE doc_id % 13 <> 0),
sent AS (SELECT batch, to_json(struct_pack(summaries := list(e))) AS body FROM entry GROUP BY batch),
got AS (SELECT batch, unnest(from_json(body, '{"summaries": [{"id": "VARCHAR", "usable": "BOOLEAN", "reason": "VARCHAR", "lines": ["VARCHAR"]}]}').summaries) AS e FROM sent),
judged AS (SELECT g.batch, e.id AS id, CASE WHEN e.id IS NULL THEN 'id_not_string' WHEN a.id IS NULL THEN 'unknown_id' WHEN e.usable IS NULL OR e.reason IS NULL THEN 'usable_contract'
 WHEN NOT e.usable AND e.reason NOT IN ('title_body_mismatch', 'multi_topic', 'insufficient_content') THEN 'unusable_reason_conflict' WHEN NOT e.usable AND len(e.lines) > 0 THEN 'unusable_lines_present' WHEN NOT e.usable THEN 'content_rejected'
 WHEN e.reason <> 'ok' THEN 'usable_reason_conflict' WHEN len(e.lines) <> 3 OR len(list_distinct(list_transform(e.lines, lambda x: lower(x)))) <> 3 OR list_contains(list_transform(e.lines, lambda x: lower(trim(x))), lower(a.title))
  OR len(list_filter(e.lines, lambda x: trim(x) = '' OR length(x) > 90 OR regexp_matches(x, '[\n\r\t]|\*\*|__|~~|`|^\s*[-*+>]') OR NOT regexp_matches(x, '[.!?]$') OR regexp_matches(x, '[.!?]\s'))) > 0 THEN 'line_contract' ELSE 'accepted' END AS outcome
 FROM got g LEFT JOIN asked a ON a.batch = g.batch AND a.id = e.id)
SELECT batch, id, outcome FROM judged UNION ALL SELECT batch, id, 'missing_id' FROM asked ANTI JOIN judged USING (batch, id)"""


# --- labels and models

LABELS = lb.LabelRules(sure=((["license"], ["copyright", "software"], "strong_license"), (["worthless", "disgusting"], [], "strong_insult")), never=["clown"], macro=["the", "der"], industry=["that", "und"], finance=["les", "des"], regulators=["que"], actions=["los"], vague=["ing"])
_has = lambda terms: anywhere("lx", terms)
_for = "CASE " + " ".join(f"WHEN {_has(a)}{f' AND {_has(s)}' if s else ''} THEN '{r}'" for a, s, r in LABELS.sure) + " END"


@query(f"""WITH {SIGNALS}, x0 AS (SELECT *, lower(concat_ws(chr(10), title, description)) AS lx, matched_hard <> '' AS hard, matched_negative <> '' AS neg FROM decided),
x1 AS (SELECT *, {_for} AS for_it, keep AND score >= 6 AND hard AND NOT neg AS ruled, CASE WHEN {_has(LABELS.never)} THEN 'drop_obvious_non_finance' WHEN neg THEN 'drop_negative_signal'
 WHEN {_has(LABELS.macro)} AND {_has(LABELS.industry)} AND NOT {_has(LABELS.finance)} THEN 'drop_corporate_macro_noise' WHEN NOT keep AND score <= 2 THEN 'drop_score_le_2' END AS against FROM x0),
x2 AS (SELECT *, coalesce(for_it, CASE WHEN ruled THEN 'rule_keep' END) AS kept_by FROM x1)
SELECT doc_id, CASE WHEN kept_by IS NOT NULL AND against IS NOT NULL THEN 'review|0.0|review_conflicting_signals:' || kept_by || ':' || against WHEN for_it IS NOT NULL THEN '1|0.95|' || for_it WHEN ruled THEN CASE WHEN score >= 8 THEN '1|0.85|' ELSE '1|0.75|' END || 'rule_keep_score_ge_6_with_hard_match'
 WHEN against IN ('drop_negative_signal', 'drop_obvious_non_finance') THEN '0|0.95|' || against WHEN against = 'drop_corporate_macro_noise' THEN '0|0.85|' || against WHEN against IS NOT NULL THEN '0|0.75|' || against
 ELSE 'review|0.0|' || CASE WHEN length(trim(title)) < 6 AND length(trim(description)) < 12 THEN 'review_text_too_short' WHEN score BETWEEN 3 AND 5 THEN 'review_mid_score_ambiguous' WHEN {_has(LABELS.macro)} AND NOT {_has(LABELS.finance)} THEN 'review_generic_macro_only'
  WHEN {_has(LABELS.regulators)} AND NOT {_has(LABELS.actions)} THEN 'review_regulator_without_action_context' WHEN {_has(LABELS.vague)} THEN 'review_ambiguous_market_context' ELSE 'review_no_conservative_rule_matched' END END AS auto_label FROM x2""")
def pseudo_labels(spark, d):
    df = rv.decide(scored(spark, d), P)
    x = lb.pseudo_label(LABELS, F.col("title"), F.col("description"), F.col("score"), F.col("matched_hard"), F.col("matched_negative"), F.col("keep"), F.col("decision_reason"))
    return df.withColumn("x", x).select("doc_id", F.concat_ws("|", "x.label", F.col("x.confidence").cast("string"), "x.reason").alias("auto_label"))


@query("""WITH j AS (SELECT CASE WHEN l.quality IS NULL THEN '' ELSE CAST(l.quality AS VARCHAR) END AS label, d.source AS url FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT count(*) AS n_rows, count(*) FILTER (WHERE label = '') AS blank, count(*) FILTER (WHERE label NOT IN ('', '0', '1', 'review')) AS invalid, count(*) FILTER (WHERE label IN ('0', '1')) AS usable, count(*) FILTER (WHERE label = 'review') AS review,
 count(*) FILTER (WHERE url IS NULL) AS missing_url, CAST((SELECT coalesce(sum(c - 1), 0) FROM (SELECT count(*) AS c FROM j WHERE url IS NOT NULL GROUP BY url)) AS BIGINT) AS duplicates FROM j""")
def label_validation(spark, d):
    j = read(spark, d, "documents").join(read(spark, d, "labels"), "doc_id", "left")
    return lb.validate(j.select(F.col("quality").alias("label"), F.col("source").alias("url")))


@query("SELECT doc_id, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY md5('42:' || doc_id), doc_id) AS turn FROM documents) ORDER BY turn, lang, source LIMIT 200")
def stratified_round_robin(spark, d):
    return lb.stratified(read(spark, d, "documents"), ["lang", "source"], "doc_id", 200).select("doc_id", "lang", "source")


_TH = (0.35, 0.5, 0.6, 0.65, 0.7, 0.8)


@query(f"""WITH j AS (SELECT quality AS y, CAST((doc_id * 7919) % 1000 AS DOUBLE) / 1000 AS p FROM labels WHERE quality IS NOT NULL), t AS (SELECT unnest([{', '.join(map(str, _TH))}])::DOUBLE AS threshold),
c AS (SELECT threshold, count(*) FILTER (WHERE p >= threshold AND y = 1) AS tp, count(*) FILTER (WHERE p >= threshold AND y <> 1) AS fp, count(*) FILTER (WHERE p < threshold AND y = 1) AS fn, count(*) FILTER (WHERE p < threshold AND y <> 1) AS tn FROM t, j GROUP BY threshold)
SELECT *, round(coalesce(CAST(tp + tn AS DOUBLE) / nullif(tp + fp + fn + tn, 0), 0), 6) AS accuracy, round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM c""")
def threshold_metrics(spark, d):
    df = read(spark, d, "labels").where(F.col("quality").isNotNull()).select("quality", ((F.col("doc_id") * 7919) % 1000 / 1000.0).alias("p"))
    return lb.threshold_metrics(df, "p", "quality", _TH)


@query("""WITH j AS (SELECT doc_id, quality, CAST((doc_id * 7919) % 1000 AS DOUBLE) / 1000 AS p, CAST(doc_id % 5 AS INTEGER) AS conf FROM labels WHERE quality IS NOT NULL)
SELECT doc_id, conf, gap FROM (SELECT *, round(abs(p - 0.65), 6) AS gap FROM j WHERE CAST(p >= 0.65 AS INTEGER) <> quality) ORDER BY conf DESC, gap DESC, doc_id LIMIT 50""")
def disagreements_top(spark, d):
    df = read(spark, d, "labels").where(F.col("quality").isNotNull()).select("doc_id", "quality", ((F.col("doc_id") * 7919) % 1000 / 1000.0).alias("p"), (F.col("doc_id") % 5).cast("int").alias("conf"))
    return lb.disagreements(df, "p", "quality", "conf", 50).select("doc_id", "conf", "gap")


@query()
def char_ngram_classifier(spark, d):
    rows = articles(spark, d).select("doc_id", ar.model_text(F.col("title"), F.col("description")).alias("text")).join(read(spark, d, "labels").where(F.col("quality").isNotNull()), "doc_id")
    train = rows.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 0)
    model = lb.fit_classifier(train, "text", "quality")
    return model.add(rows.select("doc_id", "text", "quality")).select("doc_id", "quality", F.round("prob", 6).alias("prob"))


# --- files, runs, streams

@query("""WITH f AS (SELECT DISTINCT 'candidates_' || strftime(o_orderdate, '%Y-%m-%d') || '.csv' AS name, CAST(o_orderdate AS DATE) AS file_date FROM orders),
r AS (SELECT *, CASE WHEN file_date >= DATE '1997-01-01' THEN 'current_or_future' WHEN file_date < DATE '1997-01-01' - 91 THEN 'outside_lookback' ELSE 'included' END AS reason FROM f)
SELECT name, CASE WHEN reason = 'included' AND row_number() OVER (PARTITION BY reason ORDER BY file_date DESC, name DESC) > 60 THEN 'beyond_max_files' ELSE reason END AS reason FROM r""")
def eligible_files(spark, d):
    names = read(spark, d, "orders").select(F.concat(F.lit("candidates_"), F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd"), F.lit(".csv")).alias("name")).distinct()
    return rp.eligible_files(names, dt.date(1997, 1, 1), 91, 60).select("name", "reason")


@query("SELECT DISTINCT 'report_' || strftime(o_orderdate, '%Y-%m-%d') || '.html' AS name FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1998-01-01' - 180")
def retention(spark, d):
    names = read(spark, d, "orders").select(F.concat(F.lit("report_"), F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd"), F.lit(".html")).alias("name")).distinct()
    return rp.retained(names, dt.date(1998, 1, 1), 180)


@query("""WITH x AS (SELECT event_type, value, unnest([date_trunc('day', ts - INTERVAL 0 MINUTE) + INTERVAL 1 DAY, CASE WHEN ts >= date_trunc('day', ts) + INTERVAL '23:45' HOUR TO MINUTE THEN date_trunc('day', ts) + INTERVAL 2 DAY END]) AS run_end FROM events)
SELECT run_end, event_type, count(*) AS n, round(sum(value), 4) AS total FROM x WHERE run_end IS NOT NULL GROUP BY ALL""".replace("INTERVAL '23:45' HOUR TO MINUTE", "INTERVAL 1425 MINUTE"))
def overlapping_runs(spark, d):
    out = wn.runs(read(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")))
    return out.select(F.col("run_end").cast("timestamp_ntz").alias("run_end"), "event_type", "n", F.round("total", 4).alias("total"))


def _new_folder(spark, tag: str) -> str:
    return f"{checkpoint_root(spark)}/{tag}-{uuid.uuid4().hex[:8]}"


def _stream_path(spark, d: str, name: str) -> str:
    source = f"{d}/{name}"
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source)
    if fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(fs).isFile():
        source = f"{d}/{name.replace('.', '[.]')}"  # a glob: the stream source lists it like a folder
    return source


@query()
def overlapping_runs_stream(spark, d):
    root = _new_folder(spark, "runs")
    wn.stream_runs(spark, _stream_path(spark, d, "events.parquet"), read(spark, d, "events").schema, f"{root}/state", f"{root}/out")
    return wn.current(spark, f"{root}/out").select(F.col("run_end").cast("timestamp_ntz").alias("run_end"), "event_type", "n", F.round("total", 4).alias("total"))


ORACLE_SQL["overlapping_runs_stream"] = ORACLE_SQL["overlapping_runs"]


CACHE_TTL, CACHE_CAP = dt.timedelta(days=14), 500


@query(f"""WITH e AS (SELECT user_id || '/' || event_type AS key, ts, props AS value FROM events WHERE user_id IS NOT NULL AND event_type IS NOT NULL AND ts IS NOT NULL),
k AS (SELECT key, max(struct_pack(ts := ts, value := coalesce(value, ''))) AS x FROM e GROUP BY key), z AS (SELECT max(ts) AS now FROM e)
SELECT key, x.ts AS ts, x.value AS value FROM k, z WHERE x.ts > now - INTERVAL {CACHE_TTL.days} DAY ORDER BY x.ts DESC, key LIMIT {CACHE_CAP}""")
def keyed_cache_state(spark, d):
    """The newest entry per user and kind of event within two weeks of the last, at most CACHE_CAP, kept as a stream's state."""
    events = read(spark, d, "events")
    stream = spark.readStream.schema(events.schema).parquet(_stream_path(spark, d, "events.parquet"))
    state = _new_folder(spark, "cache")
    cc.feed(stream.select(F.concat_ws("/", F.col("user_id").cast("string"), "event_type").alias("key"), F.col("ts").cast("timestamp").alias("ts"), F.col("props").alias("value")).where("user_id is not null and event_type is not null"), state, CACHE_TTL, CACHE_CAP)
    now = events.agg(F.max(F.col("ts").cast("timestamp"))).first()[0]
    return cc.current(spark, state, now, CACHE_TTL, CACHE_CAP).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(f"WITH {TAGGED} SELECT line FROM (SELECT '# Report' AS line UNION ALL SELECT DISTINCT '## ' || sector FROM top)")
def markdown_headings(spark, d):
    return rp.markdown(tagged(spark, d), "Report").where("item_no = 0").select("line")


@query(f"""WITH {GROUPS}, r AS (SELECT doc_id FROM ranked WHERE rnk = 1), q AS (WITH {SCORED} SELECT sc.*, CASE WHEN {anywhere('link', P.lists['blocked_domains'])} OR {some('rt', 'sports')} OR ({some('rt', 'politics')} AND NOT {some('rt', 'finance')}) OR ({some('rt', 'lease')} AND NOT {some('rt', 'strong')})
 OR (NOT {some('rt', 'strong')} AND ({some('rt', 'show_strong')} OR {count('rt', 'show_weak')} >= 2)) THEN FALSE ELSE TRUE END AS ok FROM sc),
k AS (SELECT q.* FROM q JOIN r USING (doc_id) WHERE ok AND score >= 5)
SELECT keyword, count(*) AS n FROM ({' UNION ALL '.join(f"SELECT '{t}' AS keyword FROM k WHERE {has('st', t)}{' AND ' + _guard[t] if t in _guard else ''}" for t in W['hard'])}) GROUP BY keyword ORDER BY n DESC, keyword LIMIT 10""")
def top_keywords(spark, d):
    """Top hard terms of de-duplicated, relevant documents: the minimum slice end to end."""
    reps = ar.representatives(articles(spark, d)).select("doc_id")
    df = scored(spark, d).join(reps, "doc_id", "left_semi").where(rv.drop_reason(P, F.col("rule_found"), F.col("link")).isNull())
    kept = rv.decide(df, P, "rule_only").where("keep")
    return kept.select(F.explode("matched_hard").alias("keyword")).groupBy("keyword").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "keyword").limit(10)


from . import run_queries as _run_queries  # noqa: E402, F401  # registers its queries too
