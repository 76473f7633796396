"""Registered queries over what a run decides, shows and records, each with its SQL twin where SQL can express it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.terms import SYNTHETIC as P
from ..operators import articles as ar
from ..operators import events as ev
from ..operators import labels as lb
from ..operators import quality as ql
from ..operators import ranking as rk
from ..operators import relevance as rv
from ..operators import reports as rp
from ..operators import runs as rn
from ..sources.tables import read, written
from .queries import ART, GROUPS, LINES, SCORED, SECTORS, SIGNALS, SPACE, TAGGED, anywhere, articles, query, scored, some, tagged  # noqa: F401

_LINES3 = "string_split(text, chr(10))[1:3]"
_SOUND = f"(len({_LINES3}) = 3 AND len(list_filter({_LINES3}, lambda x: trim(x) = '')) = 0)"


@query(f"""WITH {ART}, s AS (SELECT *, CASE WHEN doc_id % 5 = 0 THEN 'multi_topic' ELSE '' END AS rejection FROM art)
SELECT doc_id, CASE WHEN {_SOUND} THEN 'ai' WHEN rejection <> '' THEN 'content_rejected' ELSE 'preview' END AS state,
 md5(CASE WHEN {_SOUND} THEN array_to_string(list_transform({_LINES3}, lambda x: trim(x)), ' ') WHEN rejection <> '' AND length(trim(description)) >= 24 THEN trim(description) ELSE trim(title) END) AS shown FROM s""")
def display_state_text(spark, d):
    lines, refused = F.slice(F.split("text", "\n"), 1, 3), F.when(F.col("doc_id") % 5 == 0, "multi_topic").otherwise("")
    shown = rn.display_text(lines, refused, F.col("description"), F.col("title"))
    return articles(spark, d).select("doc_id", rn.summary_state(lines, refused).alias("state"), F.md5(shown.cast("binary")).alias("shown"))


@query("""WITH j AS (SELECT CASE WHEN d.doc_id % 9 = 0 THEN 'review' ELSE CAST(l.quality AS VARCHAR) END AS lab, d.text FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT CASE WHEN lab = 'review' THEN 'review' WHEN lab IN ('0', '1') AND trim(coalesce(text, '')) <> '' THEN 'used' ELSE 'blank_or_invalid' END AS use, count(*) AS n FROM j GROUP BY 1""")
def usable_training_rows(spark, d):
    rows = read(spark, d, "documents").join(read(spark, d, "labels"), "doc_id", "left")
    label = F.when(F.col("doc_id") % 9 == 0, "review").otherwise(F.col("quality").cast("string"))
    return lb.usable(rows.withColumn("auto_label", label)).groupBy("use").agg(F.count("*").alias("n"))


@query(f"""WITH {ART}, k AS (SELECT doc_id, coalesce('u:' || nullif(trim(CASE WHEN doc_id % 2 = 0 THEN press ELSE '' END), ''), 't:' || trim(regexp_replace(lower(title), '{SPACE}', ' ', 'g'))) AS k FROM art)
SELECT min(doc_id) AS doc_id FROM k GROUP BY k""")
def dedup_url_else_title(spark, d):
    rows = articles(spark, d).withColumn("url", F.when(F.col("doc_id") % 2 == 0, F.col("press")).otherwise(""))
    return lb.first_by_key(rows).select("doc_id")


@query("SELECT doc_id, lang FROM (SELECT * FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 100)")
def deterministic_sample(spark, d):
    return lb.hashed_sample(read(spark, d, "documents"), "doc_id", 100, "lang", "doc_id").select("doc_id", "lang")


@query("""WITH r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5('42:' || doc_id), doc_id) AS n, count(*) OVER (PARTITION BY quality) AS c FROM labels WHERE quality IS NOT NULL)
SELECT doc_id, CASE WHEN n <= round_even(c * 0.25, 0) THEN 'test' ELSE 'train' END AS part FROM r""")
def stratified_holdout(spark, d):
    rows, _ = lb.stratified_holdout(read(spark, d, "labels").where(F.col("quality").isNotNull()), "quality", "doc_id")
    return rows.select("doc_id", "part")


@query("WITH l AS (SELECT source AS url, arg_min(quality, doc_id) AS label FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL GROUP BY source) SELECT doc_id, label FROM documents JOIN l ON source = url")
def label_by_url(spark, d):
    docs = read(spark, d, "documents").withColumn("url", F.col("source"))
    labels = docs.join(read(spark, d, "labels").where(F.col("quality").isNotNull()), "doc_id").select("url", F.col("quality").alias("label"), F.col("doc_id").alias("ingest_seq"))
    return lb.label_lookup(docs, labels).select("doc_id", "label")


@query(f"WITH {SIGNALS} SELECT count(*) AS input_count, count(*) FILTER (WHERE keep) AS kept_count, count(*) FILTER (WHERE NOT keep) AS dropped_count, count(prob) AS model_prob_available_count, count(*) FILTER (WHERE prob IS NULL) AS model_prob_missing_count, "
       + ", ".join(f"count(*) FILTER (WHERE reason IN ({', '.join(chr(39) + 'candidate_hybrid_' + r + chr(39) for r in reasons)})) AS candidate_hybrid_{name}" for name, reasons in ql.REASON_NAMES.items()) + " FROM decided")
def decision_metrics(spark, d):
    return ql.decision_metrics(rv.decide(scored(spark, d), P))


_LOOSE = anywhere("st", P.lists["domain"])


@query(f"WITH {SIGNALS}, x AS (SELECT * FROM decided WHERE NOT keep AND h = 0 AND matched_hard = '' AND {_LOOSE}) SELECT CAST(row_number() OVER (ORDER BY doc_id) AS INTEGER) AS place, title, link AS url, (SELECT count(*) FROM x) AS suspects FROM x ORDER BY doc_id LIMIT 10")
def suspect_drop_samples(spark, d):
    return ql.suspect_drops(rv.decide(scored(spark, d), P), rv.loose_hits(P, F.col("score_text")))


_SAMPLE = "place, title, link AS url, sector, score AS relevance_score, prob AS relevance_prob, cluster_size"


def sized(spark, d):
    return ar.title_groups(tagged(spark, d)).drop("rank")


_SIZED = f"{TAGGED}, gs AS (WITH {GROUPS} SELECT doc_id, cluster_size FROM ranked), sz AS (SELECT * FROM top JOIN gs USING (doc_id))"


@query(f"WITH {_SIZED} SELECT {_SAMPLE} FROM (SELECT *, CAST(row_number() OVER (ORDER BY pub_date DESC, title, link) AS INTEGER) AS place FROM sz WHERE topics = '') WHERE place <= 10")
def no_topic_samples(spark, d):
    return ql.no_topic_samples(sized(spark, d))


@query(f"WITH {_SIZED} SELECT {_SAMPLE} FROM (SELECT *, CAST(row_number() OVER (ORDER BY cluster_size DESC, title, link) AS INTEGER) AS place FROM sz WHERE cluster_size >= 3) WHERE place <= 10")
def mega_cluster_samples(spark, d):
    return ql.mega_samples(sized(spark, d), 3)


@query(f"WITH {TAGGED}, t AS (SELECT * FROM top ORDER BY pub_date DESC, doc_id LIMIT 10) SELECT 'count' AS kind, 'all' AS name, count(*) AS n FROM t UNION ALL SELECT 'sector', sector, count(*) FROM t GROUP BY 2 "
       "UNION ALL SELECT 'topic', unnest(string_split(CASE WHEN topics = '' THEN 'none' ELSE topics END, ';')) AS name, count(*) FROM t GROUP BY 2")
def top_composition(spark, d):
    return ql.top_composition(tagged(spark, d).orderBy(F.desc("pub_date"), "ingest_seq").limit(10))


@query(f"WITH {SECTORS}, f AS (SELECT sector, min(doc_id) AS f FROM sec GROUP BY 1) SELECT sector, CAST(row_number() OVER (ORDER BY CASE sector WHEN 'spanish' THEN 1 WHEN 'english' THEN 2 WHEN 'misc' THEN 4 ELSE 3 END, f) AS INTEGER) AS place FROM f")
def sector_display_order(spark, d):
    return rk.display_order(tagged(spark, d), ["spanish", "english"])


@query(f"""WITH {ART}, u AS (SELECT *, press IS NOT NULL AND press <> '' AND row_number() OVER (PARTITION BY press ORDER BY pub_date DESC, doc_id) = 1 AS u, doc_id % 3 = 0 AS hit, doc_id % 5 <> 0 AS works FROM (SELECT doc_id, pub_date, press || '/' || (doc_id % 40) AS press FROM art)),
t AS (SELECT *, sum(CASE WHEN u AND NOT hit THEN 1 ELSE 0 END) OVER (ORDER BY pub_date DESC, doc_id) AS tn FROM u), g AS (SELECT *, u AND (hit OR (works AND tn <= 30)) AS gives FROM t),
b AS (SELECT *, coalesce(sum(CASE WHEN gives THEN 1 ELSE 0 END) OVER (ORDER BY pub_date DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g)
SELECT doc_id, CASE WHEN before >= 40 THEN 'done' WHEN NOT u THEN 'duplicate' WHEN hit THEN 'cached' WHEN tn > 30 THEN 'skipped' WHEN works THEN 'summarised' ELSE 'failed' END AS action FROM b""")
def summarization_plan(spark, d):
    rows = articles(spark, d).withColumns({"link": F.concat("press", F.lit("/"), (F.col("doc_id") % 40).cast("string")), "cached": F.col("doc_id") % 3 == 0, "works": F.col("doc_id") % 5 != 0})
    return rn.summary_plan(rows, 40, 30).select("doc_id", "action")


@query(f"WITH {ART}, f AS (SELECT doc_id FROM art ORDER BY prob DESC, doc_id LIMIT 10), b AS (SELECT doc_id, 0 AS part FROM f UNION ALL SELECT doc_id, 1 FROM art WHERE prob >= 0.5), m AS (SELECT doc_id, min(part) AS part FROM b GROUP BY 1) SELECT doc_id, CAST(row_number() OVER (ORDER BY part, doc_id) AS INTEGER) AS place FROM m ORDER BY part, doc_id LIMIT 50")
def summary_targets(spark, d):
    rows = articles(spark, d)
    return rn.targets(rows.orderBy(F.desc("prob"), "doc_id").limit(10), rows.where("prob >= 0.5"), "doc_id", "ingest_seq", 50)


@query(f"""WITH {ART}, a AS (SELECT *, CASE WHEN doc_id % 4 = 0 THEN trim(description) ELSE '' END AS hand FROM art), n AS (SELECT *, sum(CASE WHEN hand = '' THEN 1 ELSE 0 END) OVER (ORDER BY doc_id) AS k FROM a),
b AS (SELECT *, CASE WHEN hand <> '' THEN hand WHEN k <= 60 THEN trim(text) ELSE '' END AS body FROM n)
SELECT doc_id, length(body) >= 120 AS cacheable, length(CASE WHEN length(body) >= 120 THEN body WHEN length(trim(title)) >= 120 THEN trim(title) ELSE '' END) AS n_input FROM b""")
def summary_input(spark, d):
    rows = articles(spark, d).withColumns({"body": F.when(F.col("doc_id") % 4 == 0, F.col("description")).otherwise(""), "fetched": F.col("text"), "description": F.col("title"), "place": F.col("doc_id")})
    return rn.input_body(rows, 120, 60).select("doc_id", "cacheable", F.length("input").cast("long").alias("n_input"))


@query(f"""WITH {ART}, i AS (SELECT doc_id // 25 AS batch_no, doc_id, '<article id="article_' || doc_id || '">' || chr(10) || translate(title, '<>', '＜＞') || chr(10) || translate(description, '<>', '＜＞') || chr(10) || '</article>' AS t FROM art)
SELECT batch_no, count(*) AS n_items, md5('Sum up each article.' || chr(10) || string_agg(t, chr(10) ORDER BY doc_id)) AS prompt, true AS capped FROM i GROUP BY 1""")
def batch_prompts(spark, d):
    items = articles(spark, d).select((F.col("doc_id") / 25).cast("long").alias("batch_no"), F.col("doc_id").alias("place"), F.concat(F.lit("article_"), F.col("doc_id").cast("string")).alias("id"), "title", F.col("description").alias("body"))
    made = rn.prompts(items, "batch_no", "Sum up each article.")
    most = F.get_json_object("response_schema", "$.properties.summaries.maxItems").cast("long")
    return made.select("batch_no", "n_items", F.md5(F.col("prompt").cast("binary")).alias("prompt"), (most == F.col("n_items")).alias("capped"))


@query("""WITH q AS (SELECT CAST(doc_id // 40 AS VARCHAR) AS b, doc_id, CASE WHEN (doc_id // 40) % 3 = 0 THEN 'failed' WHEN doc_id % 7 = 0 THEN 'line_contract' WHEN doc_id % 11 = 0 THEN NULL ELSE 'accepted' END AS o FROM documents),
l AS (SELECT *, count(*) OVER (PARTITION BY b) AS n, row_number() OVER (PARTITION BY b ORDER BY doc_id) - 1 AS p FROM q WHERE o IS NULL OR o <> 'accepted')
SELECT 1 AS round, b || '.' || CAST(p // CASE WHEN n > 25 THEN 25 WHEN n > 10 THEN 10 ELSE 1 END AS VARCHAR) AS batch_no, 'a' || doc_id AS id FROM l""")
def retry_rounds(spark, d):
    rows = read(spark, d, "documents").select(F.lit(0).alias("round"), (F.col("doc_id") / 40).cast("long").alias("b"), F.col("doc_id").alias("place"), F.concat(F.lit("a"), F.col("doc_id").cast("string")).alias("id")).withColumn("batch_no", F.col("b").cast("string"))
    outcome = F.when(F.col("b") % 3 == 0, "failed").when(F.col("place") % 7 == 0, "line_contract").otherwise("accepted")
    sent = rows.where((F.col("b") % 3 == 0) | (F.col("place") % 7 == 0) | (F.col("place") % 11 != 0)).select("round", "batch_no", "id", outcome.alias("outcome"))
    return rn.retry_rounds(rows.drop("b"), sent)


_N = len(rn.ATTEMPT_COUNTERS)


@query("SELECT " + ", ".join(f"CAST(coalesce(sum(CASE WHEN event_id % {_N} = {k} THEN CAST(floor(value) AS BIGINT) END), 0) AS BIGINT) AS {c}" for k, c in enumerate(rn.ATTEMPT_COUNTERS)) + ", 250 AS targets, 200 AS applied, 50 AS extractive_fallback FROM events")
def run_summary(spark, d):
    names = F.array(*map(F.lit, rn.ATTEMPT_COUNTERS))
    log = read(spark, d, "events").select(F.element_at(names, (F.col("event_id") % _N + 1).cast("int")).alias("counter"), F.expr("cast(floor(value) as bigint)").alias("n"))
    return rn.run_summary(log, targets=250, applied=200)


# a customer's orders stand for the targets of a run, their states for what became of each
_COUNTERS = {"targets": "true", "sent_articles": "o_orderstatus = 'O' OR o_orderpriority = '1-URGENT'", "applied": "o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')",
             "content_rejected": "o_orderstatus = 'O' AND o_totalprice < 100000", "cache_hits": "o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'", "cache_miss": "o_orderstatus = 'O' AND o_totalprice < 250000",
             "skipped_no_body": "o_orderstatus = 'P'", "api_error": "o_orderstatus = 'O' AND o_totalprice > 450000"}
_OFF = "CASE WHEN c_acctbal < -900 THEN 'missing_api_key' WHEN c_acctbal < -800 THEN 'breaker' WHEN c_acctbal < -700 THEN 'disabled' ELSE '' END"


@query(f"""WITH g AS (SELECT c_custkey AS run, {_OFF} AS disabled_reason, {', '.join(f"count(*) FILTER (o_orderkey IS NOT NULL AND ({test})) AS {c}" for c, test in _COUNTERS.items())} FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_acctbal),
f AS (SELECT *, greatest(applied - cache_hits, 0) AS fresh, CASE WHEN cache_miss > 0 THEN cache_miss ELSE sent_articles END AS asked FROM g)
SELECT run, CASE WHEN disabled_reason IN ('disabled', 'missing_api_key', 'no_targets') THEN 'skipped' WHEN disabled_reason <> '' THEN 'failed' WHEN targets <= 0 THEN 'skipped' WHEN sent_articles <= 0 THEN CASE WHEN cache_hits >= targets THEN 'ok' ELSE 'skipped' END
 WHEN fresh > 0 THEN 'ok' WHEN content_rejected > 0 AND api_error = 0 AND content_rejected >= asked THEN 'ok' ELSE 'failed' END AS status FROM f""")
def run_gate(spark, d):
    orders = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(*[F.count_if(F.expr(test)).alias(c) for c, test in _COUNTERS.items()])
    runs = read(spark, d, "customer").select("c_custkey", F.expr(_OFF).alias("disabled_reason")).join(orders, "c_custkey", "left")
    return rn.run_gate(runs.withColumnRenamed("c_custkey", "run")).select("run", "status")


@query("SELECT DISTINCT CAST(o_orderdate AS DATE) AS report_date FROM orders WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_returnflag = 'R' AND l_shipdate IS NOT NULL)")
def undelivered_runs(spark, d):
    runs = read(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("report_date")).distinct()
    return rn.undelivered(runs, read(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_shipdate").cast("date").alias("report_date")))


@query("""WITH f AS (SELECT DISTINCT CASE WHEN o_orderkey % 3 = 0 THEN '_metrics_' ELSE 'report_' END || strftime(o_orderdate, '%Y-%m-%d') || '.html' AS name, CAST(o_orderdate AS DATE) AS day, o_orderkey % 3 = 0 AS artefact FROM orders)
SELECT name FROM f WHERE day >= DATE '1998-06-01' - CASE WHEN artefact THEN 90 ELSE 180 END""")
def retention_classes(spark, d):
    name = F.concat(F.when(F.col("o_orderkey") % 3 == 0, "_metrics_").otherwise("report_"), F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd"), F.lit(".html"))
    return rp.retained(read(spark, d, "orders").select(name.alias("name")).distinct(), dt.date(1998, 6, 1))


@query("""WITH f AS (SELECT DISTINCT 'candidates_' || strftime(o_orderdate, '%Y-%m-%d') || '.csv' AS name, CAST(o_orderdate AS DATE) AS file_date FROM orders),
r AS (SELECT *, CASE WHEN file_date >= DATE '1997-01-01' THEN 'current_or_future' WHEN file_date < DATE '1997-01-01' - 91 THEN 'outside_lookback' WHEN day(file_date) % 2 = 0 THEN 'missing_columns' ELSE 'included' END AS reason FROM f)
SELECT name, CASE WHEN reason = 'included' AND row_number() OVER (PARTITION BY reason ORDER BY file_date DESC, name DESC) > 21 THEN 'beyond_max_files' ELSE reason END AS reason FROM r""")
def eligible_files_with_columns(spark, d):
    day = F.col("o_orderdate").cast("date")
    full, short = F.array(*map(F.lit, ("title", "summary", "url", "score"))), F.array(*map(F.lit, ("title", "url")))
    files = read(spark, d, "orders").select(F.concat(F.lit("candidates_"), F.date_format(day, "yyyy-MM-dd"), F.lit(".csv")).alias("name"), F.when(F.dayofmonth(day) % 2 == 0, short).otherwise(full).alias("columns")).distinct()
    return rp.eligible_files(files, dt.date(1997, 1, 1), 91, 21, ["title", "summary", "url", "score"]).select("name", "reason")


@query(f"WITH {TAGGED} SELECT doc_id FROM top WHERE doc_id % 3 = 0 AND link IN (SELECT 'doc/' || doc_id FROM labels) AND contains(lower(concat_ws(' ', title, description, topics)), 'the') ORDER BY pub_date DESC, doc_id LIMIT 20")
def search_top_favourites(spark, d):
    rows = tagged(spark, d)
    liked = read(spark, d, "labels").select(F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("link"))
    return rp.search(rows, "the", top=rows.where("doc_id % 3 = 0"), favourites=liked).select("doc_id")


def grouped(spark, d):
    """Articles in title groups, each with one absorbed duplicate made of its press."""
    rows = ar.title_groups(articles(spark, d)).drop("rank", "cluster_size", "normalized_title")
    dup = F.struct(F.concat(F.lit("Copy of "), F.col("press")).alias("title"), F.concat(F.lit("dup/"), (F.col("doc_id") % 7).cast("string")).alias("link"), "press", F.col("pub_date").cast("string").alias("pub_date"))
    return rows.withColumns({"report_date": F.lit("2024-01-01"), "cluster_id": F.col("cluster_key"), "norm_title": tx.plain_title(F.col("title")), "relevance": F.col("prob"), "duplicate_sources": F.array(dup)})


_REPR = f"""{GROUPS}, m AS (SELECT *, trim(regexp_replace(lower(title), '{SPACE}', ' ', 'g')) AS norm, 'dup/' || (doc_id % 7) AS dlink, 'Copy of ' || press AS dtitle FROM grp),
o AS (SELECT *, dlink NOT IN ('dup/3') AS ok, row_number() OVER (PARTITION BY cluster_key ORDER BY prob DESC, least(length(trim(title)), 90) - greatest(length(trim(title)) - 110, 0) DESC, (CASE WHEN trim(description) <> '' THEN 2 ELSE 0 END) DESC, pub_date DESC, norm DESC, link DESC, doc_id) AS rnk FROM m),
z AS (SELECT cluster_key, sum(1 + CAST(ok AS INTEGER)) AS size FROM o GROUP BY 1),
e AS (SELECT cluster_key, 0 AS part, doc_id AS seq, link, title FROM o WHERE rnk > 1 UNION ALL SELECT cluster_key, CASE WHEN rnk = 1 THEN 1 ELSE 2 END, doc_id, dlink, dtitle FROM o WHERE ok),
k AS (SELECT cluster_key, link, title, min({{'a': part, 'b': seq}}) AS x FROM e GROUP BY ALL), r AS (SELECT k.*, row_number() OVER (PARTITION BY cluster_key ORDER BY x) AS n FROM k ANTI JOIN (SELECT cluster_key, link, title FROM o WHERE rnk = 1) q USING (cluster_key, link, title)),
l AS (SELECT cluster_key, string_agg(link, ';' ORDER BY n) AS related FROM r WHERE n <= 5 GROUP BY 1)"""


@query(f"WITH {_REPR} SELECT doc_id, CAST(rnk AS INTEGER) AS cluster_rank, rnk = 1 AS is_representative, CAST(size AS BIGINT) AS cluster_size, CAST(size - 1 AS BIGINT) AS related_count, CASE WHEN rnk = 1 THEN coalesce(related, '') ELSE '' END AS related FROM o JOIN z USING (cluster_key) LEFT JOIN l USING (cluster_key)")
def cluster_representatives(spark, d):
    out = ev.represent(grouped(spark, d), ["dup/3"])
    links = F.coalesce(F.array_join(F.transform("related_articles", lambda x: x["link"]), ";"), F.lit(""))
    return out.select("doc_id", "cluster_rank", "is_representative", F.col("cluster_size").cast("long").alias("cluster_size"), F.col("related_count").cast("long").alias("related_count"), links.alias("related"))


@query()
def metrics_record(spark, d):
    """The nested record of a run's metrics: every document is scored and tagged once, into a table of what the parts count."""
    decided = rv.decide(tagged(spark, d), P)
    rows = written(ar.with_key(decided).select(F.md5(F.col("cluster_key").cast("binary")).alias("key"), "ingest_seq", "title", "link", "sector", "score", "prob", "keep", "decision_reason"))
    sizes = written(rows.groupBy("key").agg(F.count("*").alias("cluster_size")))
    each = rows.select("key").join(sizes, "key").select("cluster_size")
    largest = rows.join(sizes.where("cluster_size >= 3"), "key")
    return ql.metrics_record(decisions=ql.decision_metrics(rows), sectors=rows.groupBy("sector").agg(F.count("*").alias("n")), sizes=ev.size_percentiles(each), mega=ql.mega_samples(largest, 3))
