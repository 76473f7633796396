"""The paged search source, the keyed cache stream and the character classifier against plain twins."""

import collections
import datetime as dt
import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenfold.operators import labels
from lumenfold.sources import paged
from lumenfold.streaming import cache

UTC = dt.timezone.utc
NOON = dt.datetime(2026, 3, 2, 12, tzinfo=UTC)


def item(k, when, **more):
    return {"title": f"<b>T</b> {k} &amp; co", "description": " d ", "link": f"p/{k}", "originallink": f"o/{k}", "pubDate": when.strftime("%a, %d %b %Y %H:%M:%S +0000")} | more


def put(root, query, start, items):
    folder = root / f"query={query}" / f"start={start}"
    folder.mkdir(parents=True)
    (folder / "part-0.json").write_text(json.dumps({"items": items}) if isinstance(items, list) else items)


def hours(n):
    return NOON - dt.timedelta(hours=n)


def test_pages_end_where_no_later_page_can_match(spark, tmp_path):
    put(tmp_path, "old%3Drow", 1, [item(k, hours(k)) for k in range(3)])
    put(tmp_path, "old%3Drow", 4, [item(k, hours(k)) for k in range(3, 6)])  # its oldest row precedes the window
    put(tmp_path, "old%3Drow", 7, "not to be read")
    put(tmp_path, "short", 1, [item(9, hours(1)), item(10, hours(2), pubDate="never")])
    put(tmp_path, "short", 4, "not to be read")
    put(tmp_path, "cap", 1, [item(k, hours(0)) for k in range(3)])
    put(tmp_path, "cap", 4, [item(k, hours(0)) for k in range(3, 6)])
    put(tmp_path, "cap", 7, [item(k, hours(0)) for k in range(6, 9)])
    put(tmp_path, "cap", 10, "not to be read")
    got = paged.search(spark, str(tmp_path), hours(4), hours(-1), display=3, max_pages=3).collect()
    by = collections.Counter(r.query for r in got)
    assert by == {"old=row": 5, "short": 1, "cap": 9}
    one = next(r for r in got if r.query == "short")
    assert (one.title, one.description, one.link, one.originallink, one.portal_link, one.start) == ("T 9 & co", "d", "o/9", "o/9", "p/9", 1)
    none = paged.search(spark, str(tmp_path), hours(4), hours(-1), queries=["absent"], display=3)
    assert none.count() == 0 and paged.search(spark, str(tmp_path), hours(1), hours(0), queries=["short"], display=3).count() == 1


def test_window_and_query_are_pushed_down(spark, tmp_path, capsys):
    put(tmp_path, "a", 1, [item(k, hours(k)) for k in range(4)])
    put(tmp_path, "b", 1, "not to be read")
    df = paged.search(spark, str(tmp_path), hours(3), hours(1), display=10).where("query = 'a'")
    df.explain("formatted")
    shown = capsys.readouterr().out
    assert "PushedFilters: [" in shown and "LessThan(pub_date" in shown and "GreaterThanOrEqual(pub_date" in shown and "EqualTo(query,a)" in shown
    assert sorted(r.link for r in df.collect()) == ["o/2", "o/3"]  # until is left out, since is in
    loose = spark.read.format("paged_search").option("path", str(tmp_path)).load().where((F.col("query").isin("a")) & (F.col("pub_date") > F.lit(hours(3))) & (F.col("pub_date") <= F.lit(hours(1))))
    assert sorted(r.link for r in loose.collect()) == ["o/1", "o/2"]


def test_recorded_pages_read_back(spark, tmp_path):
    r = random.Random(3)
    rows = [(k, r.choice(["a b", "ü/x", "c"]), NOON - dt.timedelta(minutes=r.randrange(300)), f"t{k}\n{'}'}", None, f"l{k}", None) for k in range(400)]
    df = spark.createDataFrame(rows, "k long, query string, pub_date timestamp, title string, description string, link string, originallink string")
    paged.record(df, str(tmp_path / "p"), 20, "k")
    since, until = NOON - dt.timedelta(minutes=200), NOON - dt.timedelta(minutes=20)
    want = set()
    for q in ("a b", "ü/x", "c"):
        newest = sorted((x for x in rows if x[1] == q), key=lambda x: (-x[2].timestamp(), x[0]))[:60]
        want |= {(q, x[5], i // 20 * 20 + 1) for i, x in enumerate(newest) if since <= x[2] < until}
    got = {(x.query, x.link, x.start) for x in paged.search(spark, str(tmp_path / "p"), since, until, display=20, max_pages=3).collect()}
    assert got == want and len(want) > 50


def test_page_starts():
    assert list(paged.starts(100, 5)) == [1, 101, 201, 301, 401] and paged.starts(100, 50)[-1] == 901 and paged.starts(30, 99)[-1] <= 1000
    assert paged.parse_date("Mon, 02 Mar 2026 09:00:00") == dt.datetime(2026, 3, 2, tzinfo=UTC) and paged.parse_date("no") is None is paged.parse_date(None)


def test_cache_state_against_a_batch_twin(spark, tmp_path):
    ttl, cap, r = dt.timedelta(hours=2), 12, random.Random(5)
    rows = []
    for k in range(700):
        at = NOON + dt.timedelta(minutes=k - (r.randrange(200) if k % 5 == 0 else r.randrange(5)))  # some come late, some too late
        rows.append((f"k{r.randrange(60)}" if k % 50 else None, at, r.choice(["x", "y", None])))
    rows += rows[:30]  # repeated entries
    schema = "key string, ts timestamp, value string"
    (tmp_path / "in").mkdir()
    entries = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for part in range(0, len(rows), 150):  # every part is a run of its own that goes on from the last one's state
        spark.createDataFrame(rows[part : part + 150], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        cache.feed(entries, str(tmp_path / "state"), ttl, cap, buckets=3, log=str(tmp_path / "log"))
    newest: dict = {}
    for k, at, v in rows:
        if k is not None:
            newest[k] = max(newest.get(k, (at, v or "")), (at, v or ""))
    now = max(at for _, at, _ in rows)
    want = sorted(((k, at.replace(tzinfo=None), v) for k, (at, v) in newest.items() if at > now - ttl), key=lambda x: (-x[1].timestamp(), x[0]))[:cap]
    got = [(x.key, x.ts, x.value) for x in cache.current(spark, str(tmp_path / "state"), now, ttl, cap).withColumn("ts", F.col("ts").cast("timestamp_ntz")).collect()]
    assert got == want and len(want) == cap
    state = spark.read.format("statestore").option("path", str(tmp_path / "state")).option("stateVarName", "entries").load()
    assert state.count() <= 3 * cap  # what the buckets hold stays within their cap, however many keys came
    seen = {x.change for x in spark.read.parquet(str(tmp_path / "log")).select("change").distinct().collect()}
    assert {"put", "renewed", "evicted"} <= seen


def test_cache_entries_run_out(spark, tmp_path):
    schema = "key string, ts timestamp, value string"
    (tmp_path / "in").mkdir()
    entries = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    for batch in ([("old", NOON, "1"), ("kept", NOON, "1")], [("kept", NOON + dt.timedelta(hours=2), "2")], [("new", NOON + dt.timedelta(hours=3), "1")], [("new", NOON + dt.timedelta(hours=3, minutes=1), "2")]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        cache.feed(entries, str(tmp_path / "state"), dt.timedelta(hours=1, minutes=30), 10, buckets=1, log=str(tmp_path / "log"))
    state = spark.read.format("statestore").option("path", str(tmp_path / "state")).option("stateVarName", "entries").load()
    assert {x["user_map_key"]["key"] for x in state.collect()} == {"kept", "new"}
    assert [x.key for x in spark.read.parquet(str(tmp_path / "log")).where("change = 'expired'").collect()] == ["old"]


def test_vocabulary_is_exact(spark):
    r = random.Random(8)
    texts = [" ".join(r.choice(["ab", "Abc", "xyz", "q", "é日"]) for _ in range(r.randrange(12))) for _ in range(80)] + [None, "", "  "]
    n, d = collections.Counter(), collections.Counter()
    for t in texts:
        t = " ".join((t or "").lower().split())
        grams = collections.Counter(t[i : i + k] for k in range(2, 6) for i in range(len(t) - k + 1))
        n += grams
        d.update(grams.keys())
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    for size, least in ((10, 1), (57, 2), (10_000, 3)):
        want = sorted(((g, c, d[g]) for g, c in n.items() if d[g] >= least), key=lambda x: (-x[1], x[0]))[:size]
        assert sorted(map(tuple, labels.vocabulary(df, size, least).collect()), key=lambda x: (-x[1], x[0])) == want


def test_classifier_against_a_plain_twin(spark):
    r = random.Random(4)
    words = {0: ["football", "tour", "rain", "goal"], 1: ["loan", "bank", "rate", "goal"]}
    rows = [(k, " ".join(r.choice(words[int(r.random() < 0.8) ^ (k % 3 == 0)]) for _ in range(6)), int(k % 3 == 0), 1.0 + k % 2) for k in range(60)]
    df = spark.createDataFrame(rows, "k long, text string, y int, w double")
    model = labels.fit_classifier(df, "text", "y", "w", features=300)
    grams = [x.g for x in sorted(labels.vocabulary(df, 300).collect(), key=lambda x: (-x.n, x.g))]
    tf = np.array([[labels.char_ngrams(t).count(g) for g in grams] for _, t, _, _ in rows], dtype=float)
    x = tf * (np.log((1 + len(rows)) / (1 + (tf > 0).sum(axis=0))) + 1)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = np.hstack([x, np.ones((len(rows), 1))])
    y = np.array([v for _, _, v, _ in rows])
    w = np.array([len(rows) / (2 * (y == v).sum()) * u for _, _, v, u in rows])
    pull = np.append(np.ones(len(grams)), 0.0)
    b = np.zeros(x.shape[1])
    for _ in range(50):  # Newton's steps
        p = 1 / (1 + np.exp(-x @ b))
        b -= np.linalg.solve(x.T @ (x * (w * p * (1 - p))[:, None]) + np.diag(pull + 1e-12), x.T @ (w * (p - y)) + pull * b)
    want = 1 / (1 + np.exp(-x @ b))
    got = [z.prob for z in model.add(df).orderBy("k").collect()]
    assert np.abs(np.array(got) - want).max() < 1e-4 and 0.7 < np.mean((want > 0.5) == y)
    assert math.isclose(model.add(spark.createDataFrame([(None,)], "text string")).first().prob, 1 / (1 + math.exp(-model.intercept)))


def test_descent_ends_on_tolerance():
    hill = np.diag([1.0, 20.0, 400.0])
    x, steps = labels.minimise(lambda v: (0.5 * float(v @ hill @ v) - v.sum(), hill @ v - 1), np.zeros(3), 500)
    assert np.abs(x - [1, 0.05, 0.0025]).max() < 1e-5 and steps < 60
    with pytest.raises(ValueError):
        paged.Reader({"path": "x", "display": "0"})
