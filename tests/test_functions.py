"""Text functions and term matching on sentinel strings."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lumenfold.functions import text as tx
from lumenfold.functions.terms import Profile, ko_finance
from lumenfold.operators import articles, contracts, events, labels, relevance, runs, summaries


def one(spark, make, *values):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{k} string" for k in range(len(values))))
    return df.select(make(*[F.col(f"c{k}") for k in range(len(values))]).alias("x")).first().x


@pytest.mark.parametrize(("value", "want"), [(" <b>A</b>  b\n", "a b"), ("", ""), (None, "")])
def test_normalize(spark, value, want):
    assert one(spark, tx.normalize, value) == want


@pytest.mark.parametrize(("value", "want"), [("“Rates” rise! - 연합뉴스", "rates rise"), ("[속보] 금리 인상…", "금리 인상"), ("A/B: c", "a b c"), ("뉴스", "뉴스")])
def test_title_key(spark, value, want):
    assert one(spark, tx.title_key, value) == want


@pytest.mark.parametrize(("value", "want"), [("+08.40", "8.4"), ("-0.0", "0"), ("-1.50", "-1.5"), ("007", "7"), ("0.5", "0.5")])
def test_metric_value(spark, value, want):
    assert one(spark, tx.metric_value, value) == want


def test_small_functions(spark):
    assert one(spark, tx.host, "https://www.Example.com:80/a?b") == "example.com:80"
    assert one(spark, lambda c: tx.shorten(c, 8), "abcdefghij") == "abcde..." and one(spark, tx.html_escape, "<a&'\">") == "&lt;a&amp;&#x27;&quot;&gt;"
    assert one(spark, tx.widen_brackets, "<x>") == "＜x＞" and one(spark, tx.mask_dots, "On 2026. 8. 4. it") == "On 2026· 8· 4· it"
    assert one(spark, lambda c: tx.cut_at_sentence(c, 10), "Abcd ef. Gh ij kl") == "Abcd ef." and one(spark, lambda c: tx.cut_at_sentence(c, 9), "Ab cd ef gh") == "Ab cd ef"
    assert one(spark, tx.unescape, "a &amp;&eacute; &#39;") == "a &é '" and one(spark, tx.nfkc, "ﬁ①") == "fi1" and one(spark, tx.repair_encoding, "é".encode().decode("latin-1")) == "é"
    assert one(spark, lambda a, b: tx.first_number(a, b), "x", "2.5") == 2.5 and one(spark, lambda a, b: tx.first_of(a, b), " ", "b ") == "b"
    assert one(spark, tx.numbers, "3.5 % and 12월") == ["3.5%", "12월"]


@pytest.mark.parametrize(("text", "term", "want"), [
    ("a risk here", "risk", True), ("the risky", "risk", False), ("금융위 발표", "금융위", True), ("금융위기 우려", "금융위", False), ("건강보험 개편", "보험", False), ("보험 개편", "보험", True),
    ("기업어음 발행", "cp", True), ("cpi 상승", "cp", False), ("대부업체 점검", "대부업", True), ("불법 대부도 여행", "불법대부", False), ("불법 대부를 단속", "불법대부", True)])
def test_matching(spark, text, term, want):
    p = ko_finance()
    assert one(spark, lambda c: p.has(c, term), text) is want and one(spark, lambda c: p.any(c, [term]), text) is want


def test_excluded_word_keeps_neighbouring_edges(spark):
    p = Profile({}, {}, excludes={"감독": ["금융감독"]})
    assert one(spark, lambda c: p.has(c, "감독"), "금융감독 감독") is True and one(spark, lambda c: p.has(c, "감독"), "금융감독감독") is False


def decided(spark, title, prob=None, policy="candidate_hybrid"):
    p = ko_finance()
    df = spark.createDataFrame([(title, "doc/1", prob)], "title string, link string, prob double").withColumn("score_text", articles.score_text(F.col("title"), F.lit("")))
    r = relevance.decide(relevance.with_score(df, p), p, policy).first()
    return r.keep, r.decision_reason.replace("candidate_hybrid_", ""), r.score


def test_korean_decisions(spark):
    keep, reason, score = decided(spark, "금감원, 저축은행 불법사금융 검사 착수")
    assert keep and score >= 8 and reason == "keep_strong_domain_rule_anchor"
    assert decided(spark, "미 국채금리 급등에 원달러 환율 상승")[:2] == (True, "keep_overseas_korean_market_impact")
    assert decided(spark, "주말 나들이 명소 소개")[0] is False
    assert decided(spark, "주말 나들이 명소 소개", 0.9)[1] == "drop_model_keep_without_domain_anchor"
    assert decided(spark, "주말 나들이 명소 소개", 0.2)[1] == "model_drop_prob_le_threshold"
    assert decided(spark, "아무 말", 0.6, "authoritative")[1] == "model_keep_prob_ge_threshold"


def test_collection_window():
    start, end = articles.collection_window("2026-03-02", "09:00", 24, 15)
    assert end - start == dt.timedelta(hours=24, minutes=15) and end.utcoffset() == dt.timedelta(hours=9)
    early = dt.datetime(2026, 3, 2, 8, 0, tzinfo=articles.KST)
    assert articles.collection_window("2026-03-02", "09:00", 24, 0, early)[1].day == 1
    with pytest.raises(ValueError):
        articles.collection_window("2026-03-02", "9:00")


def row(title, **more):
    base = {"norm_title": title, "tokens": set(title.split()), "numbers": set(), "entities": set(), "issue_terms": set(), "fingerprint": None, "low_value": False, "sector": "a", "metrics": set(), "subjects": set(), "period": None}
    out = base | more
    return out | {"keys": set(title.split()) | {title} | ({out["fingerprint"]} if out["fingerprint"] else set())}


def test_pair_rule_and_first_fit():
    a, b = row("loan rates rise at banks today", issue_terms={"rates", "loan"}), row("loan rates rise at many banks", issue_terms={"rates", "loan"})
    c = row("parade in town", sector="b")
    assert events.same_event(b, a) and not events.same_event(c, a) and events.same_event(c, dict(c))
    assert not events.same_event(row("x y z", fingerprint="f:1"), row("x y w", fingerprint="f:2")) and events.same_event(row("one thing", fingerprint="f:1"), row("other thing", fingerprint="f:1"))
    veto = {"metrics": {"ratio"}, "subjects": {"banks"}}
    assert not events.same_event({**b, **veto}, {**a, "metrics": {"ratio"}, "subjects": {"cards"}}) and events.vetoed({**b, **veto, "period": (2026, 3)}, {**a, **veto, "period": (2026, 6)})
    assert events.first_fit([a, c, b]) == [[0, 2], [1]]


def test_ratio_blocking_loses_no_pair(spark, data):
    df = articles.from_documents(spark.read.parquet(f"{data}/documents.parquet"))
    got = {(r.doc_a, r.doc_b) for r in events.ratio_pairs(df, 0.88).collect()}
    rows = sorted({r.n: r.d for r in df.select(tx.plain_title(F.col("title")).alias("n"), F.col("doc_id").alias("d")).orderBy(F.desc("d")).collect() if len(r.n) >= 4}.items(), key=lambda x: x[1])
    want = {(i, j) for k, (a, i) in enumerate(rows) for b, j in rows[k + 1 :] if 2 * min(len(a), len(b)) >= 0.88 * (len(a) + len(b)) and events.ratio(b, a) >= 0.88}
    assert got == want


def test_similar_titles_meet_few_others(spark):
    rng = random.Random(5)
    words = [f"w{k:03}" for k in range(120)]  # every word is in a tenth of the titles
    sets = [rng.sample(words, rng.randint(8, 16)) for _ in range(900)]
    sets += [[*s[:-2], "new"] for s in sets[:60]]
    rows = [(k, " ".join(s)) for k, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "doc_id long, title string")
    met = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b))
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if met(sets[i], sets[j]) >= 0.5}
    assert {(r.doc_a, r.doc_b) for r in events.title_pairs(df, 0.5).collect()} == want and len(want) >= 50
    assert events.overlapping(df.select(F.col("doc_id").alias("id"), F.split("title", " ").alias("s")), 0.5).count() <= 3000


def test_line_contract(spark):
    df = spark.createDataFrame([(["A says so.", "B says 2026. 8. 4. so.", "C says so."], "T"), (["- A.", "B.", "C."], "T"), (["A. B.", "B.", "C."], "T"), (["A.", "a.", "C."], "T"), (["A.", "B."], "T"), (None, "T"), (["A is it.", "B.", "C."], "a is it")], "l array<string>, t string")
    assert [r.x for r in df.select(contracts.valid_lines(F.col("l"), F.col("t")).alias("x")).collect()] == [True, False, False, False, False, False, False]


def test_batches_and_ladder(spark):
    df = spark.createDataFrame([(k, "g", n) for k, n in enumerate([100, 100, 900, 5000, 10, None])], "k long, g string, n long")
    got = [(r.k, r.fitted_chars, r.batch_no) for r in contracts.budget_batches(df, "k", "n", "g", 2, 2000, 500, 200).orderBy("k").collect()]
    assert [b for _, _, b in got] == [0, 0, 1, 2, 3, 3] and got[3][1] == 2000 - 500 - 64
    assert contracts.split_ladder(25) == [10, 1] and contracts.split_ladder(1) == [1]


def fold(sizes, max_items, max_chars, overhead):
    batch, n, used, out = 0, 0, overhead, []
    for k in sizes:
        if n and (n >= max_items or used + k > max_chars):
            batch, n, used = batch + 1, 0, overhead
        out.append(batch)
        n, used = n + 1, used + k
    return out


def test_closing_of_stretches():
    import random

    r = random.Random(3)
    for _ in range(300):
        sizes = [r.randrange(64, 900) for _ in range(r.randrange(1, 80))]
        want = fold(sizes, 5, 2000, 300)
        held, first, got, at = 0, 0, [], 0
        while at < len(sizes):  # stretches of any size, one row too
            n = r.choice([1, 2, 3, 7, 30])
            c = contracts.Closing(sizes[max(0, at - 5) : at], sizes[at : at + n], 5, 1700)
            got += c.numbers(held, first).tolist()
            after, closed = c.through()
            held, first, at = after[held], first + closed[held], at + n
        assert got == want


def test_batches_of_a_large_group_in_many_tasks(spark):
    n, size = 300_000, lambda k: (k * 7919) % 9000
    df = spark.range(n).select("id", F.when(F.col("id") % 10 < 9, "hot").when(F.col("id") % 100 == 9, None).otherwise("small").alias("g"), ((F.col("id") * 7919) % 9000).alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = contracts.budget_batches(df, "id", "n", "g", 25, 60_000, 2_000, 200).toPandas()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for name, rows in out.groupby(out["g"].fillna("-")):
        rows = rows.sort_values("id")
        assert rows["batch_no"].tolist() == fold([size(k) + contracts.OVERHEAD for k in rows["id"]], 25, 60_000, 2_000), name
    assert len(out) == n


def test_bodies_are_cut_at_a_sentence(spark):
    df = spark.createDataFrame([("One  sentence here. " * 200,), ("short",), (None,), ("x" * 5000,)], "t string")
    got = [r.x for r in df.select(contracts.fitted(F.col("t"), 3000, 1000, 200).alias("x")).collect()]
    assert got[0].endswith(".") and 0.6 * 1936 < len(got[0]) <= 1936 and "  " not in got[0] and got[1:3] == ["short", ""] and len(got[3]) == 1936
    assert df.select(contracts.fitted(F.col("t"), 1200, 1000, 200).alias("x")).where("x is not null").isEmpty()


def test_main_text():
    page = "<html><nav>menu</nav><div class='ad'>buy</div><article><p>" + "Body words here. " * 30 + "<p>More &amp; more</article><script>x()</script>"
    text = summaries.main_text(page)
    assert "menu" not in text and "buy" not in text and "x()" not in text and "More & more" in text and summaries.main_text(None) == "" and summaries.main_text("plain") == "plain"


def test_stratified_takes_turns(spark):
    df = spark.createDataFrame([(k, "big" if k < 90 else "small") for k in range(100)], "k long, s string")
    got = [r.s for r in labels.stratified(df, ["s"], "k", 10).collect()]
    assert got.count("small") == 5


def test_shown_lines_keep_their_digits(spark):
    three = F.split(F.lit("0 first 0| 11 second 1|2 third 2 "), "[|]")
    row = spark.range(1).select(runs.sound_lines(three).alias("l"), runs.display_text(three, F.lit(""), F.lit(None), F.lit("t")).alias("t")).first()
    assert row.l == ["0 first 0", "11 second 1", "2 third 2"] and row.t == "0 first 0 11 second 1 2 third 2"


def test_sentences_keep_their_digits(spark):
    text = "0 of the first sentence 0. 11 of the second sentence 11. 2 of the third sentence here 2"
    assert one(spark, tx.sentences, text) == ["0 of the first sentence 0.", "11 of the second sentence 11.", "2 of the third sentence here 2"]
    rows = summaries.term_frequency(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert {(r.term, r.n) for r in rows} >= {("11", 2), ("sentence", 3)}
