"""Readers, models, gates, Korean rules, event clusters and picks against plain twins on small fixtures."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lumenfold.functions import text as tx
from lumenfold.functions.terms import ko_finance
from lumenfold.operators import articles, event_features, events, labels, ranking, relevance, reports, runs, summaries, tagging
from lumenfold.sources import tables
from lumenfold.streaming import windows

KO = ko_finance()


def korean(spark, *texts):
    return spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")


@pytest.mark.parametrize(("text", "term", "want"), [
    ("신협중앙회 발표", "신협", True), ("여신협회 발표", "신협", False), ("금융위축 우려", "금융위", False), ("프로야구 감독 경질", "감독", True), ("감독 교체 발표", "감독", False), ("축구 경기 결과", "경기", True), ("경기 결과 발표", "경기", False)])
def test_special_terms_need_their_context(spark, text, term, want):
    assert korean(spark, text).select(KO.has(F.col("t"), term).alias("x")).first().x is want
    assert korean(spark, text).select(KO.scan(F.col("t"), [term]).alias("x")).first().x == ([term] if want else [])


def test_spellings(spark):
    got = [r.x for r in korean(spark, "불법 사금융과 불법 대부를 단속", "불법 대부도 여행").select(KO.canonical(F.col("t")).alias("x")).collect()]
    assert got == ["불법사금융과 불법대부를 단속", "불법 대부도 여행"]
    assert [r.x for r in korean(spark, "美 증시와 인뱅", "美 여행").select(KO.tag_text(F.col("t")).alias("x")).collect()] == ["미국 증시와 인터넷은행", "美 여행"]
    found = korean(spark, "리스크 관리", "자동차 리스 은행 창구").select(KO.scan(F.col("t"), ["리스", "은행"], tags=True).alias("x")).collect()
    assert [r.x for r in found] == [[], ["리스", "은행"]]


def test_score_extras(spark):
    df = spark.createDataFrame([(0, "공유재산 대부 계약 안내", "l"), (1, "사채 금감원 단속", "l"), (2, "사채 시장", "l")], "k int, score_text string, link string")
    got = {r.k: r.score for r in relevance.with_score(df, KO).collect()}
    plain = {r.k: r.score for r in relevance.with_score(df, type(KO)(**{**KO.__dict__, "extras": []})).collect()}
    assert got[0] == plain[0] - 10 and got[1] == plain[1] + 2 and got[2] == plain[2]


def test_sector_rules(spark):
    made = [tagging.build_sector("은행", ["은행", "예금", "대출"], ["은행", "대출"], strong=["은행권"]), tagging.Sector("감독·제재", ["제재"]), tagging.Sector("대부", ["대부업"])]
    assert made[0].strong == ["예금", "은행권"] and made[0].weak == ["은행", "대출"] and made[0].generic == ["은행", "대출"]
    rows = [("금감원, 대부업체 검사 착수", ""), ("국민은행 예금 늘어", ""), ("제재 논의", "내용 없음")]
    df = spark.createDataFrame([(k, *r, "") for k, r in enumerate(rows)], "k int, title_text string, body_text string, query_text string")
    got = {r.k: (r.best_sector, r.sector_score, r.sector_title_score) for r in tagging.assign_sector(tagging.with_found(df, KO, made), made, profile=KO).collect()}
    assert got[0][0] == "대부" and got[1] == ("은행", 11.0, 13.0) and got[2][1:] == (0.0, 0.0)  # 6 for the title's word, then the rules


@pytest.mark.parametrize(("title", "want"), [("금리 인상 - SBS", "금리 인상"), ("금리 인상 | 조선비즈", "금리 인상"), ("금리 인상 · 한겨레", "금리 인상"), ("금리 인상 - 전망", "금리 인상 전망")])
def test_outlets_leave_title_keys(spark, title, want):
    assert korean(spark, title).select(tx.title_key(F.col("t")).alias("x")).first().x == want


def test_publisher(spark):
    df = spark.createDataFrame([("[한국경제]", "https://a.com/x"), ("매일경제 | 네이버뉴스", ""), ("", "https://news.naver.com/1"), (None, "https://www.b.co.kr/1")], "n string, u string")
    assert [r.x for r in df.select(tx.publisher(F.col("n"), F.col("u")).alias("x")).collect()] == ["한국경제", "매일경제", "", "b.co.kr"]


def title_rows(n, seed):
    r = random.Random(seed)
    words = ["loan", "rates", "rise", "banks", "fall", "card", "fraud", "probe", "fund", "opens", "7%", "12", "seoul"]
    out = []
    for k in range(n):
        base = out[r.randrange(len(out))][1].split() if out and r.random() < 0.5 else [r.choice(words) for _ in range(r.randrange(2, 8))]
        if r.random() < 0.6:
            base[r.randrange(len(base))] = r.choice(words)
        out.append((k, " ".join(base), r.choice("ab"), r.random() < 0.1, r.choice([None, None, "f:1", "f:2", "g:1"]), r.choice([[], [], ["ratio"]]), r.choice([[], ["banks"], ["cards"]])))
    return out


def test_event_clusters_match_first_fit_over_all_pairs(spark):
    rows = title_rows(160, 5)
    df = spark.createDataFrame([(k, "d1" if k % 3 else "d2", t, t, s, low, f, m, sub) for k, t, s, low, f, m, sub in rows], "ingest_seq long, report_date string, title string, norm_title string, sector string, low_value boolean, fingerprint string, metrics array<string>, subjects array<string>")
    feats = df.withColumns({"tokens": tx.tokens(F.col("title")), "numbers": tx.numbers(F.col("title")), "entities": F.array_intersect(tx.tokens(F.col("title")), F.array(F.lit("seoul"), F.lit("banks"))), "issue_terms": F.array_intersect(tx.tokens(F.col("title")), F.array(F.lit("loan"), F.lit("fraud"), F.lit("rates"))), "period": F.lit(None).cast("string")})
    got = {r.ingest_seq: (r.cluster_id, r.cluster_size) for r in events.event_clusters(feats, safe=("g:",)).collect()}
    want = {}
    for day in ("d1", "d2"):
        every = [r.asDict() for r in feats.where(F.col("report_date") == day).orderBy("ingest_seq").collect()]
        first = {}
        for r in every:
            first.setdefault(r["norm_title"], r)
        heads = [{**r, **{c: set(r[c]) for c in events.SETS if c in r}} for r in first.values()]
        for members in events.first_fit(heads, ("g:",)):
            titles = {heads[m]["norm_title"] for m in members}
            inside = [r["ingest_seq"] for r in every if r["norm_title"] in titles]
            want |= {k: (events.cluster_id(sorted(titles)), len(inside)) for k in inside}
    assert got == want and len({c for c, _ in want.values()}) < 120


def test_korean_event_features(spark):
    spec = event_features.korean()
    rows = [("삼성생명 2026년 2분기 킥스 비율 210.50% 기록", "", "보험"), ("보험사 킥스 비율 200%", "", "보험"), ("1분기 대비 개선, 국민은행 6월말 연체율 0.5%", "", "은행"), ("연체율 0.3%p 상승", "", "은행"),
            ("서울특별시 불법사금융 집중단속", "전통시장 상인 보호", "대부"), ("업비트 수수료 인하", "", "디지털자산"), ("한국은행 기준금리 동결", "", "거시·시장"), ("오늘의 은행 단신", "", "은행"), ("저축은행 현장점검 착수", "", "저축은행")]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "ingest_seq long, title string, description string, sector string")
    got = {r.ingest_seq: r for r in event_features.with_features(df, spec).collect()}
    assert got[0].reported == ["capital_adequacy_ratio=210.5"] and got[0].subjects == ["삼성생명"] and got[0].period == [2026, 6]
    assert got[1].subjects == ["보험사"] and got[1].period == [None, None] and got[2].subjects == ["국민은행"] and got[2].period == [None, 6]
    assert got[3].metrics == ["delinquency_rate"] and got[3].reported == [] and got[3].subjects == []
    assert got[4].fingerprint == "enforcement:서울시:small_business" and got[4].strict and got[4].enforces
    assert [got[k].fingerprint for k in (5, 6, 8)] == ["digital:upbit:fee", "macro:bok_base_rate", "rule:savings_bank_inspection"] and got[7].low_value and "국민은행" in got[2].entities


def test_lending_clusters_need_two_supporters(spark):
    base = {"numbers": set(), "entities": set(), "issue_terms": {"loan_ad"}, "fingerprint": None, "low_value": False, "metrics": set(), "subjects": set(), "period": None, "sector": "대부", "strict": True}
    row = lambda t, words: {**base, "norm_title": t, "tokens": set(t.split()), "words": words, "headline_terms": {"loan_ad"}, "description_words": {"x"}}
    a, b, c = row("aaaa bbbb cccc dddd", {1, 2, 3, 4}), row("aaaa bbbb eeee ffff", {1, 2, 3, 5}), row("zzzz yyyy xxxx wwww", {3, 5, 6})
    assert events.same_event(b, a) and not events.same_event(c, a)
    bridge = {**c, "words": {1, 2, 3, 5, 6}, "description_words": set()}
    assert events.same_event(bridge, b) and not events.same_event(bridge, a)
    lone = [a, b, bridge]
    assert events.first_fit(lone) == [[0, 1], [2]] and events.first_fit([{**r, "strict": False} for r in lone]) == [[0, 1, 2]]
    backed = [{**r, "description_words": {"p", "q"}} for r in lone]
    assert events.first_fit(backed) == [[0, 1, 2]]


def test_near_titles_in_other_sectors_are_one_event(spark):
    a, b = "internationalization", "internationalisation"
    base = {"tokens": {1}, "numbers": set(), "entities": set(), "issue_terms": set(), "fingerprint": None, "low_value": False, "metrics": set(), "subjects": set(), "period": None}
    assert events.first_fit([{**base, "norm_title": a, "sector": "x"}, {**base, "norm_title": b, "sector": "y"}]) == [[0, 1]]


def test_ratio_pairs_with_many_insertions(spark):
    r = random.Random(2)
    rows = []
    for k in range(40):
        base = "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(71)).strip()
        more = list(base)
        for _ in range(r.randrange(1, 20)):
            more.insert(r.randrange(len(more)), r.choice("0123456789"))
        rows += [(2 * k, base), (2 * k + 1, "".join(more))]
    norm = {k: " ".join(t.split()) for k, t in rows}
    got = {(x.doc_a, x.doc_b) for x in events.ratio_pairs(spark.createDataFrame(rows, "doc_id long, title string")).collect()}
    assert got == {(a, b) for a in norm for b in norm if a < b and events.ratio(norm[b], norm[a]) >= 0.88} and len(got) > 20


def shuffled(spark):
    """Bytes that all stages so far have written for shuffles."""
    sc = spark.sparkContext
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None).iterator()
    total = 0
    while stages.hasNext():
        total += stages.next().shuffleWriteBytes()
    return total


def test_long_titles_are_shuffled_a_few_times(spark):
    r = random.Random(4)
    rows = []
    for k in range(120):
        base = "".join(r.choice("abcdefghijklmnopqrstuvwxyz  .,0123456789éöß") for _ in range(r.randrange(150, 2500)))
        more = list(base)
        for _ in range(r.randrange(1, 8)):
            more[r.randrange(len(more))] = r.choice("xyz0")
        rows += [(2 * k, base), (2 * k + 1, "".join(more))]
    norm = {k: t for t, k in reversed({" ".join(t.split()): k for k, t in reversed(rows)}.items())}
    before = shuffled(spark)
    got = {(x.doc_a, x.doc_b) for x in events.ratio_pairs(spark.createDataFrame(rows, "doc_id long, title string")).collect()}
    assert shuffled(spark) - before < 20 * sum(len(t) for t in norm.values())
    near = lambda a, b: 2 * min(len(a), len(b)) >= 0.88 * (len(a) + len(b))
    assert got == {(a, b) for a in norm for b in norm if a < b and near(norm[a], norm[b]) and events.ratio(norm[b], norm[a]) >= 0.88} and len(got) > 5


def test_capped_top_matches_picks_over_all_rows(spark):
    r = random.Random(9)
    rows = [(k, f"title {r.randrange(30) if k % 2 else 0}", f"c{r.randrange(40)}", r.choice(["big", "big", "soft", "misc", "b"]), r.random(), r.choice([[], ["romance"]]), 0.9, 9) for k in range(600)]
    df = spark.createDataFrame(rows, "ingest_seq long, title string, cluster_key string, sector string, rank_score double, topics array<string>, prob double, score int").withColumns({"pub_date": F.lit("2024-01-01").cast("timestamp"), "description": F.lit("")})
    got = [x.ingest_seq for x in ranking.capped_top(df, caps={"soft": 2, "misc": 1}).orderBy("place").collect()]
    every = [{"ingest_seq": k, "title_key": t, "cluster_key": c, "sector": s, "g": "romance" in top} for k, t, c, s, _, top, _, _ in sorted(rows, key=lambda x: (x[4], x[1]), reverse=True)]
    picks, seen, used = [], set(), {}
    fresh = lambda x: x["title_key"] not in seen and x["cluster_key"] not in seen

    def take(x):
        picks.append(x["ingest_seq"])
        seen.update((x["title_key"], x["cluster_key"]))

    for x in every:
        if len(picks) < 10 and fresh(x) and used.get(x["sector"], 0) < {"soft": 2, "misc": 1}.get(x["sector"], 3) and not (x["g"] and used.get("g", 0) >= 2):
            take(x)
            used[x["sector"]] = used.get(x["sector"], 0) + 1
            used["g"] = used.get("g", 0) + x["g"]
    for x in every:
        if len(picks) < 10 and fresh(x) and not (x["sector"] == "soft" and any(fresh(y) and y["sector"] != "soft" for y in every)):
            take(x)
    for x in sorted(every, key=lambda y: y["ingest_seq"]):
        if len(picks) < 10 and fresh(x):
            take(x)
    assert got == picks


def test_summaries(spark):
    of = summaries.Summarizer(summaries.SummaryWords(action="decided"))
    text = ["The bank decided to raise the rate by 3 points today", "Read more at www.example.com about all of this", "The market expects that rate rise to last for 2 years", "Nothing else was said by anyone at all"]
    assert of.best(text, "Bank rate") == "The bank decided to raise the rate by 3 points today. The market expects that rate rise to last for 2 years."
    assert of.summary([], ["The description has one full sentence here"], title="Title") == "The description has one full sentence here." and of.summary([], [], title="Only a title") == "Only a title."
    assert not of.sound("Too short.", "x") and not of.sound("This is the title of the piece.", "This is the title of the piece")
    ko = summaries.Summarizer(summaries.KOREAN)
    assert ko.is_junk("무단전재 및 재배포 금지 안내 문구입니다") and ko.is_junk("This sentence is in English only, all of it") and "5%" in ko.best(["금융위는 대출 금리를 5% 인하하기로 결정했다고 밝혔다", "날씨가 아주 맑고 따뜻한 하루가 이어졌습니다"], "대출 금리")
    df = spark.createDataFrame([(1, "", "", ""), (2, "A title", None, None), (3, None, None, None)], "doc_id long, title string, description string, text string")
    assert {r.doc_id: r.summary for r in summaries.summarize(df).collect()} == {1: "", 2: "A title.", 3: ""}


def test_readers_and_writers(spark, tmp_path):
    rows = [{"title": "<b>A</b> &amp; B", "link": "l", "pubDate": "Mon, 02 Mar 2026 09:00:00 +0900"}, {"title": "C", "link": "l", "pubDate": "2 Mar 2026 09:00:00"}, {"title": "D", "link": "l", "pubDate": "no date"}]
    (tmp_path / "raw.json").write_text("\n".join(map(json.dumps, rows)))
    got = tables.read_raw(spark, str(tmp_path / "raw.json")).orderBy("title").collect()
    assert [r.title for r in got] == ["A & B", "C"] and got[0].pub_date == got[1].pub_date
    flat = articles.normalize(spark.createDataFrame([(" t ", "l", " d "), ("", "l", "d"), ("t", None, "d")], "title string, link string, description string")).collect()
    assert [(r.title, r.source_description) for r in flat] == [("t", "d")]
    (tmp_path / "q.yml").write_text("sectors: {bank: [loan, rate]}\ntopics: {fraud: [scam]}\nfetch_queries: {a: [x, y], b: [x]}\n")
    assert [(r.kind, r.name, r.term) for r in tables.load_taxonomy(spark, str(tmp_path / "q.yml")).collect()] == [("sector", "bank", "loan"), ("sector", "bank", "rate"), ("topic", "fraud", "scam"), ("fetch", "a", "x"), ("fetch", "a", "y"), ("fetch", "b", "x")]
    base = spark.createDataFrame([(1, "t", "d", "l")], "k long, title string, description string, link string").withColumns({"report_date": F.lit("2026-03-02"), "prob": F.lit(0.5), "score_text": F.lit("은행 대출")})
    decided = relevance.decide(relevance.with_score(base, KO), KO)
    tables.write_candidates(decided, str(tmp_path / "log"))
    back = spark.read.option("header", True).csv(str(tmp_path / "log")).first()
    assert back.title == "t" and back.decision in ("keep", "drop") and str(back.report_date) == "2026-03-02" and len(back) == 17
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "candidates_2026-03-01.csv").write_text("title,summary,url\na,,u\n")
    (tmp_path / "in" / "candidates_2026-03-02.csv").write_text("title,summary,url\nb,s,\n")
    one = tables.read_candidates(spark, [str(tmp_path / "in" / "candidates_2026-03-01.csv")]).collect()
    assert [(r.title, r.summary, str(r.report_date)) for r in one] == [("a", "", "2026-03-01")] and tables.read_candidates(spark, str(tmp_path / "in")).count() == 2
    with pytest.raises(ValueError):
        tables.read_candidates(spark, str(tmp_path / "in"), "phase1_debug")
    cache = spark.createDataFrame([(k, f"k{k}", ["a", "b", "c"] if k else ["a"], "2026-03-01 00:00:00") for k in range(4)], "ingest_seq long, key string, lines array<string>, created_at string")
    for _ in range(2):  # the second write replaces the first
        tables.write_line_cache(cache, str(tmp_path / "cache"), keep=3)
    assert sorted(r.key for r in tables.read_line_cache(spark, str(tmp_path / "cache")).collect()) == ["k1", "k2", "k3"] and tables.read_line_cache(spark, str(tmp_path / "cache"), version=2).isEmpty()
    tagged = spark.createDataFrame([(1, "T <x>", "d", "l", "bank", ["a"], 5, "2026-03-01")], "ingest_seq long, title string, description string, link string, sector string, topics array<string>, score int, pub_date string")
    reports.write_report(tagged, "R", str(tmp_path / "rep"), "r1")
    assert spark.read.text(str(tmp_path / "rep" / "r1.md")).count() == 3 and "T &lt;x&gt;" in spark.read.text(str(tmp_path / "rep" / "r1.html"), wholetext=True).first().value


def labelled(spark, n=80):
    r = random.Random(1)
    rows = [(k, " ".join(r.choice(["loan rate", "bank fraud", "credit"] if k % 2 else ["football", "concert tour", "weather"]) for _ in range(5)), str(k % 2) if k % 10 else "review", 1.0) for k in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, auto_label string, train_weight double")


def test_models(spark, tmp_path):
    rows = labelled(spark)
    used = labels.usable(rows).where("use = 'used'").withColumn("y", F.col("auto_label").cast("int"))
    parts, why = labels.stratified_holdout(used, "y", "doc_id")
    assert why == "" and {(r.y, r.part): r.n for r in parts.groupBy("y", "part").agg(F.count("*").alias("n")).collect()} == {(0, "test"): 8, (0, "train"): 24, (1, "test"): 10, (1, "train"): 30}
    assert labels.stratified_holdout(used.limit(3), "y", "doc_id")[1] == "too_few_rows"
    names = spark.createDataFrame([("a", "included"), ("b", "included"), ("c", "no_date")], "name string, reason string")
    take = lambda _: rows
    path = str(tmp_path / "relevance_candidate")
    assert labels.refresh(spark, names, take, "models/relevance")[:2] == ("failed", "forbidden_model_path")
    assert labels.refresh(spark, names.limit(0), take, path)[1] == "no_candidate_files" and labels.refresh(spark, names.where("name = 'c'"), take, path)[1] == "no_eligible_candidate_files"
    assert labels.refresh(spark, names, take, path, least_files=3)[1] == "insufficient_eligible_candidate_files" and labels.refresh(spark, names, take, path)[1] == "too_few_positive"
    status, _, metrics = labels.refresh(spark, names, take, path, least_class=20, max_iter=50)
    assert status == "refreshed" and metrics.where("threshold = 0.5").first().f1 > 0.9
    prob = {r.doc_id: r.prob for r in labels.CharModel.load(spark, path).add(used).collect()}
    assert all((p > 0.5) == bool(k % 2) for k, p in prob.items())
    with pytest.raises(ValueError):
        labels.manual_model(used.limit(10), label="y")
    assert labels.manual_model(used, label="y").add(used).count() == used.count()


def test_settings():
    env = {"A": "5", "B": "x", "C": "99", "D": "nan"}
    assert runs.setting("A", 1, env=env) == 5 and runs.setting("B", 1, env=env) == 1 and runs.setting("C", 1, 0, 10, env) == 1 and runs.setting("D", 0.5, env=env) == 0.5 and runs.setting("E", 2, env=env) == 2


def test_keyed_cache_stream_keeps_the_newest(spark, tmp_path):
    schema = "k string, v string, n long"
    for part, rows in enumerate(([("a", "1", 1), ("b", "1", 2)], [("a", "2", 3)], [("b", "0", 1)])):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(tmp_path / "in"))
        updates = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        windows.latest_by_key(spark, updates, "k", "n", str(tmp_path / "table"), str(tmp_path / "state"))
    assert {r.k: r.v for r in windows.current(spark, str(tmp_path / "table")).collect()} == {"a": "2", "b": "1"}
