"""Quality rules, periodic runs and importance resampling against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenfold.llm import periodic, quality_rules, resample
from lumenfold.llm import queries as q

from .conftest import prose

BLANK = r"[^\x20\x09-\x0D]"


def rates(text):
    text = text or ""
    w, lines = re.findall(BLANK + "+", text), [x for x in text.split("\n") if re.search(BLANK, x)]
    at = collections.defaultdict(list)
    for i in range(len(w) - 4):
        at[tuple(w[i : i + 5])].append(i)
    again = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(again)


def bucket(v):
    shift = max(v.bit_length() - 6, 0)
    return shift * 32 + (v >> shift)


def middle(b):
    shift = max(b // 32 - 1, 0)
    return (b - shift * 32 << shift) + ((1 << shift) // 2)


def verdicts(rows):
    """rows: (lang, source, text). The kept flags by the stated rules, from whole lists instead of sketches."""
    counts = [dict(zip(quality_rules.COUNTS, rates(t), strict=True)) for _, _, t in rows]

    def fence(name, members):
        num, of, least, _, _ = quality_rules.RULES[name]
        values = sorted(bucket(counts[k][num] * 1000 // counts[k][of]) for k in members if counts[k][of])
        if not values:
            return None
        q1, q3 = (middle(values[-(-len(values) * k // 4) - 1]) for k in (1, 3))
        most = max(collections.Counter(values).values())
        reach = quality_rules.REACH * max(q3 - q1, least)
        return q1 - reach, q3 + reach, len(values) >= quality_rules.MIN_DOCS and most * quality_rules.MOST_IN_BUCKET <= len(values)

    def wider(own, more):
        return own if own[2] else (min(own[0], more[0]), max(own[1], more[1]), True)

    groups, langs = collections.defaultdict(list), collections.defaultdict(list)
    for k, (lang, source, _) in enumerate(rows):
        groups[lang, source].append(k)
        langs[lang].append(k)
    out = []
    for k, (lang, source, _) in enumerate(rows):
        c = counts[k]
        bad = c["n_words"] < 10 or 100 * c["n_repeat_words"] > 20 * c["n_words"]
        for name, (num, of, _, slack, below) in quality_rules.RULES.items():
            own, of_lang, every = fence(name, groups[lang, source]), fence(name, langs[lang]), fence(name, range(len(rows)))
            if own:
                low, high, _ = wider(own, wider(of_lang, every))
                bad |= c[num] * 1000 > high * c[of] + slack * 1000 or below and c[num] * 1000 < low * c[of] - slack * 1000
        out.append(not bad)
    return out


def test_counts_of_texts(spark):
    r = random.Random(1)
    texts = [None, "", " \n\t ", "a", "a b c d", "a b c d e", "a b c d e a b c d e", "x " * 40, "x\x0by\x0cz\r\nx\n\nx\nx ", "é日 ##| <b>\n" * 5, "   x"]
    texts += [" ".join(r.choice("abc") for _ in range(r.randrange(60))) for _ in range(150)] + [prose(k, 3000, 40) for k in range(3)] + ["\n".join(r.choice(["", " ", "p q", "p q ", "$"]) for _ in range(12)) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").select("doc_id", quality_rules.counts(F.col("text")).alias("c")).select("doc_id", "c.*")
    got = {x["doc_id"]: tuple(x[c] for c in quality_rules.COUNTS) for x in df.collect()}
    assert [got[k] for k in range(len(texts))] == [rates(t) for t in texts]


def test_sketch_buckets(spark):
    values = [*range(300), 1000, 12345, 2**31 + 7, 2**40 - 1]
    for r in spark.createDataFrame([(v,) for v in values], "v long").select("v", quality_rules.bucket(F.col("v")).alias("b")).withColumn("m", quality_rules.middle(F.col("b"))).collect():
        assert (r.b, r.m) == (bucket(r.v), middle(bucket(r.v))) and abs(r.m - r.v) * 32 <= r.v


def test_sketches_merge(spark):
    rows = [(r.choice(["en", None]), r.choice("ab"), *rates(prose(k, 30 + k))) for k, r in ((k, random.Random(k)) for k in range(80))]
    df = spark.createDataFrame(rows, "lang string, source string, " + ", ".join(f"{c} long" for c in quality_rules.COUNTS))
    whole = quality_rules.sketch(df, ("lang",)).collect()
    parts = quality_rules.merged(quality_rules.sketch(df), "lang").collect()
    assert sorted(map(repr, map(tuple, whole))) == sorted(map(repr, map(tuple, parts)))


def test_rules_against_whole_lists(spark):
    r = random.Random(4)
    rows = []
    for k in range(900):
        lang, source = r.choice(["en", "en", "fr", None]), r.choice(["hot", "hot", "hot", "a", None])
        long = {"en": "w", "fr": "motlong", None: "z"}[lang]
        text = " ".join(long + str(r.randrange(500)) for _ in range(r.randrange(3, 160)))
        odd = r.randrange(12)
        rows.append((lang, source, text.replace(" ", " ## ") if odd == 0 else "\n".join(text[k : k + 9] for k in range(0, len(text), 9)) + "\nsame line" * r.randrange(40) if odd == 1 else text.upper() * 3 if odd == 2 else text.replace(" ", "long ") if odd == 3 else text))
    rows += [("fr", "copies", rows[5][2])] * 300 + [("en", "hot", None), (None, None, "")]
    df = spark.createDataFrame([(k, *x) for k, x in enumerate(rows)], "doc_id long, lang string, source string, text string")
    got = {x.doc_id: x for x in quality_rules.assess(df).collect()}
    want = verdicts(rows)
    assert [got[k].kept for k in range(len(rows))] == want and 0.5 < sum(want) / len(want) < 0.95
    assert {x for k in got for x in got[k].failed} == set(quality_rules.RULES)
    assert sorted(x.doc_id for x in quality_rules.kept_rows(df).collect()) == [k for k, keep in enumerate(want) if keep]


def test_rules_keep_clean_labels(spark):
    data = "/root/testdata/sf0.01"
    got = quality_rules.assess(spark.read.parquet(f"{data}/documents.parquet")).join(spark.read.parquet(f"{data}/labels.parquet"), "doc_id")
    by = collections.Counter((r.quality, r.kept) for r in got.where("not base_failed").collect())
    assert by[1, True] > 0.99 * (by[1, True] + by[1, False]) and by[0, False] > 0.8 * (by[0, True] + by[0, False])


def test_rules_odd_rows(odd, nothing):
    out = quality_rules.assess(odd).collect()
    assert len(out) == odd.count() and quality_rules.assess(nothing).count() == 0 and quality_rules.kept_rows(nothing).count() == 0
    by = {r.doc_id: r for r in out}
    assert by[3].n_words == by[4].n_words == by[5].n_words == 0 and by[3].base_failed and not by[3].kept and by[0][3:] == by[12][3:]
    kept = quality_rules.kept_rows(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in out)


def test_rules_plan_has_no_python(spark, data):
    plan = quality_rules.assess(spark.read.parquet(f"{data}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


def all_runs(x):
    best = {}
    for p in range(1, len(x) // 3 + 1):
        i = 0
        while i < len(x) - p:
            j = i
            while j < len(x) - p and x[j] == x[j + p]:
                j += 1
            if j + p - i >= max(24, 3 * p) and j > i:
                best.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted(((s, e - s, p) for (s, e), p in best.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("block", [1, 13, 1 << 16])
def test_runs_match_brute_force(monkeypatch, block):
    monkeypatch.setattr(periodic, "BLOCK", block)
    r = random.Random(block)
    for _ in range(400):
        n, letters = r.randrange(150), r.choice([1, 2, 2, 3, 9])
        x = [r.randrange(letters) for _ in range(n)]
        for _ in range(r.randrange(4)):
            if n > 30:
                a = r.randrange(n)
                p = r.randrange(1, max(2, (n - a) // 3 + 1))
                for i in range(a, min(n, a + p * r.randrange(3, 9))):
                    x[i] = x[a + (i - a) % p]
        assert periodic.runs_of(np.array(x, dtype=np.int64)) == all_runs(x)


def test_runs_when_hashes_collide():
    half = [bin(i).count("1") % 2 for i in range(1 << 12)]  # its halves of 2^11 and more have equal hashes modulo 2^64 though they differ
    hashes = periodic.PrefixHashes(np.array(half))
    assert hashes.equal(np.array([0]), np.array([2048]), np.array([2048]))[0] and half[:2048] != half[2048:]
    assert periodic.runs_of(np.array(half * 4)) == all_runs(half * 4) == [(0, 1 << 14, 1 << 12)]


def test_strongest_run_is_exact():
    assert periodic.strongest([(0, 30, 7), (40, 60, 14), (5, 30, 7)]) == (0, 30, 7) and periodic.strongest([]) is None
    assert periodic.strongest([(0, 10**17, 3 * 10**16), (9, 10**17 + 1, 3 * 10**16)]) == (9, 10**17 + 1, 3 * 10**16)


def test_run_digests_of_a_whole_table(spark, data):
    got = {r.doc_id: r for r in q.op12_periodic_runs(spark, data).collect()}
    docs = spark.read.parquet(f"{data}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        w = re.findall(BLANK + "+", d.text or "")
        h, n = zlib.crc32(str(d.doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if n > 2500:  # the plain way is quadratic
            continue
        found = all_runs(w)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        gone = {i for s, size, p in found for i in range(s + p, s + size)}
        x = got[d.doc_id]
        assert (x.n_runs, x.start, x.length, x.period, x.exponent_milli) == (len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None)
        assert x.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in found).encode()).hexdigest()
        assert x.collapsed_sha256 == hashlib.sha256(" ".join(v for i, v in enumerate(w) if i not in gone).encode()).hexdigest()
    assert sum(r.n_runs > 0 for r in got.values()) > 0.05 * len(got)


def test_runs_odd_rows(spark, odd, nothing):
    out = periodic.digest(odd).collect()
    assert len(out) == odd.count() and periodic.digest(nothing).count() == 0 and periodic.runs(nothing).count() == 0
    empty = hashlib.sha256(b"").hexdigest()
    by = {r.doc_id: r for r in out}
    assert by[3][1:] == by[4][1:] == by[5][1:] == (0, None, None, None, None, empty, empty) and by[0][1:] == by[1][1:]
    docs = spark.createDataFrame([(1, "go  " + "a b c " * 9 + "end", 5), (2, "no\nrun", 6), (3, None, 7)], "doc_id long, text string, period int")
    assert [tuple(r) for r in periodic.runs(docs).collect()] == [(1, 1, 27, 3, "a b c")]
    assert [tuple(r) for r in periodic.collapsed(docs).orderBy("doc_id").collect()] == [(1, "go a b c end", 5), (2, "no\nrun", 6), (3, None, 7)]
    assert periodic.collapsed(odd).columns == odd.columns and periodic.collapsed(odd).count() == odd.count()


def plain_draw(docs, target, percent=25, least=20):
    """docs: (doc_id, text). doc_id -> (n_features, weight, score, rank)."""

    def features(t):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return len(w), [zlib.crc32(x.encode()) % 10000 for x in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:], strict=False))]]

    made = [features(t) for _, t in docs]
    s, t = collections.Counter(b for _, f in made for b in f), collections.Counter(b for x in target for b in features(x)[1])
    ns, nt = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (ns + 10000) / ((s[b] + 1) * (nt + 10000))))
    rows = []
    for (i, _), (n, f) in zip(docs, made, strict=True):
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    ok = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    rank = collections.defaultdict(list)
    for k, r in enumerate(ok[: len(ok) * percent // 100]):
        rank[r].append(k + 1)
    return sorted(((r[0], *r[2:], rank[r].pop(0) if rank[r] else None) for r in rows), key=repr)


def as_rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_draw_of_a_whole_table(spark, data):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    assert as_rows(q.op13_importance_resampling(spark, data)) == plain_draw(docs, target)


def test_draw_with_copies_and_ties(spark):
    r = random.Random(2)
    docs = [(k, prose(7, 60)) for k in range(2500)] + [(2500 + k, prose(k % 900, r.randrange(40))) for k in range(1800)] + [(3000, "A B c É 1-2 " * 9)] * 7 + [(9999, None), (10_000, ""), (10_001, "one")]
    target = [prose(3, 200), None, ""]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    to = spark.createDataFrame([(t,) for t in target], "text string")
    got = as_rows(resample.resample(df, to))
    assert got == plain_draw(docs, target)
    drawn = resample.drawn_rows(df.withColumn("key", F.lit(1)).withColumn("_many", F.lit("x")), to)
    assert drawn.columns == ["doc_id", "text", "key", "_many"] and sorted(x.doc_id for x in drawn.collect()) == sorted(x[0] for x in got if x[4])


def test_draw_odd_rows(spark, odd, nothing):
    target = spark.createDataFrame([("idiot scum",)], "text string")
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert as_rows(resample.resample(odd, target)) == plain_draw(docs, ["idiot scum"])
    assert resample.resample(nothing, target).count() == 0 and as_rows(resample.resample(odd, nothing)) == plain_draw(docs, [])
    assert resample.drawn_rows(odd, target).columns == odd.columns and resample.drawn_rows(nothing, target).count() == 0
