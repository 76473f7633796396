"""Mixing, media, token counts, packing, scores and the pipeline."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from lumenfold.llm import hmm, mixing, mpeg_audio, packing, token_counts, toxicity
from lumenfold.llm.tokens import load

from .conftest import prose


def test_mix_against_sql(spark, data):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    got = sorted(map(tuple, mixing.mix(spark.read.parquet(f"{data}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken").collect()))
    assert got == sorted(con.execute(mixing.ORACLE).fetchall())


def water(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w, total = {s: weights[k % 3] for k, s in enumerate(names)}, sum(sizes.values())
    target, open_ = {}, set(names)
    while True:
        rest = total - sum(target.values())
        level = {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if level[s] > cap * sizes[s]}
        if not over:
            return target | level
        target |= {s: float(cap * sizes[s]) for s in over}
        open_ -= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 100, "c": 5, None: 300}, {"x": 1, "y": 1000, "z": 1000}, {"a": 0, "b": 4}, {"é": 50, "z": 50, "": 2}])
def test_targets(spark, sizes):
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    want = water(sizes)
    assert set(got) == set(want) and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_mix_comes_near_targets(spark):
    r = random.Random(3)
    rows = [(k, "w " * r.randrange(1, 60), r.choice(["hot", "hot", "b", "c"])) for k in range(3000)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken, target = collections.Counter(), {}
    for x in out:
        taken[x.source] += x.taken
        target[x.source] = x.target
        assert x.taken <= 3 * x.size
    assert all(abs(taken[s] - target[s]) <= 30 for s in target)


def test_mix_odd_rows(odd, nothing):
    out = mixing.mix(odd).collect()
    assert len(out) == odd.count() and mixing.mix(nothing).count() == 0 and mixing.mixed_rows(nothing).count() == 0
    rows = mixing.mixed_rows(odd)
    assert rows.columns == odd.columns and rows.count() == sum(r.repeats for r in out)
    assert len({r.repeats for r in out if r.doc_id == 0}) == 1


def test_audio_round_trip():
    for n in (0, 1, 63, 64, 65, 1417, 1418, 5000, 100_000):
        payload, size = mpeg_audio.padded("a" * n)
        assert size == n and len(payload) % 64 == 0 and len(payload) >= 64
        p = mpeg_audio.parse(mpeg_audio.encode(payload), seeks=True)
        assert p["payload"] == payload and p["sound"] and p["bad_crc"] == 0 and p["skipped"] == 0 and p["frames"] == p["vbr_frames"] == len(p["seeks"])
        assert abs(p["duration_ms"] - p["frames"] * 36) < 1e-9


def test_audio_resynchronises_and_checks():
    payload, _ = mpeg_audio.padded(prose(1, 2000))
    stored = mpeg_audio.encode(payload)
    at = mpeg_audio.parse(stored, seeks=True)["seeks"]
    junk = stored[: at[2]] + b"\xff\xfb\x00junk\xff" + stored[at[2] :] + b"TAG" + bytes(125)
    p = mpeg_audio.parse(junk)
    assert p["skipped"] == 8 and p["payload"] == payload and p["frames"] == len(at)
    bad = bytearray(stored)
    bad[at[1] + 8] ^= 1  # side information under the checksum
    assert mpeg_audio.parse(bytes(bad))["bad_crc"] == 1 and not mpeg_audio.parse(bytes(bad))["sound"]
    assert mpeg_audio.parse(b"")["frames"] == 0 and mpeg_audio.parse(b"no audio at all" * 9)["frames"] == 0


def test_vbri_seek_table():
    head = bytes((0xFF, 0xFB, 0x90, 0x00))  # 417 bytes, 1152 samples
    frames = [head + bytes([k]) * 413 for k in range(6)]
    table = b"VBRI" + (1).to_bytes(2, "big") + bytes(4) + (7 * 417).to_bytes(4, "big") + (6).to_bytes(4, "big") + (3).to_bytes(2, "big") + (3).to_bytes(2, "big") + (2).to_bytes(2, "big") + (2).to_bytes(2, "big") + (2 * 417 // 3).to_bytes(2, "big") * 3
    p = mpeg_audio.parse(head + bytes(32) + table + bytes(413 - 32 - len(table)) + b"".join(frames), seeks=True)
    assert p["vbr_frames"] == p["frames"] == 6 and p["table"] == [(0, 417), (2, 3 * 417), (4, 5 * 417), (6, 7 * 417)]
    assert [at for frame, at in p["table"][:3]] == [p["seeks"][frame] for frame, _ in p["table"][:3]] and mpeg_audio.vbri_table(b"short", 0) == []


def test_frame_headers():
    assert mpeg_audio.header(bytes((0xFF, 0xFB, 0x90, 0x00)))[:3] == (417, 1152, 44100)  # MPEG-1 layer III, 128 kbit/s
    assert mpeg_audio.header(bytes((0xFF, 0xFD, 0xA4, 0x00)))[:3] == (576, 1152, 48000)  # layer II, 192 kbit/s
    assert mpeg_audio.header(bytes((0xFF, 0xF3, 0x40, 0xC0)))[:3] == (104, 576, 22050)  # MPEG-2 layer III, 32 kbit/s
    assert mpeg_audio.header(bytes((0xFF, 0xFB, 0xF0, 0x00))) is None and mpeg_audio.header(b"\xff\xfb") is None


def test_audio_odd_rows(odd, nothing):
    rows = mpeg_audio.digest(odd).collect()
    assert len(rows) == odd.count() and mpeg_audio.digest(nothing).count() == 0
    by = {r.doc_id: r for r in rows}
    assert by[3][1:] == by[4][1:] and by[3].payload_bytes == 64 and by[3].tail_crc32 == zlib.crc32(bytes(64)) and by[0][1:] == by[1][1:]


def test_audio_digests_of_a_whole_table(spark, data):
    df = spark.read.parquet(f"{data}/documents.parquet")
    got = {r.doc_id: r for r in mpeg_audio.digest(df).collect()}
    for r in df.collect():
        raw = (r.text or "").encode()
        payload = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        stored = mpeg_audio.encode(payload)
        x = got[r.doc_id]
        assert (x.n_bytes, x.payload_bytes, x.payload_sha256, x.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert x.seek_offsets == mpeg_audio.parse(stored, seeks=True)["seeks"] and x.duration_ms == 36 * len(x.seek_offsets)
        assert (x.media_bytes, x.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest()) and "sound=1" in x.feature


def test_token_counts(odd, nothing):
    tok = load(token_counts.TOKENIZER)
    want = collections.Counter((r.doc_id, len((r.text or "").encode()), n, n > 2048) for r in odd.collect() for n in [len(tok.encode(r.text or "", add_special_tokens=False).ids)])
    for common in (5, 10_000):  # few words by the map and most by the join, or the other way round
        got = token_counts.count_tokens(odd, common=common)
        assert collections.Counter(map(tuple, got.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect())) == want
    assert token_counts.count_tokens(nothing).count() == 0


def check_packing(rows, texts):
    tok = load(packing.TOKENIZER)
    ids = {k: tok.encode(t or "", add_special_tokens=False).ids + [packing.END_ID] for k, t in texts.items()}
    bins = collections.defaultdict(list)
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and zlib.crc32(np.asarray(part, dtype="<u4").tobytes()) == r.ids_crc32
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 1024
    return len(bins)


def test_packing(spark, data):
    df = spark.read.parquet(f"{data}/documents.parquet")
    rows = packing.pack(df).collect()
    texts = {r.doc_id: r.text for r in df.collect()}
    n = check_packing(rows, texts)
    assert n <= 1.03 * sum(r.length for r in rows) / 1024 + 1
    assert {(r.doc_id, r.piece) for r in rows} and all(r.length == 1024 for r in rows if r.piece > 0)


def test_packing_odd_rows(odd, nothing):
    plain = odd.where("doc_id is not null")
    rows = packing.pack(plain).collect()
    check_packing(rows, {r.doc_id: r.text for r in plain.collect()})
    assert sum(r.doc_id == 0 for r in rows) == 3 and packing.pack(nothing).count() == 0 and packing.pack(odd).where("doc_id is null").count() == 2


@pytest.mark.parametrize("seed", range(6))
def test_program_beats_or_meets_best_fit(seed):
    r = np.random.default_rng(seed)
    lengths = r.integers(1, 1025, 3000) if seed % 2 else np.minimum(1024, (r.pareto(1.2, 3000) * 60 + 1).astype(int))
    demand = np.bincount(lengths, minlength=1025)
    plan = packing.Plan(demand)
    rank = np.zeros(len(lengths), dtype=np.int64)
    for n in np.unique(lengths):
        rank[lengths == n] = np.arange((lengths == n).sum())
    seq, at = plan.place(lengths.astype(np.int64), rank)
    filled = np.zeros((plan.sequences, 1024), dtype=int)
    for s, o, n in zip(seq, at, lengths, strict=True):
        filled[s, o : o + n] += 1
    assert filled.max() == 1 and plan.bound <= plan.sequences + 1e-6
    greedy = sum(n for _, n in packing.best_fit(demand.astype(np.int64).copy()))
    assert plan.sequences <= greedy * 1.005 + 2


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_program_solves_the_given_tables(spark, sf):
    """The amounts come from the weights themselves, on histograms of many distinct lengths, and cover the demand near the dual bound."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").repartition(8)
    demand = np.zeros(1025, dtype=np.int64)
    for r in packing.pieces(docs).groupBy("length").count().collect():
        demand[r["length"]] = r["count"]
    x, lower, _ = packing.program(demand)
    held = np.zeros(1025)
    for config, n in x.items():
        assert n > 0 and sum(k * a for k, a in config) <= 1024
        for k, a in config:
            held[k] += a * n
    assert (held >= demand - 1e-6).all() and (demand > 0).sum() > 500 and len(x) > 500
    assert demand @ np.arange(1025) / 1024 - 1e-6 <= lower <= sum(x.values()) <= 1.02 * lower
    made, bound = packing.rounded(demand)
    assert bound <= sum(n for _, n in made) <= {"sf0.01": 966, "sf0.1": 9879}[sf]


def test_knapsack_matches_brute_force():
    r = np.random.default_rng(2)
    for _ in range(30):
        value = np.where(r.random(31) < 0.3, r.random(31), 0.0)
        best = [0.0] * 31
        for c in range(1, 31):
            best[c] = max([best[c - 1], *(value[k] + best[c - k] for k in range(1, c + 1))])
        sack = packing.Knapsack(value)
        assert np.allclose(sack.best, best)
        for k in np.flatnonzero(value[1:]) + 1:
            config = sack.around(int(k))
            assert dict(config)[k] >= 1 and sum(n * a for n, a in config) <= 30 and np.isclose(sum(value[n] * a for n, a in config), value[k] + best[30 - k])


@pytest.mark.parametrize("lengths", [(130, 212, 301, 377, 450, 513), (205, 256, 341, 400, 512), (171, 257, 342, 343, 511), (300, 400, 700)])
def test_rounding_stays_near_the_dual_bound(lengths):
    demand = np.bincount(np.random.default_rng(3).choice(lengths, 20_000), minlength=1025)
    made, lower = packing.rounded(demand)
    held = np.zeros(1025, dtype=np.int64)
    for config, times in made:
        assert times > 0 and sum(k * a for k, a in config) <= 1024
        for k, a in config:
            held[k] += a * times
    assert (held == demand).all() and lower <= sum(n for _, n in made) <= lower * 1.001 + len(lengths)


def test_hmm_counts_and_scores(spark):
    rows = [(k, prose(k, 30, 60).upper() if k % 2 else " ".join(f"v{x}" for x in np.random.default_rng(k).integers(0, 60, 30))) for k in range(300)] + [(900, None), (901, ""), (902, "never seen zzz")]
    rows += [rows[0]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = hmm.score(df, top=50, common=70).collect()
    toks = lambda t: (t or "").lower().split()
    train = [toks(t) for k, t in rows if zlib.crc32(str(k).encode()) % 10]
    c = collections.Counter(w for t in train for w in t)
    n, v = sum(c.values()) + len(train), len(c) + 1
    log = lambda x: math.log10((x + 0.1) / (n + 0.1 * (v + 1)))
    text = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        w = toks(text[r.doc_id])
        assert abs(r.base_score - sum(log(c[x]) for x in w) - log(len(train))) < 1e-6
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w) + 1, sum(c[x] > 0 for x in w) + 1, n)
        assert math.isfinite(r.score) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
    held = [r for r in got if r.held_out and r.doc_id < 900]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_forward_is_exact_and_baum_welch_climbs():
    r = np.random.default_rng(2)
    norm = lambda x, a: x / x.sum(axis=a, keepdims=True)
    p = hmm.Params(norm(r.random(3), 0), norm(r.random((3, 3)), 1), norm(r.random((5, 3)), 0))
    docs = [r.integers(0, 5, n) for n in (1, 2, 4, 6, 3)]
    for d, got in zip(docs, hmm.log_likelihood(p, docs), strict=True):
        total = 0.0
        for path in np.ndindex(*[3] * len(d)):
            x = p.start[path[0]] * p.emit[d[0], path[0]]
            for t in range(1, len(d)):
                x *= p.move[path[t - 1], path[t]] * p.emit[d[t], path[t]]
            total += x
        assert abs(np.log(total) - got) < 1e-9
    before = hmm.log_likelihood(p, docs).sum()
    s = hmm.Stats(3, 5)
    s.add(p, docs)
    assert abs(s.log - before) < 1e-9 and abs(s.emit.sum() - sum(map(len, docs))) < 1e-9
    after = hmm.Params(norm(s.start, 0), norm(s.move, 1), norm(s.emit, 0))
    assert hmm.log_likelihood(after, docs).sum() >= before - 1e-9


def test_expected_counts_of_all_partitions_equal_those_of_one_machine(spark):
    r = np.random.default_rng(4)
    norm = lambda x, a: x / x.sum(axis=a, keepdims=True)
    p = hmm.Params(norm(r.random(3), 0), norm(r.random((3, 3)), 1), norm(r.random((6, 3)), 0))
    texts = ["".join(map(str, r.integers(0, 6, n))) for n in r.integers(1, 40, 50)] + ["0"] * 3
    sequence = lambda t: np.array([int(x) for x in t or "5"], dtype=np.int32)
    got = hmm.expected_counts(spark.createDataFrame([(t,) for t in [*texts, None]], "text string").repartition(5), sequence, p)
    want = hmm.Stats(3, 6)
    want.add(p, [sequence(t) for t in [*texts, None]])
    assert np.allclose(got.start, want.start) and np.allclose(got.move, want.move) and np.allclose(got.emit, want.emit)


def test_hmm_odd_rows(odd, nothing):
    assert hmm.score(odd, top=20, common=30).count() == odd.count() and hmm.score(nothing).count() == 0


@pytest.fixture(scope="module")
def rated(spark):
    r, rows, labels = random.Random(5), [], []
    for k in range(600):
        bad = k % 6 == 0
        words = prose(k, r.randrange(5, 80)).split()
        if bad:
            words.insert(r.randrange(len(words)), r.choice(["idiot", "brakkol", "brakkan", "brakkes", "scum"]))
        rows.append((k, " ".join(words)))
        if k % 4:
            labels.append((k, 1, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*labels, (None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")


def test_toxicity_held_out(rated):
    docs, labels = rated
    got = {r.doc_id: r for r in toxicity.classify(docs, labels).collect()}
    held = [r for r in got.values() if r.held_out]
    right = sum((r.doc_id % 6 == 0) == bool(r.predicted) for r in held)
    assert len(held) > 60 and right >= 0.97 * len(held) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_toxicity_odd_rows(odd, nothing, rated):
    labels = rated[1]
    assert toxicity.classify(odd, labels).count() == odd.count() and toxicity.classify(nothing, labels).count() == 0
    bare = {r.doc_id: r.predicted for r in toxicity.classify(odd, labels.limit(0)).collect()}  # no labels: the fixed lists
    assert bare[11] == 1 and bare[0] == 0 and bare[4] == 0
    model = toxicity.train(*rated)
    scored = toxicity.score(odd, model)
    assert scored.columns == [*odd.columns, "score_"]
    assert {r._n for r in scored.collect()} == {2**60 + 1, None}  # other columns stay as they are


def test_label_model_finds_accuracies_and_groups():
    r = np.random.default_rng(1)
    y = r.random(4000) < 0.2
    fire = lambda on, off: np.where(y, r.random(4000) < on, r.random(4000) < off)
    a = fire(0.8, 0.02)
    votes = np.stack([a, a ^ (r.random(4000) < 0.01), fire(0.6, 0.05), fire(0.5, 0.01)], axis=1)
    post, on, weight, groups = toxicity.label_model(votes, np.full(4000, -1))
    assert [0, 1] in groups and weight[0] == 0.5 and ((post > 0.5) == y).mean() > 0.95 and abs(on[0][2] - 0.6) < 0.1


def test_labels_hold_the_classes_among_many_rows_without_one():
    r = np.random.default_rng(2)
    n = 30_000
    y, topic = r.random(n) < 0.1, r.random(n) < 0.3  # voters that follow a topic must not become the class
    fire = lambda of, on, off: np.where(of, r.random(n) < on, r.random(n) < off)
    gold = np.where(r.random(n) < 0.1, y.astype(int), -1)
    votes = np.stack([*(fire(y, 0.4, 0.02) for _ in range(10)), *(fire(topic, 0.5, 0.02) for _ in range(10)), gold == 1, gold == 0], axis=1)
    post, on, _, _ = toxicity.label_model(votes, gold)
    assert (on[0][:10] > 5 * on[1][:10]).all() and (post >= 0.5)[y].mean() > 0.85
    assert ((post >= 0.5) == y)[gold >= 0].mean() > 0.9


def test_pipeline(spark, data, tmp_path):
    import corpus_pipeline as cp

    docs, columns = spark.read.parquet(f"{data}/documents.parquet"), None
    columns = docs.columns
    assert [n for n, _ in cp.STAGES] == ["toxicity", "line dedup", "near duplicates", "source mix", "packing"]
    for k, (_, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, data)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert docs.count() > 0 and (docs.columns == columns or k == 4)


def test_pipeline_stages_against_plain_twins(spark, tmp_path):
    import corpus_pipeline as cp

    from .test_pairs import bag, weighted

    line = prose(900, 14)
    rows = [(k, f"{prose(k, 60)}\n{prose(k + 500, 14)}", "en", f"s{k % 3}", 0) for k in range(40)]
    rows += [(40, f"{prose(40, 60)}\n{line}", "en", "s0", 0), (41, f"{prose(41, 60)}\n{line}", "en", "s1", 0), (42, rows[0][1].split("\n")[0].replace("w1 ", "x "), "en", "s2", 0), (43, "you are an idiot moron", "en", "s0", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, columns in (("documents", docs), ("labels", spark.createDataFrame([], "doc_id long, quality int, toxic int"))):
        columns.write.parquet(str(tmp_path / f"{name}.parquet"))
    stages, text = dict(cp.STAGES), lambda df: {r.doc_id: r.text for r in df.collect()}
    clean = stages["toxicity"](spark, docs, str(tmp_path))
    assert set(text(clean)) == set(range(43))  # without labels the fixed lists judge
    lines = stages["line dedup"](spark, docs, str(tmp_path))
    want = {k: t for k, t, *_ in rows}
    want[41] = prose(41, 60)
    got = text(lines)
    assert {k: got[k] for k in got if k != 42} == {k: want[k] for k in want if k != 42}
    kept = text(stages["near duplicates"](spark, lines, str(tmp_path)))
    bags = {k: bag(t) for k, t in got.items()}
    twins = [(a, b) for a in bags for b in bags if a < b and weighted(bags[a], bags[b]) >= 0.8]
    assert all(b not in kept for _, b in twins) and len(kept) == len(got) - len({b for _, b in twins})
    mixed = stages["source mix"](spark, docs, str(tmp_path)).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in mixed} == {r.doc_id: r.repeats for r in mixing.mix(docs).collect() if r.repeats}
    packed = stages["packing"](spark, docs, str(tmp_path)).collect()
    assert check_packing(packed, {k: t for k, t, *_ in rows}) <= sum(r.length for r in packed) / 1024 + 2


def test_pipeline_stages_take_odd_rows(spark, odd, nothing, data):
    import corpus_pipeline as cp

    for docs in (odd, nothing):
        for _, stage in cp.STAGES[:-1]:
            out = stage(spark, docs, data)
            assert out.columns == odd.columns and (out.count() > 0) == (docs is odd)


def test_counter_loads_no_second_model():
    import subprocess
    import sys

    code = """
import re
from lumenfold.llm.tokens import WordSplitter
held = lambda: sum(map(int, re.findall(r"\\nPss_(?:Anon|Shmem):\\s+(\\d+)", open("/proc/self/smaps_rollup").read())))
splitter = WordSplitter("word_bpe_49k.json")
splitter.full
before = held()
count = splitter.counter()
want = [len(splitter.full.encode(w, add_special_tokens=False)) for w in ("idiot", "ünï", "quxzzy", "12")]
assert count(["idiot", "ünï", "quxzzy"]) == want[:3]
print(held() - before)
"""
    grown = int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout)
    assert grown < 4096, grown  # KB


def test_hmm_passes_read_stored_symbols(spark, monkeypatch):
    docs = spark.createDataFrame([(k, prose(k, 20)) for k in range(60)] + [(60, None), (61, "")], "doc_id long, text string")
    seen, plain = [], hmm.expected_counts

    def watched(rows, sequence, params):
        seen.append((rows.dtypes, sorted(tuple(sequence(r[0])) for r in rows.collect())))
        return plain(rows, sequence, params)

    monkeypatch.setattr(hmm, "expected_counts", watched)
    got = hmm.score(docs, top=20, common=30).collect()
    assert len(got) == 62 and len(seen) == hmm.ROUNDS and all(x == seen[0] for x in seen)
    assert seen[0][0] == [("seq", "binary")]  # no text is split again
    assert sorted(map(len, seen[0][1])) == sorted(r.n_tokens for r in got if not r.held_out)
