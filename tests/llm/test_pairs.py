"""Near duplicates, fuzzy lines and embedding links against brute force."""

import collections
import random

import numpy as np
import pytest

from lumenfold.llm import covertree, linededup, neardup, shingles
from lumenfold.llm.common import Scratch, components

from .conftest import prose


def bag(text):
    w = (text or "").lower().split()
    return collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else collections.Counter([tuple(w)] if w else [])


def weighted(a, b):
    met = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - met
    return met / total if total else 0.0


def roots(keys, linked):
    up = {k: k for k in keys}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {k: find(k) for k in keys}


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (3, 4), (4, 5), (7, 7), (5, 6)] + [(100, k) for k in range(101, 160)]
    got = {r.node: r.component for r in components(Scratch(spark, "t"), spark.createDataFrame(edges, "a long, b long")).collect()}
    want = roots({x for e in edges for x in e}, edges)
    assert got == {k: v for k, v in want.items() if k != 7}


def test_bag_minhash_is_unbiased():
    rng, off = np.random.default_rng(0), []
    for _ in range(20):
        a = rng.integers(0, 40, 150)
        b = np.concatenate([a[:110], rng.integers(0, 40, 60)])
        doc, h = np.repeat([0, 1], [len(a), len(b)]), shingles.mix64(np.concatenate([a, b]).astype(np.uint64))
        sig = shingles.bag_minhash(doc, h, 2, 512)
        off.append((sig[0] == sig[1]).mean() - weighted(collections.Counter(a.tolist()), collections.Counter(b.tolist())))
    assert abs(np.mean(off)) < 0.012


@pytest.fixture(scope="module")
def copies(spark):
    r, rows = random.Random(4), []
    for g in range(12):
        base = prose(g, 80).split()
        for _ in range(8):
            w = list(base)
            for _ in range(r.randrange(6)):
                w[r.randrange(len(w))] = f"x{r.randrange(999)}"
            rows.append((len(rows), " ".join(w)))
    rows += [(len(rows) + k, "same copy of words here again") for k in range(5)]
    return rows


def test_near_duplicates_match_brute_force(spark, copies):
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(spark.createDataFrame(copies, "doc_id long, text string")).collect()}
    bags = {k: bag(t) for k, t in copies}
    links = [(a, b) for a in bags for b in bags if a < b and weighted(bags[a], bags[b]) >= 0.8]
    assert got == roots(bags, links)


def test_near_duplicates_odd_rows(odd, nothing):
    rows = neardup.near_duplicates(odd).collect()
    assert len(rows) == odd.count() and neardup.near_duplicates(nothing).count() == 0
    by = collections.defaultdict(set)
    for r in rows:
        by[r.doc_id].add(r.class_id)
    assert by[0] == by[1] == by[12] == {0} and by[3] == by[4] == {3} and by[5] == {5}
    kept = neardup.without_near_duplicates(odd)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == odd.columns and ids.count(0) == 1 and 1 not in ids and 12 not in ids and 3 in ids and 4 not in ids


def test_classes_with_the_same_id_or_none_stay_apart(spark):
    rows = [(None, prose(k, 30)) for k in range(3)] + [(7, prose(k, 30)) for k in (3, 4)] + [(None, prose(0, 30)), (7, prose(3, 30)), (9, prose(4, 30))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = neardup.near_duplicates(docs).collect()
    assert len({r.component for r in found}) == 5 and sorted(r.class_size for r in found) == [1, 1, 2, 2, 2, 2, 2, 2]
    assert sorted(r.text for r in neardup.without_near_duplicates(docs).collect()) == sorted(prose(k, 30) for k in range(5))


def test_similar_lines_share_a_band():
    rng, n, total = np.random.default_rng(5), 6000, 50
    h = rng.integers(0, 2**64, (n, total), dtype=np.uint64)
    a, b = h[:, :45], np.hstack([h[:, :40], h[:, 45:]])  # Jaccard similarity 0.8
    doc = np.repeat(np.arange(2 * n), 45)
    found = shingles.bands(shingles.one_permutation(doc, np.concatenate([a.ravel(), b.ravel()]), 2 * n, linededup.BITS), linededup.ROWS)[:, : linededup.BANDS]
    assert (found[:n] == found[n:]).any(axis=1).mean() > 0.993


def test_links_compare_the_strings_themselves(spark):
    r = random.Random(6)
    for letters in ("abcd ", "".join(map(chr, range(0x4E00, 0x4E00 + 6000)))):
        lines = ["".join(r.choice(letters) for _ in range(r.randrange(5, 60) if k % 9 else 900)) for k in range(60)]
        lines += [x[: len(x) // 2] + r.choice(letters) + x[len(x) // 2 + k % 2 :] for k, x in enumerate(lines)]
        sets = [{x[i : i + 5] for i in range(len(x) - 4)} for x in lines]
        pairs = [(a, b, lines[a], lines[b]) for a in range(120) for b in range(a + 1, 120)]
        got = {tuple(x) for x in linededup.line_links(spark.createDataFrame(pairs, "a long, b long, ia string, ib string"), 0.7).collect()}
        assert got == {(a, b) for a, b, _, _ in pairs if len(sets[a] & sets[b]) >= 0.7 * len(sets[a] | sets[b]) - 1e-9} and len(got) > 20


def test_lines_match_brute_force(spark):
    r, rows = random.Random(8), []
    pool = [prose(k + 50, 14) for k in range(15)]
    for k in range(60):
        lines = [prose(1000 + k * 3 + j, 12) for j in range(2)] + [r.choice(pool)]
        if r.random() < 0.5:
            lines[-1] = lines[-1][:-2] + "zz"
        r.shuffle(lines)
        rows.append((k, "\n".join([*lines, "short", ""])))
    got = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    occ = [(k, p, linededup.normal(x)) for k, t in rows for p, x in enumerate(t.split("\n")) if len(linededup.normal(x)) >= linededup.MIN_CHARS]
    sets = {x: {x[i : i + 5] for i in range(len(x) - 4)} for _, _, x in occ}
    links = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    root, seen, keep = roots(sets, links), set(), set()
    for k, p, x in occ:
        if root[x] not in seen:
            seen.add(root[x])
            keep.add((k, p))
    long = {(k, p) for k, p, _ in occ}
    want = ["\n".join(x for p, x in enumerate(t.split("\n")) if (k, p) not in long or (k, p) in keep) for k, t in rows]
    assert [r.text for r in got] == want


def test_lines_odd_rows(odd, nothing):
    out = linededup.dedup_lines(odd)
    rows = out.collect()
    assert out.columns == [*odd.columns, "_lines_", "_dropped_"] and len(rows) == odd.count() and linededup.dedup_lines(nothing).count() == 0
    first = {r.doc_id: r.text for r in rows if r.doc_id is not None}
    assert first[1] == "" and first[12] == "" and first[3] is None and first[0] and first[6] == "one" and first[8].count("\n") == 0
    assert len({r.text for r in rows if r.doc_id == 0}) == 1  # equal rows stay equal


def test_dual_traversal_is_exact():
    rng = np.random.default_rng(1)
    for _ in range(5):
        b = rng.normal(size=(5, 12))
        x, y = ((lambda v: v / np.linalg.norm(v, axis=1, keepdims=True))(b[rng.integers(5, size=n)] + rng.normal(size=(n, 12)) * rng.choice([0.02, 0.08, 0.5], size=(n, 1))) for n in (500, 400))
        wx, wy = rng.integers(1, 4, 500), rng.integers(1, 4, 400)
        hit = x @ y.T >= 0.98
        lx, ly, _ = covertree.dual(x, y, wx, wy)
        assert (lx == hit @ wy).all() and (ly == wx @ hit).all()
        own = x @ x.T >= 0.98
        np.fill_diagonal(own, False)
        assert (covertree.dual(x, None, wx, None)[0] == own @ wx).all()


def test_links_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [2.0, 0.01], 1), (2, [1.0, 0.0], 2), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1), (7, [inf, 1.0], 1), (8, [None, 1.0], 1), (9, [0.0, 1.0], 1), (10, [1.0, 0.0], 1), (11, [], 1), (12, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (9, [0.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = collections.defaultdict(list)
    for r in covertree.link(df).collect():
        got[r.vec_id].append((r.n_links, r.component_id, r.kept))
    assert got[0] == [(3, 0, True)] and got[1] == [(3, 0, False)] and got[10] == [(3, 0, False)] and got[None] == [(3, 0, False)]
    assert all(got[k] == [(0, k, True)] for k in (2, 3, 4, 5, 6, 7, 8, 11, 12)) and got[9] == [(1, 9, True)] * 2
    assert covertree.link(df.limit(0)).count() == 0


def test_links_match_brute_force(spark, data):
    df = spark.read.parquet(f"{data}/embeddings.parquet")
    got = {r.vec_id: r for r in covertree.link(df, 0.3).collect()}
    rows = df.toPandas()
    for _, g in rows.groupby("label"):
        x = np.array(g["embedding"].tolist(), dtype=float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        hit, ids = x @ x.T >= 0.3, g["vec_id"].tolist()
        np.fill_diagonal(hit, False)
        root = roots(ids, [(ids[i], ids[j]) for i, j in zip(*np.nonzero(hit), strict=True)])
        assert all(got[k].n_links == hit[i].sum() and got[k].component_id == root[k] for i, k in enumerate(ids))


def test_links_of_doubles_and_clashing_columns(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0000000001, 0.0]), (2, [1e-46, 0.0]), (3, [1e300, 1e300]), (4, [1.0, 1.0]), (5, [5e-324, 5e-324]), (6, [0.0, 0.0])]
    df = spark.createDataFrame([(k, v, 1, "n", 2, 0.5, "x") for k, v in rows], "vec_id long, embedding array<double>, label int, node string, cell int, dist double, grp string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in covertree.link(df).collect()}
    assert got == {0: (2, 0), 1: (2, 0), 2: (2, 0), 3: (2, 3), 4: (2, 3), 5: (2, 3), 6: (0, 6)}


def test_links_across_leaves_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(covertree, "CHUNK", 40)  # many leaves and chunks on few rows
    r = np.random.default_rng(2)
    base = r.normal(size=(12, 16))
    x = base[r.integers(12, size=500)] + r.normal(size=(500, 16)) * r.choice([0.05, 0.15, 0.6], size=(500, 1))
    x[400:450] = x[0]
    df = spark.createDataFrame([(k, v.tolist(), 7 if k % 3 else 8) for k, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {q.vec_id: q for q in covertree.link(df).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = (u @ u.T >= 0.98) & np.equal.outer(np.arange(500) % 3 > 0, np.arange(500) % 3 > 0)
    np.fill_diagonal(hit, False)
    root = roots(range(500), list(zip(*np.nonzero(hit), strict=True)))
    assert all(got[k].n_links == hit[k].sum() and got[k].component_id == root[k] for k in range(500))


def test_units_of_near_copies_are_counted_before_they_are_sent(spark):
    from lumenfold.llm import similar

    own = {k: [*range(1000, 1060), -k - 1] for k in range(300)}  # 60 units in common, one of each row's own
    lines = {k: f"one very common line of some length {k:04d}" for k in range(300)}
    for units_of, items, kind, want in ((similar.array_units, own, "array<long>", 360), (linededup.line_units, lines, "string", None)):
        rows = spark.createDataFrame(list(items.items()), f"node long, item {kind}").coalesce(2)
        got = units_of(rows).collect()
        sets = {k: set(x) if want else {x[j : j + 5] for j in range(len(x) - 4)} for k, x in items.items()}
        assert sum(r.k for r in got) == sum(map(len, sets.values()))
        assert len(got) <= 2 * len(set().union(*sets.values())) < 0.2 * sum(map(len, sets.values()))
        if want:
            seen = collections.Counter()
            for r in got:
                seen[r.unit] += r.k
            assert len(seen) == want and seen[1000] == 300 and {r.node for r in got if r.unit == -5} == {4}


def test_large_group_of_near_copies_is_compared_about_once_a_row(spark, monkeypatch):
    from lumenfold.llm import linededup as ld

    texts = [f"one very common line of quite some length, seen again and again, copy number {k:04d}" for k in range(400)]
    made, plain = [], ld.line_links

    def watched(pairs, threshold):
        made.append(pairs.count())
        return plain(pairs, threshold)

    monkeypatch.setattr(ld, "line_links", watched)
    got = ld.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted(r.text for r in got) == [""] * 399 + [texts[0]]
    assert sum(made) < 3 * len(texts), made


def test_small_buckets_are_pairs_and_large_ones_are_whole(spark):
    from lumenfold.llm import similar
    from lumenfold.llm.common import Scratch

    groups = {10: [1, 2], 20: [2, 3, 5], 30: list(range(100, 100 + similar.PAIRED)), 40: list(range(200, 201 + similar.PAIRED)), 50: [-7], 60: list(range(300, 600))}
    rows = [(n, k.to_bytes(6, "little")) for k, nodes in groups.items() for n in nodes for _ in range(2)] + [(9, b""), (9, None)]
    items = spark.createDataFrame(rows, "node long, bands binary").repartition(3)
    pairs, found = similar.bucket_mates(Scratch(spark, "test"), items, 1)
    small = [sorted(groups[k]) for k in (10, 20, 30)]
    assert {(r.a, r.b, r.star) for r in pairs.collect()} == {(x, y, x == g[0] or (x, y) == (1, 2)) for g in small for x in g for y in g if x < y}
    assert sorted(tuple(r) for r in found.select("node", "bucket").collect()) == sorted((n, k) for k in (40, 60) for n in groups[k])
    assert similar.bucket_mates(Scratch(spark, "test"), items.where("node < 150"), 1)[1] is None


def test_plain_lines_stay_and_white_space_collapses():
    for line in ("A b", " a b", "a b ", "a  b", "a\tb", "a\u00a0b", "a\u2028b", "a\x1fb", "Ünï \u3000 日本", "", " ", "ΑΣ ΑΣ"):
        assert linededup.normal(line) == " ".join(line.lower().split())


def test_bins_of_lines_are_those_of_each_line_alone():
    lines = [prose(k, 3 + k % 40) for k in range(300)] + ["日本語" * 9, "abcde"]
    found = linededup.line_bands(lines)
    assert found.shape == (302, linededup.BANDS) and all((linededup.line_bands([x]) == found[k]).all() for k, x in enumerate(lines))
    r, n, total = np.random.default_rng(5), 3000, 49
    made = r.integers(97, 97 + 4000, (n, total + 4))
    texts = ["".join(map(chr, x)) for x in made]
    near = [x[:-5] + "".join(map(chr, r.integers(97, 4097, 5))) for x in texts]
    a, b = linededup.line_bands(texts), linededup.line_bands(near)  # 44 of 54 shingles in common: 0.815
    assert (a == b).any(axis=1).mean() > 0.993
