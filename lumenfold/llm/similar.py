"""Verified links between items that share signature buckets, without emitting all pairs of a bucket."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, components
from .shingles import from_six_bytes, six_bytes

STARS, SLOTS = 8, 1024  # medoids a bucket; bits of the marks of an item
PAIRED = 16  # buckets of so many nodes at most are listed as pairs at once
RANGE_KEYS, CHUNK_KEYS, SKETCH_BITS = 4_000_000, 1_000_000, 1 << 26
U = np.uint64


def mark_rows(owner: np.ndarray, unit: np.ndarray, n: int) -> np.ndarray:
    """Per item a bitmap of SLOTS bits, as a row of longs, of the places its units hash to; owner is in order."""
    out, place = [np.zeros((0, SLOTS // 64), dtype=np.int64)], (unit.view(U) % U(SLOTS)).astype(np.int64)
    for first in range(0, n, 4096):
        a, b = np.searchsorted(owner, [first, first + 4096])
        bits = np.zeros((min(4096, n - first), SLOTS), dtype=bool)
        bits[owner[a:b] - first, place[a:b]] = True
        out.append(np.packbits(bits, axis=1).view(np.int64))
    return np.concatenate(out)


def marks(owner: np.ndarray, unit: np.ndarray, n: int) -> list[np.ndarray]:
    """The rows of ``mark_rows`` as a list."""
    return list(mark_rows(owner, unit, n))


def array_links(pairs: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of the pairs (a, b, ia, ib) whose items, arrays without repeats, are similar."""
    met, total = F.size(F.array_intersect("ia", "ib")), F.size("ia") + F.size("ib")
    return pairs.where(met >= threshold * (total - met) - 1e-9).select("a", "b")


def counted_units(found):
    """Record batches (unit, node, k) of pairs of arrays (node, unit): per chunk each unit once, with the number of its nodes and the least."""

    def out(node, unit):
        order = np.argsort(unit, kind="stable")
        node, unit = node[order], unit[order]
        first = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
        return pa.RecordBatch.from_arrays([pa.array(unit[first]), pa.array(np.minimum.reduceat(node, first)), pa.array(np.diff(np.append(first, len(unit))))], ["unit", "node", "k"])

    held, size = [], 0
    for x in found:
        held.append(x)
        size += len(x[1])
        if size >= CHUNK_KEYS:
            yield out(*map(np.concatenate, zip(*held, strict=True)))
            held, size = [], 0
    if size:
        yield out(*map(np.concatenate, zip(*held, strict=True)))


def array_units(rows: DataFrame) -> DataFrame:
    """(unit, node, k) of the units of all rows, arrays of longs without repeats; a unit has a row per chunk of a task."""

    def run(batches):
        cells = ((b.column("node").to_numpy(), b.column("item")) for b in batches)
        yield from counted_units((np.repeat(node, item.value_lengths().to_numpy()), item.flatten().to_numpy()) for node, item in cells)

    return rows.select("node", "item").mapInArrow(run, "unit long, node long, k long")


def _flat(batch) -> tuple[np.ndarray, np.ndarray]:
    """(node, key) of every band of a batch; bands are six bytes a key."""
    cells = pc.fill_null(batch.column("bands"), b"")
    if not len(cells):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    at = np.frombuffer(cells.buffers()[1], dtype=np.int32)[cells.offset : cells.offset + len(cells) + 1]
    raw = memoryview(cells.buffers()[2] or b"")[at[0] : at[-1]]
    return np.repeat(batch.column("node").to_numpy(), np.diff(at) // 6), from_six_bytes(raw)


def _starts(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, dtype=np.int64)


def _once(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (key, node), in order."""
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    new = np.append(True, (key[1:] != key[:-1]) | (node[1:] != node[:-1]))[: len(key)]
    return key[new], node[new]


def _some_of_each(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, node) in order of keys; a key of more than PAIRED + 1 rows keeps that many distinct nodes, which tell that it has more than PAIRED."""
    order = np.argsort(key)
    key, node = key[order], node[order]
    n = np.diff(np.append(_starts(key), len(key)))
    many = np.repeat(n > PAIRED + 1, n)
    if not many.any():
        return key, node
    k, x = _once(key[many], node[many])
    first = _starts(k)
    some = np.arange(len(k)) - np.repeat(first, np.diff(np.append(first, len(k)))) <= PAIRED
    key, node = np.concatenate([key[~many], k[some]]), np.concatenate([node[~many], x[some]])
    order = np.argsort(key)
    return key[order], node[order]


def bucket_mates(scratch: Scratch, items: DataFrame, n_bands: int) -> tuple[DataFrame, DataFrame | None]:
    """The pairs of nodes of buckets of two to PAIRED nodes, distinct rows (a, b, star), and the distinct (node, bucket) of
    all larger buckets, None if there are none. star: a is the first node of a bucket that holds both.

    A task sorts its keys and sends, per range of keys, packed arrays of keys and nodes, PAIRED + 1 nodes of a key at most. The number of
    ranges follows the number of keys. A range finds its shared keys by one sort, lists the pairs of the smaller buckets, and makes
    a bitmap of the larger ones: all bitmaps together have SKETCH_BITS bits at any size, go to the tasks and let most
    other keys be left out before the exact join with the larger buckets."""
    keys = items.count() * n_bands
    power = min(20, max(6, int(keys // RANGE_KEYS).bit_length()))
    slots = max(8, SKETCH_BITS >> power)

    def packed(node, key):
        key, node = _some_of_each(key, node)
        cut = np.searchsorted(key >> (48 - power), np.arange((1 << power) + 1))
        there = np.flatnonzero(np.diff(cut))
        spans = [slice(cut[r], cut[r + 1]) for r in there]
        blobs = [[six_bytes(key[x]).tobytes() for x in spans], [node[x].tobytes() for x in spans]]
        return pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), *(pa.array(b, pa.binary()) for b in blobs)], ["range", "keys", "nodes"])

    def spread(batches):
        held, size = [], 0
        for b in batches:
            held.append(_flat(b))
            size += len(held[-1][1])
            if size >= CHUNK_KEYS:
                yield packed(*map(np.concatenate, zip(*held, strict=True)))
                held, size = [], 0
        if size:
            yield packed(*map(np.concatenate, zip(*held, strict=True)))

    def shared(part):
        key, node = from_six_bytes(b"".join(part.column("keys").to_pylist())), np.frombuffer(b"".join(part.column("nodes").to_pylist()), dtype=np.int64)
        order = np.argsort(key)
        key, node = key[order], node[order]
        n = np.diff(np.append(_starts(key), len(key)))
        met = np.repeat(n > 1, n)
        key, node = _once(key[met], node[met])
        first = _starts(key)
        n = np.diff(np.append(first, len(key)))
        large = key[first[n > PAIRED]]
        found = [(large, None, None, None)]
        for size in range(2, PAIRED + 1):
            mates, (i, j) = node[first[n == size][:, None] + np.arange(size)], np.triu_indices(size, 1)
            found.append((mates[:, i].ravel(), mates[:, j].ravel(), np.tile(i == 0, len(mates)), None))
        if len(large):
            bits = np.zeros(slots, dtype=bool)
            bits[large % slots] = True
            found.append(([int(key[0] >> (48 - power))], None, None, [np.packbits(bits).tobytes()]))
        return pa.concat_tables(pa.table([pa.nulls(len(x[0]), t) if c is None else pa.array(c, t) for c, t in zip(x, kinds, strict=True)], names=["a", "b", "star", "bits"]) for x in found)

    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
    found = scratch.keep(items.mapInArrow(spread, "range int, keys binary, nodes binary").groupBy("range").applyInArrow(shared, "a long, b long, star boolean, bits binary"))
    pairs = scratch.keep(found.where("b IS NOT NULL").groupBy("a", "b").agg(F.max("star").alias("star")))
    sketch = np.zeros((1 << power, slots // 8), dtype=np.uint8)
    for r in found.where("bits IS NOT NULL").select("a", "bits").collect():  # SKETCH_BITS together, at any size
        sketch[r["a"]] = np.frombuffer(r["bits"], dtype=np.uint8)
    if not sketch.any():
        scratch.drop(found)
        return pairs, None
    known = items.sparkSession.sparkContext.broadcast(sketch)

    def probe(batches):
        for b in batches:
            node, key = _flat(b)
            at = key % slots
            on = (known.value[key >> (48 - power), at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0
            yield pa.RecordBatch.from_arrays([pa.array(node[on]), pa.array(key[on])], ["node", "bucket"])

    some = items.mapInArrow(probe, "node long, bucket long").distinct()
    out = scratch.keep(some.join(found.where("b IS NULL AND bits IS NULL").select(F.col("a").alias("bucket")), "bucket", "left_semi"))
    scratch.drop(found)
    return pairs, out


def further(scratch: Scratch, comp: DataFrame, edges: DataFrame) -> DataFrame:
    """The components (node, component) of comp after more edges (a, b): only the components that those meet are joined anew."""
    name = lambda x: comp.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
    met = edges.join(name("a"), "a", "left").join(name("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    up = components(scratch, met)
    old = comp.join(up.select(F.col("node").alias("component"), F.col("component").alias("up")), "component", "left").select("node", F.coalesce("up", "component").alias("component"))
    return scratch.keep(old.union(up.join(comp, "node", "left_anti").select("node", "component")))


def linked(scratch: Scratch, items: DataFrame, n_bands: int, short: int, sets_of: Callable[[DataFrame], DataFrame], threshold: float, links=array_links, units_of=array_units) -> DataFrame:
    """Rows (node, component) of the items with links: Jaccard similarity >= threshold between bucket mates.

    items: (node long, bands binary, six bytes a band), a row per node or several that agree. sets_of(nodes) gives (node, item,
    size, marks) for the nodes asked for: what is compared, of how many units it is, and the bitmap of their places, of which the first
    part reads ``short`` bits; links and units_of read items. Buckets of at most PAIRED nodes are pairs from the start: those with a bucket's
    first node are compared first, the others where their components differ by then. In larger ones, first every bucket mate is compared with its bucket's heaviest
    node, the one with most bucket mates overall; the links found form components. Next those in another component are compared with STARS nodes
    of the bucket, the heaviest in each of as many hash classes, and components follow again. Then,
    in larger buckets that still hold several components and pairs not tried, nodes outside the component of the bucket's first node
    are compared with nodes of other components in the bucket. Bounds, which lose no link, keep those pairs few:
    sizes must be close; each one's size less the places only it has marked must reach the overlap that the threshold asks of
    the pair; and so must, in the second part, what either node shares with any other node left. So each pair of bucket mates is
    compared, in one component already, or too different by its own units.
    """
    pairs, found = bucket_mates(scratch, items, n_bands)
    asked = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    sets = scratch.keep(sets_of((asked.union(found.select("node")) if found else asked).distinct()))
    # places modulo fewer: every so manyth word of the bitmap taken together
    folded = F.array(*[reduce(lambda x, y: x.bitwiseOR(y), [F.col("marks")[j] for j in range(k, SLOTS // 64, short // 64)]) for k in range(short // 64)])
    only = lambda x, y, n: reduce(lambda a, b: a + b, [F.bit_count(F.col(x)[k].bitwiseAND(F.bitwise_not(F.col(y)[k]))) for k in range(n // 64)])
    enough = lambda most: most * (1 + threshold) >= (F.col("sa") + F.col("sb")) * threshold - 1e-9
    close = lambda n: (F.least("sa", "sb") >= F.greatest("sa", "sb") * threshold - 1e-9) & enough(F.col("sa") - only("ma", "mb", n)) & enough(F.col("sb") - only("mb", "ma", n))

    def verified(pairs: DataFrame) -> DataFrame:
        one = pairs.join(sets.select(F.col("node").alias("a"), F.col("item").alias("ia"), F.col("size").alias("sa"), F.col("marks").alias("ma")), "a")
        both = one.join(sets.select(F.col("node").alias("b"), F.col("item").alias("ib"), F.col("size").alias("sb"), F.col("marks").alias("mb")), "b")
        return links(both.where(close(SLOTS)).select("a", "b", "ia", "ib"), threshold)

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a <> b").distinct()

    tries = pairs.where("star").select("a", "b")
    if found:
        mass = found.join(found.groupBy("bucket").agg(F.count("*").alias("n")), "bucket").groupBy("node").agg(F.sum("n").alias("mass"))
        mates = scratch.keep(found.join(sets.select("node", "size", folded.alias("marks")).join(mass, "node"), "node"))
        scratch.drop(found)
        first = mates.groupBy("bucket").agg(F.max_by(F.struct("node", "size", "marks"), F.struct("mass", F.xxhash64("node"))).alias("r"))
        one = mates.join(first, "bucket").select(F.col("node").alias("x"), F.col("size").alias("sa"), F.col("marks").alias("ma"), F.explode(F.array("r")).alias("r"))
        met = one.select("x", "sa", "ma", F.col("r.node").alias("y"), F.col("r.size").alias("sb"), F.col("r.marks").alias("mb"))
        tries = tries.union(ordered(met.where("x <> y").where(close(short)))).distinct()
    tried_first = scratch.keep(tries) if found else tries
    edges_first = scratch.keep(verified(tried_first))
    comp = components(scratch, edges_first)

    named = lambda x: comp.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
    apart = pairs.where("NOT star").join(named("a"), "a", "left").join(named("b"), "b", "left")
    tries = apart.where(~F.coalesce("ca", "a").eqNullSafe(F.coalesce("cb", "b"))).select("a", "b")
    if not found:
        more = scratch.keep(verified(tries))
        out = further(scratch, comp, more) if not more.isEmpty() else comp
        scratch.drop(pairs, sets, edges_first, more)
        return out

    placed = mates.join(comp, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
    mate = F.struct("node", "size", "marks", "c")
    heavy = [F.max_by(mate, F.when(F.pmod(F.xxhash64("node"), F.lit(STARS)) == k, F.struct("mass", F.xxhash64("node", F.lit(k))))).alias(f"r{k}") for k in range(STARS)]
    stars = placed.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), *heavy).where("lo <> hi").drop("lo", "hi")
    star = placed.join(stars, "bucket").select(F.col("node").alias("x"), F.col("size").alias("sa"), F.col("marks").alias("ma"), F.col("c").alias("cx"), F.explode(F.array_compact(F.array(*[f"r{k}" for k in range(STARS)]))).alias("r"))
    met = star.where(F.col("cx") != F.col("r.c")).select("x", "sa", "ma", F.col("r.node").alias("y"), F.col("r.size").alias("sb"), F.col("r.marks").alias("mb"))
    tried_next = scratch.keep(tries.union(ordered(met.where(close(short)))).distinct().join(tried_first, ["a", "b"], "left_anti"))
    edges_next = scratch.keep(verified(tried_next))
    tried = tried_first.union(tried_next)
    comp = further(scratch, comp, edges_next) if not edges_next.isEmpty() else comp

    named = mates.join(comp, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
    head = F.min_by("c", F.xxhash64("node", F.lit(0)))
    # where all nodes but one at most were medoids, each pair has been tried or is in one component
    medoids = F.expr(f"bit_count(bit_or(shiftleft(1, int(pmod(xxhash64(node), {STARS})))))")
    mixed = named.groupBy("bucket").agg(head.alias("head"), F.min("c").alias("lo"), F.max("c").alias("hi"), (F.count("*") - medoids).alias("others")).where("lo <> hi and others > 1").select("bucket", "head")
    inside = scratch.keep(named.join(mixed, "bucket"))
    # What a node shares with any node left bounds its overlap with each of them: its size less the units that only it has.
    left_sets = scratch.keep(sets.join(inside.select("node").distinct(), "node", "left_semi"))
    alone = units_of(left_sets.select("node", "item")).groupBy("unit").agg(F.sum("k").alias("k"), F.min("node").alias("node")).where("k = 1").groupBy("node").agg(F.count("*").alias("alone"))
    able = left_sets.select("node", "size", "marks").join(alone, "node", "left").select("node", "marks", (F.col("size") - F.coalesce("alone", F.lit(0))).alias("own"), "size").where(F.col("own") >= threshold * F.col("size") - 1e-9).drop("size")
    inside = scratch.keep(inside.drop("marks").join(able, "node"))
    # A node outside the head's component meets the head's component; among themselves the outsiders meet once.
    left = inside.where("c <> head").select("bucket", F.col("node").alias("x"), F.col("size").alias("sa"), F.col("own").alias("oa"), F.col("marks").alias("ma"), F.col("c").alias("cx"))
    right = inside.select("bucket", F.col("node").alias("y"), F.col("size").alias("sb"), F.col("own").alias("ob"), F.col("marks").alias("mb"), F.col("c").alias("cy"), (F.col("c") == F.col("head")).alias("main"))
    rest = left.join(right, "bucket").where(F.col("main") | (F.col("cx") < F.col("cy"))).where(enough(F.least("oa", "ob")) & close(SLOTS))
    more = scratch.keep(verified(ordered(rest).join(tried, ["a", "b"], "left_anti")))
    out = further(scratch, comp, more) if not more.isEmpty() else comp
    scratch.drop(pairs, mates, sets, left_sets, tried_first, tried_next, inside, edges_first, edges_next, more)
    return out
