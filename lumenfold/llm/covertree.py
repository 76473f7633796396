"""Exact cosine threshold links between embeddings of one label by dual traversal of cover trees.

On unit vectors cosine >= t is distance <= sqrt(2 - 2t). A bounded sample of each label gives the top levels, a tree with
halving radii, grown until a leaf stands for about a chunk of vectors. Every vector goes down to its leaf by the nearest child and the
leaf's radius is that of all its vectors. Leaves are dealt into chunks of bounded size. Pairs of leaves whose covering
radii keep them apart are pruned; each other pair of chunks is one small task, in which trees with halving radii are built over both chunks and traversed
together: a node pair is dropped if too far, taken whole if close enough, and else opened, down to blocks compared
exactly in double precision. Tasks return link counts and spanning edges, never all pairs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, components

THRESHOLD = 0.98
SAMPLE_ROWS = 8192  # of all labels; it shapes the leaves only, every vector is placed and compared
CHUNK, LEAF, FAN, EPS = 2000, 128, 16, 1e-9


@dataclass
class Node:
    center: np.ndarray
    radius: float
    at: np.ndarray
    children: list[Node] = field(default_factory=list)


def distance(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - c) ** 2).sum(axis=-1))


def tree(x: np.ndarray, at: np.ndarray | None = None, leaf: int = LEAF) -> Node:
    """A tree over the rows of x: each node's children cover it with at most half its radius, or, where FAN
    centres cannot, with the radius they reach."""
    at = np.arange(len(x)) if at is None else at
    d = distance(x[at], x[at[0]])
    node = Node(x[at[0]], float(d.max()), at)
    if len(at) <= leaf or node.radius == 0:
        return node
    near, own, centers = d, np.zeros(len(at), dtype=int), [0]
    while len(centers) < FAN and near.max() > node.radius / 2:
        far = int(near.argmax())
        d = distance(x[at], x[at[far]])
        own, near = np.where(d < near, len(centers), own), np.minimum(near, d)
        centers.append(far)
    if len(centers) > 1:
        for k, c in enumerate(centers):
            mine = at[own == k]
            first = np.flatnonzero(mine == at[c])[0]
            mine[[0, first]] = mine[[first, 0]]
            node.children.append(tree(x, mine, leaf))
    return node


def _block_edges(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Components of a bipartite block: the label of each row and column; equal labels are connected, -1 is alone."""
    n, m = hit.shape
    rows, cols = np.arange(n), np.full(m, n + m)
    while True:
        cols_new = np.minimum(cols, np.where(hit, rows[:, None], n + m).min(axis=0))
        rows_new = np.minimum(rows, np.where(hit, cols_new[None, :], n + m).min(axis=1))
        if (cols_new == cols).all() and (rows_new == rows).all():
            break
        rows, cols = rows_new, cols_new
    return np.where(hit.any(axis=1), rows, -1), np.where(hit.any(axis=0), cols, -1)


def dual(x: np.ndarray, y: np.ndarray | None, wx: np.ndarray, wy: np.ndarray | None, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Links between rows of x and rows of y, or among rows of x if y is None.

    Returns the linked weight of each row of x and of each row of y, and spanning edges as arrays of (i, j), rows of
    y numbered after those of x.
    """
    reach, same = float(np.sqrt(2 - 2 * threshold)), y is None
    y, wy, shift = (x, wx, 0) if same else (y, wy, len(x))
    lx, ly, edges = np.zeros(len(x), dtype=np.int64), np.zeros(len(y), dtype=np.int64), []
    a = tree(x)
    todo = [(a, a if same else tree(y))]
    while todo:
        p, q = todo.pop()
        one = same and p is q
        d = 0.0 if one else float(distance(p.center, q.center))
        if d - p.radius - q.radius > reach + EPS:
            continue
        if d + p.radius + q.radius <= reach - EPS:
            if one:
                lx[p.at] += wx[p.at].sum() - wx[p.at]
            else:
                lx[p.at] += wy[q.at].sum()
                ly[q.at] += wx[p.at].sum()
            every = np.concatenate([p.at, q.at + shift])
            edges.append(np.stack([every, np.full(len(every), every[0])], axis=1))
        elif p.children or q.children:
            if one:
                todo += [(c, e) for k, c in enumerate(p.children) for e in p.children[k:]]
            elif p.children and (not q.children or p.radius >= q.radius):
                todo += [(c, q) for c in p.children]
            else:
                todo += [(p, c) for c in q.children]
        else:
            hit = x[p.at] @ y[q.at].T >= threshold
            if one:
                np.fill_diagonal(hit, False)
            if hit.any():
                lx[p.at] += hit @ wy[q.at]
                if not one:
                    ly[q.at] += wx[p.at] @ hit
                r, c = _block_edges(hit)
                for at, lab in ((p.at, r), (q.at + shift, c)):
                    keep = lab >= 0
                    edges.append(np.stack([at[keep], p.at[lab[keep]]], axis=1))
    return (lx + ly, ly, edges) if same else (lx, ly, edges)


def leaves(node: Node) -> list[np.ndarray]:
    """The centres of a tree's leaves, in order."""
    return [c for child in node.children for c in leaves(child)] if node.children else [node.center]


def descend(node: Node, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the leaf, distance from its centre) of each row of x, going to the nearest child at every level."""
    if not node.children:
        return np.zeros(len(x), dtype=np.int64), distance(x, node.center)
    near = (x @ np.array([c.center for c in node.children]).T).argmax(axis=1)
    leaf, dist, first = np.zeros(len(x), dtype=np.int64), np.zeros(len(x)), 0
    for k, child in enumerate(node.children):
        mine = near == k
        n, d = descend(child, x[mine])
        leaf[mine], dist[mine] = n + first, d
        first += len(leaves(child))
    return leaf, dist


def unit_rows(cells) -> tuple[list[int], list[np.ndarray]]:
    """Which embeddings are usable (present, finite, not zero), and their unit vectors in double precision."""
    at, rows = [], []
    for k, e in enumerate(cells):
        if e is None or not len(e):
            continue
        v = np.asarray([np.nan if z is None else z for z in e] if getattr(e, "dtype", None) == object or isinstance(e, list) else e, dtype=np.float64)
        if not np.isfinite(v).all() or not v.any():
            continue
        v = v / np.abs(v).max()
        at.append(k)
        rows.append(v / np.sqrt(v @ v))
    return at, rows


def link(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of (vec_id, embedding, label).

    Rows link if their labels are equal and not null, their lengths agree and their cosine is at least
    ``threshold``. Null, empty and zero vectors and those with null or non-finite components link with nothing.
    Repeated vectors are linked to one another and counted each. A row without links is its own component; a
    null vec_id never names a component with other ids. An empty table gives an empty result.
    """
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession, "cover")
    kind, wide = (vectors.schema[c].dataType.simpleString() for c in ("vec_id", "embedding"))
    rows = vectors.select("vec_id", "embedding", F.concat_ws(":", F.col("label").cast("string"), F.size("embedding").cast("string")).alias("grp"), (F.col("label").isNotNull() & F.col("embedding").isNotNull()).alias("asked"))
    asked = rows.where("asked")
    amounts = {r["grp"]: r["count"] for r in asked.groupBy("grp").count().collect()}  # a row per label and length
    share = min(1.0, SAMPLE_ROWS / max(1, sum(amounts.values())))
    picked = asked.select(F.xxhash64("vec_id", "embedding").alias("h"), "grp", "embedding").where(F.pmod(F.col("h"), F.lit(1 << 20)) < int(share * (1 << 20))).dropDuplicates(["h", "grp"]).toPandas().sort_values("h")
    found: dict[str, Node] = {}
    for grp, part in picked.groupby("grp"):
        _, units = unit_rows(part["embedding"].tolist())
        if units:
            found[grp] = tree(np.array(units), leaf=max(1, len(units) * CHUNK // amounts[grp]))
    shared = spark.sparkContext.broadcast(found)

    def place(batches):
        for pdf in batches:
            at, units = unit_rows(pdf["embedding"].tolist())
            out = pdf[["vec_id", "embedding", "grp"]].iloc[at].reset_index(drop=True)
            cell, dist = np.zeros(len(at), dtype=np.int32), np.full(len(at), 2.0)
            for grp, mine in out.groupby("grp").indices.items():
                if grp in shared.value:
                    cell[mine], dist[mine] = descend(shared.value[grp], np.array([units[k] for k in mine]))
            yield out.assign(cell=cell, dist=dist)

    placed = scratch.keep(asked.mapInPandas(place, f"vec_id {kind}, embedding {wide}, grp string, cell int, dist double").withColumn("node", F.xxhash64("grp", "embedding")))
    nodes = placed.groupBy("node").agg(F.min("grp").alias("grp"), F.min("cell").alias("cell"), F.max("dist").alias("dist"), F.min("embedding").alias("embedding"), F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    nodes = scratch.keep(nodes)
    sizes = nodes.groupBy("grp", "cell").agg(F.count("*").alias("n"), F.max("dist").alias("radius"))
    chunked = scratch.keep(nodes.select("node", "grp", "cell", "embedding", "copies").join(sizes, ["grp", "cell"]).withColumn("chunk", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / CHUNK))).drop("n", "radius"))
    gap_rows = []  # leaves are fewer than the sample's rows
    for g, t in found.items():
        c = np.array(leaves(t))
        a, b = np.triu_indices(len(c), 1)
        gap_rows.append(pa.table({"grp": pa.array([g] * len(a), pa.string()), "cell_a": pa.array(a, pa.int32()), "cell_b": pa.array(b, pa.int32()), "gap": np.concatenate([distance(c[a[k : k + 4096]], c[b[k : k + 4096]]) for k in range(0, max(1, len(a)), 4096)])}))
    gaps = spark.createDataFrame(pa.concat_tables(gap_rows)) if gap_rows else spark.createDataFrame([], "grp string, cell_a int, cell_b int, gap double")
    parts = sizes.select("grp", "cell", "radius", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / CHUNK) - 1)).alias("chunk"))
    left = parts.toDF("grp", "cell_a", "radius_a", "chunk_a")
    right = parts.toDF("grp", "cell_b", "radius_b", "chunk_b")
    reach = float(np.sqrt(2 - 2 * threshold)) + EPS
    once = (F.col("cell_a") < F.col("cell_b")) | ((F.col("cell_a") == F.col("cell_b")) & (F.col("chunk_a") <= F.col("chunk_b")))
    tested = left.join(right, "grp").where(once).join(gaps, ["grp", "cell_a", "cell_b"], "left").where(F.coalesce("gap", F.lit(0.0)) - F.col("radius_a") - F.col("radius_b") <= reach)
    pairs = scratch.keep(tested.select("grp", "cell_a", "chunk_a", "cell_b", "chunk_b"))
    key = F.concat_ws("|", "cell_a", "chunk_a", "cell_b", "chunk_b", "grp").alias("pair")
    ends = pairs.select("grp", F.col("cell_a").alias("cell"), F.col("chunk_a").alias("chunk"), key, F.lit(0).alias("side")).union(
        pairs.where("cell_a <> cell_b or chunk_a <> chunk_b").select("grp", F.col("cell_b").alias("cell"), F.col("chunk_b").alias("chunk"), key, F.lit(1).alias("side")))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        at, units = unit_rows(pdf["embedding"].tolist())
        units, (node, copies, side) = np.array(units), (pdf[c].to_numpy()[at] for c in ("node", "copies", "side"))
        i, j = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(i):
            return pd.DataFrame({"a": [], "b": [], "n": []}, dtype="int64")
        lx, ly, edges = dual(units[i], units[j] if len(j) else None, copies[i], copies[j] if len(j) else None, threshold)
        order = np.concatenate([i, j])
        a, n = node[order], np.concatenate([lx, ly]) if len(j) else lx
        out = [pd.DataFrame({"a": a[n > 0], "b": a[n > 0], "n": n[n > 0]})]
        if edges:
            e = np.unique(np.concatenate(edges), axis=0)
            e = e[e[:, 0] != e[:, 1]]
            out.append(pd.DataFrame({"a": node[order[e[:, 0]]], "b": node[order[e[:, 1]]], "n": 0}))
        return pd.concat(out, ignore_index=True).astype("int64")

    work = chunked.select("grp", "cell", "chunk", "node", "copies", "embedding").join(ends, ["grp", "cell", "chunk"])
    made = scratch.keep(work.groupBy("pair").applyInPandas(compare, "a long, b long, n long"))
    counts = made.where("n > 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    comp = components(scratch, made.where("n = 0").select("a", "b"))
    named = nodes.select("node", "copies", "least").join(counts, "node", "left").join(comp, "node", "left").withColumn("c", F.coalesce("component", "node"))
    ids = named.groupBy("c").agg(F.min("least").alias("component_id"))
    by_node = named.join(ids, "c").select("node", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    used = placed.select("vec_id", "node").join(by_node, "node").select("vec_id", "n_links", "component_id")
    good = F.col("asked") & (F.size("embedding") > 0) & F.forall("embedding", lambda z: z.isNotNull() & ~F.isnan(z) & (F.abs(z) != float("inf"))) & F.exists("embedding", lambda z: z != 0)
    rest = rows.where(~F.coalesce(good, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return used.union(rest).select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
