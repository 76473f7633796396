"""Fuzzy line deduplication: MinHash of character shingles, banding, exact Jaccard, union-find."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, fresh
from .shingles import U, bands, filled, rolling, six_bytes, sliding_minima
from .similar import SLOTS, counted_units, linked, mark_rows

SHINGLE, THRESHOLD, MIN_CHARS = 5, 0.8, 20
ROWS, BANDS, BITS, SHORT = 6, 21, 7, 256
SKETCH, SKETCH_PART = 1 << 26, 1 << 20
SEEN = 300_000
GROUP_CHARS, GROUP_LINES, SKETCHED = 50_000, 20_000, 8192


def normal(line: str) -> str:
    """The form in which lines are compared: lower case, white space as single blanks."""
    line = line.lower()
    if line.isprintable() and "  " not in line and not line.startswith(" ") and not line.endswith(" "):  # no white space but single blanks inside
        return line
    return " ".join(line.split())


def shingles(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(line number, hash) of the five-character shingles of each line; every line has at least five characters."""
    sizes = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    flat = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(U)
    owner = np.repeat(np.arange(len(lines)), sizes)
    n = len(flat) - SHINGLE + 1
    whole = owner[:n] == owner[SHINGLE - 1 :]
    return owner[:n][whole], rolling(flat, SHINGLE)[whole]


def _groups(lines: list[str]):
    first, size = 0, 0
    for k, x in enumerate(lines):
        size += len(x)
        if size >= GROUP_CHARS or k - first + 1 >= GROUP_LINES:
            yield lines[first : k + 1]
            first, size = k + 1, 0
    if first < len(lines):
        yield lines[first:]


def _line_node(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _lines(texts, min_chars: int):
    """(row, position, normalised line) of the lines long enough."""
    for k, text in enumerate(texts):
        for p, raw in enumerate(text.split("\n") if isinstance(text, str) else ()):
            if len(raw) >= min_chars and len(line := normal(raw)) >= min_chars:
                yield k, p, line


def line_bands(lines: list[str]) -> np.ndarray:
    """The keys of the bands of lines of at least SHINGLE characters, a row a line."""
    out = [np.zeros((0, BANDS), dtype=np.int64)]
    for first in range(0, len(lines), SKETCHED):
        sig = np.concatenate([sliding_minima(part, SHINGLE, BITS) for part in _groups(lines[first : first + SKETCHED])])
        out.append(bands(filled(sig.astype(U), sig != np.uint32(0xFFFFFFFF)), ROWS)[:, :BANDS])
    return np.concatenate(out)


def scan_of(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, tnode, pos, node, bands binary) of every line of at least ``min_chars`` characters when normalised.

    bands is null where the task has just seen the line; several tasks may give one line's bands, which are the same."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            at, pos, node, fresh, new = [], [], [], [], []
            for k, p, line in _lines(batch.column("text").to_pylist(), min_chars):
                n = _line_node(line)
                at.append(k)
                pos.append(p)
                node.append(n)
                fresh.append(n not in seen)
                if fresh[-1]:
                    seen.add(n)
                    new.append(line)
            if len(seen) > SEEN:
                seen.clear()
            if not at:
                continue
            flat, mask = six_bytes(line_bands(new)).tobytes(), np.array(fresh)
            ends = np.concatenate([[0], np.cumsum(mask) * 6 * BANDS]).astype(np.int32)
            keys = pa.Array.from_buffers(pa.binary(), len(at), [pa.array(mask).buffers()[1], pa.py_buffer(ends.tobytes()), pa.py_buffer(flat)])
            rows_at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(rows_at), batch.column("tnode").take(rows_at), pa.array(pos, pa.int32()), pa.array(node, pa.int64()), keys], ["doc_id", "tnode", "pos", "node", "bands"])

    return docs.mapInArrow(run, f"doc_id {kind}, tnode long, pos int, node long, bands binary")


def sets_of(docs: DataFrame, asked: DataFrame, min_chars: int) -> DataFrame:
    """(node, item, size, marks) of the lines asked for: the normalised line, how many distinct shingles it has and where they hash to.

    A sketch of fixed size, one bit per residue of a node, goes to the tasks and lets most other lines be left out early; the
    join takes exactly those asked for."""

    def packed(part):
        bits = np.zeros(SKETCH_PART, dtype=bool)
        place = part.column("place").to_numpy()
        bits[place % SKETCH_PART] = True
        return pa.table({"part": [int(place[0]) // SKETCH_PART], "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    place = F.pmod(F.col("node"), F.lit(SKETCH)).cast("int")
    known = bytearray(SKETCH // 8)
    for r in asked.select(place.alias("place")).groupBy(F.floor(F.col("place") / SKETCH_PART)).applyInArrow(packed, "part long, bits binary").collect():  # SKETCH bits together, at any size
        known[r["part"] * SKETCH_PART // 8 : (r["part"] + 1) * SKETCH_PART // 8] = r["bits"]
    sketch = docs.sparkSession.sparkContext.broadcast(bytes(known))

    def run(batches):
        on, seen = sketch.value, set()
        for batch in batches:
            new: dict[int, str] = {}
            for _, _, line in _lines(batch.column("text").to_pylist(), min_chars):
                n = _line_node(line)
                if on[n % SKETCH >> 3] >> (n & 7) & 1 and n not in seen:
                    seen.add(n)
                    new[n] = line
            if len(seen) > SEEN:
                seen.clear()
            first, nodes, lines = 0, pa.array(new, pa.int64()), list(new.values())
            for part in _groups(lines):
                at, h = shingles_once(part)
                bits = mark_rows(at, h, len(part)).ravel()
                ends = pa.array(np.arange(len(part) + 1, dtype=np.int32) * (SLOTS // 64))
                yield pa.RecordBatch.from_arrays([nodes.slice(first, len(part)), pa.array(part, pa.string()), pa.array(np.bincount(at, minlength=len(part)), pa.int64()), pa.ListArray.from_arrays(ends, pa.array(bits))], ["node", "item", "size", "marks"])
                first += len(part)

    found = docs.select("text").mapInArrow(run, "node long, item string, size long, marks array<long>").join(asked, "node", "left_semi")
    return found.groupBy("node").agg(F.min("item").alias("item"), F.min("size").alias("size"), F.min("marks").alias("marks"))


def shingles_once(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(line number, 48-bit hash) of the distinct shingles of each of at most GROUP_LINES lines, in order; they feed bounds only."""
    doc, h = shingles(lines)
    key = np.sort((doc.astype(U) << U(48)) | (h >> U(16)))
    key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
    return (key >> U(48)).astype(np.int64), key & U((1 << 48) - 1)


def grams(line: str) -> np.ndarray | frozenset[str]:
    """The distinct shingles of a line as numbers, in order: 12 bits a character, so they are the strings themselves; the strings if a character needs more."""
    x = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    if not len(x) or x.max() >= 4096:
        return wide_grams(line)
    n = len(x) - SHINGLE + 1
    code = x[:n].copy()
    for k in range(1, SHINGLE):
        code <<= 12
        code |= x[k : n + k]
    code.sort()
    return code[np.append(True, code[1:] != code[:-1])[: len(code)]]


def wide_grams(line: str) -> frozenset[str]:
    """The distinct shingles of a line, the strings themselves."""
    return frozenset([line[k : k + SHINGLE] for k in range(len(line) - SHINGLE + 1)])


def line_links(pairs: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of the pairs of lines whose sets of shingles, the strings themselves, reach the threshold.

    Pairs of one line mostly come one after the other, so the last set of either side is kept, and no more."""

    def run(batches):
        for pdf in batches:
            keep, known = [], [("", frozenset()), ("", frozenset())]
            for pair in zip(pdf["ia"], pdf["ib"], strict=True):
                known = [k if k[0] == line else (line, grams(line)) for k, line in zip(known, pair, strict=True)]
                x, y = known[0][1], known[1][1]
                if type(x) is not type(y):
                    x, y = map(wide_grams, pair)
                if isinstance(x, frozenset):
                    met = len(x & y)
                else:
                    both = np.concatenate([x, y])
                    both.sort()
                    met = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(met >= threshold * (len(x) + len(y) - met) - 1e-9)
            yield pdf.loc[keep, ["a", "b"]] if len(pdf) else pdf[["a", "b"]]

    return pairs.mapInPandas(run, "a long, b long")


def line_units(rows: DataFrame) -> DataFrame:
    """(unit, node, k) of the shingles of all lines; see ``array_units``."""

    def found(batches):
        for b in batches:
            first, nodes = 0, b.column("node").to_numpy()
            for part in _groups(b.column("item").to_pylist()):
                at, h = shingles_once(part)
                yield nodes[first + at], h.view(np.int64)
                first += len(part)

    return rows.mapInArrow(lambda batches: counted_units(found(batches)), "unit long, node long, k long")


def dropped_lines(docs: DataFrame, threshold: float = THRESHOLD, min_chars: int = MIN_CHARS) -> DataFrame:
    """Rows (doc_id, tnode, drop array<int>): the positions of lines to leave out of the text hashed to tnode.

    Lines are compared in lower case with white space collapsed. Two lines are linked if equal, or if the
    Jaccard similarity of their sets of five-character shingles is at least ``threshold``. Of each component one
    line stays: the first by doc_id (null last), text hash and position. Lines shorter than ``min_chars`` are
    never dropped. Equal rows (same id and text) count as one document and keep the same lines.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    base = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tnode"))
    scan = scratch.keep(scan_of(base, min_chars))
    comp = linked(scratch, scan.where("bands IS NOT NULL").select("node", "bands"), BANDS, SHORT, lambda asked: sets_of(base, asked, min_chars), threshold, line_links, line_units)
    places = scratch.keep(scan.drop("bands").join(comp, "node", "left").select("doc_id", "tnode", "pos", F.coalesce("component", "node").alias("c")))
    spot = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tnode", "pos")
    many = scratch.keep(places.join(places.groupBy("c").agg(F.count("*").alias("n")).where("n > 1").select("c"), "c"))
    first = many.groupBy("c").agg(F.min(spot).alias("keep"))
    extra = many.join(first, "c").where(~((F.col("tnode") == F.col("keep.tnode")) & (F.col("pos") == F.col("keep.pos")) & F.col("doc_id").eqNullSafe(F.col("keep.doc_id"))))
    return scratch.keep(extra.groupBy("doc_id", "tnode").agg(F.collect_set("pos").alias("drop")))


def dedup_lines(docs: DataFrame, threshold: float = THRESHOLD, min_chars: int = MIN_CHARS) -> DataFrame:
    """All rows and columns of docs, the text without dropped lines (n_chars, where there is one, follows), and
    ``_lines`` and ``_dropped`` (with underscores added where docs has such names): how many lines the text had and lost. Null texts stay null, a text whose lines all go is empty."""
    names = docs.columns
    gone = dropped_lines(docs, threshold, min_chars).select(F.col("doc_id").alias("_d"), F.col("tnode").alias("_t"), "drop")
    rows = docs.select(F.struct(*names).alias("_row"), F.col("doc_id").alias("_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_node"))
    met = rows.join(gone.hint("shuffle_hash"), (F.col("_node") == F.col("_t")) & F.col("_id").eqNullSafe(F.col("_d")), "left")
    parts = F.split("_row.text", "\n", -1)
    left = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains("drop", i)), "\n")
    out = met.select("_row", F.when(F.col("drop").isNull(), F.col("_row.text")).otherwise(left).alias("_text"), F.when(F.col("_row.text").isNull(), F.lit(0)).otherwise(F.size(parts)).cast("long").alias("_lines"), F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("_dropped"))
    new = {"text": F.col("_text"), "n_chars": F.length("_text").cast("long")}
    return out.select(*[(new[c] if c in new else F.col("_row")[c]).alias(c) for c in names], *[F.col(c).alias(fresh(docs, c)) for c in ("_lines", "_dropped")])
