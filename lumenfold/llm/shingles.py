"""Vectorised hashing of word and character shingles."""

from __future__ import annotations

import hashlib

import numpy as np

U = np.uint64
_M1, _M2, _G = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB), U(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x + _G
    x = (x ^ (x >> U(30))) * _M1
    x = (x ^ (x >> U(27))) * _M2
    return x ^ (x >> U(31))


class WordHash(dict):
    """64-bit hashes of words, kept while fewer than ``limit`` are."""

    limit = 400_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return h


def rolling(x: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n values in a row; len(x) - n + 1 of them."""
    out = np.zeros(len(x) - n + 1, dtype=U)
    for k in range(n):
        out = out * U(0x100000001B3) + x[k : len(x) - n + 1 + k]
    return mix64(out)


def word_shingles(texts: list[list[str]], known: WordHash, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of every shingle of n words; a shorter text with words has one shingle of all of them."""
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    flat = np.fromiter((known[w] for t in texts for w in t), dtype=U, count=int(sizes.sum()))
    owner = np.repeat(np.arange(len(texts)), sizes)
    doc, h = [], []
    if len(flat) >= n:
        whole = owner[: len(flat) - n + 1] == owner[n - 1 :]
        doc.append(owner[: len(flat) - n + 1][whole])
        h.append(rolling(flat, n)[whole])
    ends = np.cumsum(sizes)
    for k in np.flatnonzero((sizes > 0) & (sizes < n)):
        part = flat[ends[k] - sizes[k] : ends[k]]
        doc.append(np.array([k]))
        h.append(rolling(part, len(part)) + U(len(part)))
    if not doc:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U)
    doc, h = np.concatenate(doc), np.concatenate(h)
    return doc, h


def occurrences(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, h, number of times) of the distinct pairs, sorted."""
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    first = np.ones(len(h), dtype=bool)
    first[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(first)
    return doc[at], h[at], np.diff(np.append(at, len(h)))


def units(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One value per occurrence, so that multisets become sets: (doc, value), doc in order."""
    doc, h, times = occurrences(doc, h)
    which = np.repeat(np.arange(len(h)), times)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
    return doc[which], np.where(nth > 0, mix64(h[which] ^ (nth.astype(U) * _G)), h[which])


def six_bytes(x: np.ndarray) -> np.ndarray:
    """The low 48 bits of each 64-bit number, six bytes a row."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8)[:, :6]


def from_six_bytes(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 6)
    return out.view(np.int64).ravel()


def bands(sig: np.ndarray, rows: int) -> np.ndarray:
    """One int64 per band of ``rows`` signature columns; the band number is part of it."""
    n = sig.shape[1] // rows
    out = np.empty((len(sig), n), dtype=U)
    for b in range(n):
        acc = np.full(len(sig), b + 1, dtype=U)
        for r in range(rows):
            acc = mix64(acc ^ sig[:, b * rows + r])
        out[:, b] = acc
    return out.view(np.int64)


def bag_minhash(doc: np.ndarray, h: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """BagMinHash signatures, n_docs x m, of the multisets given by (doc, h) occurrences.

    The weight axis is cut into blocks [0,1), [1,2), [2,4), [4,8) and so on. Every (element, block) carries a
    Poisson process whose rate is m times the block's width; a point falls on one of the m components and at a
    place within the block, and counts only if that place lies below the element's weight. Points come in
    order of time, so a process stops once its time passes the document's largest component. Two documents
    share the first point of a component with the probability of their weighted Jaccard similarity.
    """
    sig = np.full(n_docs * m, np.inf)
    doc, h, times = occurrences(doc, h)
    blocks = [(doc, h, np.zeros(len(h)), np.ones(len(h)), times.astype(float))]
    low = 1
    while len(times) and times.max() > low:
        k = np.flatnonzero(times > low)
        blocks.append((doc[k], mix64(h[k] ^ U(low)), np.full(len(k), float(low)), np.full(len(k), float(low)), times[k].astype(float)))
        low *= 2
    doc, state, start, width, weight = (np.concatenate(x) for x in zip(*blocks, strict=True))
    time, worst = np.zeros(len(doc)), np.full(n_docs, np.inf)
    while len(doc):
        state = mix64(state)
        time = time - np.log(((state >> U(11)).astype(float) + 0.5) * 2.0**-53) / (width * m)
        live = time < worst[doc]
        doc, state, start, width, weight, time = (x[live] for x in (doc, state, start, width, weight, time))
        if not len(doc):
            break
        pick = mix64(state ^ U(0x5851F42D4C957F2D))
        place = start + ((pick >> U(32)).astype(float) * 2.0**-32) * width
        hit = place < weight
        np.minimum.at(sig, doc[hit] * m + ((pick & U(0xFFFFFFFF)) % U(m)).astype(np.int64)[hit], time[hit])
        worst = sig.reshape(n_docs, m).max(axis=1)
    return sig.reshape(n_docs, m).view(U)


def one_permutation(doc: np.ndarray, h: np.ndarray, n_docs: int, bits: int) -> np.ndarray:
    """MinHash signatures, n_docs x 2^bits, by one permutation: the least hash in each of the bins its leading bits choose;
    an empty bin copies a full one, found by the same probes everywhere. Repeated hashes change nothing."""
    sig = np.full(n_docs << bits, 0xFFFFFFFFFFFFFFFF, dtype=U)
    np.minimum.at(sig, (doc << bits) + (h >> U(64 - bits)).astype(np.int64), h)
    sig = sig.reshape(n_docs, 1 << bits)
    return filled(sig, sig != U(0xFFFFFFFFFFFFFFFF))


def filled(sig: np.ndarray, full: np.ndarray) -> np.ndarray:
    """The signatures, their empty bins filled; full tells the others, and a row without any stays."""
    k = sig.shape[1]
    rows = np.flatnonzero(full.any(axis=1) & ~full.all(axis=1))
    columns = np.arange(k, dtype=U)
    r, c = np.nonzero(~full[rows])
    r, probe = rows[r], 0
    while len(r) and probe <= 64 * k:  # each probe is random; a full bin is met long before
        probe += 1
        src = (mix64(columns * U(0x10001) + U(probe)) & U(k - 1)).astype(np.int64)[c]
        met = full[r, src]
        sig[r[met], c[met]] = sig[r[met], src[met]] ^ mix64(np.full(1, probe, dtype=U))
        r, c = r[~met], c[~met]
    return sig


def sliding_minima(texts: list[str], n: int, bits: int) -> np.ndarray:
    """The bins of ``one_permutation`` before empty ones are filled, by 32-bit hashes of the runs of n characters of each text;
    the greatest number stands for an empty bin. Every text has at least n characters."""
    full, sizes = np.uint32(0xFFFFFFFF), np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    m = len(flat) - n + 1
    h = flat[:m] * np.uint32(0x9E3779B1)
    for k in range(1, n):
        h += flat[k : m + k]
        h *= np.uint32(0x01000193)
    for shift, by in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h ^= h >> np.uint32(shift)
        h *= np.uint32(by)
    h ^= h >> np.uint32(16)
    for k in range(1, n):  # runs across two texts
        h[np.cumsum(sizes)[:-1] - k] = full
    at = np.repeat(np.arange(len(texts), dtype=np.int64) << bits, sizes)[:m]
    at += h >> np.uint32(32 - bits)
    sig = np.full(len(texts) << bits, full, dtype=np.uint32)
    np.minimum.at(sig, at, h)
    return sig.reshape(len(texts), 1 << bits)
