"""Toxicity by weak supervision: many voters, a generative label model, and a linear classifier on its posteriors.

Voters are fixed word lists, fixed patterns, and words and word beginnings mined from the labelled training
rows. The label model estimates from their votes how often each fires on either class, finds voters that agree
beyond what the class explains and lets such a group count less than the sum of its members. It is fitted to the votes
on all training rows, labelled or not; labels choose the mined voters, vote themselves, and hold their rows near what they say, while all rows without one
weigh no more together than those with one, so that the two classes stay what the labels mean however many rows have none. Its posterior
probabilities train a logistic classifier over words and word beginnings, and only that classifier scores documents.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import Scratch, fresh, id_hash_mod

SAMPLE_ROWS = 24_000  # labelled training rows the voters and the classifier are fitted on, at most
VOTERS, FEATURES = 256, 4096
LENGTHS, MIN_GAIN = (4, 5, 6), 3.5
FLUSH, ROUNDS = 200_000, 10
HELD, BLOCK = 0.98, 512  # how sure a given label is; numbers in a row of partial sums
WORD = re.compile(r"[^\W\d_]+")

# Insults in the four languages, one voter per language.
LEXICONS = {
    "en": "idiot moron stupid loser pathetic worthless disgusting scum trash clown dumb imbecile bastard bitch asshole fuck shit retard whore slut",
    "de": "idiot dummkopf arschloch scheisse scheiße hurensohn trottel abschaum versager miststück wichser",
    "fr": "idiot idiote connard connasse salope merde imbécile abruti ordure enculé débile",
    "es": "idiota imbécil estúpido estúpida mierda puta cabrón pendejo basura escoria asqueroso",
}
# Patterns, one voter each.
PATTERNS = {
    "masked": r"\b[a-z]{1,3}[*@#$]{2,}[a-z]{0,4}\b",
    "shouting": r"!{3,}",
    "kill": r"\b(?:kill|hate|shut up|go to hell)\b",
    "you": r"\byou (?:are|re) (?:an? |so |such )?(?:idiot|moron|stupid|loser|pathetic|worthless|disgusting|scum|trash|clown|dumb)",
}
_SETS = {k: frozenset(v.split()) for k, v in LEXICONS.items()}
_PATTERNS = {k: re.compile(v) for k, v in PATTERNS.items()}
FIXED = [*(f"list:{k}" for k in LEXICONS), *(f"pattern:{k}" for k in PATTERNS)]


def features_of(word: str) -> list[str]:
    """The word, and each of its beginnings marked by an asterisk."""
    return [word, *(word[:n] + "*" for n in LENGTHS if len(word) >= n)]


def fixed_votes(lower: str, words: set[str]) -> list[str]:
    return [f"list:{k}" for k, v in _SETS.items() if not v.isdisjoint(words)] + [f"pattern:{k}" for k, v in _PATTERNS.items() if v.search(lower)]


class Matcher(dict):
    """Which of the given features a word has, remembered per word."""

    limit = 400_000

    def __init__(self, wanted: dict[str, int]):
        super().__init__()
        self.wanted = wanted

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= self.limit:
            self.clear()
        out = self[word] = tuple(self.wanted[f] for f in features_of(word) if f in self.wanted)
        return out

    def of(self, text: str) -> list[int]:
        lower = text.lower()
        words = set(WORD.findall(lower))
        found: set[int] = set()
        for ids in filter(None, map(self.__getitem__, words)):
            found.update(ids)
        found.update(self.wanted[f] for f in fixed_votes(lower, words) if f in self.wanted)
        return sorted(found)


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    voters: list[str]
    accuracy: dict[str, tuple[float, float]]  # how often each voter fires on toxic and on clean rows
    groups: list[list[str]]

    def scorer(self):
        names = list(self.weights)
        match, w = Matcher({f: k for k, f in enumerate(names)}), np.array([self.weights[f] for f in names] or [0.0])

        def score(text: str | None) -> float:
            z = self.bias + sum(w[k] for k in match.of(text if isinstance(text, str) else ""))
            return float(1 / (1 + np.exp(-min(35.0, max(-35.0, z)))))

        return score


@dataclass
class Rates:
    """Parameters of the label model: P(toxic), how often each voter fires on toxic (row 0) and clean rows (row 1), and the share of its evidence that counts."""

    prior: float
    on: np.ndarray
    weight: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        fire, rest = self.weight * np.log(self.on[0] / self.on[1]), self.weight * np.log((1 - self.on[0]) / (1 - self.on[1]))
        z = np.log(self.prior / (1 - self.prior)) + votes @ (fire - rest) + rest.sum()
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def vote_sums(votes: np.ndarray, n: np.ndarray, post: np.ndarray) -> np.ndarray:
    """What the next rates need of rows that occur n times: (rows, toxic mass), then votes and toxic votes per voter."""
    return np.concatenate([[n.sum(), n @ post], n @ votes, (n * post) @ votes])


def rates_of(sums: np.ndarray, weight: np.ndarray) -> Rates:
    (rows, toxic), (cast, hot) = sums[:2], np.split(sums[2:], 2)
    prior = float(np.clip(toxic / max(rows, 1e-9), 1e-3, 1 - 1e-3))
    on = np.stack([(hot + 0.5 * prior) / (toxic + 1), (cast - hot + 0.05) / (rows - toxic + 10)])
    return Rates(prior, np.clip(on, 1e-6, 1 - 1e-6), weight)


def anchored(post: np.ndarray, n: np.ndarray, gold: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """(n, posterior) of rows that occur n times: those with a label (gold 1 or 0, else -1) are held near it, the others count ``share`` each."""
    known = gold >= 0
    return np.where(known, n, share * n), np.where(known, np.where(gold == 1, HELD, 1 - HELD), post)


def share_of(known: float, unknown: float) -> float:
    """What a row without a label counts: all of them no more than all rows with one."""
    return min(1.0, known / unknown) if known and unknown else 1.0


def pair_sums(votes: np.ndarray, n: np.ndarray, post: np.ndarray, rates: Rates) -> np.ndarray:
    """Products of the residuals that the class leaves, and of the votes, of every two voters."""
    post = post[:, None]
    res = votes - (post * rates.on[0] + (1 - post) * rates.on[1])
    return np.stack([(res * n[:, None]).T @ res, (votes * n[:, None]).T @ votes])


def fit_rates(sum_of, pairs_of, start: Rates, rounds: int = 25) -> tuple[Rates, list[list[int]]]:
    """(rates, groups) by expectation maximisation; sum_of(rates) and pairs_of(rates) give the sums over all rows.

    After a first fit, voters whose residuals correlate by more than 0.5, or votes by more than 0.9, form groups, and each
    member's evidence is divided by the size of its group; then the model is fitted again."""
    rates, m = start, len(start.weight)
    groups: list[list[int]] = [[j] for j in range(m)]
    for step in range(2):
        for _ in range(rounds):
            sums = sum_of(rates)
            new = rates_of(sums, rates.weight)
            done, rates = np.abs(new.on - rates.on).max() < 1e-5, new
            if done:
                break
        if step == 0 and m > 1:
            rows, cast = sums[0], sums[2 : 2 + m]
            res, both = pairs_of(rates)
            sd, mean = np.sqrt(np.diag(res) / rows) + 1e-9, cast / rows
            spread = np.sqrt(np.maximum(mean - mean**2, 0)) + 1e-9  # near copies may have made the class their own
            alike = (res / rows / np.outer(sd, sd) > 0.5) | ((both / rows - np.outer(mean, mean)) / np.outer(spread, spread) > 0.9)
            home = np.arange(m)
            for a, b in zip(*np.nonzero(np.triu(alike, 1)), strict=True):
                x, y = home[a], home[b]
                if x != y:
                    home[home == max(x, y)] = min(x, y)
            groups = [np.flatnonzero(home == k).tolist() for k in np.unique(home)]
            weight = np.ones(m)
            for g in groups:
                weight[g] = 1 / len(g)
            rates = Rates(rates.prior, rates.on, weight)
    return rates, groups


def label_model(votes: np.ndarray, gold: np.ndarray, rounds: int = 25) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[int]]]:
    """(posterior, fire[2, voters], weight, groups) of the latent class model over votes (rows x voters, boolean) of one machine.

    gold: 1, 0 or -1 (none) per row; the fit starts from it, and rows that have it stay near it."""
    v, n, share = votes.astype(np.float64), np.ones(len(votes)), share_of((gold >= 0).sum(), (gold < 0).sum())
    start = rates_of(vote_sums(v, *anchored(np.clip(votes.any(axis=1) * 0.6 + 0.05, 0, 1), n, gold, share)), np.ones(votes.shape[1]))
    held = lambda r: anchored(r.posterior(v), n, gold, share)
    rates, groups = fit_rates(lambda r: vote_sums(v, *held(r)), lambda r: pair_sums(v, *held(r), r), start, rounds)
    return rates.posterior(v), rates.on, rates.weight, groups


def dense(lists, m: int) -> np.ndarray:
    """The votes of rows given by the numbers of the voters that fire, as a 0/1 matrix."""
    out = np.zeros((len(lists), m))
    for k, x in enumerate(lists):
        out[k, x] = 1.0
    return out


def logistic(rows: list[np.ndarray], target: np.ndarray, m: int, l2: float = 0.02, steps: int = 1500) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic fit to soft targets; rows hold the indices of the features present."""
    size = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
    col = np.concatenate(rows).astype(np.int64) if size.sum() else np.zeros(0, dtype=np.int64)
    row = np.repeat(np.arange(len(rows)), size)
    w, bias = np.zeros(m), float(np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3)))
    first, second = np.zeros(m + 1), np.zeros(m + 1)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(row, weights=w[col], minlength=len(rows)), -35, 35)))
        err = p - target
        grad = np.append(np.bincount(col, weights=err[row], minlength=m) + l2 * w, err.sum())
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        move = 0.1 * (1 - t / (steps + 1)) * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return w, float(bias)


def train(docs: DataFrame, labels: DataFrame, folds: int = 5) -> Model:
    """A model from the rows whose crc32(doc_id) mod ``folds`` is not 0.

    The label model takes the votes on all of them, summed by pattern. Voters are mined and the classifier is fitted on at most
    SAMPLE_ROWS labelled ones. A document labelled more than once is toxic if one of its labels says so. Without labelled rows of both
    classes the fixed lists and patterns alone make the score.
    """
    scratch = Scratch(docs.sparkSession, "toxic")
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (id_hash_mod("doc_id", folds) != 0)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = scratch.keep(known.withColumn("h", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))))
    share = min(1.0, 0.98 * SAMPLE_ROWS / max(1, known.count()))
    chosen = known.where(F.col("h") < int(share * (1 << 20))).select("doc_id", "toxic")
    # SAMPLE_ROWS bounds this side
    sample = scratch.keep(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", (F.col("toxic") > 0).cast("int").alias("y")))

    def tally(batches):
        seen: dict[str, list[int]] = {}

        def out():
            return pd.DataFrame({"f": pd.Series(list(seen), dtype="object"), "pos": pd.Series([x[1] for x in seen.values()], dtype="int64"), "neg": pd.Series([x[0] for x in seen.values()], dtype="int64")})

        for pdf in batches:
            for text, y in zip(pdf["text"], pdf["y"], strict=True):
                words = set(WORD.findall(text.lower())) if isinstance(text, str) else set()
                for f in {f for w in words for f in features_of(w)}:
                    seen.setdefault(f, [0, 0])[y] += 1
                if len(seen) >= FLUSH:
                    yield out()
                    seen.clear()
        yield out()

    totals = sample.agg(F.sum("y"), F.sum(1 - F.col("y"))).first()
    n1, n0 = int(totals[0] or 0), int(totals[1] or 0)
    if not n1 or not n0:
        return Model({f: 4.0 if f.startswith("list") or f == "pattern:you" else 1.0 for f in FIXED}, -2.5, FIXED, {}, [[f] for f in FIXED])
    counts = sample.mapInPandas(tally, "f string, pos long, neg long").groupBy("f").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).where("pos + neg >= 3")
    lift = F.log((F.col("pos") + 0.2) / (n1 + 0.4)) - F.log((F.col("neg") + 0.2) / (n0 + 0.4))
    gain = F.abs(lift) * F.sqrt(F.col("pos") + F.col("neg"))
    top = counts.withColumn("lift", lift).withColumn("gain", gain).where(F.col("gain") >= MIN_GAIN).orderBy(F.desc("gain"), "f").limit(FEATURES).collect()
    mined = [r["f"] for r in top if r["lift"] > 1.5][:VOTERS]
    voters = [*FIXED, *mined]
    names = [*dict.fromkeys([*(r["f"] for r in top), *mined, *FIXED])]
    index = {f: k for k, f in enumerate(names)}
    wanted = sample.sparkSession.sparkContext.broadcast(index)

    def present(batches):
        match = Matcher(wanted.value)
        for pdf in batches:
            yield pd.DataFrame({"y": pdf["y"], "on": [match.of(t) if isinstance(t, str) else [] for t in pdf["text"]]})

    rows = sample.mapInPandas(present, "y int, on array<int>").toPandas()
    on = [np.asarray(x, dtype=np.int64) for x in rows["on"]]
    place = np.full(len(names), -1)
    place[[index[f] for f in voters]] = np.arange(len(voters))
    m = len(voters) + 2  # a given label is a voter too: one fires where it says toxic, one where it says clean
    said = lambda y: [] if y is None else [m - 2] if y > 0 else [m - 1]
    cast = docs.sparkSession.sparkContext.broadcast({f: k for k, f in enumerate(voters)})

    def vote(batches):
        match = Matcher(cast.value)
        for batch in batches:
            rows = zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([(match.of(t) if t else []) + said(y) for t, y in rows], pa.list_(pa.int32()))], ["votes"])

    training = docs.where(id_hash_mod("doc_id", folds) != 0).select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left").select("text", "toxic")
    patterns = scratch.keep(training.mapInArrow(vote, "votes array<int>").groupBy("votes").agg(F.count("*").alias("n")))

    def summed(of, size: int) -> np.ndarray:
        """The sum over all rows of of(votes, n, gold), an array of ``size`` numbers whatever the rows are; a task sends it in blocks."""

        def part(batches):
            total = np.zeros(size)
            for b in batches:
                at, n = b.column("votes").to_pylist(), b.column("n").to_numpy().astype(float)
                for k in range(0, len(at), 4000):
                    votes = dense(at[k : k + 4000], m)
                    total += of(votes, n[k : k + 4000], np.where(votes[:, m - 2] > 0, 1, np.where(votes[:, m - 1] > 0, 0, -1))).ravel()
            blocks = {k: total[k : k + BLOCK] for k in range(0, size, BLOCK)}
            blocks = {k: x for k, x in blocks.items() if x.any()}
            yield pa.RecordBatch.from_arrays([pa.array(blocks.keys(), pa.int64()), pa.array([x.tobytes() for x in blocks.values()], pa.binary())], ["at", "x"])

        def add(rows):
            x = sum(np.frombuffer(c.as_py()) for c in rows.column("x"))
            return pa.table({"at": rows.column("at").slice(0, 1), "x": pa.array([x.tobytes()], pa.binary())})

        out = np.zeros(size)
        for r in patterns.mapInArrow(part, "at long, x binary").groupBy("at").applyInArrow(add, "at long, x binary").collect():
            x = np.frombuffer(r["x"])
            out[r["at"] : r["at"] + len(x)] = x
        return out

    gold = rows["y"].to_numpy()
    share = share_of(len(gold), int(patterns.agg(F.sum("n")).first()[0]) - len(gold))
    seen = dense([[*(p := place[x])[p >= 0], *said(y)] for x, y in zip(on, gold.tolist(), strict=True)], m)
    start = rates_of(vote_sums(seen, np.ones(len(seen)), np.where(gold == 1, HELD, 1 - HELD)), np.ones(m))
    votes_of = lambda r: summed(lambda v, n, y: vote_sums(v, *anchored(r.posterior(v), n, y, share)), 2 + 2 * m)
    pairs_of = lambda r: summed(lambda v, n, y: pair_sums(v, *anchored(r.posterior(v), n, y, share), r), 2 * m * m).reshape(2, m, m)
    rates, groups = fit_rates(votes_of, pairs_of, start, ROUNDS)
    w, bias = logistic(on, rates.posterior(seen), len(names))
    every = [*voters, "label:toxic", "label:clean"]
    scratch.drop(known, sample, patterns)
    return Model({f: float(x) for f, x in zip(names, w, strict=True) if abs(x) > 1e-4}, bias, every, {f: (float(a), float(b)) for f, a, b in zip(every, *rates.on, strict=True)}, [[every[j] for j in g] for g in groups])


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """All rows and columns of docs and, last, their score, 0 to 1, named ``name`` (with underscores added where docs has that name).
    Null texts score as empty ones; the whole text counts."""
    shared, name = docs.sparkSession.sparkContext.broadcast(model), fresh(docs, name)
    names = [*docs.columns, name]

    def run(batches):
        of = shared.value.scorer()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([of(t.as_py()) for t in batch.column("text")], pa.float64())], names)

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs. An empty table gives an empty result."""
    model = train(docs, labels, folds)
    out = score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (id_hash_mod("doc_id", folds) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
