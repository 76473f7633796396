"""One best sector and many topics per article, keyword trends and taxonomy counts."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.terms import Profile, among, some, with_scans

# Points of hits, and the least score of a sector or topic.
SECTOR_POINTS = {"title": {"strong": 6, "weak": 3, "generic": 1, "negative": -6}, "body": {"strong": 3, "weak": 1, "generic": 1, "negative": -3}}
TOPIC_POINTS = {"title": {"strong": 4.0, "weak": 2.0, "context": 1.2, "negative": -4.0}, "body": {"strong": 2.0, "weak": 1.0, "context": 0.6, "negative": -2.0}}
QUERY_POINTS, AFFINITY_POINTS, SECTOR_LEAST, TOPIC_LEAST = 0.15, 0.8, 4, 2.8


@dataclass
class Sector:
    name: str
    strong: list[str]
    weak: list[str] = field(default_factory=list)
    generic: list[str] = field(default_factory=list)
    negative: list[str] = field(default_factory=list)


@dataclass
class Adjustment:
    """Points for a sector, for all of the text and for the title, if a term occurs and none of ``unless`` does."""

    sector: str
    terms: list[str]
    total: float
    title: float
    unless: list[str] = field(default_factory=list)


@dataclass
class Topic:
    name: str
    strong: list[str]
    weak: list[str] = field(default_factory=list)
    negative: list[str] = field(default_factory=list)
    title_context: list[str] = field(default_factory=list)
    body_context: list[str] = field(default_factory=list)
    sectors: list[str] = field(default_factory=list)
    least: float = TOPIC_LEAST


@dataclass
class Fallback:
    """A topic appended if a term occurs, in one of the sectors if any are given."""

    topic: str
    terms: list[str]
    sectors: list[str] = field(default_factory=list)


def build_sector(name: str, keywords: list[str], generic: list[str], demote: list[str] = (), strong: list[str] = (), weak: list[str] = (), negative: list[str] = ()) -> Sector:
    """A sector from its configured keywords: generic and demoted ones are weak, the others strong, and more words of each kind join them."""
    firm = list(dict.fromkeys([*(k for k in keywords if k not in generic and k not in demote), *strong]))
    soft = list(dict.fromkeys([*(k for k in keywords if k not in firm), *demote, *weak]))
    return Sector(name, firm, soft, [k for k in soft if k in generic], list(dict.fromkeys(negative)))


def context_points(p: Profile, title: Column, body: Column) -> dict[str, tuple[Column, Column]]:
    """Per sector the points (of all, of the title) that the profile's sector rules give, from its signals in title and body.

    A rule names signals that must hold, or with ! must not, each in both fields together, in the title (@title) or in the body (@body)."""
    fields = {"": (title, body), "title": (title,), "body": (body,)}

    def signal(name: str) -> Column:
        if name.startswith("!"):
            return ~signal(name[1:])
        if name in p.compounds:
            return reduce(or_, [reduce(and_, map(signal, part)) for part in p.compounds[name]])
        name, _, field = name.partition("@")
        seen = lambda terms: reduce(or_, [some(f, terms) for f in fields[field]])
        return seen(p.signals[name]["terms"]) & ~seen(p.signals[name].get("unless", []))

    out: dict[str, tuple[Column, Column]] = {}
    for sector, names, total, head in p.sector_rules:
        holds, (a, b) = reduce(and_, map(signal, names)), out.get(sector, (F.lit(0.0), F.lit(0.0)))
        out[sector] = (a + F.when(holds, float(total)).otherwise(0.0), b + F.when(holds, float(head)).otherwise(0.0))
    return out


def _minus(a: Column, *others: Column) -> Column:
    for b in others:
        a = F.array_except(a, b)
    return a


def sector_scores(s: Sector, title: Column, body: Column) -> Column:
    """struct(title_score, score, hits) from the terms found in both fields; a term counts once per field and, in the body, only if not in the title."""
    t = {k: among(title, getattr(s, k)) for k in SECTOR_POINTS["title"]}
    b = {k: among(body, getattr(s, k)) for k in SECTOR_POINTS["body"]}
    pt, pb = SECTOR_POINTS["title"], SECTOR_POINTS["body"]
    in_title = F.size(t["strong"]) * pt["strong"] + F.size(_minus(t["weak"], t["strong"], t["generic"])) * pt["weak"] + F.size(t["generic"]) * pt["generic"] + F.size(t["negative"]) * pt["negative"]
    in_body = F.size(_minus(b["strong"], t["strong"])) * pb["strong"] + F.size(_minus(b["weak"], t["weak"], b["generic"])) * pb["weak"] + F.size(_minus(b["generic"], t["generic"])) * pb["generic"] + F.size(b["negative"]) * pb["negative"]
    return F.struct(in_title.cast("double").alias("title_score"), (in_title + in_body).cast("double").alias("score"), F.array_distinct(F.concat(t["strong"], t["weak"], b["strong"], b["weak"])).alias("hits"))


def with_found(df: DataFrame, p: Profile, sectors: list[Sector], adjustments: list[Adjustment] = (), topics: list[Topic] = (), fallbacks: list[Fallback] = (), title: str = "title_text", body: str = "body_text", query: str = "query_text") -> DataFrame:
    """Adds title_found, body_found and query_found: the terms of the taxonomy found in each field, scanned once."""
    fields = {Sector: ("strong", "weak", "generic", "negative"), Adjustment: ("terms", "unless"), Topic: ("strong", "weak", "negative", "title_context", "body_context"), Fallback: ("terms",)}
    terms = [t for x in (*sectors, *adjustments, *topics, *fallbacks) for name in fields[type(x)] for t in getattr(x, name)]
    terms += [t for x in p.signals.values() for name in ("terms", "unless") for t in x.get(name, [])]
    return with_scans(df, p, terms, tags=True, title_found=title, body_found=body, query_found=query)


def assign_sector(df: DataFrame, sectors: list[Sector], adjustments: list[Adjustment] = (), misc: str = "misc", profile: Profile | None = None) -> DataFrame:
    """Adds best_sector, sector (misc below the least score), sector_score, sector_title_score and sector_hits, from the terms found.

    The best sector has the greatest (title score, score); the first in the list wins a tie."""
    title, body = F.col("title_found"), F.col("body_found")
    made, context = [], context_points(profile, title, body) if profile else {}
    for k, s in enumerate(sectors):
        raw = sector_scores(s, title, body)
        extra, extra_title = context.get(s.name, (F.lit(0.0), F.lit(0.0)))
        for a in adjustments:
            if a.sector == s.name:
                on = (some(title, a.terms) | some(body, a.terms)) & ~(some(title, a.unless) | some(body, a.unless))
                on_title = some(title, a.terms) & ~some(title, a.unless)
                extra, extra_title = extra + F.when(on, a.total).otherwise(0.0), extra_title + F.when(on_title, a.title).otherwise(0.0)
        made.append(F.struct((raw["title_score"] + extra_title).alias("title_score"), (raw["score"] + extra).alias("score"), F.lit(-k).alias("order"), F.lit(s.name).alias("name"), raw["hits"].alias("hits")))
    out = df.withColumn("_s", F.array_max(F.array(*made)))
    return out.withColumns({"best_sector": F.col("_s.name"), "sector": F.when(F.col("_s.score") >= SECTOR_LEAST, F.col("_s.name")).otherwise(misc), "sector_score": F.col("_s.score"), "sector_title_score": F.col("_s.title_score"), "sector_hits": F.col("_s.hits")}).drop("_s")


def topic_score(t: Topic, title: Column, body: Column, query: Column, sector: Column) -> Column:
    """struct(score, hits) from the terms found in each field."""
    strong = t.strong or t.weak
    ts, bs, tw, bw = among(title, strong), among(body, strong), among(title, t.weak), among(body, t.weak)
    tc, bc = among(title, t.title_context), among(body, t.body_context)
    pt, pb = TOPIC_POINTS["title"], TOPIC_POINTS["body"]
    asked = _minus(F.array_distinct(F.concat(among(query, strong), among(query, t.weak))), ts, bs, tw, bw)
    near = sector.isin(t.sectors) & (F.size(F.concat(ts, tw, tc)) > 0) if t.sectors else F.lit(False)
    score = (F.size(ts) * pt["strong"] + F.size(_minus(bs, ts)) * pb["strong"] + F.size(_minus(tw, ts)) * pt["weak"] + F.size(_minus(bw, tw, bs, ts)) * pb["weak"]
             + F.size(_minus(tc, ts, tw)) * pt["context"] + F.size(_minus(bc, bs, bw)) * pb["context"] + F.when(near, AFFINITY_POINTS).otherwise(0.0) + F.size(asked) * QUERY_POINTS
             + F.size(among(title, t.negative)) * pt["negative"] + F.size(among(body, t.negative)) * pb["negative"])
    return F.struct(score.alias("score"), F.array_distinct(F.concat(ts, tw, bs, bw, tc, bc)).alias("hits"))


def assign_topics(df: DataFrame, topics: list[Topic], fallbacks: list[Fallback] = ()) -> DataFrame:
    """Adds topics and matched_keywords. Scores use best_sector, fallbacks the final sector; only configured topics stay."""
    title, body, query = (F.col(c) for c in ("title_found", "body_found", "query_found"))
    scores = F.array(*[F.struct(F.lit(t.name).alias("name"), F.lit(float(t.least)).alias("least"), topic_score(t, title, body, query, F.col("best_sector")).alias("s")) for t in topics])
    out = df.withColumn("_t", F.filter(scores, lambda x: (x["s"]["score"] >= x["least"] - 1e-9) & (F.size(x["s"]["hits"]) > 0)))
    more = [F.when((some(title, f.terms) | some(body, f.terms)) & (F.col("sector").isin(f.sectors) if f.sectors else F.lit(True)), F.lit(f.topic)) for f in fallbacks]
    names = F.transform("_t", lambda x: x["name"])
    if more:
        names = F.array_union(names, F.array_compact(F.array(*more)))
    names = F.array_intersect(names, F.array(*[F.lit(t.name) for t in topics]))
    words = F.array_distinct(F.concat("sector_hits", F.flatten(F.transform("_t", lambda x: x["s"]["hits"]))))
    return out.withColumns({"topics": names, "matched_keywords": words}).drop("_t")


def keyword_trends(tagged: DataFrame, n: int = 10) -> DataFrame:
    """The n most frequent keywords: (keyword, n_rows, first_seq, first_pos), ties by first appearance."""
    rows = tagged.select("ingest_seq", F.posexplode("matched_keywords").alias("pos", "keyword"))
    first = F.min(F.struct("ingest_seq", "pos"))
    return rows.groupBy("keyword").agg(F.count("*").alias("n_rows"), first.alias("f")).orderBy(F.desc("n_rows"), "f").limit(n).select("keyword", "n_rows")


def taxonomy_counts(tagged: DataFrame) -> DataFrame:
    """(kind, name, n) for sectors and topics in one pass."""
    both = F.concat(F.array(F.struct(F.lit("sector").alias("kind"), F.col("sector").alias("name"))), F.transform("topics", lambda x: F.struct(F.lit("topic").alias("kind"), x.alias("name"))))
    return tagged.select(F.explode(both).alias("x")).groupBy("x.kind", "x.name").agg(F.count("*").alias("n"))


def no_topic(tagged: DataFrame) -> DataFrame:
    n = F.count_if(F.size("topics") == 0)
    return tagged.agg(n.alias("no_topic"), F.count("*").alias("n_rows"), F.coalesce(F.round(F.try_divide(n, F.count("*")), 4), F.lit(0.0)).alias("ratio"))


def newest_per_sector(tagged: DataFrame, n: int = 10) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("sector").orderBy(F.desc("pub_date"), "ingest_seq"))
    return tagged.withColumn("rank", rank).where(F.col("rank") <= n)


# A taxonomy whose terms occur in the synthetic tables.
SYNTHETIC_SECTORS = [
    Sector("german", ["der", "und"], ["die", "das"], ["ung"], ["les"]), Sector("french", ["les", "des"], ["par", "sur"], ["eau"], ["der"]),
    Sector("spanish", ["que", "los"], ["para", "del"], ["ado"], ["les"]), Sector("english", ["the", "of"], ["that", "with"], ["ing"], ["que"]),
]
SYNTHETIC_ADJUSTMENTS = [Adjustment("french", ["dans"], 2.0, 1.0), Adjustment("english", ["license"], 3.0, 2.0, ["der"])]
SYNTHETIC_TOPICS = [
    Topic("legal", ["license"], ["copyright", "rights"], ["###"], ["the"], ["of"], ["english"]), Topic("insult", ["idiot", "moron", "loser"], ["stupid", "trash"], [], [], [], []),
    Topic("article", ["the"], ["der", "les"], ["que"], [], ["of"], ["english", "german"], 3.0), Topic("romance", ["que", "des"], ["los", "par"], ["und"], ["en"], [], ["french", "spanish"]),
]
SYNTHETIC_FALLBACKS = [Fallback("legal", ["clown"]), Fallback("romance", ["une"], ["misc"])]
