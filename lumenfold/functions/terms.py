"""Term matching compiled to column expressions: boundary modes, excluded longer words, aliases."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, fields
from pathlib import Path

import yaml
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EDGE = "가-힣a-z0-9"
MANY = 120  # terms from which one automaton is quicker than an expression a term


@dataclass
class Profile:
    """Word lists, weights and rules of one domain; see the profiles below."""

    lists: dict[str, list[str]]
    weights: dict[str, dict[str, int]]
    aliases: dict[str, list[str]] = field(default_factory=dict)
    alias_modes: dict[str, str] = field(default_factory=dict)
    excludes: dict[str, list[str]] = field(default_factory=dict)
    suffixes: list[str] = field(default_factory=list)
    content: dict[str, list[str]] = field(default_factory=dict)
    source: dict[str, list[str]] = field(default_factory=dict)
    source_adjustments: dict[str, float] = field(default_factory=dict)
    special: dict[str, str] = field(default_factory=dict)  # own patterns of short terms
    needs: dict[str, list[str]] = field(default_factory=dict)  # terms that count only beside one of these
    particles: list[str] = field(default_factory=list)
    compact: list[str] = field(default_factory=list)  # terms whose spaced aliases are written together
    extras: list[dict] = field(default_factory=list)  # points of a term beside others: term, beside, without, kind, points
    replacements: list[list[str]] = field(default_factory=list)  # patterns and what tagging reads instead
    tag_modes: dict[str, str] = field(default_factory=dict)
    tag_excludes: dict[str, list[str]] = field(default_factory=dict)
    signals: dict[str, dict] = field(default_factory=dict)
    compounds: dict[str, list[list[str]]] = field(default_factory=dict)
    sector_rules: list[list] = field(default_factory=list)

    def own_pattern(self, term: str, mode: str) -> str:
        """The pattern of a term; short Korean terms may have one of their own."""
        if mode == "korean_short" and term in self.special:
            return self.special[term]
        return pattern(term, mode, self.particles if mode == "korean_particle" else self.suffixes)

    def canonical(self, text: Column) -> Column:
        """The text with the spaced aliases of compact terms written together, the longest first, where they match as aliases."""
        for term in self.compact:
            for alias in sorted(self.aliases.get(term, []), key=len, reverse=True):
                closed, mode = alias.replace(" ", ""), self.alias_modes.get(alias, "phrase")
                text = F.replace(text, F.lit(alias), F.lit(closed)) if mode == "phrase" else F.regexp_replace(text, re.escape(alias) + f"(?={self.own_pattern(alias, mode)[len(re.escape(alias)):]})", closed)
        return text

    def tag_text(self, text: Column) -> Column:
        """The normalised text with spellings replaced, in order."""
        for source, target in self.replacements:
            text = F.regexp_replace(text, source, target)
        return text

    def has(self, text: Column, term: str, mode: str = "auto", excludes: list[str] = ()) -> Column:
        """Whether the normalised text holds the term, outside its excluded longer words, or one of its aliases."""
        term = term.lower()
        view = text
        for word in [*self.excludes.get(term, []), *excludes]:
            # a filler of the same length that is itself an edge character keeps neighbouring boundaries
            view = F.replace(view, F.lit(word), F.lit("힣" * len(word)))
        out = self.matched(view, term, auto_mode(term) if mode == "auto" else mode)
        if beside := self.needs.get(term):
            out = out & self.any(text, beside)
        for alias in self.aliases.get(term, []):
            out = out | self.matched(text, alias, self.alias_modes.get(alias, "phrase"))
        return out

    def matched(self, text: Column, term: str, mode: str) -> Column:
        return F.contains(text, F.lit(term)) if mode == "phrase" else text.rlike(self.own_pattern(term, mode))

    def scan(self, text: Column, terms: list[str], tags: bool = False) -> Column:
        """All of the terms found in the text, in one pass: plain short words by the text's own words, the others one by one.

        For tags, risky words have modes and excluded words of their own."""
        terms, modes, less = list(dict.fromkeys(terms)), self.tag_modes if tags else {}, self.tag_excludes if tags else {}
        plain = [t for t in terms if auto_mode(t) == "english_token" and not any(t in table for table in (self.excludes, self.aliases, modes, less))]
        others = [F.when(self.has(text, t, modes.get(t, "auto"), less.get(t, [])), F.lit(t)) for t in terms if t not in set(plain)]
        words = F.array_intersect(strings(plain), F.regexp_extract_all(text, F.lit("[a-z0-9]+"), F.lit(0)))
        return F.concat(words, F.array_compact(F.array(*others))) if others else words

    def every_term(self) -> list[str]:
        """The terms of all lists and weights."""
        return [t for table in (self.lists, self.weights) for terms in table.values() for t in terms]

    def any(self, text: Column, terms: list[str] | str, mode: str = "auto") -> Column:
        """Whether one of the terms (or of the named list) is found: one alternation per mode, aliases and excludes apart."""
        terms = self.lists[terms] if isinstance(terms, str) else terms
        plain: dict[str, list[str]] = {}
        parts = []
        for t in terms:
            low = t.lower()
            if any(low in table for table in (self.excludes, self.aliases, self.special, self.needs)):
                parts.append(self.has(text, t, mode))
            else:
                plain.setdefault(auto_mode(low) if mode == "auto" else mode, []).append(low)
        parts += [text.rlike("|".join(pattern(t, m, self.suffixes) for t in ts)) for m, ts in plain.items()]
        out = F.lit(False)
        for p in parts:
            out = out | p
        return out


def strings(terms: list[str]) -> Column:
    return F.array(*map(F.lit, terms)).cast("array<string>")


def among(found: Column, terms: list[str]) -> Column:
    """Those of the terms that a scan found, in list order."""
    return F.array_intersect(strings(list(terms)), found)


def some(found: Column, terms: list[str]) -> Column:
    """Whether a scan found one of the terms."""
    return F.arrays_overlap(found, strings(list(terms))) if terms else F.lit(False)


def with_scans(df: DataFrame, p: Profile, terms: list[str], tags: bool = False, **texts: str) -> DataFrame:
    """Adds one array of found terms per text column (new name = text column).

    Long lists go through an automaton. For short ones the arrays come from a generator of one row, so that filters on them are not
    pushed below it and each text is scanned once."""
    if len(set(terms)) > MANY:
        from .lexicon import with_hits

        return with_hits(df, p, terms, tags, **texts)
    return df.select("*", F.inline(F.array(F.struct(*[p.scan(F.col(t), terms, tags).alias(n) for n, t in texts.items()]))))


def auto_mode(term: str) -> str:
    if re.fullmatch("[a-z0-9]{1,4}", term):
        return "english_token"
    return "korean_short" if re.search("[가-힣]", term) and len(term) <= 3 else "phrase"


def pattern(term: str, mode: str, suffixes: list[str] = ()) -> str:
    """The Java pattern of a term in a mode."""
    q = re.escape(term)
    if mode == "phrase":
        return q
    if mode == "english_token":
        return f"(?<![a-z0-9]){q}(?![a-z0-9])"
    if mode in ("token", "korean_short"):
        return f"(?<![{EDGE}]){q}(?![{EDGE}])"
    if mode == "right_token":
        return f"{q}(?![{EDGE}])"
    if mode in ("korean_postposition", "korean_particle"):
        return f"{q}(?:{'|'.join(suffixes)})?(?![{EDGE}])"
    raise ValueError(f"no such mode: {mode}")


def found_by_sql(text: str, term: str) -> str:
    """The same test for engines without lookaround; terms of the synthetic profile only."""
    term = term.lower()
    if auto_mode(term) == "phrase":
        return f"contains({text}, '{term}')"
    return f"regexp_matches({text}, '(^|[^a-z0-9]){re.escape(term)}($|[^a-z0-9])')"


def load_profile(path: str | Path) -> Profile:
    """A profile from a YAML file with weights, aliases, excludes, content, source and word lists."""
    raw = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    raw["suffixes"] = raw.pop("postpositions", [])
    own = [f.name for f in fields(Profile) if f.name != "lists"]
    return Profile({k: v for k, v in raw.items() if k not in own}, **{k: raw[k] for k in own if k in raw})


def ko_finance() -> Profile:
    return load_profile(Path(__file__).with_name("ko_finance.yml"))


# A profile whose terms occur in the synthetic tables.
SYNTHETIC = Profile(
    lists={
        "blocked_domains": ["doc/13", "doc/77"], "sports": ["clown"], "politics": ["idiot", "moron"], "finance": ["the", "der", "les", "que"],
        "lease": ["scum"], "strong": ["license", "para"], "show_strong": ["loser"], "show_weak": ["pathetic", "trash", "stupid", "thsh"],
        "context_strong": ["license", "der"], "risk": ["que", "of", "des"], "capped": ["thsh", "trash"], "enforcement": ["eau", "ung"], "entities": ["les", "des"],
        "domain": ["license", "para", "der"], "generic": ["the", "of", "que"], "corporate_macro": ["des"], "corporate": ["les", "und"], "market_ipo": ["that", "with"],
        "enforcement_always": ["copyright"], "impact_trigger": ["los"], "impact_home": ["del"], "global_macro": ["par"], "global_market": ["sur", "dans"],
        "low_value": ["thsh", "disgusting"], "mood_market": ["this"], "mood": ["worthless"],
    },
    weights={"hard": {"license": 5, "der": 4, "para": 4, "les": 3, "that": 2, "eau": 2}, "soft": {"the": 1, "of": 1, "que": 2, "und": 1, "with": 1}, "negative": {"thsh": 3, "trash": 4, "idiot": 6, "###": 5}},
    content={"opinion": ["pathetic"], "schedule": ["for"], "profile": ["was"], "regulator": ["der", "les"], "action": ["und", "des"], "risk": ["license"], "local_social": ["clown"], "briefing": ["this"], "event": ["stupid"], "pr": ["with"], "price_quote": ["los"], "product": ["que"], "market": ["that"]},
    source={"regulatory": ["license"], "primary_publisher": ["src1"], "primary": ["copyright"], "promo_or_stock_snippet": ["trash"], "press_release_like": ["with"], "low_information": ["was"], "major_finance": ["src2"], "major_general": ["src3"], "specialist": ["src4"], "regional": ["src5"]},
    source_adjustments={"primary": 0.8, "regulatory": 0.8, "major_finance": 0.4, "major_general": 0.2, "specialist": 0.2, "regional": 0.0, "press_release_like": -0.7, "low_information": -0.8, "promo_or_stock_snippet": -1.2, "unknown": -0.3},
)
