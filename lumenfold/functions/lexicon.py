"""All terms of a profile found in one pass over a text, by an Aho-Corasick automaton of their spellings.

The automaton tells which spellings a text holds at all; only those few terms are then held against their modes, excluded
longer words and companions. So time goes with the text and with what it holds, not with the number of terms.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .terms import Profile, auto_mode

FILLER = "힣"  # stands for excluded words; an edge character, so that neighbouring boundaries stay


class Lexicon:
    """The terms of ``Profile.scan``, in its order; ``hits`` gives the same terms for a text."""

    def __init__(self, profile: Profile, terms: list[str], tags: bool = False):
        self.profile = profile
        modes, less = (profile.tag_modes, profile.tag_excludes) if tags else ({}, {})
        terms = list(dict.fromkeys(terms))
        plain = [t for t in terms if auto_mode(t) == "english_token" and not any(t in table for table in (profile.excludes, profile.aliases, modes, less))]
        self.terms = plain + [t for t in terms if t not in set(plain)]
        self.tests = [self._word(t) if k < len(plain) else self._test(t, modes.get(t, "auto"), less.get(t, [])) for k, t in enumerate(self.terms)]
        self.always, spelled = [], {}
        for k, t in enumerate(self.terms):
            if profile.special.get(t.lower()):
                self.always.append(k)  # its pattern is its own, not its spelling
            else:
                for s in (t.lower(), *profile.aliases.get(t.lower(), [])):
                    spelled.setdefault(s, []).append(k)
        self.automaton = ahocorasick.Automaton()
        for s, numbers in spelled.items():
            self.automaton.add_word(s, tuple(numbers))
        if spelled:
            self.automaton.make_automaton()

    def _word(self, term: str) -> Callable[[str], bool]:
        found = regex.compile(rf"(?<![a-z0-9]){regex.escape(term)}(?![a-z0-9])")
        return lambda text: found.search(text) is not None

    def _matched(self, term: str, mode: str) -> Callable[[str], bool]:
        if mode == "phrase":
            return lambda text: term in text
        found = regex.compile(self.profile.own_pattern(term, mode))
        return lambda text: found.search(text) is not None

    def _test(self, term: str, mode: str = "auto", excludes: list[str] = ()) -> Callable[[str], bool]:
        low = term.lower()
        longer = [*self.profile.excludes.get(low, []), *excludes]
        own = self._matched(low, auto_mode(low) if mode == "auto" else mode)
        beside = [self._test(t) for t in self.profile.needs.get(low, [])]
        others = [self._matched(a, self.profile.alias_modes.get(a, "phrase")) for a in self.profile.aliases.get(low, [])]

        def holds(text: str) -> bool:
            view = text
            for word in longer:
                view = view.replace(word, FILLER * len(word))
            return own(view) and (not beside or any(t(text) for t in beside)) or any(t(text) for t in others)

        return holds

    def hits(self, text: str | None) -> list[str] | None:
        """The terms found in a normalised text; None for None."""
        if text is None:
            return None
        there = set(self.always)
        if len(self.automaton):
            for _, numbers in self.automaton.iter(text):
                there.update(numbers)
        return [self.terms[k] for k in sorted(there) if self.tests[k](text)]


def scanned(profile: Profile, text: Column, terms: list[str], tags: bool = False) -> Column:
    """The column of terms that ``Profile.scan`` gives, by one automaton a task."""

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lexicon = Lexicon(profile, terms, tags)
        for s in texts:
            yield s.map(lexicon.hits, na_action=None)

    return F.pandas_udf(run, "array<string>")(text)


def with_hits(df: DataFrame, profile: Profile, terms: list[str], tags: bool = False, **texts: str) -> DataFrame:
    """Adds one array of found terms per text column (new name = text column)."""
    return df.withColumns({n: scanned(profile, F.col(t), terms, tags) for n, t in texts.items()})
