"""The automaton of terms against the expressions it stands for."""

import random
import time

import pytest
from pyspark.sql import functions as F

from lumenfold.functions.lexicon import Lexicon, with_hits
from lumenfold.functions.terms import SYNTHETIC, Profile, ko_finance


@pytest.mark.parametrize("tags", [False, True])
def test_automaton_finds_what_the_expressions_find(spark, tags):
    r = random.Random(11 + tags)
    for profile in (ko_finance(), SYNTHETIC):
        terms = list(dict.fromkeys([*profile.every_term(), *profile.aliases, *profile.tag_modes]))
        pieces = [t.lower() for t in terms] + [x for table in (profile.aliases, profile.excludes, profile.needs, profile.tag_excludes) for v in table.values() for x in v]
        pieces += ["은", "은행가", "x", "1", "의", "들", " ", " ", " ", "a"]
        texts = ["".join(r.choice(pieces) + r.choice(["", " ", " ", "은 ", "s"]) for _ in range(r.randrange(14))) for _ in range(250)] + ["", *(t.lower() for t in terms)]
        df = spark.createDataFrame(list(enumerate(texts)), "k long, t string").repartition(4)
        some = r.sample(terms, min(60, len(terms)))
        want = {x.k: x.x for x in df.select("k", profile.scan(F.col("t"), some, tags).alias("x")).collect()}
        got = {x.k: x.x for x in with_hits(df, profile, some, tags, x="t").collect()}
        assert got == want and sum(map(bool, want.values())) > 50
        assert Lexicon(profile, terms, tags).hits(None) is None


def test_time_does_not_follow_the_terms():
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8))
    text, took = " ".join(word() for _ in range(20_000)), {}
    for n in (50, 500):
        lexicon = Lexicon(Profile({}, {}), [word() for _ in range(n)])
        times = []
        for _ in range(5):
            began = time.perf_counter()
            lexicon.hits(text)
            times.append(time.perf_counter() - began)
        took[n] = min(times)
    assert took[500] < 3 * took[50]
