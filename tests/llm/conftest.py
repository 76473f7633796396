import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, h int, _row string, rank int, node string, component int, _lines string, _dropped int, _toxicity double, score double, _n long, bands string, bucket int"


def prose(seed, n, words=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, and extra columns whose names the operators use inside."""
    base, line = prose(1, 120), prose(2, 12)
    texts = [base, base, base.replace("w1 ", "w2 "), None, "", " \n\t ", "one", f"{line}\n{prose(3, 30)}", f"{prose(4, 30)}\n{line} x", prose(5, 20_000), "Ünï çödé 日本 <|endoftext|> it's", "idiot scum", base]
    rows = [(k, t, "en", f"src{k % 3}", None, "s", k, "r", 1, "n", 2, "l", 3, 0.5, 0.25, 2**60 + 1, "b", 4) for k, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, "no id here at all", *[None] * 16), (None, None, *[None] * 16)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
