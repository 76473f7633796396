"""Quality rules whose thresholds come from the data: quantile sketches per language and source; DataFrame functions only.

A rule is a rate of two counts of a text. Its values are sketched in log-linear buckets (exact below 64, then 32 buckets
a power of two, so a quantile is within 1/32 of its value). A sketch is a table of counts by bucket: sketches merge
by adding counts, in any order, so those of a language and of all documents come from those of the groups, and a hot
group is summed before it is shuffled. A document fails a rule outside the fences that the quartiles of its group give.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

BLANKS, SYMBOLS, WINDOW = " \t\n\x0b\x0c\r", "#*$%&|<>", 5
MIN_WORDS, REPEAT_PERCENT = 10, 20  # the base rule
REACH, MIN_DOCS, MOST_IN_BUCKET = 3, 200, 4  # fences lie REACH spreads beyond the quartiles; a sketch is trusted from MIN_DOCS rows, no bucket above 1/MOST_IN_BUCKET
BROADCAST_GROUPS = 50_000

# name: (counted, of, least spread between quartiles in thousandths, units that a document may lie beyond a fence, lower fence too)
RULES = {
    "word_length": ("word_chars", "n_words", 50, 30, True),
    "symbols": ("n_symbols", "n_words", 10, 5, False),
    "dup_lines": ("n_dup_lines", "n_lines", 50, 2, False),
    "repeats": ("n_repeat_words", "n_words", 50, 10, False),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def let(value: Column, body) -> Column:
    """body(value), with value computed once per row wherever body uses it."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column) -> Column:
    """How many words lie in a window of five words that occurs twice; windows are compared by 64-bit hashes."""
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*[words[i + k] for k in range(WINDOW)]))

    def covered(places: Column) -> Column:
        steps = F.zip_with(places, F.slice(places, 2, F.size(places)), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0), lambda acc, x: acc + x)

    def twice(sorted_: Column) -> Column:
        met = F.zip_with(sorted_, F.slice(sorted_, 2, F.size(sorted_)), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
        return let(F.sort_array(F.array_distinct(F.flatten(met))), covered)

    def count(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(F.sort_array(pairs), twice))

    return F.when(F.size(words) < WINDOW, 0).otherwise(let(hashes, count))


def counts(text: Column) -> Column:
    """The struct of COUNTS of a text; a null text counts as empty. Work and memory are in proportion to the text, but for one sort of its windows."""
    text = F.coalesce(text, F.lit(""))
    bare = lambda c: F.translate(c, BLANKS, "")
    words = F.filter(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: bare(x) != "")
    of_words = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeated_words(w).cast("long").alias("r")))
    of_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("d")))
    return let(F.struct(of_words.alias("w"), of_lines.alias("l")), lambda x: F.struct(
        x["w"]["n"].alias("n_words"), F.length(bare(text)).cast("long").alias("word_chars"), (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        x["l"]["n"].alias("n_lines"), x["l"]["d"].alias("n_dup_lines"), x["w"]["r"].alias("n_repeat_words")))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)


def bucket(v: Column) -> Column:
    """The log-linear bucket of a whole number v >= 0."""
    return let(F.greatest(F.length(F.bin(v)) - 6, F.lit(0)), lambda shift: shift * 32 + F.call_function("shiftright", v, shift).cast("int"))


def middle(b: Column) -> Column:
    """The middle of bucket b."""
    shift = F.greatest(F.floor(b / 32).cast("int") - 1, F.lit(0))
    wide = F.pow(F.lit(2.0), shift)
    return F.floor((b - shift * 32) * wide + F.floor(wide / 2)).cast("long")


def sketch(rows: DataFrame, keys: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """Rows (keys, rule, bucket, n): one sketch per group and rule over all rows for which the rule's rate exists."""
    rate = [F.when(F.col(of) > 0, F.struct(F.lit(name).alias("rule"), bucket(F.floor(F.col(num) * 1000 / F.col(of)).cast("long")).alias("bucket"))) for name, (num, of, *_) in RULES.items()]
    return rows.select(*keys, F.explode(F.array_compact(F.array(*rate))).alias("_x")).groupBy(*keys, "_x.rule", "_x.bucket").agg(F.count("*").alias("n"))


def merged(sketches: DataFrame, *keys: str) -> DataFrame:
    """Sketches of coarser groups: counts added."""
    return sketches.groupBy(*keys, "rule", "bucket").agg(F.sum("n").alias("n"))


def fences(sketches: DataFrame, *keys: str) -> DataFrame:
    """Rows (keys, rule, low, high, trusted), in thousandths, from the sketches of groups by keys."""
    by = Window.partitionBy(*keys, "rule")
    seen = sketches.withColumns({"upto": F.sum("n").over(by.orderBy("bucket")), "total": F.sum("n").over(by)})
    quartile = lambda q: middle(F.min(F.when(F.col("upto") * 4 >= F.col("total") * q, F.col("bucket"))))
    found = seen.groupBy(*keys, "rule").agg(quartile(1).alias("q1"), quartile(3).alias("q3"), ((F.max("total") >= MIN_DOCS) & (F.max("n") * MOST_IN_BUCKET <= F.max("total"))).alias("trusted"))
    least = F.coalesce(*[F.when(F.col("rule") == name, least) for name, (_, _, least, _, _) in RULES.items()])
    reach = F.greatest(F.col("q3") - F.col("q1"), least) * REACH
    return found.select(*keys, "rule", (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"), "trusted")


def _own_or_wider(a: str, b: str) -> list[Column]:
    """The fences of a if trusted, else the wider of those of a and b."""
    pick = lambda side, wider: F.when(F.col(f"{a}.trusted"), F.col(f"{a}.{side}")).otherwise(wider(f"{a}.{side}", f"{b}.{side}")).alias(side)
    return [pick("low", F.least), pick("high", F.greatest)]


def thresholds(scratch: Scratch, rows: DataFrame) -> DataFrame:
    """One row per (lang, source) of rows, with columns low_<rule> and high_<rule> in thousandths.

    A group uses its own fences where its sketch is trusted, else the wider of its own and its language's; a language
    that is not trusted takes the wider of its own and those of all documents. So neither few rows nor many copies of
    one text narrow them.
    """
    fine = scratch.keep(sketch(rows))
    of_lang = merged(fine, "lang")
    group, lang, every = fences(fine, "lang", "source").alias("g"), fences(of_lang, "lang").alias("l"), fences(merged(of_lang)).alias("e")
    lang = lang.join(F.broadcast(every), "rule").select("lang", "rule", *_own_or_wider("l", "e")).alias("l")  # all documents have a row a rule
    both = group.join(lang, (F.col("g.rule") == F.col("l.rule")) & F.col("g.lang").eqNullSafe(F.col("l.lang"))).select("g.lang", "source", "g.rule", *_own_or_wider("g", "l"))
    found = scratch.keep(both.groupBy("lang", "source").agg(*[F.max(F.when(F.col("rule") == r, F.col(side))).alias(f"{side}_{r}") for r in RULES for side in ("low", "high")]))
    scratch.drop(fine)
    return found


def outside() -> Column:
    """The names of the rules that a row with its counts and its group's thresholds fails."""
    fails = []
    for name, (num, of, _, slack, below) in RULES.items():
        over = F.col(num) * 1000 > F.col(f"high_{name}") * F.col(of) + slack * 1000
        under = F.col(num) * 1000 < F.col(f"low_{name}") * F.col(of) - slack * 1000
        fails.append(F.when(over | under if below else over, F.lit(name)))
    return F.array_compact(F.array(*fails))


def _judged(rows: DataFrame, found: DataFrame) -> DataFrame:
    """rows with lang, source and counts, and base_failed, failed (names of rules) and kept. Thresholds are broadcast only if their counted rows are few."""
    side = found.withColumnsRenamed({"lang": "_l", "source": "_s"})
    if found.count() <= BROADCAST_GROUPS:
        side = F.broadcast(side)
    met = rows.join(side, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")), "left")
    return met.withColumns({"base_failed": base_failed(), "failed": outside()}).withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0)).select(*rows.columns, "base_failed", "failed", "kept")


def _counted(docs: DataFrame, *more: Column | str) -> DataFrame:
    return docs.select(*more, F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), counts(F.col("text")).alias("_c")).select("*", "_c.*").drop("_c")


def assess(docs: DataFrame) -> DataFrame:
    """Every document's counts, lang, source, base_failed, failed (the rules it fails) and kept.

    Null and empty texts have no words and fail the base rule; a null language or source is one of its own; repeated
    rows and ties are judged alike, each counted in the sketches; an empty table gives an empty result. Columns of docs
    other than doc_id, text, lang and source are left out.
    """
    scratch = Scratch(docs.sparkSession, "rules")
    rows = scratch.keep(_counted(docs, "doc_id"))
    return _judged(rows, thresholds(scratch, rows))


def kept_rows(docs: DataFrame) -> DataFrame:
    """The documents that ``assess`` keeps, with the columns of docs."""
    scratch = Scratch(docs.sparkSession, "rules")
    rows = scratch.keep(_counted(docs))
    found = thresholds(scratch, rows)
    scratch.drop(rows)
    return _judged(_counted(docs, F.struct(*docs.columns).alias("_row")), found).where("kept").select("_row.*")


_WORD = r"[^\x20\x09-\x0D]"
_BUCKET = "(greatest(length(bin({v})) - 6, 0) * 32 + ({v} >> greatest(length(bin({v})) - 6, 0)))"
_MIDDLE = "((({b}) - 32 * greatest(({b}) // 32 - 1, 0)) * (1 << greatest(({b}) // 32 - 1, 0)) + (1 << greatest(({b}) // 32 - 1, 0)) // 2)"


def _oracle() -> str:
    rates = " UNION ALL ".join(f"SELECT lang, source, '{r}' AS rule, CAST({num} * 1000 // {of} AS BIGINT) AS v FROM c WHERE {of} > 0" for r, (num, of, *_) in RULES.items())
    least = " ".join(f"WHEN '{r}' THEN {x[2]}" for r, x in RULES.items())

    def fence(name: str, keys: str) -> str:
        by = f"PARTITION BY {keys}, rule" if keys else "PARTITION BY rule"
        pre = f"{keys}, " if keys else ""
        return f"""{name}_n AS (SELECT {pre}rule, b, sum(n) AS n FROM h GROUP BY {pre}rule, b),
{name}_c AS (SELECT *, sum(n) OVER ({by} ORDER BY b) AS upto, sum(n) OVER ({by}) AS total FROM {name}_n),
{name}_q AS (SELECT {pre}rule, CAST(min(b) FILTER (upto * 4 >= total) AS BIGINT) AS b1, CAST(min(b) FILTER (upto * 4 >= total * 3) AS BIGINT) AS b3,
  max(total) >= {MIN_DOCS} AND max(n) * {MOST_IN_BUCKET} <= max(total) AS trusted, CASE rule {least} END AS least FROM {name}_c GROUP BY {pre}rule),
{name}_m AS (SELECT *, {_MIDDLE.format(b="b1")} AS q1, {_MIDDLE.format(b="b3")} AS q3 FROM {name}_q),
{name} AS (SELECT {pre}rule, trusted, q1 - {REACH} * greatest(q3 - q1, least) AS low, q3 + {REACH} * greatest(q3 - q1, least) AS high FROM {name}_m)"""

    fails = " OR ".join(f"bool_or(t.rule = '{r}' AND ({num} * 1000 > high * {of} + {slack * 1000}" + (f" OR {num} * 1000 < low * {of} - {slack * 1000}" if below else "") + "))" for r, (num, of, _, slack, below) in RULES.items())
    return f"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, lang, source, text, regexp_extract_all(text, '{_WORD}+') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS l FROM d),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5),
s AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i+4], ' ')) AS times FROM p),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM s, (SELECT unnest(range(5)) AS k) WHERE times > 1 GROUP BY doc_id),
c AS (SELECT w.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN r ON w.doc_id = r.doc_id),
v AS ({rates}),
h AS (SELECT lang, source, rule, {_BUCKET.format(v="v")} AS b, count(*) AS n FROM v GROUP BY ALL),
{fence("g", "lang, source")},
{fence("y", "lang")},
{fence("e", "")},
yl AS (SELECT lang, rule, CASE WHEN y.trusted THEN y.low ELSE least(y.low, e.low) END AS low, CASE WHEN y.trusted THEN y.high ELSE greatest(y.high, e.high) END AS high FROM y JOIN e USING (rule)),
t AS (SELECT g.lang, source, g.rule, CASE WHEN trusted THEN g.low ELSE least(g.low, yl.low) END AS low, CASE WHEN trusted THEN g.high ELSE greatest(g.high, yl.high) END AS high
  FROM g JOIN yl ON g.rule = yl.rule AND g.lang IS NOT DISTINCT FROM yl.lang),
f AS (SELECT doc_id, {fails} AS failed FROM c JOIN t ON c.lang IS NOT DISTINCT FROM t.lang AND c.source IS NOT DISTINCT FROM t.source GROUP BY doc_id),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM c)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(f.failed, false) AS kept FROM b LEFT JOIN f ON b.doc_id = f.doc_id
"""


ORACLE = _oracle()
