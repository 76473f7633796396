"""Every registered article query against its SQL twin; rows only where there is none."""

import math

import pytest

from lumenfold.plans import queries as q

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(data):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def canon(rows, columns):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    tidy = lambda v: round(v, 6) if isinstance(v, float) and math.isfinite(v) else v
    return sorted((tuple(tidy(r[k]) for k in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", [n for n in q.QUERIES if n in q.ORACLE_SQL])
def test_equals_sql(spark, data, duck, name):
    df = q.QUERIES[name](spark, data)
    found = duck.execute(q.ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert canon(df.collect(), df.columns) == canon(found.fetchall(), columns)


@pytest.mark.parametrize("name", [n for n in q.QUERIES if n not in q.ORACLE_SQL])
def test_gives_rows(spark, data, name):
    assert q.QUERIES[name](spark, data).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    out = entry.entry(spark)
    assert out.columns == ["keyword", "n"] and out.count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())


def test_order_of_rows_does_not_matter(spark, data, tmp_path):
    from pyspark.sql import functions as F

    for t in ("documents", "labels", "pages", "events", "orders", "conversations"):
        spark.read.parquet(f"{data}/{t}.parquet").orderBy(F.rand(3)).repartition(3).write.parquet(str(tmp_path / f"{t}.parquet"))
    for name in ("dedup_title_representative", "decision_hybrid", "topic_assignment", "title_pair_jaccard", "event_clusters", "capped_top_10", "extractive_summary"):
        a, b = (canon(q.QUERIES[name](spark, d).collect(), q.QUERIES[name](spark, d).columns) for d in (data, str(tmp_path)))
        assert a == b, name


def test_metrics_record_reads_documents_once(spark, data):
    df = q.QUERIES["metrics_record"](spark, data)
    assert not any("documents" in f for f in df.inputFiles())  # each part reads the table of what was scored and tagged before
    row = df.first()
    sizes, parts = row.sizes[0], {x.sector: x.n for x in row.sectors}
    assert row.decisions[0].input_count == sum(parts.values()) == sizes.clusters and 1 <= sizes.p50 <= sizes.p95 <= sizes.largest
