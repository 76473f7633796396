"""Readers and writers of the engine's tables and files."""

from __future__ import annotations

import atexit
import uuid
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx

ARTICLE = T.StructType([T.StructField(n, t) for n, t in (
    ("title", T.StringType()), ("description", T.StringType()), ("link", T.StringType()), ("originallink", T.StringType()), ("naver_link", T.StringType()), ("pubDate", T.StringType()), ("query", T.StringType()))])
CANDIDATE_COLUMNS = {
    "any": ["title", "summary", "url"],
    "phase1_debug": ["title", "summary", "url", "score", "decision", "decision_reason"],
    "phase4c_hybrid": ["title", "summary", "url", "score", "decision", "decision_reason", "matched_hard", "matched_negative", "relevance_model_policy"],
}


def checkpoint_root(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir; a local session without it gets one under /tmp."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return found or f"file:///tmp/checkpoints/{spark.sparkContext.applicationId}"


def checkpointed(df: DataFrame) -> DataFrame:
    """df written to the session's checkpoint folder, so that neither later rounds nor lost executors compute it again."""
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))
    return df.checkpoint()


_written: dict[str, SparkSession] = {}


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the session's checkpoint folder, read back. For rounds that each join the last one's result: a checkpoint
    keeps its plan's estimate of size, which such joins square until planning takes longer than the work; a table has its own size."""
    path = f"{checkpoint_root(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    _written[path] = df.sparkSession
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes tables of ``written`` that no later plan reads."""
    for t in tables:
        path = getattr(t, "_written", None)
        if path and (spark := _written.pop(path, None)):
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _forget_all() -> None:
    for path, spark in list(_written.items()):
        try:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        except Exception:  # the session has ended before the interpreter
            return


atexit.register(_forget_all)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Search items as JSON lines, title and description without entities and bold marks; pub_date is parsed, rows without a readable one are
    dropped, times without zone are UTC+9."""
    raw = spark.read.schema(ARTICLE).json(path)
    raw = raw.withColumns({c: F.trim(F.regexp_replace(tx.unescape(F.col(c)), "</?b>", "")) for c in ("title", "description")})
    text = F.regexp_replace("pubDate", "^[A-Za-z]{3},? *", "")
    zoned = F.try_to_timestamp(text, F.lit("d MMM yyyy HH:mm:ss xx"))
    naive = F.to_utc_timestamp(F.try_to_timestamp(text, F.lit("d MMM yyyy HH:mm:ss")), "Asia/Seoul")
    return raw.withColumn("pub_date", F.coalesce(zoned, naive)).where(F.col("pub_date").isNotNull())


def load_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """(kind, name, ordinal, term, pos) from YAML with sectors, topics and fetch lists, or a plain mapping of sectors."""
    raw = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    parts = {k: raw[k] for k in ("sectors", "topics") if isinstance(raw.get(k), dict)} or {"sectors": {k: v for k, v in raw.items() if isinstance(v, list)}}
    fetch = raw.get("fetch_queries") or raw.get("fetch") or []
    groups = fetch.items() if isinstance(fetch, dict) else [("fetch", fetch)]
    rows = [(kind.rstrip("s"), name, k, str(t), p) for kind, table in parts.items() for k, (name, terms) in enumerate(table.items()) for p, t in enumerate(terms or [])]
    rows += [("fetch", name, k, str(t), p) for k, (name, terms) in enumerate(groups) for p, t in enumerate(terms or [])]
    return spark.createDataFrame(rows, "kind string, name string, ordinal int, term string, pos int")


def read_candidates(spark: SparkSession, path: str | list[str], level: str = "any", glob: str = "*.csv") -> DataFrame:
    """Candidate logs (a folder, or listed files) as strings, missing values empty, with report_date from the file name; lacking columns are an error."""
    df = spark.read.option("pathGlobFilter", glob).csv(path, header=True)
    if lacking := [c for c in CANDIDATE_COLUMNS[level] if c not in df.columns]:
        raise ValueError(f"columns missing: {lacking}")
    filled = df.select(*[F.coalesce(c, F.lit("")).alias(c) for c in df.columns], F.try_to_date(F.regexp_extract(F.col("_metadata.file_name"), r"(\d{4}-\d{2}-\d{2})", 1)).alias("report_date"))
    return filled


def write_candidates(decided: DataFrame, path: str, keep_prob: float = 0.65, drop_prob: float = 0.35) -> None:
    """The decision log of 17 columns, partitioned by report_date."""
    prob = F.round("prob", 4)
    flat = decided.select("report_date", "title", F.col("description").alias("summary"), F.col("link").alias("url"), "score", prob.alias("prob"), "keep", "decision", "decision_reason", F.col("score").alias("relevance_score"), prob.alias("relevance_prob"),
                          *[F.array_join(c, ";").alias(c) for c in ("matched_hard", "matched_negative")], "relevance_model_policy", "model_used", F.lit(keep_prob).alias("candidate_keep_prob"), F.lit(drop_prob).alias("candidate_drop_prob"))
    flat.write.mode("overwrite").partitionBy("report_date").option("header", True).csv(path)


def write_json(metrics: DataFrame, path: str) -> None:
    """One row of metrics as JSON."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def write_lines(lines: DataFrame, path: str, *order: str) -> None:
    """A text file of the column ``line`` in order."""
    lines.orderBy(*order).select("line").coalesce(1).write.mode("overwrite").text(path)


CACHE = "version int, entries array<struct<key: string, lines: array<string>, created_at: string>>"


def read_line_cache(spark: SparkSession, path: str, version: int = 3) -> DataFrame:
    """(key, lines, created_at) of the valid entries of a JSON cache of this version."""
    raw = spark.read.schema(CACHE).option("multiLine", True).json(path).where(F.col("version") == version)
    e = raw.select(F.explode("entries").alias("e")).select("e.*")
    return e.where(F.col("key").isNotNull() & (F.size("lines") == 3) & F.forall("lines", lambda x: F.trim(x) != "")).withColumn("created_at", F.try_to_timestamp("created_at"))


def write_line_cache(cache: DataFrame, path: str, version: int = 3, keep: int = 10_000) -> None:
    """The newest ``keep`` entries of (key, lines, created_at, ingest_seq) as one JSON record; the old file stays until the new one is whole."""
    spark = cache.sparkSession
    last = cache.orderBy(F.desc("ingest_seq")).limit(keep)
    entry = F.struct("key", "lines", F.col("created_at").cast("string").alias("created_at"))
    one = last.agg(F.lit(version).alias("version"), F.collect_list(entry).alias("entries"))  # at most ``keep`` entries
    one.coalesce(1).write.mode("overwrite").json(f"{path}.new")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(hadoop(path), True)
    fs.rename(hadoop(f"{path}.new"), hadoop(path))
