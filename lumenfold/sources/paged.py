"""Search results in pages as a Spark data source: ``spark.read.format("paged_search")``.

A service answers a query page by page, newest rows first. The source reads each query in a partition of its own and ends a
query as soon as no later page can hold a row of the window asked for, which filters on ``pub_date`` tell it: they and those
on ``query`` are pushed down, and need not be judged again. Pages come from recorded answers in a folder, one folder per query
and page (``query=<name>/start=<n>/``, as ``record`` writes them), on any file system that the executors reach.
"""

from __future__ import annotations

import datetime as dt
import html
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from email.utils import parsedate_to_datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

SCHEMA = "title string, description string, link string, originallink string, portal_link string, pub_date timestamp, query string, start int"
DISPLAY, MAX_PAGES, LAST_START = 100, 5, 1000  # Fixed values: rows a page, pages a query, and the last place a page may start at.
UTC, NAIVE = dt.timezone.utc, dt.timezone(dt.timedelta(hours=9))
TICK = dt.timedelta(microseconds=1)


def parse_date(text: str | None) -> dt.datetime | None:
    """A mail date in UTC; without a zone it is UTC+9; None where unreadable."""
    try:
        found = parsedate_to_datetime(text or "")
    except (TypeError, ValueError):
        return None
    return found.replace(tzinfo=found.tzinfo or NAIVE).astimezone(UTC)


def clean(text: str | None) -> str:
    return html.unescape(re.sub("</?b>", "", text or "")).strip()


def starts(display: int, max_pages: int) -> range:
    """Where the pages of a query start."""
    return range(1, min(LAST_START, (max_pages - 1) * display + 1) + 1, display)


def item_row(item: dict, when: dt.datetime, query: str, start: int) -> tuple:
    """An answer's item as a row; its link is the publisher's, else the portal's."""
    own, portal = ((item.get(k) or "").strip() or None for k in ("originallink", "link"))
    return clean(item.get("title")), clean(item.get("description")), own or portal or "", own, portal, when, query, start


def scan(pages, query: str, since: dt.datetime | None, until: dt.datetime | None, display: int = DISPLAY, max_pages: int = MAX_PAGES) -> Iterator[tuple]:
    """Rows of a query with since <= pub_date < until. ``pages(start)`` gives a page's items, none where there is no page.

    Ends at an empty page, after a page with fewer than ``display`` items, and after a page whose oldest row precedes the window."""
    for start in starts(display, max_pages):
        items = pages(start)
        dated = [(when, item) for item in items for when in [parse_date(item.get("pubDate"))] if when is not None]
        for when, item in dated:
            if (since is None or when >= since) and (until is None or when < until):
                yield item_row(item, when, query, start)
        if len(items) < display or dated and since is not None and min(when for when, _ in dated) < since:
            return


@dataclass
class Query(InputPartition):
    name: str
    folder: str


class Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.display, self.max_pages = options["path"].rstrip("/"), int(options.get("display", DISPLAY)), int(options.get("max_pages", MAX_PAGES))
        if not 0 < self.display <= LAST_START or self.max_pages < 1:
            raise ValueError("display must be from 1 to 1000, max_pages at least 1")
        self.queries = json.loads(options["queries"]) if options.get("queries") else None
        self.since = self.until = None

    def pushFilters(self, filters):
        for f in filters:
            if f.attribute == ("pub_date",) and isinstance(f, GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual):
                at = f.value if f.value.tzinfo else f.value.astimezone()
                at = at.astimezone(UTC) + (TICK if isinstance(f, GreaterThan | LessThanOrEqual) else 0 * TICK)
                if isinstance(f, GreaterThan | GreaterThanOrEqual):
                    self.since = max(at, self.since or at)
                else:
                    self.until = min(at, self.until or at)
            elif f.attribute == ("query",) and isinstance(f, EqualTo | In):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.queries = sorted(wanted if self.queries is None else wanted & set(self.queries))
            else:
                yield f

    def _folder(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path.removeprefix("file:"))

    def partitions(self):
        from pyarrow import fs

        at, root = self._folder()
        folders = [i.base_name for i in at.get_file_info(fs.FileSelector(root)) if i.type == fs.FileType.Directory and i.base_name.startswith("query=")]
        there = {unquote(f.removeprefix("query=")): f for f in sorted(folders)}
        return [Query(q, f"{root}/{there[q]}") for q in (there if self.queries is None else dict.fromkeys(self.queries)) if q in there]

    def read(self, partition):
        from pyarrow import fs

        if partition is None:  # there are no queries
            return iter(())
        at, _ = self._folder()

        def pages(start: int) -> list[dict]:
            folder = fs.FileSelector(f"{partition.folder}/start={start}", allow_not_found=True)
            out: list[dict] = []
            for info in sorted(at.get_file_info(folder), key=lambda i: i.path):
                if info.type == fs.FileType.File and not info.base_name.startswith(("_", ".")):
                    with at.open_input_stream(info.path) as f:
                        out += [item for line in f.read().decode().splitlines() if line.strip() for item in json.loads(line).get("items", [])]
            return out

        return scan(pages, partition.name, self.since, self.until, self.display, self.max_pages)


class PagedSearch(DataSource):
    """Options: path (recorded answers), display, max_pages, queries (a JSON list; all in the folder if absent)."""

    @classmethod
    def name(cls) -> str:
        return "paged_search"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options)


def register(spark: SparkSession) -> None:
    """Makes the format known to the session and lets it take filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedSearch)


def search(spark: SparkSession, path: str, start, end, queries: list[str] | None = None, display: int = DISPLAY, max_pages: int = MAX_PAGES) -> DataFrame:
    """Rows of all queries (or those given) with start <= pub_date < end."""
    register(spark)
    source = spark.read.format("paged_search").option("path", path).option("display", display).option("max_pages", max_pages)
    if queries is not None:
        source = source.option("queries", json.dumps(queries))
    return source.load().where((F.col("pub_date") >= F.lit(start)) & (F.col("pub_date") < F.lit(end)))


def record(items: DataFrame, path: str, display: int = DISPLAY, *tie: str) -> None:
    """Writes items (query, pub_date, title, description, link, originallink) as a service's answers: per query the newest
    first, ``display`` a page, each page one JSON record in a folder of its own. Only pages that a query can ask for are kept."""
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("pub_date"), *tie)) - 1
    item = F.struct("title", "description", "link", "originallink", F.concat(F.date_format(F.to_utc_timestamp("pub_date", F.current_timezone()), "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000")).alias("pubDate"))
    paged = items.withColumn("place", place).where(F.col("place") < starts(display, LAST_START)[-1] - 1 + display)
    start = (F.floor(F.col("place") / display) * display + 1).cast("int")
    pages = paged.groupBy("query", start.alias("start")).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", item.alias("item")))), lambda x: x["item"]).alias("items"))  # at most ``display`` items
    (pages.select("query", "start", F.to_json(F.struct("items")).alias("value")).repartition("query", "start").write.mode("overwrite").partitionBy("query", "start").text(path))
