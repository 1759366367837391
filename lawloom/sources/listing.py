"""Directory listings: parsing landed pages, and fetching them with a Python data source.

`anchors` reads a page tag by tag as a parser does (quotes, comments, character references);
`hrefs` is a pattern without Python, for quoted targets outside of comments.
"""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .staging import opened

log = logging.getLogger(__name__)

HREF = r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""


def hrefs(html: Column) -> Column:
    """The targets of all anchors, in order."""
    return F.regexp_extract_all(html, F.lit(HREF), F.lit(1))


class _Anchors(HTMLParser):
    """The targets of a page's anchors, in order."""

    def __init__(self, html: str):
        super().__init__()
        self.found: list[str] = []
        self.feed(html)
        self.close()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "a":
            self.found += [v for k, v in attrs if k == "href" and v is not None][:1]


@F.pandas_udf(T.ArrayType(T.StringType()))
def anchors(html: pd.Series) -> pd.Series:
    """The targets of all anchors as a parser finds them: unquoted ones too, none in comments or
    scripts, character references resolved.  A page of null has none."""
    return html.map(lambda page: _Anchors(page).found if page is not None else [])


def listed_files(pages: DataFrame, html: str = "html", suffix: str = ".pdf") -> DataFrame:
    """Names of the files with the suffix (case counts), in order of the page, with repeats."""
    rows = pages.select(F.explode(anchors(F.col(html))).alias("href")).where(F.col("href").endswith(suffix))
    name = F.element_at(F.split("href", "/"), -1)
    return rows.select(F.substr(name, F.lit(1), F.length(name) - len(suffix)).alias("filename"))


def listed_sessions(pages: DataFrame, html: str = "html") -> DataFrame:
    """Sessions named by numeric last parts of the links, latest first (as text)."""
    rows = pages.select(F.explode(anchors(F.col(html))).alias("href"))
    rows = rows.select(F.element_at(F.split(F.regexp_replace("href", "/+$", ""), "/"), -1).alias("session"))
    return rows.where(F.col("session").rlike(r"^\d+$")).distinct().orderBy(F.desc("session"))


def timed_out(e: Exception) -> bool:
    """A read that timed out, or a connection that did, which urllib wraps."""
    return isinstance(e, TimeoutError) or isinstance(getattr(e, "reason", None), TimeoutError)


def fetched(url: str, timeout: float = 10.0, attempts: int = 3, least: float = 2.0, most: float = 30.0, get=None, sleep=time.sleep) -> bytes:
    """GET with retries on timeouts alone, waiting 2 to 30 seconds, longer each time; an HTTP
    error is raised at once, unlike with Spark's own task retries."""
    import urllib.request

    get = get or (lambda u: urllib.request.urlopen(u, timeout=timeout).read())
    for k in range(attempts):
        try:
            return get(url)
        except OSError as e:
            if not timed_out(e) or k + 1 == attempts:
                raise
            sleep(min(most, max(least, 2.0**k)))
    raise ValueError("attempts must be positive")


def lanes(urls: list[str], per_host: int) -> list[list[str]]:
    """The URLs dealt out so that no host is asked by more than `per_host` lanes."""
    by_host: dict[str, list[str]] = {}
    for u in urls:
        by_host.setdefault(urlsplit(u).netloc, []).append(u)
    return [us[k::per_host] for us in by_host.values() for k in range(min(per_host, len(us)))]


class UrlPartition(InputPartition):
    def __init__(self, urls: list[str]):
        super().__init__(None)
        self.urls = urls


class UrlReader(DataSourceReader):
    """Deals URLs to `workers` tasks; a failed one becomes a row with its error."""

    def __init__(self, options: dict[str, str]):
        self.urls = [u for u in options.get("urls", "").split("\n") if u]
        self.workers = int(options.get("workers", "8"))
        self.timeout = float(options.get("timeout", "10"))

    def partitions(self) -> list[InputPartition]:
        return [UrlPartition(self.urls[k :: self.workers]) for k in range(min(self.workers, len(self.urls)))]

    def read(self, partition: UrlPartition) -> Iterator[tuple]:
        return answers(partition.urls, self.timeout)


def answers(urls: list[str], timeout: float, delay: float = 0.0) -> Iterator[tuple]:
    """(url, content, error) of each URL; one bad item must not end the session."""
    for k, url in enumerate(urls):
        if k and delay:
            time.sleep(delay)
        try:
            yield url, fetched(url, timeout), None
        except Exception as e:
            yield url, None, f"{type(e).__name__}: {e}"


class UrlStreamReader(DataSourceStreamReader):
    """A listing as a stream.  An offset is a position in it; a batch takes `budget` URLs more,
    shared by all hosts, and asks a host by at most `per_host` tasks, each of which waits `delay`
    seconds between requests.

    Spark asks for the latest offset without saying where it stands, so after a restart the
    position is read from the query's own checkpoint: the last planned batch is either done or
    comes again first.
    """

    def __init__(self, options: dict[str, str]):
        self.urls = [u for u in options.get("urls", "").split("\n") if u]
        self.budget, self.per_host = int(options.get("budget", "100")), int(options.get("per_host", "2"))
        self.timeout, self.delay = float(options.get("timeout", "10")), float(options.get("delay", "0"))
        self.at = self.planned(options.get("checkpoint", ""))

    @staticmethod
    def planned(checkpoint: str) -> int:
        """The end of the last batch in a checkpoint, or 0."""
        if not checkpoint:
            return 0
        store, top = opened(checkpoint)
        files = store.get_file_info(fs.FileSelector(f"{top}/offsets", allow_not_found=True))
        batches = [int(f.base_name) for f in files if f.base_name.isdigit()]
        if not batches:
            return 0
        with store.open_input_stream(f"{top}/offsets/{max(batches)}") as f:
            return json.loads(f.read().decode().rstrip("\n").rpartition("\n")[2])["at"]

    def initialOffset(self) -> dict:
        return {"at": 0}

    def latestOffset(self) -> dict:
        self.at = min(self.at + self.budget, len(self.urls))
        return {"at": self.at}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [UrlPartition(us) for us in lanes(self.urls[start["at"] : end["at"]], self.per_host)]

    def read(self, partition: UrlPartition) -> Iterator[tuple]:
        return answers(partition.urls, self.timeout, self.delay)

    def commit(self, end: dict) -> None:
        pass


class UrlSource(DataSource):
    """spark.dataSource.register(UrlSource); spark.read.format("urls").option("urls", ...).load(),
    or readStream with the options of `UrlStreamReader`."""

    @classmethod
    def name(cls) -> str:
        return "urls"

    ROW = "url string, content binary, error string"

    def schema(self) -> str:
        return self.ROW

    def reader(self, schema) -> DataSourceReader:
        return UrlReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return UrlStreamReader(self.options)


def land(spark: SparkSession, urls: list[str], folder: str, budget: int = 100, per_host: int = 2, delay: float = 0.0, timeout: float = 10.0) -> DataFrame:
    """Fetch a listing into folder/files and return its rows (url, content, error).

    A run that was killed is carried on by the next one with the same listing: batches that had
    been landed aren't fetched again.  The sink's own log keeps the files of each batch, so a
    batch that comes again counts once.
    """
    spark.dataSource.register(UrlSource)
    mark, place = f"{folder.rstrip('/')}/checkpoint", f"{folder.rstrip('/')}/files"
    options = {"urls": "\n".join(urls), "budget": budget, "per_host": per_host, "delay": delay, "timeout": timeout, "checkpoint": mark}
    stream = spark.readStream.format("urls").options(**options).load()
    query = stream.writeStream.format("parquet").option("checkpointLocation", mark).start(place)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.read.schema(UrlSource.ROW).parquet(place)


# --------------------------------------------------------------------------- crawling


@F.pandas_udf(T.ArrayType(T.StringType()))
def targets(url: pd.Series, html: pd.Series) -> pd.Series:
    """The absolute targets of a page's anchors, without queries and fragments."""
    return pd.Series([[urljoin(u, h).partition("#")[0].partition("?")[0] for h in _Anchors(page).found] if page is not None else [] for u, page in zip(url, html, strict=True)])


def _written(spark: SparkSession, place: str) -> bool:
    """Whether a write to this folder was committed."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(place, "_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def crawled(spark: SparkSession, root: str, folder: str, workers: int = 8, suffix: str = ".pdf") -> DataFrame:
    """(session, url) of the files below a root listing.

    Rounds to a fixed point: fetch the listings of the frontier, take from their anchors the
    files and the listings of sessions (a number as the last part) below the root, and go on
    with the listings that were not seen before.  A round's links are written to folder/round=n,
    from which a crawl that was cut off goes on.  Listings are a page a session, so the frontier
    is short; the files are never collected.
    """
    spark.dataSource.register(UrlSource)
    root = root.rstrip("/") + "/"
    frontier, seen, n = [root], {root}, 0
    kind = "page string, url string, session string, listing boolean, error string"
    while frontier:
        place = f"{folder.rstrip('/')}/round={n}"
        if not _written(spark, place):
            pages = spark.read.format("urls").option("urls", "\n".join(frontier)).option("workers", workers).load()
            d = pages.select(F.col("url").alias("page"), "error", F.explode_outer(targets("url", F.decode("content", "utf-8"))).alias("url"))
            rest = F.substr("url", F.lit(len(root) + 1))
            session = F.regexp_extract(rest, r"^(\d+)(?:/|$)", 1)
            listing = rest.rlike(r"^\d+/?$")
            d = d.where(F.col("error").isNotNull() | F.col("url").startswith(root) & (listing | (session != "") & F.col("url").endswith(suffix)))
            url = F.when(listing, F.concat(F.regexp_replace("url", "/+$", ""), F.lit("/"))).otherwise(F.col("url"))
            d.select("page", url.alias("url"), session.alias("session"), listing.alias("listing"), "error").distinct().write.mode("overwrite").parquet(place)
        links = spark.read.schema(kind).parquet(place)
        for r in links.where("error IS NOT NULL").collect():
            if r["page"] == root:
                raise RuntimeError(f"{root}: {r['error']}")
            log.error("no listing %s: %s", r["page"], r["error"])
        frontier = sorted({r["url"] for r in links.where("listing").select("url").distinct().collect()} - seen)
        seen.update(frontier)
        n += 1
    found = spark.read.schema(kind).parquet(*[f"{folder.rstrip('/')}/round={k}" for k in range(n)])
    return found.where("error IS NULL AND NOT listing").select(F.col("session").cast("int").alias("session"), "url").distinct()
