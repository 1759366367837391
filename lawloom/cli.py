"""Command line: sessions from a server's listings, or landed texts, to tables, and publishing."""

from __future__ import annotations

import argparse
import importlib
import logging
import sys
import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.documents import bill_documents, bill_records
from .operators.quality import below_gate, gate_measures
from .operators.selection import filename_counts, valid_filenames
from .publish import FolderPublisher, publish_session, sync_card
from .sources.listing import UrlSource, crawled, land, listed_files
from .sources.readers import Decoder, decoded, text_of_pages
from .sources.sinks import Written, write_all_session_files, write_session_files

log = logging.getLogger(__name__)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lawloom", description="Bill texts to typed tables by session")
    p.add_argument("landed", nargs="?", help="Parquet of filename and raw_text; without it, sessions are fetched from --base-url")
    p.add_argument("--decoder", default="lawloom.sources.readers:pdf_pages", metavar="MODULE:FUNCTION", help="bytes of a file to the texts of its pages")
    p.add_argument("--sessions", type=int, nargs="+", default=[132])
    p.add_argument("--all-sessions", action="store_true", help="find the sessions and their files from the root listing")
    p.add_argument("--resume", metavar="DIR", help="land what is fetched here, and go on there after a killed run")
    p.add_argument("--publish", metavar="DIR", help="publish to this folder and write its card")
    p.add_argument("--repo-id", default="bills", help="name of the data set on its card")
    p.add_argument("--base-url", default="", help="where <session>/<filename>.pdf lie, and prefix of the source URLs")
    p.add_argument("--local-dir", default="./data")
    p.add_argument("--workers", type=int, default=8, help="tasks that fetch files")
    return p


def decoder_named(name: str) -> Decoder:
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def counted(names: DataFrame) -> DataFrame:
    """Names as they are, after a warning of those that are left out later."""
    n = filename_counts(names).first()
    if n["n_skipped"]:
        log.warning("skipping %d files with unexpected names", n["n_skipped"])
    return valid_filenames(names)


def listed_urls(spark: SparkSession, base_url: str, session: int) -> list[str]:
    """The files with valid names that a session's listing names; a listing is one page."""
    spark.dataSource.register(UrlSource)
    top = f"{base_url.rstrip('/')}/{session}/"
    page = spark.read.format("urls").option("urls", top).load()
    if (error := page.first()["error"]) is not None:
        raise RuntimeError(f"{top}: {error}")
    names = counted(listed_files(page.select(F.decode("content", "utf-8").alias("html"))).distinct())
    return [f"{top}{r['filename']}.pdf" for r in names.orderBy("filename").collect()]


def crawled_urls(files: DataFrame, session: int) -> list[str]:
    """The same from a crawl's files."""
    named = files.where(F.col("session") == session).select("url", F.regexp_extract("url", r"([^/]*)\.pdf$", 1).alias("filename"))
    return [r["url"] for r in counted(named).orderBy("url").collect()]


def fetched_files(spark: SparkSession, urls: list[str], decoder: Decoder, workers: int = 8, resume: str | None = None) -> DataFrame:
    """filename and raw_text of a session's files; those that can't be fetched or decoded are
    logged and left out.  With `resume` they are landed there, and not fetched again."""
    if resume:
        files = land(spark, urls, resume, budget=8 * workers, per_host=workers)
    else:
        files = spark.read.format("urls").option("urls", "\n".join(urls)).option("workers", workers).load()
    files = files.withColumn("filename", F.regexp_extract("url", r"([^/]*)\.pdf$", 1)).withColumnRenamed("error", "missing")
    pages = decoded(files, decoder).persist()  # one fetch and one decoding serve the log and the records
    reason = F.coalesce("missing", "error")
    for r in pages.select("filename", reason.alias("error")).where("error IS NOT NULL").toLocalIterator():
        log.error("failed to process %r; skipping: %s", r["filename"], r["error"])
    return pages.where("missing IS NULL AND error IS NULL").select("filename", text_of_pages(F.col("pages")).alias("raw_text"))


def log_written(session: int, done: Written) -> None:
    """Files, rows and rates of a session, all counted by the plan that wrote it."""
    for f in done.files:
        log.info("saved %s", f)
    log.info("session %d: %d records", session, done.counted["rows"])
    for k, v in below_gate(done.counted).items():
        log.warning("session %d: %s is %.2f, below its gate", session, k, v)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    now = F.lit(datetime.now(UTC).isoformat())
    landed = counted(spark.read.parquet(args.landed)) if args.landed else None
    to = FolderPublisher(args.publish) if args.publish else None
    sessions, files = args.sessions, None
    if landed is None and args.all_sessions:
        folder = args.resume or f"{args.local_dir}/_crawls/{uuid.uuid4().hex}"
        files = crawled(spark, args.base_url, f"{folder}/crawl", args.workers).persist()
        sessions = sorted(r["session"] for r in files.select("session").distinct().collect())
    if landed is not None and not to:  # one scan of the landed texts for all sessions
        records = bill_records(bill_documents(landed), args.base_url, scraped_at=now)
        for s, done in write_all_session_files(records, sessions, args.local_dir, measures=gate_measures()).items():
            log_written(s, done)
        return
    for s in sessions:
        rows = landed
        if rows is None:
            urls = listed_urls(spark, args.base_url, s) if files is None else crawled_urls(files, s)
            rows = fetched_files(spark, urls, decoder_named(args.decoder), args.workers, args.resume and f"{args.resume}/{s}")
        url = args.base_url if args.landed else f"{args.base_url.rstrip('/')}/{s}/"
        records = bill_records(bill_documents(rows), url, scraped_at=now)
        if to:
            log.info("session %d: %d records", s, publish_session(records, s, to, args.local_dir))
        else:
            log_written(s, write_session_files(records, s, args.local_dir, measures=gate_measures()))
    if to:
        sync_card(to, "Bills by session", args.repo_id, args.base_url)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    try:
        run(SparkSession.builder.appName("lawloom").getOrCreate(), args)
    except Exception:
        log.exception("run failed")
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
