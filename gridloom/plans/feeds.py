"""The feeds end to end: page, newest link, workbook, cells, series, checks, file."""

from __future__ import annotations

import logging
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.config import YEARLY, FlatProfile, IndexFeed, Origin, Output, RateFeed
from gridloom.operators import clean, quality
from gridloom.sources import files, links
from gridloom.sources.xlsx import read_cells, read_sheets

log = logging.getLogger("gridloom.feeds")


def page_links(spark: SparkSession, page, origin: Origin) -> DataFrame:
    html = spark.read.text(str(page), wholetext=True).withColumnRenamed("value", "html")
    return links.extract_links(html, F.lit(origin.host + "/"), origin.links)


def acquire(spark: SparkSession, origin: Origin, output: Output, fetch, raw: str) -> str:
    """Lands the page, then the newest workbook it links to."""
    page = files.land(spark, fetch.read(origin.page), f"{raw}/{output.landed.rpartition('.')[0]}.html")
    found = page_links(spark, page, origin)
    newest = links.target(found, origin.wanted) if origin.wanted else links.newest(found)
    chosen = links.only(found, newest, origin.links)
    log.info("chosen: %s", chosen.href)
    return files.download(spark, fetch, chosen.url, f"{raw}/{output.landed}")


def download_profile(spark: SparkSession, fetch, raw: str, profile: FlatProfile = YEARLY) -> str:
    """Lands the file of a flat profile."""
    if not profile.url:
        raise ValueError(f"the profile {profile.name!r} has no address")
    return files.download(spark, fetch, profile.url, f"{raw}/{profile.landed}")


def publish(df: DataFrame, path: str, suite: quality.Suite, always: bool, empty: str = "the series has no row") -> DataFrame:
    """Writes the series beside its place, with the figures of its checks gathered on the way, then puts it there if
    they pass; with `always` before they are judged, so a failing series is kept to look at."""
    spark = df.sparkSession
    rows, seen = suite.observed(df, "checks")
    staged = files.stage_series(rows, path)
    try:
        found = seen.get
        if not found["n_rows"]:
            raise ValueError(empty)
        if always:
            files.commit(spark, staged, path)
        suite.judge(found, files.load_series(spark, path if always else staged, suite.measure))
        if not always:
            files.commit(spark, staged, path)
    finally:
        files.discard(spark, staged)
    log.info("%s: %s rows of %s columns, %s to %s", path.rpartition("/")[2], found["n_rows"], len(df.columns), found["first_date"], found["last_date"])
    return files.load_series(spark, path, suite.measure)


def run_feed(spark: SparkSession, fetch, root, feed, run_date: str | None, always: bool, cleaner, suite: quality.Suite, empty: str) -> DataFrame:
    folders, today = files.ensure_folders(spark, root), run_date or date.today().isoformat()
    book = acquire(spark, feed.origin, feed.output, fetch, folders["raw"])
    cells = read_cells(spark, book, feed.sheet).cache()
    try:
        series = cleaner(cells, today, feed, read_sheets(spark, book) if feed.sheet is None else None).select(*feed.output.columns)
        return publish(series, f"{folders['processed']}/{feed.output.published}", suite, always, empty)
    finally:
        cells.unpersist()


def run_rate(spark: SparkSession, fetch, root, feed: RateFeed | None = None, run_date: str | None = None, always: bool = False) -> DataFrame:
    return run_feed(spark, fetch, root, feed or RateFeed(), run_date, always, clean.checked_clean_rate, quality.RATE_SUITE, "no column under the label has a date and a value")


def run_index(spark: SparkSession, fetch, root, feed: IndexFeed | None = None, run_date: str | None = None, always: bool = False) -> DataFrame:
    return run_feed(spark, fetch, root, feed or IndexFeed(), run_date, always, clean.clean_index, quality.INDEX_SUITE, "no row has a known month and a year with a value")


def run_all(spark: SparkSession, fetch, root, **options) -> None:
    """One feed after the other; if the first fails, the second doesn't run."""
    run_rate(spark, fetch, root, **options)
    run_index(spark, fetch, root, **options)


def run_flat(spark: SparkSession, fetch, root, profile: FlatProfile = YEARLY, run_date: str | None = None, always: bool = False) -> DataFrame:
    """A flat profile from its address to a published series. Lines of a CSV file that don't fit its header are kept beside it."""
    folders = files.ensure_folders(spark, root)
    landed = download_profile(spark, fetch, folders["raw"], profile)
    if profile.file_format == "csv":
        n = files.save_rejected(files.read_flat_csv(spark, landed)[1], f"{folders['processed']}/{profile.name}.rejected")
        if n:
            log.warning("%s: %s lines don't fit the header", profile.name, n)
    series = clean_flat_file(spark, landed, profile, run_date or date.today().isoformat())
    return publish(series.select(*RateFeed().output.columns), f"{folders['processed']}/{profile.name}.csv", quality.RATE_SUITE, always)


def clean_flat_file(spark: SparkSession, path, profile: FlatProfile, run_date: str) -> DataFrame:
    if profile.file_format == "csv":
        return clean.clean_flat(files.read_flat_csv(spark, path)[0], profile, run_date)
    return clean.clean_flat(read_cells(spark, str(path), profile.sheet), profile, run_date, read_sheets(spark, str(path)))
