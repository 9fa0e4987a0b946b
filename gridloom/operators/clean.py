"""From cell grids and flat tables to tidy monthly series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.config import FlatProfile, IndexFeed, RateFeed
from gridloom.functions.series import keep_first
from gridloom.functions.text import key, lookup, month_start, normal_name, strip, to_number, to_whole
from gridloom.operators import layout
from gridloom.operators.layout import SHEET


def rate_heads(cells: DataFrame, feed: RateFeed, sheets: DataFrame | None = None) -> DataFrame:
    """The chosen sheets with `top`, year_row, month_row and label_row: pinned ones, or found where the feed has none."""
    pinned = tuple(r for r in (feed.year_row, feed.month_row) if r is not None)
    cells = cells if feed.sheet is None else cells.where(F.col("sheet") == feed.sheet)
    found = layout.choose(layout.heads(cells, 0 if len(pinned) == 2 else 36, pinned, feed.label, sheets), feed.sheet)
    top = F.col("top")
    found = found.withColumn("year_row", layout.year_row_of(top) if feed.year_row is None else F.lit(feed.year_row))
    found = found.withColumn("month_row", layout.month_row_of(top, F.col("year_row"), feed.months) if feed.month_row is None else F.lit(feed.month_row))
    return found.withColumn("label_row", F.array_min(F.filter("labels", lambda r: r >= F.col("month_row"))))


def rate_rows(cells: DataFrame, feed: RateFeed) -> DataFrame:
    """The rows of each chosen sheet: file, sheet, year_row, month_row, label_row."""
    return rate_heads(cells, feed).select(*SHEET, "year_row", "month_row", "label_row")


def parse_rate(cells: DataFrame, feed: RateFeed | None = None, sheets: DataFrame | None = None) -> DataFrame:
    """file, date, year, month, measure, _nth of the labelled row under years and months."""
    feed = feed or RateFeed()
    found = rate_heads(cells, feed, sheets).where("label_row is not null")
    dates = layout.dates_of(F.col("top"), F.col("year_row"), F.col("month_row"), feed.months)
    by_column = F.map_from_entries(F.transform(dates, lambda d: F.struct(d["col_idx"], d)))
    dated = found.select(*SHEET, "label_row", by_column.alias("_dates"))
    measure = feed.output.measure
    values = cells.join(dated, list(SHEET)).where("row_idx = label_row").select("file", "col_idx", to_number(F.col("raw")).alias(measure), F.try_element_at("_dates", F.col("col_idx")).alias("_date"))
    values = values.where(F.col("_date").isNotNull() & F.col(measure).isNotNull())
    return values.select("file", month_start(F.col("_date.year"), F.col("_date.month")).alias("date"), "_date.year", "_date.month", measure, F.col("col_idx").cast("long").alias("_nth"))


class LabelNotFound(ValueError):
    """No row of a sheet bears the indicator's label."""


def checked_rate(cells: DataFrame, feed: RateFeed | None = None, sheets: DataFrame | None = None) -> DataFrame:
    """parse_rate, but an error where a chosen sheet has no labelled row; it looks at the first few such sheets only."""
    feed = feed or RateFeed()
    bad = [f"{r.file}: {r.sheet}" for r in rate_heads(cells, feed, sheets).where("label_row is null").select(*SHEET).limit(5).collect()]
    if bad:
        raise LabelNotFound(f"no row matches {feed.label!r} in {bad}")
    return parse_rate(cells, feed, sheets)


def parse_index(cells: DataFrame, feed: IndexFeed | None = None, sheets: DataFrame | None = None) -> DataFrame:
    """file, date, year, month, measure, _nth of a sheet with months down and years across."""
    feed = feed or IndexFeed()
    cells = cells if feed.sheet is None else cells.where(F.col("sheet") == feed.sheet)
    scan, pinned = (30, ()) if feed.header_row is None else (0, (feed.header_row,))
    found = layout.choose(layout.heads(cells, scan, pinned, sheets=sheets), feed.sheet)
    found = found.withColumn("header_row", layout.grid_header_row_of(F.col("top"), feed.month_column) if feed.header_row is None else F.lit(feed.header_row))
    found = found.select(*SHEET, "header_row", layout.cells_of(F.col("top"), F.col("header_row")).alias("_header"))
    found = found.select(*SHEET, "header_row", layout.month_column_of(F.col("_header"), feed.month_column).alias("month_col"), layout.year_columns_of(F.col("_header")).alias("_years"))
    own = cells.join(found, list(SHEET)).where("row_idx > header_row")
    month = F.when(F.col("col_idx") == F.col("month_col"), lookup(feed.months, key(F.col("raw"))))
    year, value = F.try_element_at("_years", F.col("col_idx")), to_number(F.col("raw"))
    cell = F.when(year.isNotNull() & value.isNotNull(), F.struct("col_idx", year.alias("year"), value.alias("value")))
    rows = own.groupBy(*SHEET, "row_idx").agg(F.max(month).alias("month"), F.collect_list(cell).alias("_cells")).where("month is not null")
    one = rows.select("file", "row_idx", "month", F.explode("_cells").alias("_c")).select("file", "row_idx", "month", "_c.*")
    nth = (F.col("col_idx").cast("long") * (1 << 31)) + F.col("row_idx")
    return one.select("file", month_start(F.col("year"), F.col("month")).alias("date"), "year", "month", F.col("value").alias(feed.output.measure), nth.alias("_nth"))


def finish(parsed: DataFrame, measure: str, columns, source: str, run_date: str, keys=("file",)) -> DataFrame:
    """One row per date (the first in the sheet), stamped, in the fixed order of columns.

    `keys` keep series apart and stay as columns when they are not in `columns`.
    """
    keys = [k for k in keys if k in parsed.columns]
    first = keep_first(parsed.where(F.col("date").isNotNull() & F.col(measure).isNotNull()), [*keys, "date"], ["_nth"])
    stamped = first.withColumns({"year": F.col("year").cast("int"), "month": F.col("month").cast("int"), "source": F.lit(source), "download_date": F.lit(run_date)})
    return stamped.select(*(k for k in keys if k not in columns), *columns)


def clean_rate(cells: DataFrame, run_date: str, feed: RateFeed | None = None, sheets: DataFrame | None = None) -> DataFrame:
    feed = feed or RateFeed()
    return finish(parse_rate(cells, feed, sheets), feed.output.measure, feed.output.columns, feed.output.source, run_date)


def checked_clean_rate(cells: DataFrame, run_date: str, feed: RateFeed | None = None, sheets: DataFrame | None = None) -> DataFrame:
    feed = feed or RateFeed()
    return finish(checked_rate(cells, feed, sheets), feed.output.measure, feed.output.columns, feed.output.source, run_date)


def clean_index(cells: DataFrame, run_date: str, feed: IndexFeed | None = None, sheets: DataFrame | None = None) -> DataFrame:
    feed = feed or IndexFeed()
    return finish(parse_index(cells, feed, sheets), feed.output.measure, feed.output.columns, feed.output.source, run_date)


def clean_flat_csv(raw: DataFrame, nth: Column | None = None, year: str = "year", rate: str = "unemployed_percent") -> DataFrame:
    """A yearly table: date is 1 January; columns date, year, month, unemployment_rate, _nth."""
    named = raw.toDF(*(c.strip().lower() for c in raw.columns))
    missing = [c for c in (year, rate) if c not in named.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {named.columns}")
    order = F.monotonically_increasing_id() if nth is None else nth
    y = F.col(year).cast("int")
    return named.select(month_start(y, F.lit(1)).alias("date"), y.alias("year"), F.lit(1).alias("month"), to_number(F.col(rate)).alias("unemployment_rate"), order.alias("_nth"))


def named(columns: dict[str, str]) -> dict[str, tuple[str]]:
    """The fields of a profile whose columns' names are known: {name: field}."""
    return {field: (f"^{normal_name(name)}$",) for name, field in columns.items()}


def clean_flat_cells(cells: DataFrame, profile: FlatProfile, sheets: DataFrame | None = None) -> DataFrame:
    """A flat sheet below a header that may stand anywhere: file, date, year, month, unemployment_rate, _nth."""
    head = profile.header
    cells = cells if profile.sheet is None else cells.where(F.col("sheet") == profile.sheet)
    found = layout.heads(cells, max(40, head.scan), () if head.row is None else (head.row,), sheets=sheets)
    found = layout.choose(found, profile.sheet, layout.sheet_score(F.col("top"), head.keywords))
    found = found.withColumn("header_row", layout.header_row_of(F.col("top"), head.keywords, head.scan) if head.row is None else F.lit(head.row))
    taken = layout.assigned(layout.cells_of(F.col("top"), F.col("header_row")), profile.fields)
    found = found.select(*SHEET, "header_row", taken.alias("_taken"))
    fields = list(profile.fields)
    body = cells.join(found, list(SHEET)).where("row_idx > header_row").where(F.array_contains("_taken", F.col("col_idx")))
    pick = lambda f: F.max(F.when(F.col("col_idx") == F.col("_taken")[fields.index(f)], F.col("raw"))) if f in fields else F.max(F.lit(None).cast("string"))
    wide = body.groupBy(*SHEET, "row_idx").agg(*(pick(f).alias(f"_{f}") for f in ("unemployment_rate", "year", "month", "date")))
    date = F.coalesce(F.try_to_date(F.substring(strip(F.col("_date")), 1, 10)), F.date_add(F.lit("1899-12-30").cast("date"), to_whole(F.col("_date"))))
    year, month = to_whole(F.col("_year")), to_whole(F.col("_month"))
    # a sheet without months is yearly: January of every row
    built = F.when(year.isNotNull() & F.coalesce(month, F.lit(1)).between(1, 12), month_start(year, F.coalesce(month, F.lit(1))))
    day = F.coalesce(date, built)
    return wide.select("file", day.alias("date"), F.coalesce(year, F.year(day)).alias("year"), F.coalesce(month, F.month(day)).alias("month"), to_number(F.col("_unemployment_rate")).alias("unemployment_rate"), F.col("row_idx").cast("long").alias("_nth"))


def clean_flat(data: DataFrame, profile: FlatProfile, run_date: str, sheets: DataFrame | None = None) -> DataFrame:
    """The flat cleaner for either format: raw rows of a CSV, or cells of workbooks, with a catalogue of their sheets if there is one."""
    from gridloom.config import RATE_COLUMNS

    if profile.file_format == "csv":
        parsed = clean_flat_csv(data)
    elif profile.file_format == "xlsx":
        parsed = clean_flat_cells(data, profile, sheets)
    else:
        raise ValueError(f"unknown format {profile.file_format!r}")
    return finish(parsed, "unemployment_rate", RATE_COLUMNS, profile.source, run_date)
