"""Layout inference on the cell grid, for all sheets of all files at once.

The cells (file, sheet, sheet_idx, row_idx, col_idx, raw) are read once: `heads` gathers the rows in which a
layout may stand into one array per sheet, and every rule is an expression over that array. It is bounded by
the format, some forty rows of at most 16,384 cells. Functions that take cells give one row per sheet (or
file). Ties go to the earliest candidate.
"""

from __future__ import annotations

import re
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.config import HEADER_KEYWORDS, SHEET_KEYWORDS, SHORT_MONTHS, YEAR_CELL
from gridloom.functions.text import key, lookup, matches, normal_header, strip, to_number, to_whole

SHEET = ("file", "sheet")


def heads(cells: DataFrame, scan: int, pinned=(), label: str | None = None, sheets: DataFrame | None = None) -> DataFrame:
    """file, sheet, sheet_idx; `top`: the rows below `scan` and the pinned ones, as (row_idx, cells), of
    which each is (col_idx, raw) in order; `labels`: the rows whose first cell matches `label`, in order.

    `sheets` is a catalogue of the sheets, with those that have no cell; without it there are only those that have some."""
    near = F.col("row_idx") < scan
    near = near | F.col("row_idx").isin(*pinned) if pinned else near
    labelled = F.when((F.col("col_idx") == 0) & matches(strip(F.col("raw")), label), F.col("row_idx")) if label is not None else F.lit(None).cast("int")
    rows = cells.groupBy(*SHEET, "sheet_idx", F.when(near, F.col("row_idx")).alias("_row")).agg(
        F.array_sort(F.collect_list(F.when(near & F.col("raw").isNotNull(), F.struct("col_idx", "raw")))).alias("cells"), F.collect_set(labelled).alias("_labels")
    )
    top = F.collect_list(F.when(F.col("_row").isNotNull(), F.struct(F.col("_row").alias("row_idx"), "cells")))
    found = rows.groupBy(*SHEET, "sheet_idx").agg(F.array_sort(top).alias("top"), F.array_sort(F.flatten(F.collect_list("_labels"))).alias("labels"))
    if sheets is None:
        return found
    named = [*SHEET, "sheet_idx"]
    none = (found.where("false").select("top", "labels").schema[c].dataType for c in ("top", "labels"))
    return sheets.select(*named).join(found, named, "left").select(*named, *(F.coalesce(c, F.array().cast(t)).alias(c) for c, t in zip(("top", "labels"), none, strict=True)))


def choose(heads: DataFrame, sheet: str | None, order: Column | None = None) -> DataFrame:
    """The heads of the named sheet, or of each file's greatest in `order`; the first sheet, if none is given."""
    if sheet is not None:
        return heads.where(F.col("sheet") == sheet)
    order = F.struct(-F.col("sheet_idx")) if order is None else F.struct(order, -F.col("sheet_idx"))
    return heads.groupBy("file").agg(F.max_by(F.struct("*"), order).alias("_h")).select("_h.*")


def joined(row: Column) -> Column:
    """The text of a row: its cells in lower case with spaces between them."""
    return F.array_join(F.transform(row["cells"], lambda c: key(c["raw"])), " ")


def hits(text: Column, keywords) -> Column:
    return sum((F.contains(text, F.lit(k)).cast("int") for k in keywords), F.lit(0))


def sheet_score(top: Column, keywords, rows: int = 40) -> Column:
    """Keywords in the first rows, those in the sheet's name counting twice."""
    text = F.array_join(F.transform(F.filter(top, lambda r: (r["row_idx"] < rows) & (F.size(r["cells"]) > 0)), joined), " ")
    return hits(text, keywords) + 2 * hits(F.lower("sheet"), keywords)


def greatest_row(top: Column, score, max_scan: int) -> Column:
    """The row of the highest score, row 0 if none scores."""
    best = F.array_max(F.transform(F.filter(top, lambda r: r["row_idx"] < max_scan), lambda r: F.struct(score(r).alias("s"), (-r["row_idx"]).alias("r"))))
    return F.coalesce(F.when(best["s"] > 0, -best["r"]), F.lit(0))


def header_row_of(top: Column, keywords, max_scan: int) -> Column:
    return greatest_row(top, lambda r: hits(joined(r), keywords), max_scan)


def is_year(c: Column) -> Column:
    return F.coalesce(strip(c).rlike(YEAR_CELL), F.lit(False))


def years_in(row: Column) -> Column:
    return F.size(F.filter(row["cells"], lambda c: is_year(c["raw"])))


def year_row_of(top: Column, max_scan: int = 30) -> Column:
    return greatest_row(top, years_in, max_scan)


def grid_header_row_of(top: Column, month_column: str, max_scan: int = 30) -> Column:
    """The first row with the month column's name or at least five years; else row 0."""
    name = month_column.strip().lower()
    fits = F.filter(top, lambda r: (r["row_idx"] < max_scan) & (F.exists(r["cells"], lambda c: key(c["raw"]) == name) | (years_in(r) >= 5)))
    return F.coalesce(F.get(fits, F.lit(0))["row_idx"], F.lit(0))


def month_row_of(top: Column, year_row: Column, months: dict, max_scan: int = 5) -> Column:
    """The first of the rows below the years with six different months; else the next row."""
    found = lambda r: F.size(F.array_distinct(F.filter(F.transform(r["cells"], lambda c: key(c["raw"])), lambda t: t.isin(*months))))
    fits = F.filter(top, lambda r: (r["row_idx"] > year_row) & (r["row_idx"] <= year_row + max_scan) & (found(r) >= 6))
    return F.coalesce(F.get(fits, F.lit(0))["row_idx"], year_row + 1)


def cells_of(top: Column, row: Column) -> Column:
    return F.flatten(F.transform(F.filter(top, lambda r: r["row_idx"] == row), lambda r: r["cells"]))


def dates_of(top: Column, year_row: Column, month_row: Column, months: dict) -> Column:
    """An array of (col_idx, year, month): years carry on to the right until the next one.

    A cell of the year row that is no number leaves the year before it in force."""
    body = lambda row: F.filter(cells_of(top, row), lambda c: c["col_idx"] >= 1)
    years = F.filter(F.transform(body(year_row), lambda c: F.struct(c["col_idx"].alias("col_idx"), to_number(c["raw"]).try_cast("int").alias("year"))), lambda y: y["year"].isNotNull())
    named = F.filter(F.transform(body(month_row), lambda c: F.struct(c["col_idx"].alias("col_idx"), lookup(months, key(c["raw"])).alias("month"))), lambda m: m["month"].isNotNull())
    before = lambda m: F.filter(years, lambda y: y["col_idx"] <= m["col_idx"])
    dated = F.transform(named, lambda m: F.struct(m["col_idx"].alias("col_idx"), F.try_element_at(before(m), F.lit(-1))["year"].alias("year"), m["month"].alias("month")))
    return F.filter(dated, lambda d: d["year"].isNotNull())


def month_column_of(header: Column, expected: str) -> Column:
    """The header cell named so, else the first whose name holds it, else the first."""
    want = expected.strip().lower()
    priority = lambda c: F.when(key(c["raw"]) == want, 0).when(F.contains(key(c["raw"]), F.lit(want)), 1).otherwise(2)
    return F.array_min(F.transform(header, lambda c: F.struct(priority(c).alias("p"), c["col_idx"].alias("col_idx"))))["col_idx"]


def year_columns_of(header: Column) -> Column:
    """A map from col_idx to year of the header's years; a year that stands twice counts where it stands first."""
    years = F.transform(F.filter(header, lambda c: is_year(c["raw"])), lambda c: F.struct(to_whole(strip(c["raw"])).alias("year"), c["col_idx"].alias("col_idx")))
    first = lambda y: F.array_min(F.transform(F.filter(years, lambda x: x["year"] == y), lambda x: x["col_idx"]))
    return F.map_from_entries(F.transform(F.array_distinct(F.transform(years, lambda x: x["year"])), lambda y: F.struct(first(y), y)))


def named_like(pattern: str, column: Column) -> Column:
    return matches(column["name"], pattern)


def assigned(header: Column, patterns: dict) -> Column:
    """One column number for each field of `patterns`, in their order, or -1: a field takes the first column whose name
    matches and which none before it has taken."""
    names = F.transform(header, lambda c: F.struct(c["col_idx"].alias("col_idx"), normal_header(c["raw"]).alias("name")))
    like = ["|".join(f"(?:{p})" for p in wanted) for wanted in patterns.values()]
    fits = [F.transform(F.filter(names, partial(named_like, p)), lambda n: n["col_idx"]) for p in like]
    taken = F.array().cast("array<int>")
    return F.aggregate(F.array(*fits), taken, lambda acc, columns: F.array_append(acc, F.coalesce(F.array_min(F.array_except(columns, acc)), F.lit(-1))))


def in_cells(keywords) -> bool:
    """Whether each keyword that stands in a row's text stands in one of its cells: none is empty or holds the space between cells."""
    return len(keywords) < 63 and all(k and " " not in k for k in keywords)


def found_in(raw: Column, keywords) -> Column:
    """The keywords that the cells of a group hold, as bits. No text need travel for it."""
    return F.bit_or(sum((F.when(F.contains(key(raw), F.lit(k)), F.lit(1 << i)).otherwise(0).cast("long") for i, k in enumerate(keywords)), F.lit(0).cast("long")))


def sheet_scores(cells: DataFrame, keywords, rows: int, sheets: DataFrame | None) -> DataFrame:
    """file, sheet, sheet_idx, score; see sheet_score."""
    named = [*SHEET, "sheet_idx"]
    if not in_cells(keywords):
        return heads(cells, rows, sheets=sheets).select(*named, sheet_score(F.col("top"), keywords, rows).alias("score"))
    found = cells.groupBy(*named).agg(found_in(F.when(F.col("row_idx") < rows, F.col("raw")), keywords).alias("_found"))
    if sheets is not None:
        found = sheets.select(*named).join(found, named, "left")
    return found.select(*named, (F.bit_count(F.coalesce("_found", F.lit(0).cast("long"))) + 2 * hits(F.lower("sheet"), keywords)).alias("score"))


def best_sheet(cells: DataFrame, keywords=SHEET_KEYWORDS, rows: int = 40, sheets: DataFrame | None = None) -> DataFrame:
    """Per file the sheet with most keywords in its first rows, those in its name counting twice."""
    scored = sheet_scores(cells, keywords, rows, sheets)
    return scored.groupBy("file").agg(F.max_by("sheet", F.struct("score", -F.col("sheet_idx"))).alias("sheet"), F.max("score").alias("score"))


def first_sheet(cells: DataFrame) -> DataFrame:
    return cells.groupBy("file").agg(F.min_by("sheet", "sheet_idx").alias("sheet"))


def choose_sheet(cells: DataFrame, sheet: str | None, best=first_sheet) -> DataFrame:
    """The cells of the named sheet, or of each file's chosen one."""
    return cells.where(F.col("sheet") == sheet) if sheet is not None else cells.join(best(cells), ["file", "sheet"], "left_semi")


def header_row(cells: DataFrame, keywords=HEADER_KEYWORDS, max_scan: int = 30) -> DataFrame:
    """Per sheet the row whose text holds most keywords."""
    if in_cells(keywords):
        named = [*SHEET, "sheet_idx"]
        rows = cells.groupBy(*named, F.when(F.col("row_idx") < max_scan, F.col("row_idx")).alias("_row")).agg(found_in(F.col("raw"), keywords).alias("_found"))
        # one number, the greater the more keywords and then the earlier the row: such maxima are taken in place
        place = F.lit(1 << 32) * F.bit_count("_found") - F.col("_row")
        best = rows.groupBy(*named).agg(F.max(F.when(F.col("_found") != 0, place)).alias("_best"))
        return best.select(*SHEET, F.coalesce(F.pmod(-F.col("_best"), F.lit(1 << 32)), F.lit(0)).cast(cells.schema["row_idx"].dataType).alias("header_row"))
    return heads(cells, max_scan).select(*SHEET, header_row_of(F.col("top"), keywords, max_scan).alias("header_row"))


def grid_header_row(cells: DataFrame, month_column: str = "Mes", max_scan: int = 30) -> DataFrame:
    """Per sheet the first row with the month column's name or at least five years; else row 0."""
    return heads(cells, max_scan).select(*SHEET, grid_header_row_of(F.col("top"), month_column, max_scan).alias("header_row"))


def year_row(cells: DataFrame, max_scan: int = 30) -> DataFrame:
    """Per sheet the row with most years."""
    return heads(cells, max_scan).select(*SHEET, year_row_of(F.col("top"), max_scan).alias("year_row"))


def first_row(cells: DataFrame, fits: Column) -> DataFrame:
    """Per sheet that has one, the first row with a cell that fits."""
    return cells.where(fits).groupBy(*SHEET).agg(F.min("row_idx").alias("row_idx"))


def first_row_of_words(cells: DataFrame, words, least: int) -> DataFrame:
    """Per sheet that has one, the first row whose cells hold at least so many different ones of the words."""
    word = key(F.col("raw"))
    rows = cells.where(word.isin(*words)).groupBy(*SHEET, "row_idx").agg(F.count_distinct(word).alias("_words"))
    return rows.where(F.col("_words") >= least).groupBy(*SHEET).agg(F.min("row_idx").alias("row_idx"))


def month_row(cells: DataFrame, year_rows: DataFrame, months: dict = SHORT_MONTHS, max_scan: int = 5) -> DataFrame:
    """Per sheet the first of the rows below the years with six different months; else the next row."""
    near = cells.join(year_rows, list(SHEET)).where((F.col("row_idx") > F.col("year_row")) & (F.col("row_idx") <= F.col("year_row") + max_scan))
    found = first_row_of_words(near, months, 6)
    return year_rows.join(found, list(SHEET), "left").select(*SHEET, "year_row", F.coalesce("row_idx", F.col("year_row") + 1).alias("month_row"))


def label_row(cells: DataFrame, rows: DataFrame, label: str) -> DataFrame:
    """Adds the first row from month_row on whose first cell matches; null where none does."""
    below = cells.where("col_idx = 0").join(rows, list(SHEET)).where(F.col("row_idx") >= F.col("month_row"))
    found = first_row(below, matches(strip(F.col("raw")), label))
    return rows.join(found.withColumnRenamed("row_idx", "label_row"), list(SHEET), "left")


def gathered(cells: DataFrame, keys) -> DataFrame:
    """Per sheet its rows as `top`; `keys` go with the sheet."""
    cell = F.when(F.col("raw").isNotNull(), F.struct("col_idx", "raw"))
    rows = cells.groupBy(*SHEET, *keys, "row_idx").agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    return rows.groupBy(*SHEET, *keys).agg(F.array_sort(F.collect_list(F.struct("row_idx", "cells"))).alias("top"))


def date_columns(cells: DataFrame, rows: DataFrame, months: dict = SHORT_MONTHS) -> DataFrame:
    """file, sheet, col_idx, year, month of the columns that the year and month rows date; see dates_of."""
    keys = ("year_row", "month_row")
    near = cells.join(rows.select(*SHEET, *keys), list(SHEET)).where("row_idx = year_row or row_idx = month_row")
    dated = gathered(near, keys).select(*SHEET, F.explode(dates_of(F.col("top"), F.col("year_row"), F.col("month_row"), months)).alias("_d"))
    return dated.select(*SHEET, "_d.*")


def month_column(cells: DataFrame, headers: DataFrame, expected: str = "Mes") -> DataFrame:
    """Per sheet the column named so, else the first whose name holds it, else the first column."""
    own = gathered(cells.join(headers.select(*SHEET, "header_row"), list(SHEET)).where("row_idx = header_row"), ("header_row",))
    return own.select(*SHEET, month_column_of(cells_of(F.col("top"), F.col("header_row")), expected).alias("month_col")).where("month_col is not null")


def matches_any(name: str, patterns) -> bool:
    return any(re.search(p, name, re.IGNORECASE) for p in patterns)


def map_columns(columns: list[str], patterns: dict) -> dict[str, str]:
    """{raw: canonical}: each field takes the first column that matches and is not taken."""
    found: dict[str, str] = {}
    for field, wanted in patterns.items():
        name = next((c for c in columns if c not in found and matches_any(c, wanted)), None)
        if name is not None:
            found[name] = field
    return found


def field_columns(cells: DataFrame, headers: DataFrame, patterns: dict) -> DataFrame:
    """map_columns on the grid: file, sheet, field, col_idx; fields are filled in their order."""
    own = gathered(cells.join(headers.select(*SHEET, "header_row"), list(SHEET)).where("row_idx = header_row"), ("header_row",))
    taken = own.select(*SHEET, assigned(cells_of(F.col("top"), F.col("header_row")), patterns).alias("_taken"))
    fields = F.arrays_zip(F.array(*map(F.lit, patterns)).alias("field"), F.col("_taken").alias("col_idx"))
    return taken.select(*SHEET, F.explode(fields).alias("_f")).select(*SHEET, F.col("_f")["field"].alias("field"), F.col("_f")["col_idx"].alias("col_idx")).where("col_idx >= 0")
