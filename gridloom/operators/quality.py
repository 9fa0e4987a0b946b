"""Checks of a monthly series: one aggregation, then a verdict.

`report` computes all figures of a suite in one pass over rows that know the row before them; `Suite.observed` gathers
the same while the series is written. The checks raise the first failure in order; only a failing one
looks for its rows. Their messages begin with fixed values that callers look for.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gridloom.config import DROP_TOLERANCE, GAP_DAYS, INDEX_BOUNDS, INDEX_COLUMNS, RATE_BOUNDS, RATE_COLUMNS
from gridloom.functions.series import filled_change, in_parts, repeated, with_gaps

log = logging.getLogger("gridloom.quality")


class QualityCheckError(Exception):
    """A series fails a check."""


def missing_columns(df: DataFrame, expected) -> list[str]:
    return sorted(set(expected) - set(df.columns))


def extra_columns(df: DataFrame, expected) -> list[str]:
    return sorted(set(df.columns) - set(expected))


def contract(expected, actual) -> tuple:
    """(missing, extra, all there, how many shared) of two arrays of names, as columns."""
    missing, extra = F.array_sort(F.array_except(expected, actual)), F.array_sort(F.array_except(actual, expected))
    return missing, extra, F.size(missing) == 0, F.size(F.array_intersect(expected, actual))


def check_columns(df: DataFrame, expected=RATE_COLUMNS, warn_extra: bool = True) -> None:
    if missing := missing_columns(df, expected):
        raise QualityCheckError(f"Columnas faltantes: {missing}")
    if warn_extra and (extra := extra_columns(df, expected)):
        log.warning("extra columns: %s", extra)


def check_index_columns(df: DataFrame) -> None:
    if missing := missing_columns(df, INDEX_COLUMNS):
        raise QualityCheckError(f"Columnas IPC faltantes: {missing}")


def absent(c: str, kind: str):
    """Null, and NaN in a floating-point column."""
    return F.col(c).isNull() | F.isnan(c) if kind in ("double", "float") else F.col(c).isNull()


def null_counts(df: DataFrame, columns) -> DataFrame:
    """One row: the missing values of each column."""
    kinds = dict(df.dtypes)
    return df.agg(*(F.count_if(absent(c, kinds[c])).alias(c) for c in columns))


def check_no_nulls(df: DataFrame, columns=("date", "unemployment_rate", "year", "month")) -> None:
    found = {c: n for c, n in null_counts(df, columns).first().asDict().items() if n}
    if found:
        raise QualityCheckError(f"Valores nulos: {found}")


def outside(df: DataFrame, c: str, low: float, high: float) -> DataFrame:
    """The rows outside [low, high]; missing values are not."""
    return df.where(~absent(c, dict(df.dtypes)[c]) & ~F.col(c).between(low, high))


def check_range(df: DataFrame, c: str, low: float, high: float, order="date") -> None:
    bad = [r[0] for r in outside(df, c, low, high).orderBy(order).select(c).limit(5).collect()]
    if bad:
        raise QualityCheckError(f"{c} fuera de rango [{low}, {high}]: {bad}")


def check_rate_range(df: DataFrame) -> None:
    check_range(df, "unemployment_rate", *RATE_BOUNDS)


def check_index_range(df: DataFrame) -> None:
    check_range(df, "ipc_index", *INDEX_BOUNDS)


def duplicate_dates(df: DataFrame, keys=("date",)) -> DataFrame:
    return repeated(df, keys)


def check_no_duplicates(df: DataFrame) -> None:
    bad = [r[0] for r in duplicate_dates(df).select("date").distinct().orderBy("date").limit(5).collect()]
    if bad:
        raise QualityCheckError(f"Fechas duplicadas: {bad}")


def gaps(df: DataFrame, by=(), days: int = GAP_DAYS) -> DataFrame:
    """The rows that come more than `days` after their predecessor, with `gap_days`."""
    return with_gaps(df, by, "gap_days").where(F.col("gap_days") > days)


def check_continuity(df: DataFrame) -> str | None:
    """A warning, or None. Fewer than two rows are only warned of."""
    if len(df.limit(2).collect()) < 2:
        return warn("too few rows to check continuity")
    n = gaps(df).count()
    return warn(f"{n} gaps of more than {GAP_DAYS} days") if n else None


def drops(df: DataFrame, c: str, by=(), tolerance: float = DROP_TOLERANCE) -> DataFrame:
    """The rows that fall by more than `tolerance` against their predecessor, with `change`."""
    return filled_change(df, c, by, ("date",), "change").where(F.col("change") < -tolerance)


def check_drops(df: DataFrame, c: str = "ipc_index", tolerance: float = DROP_TOLERANCE) -> str | None:
    n = drops(df, c, tolerance=tolerance).count()
    return warn(f"{n} falls of more than {tolerance:.0%}") if n else None


def warn(text: str) -> str:
    log.warning(text)
    return text


def with_steps(df: DataFrame, c: str) -> DataFrame:
    """df with what a row is to the row before: _gap in days, _change of c, and _again, whether it has the same date."""
    rows = in_parts(df, "date", {"_day": F.col("date"), "_filled": F.col(c)})
    steps = {"_gap": F.datediff("date", "_day_before"), "_change": F.try_divide("_filled", "_filled_before") - 1, "_again": F.col("date") == F.col("_day_before")}
    return rows.withColumns(steps).drop("_day", "_day_before", "_filled", "_filled_before")


def figures(kinds: dict, c: str, low: float, high: float, tolerance: float, nulls) -> list:
    """The aggregates of all checks, over rows with their steps."""
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        *(F.count_if(absent(x, kinds[x])).alias(f"null_{x}") for x in nulls),
        F.count_if(~absent(c, kinds[c]) & ~F.col(c).between(low, high)).alias("n_outside"),
        F.count_if("_again").alias("n_repeats"),
        F.count_if(F.col("_gap") > GAP_DAYS).alias("n_gaps"),
        F.count_if(F.col("_change") < -tolerance).alias("n_drops"),
    ]


def report(df: DataFrame, c: str, low: float, high: float, tolerance: float = DROP_TOLERANCE, nulls=None) -> DataFrame:
    """One row with the figures of all checks of a series of months."""
    return with_steps(df, c).agg(*figures(dict(df.dtypes), c, low, high, tolerance, nulls or ("date", c)))


@dataclass(frozen=True)
class Suite:
    """Column names, nulls, bounds, repeated dates, gaps and, with `fall`, falls of a series."""

    measure: str
    bounds: tuple
    check_names: Callable[[DataFrame], None]
    fall: bool

    @property
    def needed(self) -> tuple:
        return ("date", self.measure, "year", "month")

    def observed(self, df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
        """df, and its figures, which are there once df has been written: no second pass."""
        self.check_names(df)
        seen = Observation(name)
        rows = with_steps(df, self.measure).observe(seen, *figures(dict(df.dtypes), self.measure, *self.bounds, DROP_TOLERANCE, self.needed))
        return rows.select(*df.columns), seen

    def judge(self, found: dict, df: DataFrame) -> bool:
        """The first failure in order is raised; only a failing check looks for its rows in df."""
        if any(found[f"null_{x}"] for x in self.needed):
            check_no_nulls(df, self.needed)
        if found["n_outside"]:
            check_range(df, self.measure, *self.bounds)
        if found["n_repeats"]:
            check_no_duplicates(df)
        if found["n_rows"] < 2:
            warn("too few rows to check continuity")
        elif found["n_gaps"]:
            warn(f"{found['n_gaps']} gaps of more than {GAP_DAYS} days")
        if self.fall and found["n_drops"]:
            warn(f"{found['n_drops']} falls of more than {DROP_TOLERANCE:.0%}")
        return True

    def run(self, df: DataFrame) -> bool:
        self.check_names(df)
        return self.judge(report(df, self.measure, *self.bounds, nulls=self.needed).first().asDict(), df)


RATE_SUITE = Suite("unemployment_rate", RATE_BOUNDS, check_columns, False)
INDEX_SUITE = Suite("ipc_index", INDEX_BOUNDS, check_index_columns, True)


def run_rate_checks(df: DataFrame) -> bool:
    return RATE_SUITE.run(df)


def run_index_checks(df: DataFrame) -> bool:
    return INDEX_SUITE.run(df)
