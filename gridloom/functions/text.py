"""Column functions that keep the meaning of lenient text handling on Spark."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space in any script, and the four separators that count as such.
BLANK = r"[\s\x1c-\x1f]"
NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"(?U)^{BLANK}+|{BLANK}+$", "")


def key(c: Column) -> Column:
    """The form in which labels are compared: stripped and in lower case."""
    return F.lower(strip(c))


def matches(c: Column, pattern: str) -> Column:
    """Search without regard to case, accented letters included; null where c is null."""
    return c.rlike(f"(?iu){pattern}")


def to_number(c: Column) -> Column:
    """A finite number, or null: no suffixes, no separators, NaN and overflow are missing."""
    text = c.cast("string")
    value = F.when(text.rlike(NUMBER), F.regexp_replace(text, r"^\s+|\s+$", "").try_cast("double"))
    return F.when(F.abs(value) <= F.lit(1.7976931348623157e308), value)


def to_whole(c: Column) -> Column:
    """The number cut to an int, or null."""
    return to_number(c).try_cast("int")


def normal_header(c: Column) -> Column:
    """Stripped, lower case, white space as one underscore, only letters, digits and underscores."""
    return F.regexp_replace(F.regexp_replace(key(c), f"(?U){BLANK}+", "_"), r"[^\p{L}\p{N}_]", "")


def normal_name(name: str) -> str:
    """normal_header for a column name on the driver."""
    return re.sub(r"[^\w]", "", re.sub(r"\s+", "_", str(name).strip().lower()))


def lookup(table: dict, c: Column, default=None) -> Column:
    """The value of a small fixed table, or the default (null)."""
    found = F.try_element_at(F.create_map(*(F.lit(v) for kv in table.items() for v in kv)), c)
    return found if default is None else F.coalesce(found, F.lit(default))


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))
