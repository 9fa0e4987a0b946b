"""Links of landed pages, their periods, and the choice of the newest release."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.config import PERIOD, SHORT_MONTHS
from gridloom.functions.text import lookup, matches
from gridloom.sources.html import with_anchors

# The parts of a reference (RFC 3986, appendix B), with a scheme that begins with a letter.
REFERENCE = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
#: Schemes of addresses with a host, whose references may be relative.
HIERARCHICAL = ("http", "https", "ftp", "ws", "wss", "sftp")


def part(c: Column, n: int) -> Column:
    """A part of a reference; empty where it is absent."""
    return F.regexp_extract(c, f"(?s){REFERENCE}", n)


def without_dots(segments: Column) -> Column:
    """The path of these segments without `.` and `..`; steps above the root are none."""
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).when(s == ".", acc).otherwise(F.array_append(acc, s)),
    )
    # a path that ends in dots names the folder
    path = F.array_join(F.when(F.element_at(segments, -1).isin(".", ".."), F.array_append(kept, F.lit(""))).otherwise(kept), "/")
    return F.when(path == "", F.lit("/")).otherwise(path)


def absolute(base: Column, href: Column) -> Column:
    """href resolved on its base (RFC 3986): other schemes stay as they are, other hosts keep their path, dots are removed, a
    reference that is only a query or a fragment keeps the base's path. Blanks before it and line ends inside are not part of it."""
    ref = F.regexp_replace(F.regexp_replace(href, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    scheme, host, path, query, fragment = (part(ref, n) for n in range(1, 6))
    own, place, folder = F.lower(part(base, 1)), part(base, 2), part(base, 3)
    foreign = ((scheme != "") & (F.lower(scheme) != own)) | ~own.isin(*HIERARCHICAL)
    segments = F.split(path, "/")
    above = F.split(F.regexp_replace(folder, "[^/]*$", ""), "/")
    above = F.when(F.size(above) > 1, F.slice(above, F.lit(1), F.size(above) - 1)).otherwise(F.array(F.lit("")))
    merged = F.concat(above, segments)
    inner = F.filter(merged, lambda s, i: (s != "") | (i == 0) | (i == F.size(merged) - 1))
    final = F.when(host != "", path).when(path == "", folder).otherwise(without_dots(F.when(path.startswith("/"), segments).otherwise(inner)))
    asked = F.when((host == "") & (path == "") & (query == ""), part(base, 4)).otherwise(query)
    at = F.when(host != "", host).otherwise(place)
    rooted = F.when((at != "") & (final != "") & ~final.startswith("/"), F.concat(F.lit("/"), final)).otherwise(final)
    whole = F.concat(own, F.lit("://"), at, rooted, F.when(asked != "", F.concat(F.lit("?"), asked)).otherwise(""), F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""))
    return F.when(href == "", base).when(foreign, href).otherwise(whole)


def extract_links(pages: DataFrame, base: Column, pattern: str, html: str = "html", keys=()) -> DataFrame:
    """keys, ordinal, url, text, href of each anchor whose href matches, in document order, repeated ones too.

    ordinal counts the anchors that have an href. Null and empty pages have no links."""
    found = with_anchors(pages.select(*(F.col(k) for k in keys), base.alias("_base"), F.col(html).alias("_html")), "_html", "_anchors")
    linked = found.select(*keys, "_base", F.explode("_anchors").alias("_a")).where(matches(F.col("_a.href"), pattern))
    return linked.select(*keys, "_a.ordinal", absolute(F.col("_base"), F.col("_a.href")).alias("url"), "_a.text", "_a.href")


def period(href: Column, months: dict = SHORT_MONTHS) -> Column:
    """struct(year, month) of `...mmmYYYY.xlsx`, or null where the form or the month is unknown."""
    month = lookup(months, F.lower(F.regexp_extract(href, f"(?i){PERIOD}", 1)))
    year = F.regexp_extract(href, f"(?i){PERIOD}", 2).try_cast("int")
    return F.when(month.isNotNull() & year.isNotNull(), F.struct(year.alias("year"), month.alias("month")))


def period_key(href: Column, keep_year: bool, months: dict = SHORT_MONTHS) -> Column:
    """The sort key: an unknown month counts as (0, 0), or with `keep_year` as (year, 0)."""
    year = F.coalesce(F.regexp_extract(href, f"(?i){PERIOD}", 2).try_cast("int"), F.lit(0))
    month = lookup(months, F.lower(F.regexp_extract(href, f"(?i){PERIOD}", 1)), 0)
    return F.struct((year if keep_year else F.when(month > 0, year).otherwise(0)).alias("year"), month.alias("month"))


def newest_first(links: DataFrame, keep_year: bool = False, keys=()) -> DataFrame:
    """Links with their `rank`: newest first, the earlier in the page first among equals."""
    order = W.partitionBy(*keys).orderBy(period_key(F.col("href"), keep_year).desc(), "ordinal")
    return links.withColumn("rank", F.row_number().over(order))


def best_link(keep_year: bool) -> Column:
    """An aggregate: the newest link, the earlier in the page among equals."""
    k = period_key(F.col("href"), keep_year)
    return F.max_by(F.struct("url", "text", "href"), F.struct(k.alias("k"), (-F.col("ordinal")).alias("o")))


def newest(links: DataFrame, keep_year: bool = False, keys=()) -> DataFrame:
    """The newest link of each page (or of all)."""
    return links.groupBy(*keys).agg(best_link(keep_year).alias("b")).where("b is not null").select(*keys, "b.url", "b.text", "b.href")


def newest_variants(links: DataFrame, keys=()) -> DataFrame:
    """`strict` and `by_year`: the newest link of each page by either key for unknown months, in one pass."""
    return links.groupBy(*keys).agg(best_link(False).alias("strict"), best_link(True).alias("by_year"))


def target(links: DataFrame, pattern: str, keys=()) -> DataFrame:
    """Among the links that match, the newest."""
    return newest(links.where(matches(F.col("href"), pattern)), True, keys)


def only(links: DataFrame, found: DataFrame, what: str):
    """The one chosen link, or an error that lists what there was."""
    row = found.first()
    if row is None:
        there = [r.href for r in links.select("href").limit(20).collect()]
        raise ValueError(f"no link for {what}; there are {there}")
    return row
