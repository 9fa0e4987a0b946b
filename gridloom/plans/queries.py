"""The engine's operators on the driver's tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.config import LONG_MONTHS, SHORT_MONTHS, FlatProfile, IndexFeed, RateFeed
from gridloom.functions import series, text
from gridloom.operators import clean, layout, quality
from gridloom.sources import links

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    """Registers a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(c, digits: int = 4) -> Column:
    return F.round(c, digits) + F.lit(0.0)


def order_days(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("date", F.to_date("o_orderdate"))


def months_of_orders(spark, sf_dir) -> DataFrame:
    """date, year, month, value (in cents, so that sums don't depend on order)."""
    day = order_days(spark, sf_dir).select(F.year("date").alias("year"), F.month("date").alias("month"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    sums = day.groupBy("year", "month").agg(F.sum("cents").alias("cents"))
    return sums.select(text.month_start(F.col("year"), F.col("month")).alias("date"), "year", "month", (F.col("cents") / 100).alias("value"))


MONTHS_SQL = """m AS (
  SELECT make_date(y, mo, 1) AS date, CAST(y AS INTEGER) AS year, CAST(mo AS INTEGER) AS month, c / 100 AS value
  FROM (SELECT year(o_orderdate) AS y, month(o_orderdate) AS mo, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS c FROM orders GROUP BY 1, 2)
)"""


def month_case(column: str, months: dict) -> str:
    return "CASE " + column + " " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in months.items()) + " END"


def name_case(column: str, months: dict) -> str:
    return "CASE " + column + " " + " ".join(f"WHEN {v} THEN '{k}'" for k, v in months.items()) + " END"


@query(f"WITH {MONTHS_SQL} SELECT date, year, month, round(value, 2) AS value FROM m")
def monthly_series(spark, sf_dir):
    return months_of_orders(spark, sf_dir).select("date", "year", "month", rounded("value", 2).alias("value")).orderBy("date")


@query("SELECT CAST(o_orderdate AS DATE) AS date, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1")
def dedup_keep_first(spark, sf_dir):
    return series.keep_first(order_days(spark, sf_dir).select("date", "o_orderkey"), ["date"], ["o_orderkey"])


@query("SELECT CAST(o_orderdate AS DATE) AS date, o_orderkey FROM orders QUALIFY count(*) OVER (PARTITION BY CAST(o_orderdate AS DATE)) > 1")
def duplicate_dates(spark, sf_dir):
    return quality.duplicate_dates(order_days(spark, sf_dir).select("date", "o_orderkey"))


@query("SELECT CAST(o_orderdate AS DATE) AS date FROM orders GROUP BY 1 HAVING count(*) > 1 ORDER BY 1 LIMIT 5")
def duplicate_sample5(spark, sf_dir):
    return quality.duplicate_dates(order_days(spark, sf_dir).select("date")).distinct().orderBy("date").limit(5)


@query("SELECT " + ", ".join(f"count(*) - count({c}) AS {c}" for c in ("event_id", "ts", "user_id", "event_type", "value", "props")) + " FROM events")
def null_profile(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return quality.null_counts(events, ("event_id", "ts", "user_id", "event_type", "value", "props"))


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal NOT BETWEEN 0 AND 9000")
def range_violations(spark, sf_dir):
    return quality.outside(table(spark, sf_dir, "customer"), "c_acctbal", 0.0, 9000.0).select("c_custkey", "c_acctbal")


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal NOT BETWEEN 0 AND 9000 ORDER BY c_custkey LIMIT 5")
def range_violation_sample5(spark, sf_dir):
    return range_violations(spark, sf_dir).orderBy("c_custkey").limit(5)


@query("""
WITH d AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS date FROM orders),
g AS (SELECT *, date_diff('day', lag(date) OVER (PARTITION BY o_custkey ORDER BY date), date) AS gap_days FROM d)
SELECT o_custkey, date, CAST(gap_days AS INTEGER) AS gap_days FROM g WHERE gap_days > 62""")
def gap_check(spark, sf_dir):
    days = order_days(spark, sf_dir).select("o_custkey", "date").distinct()
    return quality.gaps(days, by=("o_custkey",))


@query(f"WITH {MONTHS_SQL} SELECT date, round(value / nullif(lag(value) OVER (ORDER BY date), 0) - 1, 4) + 0.0 AS change FROM m")
def pct_change(spark, sf_dir):
    return series.filled_change(months_of_orders(spark, sf_dir), "value", (), ("date",), "change").select("date", rounded("change").alias("change"))


@query(f"WITH {MONTHS_SQL}, c AS (SELECT date, value / nullif(lag(value) OVER (ORDER BY date), 0) - 1 AS change FROM m) SELECT date, round(change, 4) AS change FROM c WHERE change < -0.15")
def large_drops(spark, sf_dir):
    return quality.drops(months_of_orders(spark, sf_dir), "value").select("date", rounded("change").alias("change"))


@query("""
SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
  OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS filled FROM events""")
def ffill(spark, sf_dir):
    value = F.when(F.col("event_type") == "purchase", F.col("value"))
    return table(spark, sf_dir, "events").select("event_id", series.forward_fill(value, ("user_id",), ("ts", "event_id")).alias("filled"))


@query("""
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month, CAST(sum(l_quantity) AS DOUBLE) AS quantity
FROM lineitem GROUP BY 1, 2""")
def unpivot_year_month(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(F.month("l_shipdate").alias("month"), F.year("l_shipdate").alias("year"), "l_quantity")
    years = [r.year for r in items.select("year").distinct().orderBy("year").collect()]
    wide = items.groupBy("month").pivot("year", years).agg(F.sum("l_quantity"))
    long = wide.unpivot(["month"], [str(y) for y in years], "year", "quantity").dropna(subset=["quantity"])
    return long.select(F.col("year").cast("int").alias("year"), "month", "quantity")


@query(f"""
WITH l AS (SELECT o_orderkey, CASE WHEN o_orderkey % 12 = 0 THEN 'setiembre' ELSE {name_case('month(o_orderdate)', LONG_MONTHS)} END AS label FROM orders)
SELECT o_orderkey, label, CAST({month_case('label', LONG_MONTHS)} AS INTEGER) AS month FROM l WHERE label <> 'setiembre'""")
def valid_month_filter(spark, sf_dir):
    names = {v: k for k, v in LONG_MONTHS.items()}
    label = F.when(F.col("o_orderkey") % 12 == 0, "setiembre").otherwise(text.lookup(names, F.month("o_orderdate")))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", label.alias("label"))
    return orders.withColumn("month", text.lookup(LONG_MONTHS, text.key(F.col("label")))).where("month is not null")


NUMBER_SQL = r"'^[ \t\n\r\f\v]*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t\n\r\f\v]*$'"


@query(f"""
WITH t AS (SELECT doc_id, unnest(string_split(text, ' ')) AS token FROM documents)
SELECT doc_id, count(*) FILTER (regexp_matches(token, {NUMBER_SQL}) AND isfinite(TRY_CAST(token AS DOUBLE))) AS numbers,
  max(CASE WHEN regexp_matches(token, {NUMBER_SQL}) AND isfinite(TRY_CAST(token AS DOUBLE)) THEN TRY_CAST(token AS DOUBLE) END) AS largest
FROM t GROUP BY doc_id""")
def numeric_coerce(spark, sf_dir):
    tokens = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", " ")).alias("token"))
    value = text.to_number(F.col("token"))
    return tokens.select("doc_id", value.alias("v")).groupBy("doc_id").agg(F.count("v").alias("numbers"), F.max("v").alias("largest"))


@query("""
WITH t AS (SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || '-' || lpad(CAST(CASE WHEN o_orderkey % 10 = 0 THEN 13 ELSE month(o_orderdate) END AS VARCHAR), 2, '0') || '-01' AS stamp FROM orders)
SELECT o_orderkey, CAST(try_strptime(stamp, '%Y-%m-%d') AS DATE) AS date, CAST(year(try_strptime(stamp, '%Y-%m-%d')) AS INTEGER) AS year FROM t""")
def date_parse(spark, sf_dir):
    month = F.when(F.col("o_orderkey") % 10 == 0, 13).otherwise(F.month("o_orderdate"))
    stamp = F.concat_ws("-", F.year("o_orderdate").cast("string"), F.lpad(month.cast("string"), 2, "0"), F.lit("01"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.try_to_date(stamp, "yyyy-MM-dd").alias("date")).withColumn("year", F.year("date"))


def document_grid(spark, sf_dir) -> DataFrame:
    """Each document as a sheet: lines are rows, words are cells."""
    lines = table(spark, sf_dir, "documents").select(F.col("source").alias("file"), F.col("doc_id").cast("string").alias("sheet"), F.col("doc_id").alias("sheet_idx"), F.posexplode(F.split("text", "\n")).alias("row_idx", "line"))
    return lines.select("file", "sheet", "sheet_idx", "row_idx", F.posexplode(F.split("line", " ")).alias("col_idx", "raw"))


GRID_SQL = """r AS (
  SELECT source AS file, CAST(doc_id AS VARCHAR) AS sheet, doc_id AS sheet_idx, CAST(i - 1 AS INTEGER) AS row_idx, lower(line) AS t
  FROM (SELECT source, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)
)"""
WANTED = ("the", "tion", "ung", "que", "mente")
SCORE_SQL = " + ".join(f"CAST(contains(t, '{k}') AS INTEGER)" for k in WANTED)


@query(f"WITH {GRID_SQL}, s AS (SELECT *, {SCORE_SQL} AS score FROM r WHERE row_idx < 30) SELECT file, sheet, CASE WHEN max(score) > 0 THEN arg_max(row_idx, [score, -row_idx]) ELSE 0 END AS header_row FROM s GROUP BY file, sheet")
def row_arg_max(spark, sf_dir):
    return layout.header_row(document_grid(spark, sf_dir), WANTED)


@query(f"WITH {GRID_SQL} SELECT file, sheet, min(row_idx) AS row_idx FROM r WHERE regexp_matches(t, '[0-9]{{4}}') GROUP BY file, sheet")
def first_match_row(spark, sf_dir):
    return layout.first_row(document_grid(spark, sf_dir), text.matches(F.col("raw"), r"\d{4}"))


@query(f"""
WITH {GRID_SQL}, c AS (SELECT file, sheet, row_idx, unnest(string_split(t, ' ')) AS w FROM r),
n AS (SELECT file, sheet, row_idx FROM c WHERE w IN ('the', 'of', 'and', 'die', 'und', 'que', 'la', 'de') GROUP BY ALL HAVING count(DISTINCT w) >= 2)
SELECT file, sheet, min(row_idx) AS row_idx FROM n GROUP BY file, sheet""")
def distinct_match_count(spark, sf_dir):
    return layout.first_row_of_words(document_grid(spark, sf_dir), ("the", "of", "and", "die", "und", "que", "la", "de"), 2)


SHEET_SCORE_SQL = " + ".join(f"CAST(contains(t, '{k}') AS INTEGER) + 2 * CAST(contains(sheet, '{k}') AS INTEGER)" for k in (*WANTED, "7"))


@query(f"WITH {GRID_SQL}, b AS (SELECT file, sheet, sheet_idx, string_agg(t, ' ' ORDER BY row_idx) FILTER (row_idx < 40) AS t FROM r GROUP BY ALL), s AS (SELECT *, {SHEET_SCORE_SQL} AS score FROM b) SELECT file, arg_max(sheet, [score, -sheet_idx]) AS sheet, max(score) AS score FROM s GROUP BY file")
def best_sheet(spark, sf_dir):
    return layout.best_sheet(document_grid(spark, sf_dir), (*WANTED, "7"))


HREFS_SQL = """a AS (
  SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*?href\\s*=\\s*["''][^"'']*["''][^>]*>.*?</a>')) AS a,
         generate_subscripts(regexp_extract_all(html, '(?is)<a\\s[^>]*?href\\s*=\\s*["''][^"'']*["''][^>]*>.*?</a>'), 1) - 1 AS ordinal,
         regexp_extract(url, '^([^/]*//[^/]*)', 1) AS host
  FROM pages
), h AS (
  SELECT page_id, CAST(ordinal AS INTEGER) AS ordinal, host, replace(regexp_extract(a, '(?is)^<a\\s[^>]*?href\\s*=\\s*["'']([^"'']*)["'']', 1), '&amp;', '&') AS href FROM a
)"""


def page_links(spark, sf_dir) -> DataFrame:
    return links.extract_links(table(spark, sf_dir, "pages"), F.col("url"), "^/", keys=("page_id",))


@query(f"WITH {HREFS_SQL} SELECT page_id, ordinal, host || href AS url, href FROM h WHERE starts_with(href, '/')")
def link_extract(spark, sf_dir):
    return page_links(spark, sf_dir).select("page_id", "ordinal", "url", "href")


@query(f"WITH {HREFS_SQL} SELECT page_id, arg_min(href, ordinal) AS href FROM h WHERE starts_with(href, '/') AND regexp_matches(href, '(?i)th') GROUP BY page_id")
def target_link(spark, sf_dir):
    return links.target(page_links(spark, sf_dir), "th", keys=("page_id",)).select("page_id", "href")


REFERENCES = ("../up.html", "./a/./b/../c?x=1#y", "?page=2", "#top", "//cdn.example.org/a/b", "/root/../../r//s/.", "d//e/..", "", "HTTPS://other.example.org/../z", "mailto:a@b.c", "../../../g;p")
PATH_SQL = """CASE WHEN host <> '' THEN path WHEN path = '' THEN folder ELSE coalesce(nullif(array_to_string(CASE WHEN s[-1] IN ('.', '..') THEN list_append(kept, '') ELSE kept END, '/'), ''), '/') END"""


@query(rf"""
WITH p AS (
  SELECT page_id, url AS base, CAST(n - 1 AS INTEGER) AS n, ref, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) AS scheme, regexp_extract(url, '^[^/?#]*//([^/?#]*)', 1) AS place,
    regexp_extract(url, '^[^/?#]*//[^/?#]*([^?#]*)', 1) AS folder, regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS asked,
    lower(regexp_extract(ref, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) AS own, regexp_extract(ref, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1) AS host,
    regexp_extract(ref, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1) AS path, regexp_extract(ref, '\?([^#]*)', 1) AS query, regexp_extract(ref, '#(.*)$', 1) AS fragment
  FROM pages, (SELECT unnest({list(REFERENCES)}) AS ref, generate_subscripts({list(REFERENCES)}, 1) AS n)
), q AS (
  SELECT *, CASE WHEN starts_with(path, '/') THEN string_split(path, '/') ELSE list_concat(list_slice(string_split(folder, '/'), 1, greatest(len(string_split(folder, '/')) - 1, 1)), string_split(path, '/')) END AS raw FROM p
), i AS (
  SELECT *, CASE WHEN starts_with(path, '/') THEN raw ELSE list_filter(raw, lambda x, i: x <> '' OR i = 1 OR i = len(raw)) END AS s FROM q
), k AS (
  SELECT *, list_reduce(list_prepend(CAST([] AS VARCHAR[]), list_transform(s, lambda x: [x])),
    lambda acc, x: CASE WHEN x[1] = '..' THEN list_slice(acc, 1, len(acc) - 1) WHEN x[1] = '.' THEN acc ELSE list_concat(acc, x) END) AS kept FROM i
), f AS (
  SELECT *, CASE WHEN host <> '' THEN host ELSE place END AS site, {PATH_SQL} AS final, CASE WHEN host = '' AND path = '' AND query = '' THEN asked ELSE query END AS wanted FROM k
)
SELECT page_id, n, CASE WHEN ref = '' THEN base WHEN own <> '' AND own <> scheme THEN ref
  ELSE scheme || '://' || site || CASE WHEN final <> '' AND NOT starts_with(final, '/') THEN '/' ELSE '' END || final
    || CASE WHEN wanted <> '' THEN '?' || wanted ELSE '' END || CASE WHEN fragment <> '' THEN '#' || fragment ELSE '' END END AS url FROM f""")
def link_resolve(spark, sf_dir):
    """References of every kind, resolved on the address of each page."""
    refs = table(spark, sf_dir, "pages").select("page_id", "url", F.posexplode(F.array(*map(F.lit, REFERENCES))).alias("n", "ref"))
    return refs.select("page_id", "n", links.absolute(F.col("url"), F.col("ref")).alias("url"))


def order_hrefs(spark, sf_dir) -> DataFrame:
    names = {v: k for k, v in SHORT_MONTHS.items()}
    month = F.when(F.col("o_orderkey") % 7 == 0, "sept").otherwise(text.lookup(names, F.month("o_orderdate")))
    href = F.concat(F.lit("/files/anex-GEIH-"), month, F.year("o_orderdate").cast("string"), F.lit(".xlsx"))
    return table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("ordinal"), href.alias("href"), href.alias("url"), F.lit("").alias("text"))


PERIODS_SQL = f"""x AS (
  SELECT o_custkey, o_orderkey, '/files/anex-GEIH-' || CASE WHEN o_orderkey % 7 = 0 THEN 'sept' ELSE {name_case('month(o_orderdate)', SHORT_MONTHS)} END || CAST(year(o_orderdate) AS VARCHAR) || '.xlsx' AS href FROM orders
), p AS (
  SELECT *, CAST(regexp_extract(href, '(?i)([a-z]{{3}})([0-9]{{4}})\\.xlsx$', 2) AS INTEGER) AS y,
         {month_case("lower(regexp_extract(href, '(?i)([a-z]{3})([0-9]{4})\\.xlsx$', 1))", SHORT_MONTHS)} AS m FROM x
)"""


@query(f"WITH {PERIODS_SQL} SELECT o_orderkey AS ordinal, CASE WHEN m IS NOT NULL THEN y END AS year, CAST(m AS INTEGER) AS month FROM p")
def period_parse(spark, sf_dir):
    return order_hrefs(spark, sf_dir).select("ordinal", links.period(F.col("href")).alias("p")).select("ordinal", "p.year", "p.month")


@query(f"""
WITH {PERIODS_SQL}, k AS (SELECT *, CASE WHEN m IS NULL THEN 0 ELSE y END AS y0, coalesce(m, 0) AS m0 FROM p)
SELECT o_custkey, arg_max(href, [y0, m0, -o_orderkey]) AS newest_strict, arg_max(href, [y, m0, -o_orderkey]) AS newest_by_year FROM k GROUP BY o_custkey""")
def period_sort_variants(spark, sf_dir):
    hrefs = order_hrefs(spark, sf_dir)
    return links.newest_variants(hrefs, ("o_custkey",)).select("o_custkey", F.col("strict.href").alias("newest_strict"), F.col("by_year.href").alias("newest_by_year"))


BLANK_SQL = r"[\s\v\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


@query(rf"SELECT doc_id, regexp_replace(regexp_replace(lower(regexp_replace(text, '^{BLANK_SQL}|{BLANK_SQL}$', '', 'g')), '{BLANK_SQL}', '_', 'g'), '[^\p{{L}}\p{{N}}_]', '', 'g') AS name FROM documents")
def header_normalise(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.normal_header(F.col("text")).alias("name"))


@query("""
SELECT count(o_totalprice) AS count, round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS std, min(o_totalprice) AS min,
  round(quantile_cont(o_totalprice, 0.25), 4) AS q25, round(quantile_cont(o_totalprice, 0.5), 4) AS q50, round(quantile_cont(o_totalprice, 0.75), 4) AS q75, max(o_totalprice) AS max FROM orders""")
def describe_measure(spark, sf_dir):
    one = series.describe(table(spark, sf_dir, "orders"), "o_totalprice")
    return one.select("count", *(rounded(c).alias(c) for c in ("mean", "std")), "min", *(rounded(c).alias(c) for c in ("q25", "q50", "q75")), "max")


@query("SELECT event_id, CASE WHEN event_type <> 'click' THEN value END AS value FROM events WHERE event_type <> 'click' AND value IS NOT NULL")
def drop_null_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") != "click", F.col("value")).alias("value"))
    return events.dropna(subset=["value"])


CONTRACT = ("k", "user_id", "value")


@query("""
WITH e AS (SELECT event_type, list_sort(list_concat(json_keys(props), CASE WHEN value IS NOT NULL THEN ['value'] ELSE [] END)) AS names FROM events),
x AS (SELECT event_type, list_sort(list_filter(['k', 'user_id', 'value'], lambda c: NOT list_contains(coalesce(names, []), c))) AS missing,
  list_filter(coalesce(names, []), lambda c: NOT list_contains(['k', 'user_id', 'value'], c)) AS extra FROM e)
SELECT event_type, missing, extra, len(missing) = 0 AS complete, CAST(3 - len(missing) AS INTEGER) AS shared, count(*) AS events FROM x GROUP BY ALL""")
def column_contract(spark, sf_dir):
    """The names that each event bears, against those expected: missing, extra, all there, how many shared."""
    own = F.concat(F.coalesce(F.json_object_keys("props"), F.array().cast("array<string>")), F.when(F.col("value").isNotNull(), F.array(F.lit("value"))).otherwise(F.array().cast("array<string>")))
    named = table(spark, sf_dir, "events").select("event_type", F.array_sort(own).alias("names"))
    missing, extra, complete, shared = quality.contract(F.array(*map(F.lit, CONTRACT)), F.col("names"))
    found = named.select("event_type", missing.alias("missing"), extra.alias("extra"), complete.alias("complete"), shared.alias("shared"))
    return found.groupBy(*found.columns).agg(F.count("*").alias("events"))


@query(f"""
WITH {MONTHS_SQL}, w AS (SELECT *, date_diff('day', lag(date) OVER (ORDER BY date), date) AS gap, value / nullif(lag(value) OVER (ORDER BY date), 0) - 1 AS change FROM m)
SELECT count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date, count(*) - count(date) AS null_date, count(*) - count(value) AS null_value,
  count(*) FILTER (value NOT BETWEEN 1000000 AND 30000000) AS n_outside, count(date) - count(DISTINCT date) AS n_repeats,
  count(*) FILTER (gap > 62) AS n_gaps, count(*) FILTER (change < -0.15) AS n_drops FROM w""")
def quality_report(spark, sf_dir):
    return quality.report(months_of_orders(spark, sf_dir), "value", 1e6, 3e7)


@query("""
SELECT make_date(y, 1, 1) AS date, CAST(y AS INTEGER) AS year, CAST(1 AS INTEGER) AS month, CAST(n AS DOUBLE) / 1000 AS unemployment_rate, 'DANE' AS source, '2026-01-01' AS download_date
FROM (SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1)""")
def flat_csv_clean(spark, sf_dir):
    years = order_days(spark, sf_dir).groupBy(F.year("date").alias(" Year")).agg((F.count("*") / 1000).cast("string").alias("Unemployed_Percent "))
    return clean.clean_flat(years, FlatProfile("orders", "orders.csv"), "2026-01-01")


def text_cells(rows: DataFrame, *cells) -> DataFrame:
    """A grid from rows of keys: each of `cells` is (row_idx, col_idx, raw)."""
    made = F.explode(F.array(*(F.struct(r.cast("int").alias("row_idx"), c.cast("int").alias("col_idx"), v.cast("string").alias("raw")) for r, c, v in cells)))
    return rows.select("file", "sheet", F.lit(0).alias("sheet_idx"), made.alias("x")).select("file", "sheet", "sheet_idx", "x.*")


def quantities(spark, sf_dir, file: Column) -> DataFrame:
    """file, year, month, value: lines shipped."""
    items = table(spark, sf_dir, "lineitem").select(file.alias("file"), F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"))
    return items.groupBy("file", "year", "month").agg(F.count("*").alias("value"))


FLAGS_SQL = "SELECT l_returnflag AS file, year(l_shipdate) AS y, month(l_shipdate) AS mo, count(*) AS n FROM lineitem GROUP BY ALL"


@query(f"SELECT file, make_date(y, mo, 1) AS date, CAST(y AS INTEGER) AS year, CAST(mo AS INTEGER) AS month, CAST(n AS DOUBLE) AS unemployment_rate, 'DANE' AS source, '2026-01-01' AS download_date FROM ({FLAGS_SQL})")
def concept_pivot_parse(spark, sf_dir):
    names = {v: k for k, v in SHORT_MONTHS.items()}
    data = quantities(spark, sf_dir, F.col("l_returnflag")).withColumn("sheet", F.lit("Total nacional"))
    first = data.groupBy("file", "year").agg(F.min("month").alias("month")).withColumn("lead", F.lit(True))
    column = (F.col("year") - 1980) * 12 + F.col("month")
    cells = text_cells(data.join(first, ["file", "year", "month"], "left"), (F.lit(11), column, F.when(F.col("lead"), F.col("year"))), (F.lit(12), column, F.initcap(text.lookup(names, F.col("month")))), (F.lit(16), column, F.col("value")))
    label = text_cells(data.select("file", "sheet").distinct(), (F.lit(16), F.lit(0), F.lit("Tasa de Desocupación (TD)")))
    return clean.clean_rate(cells.where("raw is not null").unionByName(label), "2026-01-01")


@query(f"SELECT file, make_date(y, mo, 1) AS date, CAST(y AS INTEGER) AS year, CAST(mo AS INTEGER) AS month, CAST(n AS DOUBLE) AS ipc_index, 'DANE' AS source, '2026-01-01' AS download_date FROM ({FLAGS_SQL})")
def month_year_parse(spark, sf_dir):
    names = {v: k for k, v in LONG_MONTHS.items()}
    data = quantities(spark, sf_dir, F.col("l_returnflag")).withColumn("sheet", F.lit("IndicesIPC"))
    column, row = F.col("year") - 1980, 8 + F.col("month")
    # all cells from one pass over the data; those of the header and the months come once for each value
    head = (F.lit(8), F.lit(0), F.lit("Mes")), (F.lit(8), column, F.col("year")), (row, F.lit(0), F.initcap(text.lookup(names, F.col("month"))))
    cells = text_cells(data, (row, column, F.col("value")), *head).distinct()
    return clean.clean_index(cells, "2026-01-01", IndexFeed(header_row=None))


def order_sheets(spark, sf_dir) -> DataFrame:
    """A grid of years (some written 2001.0) and month names, 50 sheets, with rows past every scan bound."""
    orders, names = table(spark, sf_dir, "orders"), {v: k for k, v in SHORT_MONTHS.items()}
    key, year = F.col("o_orderkey"), F.year("o_orderdate").cast("string")
    raw = F.when(key % 2 == 0, F.initcap(text.lookup(names, F.month("o_orderdate")))).when(key % 5 == 0, F.concat(year, F.lit(".0"))).otherwise(year)
    row = F.dayofmonth("o_orderdate") + F.when(key % 3 == 0, 20).otherwise(0)
    return orders.select(F.col("o_orderstatus").alias("file"), (F.col("o_custkey") % 50).cast("string").alias("sheet"), F.lit(0).alias("sheet_idx"), row.alias("row_idx"), key.cast("int").alias("col_idx"), raw.alias("raw"))


SHEETS_SQL = f"""g AS (
  SELECT o_orderstatus AS file, CAST(o_custkey % 50 AS VARCHAR) AS sheet, CAST(day(o_orderdate) + CASE WHEN o_orderkey % 3 = 0 THEN 20 ELSE 0 END AS INTEGER) AS row_idx,
    CASE WHEN o_orderkey % 2 = 0 THEN {name_case('month(o_orderdate)', SHORT_MONTHS)} END AS mon, o_orderkey % 2 <> 0 AS is_year FROM orders
), n AS (
  SELECT file, sheet, row_idx, count(*) AS years FROM g WHERE is_year AND row_idx < 30 GROUP BY ALL
), y AS (
  SELECT s.file, s.sheet, coalesce(arg_max(n.row_idx, [n.years, -n.row_idx]), 0) AS year_row FROM (SELECT DISTINCT file, sheet FROM g) s LEFT JOIN n ON n.file = s.file AND n.sheet = s.sheet GROUP BY ALL
)"""


@query(f"WITH {SHEETS_SQL} SELECT file, sheet, year_row FROM y")
def year_row(spark, sf_dir):
    return layout.year_row(order_sheets(spark, sf_dir))


@query(f"""
WITH {SHEETS_SQL}, d AS (
  SELECT g.file, g.sheet, g.row_idx FROM g JOIN y ON g.file = y.file AND g.sheet = y.sheet
  WHERE g.row_idx > year_row AND g.row_idx <= year_row + 5 AND mon IS NOT NULL GROUP BY ALL HAVING count(DISTINCT mon) >= 6
), f AS (SELECT file, sheet, min(row_idx) AS month_row FROM d GROUP BY ALL)
SELECT y.file, y.sheet, year_row, coalesce(month_row, year_row + 1) AS month_row FROM y LEFT JOIN f ON f.file = y.file AND f.sheet = y.sheet""")
def month_row(spark, sf_dir):
    cells = order_sheets(spark, sf_dir)
    return layout.month_row(cells, layout.year_row(cells))


FIELDS = {"first": ("^th", "ung$"), "second": ("e", "^a"), "third": ("^zzz",)}


@query(r"""
WITH h AS (
  SELECT file, sheet, CAST(c - 1 AS INTEGER) AS col_idx, regexp_replace(w, '[^\p{L}\p{N}_]', '', 'g') AS name
  FROM (SELECT file, sheet, unnest(string_split(t, ' ')) AS w, generate_subscripts(string_split(t, ' '), 1) AS c FROM r WHERE row_idx = 0)
), a AS (SELECT file, sheet, min(col_idx) AS col_idx FROM h WHERE regexp_matches(name, '^th|ung$') GROUP BY ALL),
b AS (SELECT h.file, h.sheet, min(h.col_idx) AS col_idx FROM h LEFT JOIN a ON a.file = h.file AND a.sheet = h.sheet
  WHERE regexp_matches(name, 'e|^a') AND h.col_idx IS DISTINCT FROM a.col_idx GROUP BY ALL)
SELECT file, sheet, 'first' AS field, col_idx FROM a UNION ALL SELECT file, sheet, 'second', col_idx FROM b""".replace("WITH h", f"WITH {GRID_SQL}, h", 1))
def column_auto_map(spark, sf_dir):
    cells = document_grid(spark, sf_dir)
    return layout.field_columns(cells, cells.select("file", "sheet").distinct().withColumn("header_row", F.lit(0)), FIELDS)


@query(f"SELECT file, make_date(y, mo, 1) AS date, CAST(y AS INTEGER) AS year, CAST(mo AS INTEGER) AS month, CAST(n AS DOUBLE) AS unemployment_rate, 'DANE' AS source, '2026-01-01' AS download_date FROM ({FLAGS_SQL})")
def flat_cells_clean(spark, sf_dir):
    data = quantities(spark, sf_dir, F.col("l_returnflag")).withColumn("sheet", F.lit("Tasa"))
    row = 10 + (F.col("year") - 1980) * 12 + F.col("month")
    body = text_cells(data, (row, F.lit(1), F.col("year")), (row, F.lit(2), F.col("month")), (row, F.lit(4), F.col("value")))
    sheets = data.select("file", "sheet").distinct()
    # a title, a sheet that is not meant, and a header that stands in another row of each file
    at = F.ascii("file") % 4 + 3
    head = text_cells(sheets, (F.lit(0), F.lit(0), F.lit("Total")), (at, F.lit(1), F.lit(" Año ")), (at, F.lit(2), F.lit("MES")), (at, F.lit(4), F.lit("Tasa de desempleo")))
    other = text_cells(sheets.withColumn("sheet", F.lit("Notas")), (F.lit(0), F.lit(0), F.lit("Año"))).withColumn("sheet_idx", F.lit(1))
    return clean.clean_flat(body.unionByName(head).unionByName(other), FlatProfile("lines", "lines.xlsx", "xlsx"), "2026-01-01")


@query(f"""
SELECT file, make_date(y, mo, 1) AS date, CAST(y AS INTEGER) AS year, CAST(mo AS INTEGER) AS month, CAST(n AS DOUBLE) AS unemployment_rate, 'DANE' AS source, '2026-01-01' AS download_date FROM ({FLAGS_SQL})""")
def pivot_layout_parse(spark, sf_dir):
    """The rate feed without pinned rows: years, months and the label are found."""
    names = {v: k for k, v in SHORT_MONTHS.items()}
    data = quantities(spark, sf_dir, F.col("l_returnflag")).withColumn("sheet", F.lit("Total nacional"))
    column, at = (F.col("year") - 1980) * 12 + F.col("month"), F.ascii("file") % 5 + 6
    cells = text_cells(data, (at, column, F.col("year")), (at + 2, column, F.initcap(text.lookup(names, F.col("month")))), (at + 9, column, F.col("value")))
    label = text_cells(data.select("file", "sheet").distinct(), (at + 4, F.lit(0), F.lit("Población")), (at + 9, F.lit(0), F.lit(" TASA DE DESOCUPACIÓN (TD)")))
    return clean.clean_rate(cells.unionByName(label), "2026-01-01", RateFeed(year_row=None, month_row=None))
