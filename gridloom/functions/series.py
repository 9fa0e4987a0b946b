"""Order-dependent functions over series: partitioned by series, or, for one series, by parts of its order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Values from which the bounds of parts are taken, about; only how even parts are depends on it.
SAMPLE = 10_000


def over(by, order) -> W:
    return W.partitionBy(*by).orderBy(*order)


def forward_fill(c: Column, by, order) -> Column:
    """The last value that is not null, up to this row."""
    return F.last(c, ignorenulls=True).over(over(by, order).rowsBetween(W.unboundedPreceding, 0))


def gap_days(date: Column, by, order) -> Column:
    return F.datediff(date, F.lag(date).over(over(by, order)))


def change(c: Column, by, order) -> Column:
    """c over its predecessor, less 1; nulls take the value before them; null where the predecessor is 0."""
    return F.try_divide(c, F.lag(c).over(over(by, order))) - 1


def filled_change(df: DataFrame, c: str, by, order, name: str) -> DataFrame:
    """df with `name`: the change of c, nulls in which take the value before them, against the row before."""
    if not by:
        return in_parts(df, order[0], {"_filled": F.col(c)}).withColumn(name, F.try_divide("_filled", "_filled_before") - 1).drop("_filled", "_filled_before")
    filled = df.withColumn("_filled", forward_fill(F.col(c), by, order))
    return filled.withColumn(name, change(F.col("_filled"), by, order)).drop("_filled")


def with_gaps(df: DataFrame, by, name: str) -> DataFrame:
    """df with `name`: the days since the row before."""
    if not by:
        return in_parts(df, "date", {"_day": F.col("date")}).withColumn(name, F.datediff("_day", "_day_before")).drop("_day", "_day_before")
    return df.withColumn(name, gap_days(F.col("date"), by, ("date",)))


def with_parts(df: DataFrame, order: str, name: str) -> DataFrame:
    """df with the number of each row's part: parts follow each other in the order of a column, and equal values share one; as
    many as shuffles have partitions.

    Their bounds stand evenly among those values of the column whose hashes fall into a share of about SAMPLE rows. They are a subquery of
    the plan and the same whenever it is evaluated, whatever the order of rows, as rows are dealt more than once in a plan."""
    n = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    value = as_number(df, order)
    rows = df.agg(F.count(value)).scalar()
    some = df.select(value.alias("v"), F.greatest(F.lit(1), F.floor(rows / SAMPLE)).alias("m")).where("v is not null and pmod(xxhash64(v), m) = 0")
    found = some.agg(F.sort_array(F.collect_set("v")).alias("s"))
    evenly = F.transform(F.sequence(F.lit(1), F.lit(n - 1)), lambda i: F.get("s", F.floor(i * F.size("s") / n).cast("int")))
    bounds = found.select(F.array_distinct(evenly).alias("b")).scalar()
    bounded = df.withColumn("_bounds", bounds)
    return bounded.withColumn(name, F.coalesce(F.size(F.filter("_bounds", lambda b: b < value)), F.lit(0))).drop("_bounds")


def as_number(df: DataFrame, c: str) -> Column:
    """A column of numbers, dates or times as numbers in the same order."""
    kind = dict(df.dtypes)[c]
    if kind == "date":
        return F.unix_date(c)
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(c).cast("timestamp"))
    return F.col(c)


def in_parts(df: DataFrame, order: str, columns: dict[str, Column]) -> DataFrame:
    """df with each of `columns` filled forward from the rows before it, and beside it, as `..._before`, that of the row before.

    All rows are one series in the order of a column, but no task holds it: windows run within parts, and what a part
    takes over from those before it comes from one row a part."""
    rows = with_parts(df.withColumns(columns), order, "_part")
    last = rows.groupBy("_part").agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(order))).alias(c) for c in columns))
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    carry = last.select(F.col("_part"), *(F.last(c, ignorenulls=True).over(earlier).alias(f"{c}_carry") for c in columns))
    within = W.partitionBy("_part").orderBy(order)
    sofar = within.rowsBetween(W.unboundedPreceding, 0)
    joined = rows.join(F.broadcast(carry), "_part")  # as many rows as parts
    filled = joined.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(sofar), F.col(f"{c}_carry")) for c in columns})
    before = {f"{c}_before": F.when(F.row_number().over(within) == 1, F.col(f"{c}_carry")).otherwise(F.lag(c).over(within)) for c in columns}
    return filled.withColumns(before).drop("_part", *(f"{c}_carry" for c in columns))


def keep_first(df: DataFrame, keys, order) -> DataFrame:
    """The first row of each key in the given order; Spark prunes to one row before it shuffles."""
    return df.withColumn("_rank", F.row_number().over(over(keys, order))).where("_rank = 1").drop("_rank")


def repeated(df: DataFrame, keys) -> DataFrame:
    """All rows whose key occurs more than once."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return df.join(counts, list(keys), "left_semi")


def quantiles(df: DataFrame, c: str, shares) -> DataFrame:
    """One row with `q`, an array of the quantiles of c by linear interpolation; null where c has no value.

    Values are counted by parts of their order. Only those of the parts in which the wanted ranks fall are looked at again, there by
    distinct value, so that no task holds all values and none holds many equal ones."""
    values = df.where(F.col(c).isNotNull()).select(F.col(c).cast("double").alias("v"))
    values = with_parts(values.where(~F.isnan("v")), "v", "part")
    counts = values.groupBy("part").agg(F.count("*").alias("n"))  # as many rows as parts
    sofar = F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, 0))
    tally = counts.select("part", (sofar - F.col("n")).alias("low"), sofar.alias("high"), F.sum("n").over(W.partitionBy()).alias("total"))
    at = [F.struct(F.lit(i).alias("i"), (F.lit(float(s)) * (F.col("total") - 1)).alias("at")) for i, s in enumerate(shares)]
    wanted = tally.select("part", "low", "high", F.explode(F.array(*at)).alias("w")).select("part", "low", "high", "w.*")
    ranks = wanted.select("part", "low", "high", "i", "at", F.explode(F.array(F.floor("at"), F.ceil("at"))).alias("rank")).distinct().where("low <= rank and rank < high")
    near = values.join(F.broadcast(ranks.select("part").distinct()), "part", "left_semi").groupBy("part", "v").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(W.partitionBy("part").orderBy("v").rowsBetween(W.unboundedPreceding, 0))
    placed = near.select("part", "v", (upto - F.col("n")).alias("from"), upto.alias("to"))
    found = placed.join(F.broadcast(ranks), "part").where((F.col("low") + F.col("from") <= F.col("rank")) & (F.col("rank") < F.col("low") + F.col("to")))
    weight = F.when(F.col("rank") == F.col("at"), 1.0).when(F.col("rank") < F.col("at"), F.ceil("at") - F.col("at")).otherwise(F.col("at") - F.floor("at"))
    each = found.groupBy("i").agg(F.sum(F.col("v") * weight).alias("q"))
    return each.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "q"))), lambda x: x["q"]).alias("q"))


def describe(df: DataFrame, c: str) -> DataFrame:
    """count, mean, std, min, quartiles by linear interpolation, max: one row."""
    one = df.agg(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"))
    one = one.withColumn("q", quantiles(df, c, (0.25, 0.5, 0.75)).scalar())
    return one.select("count", "mean", "std", "min", *(F.get("q", F.lit(i)).alias(n) for i, n in enumerate(("q25", "q50", "q75"))), "max")


def head(df: DataFrame, n: int = 10) -> DataFrame:
    """The first rows by date."""
    return df.orderBy("date").limit(n)


def with_mean(df: DataFrame, c: str) -> DataFrame:
    """date, value and the mean of all values beside each, as a chart of the series needs them."""
    mean = df.agg(F.avg(c)).scalar()
    return df.select("date", F.col(c).alias("value"), mean.cast("double").alias("mean"))
