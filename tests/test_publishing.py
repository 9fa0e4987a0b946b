"""Publishing in one pass with a safe commit; lines that don't fit; series without a key; exact quantiles."""

import math
import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.test_quality import frame

from gridloom.functions import series
from gridloom.operators import quality
from gridloom.plans import feeds
from gridloom.sources import files


def values(spark, path):
    return [r.unemployment_rate for r in files.load_series(spark, path, "unemployment_rate").orderBy("date").collect()]


def test_a_failing_series_leaves_the_old_one(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out/x.csv")
    feeds.publish(frame(spark, [3.0, 4.0]), path, quality.RATE_SUITE, False)
    with pytest.raises(quality.QualityCheckError, match="fuera de rango.*99"):
        feeds.publish(frame(spark, [3.0, 99.0]), path, quality.RATE_SUITE, False)
    with pytest.raises(ValueError, match="no row"):
        feeds.publish(frame(spark, []), path, quality.RATE_SUITE, True)
    # a failure between writing and renaming
    monkeypatch.setattr(files, "commit", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        feeds.publish(frame(spark, [5.0, 6.0]), path, quality.RATE_SUITE, False)
    monkeypatch.undo()
    assert values(spark, path) == [3.0, 4.0] and [p.name for p in (tmp_path / "out").iterdir() if not p.name.endswith(".crc")] == ["x.csv"]
    assert values(spark, path) == [3.0, 4.0]
    with pytest.raises(quality.QualityCheckError):
        feeds.publish(frame(spark, [7.0, 99.0]), path, quality.RATE_SUITE, True)
    assert values(spark, path) == [7.0, 99.0]


def test_figures_are_gathered_while_writing(spark, tmp_path):
    days = [date(2020, 1, 1), date(2020, 2, 1), date(2020, 2, 1), date(2020, 9, 1)]
    df = frame(spark, [3.6, None, 99.0, 4.0], dates=days)
    seen_rows, seen = quality.RATE_SUITE.observed(df, "test")
    seen_rows.write.parquet(str(tmp_path / "rows"))
    want = quality.report(df, "unemployment_rate", 0.0, 40.0, nulls=quality.RATE_SUITE.needed).first().asDict()
    assert seen.get == want and want["n_repeats"] == want["n_gaps"] == want["n_drops"] == 1


def test_lines_that_do_not_fit(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("date,year,month,unemployment_rate,source,download_date\n2020-01-01,2020,1,3.5,S,d\n2020-02-01,2020,x,3.5,S,d\nshort\n2020-03-01,2020,3,,S,d\n")
    assert files.load_series(spark, path, "unemployment_rate").count() == 2
    assert sorted(r.line for r in files.rejected_rows(spark, path, "unemployment_rate").collect()) == ["2020-02-01,2020,x,3.5,S,d", "short"]
    (tmp_path / "aat1.csv").write_text("year,unemployed_percent\n2001,4.7\n2002,5.8,9,9\n2003\n2004,6.0\n")
    feeds.run_flat(spark, files.Landed(tmp_path), str(tmp_path / "out"), run_date="d")
    assert values(spark, tmp_path / "out/processed/yearly.csv") == [4.7, 6.0]
    assert sorted(r.line for r in spark.read.parquet(str(tmp_path / "out/processed/yearly.rejected")).collect()) == ["2002,5.8,9,9", "2003"]


def test_a_series_without_a_key(spark):
    rng = random.Random(1)
    n = 400
    days = [date(2000, 1, 1) + timedelta(rng.choice((1, 30, 70)) * 1 + 71 * k) for k in range(n)]
    found = [None if k % 7 == 3 or k < 5 or 100 < k < 180 else rng.choice((0.0, 1.0, 2.5, 4.0)) for k in range(n)]
    df = frame(spark, found, dates=days).repartition(7)
    filled, before, want = None, None, []
    for k, v in enumerate(found):
        before, filled = filled, v if v is not None else filled
        want.append((days[k], (days[k] - days[k - 1]).days if k else None, None if not k or before in (None, 0.0) or filled is None else filled / before - 1))
    got = quality.with_steps(df, "unemployment_rate").orderBy("date").collect()
    assert [(r.date, r._gap, r._change) for r in got] == want
    assert quality.drops(df, "unemployment_rate").count() == sum(c is not None and c < -0.15 for _, _, c in want)
    assert quality.gaps(df).count() == sum(g is not None and g > 62 for _, g, _ in want)
    # all of one date, none at all
    same = frame(spark, [1.0, None, 2.0], dates=[date(2020, 1, 1)] * 3)
    assert quality.report(same, "unemployment_rate", 0.0, 40.0).first().n_repeats == 2
    assert quality.with_steps(df.limit(0), "unemployment_rate").count() == 0
    assert quality.with_steps(frame(spark, [1.0, 2.0], dates=[None, None]), "unemployment_rate").count() == 2


@pytest.mark.parametrize("seed", range(4))
def test_quantiles(spark, seed):
    rng = np.random.default_rng(seed)
    data = [rng.normal(size=1001), np.repeat(3.5, 500), np.concatenate((np.repeat(1.0, 700), rng.normal(size=300))), np.array([1.0, 2.0, 3.0, 4.0])][seed]
    shares = (0.0, 0.25, 0.5, 0.731, 1.0)
    df = spark.createDataFrame([(float(x),) for x in data] + [(None,), (math.nan,)], "v double").repartition(5)
    assert series.quantiles(df, "v", shares).first().q == pytest.approx(np.quantile(data, shares).tolist())
    assert series.describe(df.where("v is null"), "v").first().q50 is None


def test_quantiles_leave_the_values_where_they_are(spark):
    df = spark.range(200_000).select((F.col("id") * 7919 % 100_003).cast("double").alias("v"))
    found = series.describe(df, "v")
    q = np.quantile([k * 7919 % 100_003 for k in range(200_000)], (0.25, 0.5, 0.75))
    assert found.first()[4:7] == pytest.approx(tuple(q))


def test_a_root_may_be_an_address(spark, tmp_path):
    from gridloom.plans import cli

    (tmp_path / "aat1.csv").write_text("year,unemployed_percent\n2001,4.7\n2002,5.8\n")
    assert cli.main(["--flat", "--root", (tmp_path / "out").as_uri(), "--landed", str(tmp_path), "--logs", str(tmp_path / "logs")]) == 0
    assert values(spark, tmp_path / "out/processed/yearly.csv") == [4.7, 5.8]
