"""The workbook source: pushed filters, ranged reads, the catalogue of sheets."""

import io

import pytest
from pyspark.sql import functions as F

from gridloom.config import FlatProfile, IndexFeed
from gridloom.operators import clean, layout
from gridloom.plans import feeds
from gridloom.sources import xlsx
from tests import workbooks as wb


class Counted(io.FileIO):
    """A file that counts the bytes that are read from it."""

    seen = 0

    def read(self, n=-1):
        out = super().read(n)
        self.seen += len(out)
        return out

    def readinto(self, b):
        n = super().readinto(b)
        self.seen += n or 0
        return n


@pytest.fixture(scope="module")
def large(tmp_path_factory):
    path = tmp_path_factory.mktemp("large") / "large.xlsx"
    rows = [[f"label {i * 7919 % 100003}", i, i * 0.5] for i in range(120_000)]
    wb.write(path, {"Empty": [], "Large": rows, "Small": [["x"], [1]]}, shared=False)
    return path


def test_a_peek_does_not_read_the_sheet_through(large):
    with Counted(large) as f:
        rows = list(xlsx.parse(f, "Large", 40))
        peek = f.seen
    assert len(rows) == 120 and rows[-1][2:4] == (39, 2)
    with Counted(large) as f:
        assert [s[1:3] for s in xlsx.listed(f, "f")] == [("Empty", 0), ("Large", 1), ("Small", 2)]
        listing = f.seen
    size = large.stat().st_size
    assert peek < size / 5 and listing < 20_000 < size / 5


def test_filters_reach_the_source(spark, large, tmp_path):
    cells = xlsx.read_cells(spark, str(large), "Large").where((F.col("row_idx") >= 10) & (F.col("row_idx") < 12))
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan and ") Filter" not in plan
    assert {(r.row_idx, r.col_idx, r.raw) for r in cells.collect()} == {(i, j, v) for i in (10, 11) for j, v in enumerate((f"label {i * 7919 % 100003}", str(i), repr(i * 0.5).removesuffix(".0")))}
    assert xlsx.read_cells(spark, str(large)).where("sheet in ('Small', 'None') and col_idx = 0").count() == 2
    assert xlsx.read_cells(spark, str(large)).where("row_idx = 0 and row_idx > 0").count() == 0
    assert xlsx.read_cells(spark, str(large), max_rows=1).groupBy("sheet").count().count() == 2
    whole = xlsx.read_cells(spark, str(large))
    assert whole.rdd.getNumPartitions() == 3 and whole.count() == 360_002


def test_many_files_share_partitions(spark, tmp_path):
    for k in range(xlsx.LISTED + 4):
        wb.write(tmp_path / f"b{k}.xlsx", {"A": [[k]], "B": [["y"]]})
    cells = xlsx.read_cells(spark, str(tmp_path))
    assert cells.rdd.getNumPartitions() == xlsx.WAVES * spark.sparkContext.defaultParallelism
    assert cells.count() == 2 * (xlsx.LISTED + 4) and {int(r.raw) for r in cells.where("sheet = 'A'").collect()} == set(range(xlsx.LISTED + 4))
    assert xlsx.read_sheets(spark, str(tmp_path)).count() == 2 * (xlsx.LISTED + 4)


def test_files_of_a_folder(spark, tmp_path):
    for k in range(3):
        wb.write(tmp_path / f"b{k}.xlsx", {"A": [[k]], "B": [["y", None], [None, k]]})
    (tmp_path / "_SUCCESS").write_text("")
    rows = xlsx.read_cells(spark, str(tmp_path)).where("sheet = 'B' and row_idx > 0").collect()
    assert sorted((r.file.rpartition("/")[2], r.sheet_idx, r.col_idx, r.raw) for r in rows) == [(f"b{k}.xlsx", 1, 1, str(k)) for k in range(3)]
    assert xlsx.read_cells(spark, [str(tmp_path / "b0.xlsx"), str(tmp_path / "b2*")]).select("file").distinct().count() == 2
    with pytest.raises(FileNotFoundError):
        xlsx.read_cells(spark, str(tmp_path / "none*"))


def test_shared_strings_are_read_as_far_as_needed(tmp_path):
    path = tmp_path / "s.xlsx"
    wb.write(path, {"S": [[f"text {i * 7919 % 100003} {i}"] for i in range(30_000)]})
    with xlsx.zipfile.ZipFile(path) as book:
        strings = xlsx.Strings(book)
        assert strings[3] == "text 23757 3" and len(strings.read) == 4 and strings[1].endswith(" 1")


def test_empty_sheets_are_there(spark, tmp_path):
    path = wb.write(tmp_path / "first.xlsx", {"Portada": [], "Datos": [["x"], ["Mes", 2020], ["Enero", 5]]})
    cells, sheets = xlsx.read_cells(spark, path), xlsx.read_sheets(spark, path)
    assert [(r.sheet, r.sheet_idx) for r in sheets.orderBy("sheet_idx").collect()] == [("Portada", 0), ("Datos", 1)]
    assert layout.best_sheet(cells, ("zzz",)).first().sheet == "Datos" and layout.best_sheet(cells, ("zzz",), sheets=sheets).first().sheet == "Portada"
    feed = IndexFeed(sheet=None, header_row=None)
    assert clean.clean_index(cells, "d", feed).count() == 1 and clean.clean_index(cells, "d", feed, sheets).count() == 0
    assert feeds.clean_flat_file(spark, path, FlatProfile("f", "f.xlsx", "xlsx"), "d").count() == 0


def scans(df) -> int:
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("Relation [") + plan.count("LogicalRDD") + plan.count("RelationV2") + plan.count("LocalRelation [")


def test_grids_are_read_twice_at_most(spark, tmp_path):
    """Once for the layout and once for the values, whatever is looked for."""
    path = wb.write(tmp_path / "x.xlsx", {"S": wb.index_grid()})
    cells = xlsx.read_cells(spark, path)
    from gridloom.config import RateFeed

    assert scans(clean.clean_index(cells, "d", IndexFeed(sheet=None, header_row=None))) == 2
    assert scans(clean.clean_rate(cells, "d", RateFeed(sheet=None, year_row=None, month_row=None))) == 2
    assert scans(clean.clean_flat(cells, FlatProfile("f", "f.xlsx", "xlsx"), "d")) == 2


def test_fields_take_columns_in_order(spark):
    names = ["Tasa de desempleo", "TD", "Año", "Mes", "year", "Fecha"]
    cells = spark.createDataFrame([("f", "s", 0, 2, i, n) for i, n in enumerate(names)], "file string, sheet string, sheet_idx int, row_idx int, col_idx int, raw string")
    heads = cells.select("file", "sheet").distinct().withColumn("header_row", F.lit(2))
    for patterns in (FlatProfile("f", "f").fields, {"a": ("^t",), "b": ("^t",), "c": ("^t",), "d": ("e",)}, {}):
        normal = [clean.normal_name(n) for n in names]
        want = {field: normal.index(name) for name, field in layout.map_columns(normal, patterns).items()}
        assert {r.field: r.col_idx for r in layout.field_columns(cells, heads, patterns).collect()} == want if patterns else not want
