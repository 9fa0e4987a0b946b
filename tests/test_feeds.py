import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from gridloom.config import FlatProfile, Header, IndexFeed, RateFeed
from gridloom.operators import clean, layout, quality
from gridloom.plans import cli, feeds
from gridloom.sources import files, links
from gridloom.sources.xlsx import parse, read_cells
from tests import workbooks as wb


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return tmp_path_factory.mktemp("books")


@pytest.fixture(scope="module")
def rate_cells(spark, folder):
    return read_cells(spark, wb.write(folder / "rate.xlsx", {"Otra": [["x"]], "Total nacional": wb.rate_grid()})).cache()


@pytest.fixture(scope="module")
def index_cells(spark, folder):
    return read_cells(spark, wb.write(folder / "index.xlsx", {"IndicesIPC": wb.index_grid()}, shared=False)).cache()


FLAT = [["Hogares", None, None], ["Tasa, serie nacional", None, None], [None] * 3, ["Año", "Mes", "Tasa de desempleo (%)"]]
FLAT += [[2014 + k // 6, 2 * (k % 6) + 1, 7.5 + k / 4] for k in range(9)]


def test_rows_are_found(rate_cells):
    cells = layout.choose_sheet(rate_cells, "Total nacional")
    rows = clean.rate_rows(cells, RateFeed(year_row=None, month_row=None)).first()
    assert (rows.year_row, rows.month_row, rows.label_row) == (11, 12, 16)
    dates = layout.date_columns(cells, clean.rate_rows(cells, RateFeed())).orderBy("col_idx").collect()
    assert len(dates) == 36 and (dates[1].year, dates[1].month) == (2022, 2) and (dates[12].year, dates[12].month) == (2023, 1) and (dates[-1].year, dates[-1].month) == (2024, 12)


@pytest.mark.parametrize("feed", [RateFeed(), RateFeed(year_row=None, month_row=None)])
def test_rate(rate_cells, feed):
    rows = clean.clean_rate(rate_cells, "2026-01-01", feed).orderBy("date").collect()
    assert len(rows) == 36 and rows[0].source == "DANE" and rows[0].download_date == "2026-01-01"
    assert [r.unemployment_rate for r in rows] == [wb.rate_value(y, m) for y in range(3) for m in range(12)]


def test_rate_of_part_of_a_year(spark, folder):
    values = (3.25, 4.5, 4.75, 6.0, 5.5, 5.25)
    cells = read_cells(spark, wb.write(folder / "part.xlsx", {"Total nacional": wb.rate_grid(1, 2025, 6, values)}))
    rows = clean.clean_rate(cells, "2026-01-01").orderBy("date").collect()
    assert [r.unemployment_rate for r in rows] == list(values) and rows[0].date == date(2025, 1, 1)
    assert clean.clean_rate(cells, "d", RateFeed(label="No hay")).isEmpty()
    with pytest.raises(clean.LabelNotFound, match="No hay"):
        clean.checked_clean_rate(cells, "d", RateFeed(label="No hay"))


def test_a_year_that_is_no_number_keeps_the_year_before_it(spark, folder):
    grid = wb.rate_grid(2)
    grid[11][13] = "2023*"
    cells = read_cells(spark, wb.write(folder / "star.xlsx", {"Total nacional": grid}))
    rows = clean.clean_rate(cells, "d").orderBy("date").collect()
    assert len(rows) == 12 and [r.unemployment_rate for r in rows] == [wb.rate_value(0, m) for m in range(12)]


@pytest.mark.parametrize("feed", [IndexFeed(), IndexFeed(header_row=None), IndexFeed(sheet=None)])
def test_index(index_cells, feed):
    rows = clean.clean_index(index_cells, "2026-01-01", feed).orderBy("date").collect()
    assert len(rows) == 26 and [(r.year, r.month, r.ipc_index) for r in rows] == [(2023 + k // 12, k % 12 + 1, wb.index_value(k // 12, k % 12)) for k in range(26)]
    assert quality.run_index_checks(clean.clean_index(index_cells, "d").select(*IndexFeed().output.columns))


def test_index_oddities(spark, folder):
    grid = [["Mes", 2020, "2021.0", 2020, "Nota"], [" ENERO ", 1, 2, 99, 5], ["Sept", 7, 7, 7, 7], ["Febrero", "n.d.", 4, 98, 5]]
    cells = read_cells(spark, wb.write(folder / "odd.xlsx", {"S": grid}))
    rows = clean.clean_index(cells, "d", IndexFeed(sheet=None, header_row=None)).orderBy("date").collect()
    assert [(r.year, r.month, r.ipc_index) for r in rows] == [(2020, 1, 1.0), (2021, 1, 2.0), (2021, 2, 4.0)]


def test_flat_workbook(spark, folder):
    path = wb.write(folder / "flat.xlsx", {"Portada": [["nada"]], "Tasa": FLAT})
    rows = feeds.clean_flat_file(spark, path, FlatProfile("flat", "flat.xlsx", "xlsx"), "d").orderBy("date").collect()
    assert [(r.date, r.unemployment_rate) for r in rows] == [(date(2014 + k // 6, 2 * (k % 6) + 1, 1), 7.5 + k / 4) for k in range(9)]
    yearly = [["Año", "Tasa de desempleo"], [2020, 15.9], [2021, 13.7]]
    path = wb.write(folder / "yearly.xlsx", {"S": yearly})
    rows = feeds.clean_flat_file(spark, path, FlatProfile("flat", "flat.xlsx", "xlsx"), "d").orderBy("date").collect()
    assert [(r.date, r.month) for r in rows] == [(date(2020, 1, 1), 1), (date(2021, 1, 1), 1)]
    mapped = FlatProfile("flat", "flat.xlsx", "xlsx", fields=clean.named({"año": "year", "tasa_de_desempleo": "unemployment_rate"}), header=Header(row=0))
    assert feeds.clean_flat_file(spark, path, mapped, "d").count() == 2


def test_flat_csv(spark, tmp_path):
    path = tmp_path / "flat.csv"
    path.write_text("Year ,population,unemployed_percent,footnotes\n2019,1,3.7,\n2018,1,3.9,\n2020,1,14.7,\n2020,1,99,\n2021,1,x,\n")
    rows = feeds.clean_flat_file(spark, path, FlatProfile("flat", "flat.csv"), "d").orderBy("date").collect()
    assert [(r.year, r.month, r.unemployment_rate) for r in rows] == [(2018, 1, 3.9), (2019, 1, 3.7), (2020, 1, 14.7)]
    with pytest.raises(ValueError, match="unemployed_percent"):
        clean.clean_flat_csv(spark.createDataFrame([(1,)], "year int"))
    with pytest.raises(ValueError, match="format"):
        clean.clean_flat(spark.range(1), FlatProfile("x", "x", "ods"), "d")


def grid(spark, rows, file="f", sheet="s", index=0):
    cells = [(file, sheet, index, i, j, str(v)) for i, r in enumerate(rows) for j, v in enumerate(r) if v is not None]
    return spark.createDataFrame(cells, "file string, sheet string, sheet_idx int, row_idx int, col_idx int, raw string")


def test_header_rows(spark):
    assert layout.header_row(grid(spark, FLAT)).first().header_row == 3
    assert layout.header_row(grid(spark, FLAT[3:])).first().header_row == 0
    assert layout.header_row(grid(spark, [["x"], ["y"]])).first().header_row == 0
    assert layout.grid_header_row(grid(spark, [["a"], ["b"], ["c"], [" mes ", 2020]])).first().header_row == 3
    assert layout.grid_header_row(grid(spark, [["a"], [None, 2019, 2020, "2021.0", 2022, 2023]])).first().header_row == 1
    assert layout.grid_header_row(grid(spark, [["a"], [2019, 2020]])).first().header_row == 0


def test_best_sheet_prefers_the_earlier_of_equals(spark):
    a, b, c = grid(spark, [["tasa"]], sheet="A"), grid(spark, [["Tasa"]], sheet="B", index=1), grid(spark, [["x"]], sheet="desempleo", index=2)
    assert layout.best_sheet(a.union(b)).first().sheet == "A"
    assert layout.best_sheet(a.union(b).union(c)).first().sheet == "desempleo"
    deep = grid(spark, [[None]] * 40 + [["tasa desempleo unemployment"]], sheet="deep", index=3)
    assert layout.best_sheet(a.union(deep)).first().sheet == "A"


def test_no_text_travels_for_keywords(spark):
    """The rules over arrays of cells and those over bits give the same; only keywords with spaces need the cells' text."""
    rng, words = random.Random(5), ["Tasa", "x", " mes\n", "desempleo td", None, "MES TASA", "y", "date", "z", ""]
    cells = [("f", f"s{k % 4}{'td' * (k % 3)}", k % 4, rng.choice([i, i + 30, i + 38]), j, rng.choice(words)) for k in range(24) for i in range(3) for j in range(rng.randint(0, 3))]
    cells = spark.createDataFrame([*cells, ("g", "only", 0, 45, 0, "tasa"), ("h", "null", 0, 0, 0, None)], "file string, sheet string, sheet_idx int, row_idx int, col_idx int, raw string")
    sheets = cells.select("file", "sheet", "sheet_idx").distinct().union(spark.createDataFrame([("i", "td", 0)], "file string, sheet string, sheet_idx int"))
    for words in (("mes", "tasa", "td", "date"), ("mes", "mes", "x"), ("mes tasa", "x"), ("",)):
        for all_sheets in (None, sheets):
            top = layout.heads(cells, 40, sheets=all_sheets).select("file", "sheet", "sheet_idx", layout.sheet_score(F.col("top"), words).alias("score"))
            assert sorted(layout.sheet_scores(cells, words, 40, all_sheets).collect()) == sorted(top.collect())
        rows = layout.heads(cells, 30).select("file", "sheet", layout.header_row_of(F.col("top"), words, 30).alias("header_row"))
        found = layout.header_row(cells, words)
        assert sorted(found.collect()) == sorted(rows.collect()) and found.schema["header_row"].dataType == rows.schema["header_row"].dataType
    for df in (layout.best_sheet(cells), layout.header_row(cells)):
        assert "collect_list" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_month_column(spark):
    heads = lambda g: g.select("file", "sheet").distinct().withColumn("header_row", F.lit(0))
    for names, want in ((["x", "Semestre", "MES "], 2), (["x", "Semestre"], 1), (["Periodo", "y"], 0)):
        g = grid(spark, [names])
        assert layout.month_column(g, heads(g)).first().month_col == want


def test_columns_are_mapped_in_order():
    from gridloom.config import COLUMN_PATTERNS

    assert layout.map_columns(["año", "mes", "tasa_de_desempleo_"], COLUMN_PATTERNS) == {"tasa_de_desempleo_": "unemployment_rate", "año": "year", "mes": "month"}
    assert layout.matches_any("TD", COLUMN_PATTERNS["unemployment_rate"]) and not layout.matches_any("poblacion", COLUMN_PATTERNS["unemployment_rate"])


def test_cells_keep_positions_and_types(folder):
    path = folder / "types.xlsx"
    wb.write(path, {"S": [[], [None, "x", 2023.0, 1.5, True, "N/A"]]})
    assert list(parse(path.read_bytes())) == [("S", 0, 1, 1, "x", "s"), ("S", 0, 1, 2, "2023", "n"), ("S", 0, 1, 3, "1.5", "n"), ("S", 0, 1, 4, "True", "b")]
    assert not list(parse(path.read_bytes(), max_rows=1)) and not list(parse(path.read_bytes(), "T"))


PAGE = "".join(f'<td><a class="b" href="/files/operaciones/GEIH/{n}">Descargar <b>ya</b></a></td>' for n in ("bol-GEIH-ene2026.pdf", "anex-GEIH-dic2025.xlsx", "anex-GEIH-ene2026.xlsx", "anex-GEIH-Desestacionalizado-ene2026.xlsx"))
INDEX_PAGE = "".join(f"<a href='/files/operaciones/IPC/feb2026/anex-IPC-{n}.xlsx'>x</a>" for n in ("Indices-feb2026", "Variacion-feb2026", "Indices-ene2026", "Indices-zzz2027"))


def test_links(spark):
    pages = spark.createDataFrame([(PAGE,)], "html string")
    found = links.extract_links(pages, F.lit("https://www.dane.gov.co/"), RateFeed().origin.links)
    assert [r.href.rsplit("-", 1)[1] for r in found.orderBy("ordinal").collect()] == ["dic2025.xlsx", "ene2026.xlsx"]
    best = links.newest(found).first()
    assert best.url == "https://www.dane.gov.co/files/operaciones/GEIH/anex-GEIH-ene2026.xlsx" and best.text == "Descargarya"
    empty = links.extract_links(spark.createDataFrame([("",)], "html string"), F.lit("x"), ".")
    with pytest.raises(ValueError, match="no link"):
        links.only(empty, links.newest(empty), "annex")
    both = links.extract_links(spark.createDataFrame([(INDEX_PAGE,)], "html string"), F.lit("https://x/"), IndexFeed().origin.links)
    assert both.count() == 4 and "zzz2027" in links.target(both, IndexFeed().origin.wanted).first().href
    assert "feb2026" in links.newest(both.where(F.contains("href", F.lit("Indices")))).first().href


def test_periods(spark):
    rows = spark.createDataFrame([("x-feb2026.xlsx",), ("DIC2025.XLSX",), ("sept2025.xlsx",), ("other",)], "h string").select(links.period(F.col("h")).alias("p")).collect()
    assert [tuple(r.p) if r.p else None for r in rows] == [(2026, 2), (2025, 12), None, None]


def landing(folder):
    (folder / "empleo-y-desempleo").write_text(PAGE)
    wb.write(folder / "anex-GEIH-ene2026.xlsx", {"Total nacional": wb.rate_grid()})
    (folder / "indice-de-precios-al-consumidor-ipc").write_text(INDEX_PAGE.split("<a href='/files/operaciones/IPC/feb2026/anex-IPC-Indices-zzz")[0])
    wb.write(folder / "anex-IPC-Indices-feb2026.xlsx", {"IndicesIPC": wb.index_grid()})


def test_command_line(spark, tmp_path, monkeypatch):
    land, root = tmp_path / "land", tmp_path / "root"
    land.mkdir()
    landing(land)
    assert cli.main(["--all", "--root", str(root), "--landed", str(land)]) == 0
    rate = files.load_series(spark, root / "processed/unemployment_colombia.csv", "unemployment_rate")
    assert rate.count() == 36 and quality.run_rate_checks(rate)
    assert files.load_series(spark, root / "processed/ipc_colombia.csv", "ipc_index").count() == 26
    assert (root / "raw/geih_raw.html").exists()
    wb.write(land / "anex-GEIH-ene2026.xlsx", {"Total nacional": wb.rate_grid(first=1990, values=[99.0] * 12)})
    assert cli.main(["--root", str(tmp_path / "bad"), "--landed", str(land)]) == 1
    assert not (tmp_path / "bad/processed/unemployment_colombia.csv").exists()
    assert cli.main(["--root", str(tmp_path / "kept"), "--landed", str(land), "--publish", "always"]) == 1
    assert (tmp_path / "kept/processed/unemployment_colombia.csv").exists()
    (land / "empleo-y-desempleo").write_text("")
    assert cli.main(["--root", str(tmp_path / "none"), "--landed", str(land)]) == 1
    with pytest.raises(FileNotFoundError, match="nothing"):
        files.load_series(spark, tmp_path / "nothing.csv", "x")


def test_feeds_of_the_command_line():
    args = type("A", (), {"all": False, "ipc": True, "unemployment": True, "flat": True})
    assert cli.chosen(args) == (feeds.run_index,)
    args.all = True
    assert cli.chosen(args) == (feeds.run_all,)


def test_flat_profile_from_its_address(spark, tmp_path):
    (tmp_path / "aat1.csv").write_text("year,unemployed_percent\n2001,4.7\n2002,5.8\n")
    assert cli.main(["--flat", "--root", str(tmp_path / "out"), "--landed", str(tmp_path)]) == 0
    assert [r.unemployment_rate for r in files.load_series(spark, tmp_path / "out/processed/yearly.csv", "unemployment_rate").orderBy("date").collect()] == [4.7, 5.8]
    with pytest.raises(ValueError, match="address"):
        feeds.download_profile(spark, None, str(tmp_path), FlatProfile("x", "x.csv"))


def test_public_names():
    import gridloom

    assert all(callable(getattr(gridloom, n)) for n in gridloom.__all__) and len(gridloom.__all__) >= 7
