"""Workbooks as a long table of cells, and a catalogue of their sheets.

`read_cells` is a Python data source: each sheet of each file is a partition, or where there are very many, a partition
holds some of them, and filters on sheet and row_idx reach the source, so that a sheet that is not wanted is not opened and a peek at the first rows stops
behind them. A workbook is a zip file: its directory and the few parts that a sheet needs are read by
ranges, in the tasks. A row is a cell that holds something; positions are those of the cell references, from 0.
Stores that only Spark's readers can open are read whole by the binaryFile reader instead.
"""

from __future__ import annotations

import io
import json
import posixpath
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass, field
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from gridloom.config import MISSING
from gridloom.sources.files import found_files, ship

CELLS = "file string, sheet string, sheet_idx int, row_idx int, col_idx int, raw string, cell_type string"
SHEETS = "file string, sheet string, sheet_idx int, bytes long"
TYPES = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string())
NAMES = [part.split()[0] for part in CELLS.split(", ")]
REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: Stores that pyarrow opens by itself.
OPENED = ("file", "hdfs", "s3", "gs", "abfs", "abfss")
#: With more files than these their sheets are not listed before, and are read together.
LISTED = 256
#: So many partitions for each task that runs at once, at most.
WAVES = 4
BATCH = 1 << 14


def tag(element) -> str:
    return element.tag.rpartition("}")[2]


def plain_text(element) -> str:
    """Text of a string item without its phonetic hints."""
    if tag(element) == "rPh":
        return ""
    return (element.text or "" if tag(element) == "t" else "") + "".join(map(plain_text, element))


def position(reference: str) -> tuple[int, int]:
    letters, digits = re.fullmatch(r"\$?([A-Za-z]+)\$?(\d+)", reference).groups()
    column = 0
    for c in letters.upper():
        column = column * 26 + ord(c) - 64
    return int(digits) - 1, column - 1


def sheets(book: zipfile.ZipFile) -> Iterator[tuple[str, str]]:
    """(name, part) of the sheets in workbook order."""
    rels = {r.get("Id"): r.get("Target") for r in ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    for sheet in ET.fromstring(book.read("xl/workbook.xml")).iter():
        if tag(sheet) == "sheet":
            target = rels[sheet.get(REL)]
            yield sheet.get("name"), target.lstrip("/") if target.startswith("/") else posixpath.normpath(f"xl/{target}")


class Strings:
    """The strings that cells share, read as far as cells name them."""

    def __init__(self, book: zipfile.ZipFile):
        self.book, self.read, self.more = book, [], None

    def items(self):
        if "xl/sharedStrings.xml" in self.book.namelist():
            with self.book.open("xl/sharedStrings.xml") as f:
                for _, element in ET.iterparse(f):
                    if tag(element) == "si":
                        yield plain_text(element)
                        element.clear()

    def __getitem__(self, n: int) -> str:
        self.more = self.more or self.items()
        while len(self.read) <= n:
            self.read.append(next(self.more))
        return self.read[n]


def cell_text(cell, strings) -> tuple[str | None, str]:
    """(text, type) of a cell; formulas count with their cached value, errors as missing."""
    kind = cell.get("t", "n")
    parts = {tag(e): e for e in cell}
    if kind == "inlineStr":
        return plain_text(parts["is"]) if "is" in parts else None, "s"
    value = parts["v"].text if "v" in parts else None
    if value is None or kind == "e":
        return None, kind
    if kind == "s":
        return strings[int(value)], "s"
    if kind == "b":
        return ("True" if value == "1" else "False"), "b"
    if kind == "str":
        return value, "s"
    if kind == "d":
        return value, "d"
    number = float(value)
    return (str(int(number)) if number.is_integer() and abs(number) < 1e15 else repr(number)), "n"


@dataclass
class Wanted:
    """What filters leave: sheets by name (all, if None) and rows from `low` up to, not including, `high`."""

    names: set | None = None
    low: int = 0
    high: int | None = None

    def take(self, found) -> bool:
        """Takes a filter over, if it is on sheets or rows."""
        column, value = found.attribute, getattr(found, "value", None)
        if column == ("sheet",) and isinstance(found, EqualTo | In):
            names = {value} if isinstance(found, EqualTo) else set(value)
            self.names = names if self.names is None else self.names & names
        elif column == ("row_idx",) and isinstance(found, EqualTo | LessThan | LessThanOrEqual | GreaterThan | GreaterThanOrEqual):
            if isinstance(found, EqualTo | GreaterThan | GreaterThanOrEqual):
                self.low = max(self.low, value + isinstance(found, GreaterThan))
            if isinstance(found, EqualTo | LessThan | LessThanOrEqual):
                top = value + (not isinstance(found, LessThan))
                self.high = top if self.high is None else min(self.high, top)
        else:
            # no cell lacks its place
            return isinstance(found, IsNotNull) and column in (("file",), ("sheet",), ("sheet_idx",), ("row_idx",), ("col_idx",))
        return True


def parse(content, sheet: str | None = None, max_rows: int | None = None, wanted: Wanted | None = None) -> Iterator[tuple]:
    """(sheet, sheet_idx, row_idx, col_idx, raw, cell_type) of every cell that is not missing, of bytes or an open file."""
    wanted = wanted or Wanted({sheet} if sheet is not None else None, 0, max_rows)
    with zipfile.ZipFile(io.BytesIO(content) if isinstance(content, bytes) else content) as book:
        strings = Strings(book)
        for index, (name, part) in enumerate(sheets(book)):
            if wanted.names is None or name in wanted.names:
                yield from sheet_cells(book, part, name, index, strings, wanted)


def sheet_cells(book: zipfile.ZipFile, part: str, name: str, index: int, strings, wanted: Wanted) -> Iterator[tuple]:
    row, column, rows = -1, -1, None
    with book.open(part) as f:
        for event, element in ET.iterparse(f, ("start", "end")):
            kind = tag(element)
            if event == "start":
                if kind == "sheetData":
                    rows = element
                elif kind == "row":
                    row, column = int(element.get("r", row + 2)) - 1, -1
                    if wanted.high is not None and row >= wanted.high:
                        return
            elif kind == "c":
                row, column = position(element.get("r")) if element.get("r") else (row, column + 1)
                if row >= wanted.low:
                    text, type_ = cell_text(element, strings)
                    if text is not None and text not in MISSING:
                        yield name, index, row, column, text, type_
            elif kind == "row" and rows is not None:
                rows.clear()


def opened(uri: str):
    fs, path = pafs.FileSystem.from_uri(uri)
    return fs.open_input_file(path)


@dataclass
class Sheets(InputPartition):
    """Sheets by file and number; with no number all of a file."""

    items: list


def dealt(items: list, parts: int) -> list[Sheets]:
    n = min(len(items), parts)
    return [Sheets(items[k::n]) for k in range(n)]


@dataclass
class Cells(DataSourceReader):
    files: list
    parts: int
    wanted: Wanted = field(default_factory=Wanted)

    def pushFilters(self, filters):
        return [f for f in filters if not self.wanted.take(f)]

    def partitions(self):
        if self.wanted.high is not None and self.wanted.high <= self.wanted.low or self.wanted.names == set():
            return []
        if len(self.files) > LISTED:
            return dealt([(f, None) for f in self.files], self.parts)
        found = []
        for file in self.files:
            with opened(file) as f, zipfile.ZipFile(f) as book:
                found += [(file, i) for i, (name, _) in enumerate(sheets(book)) if self.wanted.names is None or name in self.wanted.names]
        return dealt(found, self.parts)

    def read(self, partition):
        rows = []
        for file, wanted in partition.items:
            with opened(file) as f, zipfile.ZipFile(f) as book:
                strings = Strings(book)
                for index, (name, part) in enumerate(sheets(book)):
                    if wanted in (None, index) and (self.wanted.names is None or name in self.wanted.names):
                        for cell in sheet_cells(book, part, name, index, strings, self.wanted):
                            rows.append((file, *cell))
                            if len(rows) == BATCH:
                                yield batch(rows)
                                rows = []
        if rows:
            yield batch(rows)


def batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), TYPES, strict=True)], names=NAMES)


class Workbooks(DataSource):
    """The cells of workbooks: options `files`, a JSON list of addresses, and `parts`, the most partitions."""

    @classmethod
    def name(cls) -> str:
        return "gridloom_cells"

    def schema(self) -> str:
        return CELLS

    def reader(self, schema) -> Cells:
        return Cells(json.loads(self.options["files"]), int(self.options["parts"]))


def listed(content, file: str) -> list[tuple]:
    """(file, sheet, sheet_idx, bytes unpacked) of each sheet, from the zip file's directory."""
    with zipfile.ZipFile(content) as book:
        sizes = {i.filename: i.file_size for i in book.infolist()}
        return [(file, name, index, sizes.get(part, 0)) for index, (name, part) in enumerate(sheets(book))]


@dataclass
class Directory(DataSourceReader):
    files: list
    parts: int

    def partitions(self):
        return dealt(self.files, self.parts)

    def read(self, partition):
        for file in partition.items:
            with opened(file) as f:
                yield from listed(f, file)


class Catalogue(DataSource):
    """The sheets of workbooks, those without cells too; options as of Workbooks."""

    @classmethod
    def name(cls) -> str:
        return "gridloom_sheets"

    def schema(self) -> str:
        return SHEETS

    def reader(self, schema) -> Directory:
        return Directory(json.loads(self.options["files"]), int(self.options["parts"]))


def source(spark: SparkSession, kind, path) -> DataFrame | None:
    """The data source on the files under path, or None where Spark alone can open them."""
    files = found_files(spark, path)
    if any(f.partition(":")[0] not in OPENED for f in files):
        return None
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(kind)
    return spark.read.format(kind.name()).option("files", json.dumps(files)).option("parts", WAVES * spark.sparkContext.defaultParallelism).load()


def read_cells(spark: SparkSession, path, sheet: str | None = None, max_rows: int | None = None) -> DataFrame:
    """The cells of all workbooks under path (or paths). Filters on sheet and row_idx reach the source."""
    found = source(spark, Workbooks, path)
    if found is not None:
        found = found if sheet is None else found.where(F.col("sheet") == sheet)
        return found if max_rows is None else found.where(F.col("row_idx") < max_rows)

    def run(batches):
        for b in batches:
            for file, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows = [(file, *cell) for cell in parse(content.as_py(), sheet, max_rows)]
                if rows:
                    yield batch(rows)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, CELLS)


def read_sheets(spark: SparkSession, path) -> DataFrame:
    """file, sheet, sheet_idx and unpacked bytes of every sheet of the workbooks under path, in workbook order, read without
    their cells."""
    found = source(spark, Catalogue, path)
    if found is not None:
        return found

    def run(batches):
        for b in batches:
            for file, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows = listed(io.BytesIO(content.as_py()), file)
                yield pa.RecordBatch.from_pylist([dict(zip(("file", "sheet", "sheet_idx", "bytes"), r, strict=True)) for r in rows], pa.schema([("file", pa.string()), ("sheet", pa.string()), ("sheet_idx", pa.int32()), ("bytes", pa.int64())]))

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, SHEETS)
