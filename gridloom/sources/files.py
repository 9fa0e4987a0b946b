"""Landing, reading and publishing of files."""

from __future__ import annotations

import logging
import urllib.request
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_FORMAT = "%(asctime)s %(levelname)s %(name)s: %(message)s"
AGENT = {"User-Agent": "Mozilla/5.0 (compatible; gridloom)"}
SERIES = "date date, year int, month int, {measure} double, source string, download_date string"


def setup_logging(folder: Path, level: int = logging.INFO) -> logging.Logger:
    """File and console handlers, added once."""
    log = logging.getLogger("gridloom")
    if log.handlers:
        return log
    folder.mkdir(parents=True, exist_ok=True)
    log.setLevel(level)
    for handler in (logging.FileHandler(folder / "pipeline.log", encoding="utf-8"), logging.StreamHandler()):
        handler.setFormatter(logging.Formatter(LOG_FORMAT, "%Y-%m-%d %H:%M:%S"))
        log.addHandler(handler)
    return log


def located(spark: SparkSession, path):
    """(file system, path) in Hadoop's terms; a path may be of any store that Spark knows."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(str(path))
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def found_files(spark: SparkSession, path) -> list[str]:
    """The addresses of the files that a path, or several, name: files, patterns, or what lies in folders."""
    found = []
    for p in path if isinstance(path, list | tuple) else [path]:
        fs, target = located(spark, p)
        for status in fs.globStatus(target) or []:
            inside = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
            found += [s.getPath().toString() for s in inside if s.isFile() and not s.getPath().getName().startswith((".", "_"))]
    if not found:
        raise FileNotFoundError(f"no file at {path}")
    return found


def ship(spark: SparkSession) -> None:
    """Lets Python workers that share this file system import the package."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = f"{root}:{env['PYTHONPATH']}" if env.get("PYTHONPATH") else root


def ensure_folders(spark: SparkSession, root) -> dict[str, str]:
    folders = {n: f"{str(root).rstrip('/')}/{n}" for n in ("raw", "processed", "logs")}
    for folder in folders.values():
        fs, target = located(spark, folder)
        fs.mkdirs(target)
    return folders


class Web:
    """Fetches over HTTP; Landed offers the same from a folder."""

    def __init__(self, timeout: int = 120, headers: dict | None = None):
        self.timeout, self.headers = timeout, {**AGENT, **(headers or {})}

    def read(self, url: str) -> bytes:
        with urllib.request.urlopen(urllib.request.Request(url, headers=self.headers), timeout=self.timeout) as r:
            return r.read()


class Landed:
    """Files that were landed before, by the last part of their address; a page is `page.html`."""

    def __init__(self, folder: Path):
        self.folder = Path(folder)

    def read(self, url: str) -> bytes:
        name = url.rsplit("/", 1)[-1]
        path = self.folder / name
        return (path if path.exists() else self.folder / "page.html").read_bytes()


def land(spark: SparkSession, content: bytes, path) -> str:
    """Writes the content, over whatever was there."""
    fs, target = located(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    return str(path)


def download(spark: SparkSession, fetch, url: str, path) -> str:
    return land(spark, fetch.read(url), path)


def exists(spark: SparkSession, path) -> bool:
    fs, target = located(spark, path)
    return fs.exists(target)


CORRUPT = "_corrupt"


def split_rows(spark: SparkSession, path, schema: str) -> tuple[DataFrame, DataFrame]:
    """(the rows of a CSV file that fit the schema; those that do not, with what could be read of them and the whole `line`)."""
    options = {"header": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "columnPruning": False}
    rows = spark.read.options(**options).schema(f"{schema}, {CORRUPT} string").csv(str(path))
    # Spark looks at the columns only that a query names: this names all, and is always true
    rows = rows.where(F.length(F.concat_ws("", *(F.col(f"`{c}`").cast("string") for c in rows.columns))) >= 0)
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT), rows.where(F.col(CORRUPT).isNotNull()).withColumnRenamed(CORRUPT, "line")


def load_series(spark: SparkSession, path, measure: str) -> DataFrame:
    """A published series, with its own types, without the lines that don't have them; see rejected_rows."""
    if not exists(spark, path):
        raise FileNotFoundError(f"no such file: {path}")
    return split_rows(spark, path, SERIES.format(measure=measure))[0]


def rejected_rows(spark: SparkSession, path, measure: str) -> DataFrame:
    """The lines that load_series leaves out."""
    return split_rows(spark, path, SERIES.format(measure=measure))[1]


def read_flat_csv(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """(the rows of a CSV file as text, the lines that have more or fewer cells than its header)."""
    names = spark.read.csv(str(path), header=True).columns
    return split_rows(spark, path, ", ".join(f"`{n.replace('`', '``')}` string" for n in names))


def save_rejected(rejected: DataFrame, path) -> int:
    """Keeps rejected rows as a table beside a series; how many there are. The table of an earlier run is replaced, an empty one goes."""
    spark = rejected.sparkSession
    rejected.write.mode("overwrite").parquet(str(path))
    n = spark.read.parquet(str(path)).count()
    if not n:
        fs, target = located(spark, path)
        fs.delete(target, True)
    return n


def stage_series(df: DataFrame, path) -> str:
    """Writes one CSV file in order of date beside `path` and gives its address; a series has one row a month."""
    spark, (folder, _, name) = df.sparkSession, str(path).rpartition("/")
    parts = f"{folder or '.'}/.{name}.{uuid.uuid4().hex}"
    df.withColumn("date", F.col("date").cast("string")).repartition(1).sortWithinPartitions("date").write.option("header", True).csv(parts)
    fs, made = located(spark, f"{parts}/part-*.csv")
    return fs.globStatus(made)[0].getPath().toString()


def commit(spark: SparkSession, staged: str, path) -> str:
    """Renames a staged file over `path` in one step: readers see the old file or the new one, never none."""
    jvm, (fs, target) = spark.sparkContext._jvm, located(spark, path)
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    target = fs.makeQualified(target)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(located(spark, staged)[1], target, how)
    discard(spark, staged)
    return str(path)


def discard(spark: SparkSession, staged: str) -> None:
    """Removes what is left of a staged file and its folder."""
    fs, target = located(spark, staged)
    fs.delete(target.getParent(), True)


def save_series(df: DataFrame, path) -> str:
    """One CSV file in order of date. It takes its name when it is whole, over whatever had it."""
    return commit(df.sparkSession, stage_series(df, path), path)
