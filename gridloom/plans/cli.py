"""python -m gridloom.plans.cli [--all | --ipc | --unemployment | --flat]"""

from __future__ import annotations

import argparse
import logging
import re
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

from gridloom.operators.quality import QualityCheckError
from gridloom.plans import feeds
from gridloom.sources.files import Landed, Web, setup_logging


def chosen(args) -> tuple:
    """--all before --ipc before --unemployment, which is also the default, before --flat."""
    if args.flat and not (args.all or args.ipc or args.unemployment):
        return (feeds.run_flat,)
    return (feeds.run_all,) if args.all else (feeds.run_index,) if args.ipc else (feeds.run_rate,)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    for name in ("all", "ipc", "unemployment", "flat"):
        parser.add_argument(f"--{name}", action="store_true")
    parser.add_argument("--root", default="data", help="a folder in any store that Spark knows")
    parser.add_argument("--logs", type=Path, help="a local folder for the log; below the root, if that is local")
    parser.add_argument("--landed", type=Path, help="read pages and workbooks from this folder")
    parser.add_argument("--publish", choices=("checked", "always"), default="checked")
    args = parser.parse_args(argv)
    root = re.sub("^file:(//)?", "", args.root)
    setup_logging(args.logs or (Path("logs") if re.match("[a-zA-Z][a-zA-Z0-9+.-]*:", root) else Path(root) / "logs"))
    log, began = logging.getLogger("gridloom.cli"), time.time()
    spark = SparkSession.builder.appName("gridloom").getOrCreate()
    try:
        for run in chosen(args):
            run(spark, Landed(args.landed) if args.landed else Web(), args.root, always=args.publish == "always")
    except QualityCheckError as e:
        log.error("check failed: %s", e)
        return 1
    except Exception:
        log.exception("the run failed")
        return 1
    log.info("done in %.1f s", time.time() - began)
    return 0


if __name__ == "__main__":
    sys.exit(main())
