"""``python -m laminar <payload_dir> <lake_root>``: run the daily job once.

Uses the session spark-submit provides (or a local one); layer tables go
under ``<lake_root>``; prints the folders to read (of the tables: the current versions).
"""

from __future__ import annotations

import argparse
import json

from laminar.plans import tables
from laminar.plans.contracts import INFRASTRUCTURE, SCHOOLS, STATISTICS
from laminar.plans.daily import run_daily
from laminar.session import build_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="laminar", description=__doc__)
    parser.add_argument("payload_dir", help="folder with the saved API payloads")
    parser.add_argument("lake_root", help="root folder of the land/raw/trusted/refined tables")
    parser.add_argument("--master", default=None, help="e.g. local[8]; default: from spark-submit")
    parser.add_argument("--shuffle-partitions", type=int, default=None)
    args = parser.parse_args(argv)
    spark = build_session(args.master, args.shuffle_partitions)
    paths = run_daily(spark, args.payload_dir, args.lake_root)
    out = {c.name: {"raw": paths.raw(c), "trusted": tables.current(spark, paths.trusted(c))}
           for c in (SCHOOLS, STATISTICS, INFRASTRUCTURE)}
    out["mart"] = tables.current(spark, paths.mart)
    print(json.dumps(out, indent=2))


if __name__ == "__main__":
    main()
