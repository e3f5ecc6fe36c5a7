"""Run the monthly job from the command line.

    python -m farezone --yellow 'root/yellow/*.parquet' --green ... --fhv ... --hvfhv ... \
        --bases 'root/bases/*.parquet' --zone-matrix idall.csv --zone-lookup lookup.parquet \
        --out root/published [--asof 2022-06-25] [--daily-jdbc-url URL --daily-table T]

On a cluster, submit with spark-submit; the session's settings (shuffle
partitions, ``spark.checkpoint.dir`` on shared storage) are used as given.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from dataclasses import replace

from farezone.config import Params
from farezone.functions.timekeys import run_bounds
from farezone.operators.checks import Checks
from farezone.plans.inputs import TripInputs
from farezone.plans.monthly import run_monthly
from farezone.session import ensure_checkpoint_dir
from farezone.sources.readers import read_daily_indicators


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="farezone", description=__doc__.splitlines()[0])
    for t in ("yellow", "green", "fhv", "hvfhv"):
        ap.add_argument(f"--{t}", required=True, help=f"{t} trip files (Parquet path or glob)")
    ap.add_argument("--bases", required=True)
    ap.add_argument("--zone-matrix", required=True)
    ap.add_argument("--zone-lookup", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--asof", type=dt.date.fromisoformat, default=dt.date.today())
    ap.add_argument("--since", type=dt.date.fromisoformat,
                    help="incremental: recompute and replace only months from this date on")
    ap.add_argument("--start", type=int, help="first hour key (YYYYMMDDHH) for every industry")
    ap.add_argument("--end", type=int, help="hour key after the last trip counted")
    ap.add_argument("--all-since", type=dt.date.fromisoformat, help="first month of the ALL rollup")
    ap.add_argument("--fare-cap", type=float)
    ap.add_argument("--distance-cap", type=float)
    ap.add_argument("--fmt", choices=("parquet", "csv"), default="parquet", help="format of the published mart")
    ap.add_argument("--daily-jdbc-url")
    ap.add_argument("--daily-table")
    ap.add_argument("--daily-option", action="append", default=[], metavar="KEY=VALUE",
                    help="JDBC option of the daily table (user, password, driver, partitionColumn, ...); repeatable")
    a = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("farezone-monthly").getOrCreate()
    ensure_checkpoint_dir(spark)
    params = Params(asof=a.asof)
    params = params.with_period(a.start, a.end)  # each bound by itself
    overrides = {k: v for k, v in (("all_since", a.all_since), ("fare_cap", a.fare_cap),
                                   ("distance_cap", a.distance_cap)) if v is not None}
    params = replace(params, **overrides)
    daily = None
    if a.daily_jdbc_url and a.daily_table:
        daily = read_daily_indicators(spark, a.daily_jdbc_url, a.daily_table, run_bounds(a.asof)[1],
                                      dict(o.split("=", 1) for o in a.daily_option))
    inputs = TripInputs.from_paths(
        spark, {"yellow": a.yellow, "green": a.green, "fhv": a.fhv, "hvfhv": a.hvfhv},
        a.bases, a.zone_matrix, a.zone_lookup, daily=daily)
    checks = Checks()
    print(json.dumps(run_monthly(inputs, params, a.out, fmt=a.fmt, since=a.since, checks=checks)))
    print(json.dumps(checks.seen()))


if __name__ == "__main__":
    main()
