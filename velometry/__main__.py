"""Run one job: ``spark-submit -m velometry`` style, e.g.

python -m velometry popularity --trips trips.csv --format csv --out results --year 2016
"""

from __future__ import annotations

import argparse

from velometry.plans import jobs
from velometry.session import build_session


# What each job cannot do without.
NEEDS = {
    "popularity": ("trips",),
    "add-trips": ("trips",),
    "stations": ("trips", "stations"),
    "balance": ("trips", "stations"),
    "slow-taxi": ("trips", "taxi", "year"),
    "placement": (),
    "duration": (),
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="velometry", description=__doc__)
    parser.add_argument("job", choices=list(NEEDS))
    parser.add_argument("--trips")
    parser.add_argument("--stations")
    parser.add_argument("--taxi")
    parser.add_argument("--out", required=True)
    parser.add_argument("--year", type=int)
    parser.add_argument("--first", type=int, help="only the earliest taxi trips")
    parser.add_argument("--buckets", type=int, help="store the flow by station, in so many files")
    parser.add_argument("--format", default="parquet")
    parser.add_argument(
        "--time-format", action="append", default=[], help="pattern of text times; may be repeated"
    )
    parser.add_argument("--bad", choices=["error", "null", "refuse"], default="error")
    parser.add_argument(
        "--max-refused", type=float, default=0.01, help="share of rows that may be refused"
    )
    parser.add_argument("--zone", help="the city's zone, where times are instants")
    args = parser.parse_args(argv)
    absent = [f"--{name}" for name in NEEDS[args.job] if getattr(args, name) is None]
    if absent:
        parser.error(f"{args.job} needs {', '.join(absent)}")
    reading = {
        "formats": args.time_format,
        "bad": args.bad,
        "zone": args.zone,
        "max_refused": args.max_refused,
    }
    spark = build_session()
    if args.job == "popularity":
        jobs.popularity_tables(spark, args.trips, args.out, args.year, args.format, **reading)
    elif args.job == "add-trips":
        added = jobs.add_trip_files(spark, args.trips, args.out, args.format, **reading)
        print(f"{len(added)} files counted")
    elif args.job == "stations":
        jobs.station_tables(spark, args.trips, args.stations, args.out, args.format, **reading)
    elif args.job == "balance":
        jobs.balance_tables(
            spark, args.trips, args.stations, args.out, args.format, args.buckets, **reading
        )
    elif args.job == "slow-taxi":
        jobs.slow_taxi_table(
            spark,
            args.trips,
            args.taxi,
            args.out,
            args.year,
            args.format,
            args.first,
            **reading,
        )
    elif args.job == "placement":
        jobs.placement_tables(spark, args.out)
    else:
        for features, error in jobs.duration_model(spark, args.out).items():
            print(f"RMSE, {features}: {error:.3f}")


if __name__ == "__main__":
    main()
