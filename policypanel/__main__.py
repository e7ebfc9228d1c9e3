"""Command line for the end-to-end jobs (works under ``spark-submit`` too).

    python -m policypanel clean-register OUT YEAR=PATH [YEAR=PATH ...] [--table T]
    python -m policypanel clean-events   CSV OUT [--table T]
    python -m policypanel enrich-events  CSV OUT
    python -m policypanel profile        CSV OUT
    python -m policypanel stats          TABLE_OR_CSV_DIR OUT COLUMN [COLUMN ...]
    python -m policypanel prepost        CSV OUT [--year-max Y]
    python -m policypanel did            TABLE_OR_CSV_DIR OUT

Outputs are written under OUT; the summary tables are also shown on stdout.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from policypanel import schemas as SC
from policypanel.plans import jobs
from policypanel.sinks import write_single_csv
from policypanel.sources.csv import read_csv


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="policypanel")
    sub = ap.add_subparsers(dest="job", required=True)
    a = sub.add_parser("clean-register")
    a.add_argument("out")
    a.add_argument("years", nargs="+", help="YEAR=PATH per yearly extract")
    a.add_argument("--table")
    b = sub.add_parser("clean-events")
    b.add_argument("csv")
    b.add_argument("out")
    b.add_argument("--table")
    for name in ("enrich-events", "profile"):
        p = sub.add_parser(name)
        p.add_argument("csv")
        p.add_argument("out")
    q = sub.add_parser("stats")
    q.add_argument("panel", help="catalog table name or folder of cleaned register CSV")
    q.add_argument("out")
    q.add_argument("columns", nargs="+")
    c = sub.add_parser("prepost")
    c.add_argument("csv")
    c.add_argument("out")
    c.add_argument("--year-max", type=int)
    d = sub.add_parser("did")
    d.add_argument("panel", help="catalog table name or folder of cleaned register CSV")
    d.add_argument("out")
    args = ap.parse_args(argv)

    def register_panel(name: str):
        if "/" not in name:
            return spark.table(name)
        return read_csv(spark, name, ", ".join(f"{n} {t}" for n, t in SC.REGISTER_COLUMNS))

    spark = SparkSession.builder.appName(f"policypanel-{args.job}").getOrCreate()
    if args.job == "clean-register":
        paths = {int(y): p for y, p in (item.split("=", 1) for item in args.years)}
        out = jobs.clean_register_job(spark, paths, args.out, table=args.table)
        show = ["audit", "verify"]
    elif args.job == "clean-events":
        out = jobs.clean_events_job(spark, args.csv, args.out, table=args.table)
        show = ["count"] if args.table else []
    elif args.job == "enrich-events":
        out = jobs.enrich_events_job(spark, args.csv, args.out)
        show = ["verify", "describe", "stats"]
    elif args.job == "profile":
        raw = read_csv(spark, args.csv, SC.collision_schema())
        out = jobs.profile_job(raw, ["BOROUGH"], SC.COLLISION_COUNTS, [jobs.FACTOR])
        for name, df in out.items():
            write_single_csv(df, f"{args.out.rstrip('/')}/{name}")
        show = ["profile", "distinct"]
    elif args.job == "stats":
        out = {"stats": jobs.stats_job(register_panel(args.panel), args.columns)}
        write_single_csv(out["stats"], args.out)
        show = ["stats"]
    elif args.job == "prepost":
        raw = read_csv(spark, args.csv, SC.collision_schema())
        out = jobs.prepost_job(spark, raw, out_base=args.out, year_max=args.year_max)
        show = ["pre_post_summary", "borough_pre_post"]
    else:
        panel = register_panel(args.panel)
        out = jobs.did_job(spark, panel, out_base=args.out)
        show = ["did_summary"]
    for name in show:
        print(f"== {name} ==")
        out[name].show(50, truncate=False)


if __name__ == "__main__":
    main()
