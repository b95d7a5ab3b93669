"""Command line: ``python -m sluice <step> --odate YYYY-MM-DD ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from sluice.functions.clock import iso_date
from sluice.plans.gate import run_gate
from sluice.plans.medallion import ingest_bronze, promote_silver, publish_gold, refresh
from sluice.plans.rulebook import STAGES
from sluice.sources.raw import require_landed
from sluice.sources.tables import Lake


def _date(value: str):
    try:
        return iso_date(value)
    except ValueError as error:
        raise argparse.ArgumentTypeError(str(error)) from error


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="sluice", description=__doc__)
    steps = main.add_subparsers(dest="step", required=True)
    for name, wants in {
        "landed": ("raw",),
        "bronze": ("raw",),
        "gate": ("stage", "run"),
        "silver": (),
        "gold": (),
        "refresh": ("raw", "run"),
    }.items():
        step = steps.add_parser(name)
        step.add_argument("--odate", required=True, type=_date)
        step.add_argument("--catalog")
        step.add_argument("--format", default="parquet", choices=("parquet", "delta"))
        if "raw" in wants:
            step.add_argument("--raw-root", required=True)
        if "stage" in wants:
            step.add_argument("--stage", required=True, choices=STAGES)
        if "run" in wants:
            step.add_argument("--run-id", required=True)
            step.add_argument("--revoke-on-failure", action="store_true")
    return main


def run(spark: SparkSession, arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    lake = Lake(spark, args.catalog, args.format)
    match args.step:
        case "landed":
            require_landed(spark, args.raw_root, args.odate)
        case "bronze":
            ingest_bronze(lake, args.raw_root, args.odate)
        case "gate":
            run_gate(
                lake,
                args.stage,
                args.odate,
                args.run_id,
                revoke_on_failure=args.revoke_on_failure,
            )
        case "silver":
            promote_silver(lake, args.odate)
        case "gold":
            publish_gold(lake, args.odate)
        case "refresh":
            refresh(lake, args.raw_root, args.odate, args.run_id)


if __name__ == "__main__":
    run(SparkSession.builder.appName("sluice").getOrCreate())
