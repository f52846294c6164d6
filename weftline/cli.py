"""Command line: ``python -m weftline.cli train|forecast`` (or as the main file of spark-submit)."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import fields

from pyspark.sql import SparkSession

from weftline.plans.jobs import ForecastConfig, TrainConfig, run_forecast, run_train

JOBS = {"train": (TrainConfig, run_train), "forecast": (ForecastConfig, run_forecast)}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="weftline")
    jobs = top.add_subparsers(dest="job")
    for name, (config, _) in JOBS.items():
        sub = jobs.add_parser(name)
        for f in fields(config):
            kind = str(f.type)
            flag = f"--{f.name.replace('_', '-')}"
            if kind == "bool":
                sub.add_argument(flag, action=argparse.BooleanOptionalAction, default=f.default)
            elif kind.startswith("tuple[int"):
                sub.add_argument(flag, type=int, nargs="+", default=list(f.default))
            elif kind.startswith("tuple[str"):
                sub.add_argument(flag, nargs="+", default=list(f.default))
            elif kind == "dict":
                sub.add_argument(flag, type=json.loads, default={})
            else:
                sub.add_argument(flag, type=int if kind == "int" else str, default=f.default)
    return top


def main(argv: list[str] | None = None) -> int:
    top = parser()
    args = vars(top.parse_args(argv))
    job = args.pop("job")
    if job is None:
        top.print_usage(sys.stderr)
        return 1
    config, run = JOBS[job]
    args = {k: tuple(v) if isinstance(v, list) else v for k, v in args.items()}
    spark = SparkSession.builder.appName(f"weftline-{job}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    found = run(spark, config(**args))
    if isinstance(found, dict):
        print(json.dumps({k: found[k] for k in ("version", "baseline_wape", "model_wape", "model_mae")}, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
