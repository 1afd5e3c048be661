"""Jobs for ``spark-submit``: train, score, runs, promote.

    spark-submit jobs.py train --raw RAW --root WORK [--model NAME] [--max-rows N] [--promote]
    spark-submit jobs.py score --root WORK --run RUN --input CSV --output FOLDER [--raw RAW]
    spark-submit jobs.py runs --root WORK [--metric test_pr_auc] [--count 10]
    spark-submit jobs.py promote --root WORK --run RUN [--overwrite]
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskloom.config import RiskConfig  # noqa: E402
from riskloom.plans import training  # noqa: E402
from riskloom.plans.scoring import ScoringService  # noqa: E402
from riskloom.plans.store import RunStore  # noqa: E402
from riskloom.session import pinned_scope  # noqa: E402
from riskloom.sources.files import load_all  # noqa: E402


def train(spark: SparkSession, args: argparse.Namespace) -> str:
    cfg = RiskConfig(model_name=args.model, max_rows=args.max_rows)
    run_id = training.run(spark, load_all(spark, args.raw), args.root, cfg, args.promote, args.overwrite)
    print(run_id)
    return run_id


def score(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = load_all(spark, args.raw) if args.raw else {}
    dimensions = {k: raw[k] for k in ("cards", "users", "mcc") if k in raw}
    with pinned_scope(spark):
        service = ScoringService.load(spark, RunStore(spark, args.root).run_directory(args.run), dimensions)
        service.predict_csv(spark, args.input, args.output)


def runs(spark: SparkSession, args: argparse.Namespace) -> None:
    RunStore(spark, args.root).leaderboard(args.metric, args.count).show(args.count, truncate=False)


def promote(spark: SparkSession, args: argparse.Namespace) -> None:
    RunStore(spark, args.root).promote(args.run, args.overwrite)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = top.add_subparsers(dest="job", required=True)

    def job(fn, *needed: str) -> argparse.ArgumentParser:
        one = jobs.add_parser(fn.__name__)
        one.set_defaults(run_job=fn)
        for name in needed:
            one.add_argument(f"--{name}", required=True)
        return one

    one = job(train, "raw", "root")
    one.add_argument("--model", default=RiskConfig.model_name)
    one.add_argument("--max-rows", type=int)
    one.add_argument("--promote", action="store_true")
    one.add_argument("--overwrite", action="store_true")
    one = job(score, "root", "run", "input", "output")
    one.add_argument("--raw")
    one = job(runs, "root")
    one.add_argument("--metric", default="test_pr_auc")
    one.add_argument("--count", type=int, default=10)
    one = job(promote, "root", "run")
    one.add_argument("--overwrite", action="store_true")
    return top


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"riskloom-{args.job}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    args.run_job(spark, args)


if __name__ == "__main__":
    main()
