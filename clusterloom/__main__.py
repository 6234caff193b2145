"""``spark-submit``-able entry: the clustering job, or a word count of text files.

    python -m clusterloom cluster
    python -m clusterloom words PATH...
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from clusterloom.config import (
    CONNECTIONS,
    FOOD_BOUNDS,
    FOOD_FEATURES,
    FOOD_K,
    FOOD_MODEL_PATH,
    FOOD_SEED_PATH,
    JobConfig,
)
from clusterloom.operators.counting import word_count
from clusterloom.plans.job import run_job


def job_config(args: argparse.Namespace) -> JobConfig:
    """Options of the command line; without --bound the food bounds of the chosen features hold."""
    bounds = {name: pair for name, pair in FOOD_BOUNDS.items() if name in args.features}
    if args.bound:
        bounds = {name: (float(low), float(high)) for name, low, high in args.bound}
    return JobConfig.from_env(
        seed_path=args.seed_path,
        seed_limit=args.seed_limit,
        seed_order=tuple(args.seed_order),
        model_path=args.model_path,
        partition_column=args.partition_column,
        connections=args.connections,
        k=args.k,
        features=tuple(args.features),
        bounds=bounds,
    )


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="clusterloom")
    commands = parser.add_subparsers(dest="command", required=True)
    cluster = commands.add_parser("cluster", help="run the clustering job on the database in DB_URL")
    cluster.add_argument("--seed-path", default=FOOD_SEED_PATH)
    cluster.add_argument("--model-path", default=FOOD_MODEL_PATH)
    cluster.add_argument("--seed-limit", type=int, help="load only so many rows, needs --seed-order")
    cluster.add_argument("--seed-order", nargs="+", default=[], metavar="COLUMN")
    cluster.add_argument("--partition-column", help="numeric column by whose ranges the source is read")
    cluster.add_argument("--connections", type=int, default=CONNECTIONS)
    cluster.add_argument("-k", type=int, default=FOOD_K, help="number of clusters")
    cluster.add_argument("--feature", nargs="+", dest="features", default=list(FOOD_FEATURES), metavar="COLUMN")
    cluster.add_argument(
        "--bound", nargs=3, action="append", metavar=("COLUMN", "LOW", "HIGH"), help="closed range of a feature"
    )
    words = commands.add_parser("words", help="count the words of text files")
    words.add_argument("path", nargs="+")
    words.add_argument("--top", type=int, default=20)
    args = parser.parse_args(argv)

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s")
    spark = SparkSession.builder.appName("clusterloom").getOrCreate()
    if args.command == "cluster":
        print(run_job(spark, job_config(args)))
    else:
        counts = word_count(spark.read.text(args.path), "value")
        counts.orderBy(F.desc("count"), "word").limit(args.top).show(args.top, truncate=False)


if __name__ == "__main__":
    main()
