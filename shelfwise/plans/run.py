"""Command line of the jobs, for ``spark-submit`` or ``python -m shelfwise.plans.run``.

    run batch --feed FEED --out OUT [--feed-format csv] [--report-format parquet] [--report-names]
    run update --feed FEED --out OUT
    run train --sales TABLE --out OUT [--holidays TABLE] [--store S --product P]

``update`` adds a CSV feed to what earlier updates of OUT have written; ``train`` reads the cleaned
table that ``batch`` or ``update`` wrote. Master, memory and the
shared checkpoint folder come from the session the job is submitted with.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.columns import day_rows
from shelfwise.operators.features import HOLIDAYS_2022_2023
from shelfwise.plans.batch import run_batch, stored_row_counts
from shelfwise.plans.incremental import update_batch
from shelfwise.plans.settings import session_settings
from shelfwise.plans.training import run_training
from shelfwise.sources.files import forget_staged, input_bytes


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="shelfwise")
    parser.add_argument("--shuffle-gib", type=float, help="size of the widest shuffle; else the input's size tells")
    jobs = parser.add_subparsers(dest="job", required=True)
    batch = jobs.add_parser("batch")
    batch.add_argument("--feed", required=True)
    batch.add_argument("--out", required=True)
    batch.add_argument("--feed-format", default="csv")
    batch.add_argument("--report-format", default="parquet")
    batch.add_argument("--report-names", action="store_true")
    update = jobs.add_parser("update")
    update.add_argument("--feed", required=True)
    update.add_argument("--out", required=True)
    train = jobs.add_parser("train")
    train.add_argument("--sales", required=True)
    train.add_argument("--out", required=True)
    train.add_argument("--holidays", help="table with a holiday column; else the two sample years")
    train.add_argument("--store")
    train.add_argument("--product")
    train.add_argument("--test-fraction", type=float, default=0.2)
    train.add_argument("--trees", type=int, default=200)
    train.add_argument("--depth", type=int, default=15)
    train.add_argument("--lookback", type=int, default=30)
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName(f"shelfwise-{args.job}").getOrCreate()
    source = args.sales if args.job == "train" else args.feed
    shuffled = int(args.shuffle_gib * 1024**3) if args.shuffle_gib else input_bytes(spark, source)
    for key, value in session_settings(shuffled, spark.sparkContext.defaultParallelism).items():
        spark.conf.set(key, value)
    if args.job == "batch":
        result = run_batch(
            spark, args.feed, args.out, args.feed_format, args.report_format, args.report_names
        )
        reports = {name: path for name, path in result.paths.items() if name != "clean_sales"}
        stored_row_counts(spark, reports, args.report_format).show(truncate=False)
        print(f"critical alerts: {result.critical_alerts}")
        return
    if args.job == "update":
        print(update_batch(spark, args.feed, args.out))
        forget_staged(spark)
        return
    holidays = (
        spark.read.parquet(args.holidays) if args.holidays else day_rows(spark, HOLIDAYS_2022_2023, "holiday")
    )
    comparison = run_training(
        spark.read.parquet(args.sales),
        holidays,
        args.out,
        args.store,
        args.product,
        test_fraction=args.test_fraction,
        num_trees=args.trees,
        max_depth=args.depth,
        lookback=args.lookback,
    )
    comparison.groupBy("model").agg(
        F.count_if(F.col("rank") == 1).alias("series_won"), F.avg("mape").alias("mean_mape")
    ).orderBy(F.desc("series_won")).show(truncate=False)
    forget_staged(spark)


if __name__ == "__main__":
    main()
