"""Command line of the jobs: ``python -m tallyward <job> ...`` or through spark-submit."""

from __future__ import annotations

import argparse
from contextlib import nullcontext

from tallyward.operators import reconcile, reports, scoring
from tallyward.plans import jobs
from tallyward.session import get_spark
from tallyward.sources import events, lake, models, sinks
from tallyward.streaming.metrics import recorded_progress
from tallyward.streaming.score import Settings, Sinks, score_stream


def _pairs(values: list[str]) -> dict[str, str]:
    return dict(v.split("=", 1) for v in values)


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="tallyward", description=__doc__)
    root.add_argument("--shuffle-partitions", type=int, default=None)
    sub = root.add_subparsers(dest="job", required=True)

    p = sub.add_parser("score-stream", help="score messages and write bronze, silver, gold and alert events")
    p.add_argument("--source-format", default="kafka")
    p.add_argument("--source-option", action="append", default=[], metavar="KEY=VALUE")
    p.add_argument("--source-path")
    p.add_argument("--per-trigger", type=int, help="messages (broker) or files (file source) per micro-batch")
    p.add_argument("--starting-offsets")
    p.add_argument("--model-path", required=True)
    p.add_argument("--raw-path", required=True)
    p.add_argument("--scored-path", required=True)
    p.add_argument("--alerts-path", required=True)
    p.add_argument("--quarantine-path", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--late-path", help="table for rows that come --late-seconds after their velocity bucket has ended")
    p.add_argument("--late-seconds", type=int)
    p.add_argument("--progress-path", help="table with a row for each micro-batch")
    p.add_argument("--events-path")
    p.add_argument("--events-format", default="text")
    p.add_argument("--events-option", action="append", default=[], metavar="KEY=VALUE")
    p.add_argument("--fraud-score-threshold", type=float, default=scoring.SCORE_THRESHOLD)
    p.add_argument("--high-amount-threshold", type=float, default=scoring.AMOUNT_THRESHOLD)
    p.add_argument("--velocity-threshold", type=float, default=scoring.VELOCITY_THRESHOLD)
    p.add_argument("--trigger-seconds", type=int, default=events.IDLE_SECONDS)
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--output-partitions", type=int)
    p.add_argument("--fail-on-bad-message", action="store_true")

    p = sub.add_parser("hourly", help="reconcile silver with labels and write the hourly tables")
    p.add_argument("--silver-path", required=True)
    labels = p.add_mutually_exclusive_group(required=True)
    labels.add_argument("--labels-csv")
    labels.add_argument("--labels-table", help="table that store-labels wrote")
    p.add_argument("--output-base", required=True)
    p.add_argument("--target-hour-utc", help="YYYY-MM-DD-HH; all hours when omitted")

    p = sub.add_parser("store-labels", help="add labels to a table in buckets of the business key")
    p.add_argument("--labels-csv", required=True)
    p.add_argument("--labels-table", required=True, help="database.table")
    p.add_argument("--buckets", type=int, default=sinks.LABEL_BUCKETS, help="fixed when the table is made")

    p = sub.add_parser("load", help="load the hourly tables into a warehouse database")
    p.add_argument("--base", required=True)
    p.add_argument("--database", required=True)
    p.add_argument("--tables", nargs="+", default=jobs.HOURLY_TABLES)
    p.add_argument("--write-disposition", choices=sorted(sinks.DISPOSITIONS), default="WRITE_TRUNCATE")
    p.add_argument("--create-dataset-if-missing", action="store_true")
    p.add_argument("--location")

    p = sub.add_parser("warehouse", help="build dimensions, facts and mart and run the assertions")
    p.add_argument("--base", required=True, help="folder of the hourly tables")
    p.add_argument("--output", required=True)
    p.add_argument("--hour-utc", action="append", help="YYYY-MM-DD-HH, may be repeated: update only these hours of a warehouse built before")

    p = sub.add_parser("refresh-model", help="retrain from the retraining table, or from silver and labels")
    p.add_argument("--retraining", help="table name or path")
    p.add_argument("--silver-path")
    p.add_argument("--labels-csv")
    p.add_argument("--model-output", required=True)
    p.add_argument("--model-seed", type=int, default=42)
    p.add_argument("--model-num-trees", type=int, default=120)
    p.add_argument("--model-max-depth", type=int, default=8)
    p.add_argument("--exclude-balances", action="store_true")

    p = sub.add_parser("train-baseline", help="first model from the labelled CSV")
    p.add_argument("--input", required=True)
    p.add_argument("--model-output", required=True)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--train-ratio", type=float, default=0.8)
    p.add_argument("--max-rows", type=int, default=75_000)
    p.add_argument("--num-trees", type=int, default=8)
    p.add_argument("--max-depth", type=int, default=4)
    p.add_argument("--exclude-balances", action="store_true")

    p = sub.add_parser("preview", help="newest rows of a lake table")
    p.add_argument("--path", required=True)
    p.add_argument("--format", choices=lake.FORMATS, default="parquet")
    p.add_argument("--limit", type=int, default=20)
    p.add_argument("--only-alerts", action="store_true")
    p.add_argument("--show-schema", action="store_true")
    return root


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = get_spark(f"tallyward-{args.job}", args.shuffle_partitions)

    if args.job == "score-stream":
        options = _pairs(args.source_option) | events.pacing_options(
            args.source_format, args.per_trigger, args.starting_offsets)
        messages = events.read_events(spark, args.source_format, options, args.source_path)
        paths = Sinks(
            bronze=args.raw_path, silver=args.scored_path, gold=args.alerts_path,
            quarantine=args.quarantine_path, checkpoint=args.checkpoint, events=args.events_path,
            late=args.late_path, events_format=args.events_format, events_options=_pairs(args.events_option))
        settings = Settings(
            score_threshold=args.fraud_score_threshold, amount_threshold=args.high_amount_threshold,
            velocity_threshold=args.velocity_threshold, files_per_batch=args.output_partitions,
            trigger_seconds=args.trigger_seconds, available_now=args.available_now,
            fail_on_bad_message=args.fail_on_bad_message, late_seconds=args.late_seconds)
        with recorded_progress(spark, args.progress_path) if args.progress_path else nullcontext():
            score_stream(messages, models.load_serving(spark, args.model_path), paths, settings).awaitTermination()
    elif args.job == "hourly":
        labels = spark.table(args.labels_table) if args.labels_table else lake.read_labels(spark, args.labels_csv)
        counts = jobs.hourly_from_lake(
            spark, args.silver_path, labels, args.output_base, args.target_hour_utc)
        print(counts)
    elif args.job == "store-labels":
        sinks.store_labels(lake.read_labels(spark, args.labels_csv), args.labels_table, args.buckets)
    elif args.job == "load":
        print(jobs.load(spark, args.base, args.database, args.tables, args.write_disposition,
                        args.create_dataset_if_missing, args.location))
    elif args.job == "warehouse":
        built = jobs.build_warehouse(
            spark, lake.read_table_layout(spark, args.base, "curated_scored"),
            lake.read_table_layout(spark, args.base, "monitoring_hourly"), args.output,
            [reconcile.parse_hour(h) for h in args.hour_utc] if args.hour_utc else None)
        failed = built.failed()
        print(failed or "all assertions hold")
        return 1 if failed else 0
    elif args.job == "refresh-model":
        options = {"trees": args.model_num_trees, "depth": args.model_max_depth, "seed": args.model_seed,
                   "exclude_balances": args.exclude_balances}
        if args.retraining:
            _, message, _ = jobs.refresh_model(spark, args.retraining, args.model_output, **options)
        elif args.silver_path and args.labels_csv:
            _, message, _ = jobs.refresh_from_lake(
                spark, lake.read_silver(spark, args.silver_path), lake.read_labels(spark, args.labels_csv),
                args.model_output, **options)
        else:
            raise SystemExit("Give --retraining, or --silver-path with --labels-csv")
        print(message)
    elif args.job == "train-baseline":
        trained = jobs.train_first_model(
            spark, args.input, args.model_output, trees=args.num_trees, depth=args.max_depth, seed=args.seed,
            train_ratio=args.train_ratio, max_rows=args.max_rows,
            exclude_balances=args.exclude_balances)
        print(f"Model saved to {args.model_output} with validation AUC={trained.auc:.4f}")
    elif args.job == "preview":
        df = lake.read_lake(spark, args.path, args.format)
        if args.show_schema:
            df.printSchema()
        reports.lake_preview(df, args.limit, args.only_alerts).show(args.limit, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
