"""Command line: ``python -m campaignlake <job> ...`` (spark-submit friendly).

Jobs mirror the reference's batch scripts; dates are explicit parameters
(default: today).  Paths may be any Hadoop file system URI.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import functions as F


def _today() -> str:
    return dt.date.today().isoformat()


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="campaignlake")
    ap.add_argument("--profile", default="cluster", choices=["cluster", "local"],
                    help="session defaults (cluster: RocksDB streaming state, 128 MB partitions)")
    sub = ap.add_subparsers(dest="job", required=True)

    p = sub.add_parser("csv-flow", help="delimited delivery -> raw -> ods -> dm.campaign_daily")
    p.add_argument("--delivery", required=True)
    p.add_argument("--lake", required=True)
    p.add_argument("--processing-date", default=None)

    p = sub.add_parser("message-flow", help="messages -> raw -> ods -> lite mart")
    p.add_argument("--source", required=True, help="folder of messages, or topic with --format kafka")
    p.add_argument("--lake", required=True)
    p.add_argument("--format", default="text", choices=["text", "kafka"])
    p.add_argument("--bootstrap", default=None, help="kafka.bootstrap.servers")
    p.add_argument("--processing-date", default=None)

    p = sub.add_parser("features", help="ml.user_features for one snapshot date")
    p.add_argument("--lake", required=True)
    p.add_argument("--snapshot-date", default=_today())

    p = sub.add_parser("train", help="fit the click model on one feature snapshot")
    p.add_argument("--lake", required=True)
    p.add_argument("--snapshot-date", default=_today())
    p.add_argument("--model", required=True)

    p = sub.add_parser("score", help="score users and write ml.click_predictions")
    p.add_argument("--lake", required=True)
    p.add_argument("--snapshot-date", default=_today())
    p.add_argument("--model", required=True)

    p = sub.add_parser("compact", help="rewrite small files of selected partitions")
    p.add_argument("--table", required=True)
    p.add_argument("--partition", default="event_date")
    p.add_argument("--where", default=None)
    p.add_argument("--rows-per-file", type=int, default=5_000_000)

    p = sub.add_parser("tier", help="move days older than the hot window to the cold table")
    p.add_argument("--table", required=True)
    p.add_argument("--cold", required=True)
    p.add_argument("--partition", default="event_date")
    p.add_argument("--as-of", default=_today())
    p.add_argument("--hot-days", type=int, default=30)
    p.add_argument("--ttl-days", type=int, default=None)

    p = sub.add_parser("stream-changes", help="append the actions change stream to ods.fct_actions")
    p.add_argument("--source", required=True)
    p.add_argument("--table", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--format", default="text", choices=["text", "kafka"])
    p.add_argument("--bootstrap", default=None)
    p.add_argument("--continuous", action="store_true", help="run with a 300 s trigger instead of once")

    for name, help_text in (("stream-events", "messages -> de-duplicated ods.banner_events (watermarked)"),
                            ("stream-window", "messages -> events without repeats within 10 minutes"),
                            ("ship-lines", "tail delimited files into JSON log messages")):
        p = sub.add_parser(name, help=help_text)
        p.add_argument("--source", required=True)
        p.add_argument("--table", required=True)
        p.add_argument("--checkpoint", required=True)
        if name != "ship-lines":
            p.add_argument("--format", default="text", choices=["text", "kafka"])
            p.add_argument("--bootstrap", default=None)
        else:
            p.add_argument("--growing", action="store_true", help="also ship lines that files get later; rotated files go on")
        p.add_argument("--continuous", action="store_true", help="keep running instead of once")

    args = ap.parse_args(argv)

    from campaignlake.operators import lifecycle, model
    from campaignlake.plans import flows
    from campaignlake.session import build_session
    from campaignlake.streaming import changes, events

    spark = build_session(app_name=f"campaignlake-{args.job}", profile=args.profile)
    opts = {"kafka.bootstrap.servers": args.bootstrap} if getattr(args, "bootstrap", None) else None
    if args.job == "csv-flow":
        flows.csv_flow(spark, args.delivery, args.lake, args.processing_date)
    elif args.job == "message-flow":
        flows.banner_events_flow(spark, args.source, args.lake, args.format, opts, args.processing_date)
    elif args.job == "features":
        flows.ml_daily_flow(spark, args.lake, args.snapshot_date)
    elif args.job in ("train", "score"):
        feats = spark.read.parquet(f"{args.lake}/ml/user_features") \
            .filter(F.col("snapshot_date") == F.lit(args.snapshot_date).cast("date"))
        if args.job == "train":
            m, _, test = model.train_click_model(feats)
            auc = model.evaluate_auc(m, test)
            model.save_model_with_meta(spark, m, args.model, {"roc_auc": auc})
            print(json.dumps({"roc_auc": auc}))
        else:
            m, _ = model.load_model_with_meta(spark, args.model)
            lifecycle.write_predictions(model.score_users(m, feats), f"{args.lake}/ml/click_predictions")
    elif args.job == "compact":
        lifecycle.compact_partitions(spark, args.table, args.partition, args.where, args.rows_per_file)
    elif args.job == "tier":
        lifecycle.tier_hot_cold(spark, args.table, args.cold, args.partition, args.as_of,
                                args.hot_days, args.ttl_days)
    elif args.job in ("stream-events", "stream-window", "ship-lines"):
        once = not args.continuous
        if args.job == "stream-events":
            q = events.stream_banner_events(spark, args.source, args.table, args.checkpoint,
                                            available_now=once, fmt=args.format, options=opts)
        elif args.job == "stream-window":
            q = events.stream_dedup_within_window(spark, args.source, args.table, args.checkpoint,
                                                  available_now=once, fmt=args.format, options=opts)
        else:
            q = events.ship_lines(spark, args.source, args.table, args.checkpoint, available_now=once, growing=args.growing)
        if args.continuous:
            q.awaitTermination()
    elif args.job == "stream-changes":
        q = changes.append_stream_to_table(spark, args.source, args.table, args.checkpoint,
                                           available_now=not args.continuous, fmt=args.format,
                                           options=opts)
        if args.continuous:
            q.awaitTermination()


if __name__ == "__main__":
    main()
