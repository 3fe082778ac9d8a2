"""Command-line entry points for the two batch/stream jobs.

    python -m tickyard.cli backfill --source T --target T --start 2024-01-05 --end 2024-01-09 \\
        [--granularity daily|hourly|monthly] [--batch-days N] [--files]
    python -m tickyard.cli ingest --files DIR | --kafka SERVERS --topic T \\
        --trades-table T --bars-path P --checkpoint C [--window "1 minute"] [--delay "5 minutes"]

Both run on the session given by spark-submit (or a local one) and use the
shared folder from ``spark.checkpoint.dir`` for staging.
"""

from __future__ import annotations

import argparse
import json

from .session import get_session


def _backfill(a) -> None:
    from .operators import tables as K
    spark = get_session(a.master)
    keys = ("trade_date", "symbol", "event_id")
    if a.files:
        out = K.backfill_from_files(spark, a.source, a.target, a.start, a.end, keys, a.version,
                                    fmt=a.format, time_col=a.time_col)
        print(json.dumps(out, default=str))
    else:
        for r in K.backfill(spark, a.source, a.target, a.start, a.end, keys, a.version,
                            granularity=a.granularity, batch_days=a.batch_days, time_col=a.time_col,
                            writers=a.partitions):
            print(json.dumps(r, default=str))


def _ingest(a) -> None:
    from .streaming import jobs as J
    from .streaming import sources as S
    spark = get_session(a.master, rocksdb_state=a.rocksdb)
    if a.kafka:
        rows = S.kafka_stream(spark, a.kafka, a.topic, starting_offsets=a.starting_offsets,
                              max_offsets_per_trigger=a.max_offsets,
                              fail_on_data_loss=not a.allow_data_loss)
    else:
        rows = S.file_stream(spark, a.files, max_files_per_trigger=a.max_files)
    qs = J.start_ingest(rows, a.trades_table, a.bars_path, a.dlq_path, a.checkpoint, every=a.window,
                        delay=a.delay, trigger=a.trigger, available_now=a.available_now,
                        source_topic=a.topic, buckets=a.buckets)
    if a.available_now:
        for q in qs:
            q.awaitTermination()
    else:
        J.await_any(spark, qs)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="tickyard")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    b = sub.add_parser("backfill", help="copy a date range into a keyed trade table")
    b.add_argument("--source", required=True)
    b.add_argument("--target", required=True)
    b.add_argument("--start", required=True)
    b.add_argument("--end", required=True)
    b.add_argument("--granularity", default="daily", choices=["daily", "hourly", "monthly"])
    b.add_argument("--batch-days", type=int, default=None)
    b.add_argument("--version", default="processed_at")
    b.add_argument("--time-col", default="event_time")
    b.add_argument("--partitions", type=int, default=None, help="writer tasks per slice")
    b.add_argument("--files", action="store_true", help="source is plain files, not a dated table")
    b.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    b.set_defaults(fn=_backfill)

    i = sub.add_parser("ingest", help="stream messages into the trade table and bar sink")
    src = i.add_mutually_exclusive_group(required=True)
    src.add_argument("--files")
    src.add_argument("--kafka")
    i.add_argument("--topic", default="market")
    i.add_argument("--starting-offsets", default="latest")
    i.add_argument("--max-offsets", type=int, default=None, help="rate cap per trigger")
    i.add_argument("--allow-data-loss", action="store_true", help="go on when broker offsets are lost")
    i.add_argument("--dlq-path", required=True, help="sink of rejected messages")
    i.add_argument("--buckets", type=int, default=1, help="key buckets of a new trade table")
    i.add_argument("--max-files", type=int, default=None, help="rate cap per trigger")
    i.add_argument("--trades-table", required=True)
    i.add_argument("--bars-path", required=True)
    i.add_argument("--checkpoint", required=True)
    i.add_argument("--window", default="1 minute")
    i.add_argument("--delay", default="5 minutes")
    i.add_argument("--trigger", default="5 seconds")
    i.add_argument("--available-now", action="store_true")
    i.add_argument("--rocksdb", action="store_true")
    i.set_defaults(fn=_ingest)

    a = p.parse_args(argv)
    a.fn(a)


if __name__ == "__main__":
    main()
