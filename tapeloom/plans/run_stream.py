"""Job: one of the streaming queries.

    spark-submit job.py run_stream ingest FRAMES LOG HISTORY --checkpoint DIR (--rejects DIR | --drop-rejects)
    spark-submit job.py run_stream ingest TOPIC LOG HISTORY --kafka SERVERS --checkpoint DIR (--rejects DIR | --drop-rejects)
    spark-submit job.py run_stream orderflow LOG OUT --checkpoint DIR
    spark-submit job.py run_stream score LOG OUT --checkpoint DIR [--model DIR]
    spark-submit job.py run_stream tail LOG --checkpoint DIR
    spark-submit job.py run_stream replay HISTORY OUT [--start-ts MS --end-ts MS]

A replay is no stream but one ordered write of the days it touches.
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import session
from ..sources import history, paths, raw
from ..streaming import ingest, orderflow, replay, scoring, tail


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("query", choices=["ingest", "orderflow", "score", "tail", "replay"])
    parser.add_argument("source")
    parser.add_argument("sinks", nargs="*")
    parser.add_argument("--checkpoint")
    parser.add_argument("--rejects", help="keep bad frames here; without it the first one ends an ingest")
    parser.add_argument("--drop-rejects", action="store_true", help="leave bad frames out of an ingest")
    parser.add_argument("--new-only", action="store_true", help="pass over what is there at the start")
    parser.add_argument("--max-bytes", type=int, help="bytes per micro-batch")
    parser.add_argument("--max-files", type=int, help="files per micro-batch")
    parser.add_argument("--kafka", help="servers; the source of an ingest is then a topic")
    parser.add_argument("--max-offsets", type=int, help="records of a topic per micro-batch")
    parser.add_argument("--symbol")
    parser.add_argument("--model")
    parser.add_argument("--start-ts", type=int, help="first ms to replay, by default a minute before the last")
    parser.add_argument("--end-ts", type=int, help="last ms to replay, by default now")
    parser.add_argument("--every", help="trigger interval; without it the query ends with the backlog")
    return parser.parse_args(argv)


def publish(args: argparse.Namespace, spark: SparkSession) -> str:
    (out,) = args.sinks
    end = int(time.time() * 1000) if args.end_ts is None else args.end_ts
    begin = end - replay.DEFAULT_SPAN_MS if args.start_ts is None else args.start_ts
    return replay.publish(history.open_history(spark, args.source), begin, end, out)


def landed(args: argparse.Namespace, spark: SparkSession, caps: dict) -> DataFrame:
    """The raw frames of an ingest, from a folder or a topic."""
    if not args.kafka:
        return raw.stream_frames(spark, args.source, **caps)
    most = {"max_offsets_per_trigger": args.max_offsets} if args.max_offsets else {}
    return raw.stream_kafka(spark, args.kafka, args.source, starting="latest" if args.new_only else "earliest", **most)


def start(args: argparse.Namespace, spark: SparkSession) -> StreamingQuery:
    when = {"processingTime": args.every} if args.every else {"availableNow": True}
    caps = {"max_files_per_trigger": args.max_files}
    if args.new_only:
        # A restart goes on from the checkpoint, with the time of the first start.
        caps["since_ms"] = int(paths.remembered(spark, args.checkpoint, "since", str(int(time.time() * 1000))))
    if args.max_bytes:
        caps["max_bytes_per_trigger"] = args.max_bytes
    if args.query == "ingest":
        log, past = args.sinks
        return ingest.start(
            landed(args, spark, caps),
            log,
            past,
            args.checkpoint,
            rejects_path=args.rejects,
            symbol=args.symbol,
            drop_rejects=args.drop_rejects,
            trigger=when,
        )
    trades = raw.stream_trades(spark, args.source, **caps)
    if args.query == "tail":
        return tail.tail(trades, args.checkpoint, trigger=when)
    (out,) = args.sinks
    if args.query == "orderflow":
        return orderflow.start(trades, out, args.checkpoint, trigger=when)
    return scoring.start(scoring.entries_of(trades), out, args.checkpoint, model_path=args.model, trigger=when)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = arguments(argv)
    if args.query == "replay":
        publish(args, spark or session.create("replay"))
        return
    if not args.checkpoint:
        raise SystemExit("a stream needs --checkpoint")
    start(args, spark or session.create(f"stream_{args.query}")).awaitTermination()


if __name__ == "__main__":
    main()
