"""Live job: trip messages to zone windows, with unusable messages kept aside.

    spark-submit --py-files wayfare.zip wayfare/plans/live.py \\
        --brokers HOST:9092 --topic trips --output PATH --checkpoint PATH
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from wayfare.session import build_session, stream_settings, use_utc
from wayfare.sinks.jdbc import JdbcTarget, run_statement, upsert_writer
from wayfare.sources.messages import (
    kafka_options,
    parse_messages,
    read_kafka,
    read_message_files,
    rejected,
    usable,
)
from wayfare.streaming.progress import late_rows
from wayfare.streaming.upsert import start_emissions
from wayfare.streaming.windows import (
    DELAYS,
    stream_zone_windows,
    with_event_time,
    with_heartbeats,
    with_processing_time,
)
from wayfare.tables import REAL_TIME_ZONES


def zone_windows(
    messages: DataFrame,
    width: str = "1 minute",
    event_column: str | None = None,
    delay: str | None = None,
    heartbeats: bool = False,
) -> DataFrame:
    """Zone windows of a message stream, by processing time unless an event column is named.

    Without a delay that of the column counts. With ``heartbeats`` the clock closes windows by
    processing time, also where no messages come.
    """
    trips = usable(parse_messages(messages, event_column=event_column))
    if not event_column:
        timed = with_heartbeats(trips, delay or "1 minute") if heartbeats else with_processing_time(trips)
        return stream_zone_windows(timed, width)
    return stream_zone_windows(with_event_time(trips, event_column, delay or DELAYS[event_column]), width)


def start_windows(
    messages: DataFrame,
    output: str,
    checkpoint: str,
    width: str = "1 minute",
    event_column: str | None = None,
    delay: str | None = None,
    interval: str | None = "5 seconds",
    parallelism: int | None = None,
    closed_only: bool = False,
    compact_every: int | None = None,
) -> StreamingQuery:
    """Start storing zone windows, every ``interval`` or over everything available.

    ``closed_only`` stores each window once, when it is over: by the clock, unless an event column is
    named. ``compact_every`` so many batches the emissions are folded together.
    """
    windows = zone_windows(messages, width, event_column, delay, closed_only)
    return start_emissions(
        windows,
        output,
        checkpoint,
        "append" if closed_only else "update",
        interval=interval,
        parallelism=parallelism,
        keys=REAL_TIME_ZONES.keys,
        compact_every=compact_every,
    )


def start_upserts(
    windows: DataFrame,
    target: JdbcTarget,
    checkpoint: str,
    execute: Callable[[str], None],
    stream: str = "live",
    interval: str | None = "5 seconds",
    parallelism: int | None = None,
) -> StreamingQuery:
    """Start upserting zone windows into ``real_time_zones``; the stored window end is kept.

    Each stream stages in a table of its own, so two of them do not meet.
    """
    table = REAL_TIME_ZONES
    replace = [c for c in table.schema.names if c not in (*table.keys, "window_end")]
    writer = upsert_writer(
        table.name, target, table.keys, replace, execute, f"{table.name}_staging_{stream}"
    )
    query = windows.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    with stream_settings(windows.sparkSession, parallelism):
        return query.foreachBatch(writer).trigger(**trigger).start()


def start_rejects(
    messages: DataFrame,
    output: str,
    checkpoint: str,
    interval: str | None = "5 seconds",
    event_column: str | None = None,
) -> StreamingQuery:
    """Append unusable messages and their reasons to Parquet."""
    writer = (
        rejected(parse_messages(messages, event_column=event_column))
        .writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser()
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--brokers", help="Kafka bootstrap servers")
    source.add_argument("--files", help="folder of text files, one message per line")
    parser.add_argument("--topic", help="Kafka topic")
    parser.add_argument("--group", default="wayfare-zone-windows")
    parser.add_argument("--starting-offsets", default="latest")
    parser.add_argument("--width", default="1 minute")
    parser.add_argument(
        "--event-column", choices=sorted(DELAYS), help="event time; default is processing time"
    )
    parser.add_argument("--delay", help="default: 1 hour by pickup, 10 seconds by producer time")
    parser.add_argument("--allow-data-loss", action="store_true", help="skip expired messages")
    parser.add_argument("--per-trigger", type=int, help="files or messages a trigger takes at most")
    parser.add_argument("--interval", default="5 seconds")
    parser.add_argument("--once", action="store_true", help="stop when all input is read")
    parser.add_argument("--closed-only", action="store_true", help="store a window once, when it is over")
    parser.add_argument("--compact-every", type=int, help="batches after which emissions are folded")
    parser.add_argument("--parallelism", type=int, help="state partitions of a new checkpoint")
    parser.add_argument("--jdbc-url", help="upsert windows there instead of below --output")
    parser.add_argument("--jdbc-property", nargs="*", default=[], help="name=value")
    parser.add_argument("--output", required=True)
    parser.add_argument("--checkpoint", required=True)
    args = parser.parse_args(argv)
    if args.brokers and not args.topic:
        parser.error("--brokers needs --topic")
    if args.closed_only and args.once and not args.event_column:
        parser.error("--closed-only by processing time needs a running clock: not with --once")
    if args.jdbc_url and (args.closed_only or args.compact_every):
        parser.error("--closed-only and --compact-every are for Parquet output")

    spark = use_utc(build_session("wayfare live"))

    def messages(group: str) -> DataFrame:
        if args.files:
            return read_message_files(spark, args.files, args.per_trigger)
        options = kafka_options(
            args.brokers,
            args.topic,
            group,
            args.starting_offsets,
            not args.allow_data_loss,
            args.per_trigger,
        )
        return read_kafka(spark, options)

    interval = None if args.once else args.interval
    with late_rows(spark, None if args.once else print) as late:
        if args.jdbc_url:
            properties = dict(p.split("=", 1) for p in args.jdbc_property)
            # A flush of the sink takes 100 rows, or what came in an interval.
            target = JdbcTarget(args.jdbc_url, properties, batch_size=100)
            windows = start_upserts(
                zone_windows(messages(args.group), args.width, args.event_column, args.delay),
                target,
                f"{args.checkpoint}/windows",
                run_statement(spark, target),
                args.group.replace("-", "_"),
                interval,
                args.parallelism,
            )
        else:
            windows = start_windows(
                messages(args.group),
                f"{args.output}/windows",
                f"{args.checkpoint}/windows",
                args.width,
                args.event_column,
                args.delay,
                interval,
                args.parallelism,
                args.closed_only,
                args.compact_every,
            )
        queries = [
            windows,
            start_rejects(
                messages(f"{args.group}-rejects"),
                f"{args.output}/rejects",
                f"{args.checkpoint}/rejects",
                interval,
                args.event_column,
            ),
        ]
        if args.once:
            for query in queries:
                query.awaitTermination()
            print(f"late rows dropped: {sum(map(late.total, queries))}")
        else:
            spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
