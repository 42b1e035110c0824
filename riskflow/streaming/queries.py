"""Structured Streaming queries for the lake, the router and the debug console.

Each query has its own checkpoint. The number of shuffle partitions is frozen by a
checkpoint, so choose it before the first start.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from riskflow.contract import GOLD_PARTITIONS, SILVER_PARTITIONS
from riskflow.operators.parse import prepare_events, with_event_time
from riskflow.operators.validate import route
from riskflow.operators.windows import account_window_features
from riskflow.plans.lake import gold_account_features, silver_schema, silver_transactions
from riskflow.session import make_folder
from riskflow.settings import LogSettings, StreamSettings


@contextmanager
def _event_time_session(spark: SparkSession, state_partitions: int | None) -> Iterator[None]:
    """Session settings a query copies when it starts.

    Exchange reuse is off: when two branches of one stream share an exchange, the second
    branch loses its watermark and never emits or evicts. RocksDB keeps large state off
    the heap.
    """
    wanted = {
        "spark.sql.exchange.reuse": "false",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.sql.session.timeZone": "UTC",
    }
    if state_partitions is not None:
        wanted["spark.sql.shuffle.partitions"] = str(state_partitions)
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _start(
    writer: DataStreamWriter,
    spark: SparkSession,
    name: str,
    checkpoint: str,
    trigger_seconds: int | None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start now; without a trigger interval, read what is there and stop."""
    writer = writer.queryName(name).option("checkpointLocation", checkpoint)
    if trigger_seconds is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{trigger_seconds} seconds")
    with _event_time_session(spark, state_partitions):
        return writer.start()


def start_silver(
    events: DataFrame,
    path: str,
    checkpoint: str,
    trigger_seconds: int | None = 5,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append de-duplicated transactions, partitioned by event date and hour.

    ``state_partitions`` replaces the session's number of shuffle partitions for this query.
    """
    writer = (
        silver_transactions(events)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .partitionBy(*SILVER_PARTITIONS)
    )
    return _start(
        writer, events.sparkSession, "silver-transactions", checkpoint, trigger_seconds, state_partitions
    )


def start_gold(
    features: DataFrame,
    path: str,
    checkpoint: str,
    trigger_seconds: int | None = 5,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append a window once the watermark has passed its end, never before."""
    writer = (
        gold_account_features(features)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .partitionBy(*GOLD_PARTITIONS)
    )
    return _start(
        writer,
        features.sparkSession,
        "gold-account-features",
        checkpoint,
        trigger_seconds,
        state_partitions,
    )


def start_table(
    rows: DataFrame,
    name: str,
    path: str,
    checkpoint: str,
    trigger_seconds: int | None = 5,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append any stream to a Parquet table."""
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", path)
    return _start(writer, rows.sparkSession, name, checkpoint, trigger_seconds, state_partitions)


def start_batches(
    rows: DataFrame,
    handle: Callable[[DataFrame, int], None],
    name: str,
    checkpoint: str,
    trigger_seconds: int | None = 5,
) -> StreamingQuery:
    """Hand every micro-batch and its number to ``handle``, which must bear being given a batch again."""
    return _start(rows.writeStream.foreachBatch(handle), rows.sparkSession, name, checkpoint, trigger_seconds)


def start_console(
    features: DataFrame, checkpoint: str, trigger_seconds: int | None = 5
) -> StreamingQuery:
    """Show windows while they are still open (features built with ``update_mode=True``)."""
    writer = (
        features.writeStream.outputMode("update")
        .format("console")
        .option("truncate", "false")
        .option("numRows", "40")
    )
    return _start(writer, features.sparkSession, "console-features", checkpoint, trigger_seconds)


def start_router_files(
    records: DataFrame,
    path: str,
    checkpoint: str,
    topics: LogSettings = LogSettings(),
    trigger_seconds: int | None = 5,
) -> StreamingQuery:
    """Validate and route to a file table partitioned by topic, exactly once."""
    writer = (
        route(records, topics)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .partitionBy("topic")
    )
    return _start(writer, records.sparkSession, "validate-and-route", checkpoint, trigger_seconds)


def start_router_log(
    records: DataFrame,
    checkpoint: str,
    topics: LogSettings = LogSettings(),
    trigger_seconds: int | None = 5,
) -> StreamingQuery:
    """Validate and route to the two topics; each row names its topic. At least once."""
    writer = (
        route(records, topics)
        .writeStream.outputMode("append")
        .format("kafka")
        .option("kafka.bootstrap.servers", topics.bootstrap_servers)
        .option("kafka.acks", "all")
    )
    return _start(writer, records.sparkSession, "validate-and-route", checkpoint, trigger_seconds)


def silver_stream(spark: SparkSession, path: str, watermark: str) -> DataFrame:
    """The Silver table as a stream of already de-duplicated transactions; it may still be empty."""
    make_folder(spark, path)
    stream = spark.readStream.schema(silver_schema()).parquet(path)
    return with_event_time(stream, watermark)


def start_lake(
    values: DataFrame, settings: StreamSettings, horizon: str = "watermark"
) -> list[StreamingQuery]:
    """Silver, Gold and, if asked for, the console query over one stream of values.

    Values are parsed and de-duplicated once, by the Silver query; the others read the Silver table as a
    stream. So the ids are remembered in one state, not in one per query and window size.
    """
    lake, seconds, spark = settings.lake, settings.trigger_seconds, values.sparkSession
    events = prepare_events(values, settings.watermark, horizon)
    started = [start_silver(events, lake.silver_path, lake.silver_checkpoint, seconds)]
    silver = silver_stream(spark, lake.silver_path, settings.watermark)
    features = account_window_features(silver, settings.features)
    started.append(start_gold(features, lake.gold_path, lake.gold_checkpoint, seconds))
    if lake.console_sink:
        open_windows = account_window_features(silver, settings.features, update_mode=True)
        started.append(start_console(open_windows, lake.console_checkpoint, seconds))
    return started


def run_until(
    spark: SparkSession, queries: list[StreamingQuery], timeout_seconds: int | None = None
) -> None:
    """Wait for any query to end or the timeout, then stop them all."""
    try:
        spark.streams.awaitAnyTermination(timeout_seconds)
    finally:
        for query in queries:
            query.stop()
