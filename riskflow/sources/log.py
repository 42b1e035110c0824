"""Message-log and file sources with the same record layout.

The Kafka connector is a separate package (``spark-sql-kafka-0-10`` for the running Scala
version). The file sources feed the same pipeline where there is no broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamReader

from riskflow.contract import raw_record_schema
from riskflow.settings import LogSettings


def log_options(settings: LogSettings, topic: str) -> dict[str, str]:
    """Options of a stream that starts at the oldest record and tolerates expired ones."""
    return {
        "kafka.bootstrap.servers": settings.bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }


def read_log(spark: SparkSession, settings: LogSettings, topic: str) -> DataFrame:
    """Stream of raw records ``key, value, topic, partition, offset, timestamp``."""
    stream = spark.readStream.format("kafka").options(**log_options(settings, topic))
    if topic == settings.raw_topic:
        stream = stream.option("kafka.group.id", settings.validator_group)
    return stream.load().select("key", "value", "topic", "partition", "offset", "timestamp")


def read_validated(spark: SparkSession, settings: LogSettings) -> DataFrame:
    """Stream of validated values; other record columns are not read."""
    return read_log(spark, settings, settings.validated_topic).select("value")


def read_log_batch(spark: SparkSession, settings: LogSettings, topic: str) -> DataFrame:
    """All records a topic holds now, as a batch."""
    options = {**log_options(settings, topic), "endingOffsets": "latest"}
    return (
        spark.read.format("kafka")
        .options(**options)
        .load()
        .select("key", "value", "topic", "partition", "offset", "timestamp")
    )


def _file_stream(spark: SparkSession, files_per_trigger: int | None) -> DataStreamReader:
    """Without a limit all files that are there form one micro-batch.

    A limit lets the watermark advance between files, so rows of a later file that are older
    than it are dropped; set one only for files that arrive in event-time order.
    """
    reader = spark.readStream
    return reader if files_per_trigger is None else reader.option("maxFilesPerTrigger", files_per_trigger)


def read_value_lines(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of text files with one JSON value per line."""
    return _file_stream(spark, files_per_trigger).text(path)


def read_record_files(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of Parquet files with the raw record columns."""
    return _file_stream(spark, files_per_trigger).schema(raw_record_schema()).parquet(path)


def write_log(records: DataFrame, settings: LogSettings, topic: str | None = None) -> None:
    """Publish ``(key, value)`` records, or ``(topic, key, value)`` when no topic is given."""
    writer = (
        records.write.format("kafka")
        .option("kafka.bootstrap.servers", settings.bootstrap_servers)
        .option("kafka.acks", "all")
    )
    if topic is not None:
        writer = writer.option("topic", topic)
    writer.save()
