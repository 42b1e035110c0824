"""Operational figures of running queries as a table."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

PROGRESS_SCHEMA = """query_name string, batch_id long, input_rows long, input_rows_per_second double,
processed_rows_per_second double, batch_ms long, watermark string, state_rows long, state_bytes long,
late_rows_dropped long"""


def progress_table(spark: SparkSession, queries: Sequence[StreamingQuery]) -> DataFrame:
    """One row per recent micro-batch: rates, duration, watermark, state size and late rows.

    Spark keeps a fixed number of progress records per query, so this stays small.
    """
    rows = []
    for query in queries:
        for progress in query.recentProgress:
            report = json.loads(progress.json)
            state = report.get("stateOperators", [])
            rows.append(
                (
                    report.get("name"),
                    report["batchId"],
                    report.get("numInputRows", 0),
                    _rate(report.get("inputRowsPerSecond")),
                    _rate(report.get("processedRowsPerSecond")),
                    report.get("batchDuration"),
                    report.get("eventTime", {}).get("watermark"),
                    sum(part["numRowsTotal"] for part in state),
                    sum(part["memoryUsedBytes"] for part in state),
                    sum(part["numRowsDroppedByWatermark"] for part in state),
                )
            )
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)


def _rate(value: float | None) -> float | None:
    return None if value is None else float(value)
