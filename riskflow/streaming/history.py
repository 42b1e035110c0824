"""Every progress record of streaming queries as a table, and rates observed inside running queries."""

from __future__ import annotations

import json
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

HISTORY_SCHEMA = """query_name string, query_id string, run_id string, batch_id long, at timestamp, input_rows long, batch_ms long,
watermark string, state_rows long, late_rows_dropped long, observed map<string,map<string,double>>"""


def observed_routing(routed: DataFrame, dead_letter_topic: str = "transactions.dlq") -> DataFrame:
    """The routed rows, counted on their way: all of them, and the dead letters."""
    dead = F.count_if(F.col("topic") == dead_letter_topic)
    return routed.observe("routing", F.count(F.lit(1)).alias("rows"), dead.alias("dead_letters"))


def observed_rows(rows: DataFrame, name: str) -> DataFrame:
    """The rows, counted on their way: before and after de-duplication the difference is what was dropped."""
    return rows.observe(name, F.count(F.lit(1)).alias("rows"))


class ProgressHistory(StreamingQueryListener):
    """Appends each micro-batch of every query of the session to a table at ``path``.

    Add it with ``spark.streams.addListener`` before queries start. The table is only added to, so it
    outlives restarts, and holds each batch, unlike the few newest that a query remembers.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self.ended = threading.Condition()
        self.runs: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = json.loads(event.progress.json)
        state = report.get("stateOperators", [])
        observed = {n: {k: float(v) for k, v in m.items() if v is not None} for n, m in report.get("observedMetrics", {}).items()}
        row = (
            report.get("name"), report["id"], report["runId"], report["batchId"], report["timestamp"], report.get("numInputRows", 0),
            report.get("batchDuration"), report.get("eventTime", {}).get("watermark"), sum(p["numRowsTotal"] for p in state),
            sum(p["numRowsDroppedByWatermark"] for p in state), observed,
        )
        frame = self.spark.createDataFrame([row], HISTORY_SCHEMA.replace("at timestamp", "at string"))
        frame.withColumn("at", F.col("at").cast("timestamp")).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.ended:
            self.runs.add(str(event.runId))
            self.ended.notify_all()

    def wait_for(self, run_id: str, seconds: float = 60) -> bool:
        """Whether all records of a finished run are in the table by then."""
        with self.ended:
            return self.ended.wait_for(lambda: str(run_id) in self.runs, seconds)


def history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HISTORY_SCHEMA).parquet(path)


def _seen(name: str, metric: str) -> Column:
    return F.sum(F.col("observed")[name][metric])


def dead_letter_rate(records: DataFrame) -> DataFrame:
    """Per query: routed rows, dead letters and their share, from the history table."""
    rows, dead = _seen("routing", "rows"), _seen("routing", "dead_letters")
    found = records.where("observed['routing'] is not null").groupBy("query_name")
    return found.agg(rows.cast("long").alias("rows"), dead.cast("long").alias("dead_letters"), (dead / rows).alias("dead_letter_rate"))


def duplicate_rate(records: DataFrame, before: str = "arrived", after: str = "kept") -> DataFrame:
    """Per query: rows before de-duplication, rows dropped there and their share."""
    arrived, kept = _seen(before, "rows"), _seen(after, "rows")
    found = records.where(F.col("observed")[before].isNotNull()).groupBy("query_name")
    return found.agg(arrived.cast("long").alias("rows"), (arrived - kept).cast("long").alias("duplicates"), (1 - kept / arrived).alias("duplicate_rate"))
