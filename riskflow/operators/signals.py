"""Threshold flags on single transactions and on finished windows.

Flags describe behaviour; they are not decisions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.contract import MONEY
from riskflow.settings import FeatureSettings


def with_transaction_signals(
    events: DataFrame, settings: FeatureSettings = FeatureSettings()
) -> DataFrame:
    """Add ``is_high_amount``: the amount reaches the threshold (inclusive)."""
    cutoff = F.lit(settings.high_amount_threshold).cast(MONEY)
    return events.withColumn("is_high_amount", F.col("amount") >= cutoff)


def with_window_signals(
    windows: DataFrame, settings: FeatureSettings = FeatureSettings()
) -> DataFrame:
    """Add the three window flags; the same count cut-off serves both sizes.

    A location change needs two grid cells as well as the spread, so jitter inside
    one cell never raises it. The spread compared is the published, rounded one.
    """
    moved = F.col("unique_locations") >= 2
    far = F.col("location_spread_km") >= settings.location_spread_km_threshold
    return windows.withColumns(
        {
            "multi_device_signal": F.col("unique_devices") >= settings.multi_device_threshold,
            "rapid_transaction_signal": F.col("txn_count") >= settings.rapid_txn_count_threshold,
            "rapid_location_change_signal": moved & far,
        }
    )
