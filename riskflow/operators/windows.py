"""Per-account tumbling-window features, exact and safe for hot accounts.

Distinct merchants, devices and places are never gathered into one set per
window. Batch input uses ``count_distinct``, which Spark plans as a shuffle on
(account, window, value) before counting. A stream does the same by hand: each
event becomes one measure row and three value rows, these are grouped per value,
and a second aggregation over the same window counts them. Either way an
account-window holding a large share of the data is spread over all tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.contract import GOLD_FEATURES, MONEY
from riskflow.functions.geo import grid_cell, haversine_km
from riskflow.operators.signals import with_transaction_signals, with_window_signals
from riskflow.settings import FeatureSettings

# Published window sizes, label -> duration.
WINDOW_SIZES = {"5m": "5 minutes", "30m": "30 minutes"}
DAY_WINDOW = {"24h": "24 hours"}

_DISTINCTS = {
    "unique_merchants": "merchant_id",
    "unique_devices": "device_id",
    "unique_locations": "place",
}
_BOX = {
    "south": (F.min, "latitude"),
    "north": (F.max, "latitude"),
    "west": (F.min, "longitude"),
    "east": (F.max, "longitude"),
}


def _additive(amount_cents: Column, high: Column, counted: Column) -> list[Column]:
    """Measures that add up; money is summed as whole cents, which stays in codegen."""
    return [
        F.count(counted).alias("txn_count"),
        F.count(amount_cents).alias("priced"),
        # NULL on 64-bit overflow, far beyond what DECIMAL(12,2) can publish anyway.
        F.try_sum(amount_cents).alias("cents"),
        F.max(amount_cents).alias("max_cents"),
        F.sum(high.cast("int")).alias("high_amount_count"),
    ]


def _box(when: Column | None = None) -> list[Column]:
    corners = []
    for name, (extreme, axis) in _BOX.items():
        value = F.col(axis) if when is None else F.when(when, F.col(axis))
        corners.append(extreme(value).alias(name))
    return corners


def _batch_aggregate(rows: DataFrame, keys: list[Column]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        *_additive(F.col("cents"), F.col("is_high_amount"), F.lit(1)),
        *_box(),
        *[F.count_distinct(value).alias(name) for name, value in _DISTINCTS.items()],
    )


def _set_aggregate(rows: DataFrame, keys: list[Column]) -> DataFrame:
    """One-step form with a set per window; only for update-mode debug output."""
    return rows.groupBy(*keys).agg(
        *_additive(F.col("cents"), F.col("is_high_amount"), F.lit(1)),
        *_box(),
        *[F.size(F.collect_set(value)).alias(name) for name, value in _DISTINCTS.items()],
    )


def _stream_aggregate(rows: DataFrame, keys: list[Column]) -> DataFrame:
    """Two chained aggregations over one window; state rows stay small and spread out."""
    tags = [F.struct(F.lit("measures").alias("what"), F.lit(None).cast("string").alias("which"))]
    for name, value in _DISTINCTS.items():
        tags.append(F.struct(F.lit(name).alias("what"), F.col(value).alias("which")))
    exploded = rows.select("*", F.inline(F.array(*tags)))
    measures = F.col("what") == "measures"
    per_value = exploded.groupBy(*keys, "what", "which").agg(
        *_additive(
            F.when(measures, F.col("cents")),
            F.when(measures, F.col("is_high_amount")),
            F.when(measures, F.lit(1)),
        ),
        *_box(measures),
    )
    return per_value.groupBy("account_id", "window").agg(
        F.sum("txn_count").alias("txn_count"),
        F.sum("priced").alias("priced"),
        F.try_sum("cents").alias("cents"),
        F.max("max_cents").alias("max_cents"),
        F.sum("high_amount_count").alias("high_amount_count"),
        *[extreme(name).alias(name) for name, (extreme, _) in _BOX.items()],
        *[
            F.count(F.when(F.col("what") == name, F.col("which"))).alias(name)
            for name in _DISTINCTS
        ],
    )


def _money(cents: Column) -> Column:
    return (cents.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).try_cast(MONEY)


def _mean_money(cents: Column, n: Column) -> Column:
    """Mean as ``avg`` gives it for money: half-up to six digits, then to two."""
    exact = cents.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")
    mean = exact / F.nullif(n, F.lit(0)).cast("decimal(10,0)")
    return F.round(mean, 6).try_cast(MONEY)


def _published(aggregated: DataFrame, label: Column, start: Column, end: Column) -> DataFrame:
    spread = haversine_km(*[F.col(name) for name in ("south", "west", "north", "east")])
    typed = {
        "window_start": start,
        "window_end": end,
        "window_size": label,
        "location_spread_km": F.round(spread, 3),
        "amount_sum": _money(F.col("cents")),
        "amount_avg": _mean_money(F.col("cents"), F.col("priced")),
        "amount_max": _money(F.col("max_cents")),
        **{name: F.col(name).cast("int") for name in _DISTINCTS},
    }
    # The three flags are added afterwards by with_window_signals.
    return aggregated.select(
        *[typed.get(name, F.col(name)).alias(name) for name in GOLD_FEATURES[:-3]]
    )


def _flagged(events: DataFrame, settings: FeatureSettings) -> DataFrame:
    place = grid_cell(F.col("latitude"), F.col("longitude"), settings.location_grid_decimals)
    cents = (F.col("amount") * 100).cast("bigint")
    return with_transaction_signals(events, settings).withColumns({"place": place, "cents": cents})


def window_features(
    events: DataFrame,
    label: str,
    duration: str,
    settings: FeatureSettings = FeatureSettings(),
    update_mode: bool = False,
) -> DataFrame:
    """Features of one tumbling size; one row per (account_id, window).

    ``update_mode=True`` is the form a stream needs for the update output mode,
    which cannot chain aggregations; it keeps one set per open window in state.
    """
    if update_mode:
        aggregate = _set_aggregate
    else:
        aggregate = _stream_aggregate if events.isStreaming else _batch_aggregate
    keys = [F.col("account_id"), F.window("event_timestamp", duration)]
    aggregated = aggregate(_flagged(events, settings), keys)
    published = _published(
        aggregated, F.lit(label), F.col("window.start"), F.col("window.end")
    )
    return with_window_signals(published, settings)


def _seconds(duration: str) -> int:
    amount, unit = duration.split()
    return int(amount) * {"minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def _all_sizes_in_one_pass(
    events: DataFrame, sizes: dict[str, str], settings: FeatureSettings
) -> DataFrame:
    """Batch form: every event is tagged with its window of each size, then one aggregation."""
    second = F.unix_seconds("event_timestamp")
    windows = []
    for label, duration in sizes.items():
        length = _seconds(duration)
        start = second - F.pmod(second, F.lit(length))
        windows.append(
            F.struct(
                F.lit(label).alias("size"),
                F.timestamp_seconds(start).alias("start"),
                F.timestamp_seconds(start + F.lit(length)).alias("end"),
            )
        )
    # As with window(), a row without event time belongs to no window.
    timed = _flagged(events, settings).where(F.col("event_timestamp").isNotNull())
    tagged = timed.select("*", F.inline(F.array(*windows)))
    keys = [F.col(name) for name in ("account_id", "size", "start", "end")]
    aggregated = _batch_aggregate(tagged, keys)
    published = _published(aggregated, F.col("size"), F.col("start"), F.col("end"))
    return with_window_signals(published, settings)


def account_window_features(
    events: DataFrame,
    settings: FeatureSettings = FeatureSettings(),
    sizes: dict[str, str] | None = None,
    update_mode: bool = False,
) -> DataFrame:
    """All window sizes of every account, by default 5 and 30 minutes.

    Batch input is read once for all sizes. A stream is a union of one branch per
    size, since event-time state needs Spark's own window column.
    """
    sizes = sizes or WINDOW_SIZES
    if not events.isStreaming:
        return _all_sizes_in_one_pass(events, sizes, settings)
    branches = [
        window_features(events, label, duration, settings, update_mode)
        for label, duration in sizes.items()
    ]
    return reduce(DataFrame.unionByName, branches)
