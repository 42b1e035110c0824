"""Point-in-time behaviour features per transaction.

Every function takes de-duplicated batch transactions (usually the Silver table, read from
files) and returns one row per transaction. "Prior" means strictly earlier event time; a
label or amount of the current row, or of a row at the same instant, never enters a prior
aggregate. All history runs through ``riskflow.operators.carry``, so a hot account,
device or merchant is cut by count and spread over tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.contract import COUNTRIES
from riskflow.functions.geo import haversine_km
from riskflow.operators.carry import (
    first_of_pair,
    micros,
    running_totals,
    with_previous,
)
from riskflow.session import stored_table

# --- Fixed values: documented look-backs and travel limits ------------------
VELOCITY_WINDOWS = {"5m": "5 minutes", "30m": "30 minutes", "24h": "24 hours"}
HISTORY_DAYS = "30 days"
MAX_SPEED_KMH = 900.0
MIN_TRAVEL_KM = 500.0
# ----------------------------------------------------------------------------

_CENTS = "cents"
PREVIOUS_PLACE = {
    "previous_latitude": "latitude",
    "previous_longitude": "longitude",
    "previous_country": "country",
}


def _cents() -> Column:
    return (F.col("amount") * 100).cast("bigint")


def _since(window: str) -> int:
    """Probe offset for rows at or before the left, excluded edge of a rolling window."""
    return micros(window) + 1


def _money(cents: Column) -> Column:
    return (cents.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(20,2)")


def _edge(window: str) -> str:
    """Name of the probe at the left edge of a rolling window."""
    return f"before_{window.replace(' ', '_')}"


def _edges(*windows: str) -> dict[str, int]:
    return {_edge(window): _since(window) for window in windows}


def _country_measures() -> dict[str, Column]:
    return {code: F.when(F.col("country") == code, 1).otherwise(0) for code in COUNTRIES}


def _deviation_measures() -> dict[str, Column]:
    return {
        "priced": F.when(F.col("amount").isNotNull(), 1),
        _CENTS: _cents(),
        "squares": _cents().cast("decimal(19,0)") * _cents().cast("decimal(19,0)"),
    }


def _velocity_columns(windows: Mapping[str, str]) -> list[Column]:
    def within(measure: str, window: str) -> Column:
        return F.col(f"now_{measure}") - F.col(f"{_edge(window)}_{measure}")

    counts = [within("n", size).alias(f"txn_count_{label}") for label, size in windows.items()]
    return counts + [
        _money(within(_CENTS, size)).alias(f"amount_sum_{label}") for label, size in windows.items()
    ]


def _deviation_columns(history: str, epsilon: float) -> list[Column]:
    def within(measure: str) -> Column:
        return (F.col(f"prior_{measure}") - F.col(f"{_edge(history)}_{measure}")).cast("double")

    n, total, squares = within("priced"), within(_CENTS), within("squares")
    spread = F.greatest(squares - total * total / F.nullif(n, F.lit(0.0)), F.lit(0.0))
    mean = total / F.nullif(n, F.lit(0.0)) / 100
    deviation = F.when(n > 1, F.sqrt(spread / F.nullif(n - 1, F.lit(0.0))) / 100)
    amount = F.col("amount").cast("double")
    score = (amount - mean) / F.greatest(deviation, F.lit(epsilon))
    return [
        n.cast("bigint").alias("prior_txn_count_30d"),
        mean.alias("account_mean_amount_30d"),
        deviation.alias("account_std_amount_30d"),
        F.when(deviation.isNotNull(), score).alias("amount_zscore"),
        F.when(mean > 0, amount / F.nullif(mean, F.lit(0.0))).alias("amount_vs_recent_average"),
    ]


def _country_count(window: str) -> Column:
    used = [(F.col(f"now_{c}") > F.col(f"{_edge(window)}_{c}")).cast("int") for c in COUNTRIES]
    return sum(used[1:], used[0]).alias("country_count")


def rolling_velocity(
    events: DataFrame, windows: Mapping[str, str] = VELOCITY_WINDOWS
) -> DataFrame:
    """``txn_count_*`` and ``amount_sum_*`` of the account over the last 5 m, 30 m and 24 h.

    A window is ``[t - size, t]`` and counts the current transaction.
    """
    measures = {"n": F.lit(1), _CENTS: _cents()}
    probes = {"now": 0, **_edges(*windows.values())}
    totals = running_totals(events, ["account_id"], measures, probes)
    return totals.select("transaction_id", *_velocity_columns(windows))


def amount_deviation(
    events: DataFrame, history: str = HISTORY_DAYS, epsilon: float = 0.01
) -> DataFrame:
    """The amount against the account's prior 30 days: mean, deviation, z-score and ratio.

    NULL while there is no prior row (two for the deviation). Sums are whole cents and
    their squares, so differences of running totals lose nothing.
    """
    probes = {"prior": 1, **_edges(history)}
    totals = running_totals(events, ["account_id"], _deviation_measures(), probes)
    joined = events.select("transaction_id", "amount").join(totals, "transaction_id")
    return joined.select("transaction_id", *_deviation_columns(history, epsilon))


def account_history(
    events: DataFrame,
    windows: Mapping[str, str] = VELOCITY_WINDOWS,
    history: str = HISTORY_DAYS,
    epsilon: float = 0.01,
    countries: str = "24 hours",
    max_speed_kmh: float = MAX_SPEED_KMH,
    min_km: float = MIN_TRAVEL_KM,
) -> DataFrame:
    """The columns of velocity, deviation, countries and travel, from one pass over the accounts."""
    measures = {"n": F.lit(1), **_deviation_measures(), **_country_measures()}
    probes = {"now": 0, "prior": 1, **_edges(*windows.values(), history, countries)}
    previous = {"previous_time": "event_timestamp", **PREVIOUS_PLACE}
    totals = running_totals(events, ["account_id"], measures, probes, previous=previous)
    own = events.select("transaction_id", "amount", "event_timestamp", *PREVIOUS_PLACE.values())
    joined = own.join(totals, "transaction_id")
    linked = joined.select(
        *own.columns,
        *previous,
        *_velocity_columns(windows),
        *_deviation_columns(history, epsilon),
        _country_count(countries),
    )
    features = [c for c in linked.columns if c not in (*own.columns, *previous)]
    return travel_columns(linked, max_speed_kmh, min_km, features)


def travel(
    events: DataFrame,
    max_speed_kmh: float = MAX_SPEED_KMH,
    min_km: float = MIN_TRAVEL_KM,
) -> DataFrame:
    """Distance, time and speed from the account's previous transaction.

    Travel is impossible when it is longer than ``min_km`` and faster than ``max_speed_kmh``;
    a jump in no time at all counts, although its speed is NULL.
    """
    narrow = events.select("transaction_id", "account_id", "event_timestamp", *PREVIOUS_PLACE.values())
    linked = with_previous(narrow, ["account_id"], {"previous_time": "event_timestamp", **PREVIOUS_PLACE})
    return travel_columns(linked, max_speed_kmh, min_km)


def travel_columns(
    linked: DataFrame,
    max_speed_kmh: float = MAX_SPEED_KMH,
    min_km: float = MIN_TRAVEL_KM,
    kept: Sequence[str] = (),
) -> DataFrame:
    """``travel`` from rows that already have the previous time, place and country; ``kept`` columns stay."""
    km = haversine_km(
        F.col("previous_latitude"), F.col("previous_longitude"), F.col("latitude"), F.col("longitude")
    )
    seconds = (F.unix_micros("event_timestamp") - F.unix_micros("previous_time")) / 1e6
    hours = F.col("seconds_since_previous_txn") / 3600
    distance = F.col("distance_from_previous_km")
    return linked.withColumns(
        {"distance_from_previous_km": F.round(km, 3), "seconds_since_previous_txn": seconds}
    ).select(
        "transaction_id",
        "distance_from_previous_km",
        "seconds_since_previous_txn",
        F.round(distance / F.nullif(hours, F.lit(0.0)), 3).alias("implied_speed_kmh"),
        ((distance > min_km) & (distance > hours * max_speed_kmh)).alias("impossible_travel"),
        (F.col("country") != F.col("previous_country")).alias("country_changed"),
        *kept,
    )


def countries_seen(events: DataFrame, window: str = "24 hours") -> DataFrame:
    """How many of the contract's countries the account used within the window, now included."""
    probes = {"now": 0, **_edges(window)}
    totals = running_totals(events, ["account_id"], _country_measures(), probes)
    return totals.select("transaction_id", _country_count(window))


def new_pairs(events: DataFrame) -> DataFrame:
    """Whether the account uses this device, and pays this merchant, for the first time."""
    found = events.select("transaction_id")
    flags = {
        "new_device_for_account": ["account_id", "device_id"],
        "new_merchant_for_account": ["account_id", "merchant_id"],
    }
    for flag, pair in flags.items():
        found = found.join(first_of_pair(events, pair, flag), "transaction_id", "left")
    return found.select(
        "transaction_id", *[F.coalesce(F.col(flag), F.lit(False)).alias(flag) for flag in flags]
    )


def device_usage(events: DataFrame, parts: int | None = None) -> DataFrame:
    """Per device: accounts seen so far, use in the last hour and 30 days."""
    return device_activity(events, parts).drop("device_country_change")


def device_activity(events: DataFrame, parts: int | None = None) -> DataFrame:
    """The usage of the device, and whether the country changed since it was last used.

    The number of distinct accounts is the running count of first meetings, so no set of
    accounts is ever kept. Counts and the previous country come from one set of parts.
    """
    firsts = first_of_pair(events, ["device_id", "account_id"], "first_meeting")
    marked = events.select("transaction_id", "device_id", "event_timestamp", "country").join(firsts, "transaction_id", "left")
    # Cutting parts samples its input first, which would join twice.
    marked = stored_table(marked, "meetings")
    measures = {"n": F.lit(1), "accounts": F.coalesce(F.col("first_meeting").cast("int"), F.lit(0))}
    probes = {"now": 0, **_edges("1 hour", HISTORY_DAYS)}
    totals = running_totals(marked, ["device_id"], measures, probes, parts, {"previous_country": "country"})
    moved = (F.col("country") != F.col("previous_country")).alias("device_country_change")
    return totals.join(marked.select("transaction_id", "country"), "transaction_id").select(
        "transaction_id",
        F.col("now_accounts").alias("device_account_count"),
        (F.col("now_n") - F.col(f"{_edge('1 hour')}_n")).alias("device_txn_count_1h"),
        (F.col("now_n") - F.col(f"{_edge(HISTORY_DAYS)}_n")).alias("device_seen_count_30d"),
        moved,
    )


def merchant_history(events: DataFrame) -> DataFrame:
    """Per merchant: prior transactions, mean amount, last-hour velocity and fraud rate.

    Needs ``is_fraud`` (NULL while a label is unknown). The fraud rate is taken over strictly
    earlier labelled transactions and is NULL when there are none.
    """
    measures = {
        "n": F.lit(1),
        "priced": F.col("amount").isNotNull().cast("int"),
        _CENTS: _cents(),
        "labelled": F.col("is_fraud").isNotNull().cast("int"),
        "frauds": F.coalesce(F.col("is_fraud").cast("int"), F.lit(0)),
    }
    totals = running_totals(
        events, ["merchant_id"], measures, {"prior": 1, "hour": _since("1 hour")}
    )
    return totals.select(
        "transaction_id",
        F.col("prior_n").alias("merchant_txn_count"),
        (F.col("prior_n") - F.col("hour_n")).alias("merchant_txn_velocity_1h"),
        (F.col("prior_cents") / F.nullif(F.col("prior_priced"), F.lit(0)) / 100).alias(
            "merchant_avg_amount"
        ),
        (F.col("prior_frauds") / F.nullif(F.col("prior_labelled"), F.lit(0))).alias(
            "merchant_fraud_rate"
        ),
    )


def category_risk(events: DataFrame) -> DataFrame:
    """Per merchant category: fraud rate over strictly earlier labelled transactions.

    Needs ``is_fraud`` (NULL while a label is unknown). A row never sees its own label or a
    later one; the rate is NULL before the first label of its category.
    """
    measures = {
        "labelled": F.col("is_fraud").isNotNull().cast("int"),
        "frauds": F.coalesce(F.col("is_fraud").cast("int"), F.lit(0)),
    }
    totals = running_totals(events, ["merchant_category"], measures, {"prior": 1})
    return totals.select(
        "transaction_id",
        (F.col("prior_frauds") / F.nullif(F.col("prior_labelled"), F.lit(0))).alias(
            "merchant_category_risk"
        ),
    )


def temporal(
    events: DataFrame,
    unusual_share: float = 0.05,
    min_history: int = 20,
) -> DataFrame:
    """Hour, weekday (1 = Sunday), weekend, and whether the hour is unusual for the account.

    An hour is unusual when the account has at least ``min_history`` prior transactions and
    fewer than ``unusual_share`` of them fell into that hour of day.
    """
    at = F.col("event_timestamp")
    clocked = events.withColumn("hour_of_day", F.hour(at))
    overall = running_totals(clocked, ["account_id"], {"n": F.lit(1)}, {"all": 1})
    same_hour = running_totals(
        clocked, ["account_id", "hour_of_day"], {"n": F.lit(1)}, {"hour": 1}
    )
    weekday = F.dayofweek(at)
    return (
        clocked.select(
            "transaction_id",
            "hour_of_day",
            weekday.alias("day_of_week"),
            weekday.isin(1, 7).alias("weekend"),
        )
        .join(overall, "transaction_id")
        .join(same_hour, "transaction_id")
        .select(
            "transaction_id",
            "hour_of_day",
            "day_of_week",
            "weekend",
            unusual_hour(F.col("all_n"), F.col("hour_n"), unusual_share, min_history),
        )
    )


def unusual_hour(seen: Column, same_hour: Column, unusual_share: float, min_history: int) -> Column:
    rare = same_hour < seen * F.lit(unusual_share)
    return ((seen >= min_history) & rare).alias("unusual_hour_for_account")


def with_features(events: DataFrame, features: Sequence[DataFrame]) -> DataFrame:
    """Events with any of the feature tables above, joined on ``transaction_id``.

    All sides are keyed by the unique id, so the joins share one even partitioning.
    """
    for table in features:
        events = events.join(table, "transaction_id", "left")
    return events
