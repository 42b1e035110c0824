"""Features that look back per key, on a stream: keyed state with timers.

``account_state`` remembers of each account its newest transaction and how many fell into each hour of day;
``pair_state`` remembers the first transaction of each (account, device) and (account, merchant), each
pair a key of its own, so accounts don't gather their pairs in one place. Both emit each row
once with what was known before it. In a micro-batch a key's rows are taken in order of time and id,
so when files come in order the results are those of the batch functions row by row.

State of a key that has been idle for ``idle`` goes when the watermark passes that time (an event-time
timer); ``None`` keeps it for ever. Rows that arrive behind the newest of their key see the state as it
is, but never become the newest; ``out_of_order`` marks them. Rows without a time see nothing and change nothing.

Rows of an account go through pandas frames: Spark gathers the output rows of a key in one list when they are
``Row`` objects, and sends frames as they come. Frames have no null beside NaN, so bits tell what is known.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.shuffle import ExternalSorter
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from riskflow.operators.behaviour import travel_columns, unusual_hour
from riskflow.operators.carry import micros
from riskflow.streaming.queries import start_table
from riskflow.streaming.runs import in_order

if TYPE_CHECKING:
    import pandas as pd

HOURS = 24
HOUR_MICROS = 3_600_000_000
#: MB a Python worker may hold before a key's rows of a micro-batch are sorted on disk.
SORT_MEMORY = 384
#: Rows of a frame that goes back to Spark.
FRAME_ROWS = 10_000
_CARRIED = "event_micros long, latitude double, longitude double, country string"
_NEWEST = f"transaction_id string, {_CARRIED}, per_hour array<long>"
#: Bits of ``known``: this column has a value. A row without a time is placed behind all others.
TIME, LATITUDE, LONGITUDE = 1, 2, 4
_NO_TIME = (1 << 63) - 1
_SENT = pa.schema(
    [
        ("transaction_id", pa.string()), ("event_micros", pa.int64()), ("latitude", pa.float64()),
        ("longitude", pa.float64()), ("country", pa.string()), ("known", pa.int32()),
    ]
)
_CARRY = ("event_micros", "latitude", "longitude", "country", "known")
_ORDER = ("event_micros", "id", "number")
_ACCOUNT_ROWS = (
    "transaction_id string, account_id string, event_micros long, latitude double, longitude double, country string, known int,"
    " previous_event_micros long, previous_latitude double, previous_longitude double, previous_country string, previous_known int,"
    " prior_count long, prior_same_hour long, out_of_order boolean"
)
PAIR_OUTPUT = "transaction_id string, pair string, account_id string, value string, is_first boolean"
PAIRS = {"new_device_for_account": "device_id", "new_merchant_for_account": "merchant_id"}


def _row_type(schema: str) -> Row:
    """A row with the schema's names."""
    return Row(*[column.split()[0] for column in schema.split(", ")])


_PAIR_ROW = _row_type(PAIR_OUTPUT)


def _place(row: Row) -> tuple[bool, int, str]:
    return row.event_micros is not None, row.event_micros or 0, row.transaction_id or ""


def _in_order(rows: Iterator[Row], memory: int = SORT_MEMORY) -> Iterator[Row]:
    """A key's rows of one micro-batch by time and id, those without a time first.

    Spark's own sorter spills when the worker holds more than ``memory`` MB, whatever a key's number of rows.
    """
    return iter(ExternalSorter(memory).sorted(rows, key=_place))


def _numbered(frames: Iterator[pd.DataFrame]) -> Iterator[pa.RecordBatch]:
    """Frames with the columns of ``_SENT`` as batches; ``id`` and a running ``number`` make their order total."""
    start = 0
    for frame in frames:
        columns = [
            pa.array(frame[field.name], field.type, from_pandas=pa.types.is_string(field.type)) for field in _SENT
        ]
        columns += [pc.fill_null(columns[0], ""), pa.array(np.arange(start, start + len(frame)))]
        start += len(frame)
        yield pa.record_batch(columns, [*_SENT.names, "id", "number"])


def _unseen(rows: pa.Table) -> dict[str, pa.Array]:
    """Rows that see nothing of their account."""
    many, nothing = rows.num_rows, _carried(None)
    found = {name: rows[name] for name in _SENT.names}
    found |= {f"previous_{name}": pa.repeat(pa.scalar(nothing[name], _SENT.field(name).type), many) for name in _CARRY}
    zeros = np.zeros(many, "int64")
    return found | {"prior_count": zeros, "prior_same_hour": zeros, "out_of_order": np.zeros(many, bool)}


def _carried(last: tuple | None) -> dict[str, object]:
    """What the newest row of an account leaves to the next, as it is sent."""
    if last is None:
        return {"event_micros": 0, "latitude": 0.0, "longitude": 0.0, "country": None, "known": 0}
    _, at, latitude, longitude, country = last
    bits = TIME | (LATITUDE if latitude is not None else 0) | (LONGITUDE if longitude is not None else 0)
    latitude, longitude = (0.0 if one is None else one for one in (latitude, longitude))
    return {"event_micros": at, "latitude": latitude, "longitude": longitude, "country": country, "known": bits}


def _seen(rows: pa.Table, last: tuple | None, hours: np.ndarray) -> tuple[dict[str, pa.Array], tuple]:
    """Sorted rows with a time, with what they see; the newest row after them. ``hours`` counts them in."""
    many = rows.num_rows
    behind = 0  # rows before the newest
    if last is not None:
        at, ids, place = rows["event_micros"], rows["id"], (last[1], last[0] or "")
        behind = bisect_left(range(many), place, key=lambda row: (at[row].as_py(), ids[row].as_py()))
    found = {name: rows[name] for name in _SENT.names}
    nothing, before = _carried(None), _carried(last)
    for name in _CARRY:
        kind = _SENT.field(name).type
        pieces = [pa.repeat(pa.scalar(nothing[name], kind), behind)]
        if behind < many:
            pieces += [pa.array([before[name]], kind), *rows[name].slice(behind, many - behind - 1).chunks]
        found[f"previous_{name}"] = pa.chunked_array(pieces, kind)
    hour = rows["event_micros"].to_numpy() // HOUR_MICROS % HOURS
    found["prior_count"] = hours.sum() + np.arange(many)
    found["prior_same_hour"] = same = np.empty(many, "int64")
    for one in np.unique(hour):
        here = np.flatnonzero(hour == one)
        same[here] = hours[one] + np.arange(len(here))
        hours[one] += len(here)
    found["out_of_order"] = np.arange(many) < behind
    if behind < many:
        row = {name: rows[name][many - 1].as_py() for name in _SENT.names}
        last = (
            row["transaction_id"], row["event_micros"], row["latitude"] if row["known"] & LATITUDE else None,
            row["longitude"] if row["known"] & LONGITUDE else None, row["country"],
        )
    return found, last


def _frames(account: str | None, found: dict[str, pa.Array]) -> Iterator[pd.DataFrame]:
    many = len(found["known"])
    rows = pa.table(found | {"account_id": pa.repeat(pa.scalar(account, pa.string()), many)})
    for start in range(0, many, FRAME_ROWS):
        yield rows.slice(start, FRAME_ROWS).to_pandas()


class _Idle(StatefulProcessor):
    """State that is dropped when its key has been idle."""

    def __init__(self, idle_micros: int | None) -> None:
        self.idle_micros = idle_micros

    def _wait(self, newest: int, before: int | None) -> None:
        """Move the key's timer behind its newest row."""
        if self.idle_micros is None:
            return
        if before is not None:
            self.handle.deleteTimer(self._due(before))
        self.handle.registerTimer(self._due(newest))

    def _due(self, newest: int) -> int:
        return (newest + self.idle_micros) // 1000 + 1

    def close(self) -> None:
        pass


class AccountState(_Idle):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", _NEWEST)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self.newest.get() if self.newest.exists() else None
        last, hours = (tuple(known[:5]), np.array(known[5])) if known else (None, np.zeros(HOURS, "int64"))
        before, any_timed = last[1] if last else None, False
        for part in in_order(_numbered(rows), _ORDER):
            timed = pc.equal(pc.bit_wise_and(part["known"], TIME), TIME)
            untimed, part = part.filter(pc.invert(timed)), part.filter(timed).combine_chunks()
            if untimed.num_rows:
                yield from _frames(key[0], _unseen(untimed))
            if part.num_rows:
                any_timed = True
                seen, last = _seen(part, last, hours)
                yield from _frames(key[0], seen)
        if any_timed:
            self.newest.update((*last, hours.tolist()))
            if last[1] != before:
                self._wait(last[1], before)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.newest.exists() and self._due(self.newest.get()[1]) <= expiredTimerInfo.getExpiryTimeInMs():
            self.newest.clear()
        return iter([])


class PairState(_Idle):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "event_micros long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.newest.get()[0] if self.newest.exists() else None
        newest = None
        for row in _in_order(rows):
            first = known is None and newest is None and row.event_micros is not None
            yield _PAIR_ROW(row.transaction_id, row.pair, row.account_id, row.value, first)
            newest = row.event_micros
        if newest is not None and (known is None or newest > known):
            self.newest.update((newest,))
            self._wait(newest, known)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.newest.exists() and self._due(self.newest.get()[0]) <= expiredTimerInfo.getExpiryTimeInMs():
            self.newest.clear()
        return iter([])


def _idle(idle: str | None) -> int | None:
    return None if idle is None else micros(idle)


def account_state(events: DataFrame, idle: str | None = "30 days") -> DataFrame:
    """Each transaction of a stream with its account's previous one and counts of earlier ones.

    ``events`` needs a watermark on ``event_timestamp`` if ``idle`` is given.
    """
    time, marks = F.col("event_timestamp"), events.schema["event_timestamp"].metadata

    def bit(name: str, value: int) -> Column:
        return F.when(F.col(name).isNotNull(), value).otherwise(0)

    known = bit("event_timestamp", TIME) + bit("latitude", LATITUDE) + bit("longitude", LONGITUDE)
    rows = events.select(
        "account_id",
        "transaction_id",
        # The number bears the mark of the watermark, by which Spark drops late rows; frames can't hold all times.
        F.coalesce(F.unix_micros(time), F.lit(_NO_TIME)).alias("event_micros", metadata=marks),
        *[F.coalesce(name, F.lit(0.0)).alias(name) for name in ("latitude", "longitude")],
        "country",
        known.alias("known"),
    )
    mode = "None" if idle is None else "EventTime"
    found = rows.groupBy("account_id").transformWithStateInPandas(AccountState(_idle(idle)), _ACCOUNT_ROWS, "append", mode)

    def value(name: str, bits: int, before: str = "") -> Column:
        """A column whose bit is set; a frame makes NaN null."""
        given = F.col(f"{before}{name}")
        given = F.timestamp_micros(given) if bits == TIME else F.coalesce(given, F.lit(float("nan")))
        return F.when(F.col(f"{before}known").bitwiseAND(bits) != 0, given)

    return found.select(
        "transaction_id",
        "account_id",
        value("event_micros", TIME).alias("event_timestamp"),
        value("latitude", LATITUDE).alias("latitude"),
        value("longitude", LONGITUDE).alias("longitude"),
        "country",
        value("event_micros", TIME, "previous_").alias("previous_time"),
        value("latitude", LATITUDE, "previous_").alias("previous_latitude"),
        value("longitude", LONGITUDE, "previous_").alias("previous_longitude"),
        "previous_country",
        "prior_count",
        "prior_same_hour",
        "out_of_order",
    )


def travel_stream(events: DataFrame, idle: str | None = "30 days", **limits: float) -> DataFrame:
    """The columns of ``behaviour.travel`` for a stream."""
    return travel_columns(account_state(events, idle), **limits)


def temporal_stream(
    events: DataFrame, idle: str | None = "30 days", unusual_share: float = 0.05, min_history: int = 20
) -> DataFrame:
    """The columns of ``behaviour.temporal`` for a stream; earlier rows of one instant count as earlier."""
    at = F.col("event_timestamp")
    weekday = F.dayofweek(at)
    return account_state(events, idle).select(
        "transaction_id",
        F.hour(at).alias("hour_of_day"),
        weekday.alias("day_of_week"),
        weekday.isin(1, 7).alias("weekend"),
        unusual_hour(F.col("prior_count"), F.col("prior_same_hour"), unusual_share, min_history),
    )


def pair_state(events: DataFrame, idle: str | None = "30 days") -> DataFrame:
    """Whether a transaction is the first of its account with this device, and with this merchant: a row for each."""

    def pair(name: str, value: str) -> Column:
        return F.struct(F.lit(name).alias("pair"), F.col(value).alias("value"))

    at = F.unix_micros("event_timestamp").alias("event_micros")
    pairs = F.inline(F.array(*[pair(name, value) for name, value in PAIRS.items()]))
    rows = events.select("transaction_id", "account_id", "event_timestamp", at, pairs)
    mode = "None" if idle is None else "EventTime"
    return rows.groupBy("pair", "account_id", "value").transformWithState(PairState(_idle(idle)), PAIR_OUTPUT, "append", mode)


def pairs_by_transaction(stored: DataFrame) -> DataFrame:
    """Both flags in one row per transaction, from the stored output of ``pair_state``."""
    flags = [F.coalesce(F.max(F.when(F.col("pair") == name, F.col("is_first"))), F.lit(False)).alias(name) for name in PAIRS]
    return stored.groupBy("transaction_id").agg(*flags)


def start_keyed(
    rows: DataFrame, name: str, path: str, checkpoint: str, trigger_seconds: int | None = 5, state_partitions: int | None = None
) -> StreamingQuery:
    """Append one of the streams above to a Parquet table."""
    return start_table(rows, name, path, checkpoint, trigger_seconds, state_partitions)
