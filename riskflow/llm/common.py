"""Shared helpers of the training-text operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.session import ship_package, stored_table

# The six ASCII white-space characters that separate words and pad lines.
WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    """What Python tasks of a session need: this package, and batches bounded in bytes.

    Spark's own bound counts rows, so a batch of long texts would be held at once by the JVM,
    outside its heap, and by the worker.
    """
    ship_package(spark)
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(4 << 20))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Written once below the shared checkpoint folder and read back: outlives a lost executor, without lineage.
kept_table = stored_table


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished work now.

    It does so when the driver's JVM has collected the plans that own them, by default within
    half an hour; long jobs whose steps are written tables would hold all of them until then.
    """
    spark.sparkContext._jvm.System.gc()


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """The input row as one struct ``row`` next to the given columns.

    Whatever else the table carries stays inside the struct, so no extra column can clash
    with a name that an operator uses.
    """
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(n) for n, c in columns.items()])


def slices(batches: Iterator[pa.RecordBatch], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about ``size`` bytes, so that a task's memory doesn't follow Spark's batches; whole rows always.

    What Arrow holds without need is given back after each batch, since a worker is used again.
    """
    for batch in batches:
        rows = max(1, int(batch.num_rows * size / max(batch.nbytes, 1)))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
        del batch
        pa.default_memory_pool().release_unused()


class Lately:
    """A dictionary of texts and bytes that forgets what was not used lately; bounded in bytes.

    New and used entries are ``young``; when these are full they become ``old``, and what was old goes.
    """

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def get(self, key: str) -> bytes | None:
        known = self.young.get(key)
        if known is None:
            known = self.old.get(key)
            if known is not None:
                self.put(key, known)
        return known

    def put(self, key: str, value: bytes) -> None:
        if self.held > self.limit:
            self.young, self.old, self.held = {}, self.young, 0
        self.young[key] = value
        self.held += len(key) + len(value) + 200  # about what the objects take besides


def lower_ascii(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Words of Arrow texts (null: none): the text of each, its code, and the distinct words by code.

    Arrow's split at ASCII white space uses the same six characters as ``WORD``.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
    coded = lists.flatten().dictionary_encode()
    code, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
    blank = distinct.index("") if "" in distinct else -1
    filled = code != blank
    return owner[filled], code[filled], distinct
