"""One key's rows in order, in memory that does not grow with their number.

Rows come as Arrow batches. Once they take ``RUN_BYTES`` they are sorted and written as a run, a file without a
name in Spark's local folder; runs are then merged, ``BLOCK_ROWS`` rows of each at a time and ``FAN_IN`` at once.
"""

from __future__ import annotations

import os
import tempfile
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from typing import BinaryIO

import pyarrow as pa

RUN_BYTES = 16 << 20
BLOCK_ROWS = 2_048
FAN_IN = 48


def _sorted(rows: pa.Table, order: Sequence[str]) -> pa.Table:
    return rows.sort_by([(name, "ascending") for name in order]).combine_chunks()


def _file() -> BinaryIO:
    folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
    return tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None)


def _written(tables: Iterator[pa.Table], schema: pa.Schema) -> BinaryIO:
    file = _file()
    with pa.ipc.new_stream(file, schema) as run:
        for rows in tables:
            run.write_table(rows, BLOCK_ROWS)
    file.seek(0)
    return file


class _Head:
    """The rows of a run that are in memory."""

    def __init__(self, file: BinaryIO, order: Sequence[str]) -> None:
        self.file, self.order = file, order
        self.run = pa.ipc.open_stream(file)
        self.rows = self.run.schema.empty_table()
        self.ended = False

    def fill(self) -> None:
        blocks = [self.rows]
        while not self.ended and sum(block.num_rows for block in blocks) < BLOCK_ROWS:
            try:
                blocks.append(pa.Table.from_batches([self.run.read_next_batch()]))
            except StopIteration:
                self.ended = True
                self.file.close()
        if len(blocks) > 1:
            self.rows = pa.concat_tables(blocks).combine_chunks()

    def place(self, row: int) -> tuple:
        return tuple(self.rows.column(name)[row].as_py() for name in self.order)

    def take(self, bound: tuple | None) -> pa.Table:
        """The rows up to ``bound``, all without one; the others stay."""
        many = self.rows.num_rows
        if bound is not None:
            many = bisect_right(range(many), bound, key=self.place) if many and self.place(0) <= bound else 0
        taken, self.rows = self.rows.slice(0, many), self.rows.slice(many)
        return taken


def _merged(files: Sequence[BinaryIO], order: Sequence[str]) -> Iterator[pa.Table]:
    """No row still on disk lies before the least of the last rows in memory, so those up to it may go."""
    heads = [_Head(file, order) for file in files]
    while heads:
        for head in heads:
            head.fill()
        heads = [head for head in heads if head.rows.num_rows]
        bound = min((head.place(-1) for head in heads if not head.ended), default=None)
        taken = [rows for rows in (head.take(bound) for head in heads) if rows.num_rows]
        if taken:
            yield _sorted(pa.concat_tables(taken), order)


def in_order(
    batches: Iterator[pa.RecordBatch], order: Sequence[str], run_bytes: int = RUN_BYTES, fan_in: int = FAN_IN
) -> Iterator[pa.Table]:
    """The rows of ``batches`` by the columns ``order``, table after table; those columns hold no nulls."""
    levels: list[list[BinaryIO]] = [[]]  # runs, runs made of fan_in runs, and so on
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size < run_bytes:
            continue
        schema, rows = batch.schema, _sorted(pa.Table.from_batches(held), order)
        held, size = [], 0
        levels[0].append(_written(iter([rows]), schema))
        del rows
        for level, files in enumerate(levels):
            if len(files) == fan_in:
                if level + 1 == len(levels):
                    levels.append([])
                levels[level + 1].append(_written(_merged(files, order), schema))
                files.clear()
        pa.default_memory_pool().release_unused()
    rest = _sorted(pa.Table.from_batches(held), order) if held else None
    files = [file for level in levels for file in level]
    if not files:
        if rest is not None:
            yield rest
        return
    if rest is not None:
        files.insert(0, _written(iter([rest]), rest.schema))
        rest = None
    held = []
    while len(files) > fan_in:
        files = [*files[fan_in:], _written(_merged(files[:fan_in], order), schema)]
    yield from _merged(files, order)
