"""Importance resampling of documents towards a target set.

*Weights.* Features are runs of 1 to ``longest`` words, hashed into a fixed number of buckets. Corpus and
target are counted into one array of buckets each (a task adds up its own array before anything
is shuffled), and the log ratio of the two smoothed distributions is an array of gains. A
document's weight is the floored mean of its features' gains.

*Draw.* Adding Gumbel noise to the weights and taking the largest scores draws without replacement in
proportion to exp(weight / 1000). The noise is a function of seed and document key, so reruns agree.

*Selection.* The cutoff key is found without a global sort: each partition reports the median of
the keys it still has, the median of these medians weighted by the remaining numbers is the next pivot,
and the side that can't hold the cutoff goes, at least about a quarter of all remaining keys in each
round. What is left is written again when it has halved, so all rounds together read a few times the
keys, never the texts. The last ``base`` keys are sorted at once. Only the winners are then sorted, by ranges.

* a null text has no features: weight 0; a null key is hashed as the empty text and loses all ties;
* equal rows are drawn one by one, so a repeated row may be drawn in part; which of them has which rank is open;
* too few words: never drawn, though the row has a weight and a score;
* an empty corpus or nothing to draw: no ranks; an empty target: its counts are all zero.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.common import kept_table, packed, slices
from riskflow.operators.carry import in_parts

# Bytes of words: digits, ASCII letters (folded to lower case) and everything beyond ASCII.
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[ord("A") : ord("Z") + 1] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[ord("0") : ord("9") + 1] = _IN_WORD[ord("a") : ord("z") + 1] = _IN_WORD[128:] = True

SCORES = "doc_id long, mark long, n_words long, n_features long, weight long, score long"
#: The order of the draw: larger scores first, ties to the smaller key, null keys last.
ORDER = ("down", "keyless", "doc_id", "n_features", "weight", "mark")


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Owner and code of each word of the texts in order, and the distinct words by code."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    chars = _FOLDED[np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]] if data is not None else np.zeros(0, np.uint8)
    starts = offsets[:-1] - offsets[0]
    inside = _IN_WORD[chars]
    before = np.append(False, inside[:-1])[: len(inside)]
    before[starts[starts < len(chars)]] = False  # a text's first word starts with it
    first = np.flatnonzero(inside & ~before)
    ends = np.append(np.cumsum(inside)[first] - 1, inside.sum()).astype(np.int64)
    found = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(chars[inside].tobytes())])
    coded = found.dictionary_encode()
    owner = np.searchsorted(offsets[1:] - offsets[0], first, side="right")
    return owner, coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()


def feature_buckets(texts: pa.Array, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner and bucket of every feature, repeats included, and the number of words of each text."""
    owner, code, words = _words(texts)
    crc = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
    owners, found = [owner], [crc[code] % buckets]
    run, run_crc = code, crc
    for size in range(2, longest + 1):
        whole = owner[size - 1 :] == owner[: len(owner) - size + 1]
        pairs, place = np.unique(run[: len(whole)] * len(words) + code[size - 1 :], return_inverse=True)
        run_crc = np.fromiter((zlib.crc32(b" " + words[p % len(words)], int(run_crc[p // len(words)])) for p in pairs.tolist()), np.int64, len(pairs))
        run = place.astype(np.int64)
        owners.append(owner[: len(whole)][whole])
        found.append(run_crc[run[whole]] % buckets)
    return np.concatenate(owners), np.concatenate(found), np.bincount(owner, minlength=len(texts))


def bucket_counts(texts: DataFrame, text: str, longest: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket; the driver gets one row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for part in slices(batches):
            held += np.bincount(feature_buckets(part.column(0), longest, buckets)[1], minlength=buckets)
        used = np.flatnonzero(held)
        yield pa.record_batch([pa.array(used), pa.array(held[used])], names=["bucket", "many"])

    counted = texts.select(F.col(f"`{text}`").cast("string")).mapInArrow(run, "bucket long, many long")
    summed = counted.groupBy("bucket").agg(F.sum("many").alias("many")).toArrow()
    counts = np.zeros(buckets, np.int64)
    counts[summed["bucket"].to_numpy()] = summed["many"].to_numpy()
    return counts


def gains_of(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target to corpus, per bucket, rounded down."""
    buckets, in_corpus, in_target = len(corpus), int(corpus.sum()), int(target.sum())
    ratio = [float(t + 1) * float(in_corpus + buckets) / (float(s + 1) * float(in_target + buckets)) for s, t in zip(corpus.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def _noise(key: int | None, seed: int) -> int:
    """Gumbel noise in thousandths, from a hash of seed and key."""
    head = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8]
    return math.floor(-1000 * math.log(-math.log((int(head, 16) + 0.5) / 4294967296)))


def score_documents(docs: DataFrame, gains: np.ndarray, longest: int, seed: int, key: str, text: str) -> DataFrame:
    """``SCORES`` of every row; ``mark`` is a hash of the text, which tells rows of one key apart."""
    sent = docs.sparkSession.sparkContext.broadcast(gains)  # one number per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            owner, bucket, words = feature_buckets(part.column("text"), longest, len(sent.value))
            many = np.bincount(owner, minlength=part.num_rows)
            total = np.bincount(owner, weights=sent.value[bucket], minlength=part.num_rows).astype(np.int64)
            weight = total // np.maximum(many, 1)
            noise = np.array([_noise(k, seed) for k in part.column("doc_id").to_pylist()], np.int64)
            yield pa.record_batch([part.column("doc_id"), part.column("mark"), *map(pa.array, (words, many, weight, weight + noise))], names=[c.split()[0] for c in SCORES.split(", ")])

    text = F.col(f"`{text}`").cast("string")
    mark = F.xxhash64(F.coalesce(text, F.lit("")))
    return docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), mark.alias("mark"), text.alias("text")).mapInArrow(run, SCORES)


def _keys(scored: DataFrame) -> DataFrame:
    return scored.select((-F.col("score")).alias("down"), F.col("doc_id").isNull().cast("int").alias("keyless"), F.coalesce("doc_id", F.lit(0)).alias("id"))


Key = tuple[int, int, int]


def _before(key: Key) -> Column:
    """Whether a row's key comes before ``key``; the first test is one that a Parquet scan can use."""
    down, keyless, number = (F.lit(k) for k in key)
    tied = (F.col("keyless") < keyless) | ((F.col("keyless") == keyless) & (F.col("id") < number))
    return (F.col("down") <= down) & ((F.col("down") < down) | tied)


def _after(key: Key) -> Column:
    down, keyless, number = (F.lit(k) for k in key)
    tied = (F.col("keyless") > keyless) | ((F.col("keyless") == keyless) & (F.col("id") > number))
    return (F.col("down") >= down) & ((F.col("down") > down) | tied)


def _medians(keys: DataFrame, pivot: Key | None) -> pa.Table:
    """Per partition and side of the pivot (-1, 0, 1): how many keys, and their lower median."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.stack([c.to_numpy() for c in batch.columns]) for batch in batches]
        rows = np.concatenate([np.zeros((3, 0), np.int64), *held], axis=1)
        down, keyless, number = rows = rows[:, np.lexsort(rows[::-1])]
        low = high = 0
        if pivot is not None:
            # Rows are in order, so each comparison with the pivot is a search.
            a, b = np.searchsorted(down, pivot[0], "left"), np.searchsorted(down, pivot[0], "right")
            c, d = a + np.searchsorted(keyless[a:b], pivot[1], "left"), a + np.searchsorted(keyless[a:b], pivot[1], "right")
            low, high = c + np.searchsorted(number[c:d], pivot[2], "left"), c + np.searchsorted(number[c:d], pivot[2], "right")
        sides = [(side, start, end) for side, start, end in ((-1, 0, low), (0, low, high), (1, high, len(down))) if end > start]
        middle = [(start + end - 1) // 2 for _, start, end in sides]
        columns = [pa.array([s for s, _, _ in sides], pa.int64()), pa.array([e - b for _, b, e in sides], pa.int64())]
        yield pa.record_batch([*columns, *[pa.array(rows[i, middle], pa.int64()) for i in range(3)]], names=["side", "many", "down", "keyless", "id"])

    return keys.mapInArrow(run, "side long, many long, down long, keyless long, id long").toArrow()


def _weighted_median(found: pa.Table) -> Key:
    rows = sorted(zip(*[found[c].to_pylist() for c in ("down", "keyless", "id", "many")]))
    half, total = sum(r[3] for r in rows) / 2, 0
    for *key, many in rows:
        total += many
        if total >= half:
            return tuple(key)
    raise ValueError("no keys left")


def cutoff_key(scored: DataFrame, wanted: int, base: int = 4096) -> Key:
    """The key of the ``wanted``-th row in the order of the draw (1 is the first).

    The driver gets at most three rows per partition and round.
    """
    stored = left = kept_table(_keys(scored), "keys")
    pivot, side, written, held = None, 1, None, None
    while True:
        found = _medians(left, pivot)
        counts = {s: 0 for s in (-1, 0, 1)}
        for s, many in zip(found["side"].to_pylist(), found["many"].to_pylist()):
            counts[s] += many
        written = written or sum(counts.values())
        if wanted <= counts[-1]:
            side, left = -1, left.where(_before(pivot))
        elif pivot is not None and wanted <= counts[-1] + counts[0]:
            return pivot
        else:
            wanted -= counts[-1] + counts[0]
            side, left = 1, left if pivot is None else left.where(_after(pivot))
        held = counts[side]
        if held <= base:
            rows = sorted(zip(*[c.to_pylist() for c in left.toArrow().columns]))
            return rows[wanted - 1]
        if 2 * held <= written:
            stored = left = kept_table(left, "keys")
            written = held
        pivot = _weighted_median(found.filter(pc.equal(found["side"], side)))


def _numbered(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` numbered from 1 in ``order`` within ``group``, by ranges of about equal size.

    Equal rows may be many; a number of their own lets the ranges cut between them.
    """
    columns = rows.columns
    rows = in_parts(rows.withColumn("own", F.monotonically_increasing_id()), [*group, *order, "own"])
    held = kept_table(rows.groupBy("carry_part", *group).agg(F.count("*").alias("many")), "ranges")
    earlier = Window.partitionBy(*group).orderBy("carry_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    start = F.coalesce(F.sum("many").over(earlier), F.lit(0))
    starts = held.select(F.col("carry_part").alias("of_part"), *[F.col(g).alias(f"of_{g}") for g in group], start.alias("start"))
    same = F.col("carry_part") == F.col("of_part")
    for g in group:
        same &= F.col(g).eqNullSafe(F.col(f"of_{g}"))
    within = Window.partitionBy("carry_part", *group).orderBy(*order, "own")
    return rows.join(starts, same).select(*columns, (F.col("start") + F.row_number().over(within)).alias(name))


def with_ranks(scored: DataFrame, least_words: int, percent: int) -> DataFrame:
    """``scored`` (a written table) with ``rank``: 1, 2, 3... in the order of the draw, null if not drawn."""
    able = F.col("n_words") >= least_words
    wanted = scored.where(able).count() * percent // 100
    undrawn = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return scored.select("*", undrawn)
    last = cutoff_key(scored.where(able), wanted)
    named = scored.select("*", (-F.col("score")).alias("down"), F.col("doc_id").isNull().cast("int").alias("keyless"), F.coalesce("doc_id", F.lit(0)).alias("id"))
    drawn = able & ~_after(last)
    ranked = _numbered(named.where(drawn), [], list(ORDER), "place")
    rank = F.when(F.col("place") <= wanted, F.col("place")).alias("rank")  # more rows may tie with the last one
    return ranked.select(*scored.columns, rank).unionByName(named.where(~drawn).select(*scored.columns, undrawn))


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", longest: int = 1, buckets: int = 10_000, seed: int = 2024, least_words: int = 20, percent: int = 10) -> DataFrame:
    """``SCORES`` and ``rank`` for every row of ``docs``: ``percent`` of the rows with ``least_words`` words are drawn."""
    gains = gains_of(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets))
    return with_ranks(kept_table(score_documents(docs, gains, longest, seed, key, text), "scores"), least_words, percent)


def drawn_documents(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``row`` (the input row) and ``rank`` of the documents drawn, each drawn row once."""
    ranks = resample(docs, target, key, text, **options).where("rank is not null").select("doc_id", "mark", "rank")
    group = ["doc_id", "mark"]
    ranks = kept_table(_numbered(ranks, group, ["rank"], "nth").select(*[F.col(c).alias(f"of_{c}") for c in group], "rank", "nth"), "drawn")
    own = F.col(f"`{text}`").cast("string")
    rows = packed(docs, doc_id=F.col(f"`{key}`").cast("long"), mark=F.xxhash64(F.coalesce(own, F.lit(""))))
    on = F.col("doc_id").eqNullSafe(F.col("of_doc_id")) & (F.col("mark") == F.col("of_mark"))
    # Only rows that share key and text with a drawn one are numbered.
    some = _numbered(rows.join(ranks.where("nth = 1"), on, "left_semi"), group, [], "number")
    return some.join(ranks, on & (F.col("number") == F.col("nth"))).select("row", "rank")
