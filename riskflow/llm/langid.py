"""Language ID with language-bitmask n-gram filters.

One Bloom filter serves all languages: each slot holds a bit per language (bit-sliced), and the
slots that an n-gram hashes to, ANDed, name every language that contains it. A text's bits are
counted per language, the share expected from false positives is taken off, and the largest
corrected share decides.

Learning uses a bounded, repeatable sample of labelled rows (``per_language`` rows each on
average, whole texts); n-gram counting and filter building run as Spark aggregations, and the
driver sees at most ``slots`` rows and a row per language. Prediction is one pass without a shuffle.

* text null or without a letter: ``und`` with score 0; rows with a null label or key teach nothing;
* ties between languages go to the smaller name; a repeated row gets the same answer;
* a label with few texts teaches little, and its own texts may score low; ``texts`` says how many there were;
* no labelled row at all (or an empty table): every answer is ``und``;
* a label with few rows takes no n-gram from another: what it says of a frequency is bounded by its number of texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import kept_table, packed

SIZES = (3, 4)
HASHES = 2
MASK_BYTES = 64 << 20


@dataclass(frozen=True)
class LanguageFilter:
    languages: tuple[str, ...]
    masks: np.ndarray  # slots x words of 64 languages
    texts: tuple[int, ...] = ()  # labelled texts per language

    @property
    def chance(self) -> np.ndarray:
        """Probability, per language, that an n-gram it lacks seems to be in it."""
        set_ = [float(((self.masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean()) for i in range(len(self.languages))]
        return np.array(set_) ** HASHES


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point to lower-case letter, 0 for everything that is not a letter."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            table[code] = ord(char.lower()[0])
    return table


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams, and the text each belongs to.

    Runs of other characters count as one boundary; an n-gram may start or end with a boundary
    but never spans one.
    """
    codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    symbols = _letters()[codes]
    stays = (symbols != 0) | (np.append(np.uint32(1), symbols[:-1]) != 0)
    symbols = np.append(np.uint64(0), symbols[stays].astype(np.uint64))
    owner = np.append(0, owner[stays])
    letter = symbols != 0
    hashes, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for n in SIZES:
        if len(symbols) < n:
            continue
        many = len(symbols) - n + 1
        inside = np.ones(many, bool)
        for k in range(1, n - 1):
            inside &= letter[k : k + many]
        mixed = np.full(many, n, np.uint64)
        for k in range(n):
            mixed = (mixed * np.uint64(0x9E3779B97F4A7C15)) ^ symbols[k : k + many]
        mixed = mixed[inside]
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        hashes.append(mixed ^ (mixed >> np.uint64(32)))
        owners.append(owner[1 : 1 + many][inside])
    return np.concatenate(hashes), np.concatenate(owners)


def slots_of(hashes: np.ndarray, slots: int) -> list[np.ndarray]:
    return [((hashes >> np.uint64(24 * k)) % np.uint64(slots)).astype(np.int64) for k in range(HASHES)]


def _groups(texts: pa.Array, size: int = 1 << 19) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of rows of about ``size`` bytes, whole texts always: where each starts, and its texts."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + size, side="right")))
        yield start, texts.slice(start, stop - start).to_pylist()
        start = stop


def learn(docs: DataFrame, label: Column, learnable: Column, key: str = "doc_id", text: str = "text", per_language: int = 4000, slots: int = 1 << 19, most_languages: int = 4096, min_count: int = 3, least: float = 0.5, doubt: float = 2.0) -> LanguageFilter:
    """Fit the filter.

    A language contains an n-gram that its sampled texts hold ``min_count`` times or more at no
    less than ``least`` times the largest relative frequency that any language is sure to have.
    The labels with the most texts are languages, up to ``most_languages``; texts under other labels teach
    nothing. With many languages there are fewer slots, so that the masks never take more than ``MASK_BYTES``.
    Texts are the draws, since an n-gram comes in bursts inside one: of a frequency seen in k texts,
    the share 1 - ``doubt`` / sqrt(k) is sure. Only n-grams seen ``min_count`` times count.
    """
    known = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), label.alias("label"), learnable.alias("ok"))
    known = known.where("ok and label is not null and text is not null and key is not null")
    texts = known.groupBy("label").agg(F.count("*").alias("many")).orderBy(F.desc("many"), "label").limit(most_languages).toPandas()
    texts = texts.sort_values("label", ignore_index=True)
    languages = tuple(texts["label"])
    if not languages:
        return LanguageFilter((), np.zeros((1, 1), np.uint64))
    words = (len(languages) + 63) // 64
    slots = min(slots, MASK_BYTES // (8 * words))
    coded = docs.sparkSession.createDataFrame([(name, i, min(1.0, per_language / many)) for i, (name, many) in enumerate(zip(languages, texts["many"].tolist()))], "label string, code int, share double")
    some = known.join(F.broadcast(coded), "label")  # at most ``most_languages`` rows
    sample = some.where(F.pmod(F.xxhash64("key", F.lit("language sample")), F.lit(1 << 20)) < F.col("share") * (1 << 20)).select("code", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column(0).to_numpy()
            for a, texts in _groups(batch.column(1)):
                hashes, owners = grams(texts)
                order = np.lexsort((owners, hashes))
                hashes, owners = hashes[order], owners[order]
                first = np.append(True, (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1]))[: len(hashes)]
                times = np.diff(np.append(np.flatnonzero(first), len(hashes)))
                hashes, coded = hashes[first], codes[a + owners[first]]
                for c in np.unique(coded):
                    own, start, held = np.unique(hashes[coded == c], return_index=True, return_counts=True)
                    many = np.add.reduceat(times[coded == c], start)
                    yield pa.record_batch([pa.array(np.full(len(own), c), pa.int32()), pa.array(own.view(np.int64)), pa.array(many), pa.array(held)], names=["code", "gram", "many", "held"])

    counts = sample.mapInArrow(count, "code int, gram long, many long, held long").groupBy("code", "gram").agg(F.sum("many").alias("many"), F.sum("held").alias("held"))
    counts = kept_table(counts, "gram-counts")
    totals = counts.groupBy("code").agg(F.sum("many").alias("total"))
    sure = F.col("rate") * (1 - F.lit(doubt) / F.sqrt("held"))
    holds = (
        counts.where(F.col("many") >= min_count)
        .join(F.broadcast(totals), "code")
        .withColumn("rate", F.col("many") / F.col("total"))
        .groupBy("gram")
        .agg(F.max(sure).alias("top"), F.collect_list(F.struct("code", "rate")).alias("own"))
        .select("gram", "top", F.explode("own").alias("o"))
        .where(F.col("o.rate") >= least * F.col("top"))
    )

    def slot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column(0).to_numpy()
            for places in slots_of(batch.column(1).to_numpy().view(np.uint64), slots):
                bits = np.left_shift(np.uint64(1), (codes % 64).astype(np.uint64)).view(np.int64)
                yield pa.record_batch([pa.array(places), pa.array(codes // 64, pa.int32()), pa.array(bits)], names=["slot", "word", "bits"])

    sliced = holds.select("o.code", "gram").mapInArrow(slot, "slot long, word int, bits long").groupBy("slot", "word").agg(F.bit_or("bits").alias("bits")).toArrow()
    masks = np.zeros((slots, words), np.uint64)
    masks[sliced["slot"].to_numpy(), sliced["word"].to_numpy()] = sliced["bits"].to_numpy().view(np.uint64)
    return LanguageFilter(languages, masks, tuple(texts["many"].tolist()))


def decide(model: LanguageFilter, chance: np.ndarray, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    names, scores = ["und"] * len(texts), np.zeros(len(texts))
    size = max(1 << 14, (1 << 19) // model.masks.shape[1])  # an n-gram takes the words of its mask
    for a, some in _groups(texts, size) if model.languages else ():
        hashes, owners = grams([t or "" for t in some])
        first, *more = slots_of(hashes, len(model.masks))
        held = model.masks[first]
        for places in more:
            held &= model.masks[places]
        many = np.bincount(owners, minlength=len(some))
        shares = np.zeros((len(some), len(model.languages)))
        met = np.bitwise_or.reduce(held, axis=0, initial=np.uint64(0))
        for i in np.flatnonzero([met[i // 64] >> np.uint64(i % 64) & np.uint64(1) for i in range(len(model.languages))]):
            bit = (held[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            shares[:, i] = np.bincount(owners, weights=bit, minlength=len(some)) / np.maximum(many, 1)
        shares = np.clip((shares - chance) / np.maximum(1 - chance, 1e-9), 0, 1)
        best = shares.argmax(axis=1)
        for i in np.flatnonzero(many):
            names[a + i], scores[a + i] = model.languages[best[i]], shares[i, best[i]]
    return names, scores


def identify(docs: DataFrame, model: LanguageFilter, text: str = "text") -> DataFrame:
    """``row`` (the input row), ``lang_pred`` and ``score`` per input row; only the texts go to Python."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most ``slots`` masks

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        chance = sent.value.chance
        for texts in batches:
            names, scores = decide(sent.value, chance, texts)
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], names=["lang_pred", "score"])
            del texts
            pa.default_memory_pool().release_unused()

    # Said to be non-deterministic, so that a filter on the answer doesn't ask twice.
    answer = F.arrow_udf(run, "lang_pred string, score double").asNondeterministic()
    found = packed(docs).withColumn("found", answer(F.col(f"row.`{text}`")))
    return found.select("row", "found.lang_pred", "found.score")


def held_out(key: Column) -> Column:
    """Whether a row is kept out of learning; a null key is not, and teaches nothing either."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
