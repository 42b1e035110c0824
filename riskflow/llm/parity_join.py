"""N-gram Jaccard join with parity sketches.

A text is its set of distinct word shingles. Two texts link if their Jaccard similarity reaches
a threshold, given as a whole percentage so that the test is exact integer arithmetic.

*Sketch.* Each shingle flips one bit of a parity sketch, so the Hamming distance of two sketches
is at most the size of the symmetric difference. Within a size band that difference is at most
``d`` for every linked pair. The sketch is cut into ``d + t`` segments; by the pigeonhole principle
a linked pair agrees on at least ``t`` whole segments, so each text may leave out ``t - 1`` of
its segments, the first of an order that all texts share. Left out first are those that say little:
empty ones, then those made of shingles only that a bounded sample of texts shows to be common
(the sample steers the order, never the result). A segment's content is shuffled as a
64-bit digest: the XOR of a mixed value per set bit, which parity makes computable shingle by shingle.

*Candidates.* Texts that agree on a segment form a bucket. Each task first joins its own members
to the smallest one and sends on that one only, so a hot bucket is small before
the shuffle; then the bucket's members are joined to its smallest member. Those pairs are
verified on whole shingle sets and connected. Buckets that still hold several components
are then compared pair by pair across components. Members of one component need no more comparing,
so a large group of copies costs a star and not its square. All pairs are first held against the
bound by the Hamming distance of short bit sketches of whole sets; a bucket is compared in blocks, and
only pairs within the bound leave their task to be verified. An eighth of the buckets goes first: the
links found there leave little to compare in the others.

* null, empty or blank text: empty set, linked with nothing; fewer words than ``n``: one shingle;
* rows that repeat a key are one document, linked by whatever any of them is; a null key is never
  linked and has no component;
* an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.common import kept_table, release_shuffles, slices, words_of

BITS = 1 << 16  # of each segment
SHORT = 1024  # bits of the short sketch of a whole set
BLOCK = 1024  # members of a large bucket that one task holds twice at most
PAIRS = 1 << 17  # compared at a time
ROUNDS = (8, 1)  # of the mixed buckets, one in so many is compared in each round
EMPTY = np.uint64(0x5851F42D4C957F2D)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each whole text."""
    import xxhash

    owner, code, words = words_of(pc.ascii_lower(texts))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))[code]
    many = np.bincount(owner, minlength=len(texts))
    ends = np.cumsum(many)
    # Windows that run into the next text are cut off below.
    padded = np.append(hashes, np.zeros(n, np.uint64))
    mixed = np.full(len(hashes), n, np.uint64)
    for k in range(n):
        mixed = _mix(mixed * np.uint64(0x9E3779B97F4A7C15) + padded[k : k + len(hashes)])
    out = []
    for size, end in zip(many.tolist(), ends.tolist()):
        if size >= n:
            out.append(np.unique(mixed[end - size : end - n + 1]))
        else:
            whole = np.full(1 if size else 0, size, np.uint64)
            for k in range(size):
                whole = _mix(whole * np.uint64(0x9E3779B97F4A7C15) + hashes[end - size + k])
            out.append(whole)
    return out


class Bands:
    """Size bands for a threshold of ``percent``: a linked pair is in one band or in neighbours.

    Interval j covers bands j and j + 1; a text of band b belongs to intervals b - 1 and b.
    """

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.last = [1]  # largest size of each band

    def band(self, size: int) -> int:
        while self.last[-1] < size:
            self.last.append(max(self.last[-1] + 1, self.last[-1] * 100 // self.percent))
        return int(np.searchsorted(self.last, size))

    def difference(self, interval: int) -> int:
        """Largest symmetric difference of a linked pair in an interval."""
        while len(self.last) < interval + 2:
            self.band(self.last[-1] + 1)
        return 2 * self.last[interval + 1] * (100 - self.percent) // (100 + self.percent)

    def segments(self, interval: int) -> tuple[int, int]:
        """How many segments the interval's sketch has, and how many of them a text may leave out."""
        d = self.difference(interval)
        spare = 0 if d == 0 else 1 + d // 3
        return d + 1 + spare, spare


def segment_keys(hashes: np.ndarray, rare: np.ndarray, bands: Bands) -> np.ndarray:
    """Digests of the sketch segments of one text, for both of its intervals.

    ``rare`` tells which shingles are not common. What a segment says is a function of its
    content alone, so two texts rank an equal segment equally.
    """
    keys = []
    band = bands.band(len(hashes))
    for interval in range(max(band - 1, 0), band + 1):
        many, spare = bands.segments(interval)
        # The high bits choose the segment, so sorted hashes come segment by segment.
        segment = (hashes >> np.uint64(32)) * np.uint64(many) >> np.uint64(32)
        bit = segment * np.uint64(BITS) + (hashes & np.uint64(BITS - 1))
        first = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
        place = segment[first].astype(np.int64)
        content, says = np.zeros(many, np.uint64), np.zeros(many, np.uint64)
        content[place] = np.bitwise_xor.reduceat(_mix(bit + np.uint64(1)), first)
        says[place] = np.where(np.logical_or.reduceat(rare, first), np.uint64(2), np.uint64(1))
        says[content == 0] = 0
        content[content == 0] = EMPTY
        own = _mix(content ^ _mix(np.arange(many, dtype=np.uint64) + np.uint64(interval << 32)))
        # The lowest bit tells the two intervals of a band apart.
        own = own >> np.uint64(1) << np.uint64(1) | np.uint64(interval & 1)
        keys.append(own[np.lexsort((own, says))[spare:]] if spare else own)
    return np.concatenate(keys)


def _int64(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _digest(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    return int(np.bitwise_xor.reduce(_mix(hashes ^ np.uint64(0x1234567)))), int(np.add.reduce(_mix(hashes + np.uint64(0x89ABCDE))))


def short_sketch(hashes: np.ndarray) -> bytes:
    """Parity of the shingles per bit of a short sketch."""
    odd = np.bincount(((hashes >> np.uint64(16)) % np.uint64(SHORT)).astype(np.int64), minlength=SHORT) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def shingle_sets(docs: DataFrame, n: int) -> DataFrame:
    """``doc`` and its set of shingle hashes (64 bits each, sorted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = [s.tobytes() for s in shingles(part.column(1), n)]
            yield pa.record_batch([part.column(0), pa.array(sets, pa.binary())], names=["doc", "shingles"])

    return docs.select("doc", "text").mapInArrow(run, "doc long, shingles binary")


def common_shingles(docs: DataFrame, n: int, sample: int, least: float) -> np.ndarray:
    """Shingles that at least ``least`` of about ``sample`` texts hold, sorted.

    At most the sample's shingles divided by ``least * sample`` come to the driver.
    """
    total = docs.count()
    share = min(1.0, sample / max(total, 1))
    some = docs.where(F.pmod(F.xxhash64("doc", F.lit("common shingles")), F.lit(1 << 20)) < share * (1 << 20))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            own, many = np.unique(np.concatenate([np.zeros(0, np.uint64), *shingles(part.column(1), n)]), return_counts=True)
            yield pa.record_batch([_int64(own), pa.array(many)], names=["shingle", "many"])

    counted = some.select("doc", "text").mapInArrow(run, "shingle long, many long").groupBy("shingle").agg(F.sum("many").alias("many"))
    found = counted.where(F.col("many") >= max(3, least * share * total)).select("shingle").toArrow()
    return np.sort(found["shingle"].to_numpy().view(np.uint64))


def _star_in_chunks(docs: DataFrame, n: int, percent: int, chunk: int, common: np.ndarray) -> DataFrame:
    """One pass over the texts: rows (segment, doc, center, n_shingles, sketch) of three kinds.

    A segment on its way to its bucket has no center. A segment that met a smaller text in this
    chunk names it as center. One row per text has ``n_shingles`` and the short sketch, with the
    set's digest in the places of segment and center. Of equal sets in a chunk only the first is sent to
    buckets: the others are linked by their digests.
    """
    sent = docs.sparkSession.sparkContext.broadcast(common)
    names = ["segment", "doc", "center", "n_shingles", "sketch"]

    def flush(keys: list[np.ndarray], owners: list[np.ndarray]) -> pa.RecordBatch:
        key, doc = np.concatenate(keys), np.concatenate(owners)
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        new = np.append(True, key[1:] != key[:-1])
        first = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
        stays = new | np.append(True, doc[1:] != doc[:-1])
        center = pa.array(doc[first][stays], pa.int64(), mask=new[stays])
        rows = int(stays.sum())
        return pa.record_batch([_int64(key[stays]), pa.array(doc[stays]), center, pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.binary())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, keys, owners, held, seen = Bands(percent), [], [], 0, set()
        for part in slices(batches):
            sets = shingles(part.column(1), n)
            marks = [_digest(s) for s in sets]
            digests = np.array(marks, np.uint64).reshape(-1, 2)
            columns = [_int64(digests[:, 0].copy()), part.column(0), _int64(digests[:, 1].copy()), pa.array([len(s) for s in sets], pa.int64())]
            yield pa.record_batch([*columns, pa.array([short_sketch(s) for s in sets], pa.binary())], names=names)
            every = np.concatenate([np.zeros(0, np.uint64), *sets])
            at = np.minimum(np.searchsorted(sent.value, every), max(len(sent.value) - 1, 0))
            rare = sent.value[at] != every if len(sent.value) else np.ones(len(every), bool)
            start = 0
            for doc, own, mark in zip(part.column(0).to_pylist(), sets, marks):
                if len(own) and doc is not None and mark not in seen:
                    seen.add(mark)
                    keys.append(segment_keys(own, rare[start : start + len(own)], bands))
                    owners.append(np.full(len(keys[-1]), doc, np.int64))
                    held += len(keys[-1])
                start += len(own)
            if held >= chunk:
                yield flush(keys, owners)
                keys, owners, held, seen = [], [], 0, set()
        if held:
            yield flush(keys, owners)

    return docs.select("doc", "text").mapInArrow(run, "segment long, doc long, center long, n_shingles long, sketch binary")


def _of_classes(pairs: DataFrame, copies: DataFrame) -> DataFrame:
    """The distinct pairs (a < b) with each end replaced by the representative of its set."""
    for end in ("a", "b"):
        named = copies.select(F.col("b").alias(end), F.col("a").alias("rep"))
        pairs = pairs.join(named, end, "left").withColumn(end, F.coalesce("rep", end)).drop("rep")
    return pairs.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _near(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and short sketches allow to link."""
    left = sketches.select(F.col("doc").alias("a"), F.col("n_shingles").alias("m"), F.col("sketch").alias("x"))
    right = sketches.select(F.col("doc").alias("b"), F.col("n_shingles").alias("n"), F.col("sketch").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, n = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(len(m), -1) for c in (4, 5))
            near = np.bitwise_count(x ^ y).sum(axis=1) * (100 + percent) <= (m + n) * (100 - percent)
            near &= 100 * np.minimum(m, n) >= percent * np.maximum(m, n)
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(near))

    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "m", "n", "x", "y")
    return joined.mapInArrow(run, "a long, b long").distinct()


def _linked(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link, tested on whole shingle sets.

    Only texts that occur in a pair are shingled again; the sets are joined by key.
    """
    wanted = kept_table(pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct(), "paired")
    sets = kept_table(shingle_sets(docs.join(wanted, "doc", "left_semi"), n), "paired-sets")
    left = sets.select(F.col("doc").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                small, large = sorted((len(x), len(y)))
                if 100 * small < percent * large:
                    kept.append(False)
                    continue
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                kept.append(100 * common >= percent * (small + large - common))
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(kept, pa.bool_()))

    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return joined.mapInArrow(run, "a long, b long")


def _close_in_blocks(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different roots in one bucket whose short sketches are near enough to link.

    ``members`` holds segment, held, a, root, n_shingles, sketch. Members are dealt into blocks and
    every two blocks of a bucket meet in a task, so a task's memory doesn't follow the bucket.
    """
    blocks = F.ceil(F.col("held") / F.lit(BLOCK)).cast("int")
    dealt = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("segment", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "a", "root", "n_shingles", "sketch")

    def close(rows: pa.Table) -> pa.RecordBatch:
        """The near pairs of whole groups, all groups at once, ``PAIRS`` pairs at a time."""
        rows = rows.combine_chunks()
        segment, i, j, doc, root, size, block = (rows[c].to_numpy() for c in ("segment", "i", "j", "a", "root", "n_shingles", "block"))
        sketch = np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint64).reshape(len(doc), -1)
        bands = Bands(percent)
        bands.band(int(size.max(initial=1)))
        band = np.searchsorted(bands.last, size)
        # Two texts of one band meet in both of its intervals and are compared in the upper one.
        skipped = (band & 1) != (segment & 1)
        new = np.append(True, (segment[1:] != segment[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))
        ends = np.append(np.flatnonzero(new)[1:], len(doc))[np.cumsum(new) - 1]
        later = ends - np.arange(len(doc)) - 1  # members of the same group further on
        upto, start, found = np.cumsum(later), 0, []
        while start < len(doc):
            stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + PAIRS, side="right")))
            many = later[start:stop]
            x = np.repeat(np.arange(start, stop), many)
            y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(many) - many, many)
            differ = (root[x] != root[y]) & (doc[x] != doc[y]) & ((block[x] != block[y]) | (i[x] == j[x]))
            differ &= ~(skipped[x] & (band[x] == band[y]))
            differ &= 100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y])
            x, y = x[differ], y[differ]
            near = np.bitwise_count(sketch[x] ^ sketch[y]).sum(axis=1) * (100 + percent) <= (size[x] + size[y]) * (100 - percent)
            found.append(np.sort(np.stack([doc[x[near]], doc[y[near]]]), axis=0))
            start = stop
        pairs = np.unique(np.concatenate([np.zeros((2, 0), np.int64), *found], axis=1), axis=1)
        return pa.record_batch([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups come one after the other; the last one of a batch may go on in the next."""
        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            own = [rows[c].to_numpy() for c in ("segment", "i", "j")]
            last = np.flatnonzero(np.logical_or.reduce([c != c[-1] for c in own])) if rows.num_rows else np.zeros(0, int)
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield close(rows.slice(0, cut))
            rest = rows.slice(cut)
        if rest is not None and rest.num_rows:
            yield close(rest)

    return dealt.repartition("segment", "i", "j").sortWithinPartitions("segment", "i", "j").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``doc`` and ``root`` (smallest key reachable) for every end of the edges (a < b).

    Rounds of two steps, each a join: a node with several smaller neighbours keeps the
    smallest and passes the others on to it; then every parent is replaced by its own parent. Ends
    when each node has one parent and no parent has one.
    """
    edges = kept_table(edges.select("a", "b").distinct(), "edges")
    while True:
        least = kept_table(edges.groupBy("b").agg(F.min("a").alias("p"), F.max("a").alias("q")), "parents")
        crossed = edges.join(least.where("p < q").select("b", "p"), "b").where("a > p").select(F.col("p").alias("a"), F.col("a").alias("b"))
        up = least.select(F.col("b").alias("a"), F.col("p").alias("grand"))
        jumped = least.select("b", F.col("p").alias("a")).join(up, "a", "left").select(F.coalesce("grand", "a").alias("a"), "b", F.col("grand").isNotNull().alias("moved"))
        new = jumped.unionByName(crossed.withColumn("moved", F.lit(True))).groupBy("a", "b").agg(F.max("moved").alias("moved"))
        edges = kept_table(new, "edges")
        if not edges.where("moved").limit(1).count():
            break
    roots = edges.select(F.col("a").alias("doc")).distinct().select("doc", F.col("doc").alias("root"))
    return edges.select(F.col("b").alias("doc"), F.col("a").alias("root")).unionByName(roots)


def _rooted(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs with the roots of both ends (themselves if they have none)."""
    for end in ("a", "b"):
        named = roots.select(F.col("doc").alias(end), F.col("root").alias(f"root_{end}"))
        pairs = pairs.join(named, end, "left").withColumn(f"root_{end}", F.coalesce(f"root_{end}", end))
    return pairs


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 4, percent: int = 85, chunk: int = 250_000, sample: int = 20_000, common_share: float = 0.001) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` for every input row.

    ``chunk`` is the number of segment rows that a task compares before it sends them on; it
    bounds memory. ``sample`` and ``common_share`` say how common shingles are found. None of
    the three changes the result.
    """
    docs = docs.select(F.col(f"`{key}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"))
    common = common_shingles(docs, n, sample, common_share)
    rows = _star_in_chunks(docs, n, percent, chunk, common)
    # A row that has its center already needs no company, so it is dealt out by its own key.
    bucket = Window.partitionBy("segment", F.when(F.col("center").isNotNull(), F.col("doc")).otherwise(0))
    rows = rows.withColumn("center", F.coalesce("center", F.min("doc").over(bucket))).where("n_shingles is not null or center < doc")
    rows = kept_table(rows, "met")
    met = rows.where("n_shingles is null").drop("n_shingles", "sketch")

    # Equal sets are one class, represented by the smallest key.
    sizes = rows.where("n_shingles is not null").select("doc", "n_shingles", F.col("segment").alias("p"), F.col("center").alias("q"))
    classes = sizes.where("doc is not null and n_shingles > 0")
    smallest = kept_table(classes.groupBy("n_shingles", "p", "q").agg(F.min("doc").alias("rep"), F.max("doc").alias("last")), "classes")
    copies = classes.join(smallest.where("rep < last"), ["n_shingles", "p", "q"]).select(F.col("rep").alias("a"), F.col("doc").alias("b")).distinct()
    equal = kept_table(copies.where("a < b"), "copies")
    # A key with several sets stands for itself: its pairs may come from any of them.
    single = classes.groupBy(F.col("doc").alias("b")).agg(F.min(F.struct("n_shingles", "p", "q")).alias("low"), F.max(F.struct("n_shingles", "p", "q")).alias("high")).where("low = high")
    copies = kept_table(equal.join(single.select("b"), "b", "left_semi"), "single-copies")

    known = docs.where("doc is not null")
    sketches = rows.where("n_shingles > 0 and doc is not null").select("doc", "n_shingles", "sketch")
    compared = kept_table(_of_classes(met.select(F.col("center").alias("a"), F.col("doc").alias("b")), copies), "pairs")
    release_shuffles(docs.sparkSession)
    links = kept_table(_linked(kept_table(_near(compared, sketches, percent), "near-pairs"), known, n, percent), "links")
    release_shuffles(docs.sparkSession)
    roots = kept_table(components(links.unionByName(equal)), "roots")

    # Buckets with several components: every pair across them that is not compared yet.
    for one_in in ROUNDS:
        some = met.where(F.pmod("segment", F.lit(one_in)) == 0)
        open_pairs = _rooted(some.select(F.col("center").alias("a"), F.col("doc").alias("b"), "segment"), roots)
        mixed = kept_table(open_pairs.where("root_a != root_b").select("segment").distinct(), "mixed")
        members = some.join(mixed, "segment", "left_semi").select("segment", F.explode(F.array("center", "doc")).alias("a")).distinct()
        members = kept_table(_rooted(members.withColumn("b", F.col("a")), roots).select("segment", "a", F.col("root_a").alias("root")), "members")
        held = members.groupBy("segment").agg(F.count("*").alias("held"))
        # A repeated key may have several sets; all are compared.
        dealt = members.join(held, "segment").join(sketches.withColumnRenamed("doc", "a"), "a")
        more = _of_classes(_close_in_blocks(dealt, percent), copies).join(compared, ["a", "b"], "left_anti")
        more = kept_table(more, "more-pairs")
        release_shuffles(docs.sparkSession)
        if more.limit(1).count():
            links = kept_table(links.unionByName(_linked(more, known, n, percent)), "links")
            compared = compared.unionByName(more)
            release_shuffles(docs.sparkSession)
            roots = kept_table(components(links.unionByName(equal)), "roots")

    named = roots.select(F.col("doc"), "root")
    return sizes.join(named, "doc", "left").select(F.col("doc").alias("doc_id"), "n_shingles", F.coalesce("root", "doc").alias("component_id"))
