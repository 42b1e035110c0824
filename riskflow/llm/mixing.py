"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Texts are cut into blocks of words. Each source has an exact quota of blocks; a binary tree over the
output shards splits the vector of quotas, at every node by a multivariate-hypergeometric draw
seeded by the node's place, down to one quota per source and shard. A shard then owns a range of
each source's blocks in their permuted order, disjoint from all other shards, and shuffles them
locally. Any task can walk the tree on its own, so nothing but the sources' totals is shared. Many
sources are dealt into a fixed number of groups: the tree's draws are of groups first, then, given
those, of each group's sources, which is the same distribution and needs one group's totals at a time.

* null or empty text has size 0 and gives no block; a null source is a source of its own, last;
* rows equal in key, source and text are told apart by a running number, and each is mixed;
* an empty table, or sources without a word, give targets of 0;
* a source with any share of all rows is cut into ranges of its permuted order, none of which grows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.common import WORD, kept_table, packed
from riskflow.operators.ordered import running_over_values

KEYS = ("doc_id", "source", "mark", "copy")
#: Source tables up to this many rows are broadcast; larger ones are joined by a shuffle.
BROADCAST_SOURCES = 100_000
#: Sources whose totals a task may hold; of more sources there are as many groups.
TREE_SOURCES = 1_000
#: Blocks of one group that a task deals, and bytes of tree nodes that it remembers.
GROUP_BLOCKS, NODE_BYTES = 200_000, 64 << 20


def document_sizes(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``doc_id``, ``source``, ``size`` in words, ``mark`` (text digest) and ``copy``, one row per input row."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"),
        F.col(f"`{source}`").alias("source"),
        F.regexp_count(body, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(body).alias("mark"),
    )
    counted = rows.groupBy("doc_id", "source", "size", "mark").agg(F.count("*").alias("many"))
    return counted.select("doc_id", "source", "size", "mark", F.explode(F.sequence(F.lit(1), F.col("many"))).alias("copy"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), total: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source``, ``source_size`` and ``target``, one row per source.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``total`` times all
    words. No target exceeds ``most`` times its source; the excess goes to the others by weight.
    Closed form: with sources sorted by limit over weight, the first ones are at their limits and
    the rest share what remains. Both orders are summed in ranges, never over all sources in one task.
    """
    last = F.col("source").isNull()
    ranked = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = ranked.select("*", F.struct(last.alias("last"), "source").alias("value"), F.lit(1).alias("one"))
    ranked = running_over_values(ranked, {"one": "number"})
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("number") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = ranked.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * F.lit(most)).alias("limit"))
    order = F.struct((F.col("limit") / F.col("weight")).alias("ratio"), last.alias("last"), "source")
    ranked = kept_table(running_over_values(ranked.withColumn("value", order), {"limit": "limits", "weight": "weights"}), "mix-levels")
    words, weight_sum = ranked.agg(F.sum("source_size").cast("double"), F.sum("weight")).first()
    ranked = (
        ranked.withColumn("rest", F.lit(words) * F.lit(total) - (F.col("limits") - F.col("limit")))
        .withColumn("weights", F.lit(weight_sum) - (F.col("weights") - F.col("weight")))
        .withColumn("open", F.col("rest") * F.col("weight") / F.col("weights") <= F.col("limit"))
    )
    # The first open source in order has the largest rest among the open ones.
    level = ranked.agg(F.max(F.when(F.col("open"), F.struct("rest", "weights")))).first()[0]
    target = F.col("limit")
    if level is not None:
        target = F.least(target, F.lit(level.rest) * F.col("weight") / F.lit(level.weights))
    return ranked.select("source", "source_size", target.alias("target"))


def _with_targets(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows with their source's columns; null sources match."""
    renamed = targets.withColumnRenamed("source", "named")
    if targets.count() <= BROADCAST_SOURCES:
        renamed = F.broadcast(renamed)
    return rows.join(renamed, rows["source"].eqNullSafe(renamed["named"])).drop("named")


def _number(seed: int, *columns: str) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def draw_blocks(sizes: DataFrame, targets: DataFrame, block_words: int | None, seed: int = 11, bucket_rows: int = 50_000) -> DataFrame:
    """The blocks that the mix takes: keys, ``pass``, ``block``, ``words`` and ``rank``.

    Every whole multiple of a source is a full pass over its blocks; the remainder is the head of
    one more permuted pass, up to the block whose middle lies beyond the target. ``rank`` counts a
    source's taken blocks from 0. Ranks come from counts per range of the permutation and row
    numbers inside a range, so a hot source is never sorted in one task.
    """
    many = F.lit(1) if block_words is None else F.ceil(F.col("size") / F.lit(block_words)).cast("int")
    length = F.col("size") if block_words is None else F.least(F.lit(block_words).cast("long"), F.col("size") - F.col("block") * F.lit(block_words))
    rows = _with_targets(sizes.where("size > 0"), targets).where("target > 0")
    rows = rows.withColumn("whole", F.floor(F.col("target") / F.col("source_size")).cast("int"))
    rows = rows.withColumn("part", F.col("target") - F.col("whole") * F.col("source_size"))
    passes = F.sequence(F.lit(0), F.col("whole") - F.when(F.col("part") > 0, 0).otherwise(1))
    blocks = (
        rows.select(*KEYS, "size", "whole", "part", F.explode(passes).alias("pass"))
        .select("*", F.explode(F.sequence(F.lit(0), many - 1)).alias("block"))
        .withColumn("words", length)
        .withColumn("order", _number(seed, *KEYS, "pass", "block"))
    )
    total = sizes.select(F.sum(F.lit(1) if block_words is None else F.ceil(F.col("size") / F.lit(block_words)))).first()[0] or 0
    buckets = max(16, int(total) // bucket_rows + 1)
    width = (1 << 63) // buckets + 1
    blocks = blocks.withColumn("bucket", F.expr(f"shiftrightunsigned(`order`, 1) div {width}"))
    per_bucket = kept_table(blocks.groupBy("source", "pass", "bucket").agg(F.count("*").alias("blocks"), F.sum("words").alias("words")), "mix-ranges")
    before = Window.partitionBy("source", "pass").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_bucket.select(
        F.col("source").alias("named"),
        F.col("pass").alias("named_pass"),
        F.col("bucket").alias("named_bucket"),
        F.coalesce(F.sum("blocks").over(before), F.lit(0)).alias("blocks_before"),
        F.coalesce(F.sum("words").over(before), F.lit(0)).alias("words_before"),
    )
    inside = Window.partitionBy("source", "pass", "bucket").orderBy("order", "doc_id", "mark", "copy", "block")
    ranked = (
        blocks.withColumn("at", F.row_number().over(inside) - 1)
        .withColumn("words_at", F.sum("words").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words"))
        .join(starts, F.col("source").eqNullSafe(F.col("named")) & (F.col("pass") == F.col("named_pass")) & (F.col("bucket") == F.col("named_bucket")))
        .withColumn("before", F.col("words_at") + F.col("words_before"))
        .where((F.col("pass") < F.col("whole")) | (F.col("before") + F.col("words") / 2 <= F.col("part")))
    )
    passed = per_bucket.groupBy("source", "pass").agg(F.sum("blocks").alias("of_pass"))
    earlier = Window.partitionBy("source").orderBy("pass").rowsBetween(Window.unboundedPreceding, -1)
    passed = passed.select(F.col("source").alias("named"), F.col("pass").alias("named_pass"), F.coalesce(F.sum("of_pass").over(earlier), F.lit(0)).alias("passed"))
    ranked = ranked.drop("named", "named_pass", "named_bucket").join(passed, F.col("source").eqNullSafe(F.col("named")) & (F.col("pass") == F.col("named_pass")))
    return ranked.select(*KEYS, "pass", "block", "words", (F.col("passed") + F.col("blocks_before") + F.col("at")).alias("rank"))


def split_quotas(quotas: np.ndarray, many: int, rng: np.random.Generator) -> np.ndarray:
    """A multivariate-hypergeometric draw of ``many`` blocks from the quotas, source by source.

    The generator's own draw takes up to 10**9 blocks; above that the normal limit of the
    distribution is rounded into its exact range, so every count stays exact.
    """
    out, rest = np.zeros_like(quotas), int(quotas.sum())
    for i, own in enumerate(map(int, quotas)):
        others = rest - own
        low, high = max(0, many - others), min(own, many)
        if low == high:
            taken = low
        elif rest < 10**9:
            taken = int(rng.hypergeometric(own, others, many))
        else:
            share = own / rest
            spread = np.sqrt(max(many * share * (1 - share) * (rest - many) / (rest - 1), 0.0))
            taken = int(np.clip(round(rng.normal(many * share, spread)), low, high))
        out[i], many, rest = taken, many - taken, others
    return out


class SplittingTree:
    """Quotas per source, split among shards; nodes are drawn when they are first needed."""

    def __init__(self, quotas: np.ndarray, shards: int, seed: int) -> None:
        self.quotas, self.shards, self.seed = quotas.astype(np.int64), shards, seed
        self.remembered = max(64, NODE_BYTES // (8 * max(1, len(quotas))))
        self.left: dict[tuple[int, int], np.ndarray] = {}

    def _left(self, first: int, shards: int, quotas: np.ndarray) -> np.ndarray:
        node = (first, shards)
        if node not in self.left:
            if len(self.left) >= self.remembered:
                self.left.clear()
            many = int(quotas.sum()) * (shards // 2) // shards
            self.left[node] = split_quotas(quotas, many, np.random.default_rng([self.seed, first, shards]))
        return self.left[node]

    def shard_of(self, source: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Shard of each (source number, rank)."""
        out = np.zeros(len(rank), np.int64)
        todo = [(0, self.shards, self.quotas, np.arange(len(rank)), rank.astype(np.int64))]
        while todo:
            first, shards, quotas, rows, rest = todo.pop()
            if not len(rows):
                continue
            if shards == 1:
                out[rows] = first
                continue
            left = self._left(first, shards, quotas)
            mine = left[source[rows]]
            low = rest < mine
            todo.append((first, shards // 2, left, rows[low], rest[low]))
            todo.append((first + shards // 2, shards - shards // 2, quotas - left, rows[~low], rest[~low] - mine[~low]))
        return out


class GroupTree:
    """The quotas of one group's sources, split among shards by what the tree of groups gives the group."""

    def __init__(self, groups: SplittingTree, group: int, quotas: np.ndarray) -> None:
        self.groups, self.group, self.quotas = groups, group, quotas.astype(np.int64)

    def shard_of(self, source: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Shard of each (source number in the group, rank); every node is visited once, with all its rows."""
        out, tree = np.zeros(len(rank), np.int64), self.groups
        todo = [(0, tree.shards, tree.quotas, self.quotas, np.arange(len(rank)), rank.astype(np.int64))]
        while todo:
            first, shards, quotas, own, rows, rest = todo.pop()
            if not len(rows):
                continue
            if shards == 1:
                out[rows] = first
                continue
            left = tree._left(first, shards, quotas)
            own_left = split_quotas(own, int(left[self.group]), np.random.default_rng([tree.seed, first, shards, self.group]))
            mine = own_left[source[rows]]
            low = rest < mine
            todo.append((first, shards // 2, left, own_left, rows[low], rest[low]))
            todo.append((first + shards // 2, shards - shards // 2, quotas - left, own - own_left, rows[~low], rest[~low] - mine[~low]))
        return out


def _dealt_at_once(blocks: DataFrame, totals: list, shards: int, seed: int, schema: str) -> DataFrame:
    quotas, numbers = np.array([r.many for r in totals], np.int64), {r.source: i for i, r in enumerate(totals)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = SplittingTree(quotas, shards, seed)
        for batch in batches:
            source = np.array([numbers[s] for s in batch.column("source").to_pylist()], np.int64)
            yield batch.append_column("shard", pa.array(tree.shard_of(source, batch.column("rank").to_numpy())))

    return blocks.mapInArrow(run, schema)


def _dealt_in_groups(blocks: DataFrame, totals: DataFrame, groups: int, shards: int, seed: int, schema: str) -> DataFrame:
    """Blocks next to the totals of their group's sources, in parts of bounded size."""
    of = F.pmod(F.xxhash64(F.lit(seed), "source"), F.lit(groups)).alias("group")
    totals = totals.select("source", "many", of)
    sums = totals.groupBy("group").agg(F.sum("many").alias("many"))
    quotas = np.zeros(groups, np.int64)
    for r in sums.collect():  # at most ``groups`` rows
        quotas[r.group] = r.many
    parts = F.broadcast(sums.select(F.col("group"), F.ceil(F.col("many") / F.lit(GROUP_BLOCKS)).alias("parts")))
    key = F.xxhash64(F.lit(seed), *KEYS, "pass", "block")
    rows = blocks.withColumn("group", of).join(parts, "group").withColumn("part", F.pmod(key, "parts")).drop("parts")
    known = totals.join(parts, "group").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
    names = [*blocks.columns, "shard"]

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("source")  # nulls last
        numbers = {s: i for i, s in enumerate(right["source"].to_pylist())}
        tree = GroupTree(SplittingTree(quotas, shards, seed), key[0].as_py(), right["many"].to_numpy())
        source = np.array([numbers[s] for s in left["source"].to_pylist()], np.int64)
        return left.append_column("shard", pa.array(tree.shard_of(source, left["rank"].to_numpy()))).select(names)

    return rows.groupBy("group", "part").cogroup(known.groupBy("group", "part")).applyInArrow(run, schema)


def deal_to_shards(blocks: DataFrame, shard_blocks: int = 4096, seed: int = 11, tree_sources: int = TREE_SOURCES) -> DataFrame:
    """The blocks with their ``shard`` and their ``place`` in it.

    ``blocks`` is read twice and should be a written table. The driver gets a row per source, or one per
    group if there are more than ``tree_sources``.
    """
    totals = kept_table(blocks.groupBy("source").agg(F.count("*").alias("many")), "mix-totals")
    sums = totals.agg(F.count("*").alias("sources"), F.sum("many").alias("blocks")).first()
    shards = max(1, -(-(sums.blocks or 0) // shard_blocks))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in blocks.schema.fields) + ", shard long"
    if sums.sources <= tree_sources:
        dealt = _dealt_at_once(blocks, totals.orderBy(F.col("source").asc_nulls_last()).collect(), shards, seed, schema)
    else:
        dealt = _dealt_in_groups(blocks, totals, tree_sources, shards, seed, schema)
    local = Window.partitionBy("shard").orderBy(_number(seed + 1, *KEYS, "pass", "block"), *KEYS, "pass", "block")
    return dealt.withColumn("place", F.row_number().over(local) - 1)


def mix(
    docs: DataFrame, block_words: int | None = 128, seed: int = 11, key: str = "doc_id", source: str = "source", text: str = "text", shard_blocks: int = 4096
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sizes, targets, dealt blocks) of the mix; ``block_words`` None makes each text one block."""
    sizes = kept_table(document_sizes(docs, key, source, text), "mix-sizes")
    targets = kept_table(source_targets(sizes), "mix-targets")
    blocks = kept_table(draw_blocks(sizes, targets, block_words, seed), "mix-blocks")
    return sizes, targets, deal_to_shards(blocks, shard_blocks, seed)


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``taken``, one row per input row, and its number of shards."""
    sizes, targets, dealt = mix(docs, **options)
    taken = dealt.groupBy(*KEYS).agg(F.sum("words").alias("taken"), F.count_distinct("shard").alias("shards"))
    same = [sizes[k].eqNullSafe(taken[k]) for k in KEYS]
    on = same[0] & same[1] & same[2] & same[3]
    joined = sizes.join(taken, on, "left").select(*[sizes[c] for c in sizes.columns], "taken", "shards")
    return _with_targets(joined, targets).select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), F.coalesce("shards", F.lit(0)).alias("shards")
    )


def mixed_documents(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", seed: int = 11, shard_blocks: int = 4096) -> DataFrame:
    """The mix in rows ``shard``, ``place`` and ``row``: each text as often as it is taken, whole (texts are blocks).

    Shards stay together, a shard's rows in the order of their places, so that what is written is the
    shuffled mix.
    """
    sizes, _, dealt = mix(docs, None, seed, key, source, text, shard_blocks)
    group = KEYS[:-1]

    def same(one: str, other: str) -> Column:
        doc, source, mark = ((F.col(f"{one}{k}"), F.col(f"{other}{k}")) for k in group)
        return doc[0].eqNullSafe(doc[1]) & source[0].eqNullSafe(source[1]) & (mark[0] == mark[1])

    # A text is taken once or a few times, at most once more than its source is.
    taken = dealt.groupBy(*KEYS).agg(F.collect_list(F.struct("shard", "place")).alias("places"))
    taken = taken.groupBy(*group).agg(F.map_from_entries(F.collect_list(F.struct("copy", "places"))).alias("places"))
    repeated = sizes.where("copy = 2").select(*[F.col(k).alias(f"twice_{k}") for k in group])
    taken = taken.join(repeated, same("", "twice_"), "left").withColumn("several", F.col("twice_mark").isNotNull())
    taken = kept_table(taken.select(*[F.col(k).alias(f"of_{k}") for k in group], "places", "several"), "mix-places")
    rows = packed(docs, doc_id=F.col(f"`{key}`").cast("long"), source=F.col(f"`{source}`"), mark=F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    rows = rows.join(taken, same("", "of_"))
    # Only equal rows need a number each; the texts of all others move once for the join and once to their shard.
    number = F.row_number().over(Window.partitionBy("doc_id", "source", "mark").orderBy("row"))
    numbered = rows.where("several").withColumn("number", number.cast("long"))
    found = rows.where("not several").withColumn("number", F.lit(1).cast("long")).unionByName(numbered).withColumn("own", F.element_at("places", F.col("number")))
    return found.select("row", F.inline("own")).repartition("shard").sortWithinPartitions("shard", "place").select("shard", "place", "row")
