"""Quality rules judged by an isolation forest on rule statistics.

Each text yields counts (words, symbols, repeated lines, repeated word windows, capitals and so
on). Trees split random features at random values; texts that are isolated after few splits are
anomalies. Each tree draws its rows among all labelled rows that pass the base rules, and the
threshold is calibrated on the labels of all of them. All texts are counted and judged, whole.

* null text counts as empty: no words, so the base rules fail it;
* rows that repeat a key are judged each; a key labelled twice takes its worst label;
* without labelled good and bad rows there is no threshold and the base rules alone decide;
* an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import kept_table, words_of
from riskflow.operators.ordered import running_over_values

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks")
BASE_RULES = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"
SYMBOLS = b"#*$%&|<>"
MARKS = b"!?.,;:\"'()[]{}-_/\\"
SPACES = b" \t\n\x0b\x0c\r"


def _flags(chars: bytes) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[list(chars)] = 1
    return table


WORD_START = np.array([(b & 0xC0) != 0x80 and b not in SPACES for b in range(256)], np.int64)
BYTES = {
    "word_chars": WORD_START,
    "n_symbols": _flags(SYMBOLS),
    "n_upper": _flags(bytes(range(65, 91))),
    "n_digits": _flags(bytes(range(48, 58))),
    "n_marks": _flags(MARKS),
}


def _distinct(owner: np.ndarray, code: np.ndarray, size: int, rows: int) -> np.ndarray:
    """Distinct codes per owner."""
    return np.bincount(np.unique(owner * size + code) // size, minlength=rows) if len(owner) else np.zeros(rows, np.int64)


def _owners(lists: pa.ListArray) -> np.ndarray:
    return np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())


def count_texts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of ``COUNTS`` for each text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    rows = len(texts)
    out = {}
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + rows + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    for name, table in BYTES.items():
        total = np.append(0, np.cumsum(table[data]))
        out[name] = total[offsets[1:] - offsets[0]] - total[offsets[:-1] - offsets[0]]

    owner, code, distinct = words_of(texts)
    size = len(distinct) + 1
    out["n_words"] = np.bincount(owner, minlength=rows)
    repeated = np.zeros(len(code), bool)
    if len(code) > 2:
        _, pair = np.unique(code[:-1] * size + code[1:], return_inverse=True)
        _, window = np.unique(pair[:-1] * size + code[2:], return_inverse=True)
        same = owner[:-2] == owner[2:]
        at = np.flatnonzero(same)
        _, which, many = np.unique(owner[at] * len(code) + window[at], return_inverse=True, return_counts=True)
        at = at[many[which] > 1]
        for k in range(3):
            repeated[at + k] = True
    out["n_repeat_words"] = np.bincount(owner, weights=repeated, minlength=rows).astype(np.int64)

    lines = pc.split_pattern(texts, "\n")
    coded = lines.flatten().dictionary_encode()
    owner, code = _owners(lines), coded.indices.to_numpy().astype(np.int64)
    has_word = np.fromiter((bool(line.strip(" \t\n\x0b\x0c\r")) for line in coded.dictionary.to_pylist()), bool, len(coded.dictionary))
    filled = has_word[code] if len(code) else np.zeros(0, bool)
    owner, code = owner[filled], code[filled]
    out["n_lines"] = np.bincount(owner, minlength=rows)
    out["n_dup_lines"] = out["n_lines"] - _distinct(owner, code, len(coded.dictionary) + 1, rows)
    return out


def text_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and the counts of every whole text, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, int(batch.num_rows * (4 << 20) / max(batch.nbytes, 1)))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                found = count_texts(part.column(1))
                yield pa.record_batch([part.column(0), *[pa.array(found[n], pa.int64()) for n in COUNTS]], names=["doc_id", *COUNTS])

    schema = ", ".join(f"{n} long" for n in ("doc_id", *COUNTS))
    return docs.selectExpr(f"cast(`{key}` as long) as doc_id", f"`{text}` as text").mapInArrow(run, schema)


#: Upper limits of the rules; a statistic within its limit counts as 0.
LIMITS = {"word length": 12.0, "symbols per word": 0.1, "repeated lines": 0.5, "repeated words": 0.35, "capitals": 0.3, "digits": 0.2, "marks": 0.2}
SHORTEST_MEAN_WORD = 2.5


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """By how much each rule is exceeded; ratios that don't grow with a text's length."""
    c = {n: np.asarray(counts[n], float) for n in COUNTS}
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    mean = c["word_chars"] / words
    ratios = [mean, c["n_symbols"] / words, c["n_dup_lines"] / np.maximum(c["n_lines"], 1), c["n_repeat_words"] / words, c["n_upper"] / chars, c["n_digits"] / chars, c["n_marks"] / chars]
    over = [np.maximum(r - limit, 0) for r, limit in zip(ratios, LIMITS.values())]
    return np.column_stack([*over, np.maximum(SHORTEST_MEAN_WORD - mean, 0)])


def _usual_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, float)
    safe = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe, np.where(n == 2, 1.0, 0.0))


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees in flat arrays; a leaf has feature -1 and its path length as value."""

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    right: np.ndarray
    roots: np.ndarray
    usual: float
    threshold: float | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / usual path): near 1 for anomalies."""
        total = np.zeros(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            while (open_ := self.feature[at] >= 0).any():
                rows, node = np.flatnonzero(open_), at[open_]
                at[rows] = np.where(x[rows, self.feature[node]] < self.value[node], self.left[node], self.right[node])
            total += self.value[at]
        return 2.0 ** (-total / max(len(self.roots), 1) / self.usual)


def grow_forest(x: np.ndarray, trees: int = 100, rows: int = 256, seed: int = 17) -> Forest:
    rng = np.random.default_rng(seed)
    rows = min(rows, len(x))
    limit = int(np.ceil(np.log2(max(rows, 2))))
    nodes: list[list[float]] = []

    def grow(part: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([-1, depth + float(_usual_path(len(part))), -1, -1])
        spread = part.max(axis=0) - part.min(axis=0) if len(part) else np.zeros(x.shape[1])
        if depth < limit and len(part) > 1 and (spread > 0).any():
            f = int(rng.choice(np.flatnonzero(spread > 0)))
            cut = float(rng.uniform(part[:, f].min(), part[:, f].max()))
            low = part[:, f] < cut
            if low.any() and not low.all():
                left, right = grow(part[low], depth + 1), grow(part[~low], depth + 1)
                nodes[me] = [f, cut, left, right]
        return me

    roots = [grow(x[rng.choice(len(x), rows, replace=False)], 0) for _ in range(trees)]
    table = np.array(nodes)
    return Forest(table[:, 0].astype(int), table[:, 1], table[:, 2].astype(int), table[:, 3].astype(int), np.array(roots), max(float(_usual_path(rows)), 1.0))


def calibrate(good: np.ndarray, bad: np.ndarray, keep: float = 0.995) -> float:
    """The threshold that catches most bad rows among those that keep ``keep`` of the good ones.

    Scores above it are dropped. It lies halfway between the last score kept and the next one.
    """
    cuts = np.unique(np.concatenate([good, bad]))
    kept = np.searchsorted(np.sort(good), cuts, side="right") / len(good)
    caught = 1 - np.searchsorted(np.sort(bad), cuts, side="right") / len(bad)
    gain = np.where(kept >= keep, caught + kept, -1.0)
    last = len(cuts) - 1 - int(np.argmax(gain[::-1]))
    return float(cuts[last : last + 2].mean())


def _with_score(rows: DataFrame, forest: Forest, name: str) -> DataFrame:
    """``rows`` with the forest's score of their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = forest.scores(features({n: batch.column(n).to_numpy() for n in COUNTS}))
            yield batch.append_column(name, pa.array(scores))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{schema}, {name} double")


def calibrate_rows(scored: DataFrame, keep: float = 0.995) -> float:
    """``calibrate`` over a table of any size: ``value`` is a row's score, ``good`` whether its label is."""
    points = scored.groupBy("value").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    curve = kept_table(running_over_values(points, {"good": "good_upto", "bad": "bad_upto"}), "quality-curve")
    good, bad = curve.agg(F.max("good_upto"), F.max("bad_upto")).first()
    kept = F.col("good_upto") / F.lit(good)
    gain = (F.lit(1.0) - F.col("bad_upto") / F.lit(bad)) + kept
    last = curve.where(kept >= keep).orderBy(gain.desc(), F.desc("value")).first()["value"]
    following = curve.where(F.col("value") > last).agg(F.min("value")).first()[0]
    return last if following is None else (last + following) / 2


def fit_forest(counts: DataFrame, labels: DataFrame, trees: int = 100, rows: int = 256, seed: int = 17) -> Forest | None:
    """Forest and threshold from all labelled rows that pass the base rules.

    ``labels`` holds ``doc_id`` and ``quality`` (1 good, 0 bad). By the method each tree sees ``rows`` rows only: they
    are drawn among all labelled rows by hash, so reruns agree. The threshold is exact on all of
    them, whatever their number. None if one kind is missing.
    """
    labelled = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    joined = kept_table(counts.where(f"not ({BASE_RULES})").join(labelled, "doc_id").select("doc_id", "quality", *COUNTS), "quality-labelled")
    found = {r.quality: r.many for r in joined.groupBy("quality").agg(F.count("*").alias("many")).collect()}
    if not (found.get(0) and found.get(1)):
        return None
    draw = F.xxhash64("doc_id", F.lit("quality draw"))
    drawn = joined.orderBy(draw, *COUNTS).limit(trees * rows).orderBy("doc_id", *COUNTS).toArrow()
    forest = grow_forest(features({n: drawn[n].to_numpy() for n in COUNTS}), trees, rows, seed)
    scored = _with_score(joined, forest, "value").select("value", (F.col("quality") == 1).alias("good"))
    return replace(forest, threshold=calibrate_rows(scored))


def judge(counts: DataFrame, forest: Forest | None) -> DataFrame:
    """The counts with ``base_failed``, ``anomaly`` (the forest's score) and ``kept``."""
    base = counts.withColumn("base_failed", F.expr(BASE_RULES))
    if forest is None:
        return base.withColumn("anomaly", F.lit(None).cast("double")).withColumn("kept", ~F.col("base_failed"))

    return _with_score(base, forest, "anomaly").withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") <= forest.threshold))
