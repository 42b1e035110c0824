"""Conversation repair by dynamic programming over grammar-compressed role and fault sequences.

Every turn becomes one of twelve symbols: the initial of its role (system, user, assistant, other) and
whether it is sound, truncated, or has to go. The cheapest edits that make the initials match
``(s?(ua)+)?`` are a shortest path through four states; ties go to the audit that is least in ASCII.

*Grammar.* Frequent neighbours become rules, as in Re-Pair, over the sequences of all conversations:
pairs are counted in tasks and added up, and each round takes the most frequent pairs that share no
symbol. *Matrices.* A rule has one min-plus matrix of 4 x 4 entries, made from those of its two sides:
costs, and audits as ropes, which share their parts and are compared without being written out. The rules
(a bounded number) are evaluated bottom-up once and serve all conversations; a sequence is the
product of the matrices of its symbols after compression. The grammar saves work and never changes a result.

Edits: Keep costs 0, Rerole to user or assistant 1, Delete 2 (a must for blank and repeated turns), Insert an
empty user or assistant turn 5; a truncated turn that stays adds 5. With equal costs no audit of the same
turns is the beginning of another, so the least audit of a whole is made of least audits of its parts.

*Long conversations.* Turns are cut into ranges of equal size in the order of conversation and turn; a conversation
may span many. Each range passes on 16 costs, the order of its 16 audits and a few counts; from
these the path through the ranges follows, and each range then writes its own audit. Only the digest of
a whole conversation reads its turns one after the other, in a stream that holds one batch.

* null role or text: one space, so such a turn is blank or has an unknown role; null turns come first; null
  conversation ids are one conversation; other initials can't be kept;
* turns of one number are ordered by role and text; equal turns after the first are duplicates;
* a conversation whose turns all go: empty audit of deletions only, and no repaired turns;
* an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import WHITE, kept_table, slices

# --- Fixed values of the edit model ------------------------------------------
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
LEGAL = ("su", "ua", "au")
# ------------------------------------------------------------------------------
CLASSES = "sua"  # fourth: any other initial
SYMBOLS = "suaoSUAO1234"  # sound, truncated, to be deleted
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: What closes a conversation that ends in a state.
CLOSING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
SHORT = 64  # characters that a rope holds as plain text

Rope = str | tuple[int, "Rope", "Rope"]
Entry = tuple[int, Rope] | None
Matrix = list[Entry]  # 16 entries, by start state and end state


def _length(rope: Rope) -> int:
    return len(rope) if isinstance(rope, str) else rope[0]


def _concat(a: Rope, b: Rope) -> Rope:
    many = _length(a) + _length(b)
    if many <= SHORT:
        return a + b  # both are plain then
    return (many, a, b) if a and b else a or b


def _text(rope: Rope) -> str:
    out, todo = [], [rope]
    while todo:
        node = todo.pop()
        if isinstance(node, str):
            out.append(node)
        else:
            todo += [node[2], node[1]]
    return "".join(out)


def _less(x: tuple[Rope, ...], y: tuple[Rope, ...]) -> bool:
    """Whether the text of the ropes ``x`` comes before that of ``y``; parts shared by both are skipped."""
    a, b = list(reversed(x)), list(reversed(y))
    while a and b:
        p, q = a.pop(), b.pop()
        if p is q:
            continue
        if not isinstance(p, str) and (isinstance(q, str) or p[0] >= q[0]):
            a += [p[2], p[1]]
            b.append(q)
        elif not isinstance(q, str):
            b += [q[2], q[1]]
            a.append(p)
        else:
            n = min(len(p), len(q))
            if p[:n] != q[:n]:
                return p[:n] < q[:n]
            if len(p) > n:
                a.append(p[n:])
            if len(q) > n:
                b.append(q[n:])
    return bool(b)


def _times(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product; of equal costs the least audit."""
    out: Matrix = [None] * 16
    for p in range(4):
        for q in range(4):
            best, parts = None, None
            for r in range(4):
                left, right = a[4 * p + r], b[4 * r + q]
                if left is None or right is None:
                    continue
                cost, both = left[0] + right[0], (left[1], right[1])
                if best is None or cost < best or (cost == best and _less(both, parts)):
                    best, parts = cost, both
            if best is not None:
                out[4 * p + q] = (best, _concat(*parts))
    return out


def _inserts() -> Matrix:
    """No, one or two inserted turns; more come back to a state reached for less."""
    out: Matrix = [None] * 16
    for p in range(4):
        state, many = p, 0
        while out[4 * p + state] is None:
            out[4 * p + state] = (many * INSERT, "I" * many)
            state, many = NEXT[state], many + 1
    return out


def _turn(symbol: int) -> Matrix:
    """The edits of one turn, after any inserts."""
    out: Matrix = [None] * 16
    status, kind = divmod(symbol, 4)
    for p in range(4):
        out[5 * p] = (DELETE, "D")
        if status == 2:
            continue
        extra = TRUNCATED * status
        out[4 * p + NEXT[p]] = (REROLE + extra, "R")
        if (kind == 0 and p == START) or (kind < 3 and kind + 1 == NEXT[p]):
            out[4 * p + kind + 1] = (extra, "K")
    return _times(_inserts(), out)


class Grammar:
    """Rules over the symbols, and the matrix of every symbol and rule."""

    def __init__(self, rules: list[tuple[int, int]]) -> None:
        self.rules = rules
        self.matrices = [_turn(s) for s in range(len(SYMBOLS))]
        for left, right in rules:
            self.matrices.append(_times(self.matrices[left], self.matrices[right]))
        self.known: dict[str, Matrix] = {}
        self.held = 0

    def compress(self, symbols: np.ndarray) -> np.ndarray:
        """``symbols`` after all rules, in their order; -1 separates sequences."""
        for number, (left, right) in enumerate(self.rules, len(SYMBOLS)):
            at = np.flatnonzero((symbols[:-1] == left) & (symbols[1:] == right))
            if left == right:
                at = _alternate(at)
            if len(at):
                symbols = symbols.copy()
                symbols[at] = number
                symbols = np.delete(symbols, at + 1)
        return symbols

    def evaluate(self, sequences: list[str], remembered: int = 1 << 22) -> list[Matrix]:
        """The matrix of each sequence; equal sequences are evaluated once as long as they are remembered."""
        new = [s for s in dict.fromkeys(sequences) if s not in self.known]
        size = sum(map(len, new)) + 200 * len(new)
        if self.held + size > remembered:
            self.known, self.held = {}, 0
            new = list(dict.fromkeys(sequences))
        if new:
            flat = self.compress(numbers(new))
            for sequence, part in zip(new, np.split(flat, np.flatnonzero(flat < 0))[:-1]):
                matrix = None
                for symbol in part[part >= 0].tolist():
                    matrix = self.matrices[symbol] if matrix is None else _times(matrix, self.matrices[symbol])
                self.known[sequence] = matrix
            self.held += size
        return [self.known[s] for s in sequences]


_grammars: dict[tuple, Grammar] = {}


def _grammar(rules: list[tuple[int, int]]) -> Grammar:
    """One per worker; the last one is kept."""
    name = tuple(rules)
    if name not in _grammars:
        _grammars.clear()
        _grammars[name] = Grammar(rules)
    return _grammars[name]


def _alternate(at: np.ndarray) -> np.ndarray:
    """Every second of positions that follow one another."""
    new = np.append(True, np.diff(at) != 1)[: len(at)]
    start = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
    return at[(np.arange(len(at)) - start) % 2 == 0]


def numbers(sequences: list[str]) -> np.ndarray:
    """Symbol numbers of the sequences, each followed by -1."""
    table = np.full(128, -1, np.int64)
    table[[ord(c) for c in SYMBOLS]] = range(len(SYMBOLS))
    return table[np.frombuffer("".join(s + "\n" for s in sequences).encode("ascii"), np.uint8)]


def learn_rules(sequences: DataFrame, rounds: int = 10, per_round: int = 16, least: int = 2) -> list[tuple[int, int]]:
    """Rules for the most frequent neighbours in the column ``symbols``.

    A round takes up to ``per_round`` pairs of which no two share a symbol, so their replacements don't interfere. The
    driver gets a bounded number of counted pairs per round.
    """
    rules: list[tuple[int, int]] = []
    for _ in range(rounds):
        known = list(rules)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grammar = _grammar(known)
            base = len(SYMBOLS) + len(known)
            held = np.zeros(base * base, np.int64)
            for part in slices(batches, 1 << 20):
                flat = grammar.compress(numbers(part.column(0).to_pylist()))
                same = flat[:-1] == flat[1:]
                at = np.flatnonzero((flat[:-1] >= 0) & (flat[1:] >= 0) & ~same)
                at = np.append(at, _alternate(np.flatnonzero((flat[:-1] >= 0) & same)))
                held += np.bincount(flat[at] * base + flat[at + 1], minlength=base * base)
            used = np.flatnonzero(held)
            yield pa.record_batch([pa.array(used // base), pa.array(used % base), pa.array(held[used])], names=["a", "b", "many"])

        counted = sequences.select("symbols").mapInArrow(count, "a long, b long, many long").groupBy("a", "b").agg(F.sum("many").alias("many"))
        found = counted.where(F.col("many") >= least).orderBy(F.desc("many"), "a", "b").limit(8 * per_round).collect()
        taken: set[int] = set()
        for row in found:
            if len(rules) - len(known) < per_round and not taken & {row.a, row.b}:
                rules.append((row.a, row.b))
                taken |= {row.a, row.b}
        if len(rules) == len(known):
            break
    return rules


@dataclass(frozen=True)
class Repair:
    report: DataFrame  # one row per conversation
    turns: DataFrame  # the repaired turns in order of ``place``


def damage(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` with faults that a checksum of (conv_id, turn) chooses."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fault = F.pmod(F.crc32(name.cast("binary")), F.lit(20))
    text = F.coalesce("text", F.lit(" "))
    text = F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(fault == 4, "user").otherwise(F.coalesce("role", F.lit(" ")))
    copies = F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return turns.where(fault != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def conversation_key(conv: Column) -> Column:
    """A text that names a conversation; null ids have one of their own."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit("-"))


PLACE = ("conv", "numbered", "turn", "role", "mark")


def _described(turns: DataFrame) -> DataFrame:
    """What the repair needs to know of a turn; ``mark`` names role and text."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rest = F.rtrim(text, F.lit(WHITE))
    mark = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    kind = F.position(F.substring(role, 1, 1), F.lit(CLASSES))  # 0: any other
    return turns.select(
        conversation_key(F.col("conv_id")).alias("conv"),
        F.col("turn").isNotNull().cast("int").alias("numbered"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        role.alias("role"),
        text.alias("text"),
        mark.alias("mark"),
        F.when((kind == 0) | (F.length(role) == 0), 4).otherwise(kind).alias("kind"),
        (rest == "").alias("blank"),
        (~F.substring(rest, -1, 1).isin(".", "!", "?")).alias("cut"),
    )


def _ordered(rows: DataFrame, parts: int | None) -> DataFrame:
    """The turns without their texts, cut into ranges; ``at`` numbers them in order, starting anew in each range.

    Ranges are cut by count, also within a conversation or among equal turns. Written, so that
    every reader sees the same cuts and numbers.
    """
    order = [*PLACE, "own"]
    narrow = rows.drop("text").withColumn("own", F.monotonically_increasing_id())
    ranged = narrow.repartitionByRange(parts, *order) if parts else narrow.repartitionByRange(*order)
    # The number that Spark gives holds the range in its upper bits and counts in the lower ones.
    return kept_table(ranged.sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id()).drop("own"), "turns")


def _with_faults(rows: DataFrame) -> DataFrame:
    """``fault`` (blank, duplicate, truncated or null) and ``symbol`` of each turn."""
    first = rows.groupBy("conv", "mark").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated")
    status = F.when(fault.isin("blank", "duplicate"), 2).when(fault == "truncated", 1).otherwise(0)
    symbol = F.substring(F.lit(SYMBOLS), (status * 4 + F.col("kind")).cast("int"), F.lit(1))
    return rows.join(first, "at", "left").select(*PLACE, "at", "part", fault.alias("fault"), symbol.alias("symbol"))


SUMMARY = "conv string, part int, costs array<long>, orders array<int>, outs array<int>, illegal long, first string, last string"


def _summaries(sequences: DataFrame, rules: list[tuple[int, int]]) -> DataFrame:
    """Per range of a conversation: costs, the order of the audits of one start state, and turns written."""
    kinds = str.maketrans(SYMBOLS, "suao" * 3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = _grammar(rules)
        shown: dict[int, tuple] = {}
        for part in slices(batches, 1 << 20):
            symbols = part.column("symbols").to_pylist()
            found, shown = [], {}
            for matrix in grammar.evaluate(symbols):
                if id(matrix) not in shown:
                    shown[id(matrix)] = _summary(matrix)
                found.append(shown[id(matrix)])
            plain = [s.translate(kinds) for s in symbols]
            illegal = [len(s) - 1 - sum(s[i : i + 2] in LEGAL for i in range(len(s) - 1)) for s in plain]
            columns = [pa.array([f[0] for f in found], pa.list_(pa.int64())), *[pa.array([f[i] for f in found], pa.list_(pa.int32())) for i in (1, 2)]]
            ends = [pa.array([s[0] for s in plain], pa.string()), pa.array([s[-1] for s in plain], pa.string())]
            yield pa.record_batch([part.column("conv"), part.column("part"), *columns, pa.array(illegal, pa.int64()), *ends], names=[c.split()[0] for c in SUMMARY.split(", ")])

    return sequences.select("conv", "part", "symbols").mapInArrow(run, SUMMARY)


def _summary(matrix: Matrix) -> tuple[list[int | None], list[int | None], list[int | None]]:
    texts = [None if e is None else _text(e[1]) for e in matrix]
    orders: list[int | None] = [None] * 16
    for p in range(4):
        own = sorted((texts[4 * p + q], q) for q in range(4) if texts[4 * p + q] is not None)
        for place, (_, q) in enumerate(own):
            orders[4 * p + q] = place
    return [None if e is None else e[0] for e in matrix], orders, [None if t is None else len(t) - t.count("D") for t in texts]


PATH = "conv string, part int, entry int, place long, closing int, cost long, illegal long"


def _path(held: list[tuple]) -> Iterator[tuple]:
    """The cheapest way through the ranges of one conversation, and of the cheapest the least audit."""
    togo = [[INSERT * CLOSING[q] for q in range(4)]]
    for _, costs, *_ in reversed(held):
        after = togo[-1]
        togo.append([min((costs[4 * p + q] + after[q] for q in range(4) if costs[4 * p + q] is not None), default=1 << 60) for p in range(4)])
    togo.reverse()
    state, place, total, before = START, 0, togo[0][START], ""
    for k, (part, costs, orders, outs, illegal, first, last) in enumerate(held):
        ways = [q for q in range(4) if costs[4 * state + q] is not None and costs[4 * state + q] + togo[k + 1][q] == togo[k][state]]
        q = min(ways, key=lambda q: orders[4 * state + q])
        illegal += bool(before) and before + first not in LEGAL
        closing = CLOSING[q] if k == len(held) - 1 else 0
        yield part, 4 * state + q, place, closing, total if k == 0 else 0, illegal
        place, state, before = place + outs[4 * state + q], q, last


def _paths(summaries: DataFrame) -> DataFrame:
    """Conversations one after the other; a task holds the summaries of one (a row per range)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, out = None, [], []

        def flush() -> None:
            out.extend((at, *row) for row in _path(held))

        for part in slices(batches, 1 << 20):
            for conv, *row in zip(*[c.to_pylist() for c in part.columns]):
                if conv != at:
                    if held:
                        flush()
                    at, held = conv, []
                held.append(row)
            if out:
                yield _table(out, PATH)
                out.clear()
        if held:
            flush()
            yield _table(out, PATH)

    dealt = summaries.repartition("conv").sortWithinPartitions("conv", "part")
    return dealt.mapInArrow(run, PATH)


_ARROW = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [column.split() for column in schema.split(", ")]
    return pa.record_batch([pa.array(values, _ARROW[kind]) for values, (_, kind) in zip(zip(*rows), fields)], names=[name for name, _ in fields])


LINES = "array<struct<place:bigint,role:string,text:string,edit:string>>"
EDITS = "conv string, part int, at long, audit string, state int, place long"


def _edits(chosen: DataFrame, rules: list[tuple[int, int]]) -> DataFrame:
    """One row per turn: the inserts before it and its own edit, the state and the place before that.

    Inserts that close a conversation are a row without a turn (``at`` null).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = _grammar(rules)
        for part in slices(batches, 1 << 17):
            out: list[tuple] = []
            columns = [part.column(c).to_pylist() for c in ("conv", "part", "first", "symbols", "entry", "place", "closing")]
            for (conv, number, first, symbols, entry, place, closing), matrix in zip(zip(*columns), grammar.evaluate(columns[3])):
                state, audit, turn = entry // 4, "", 0
                for char in _text(matrix[entry][1]):
                    audit += char
                    if char == "I":
                        continue
                    out.append((conv, number, first + turn, audit, state, place))
                    for _ in range(len(audit) - (char != "R")):
                        state = NEXT[state]
                    if char == "K":
                        state = SYMBOLS.index(symbols[turn]) % 4 + 1
                    place, turn, audit = place + len(audit) - (char == "D"), turn + 1, ""
                if closing:
                    out.append((conv, number, None, "I" * closing, state, place))
            yield _table(out, EDITS)

    return chosen.mapInArrow(run, EDITS)


def _audits(chosen: DataFrame, rules: list[tuple[int, int]]) -> DataFrame:
    """The audit of each conversation; only the strings of its ranges meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = _grammar(rules)
        for part in slices(batches, 1 << 17):
            columns = [part.column(c).to_pylist() for c in ("conv", "part", "symbols", "entry", "closing")]
            audits = [_text(m[e][1]) + "I" * c for m, e, c in zip(grammar.evaluate(columns[2]), *columns[3:])]
            yield _table(list(zip(*columns[:2], audits)), "conv string, part int, audit string")

    found = chosen.mapInArrow(run, "conv string, part int, audit string")
    listed = found.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("part", "audit"))).alias("parts"))
    return listed.select("conv", F.array_join(F.transform("parts", lambda x: x["audit"]), "").alias("audit"))


def _lines(edits: DataFrame, turns: DataFrame, rows: DataFrame) -> DataFrame:
    """The repaired turns: ``conv``, ``place``, ``role``, ``text``, ``edit``."""
    edits = edits.withColumn("own", F.substring("audit", -1, 1))
    stays = F.col("own").isin("K", "R")
    # Turns that stay differ in role and text, so nobody is asked for one text by many.
    texts = rows.select(*PLACE, "text").dropDuplicates(list(PLACE))
    placed = edits.where(stays).drop("conv").join(turns.select("at", *PLACE), "at").join(texts, list(PLACE))
    columns = ("conv", "audit", "state", "place", "own", "role", "text")
    lost = edits.where(~stays & F.contains("audit", F.lit("I")))
    every = placed.select(*columns).unionByName(lost.select("conv", "audit", "state", "place", "own"), allowMissingColumns=True)
    inserts = F.length("audit") - F.col("own").isin("K", "R", "D").cast("int")

    def needed(i: Column) -> Column:
        """The role that the grammar asks for after ``i`` inserts."""
        return F.when((F.col("state") == USER).cast("int") + i % 2 == 1, "assistant").otherwise("user")

    def line(i: Column, role: Column, text: Column, edit: Column) -> Column:
        return F.struct((F.col("place") + i).alias("place"), role.alias("role"), text.alias("text"), edit.alias("edit"))

    added = F.when(inserts > 0, F.transform(F.sequence(F.lit(0), inserts - 1), lambda i: line(i, needed(i), F.lit(""), F.lit("I"))))
    role = F.when(F.col("own") == "K", F.col("role")).otherwise(needed(inserts))
    kept = F.when(F.col("own").isin("K", "R"), F.array(line(inserts, role, F.col("text"), F.col("own"))))
    empty = F.array().cast(LINES)
    return every.select("conv", F.inline(F.concat(F.coalesce(added.cast(LINES), empty), F.coalesce(kept.cast(LINES), empty))))


def _digests(lines: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines; a task reads them as a stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest, out = None, None, []
        for part in slices(batches, 1 << 20):
            for conv, role, text in zip(*[part.column(c).to_pylist() for c in ("conv", "role", "text")]):
                line = f"{role}:{text}".encode()
                if conv == at:
                    digest.update(b"\n" + line)
                    continue
                if digest:
                    out.append((at, digest.hexdigest()))
                at, digest = conv, hashlib.sha256(line)
            if out:
                yield _table(out, "conv string, repaired_sha256 string")
                out = []
        if digest:
            yield _table([(at, digest.hexdigest())], "conv string, repaired_sha256 string")

    dealt = lines.repartition("conv").sortWithinPartitions("conv", "place")
    return dealt.select("conv", "role", "text").mapInArrow(run, "conv string, repaired_sha256 string")


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair(turns: DataFrame, parts: int | None = None) -> Repair:
    """Repair conversations given as ``conv_id``, ``turn``, ``role``, ``text``.

    ``report`` names conversations by ``conv`` (see ``conversation_key``) and has ``COUNTS``, ``audit`` and
    ``repaired_sha256``; ``turns`` has the repaired turns as ``conv``, ``place``, ``role``, ``text``, ``edit``.
    Without ``parts`` Spark chooses the number of ranges; it changes no result.
    """
    rows = _described(turns)
    faulty = kept_table(_with_faults(_ordered(rows, parts)), "faults")
    listed = F.array_sort(F.collect_list(F.struct("at", "symbol")))
    symbols = F.array_join(F.transform(listed, lambda x: x["symbol"]), "")
    sequences = kept_table(faulty.groupBy("conv", "part").agg(F.min("at").alias("first"), symbols.alias("symbols")), "sequences")
    rules = learn_rules(sequences)
    paths = _paths(_summaries(sequences, rules))
    chosen = kept_table(sequences.join(paths, ["conv", "part"]), "paths")
    lines = _lines(_edits(chosen, rules), faulty, rows)

    numbered = faulty.where("numbered = 1").groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    faults = faulty.groupBy("conv").agg(*[F.count_if(F.col("fault") == name).alias(name) for name in ("blank", "duplicate", "truncated")])
    costs = chosen.groupBy("conv").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"))
    report = faults.join(costs, "conv").join(_audits(chosen, rules), "conv").join(numbered, "conv", "left").join(_digests(lines), "conv", "left")
    return Repair(report_columns(report), lines)


def report_columns(report: DataFrame) -> DataFrame:
    """The report with zeros and empty values where a conversation has nothing to tell."""
    nothing = hashlib.sha256(b"").hexdigest()
    counts = [F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in COUNTS]
    others = [c for c in report.columns if c not in (*COUNTS, "audit", "repaired_sha256")]
    return report.select(*others, *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))


def repair_damaged(conversations: DataFrame, parts: int | None = None) -> DataFrame:
    """The report on damaged conversations, one row per original ``conv_id``."""
    conversations = conversations.select("conv_id", "turn", "role", "text")
    report = repair(damage(conversations), parts).report
    ids = conversations.select("conv_id").distinct().withColumn("conv", conversation_key(F.col("conv_id")))
    return report_columns(ids.join(report, "conv", "left").drop("conv"))
