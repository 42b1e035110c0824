"""Surrogates and the isolation forest against plain versions of their own."""

import hashlib
import hmac
import math

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from riskflow.llm import pii, quality_forest
from riskflow.llm.catalog import SURROGATE_KEY
from riskflow.llm.common import table

FOLDER = "/root/testdata/sf0.001"


class Drawn:
    """Numbers of an entity's keyed stream, counted from 1."""

    def __init__(self, kind, norm, attempt=0):
        told = [f"{kind}|{norm}|{attempt}|{i}".encode() for i in range(4)]
        self.stream = "".join(hmac.new(SURROGATE_KEY.encode(), t, hashlib.sha512).hexdigest() for t in told)

    def __getitem__(self, i):
        at = 3 * (i % 170)
        return int(self.stream[at : at + 3], 16)


def plain_surrogate(kind, norm):
    drawn = Drawn(kind, norm)
    digits = lambda start: "".join(str(drawn[i] % 10) for i in range(start, len(norm) + 1))
    if kind == "phone":
        return str(2 + drawn[1] % 8) + digits(2)
    if kind == "ssn":
        return str(1 + drawn[1] % 5) + digits(2)
    if kind == "ip":
        return ".".join(str(1 + drawn[i] % 254) for i in range(1, 5))
    if kind == "card":
        body = norm[0] + digits(2)[:-1]
        total = 0
        for place, digit in enumerate(reversed(body)):
            value = int(digit) * (2 if place % 2 == 0 else 1)
            total += value - 9 if value > 9 else value
        return body + str(-total % 10)
    last = len(norm) - len(norm.rsplit(".", 1)[-1]) - 1
    out = []
    for i, char in enumerate(norm[:last], 1):
        if char in "0123456789":
            out.append("0123456789"[drawn[i] % 10])
        elif char.isalpha():
            out.append("abcdefghijklmnopqrstuvwxyz"[drawn[i] % 26])
        else:
            out.append(char)
    return "".join(out) + norm[last:]


def test_surrogates_equal_a_plain_version(spark):
    """First draws of numbers and addresses, wherever no two entities share one."""
    entities = [(kind, norm) for kind, norms in {
        "phone": ["5235551055", "4420794600", "23456"], "ssn": ["123456789", "987654321"], "ip": ["10.0.0.1", "192.168.1.77"],
        "card": ["4111111111111111", "378282246310005"], "mail": ["ann.b_7@mail.example.org", "x@y.de"]}.items() for norm in norms]
    found = {(r.kind, r.norm): r.surrogate for r in pii.surrogates(spark.createDataFrame(entities, "kind string, norm string"), SURROGATE_KEY).collect()}
    assert found == {e: plain_surrogate(*e) for e in entities}
    other = {(r.kind, r.norm): r.surrogate for r in pii.surrogates(spark.createDataFrame(entities, "kind string, norm string"), "another").collect()}
    assert sum(found[e] == other[e] for e in entities) <= 1


def compiled(pattern):
    """Java's digits and word characters are ASCII."""
    for java, plain in (("[\\d", "[0-9"), ("\\d", "[0-9]"), ("[\\w", "[A-Za-z0-9_")):
        pattern = pattern.replace(java, plain)
    return regex.compile(pattern)


def test_whole_table_is_replaced_as_a_plain_scan_says(spark):
    """What lies between entities stays; equal entities read the same in all documents, different ones differ."""
    documents = table(spark, FOLDER, "documents").select("doc_id", "text")
    pattern = compiled(pii.PATTERN)
    forms = {kind: compiled(p) for kind, p in {"mail": pii.WORDS["mail"], **pii.NUMBERS}.items()}
    told, back, seen = {}, {}, 0
    for r in pii.replace_entities(documents, SURROGATE_KEY).collect():
        text = r.row.text
        mentions = [m.group() for m in pattern.finditer(text or "")]
        if not mentions:
            assert r.safe == text and r.n_entities == 0
            continue
        assert r.n_entities >= len(mentions)
        pieces = pattern.split(text)
        if any(regex.match(pii.WORDS["person"], m) for m in mentions):
            continue  # names elsewhere in the text change its pieces
        at = 0
        for piece, mention in zip(pieces, [*mentions, None]):
            assert r.safe.startswith(piece, at)
            at += len(piece)
            if mention is None:
                assert at == len(r.safe)
                break
            kind = next((k for k, f in forms.items() if f.fullmatch(mention)), "secret")
            if kind == "secret":
                label = regex.match(pii._LABEL, mention)
                head = label.group() if label else ""
                assert r.safe.startswith(head, at)
            stop = at + len(mention)
            value = r.safe[at:stop]
            if kind == "ip":  # may be shorter or longer
                value = forms["ip"].match(r.safe, at).group()
                stop = at + len(value)
            assert value != mention
            if kind in ("phone", "card", "ssn"):
                assert regex.sub("[0-9]", "0", value) == regex.sub("[0-9]", "0", mention)
                norm = regex.sub("[^0-9]", "", mention)
                key = (kind, norm[-10:] if kind == "phone" else norm)
                value = regex.sub("[^0-9]", "", value)[-len(key[1]):]
            else:
                key = (kind, mention.lower() if kind == "mail" else mention)
                value = value.lower() if kind == "mail" else value
            assert told.setdefault(key, value) == value
            assert back.setdefault((kind, value), key) == key
            seen += 1
            at = stop
    assert seen > 20


def plain_path(forest, root, row):
    node, steps = root, 0
    while forest.feature[node] >= 0:
        node = forest.left[node] if row[forest.feature[node]] < forest.value[node] else forest.right[node]
        steps += 1
    return steps, forest.value[node]


def test_forest_scores_equal_plain_paths():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((500, 4))
    x[0] = 9  # far from all others
    forest = quality_forest.grow_forest(x, trees=20, rows=64)
    harmonic = 2 * (math.log(63) + np.euler_gamma) - 2 * 63 / 64
    scores = forest.scores(x)
    for i in range(0, 500, 7):
        total = 0.0
        for root in forest.roots:
            steps, value = plain_path(forest, root, x[i])
            assert steps <= 6 and value >= steps
            total += value
        assert math.isclose(scores[i], 2 ** (-total / 20 / harmonic), rel_tol=1e-12)
    assert scores.argmax() == 0
    same = quality_forest.grow_forest(np.ones((30, 3)))
    assert len(set(same.scores(np.ones((5, 3))))) == 1


def test_threshold_is_the_best_of_all():
    rng = np.random.default_rng(5)
    good, bad = rng.normal(0.4, 0.05, 300).round(3), rng.normal(0.5, 0.05, 200).round(3)
    cut = quality_forest.calibrate(good, bad, keep=0.98)
    assert (good <= cut).mean() >= 0.98

    def gain(at):
        return ((bad > at).mean() + (good <= at).mean()) if (good <= at).mean() >= 0.98 else -1

    assert math.isclose(gain(cut), max(gain(at) for at in np.unique(np.concatenate([good, bad]))), abs_tol=1e-12)


def test_judged_rows_equal_plain_scores(spark):
    """Rows labelled twice count once, as the worse; extra columns don't matter."""
    counts = quality_forest.text_counts(table(spark, FOLDER, "documents").withColumn("anomaly", F.lit(1))).cache()
    labels = table(spark, FOLDER, "labels")
    forest = quality_forest.fit_forest(counts, labels)
    twice = labels.unionByName(labels.where("quality = 0").withColumn("quality", F.lit(1).cast(labels.schema["quality"].dataType)))
    again = quality_forest.fit_forest(counts, twice.withColumn("kept", F.lit("x")))
    assert again.threshold == forest.threshold and (again.value == forest.value).all()
    rows = quality_forest.judge(counts, forest).toArrow()
    x = quality_forest.features({n: rows[n].to_numpy() for n in quality_forest.COUNTS})
    for i in range(0, rows.num_rows, 11):
        total = sum(plain_path(forest, root, x[i])[1] for root in forest.roots)
        score = 2 ** (-total / len(forest.roots) / forest.usual)
        assert math.isclose(rows["anomaly"][i].as_py(), score, rel_tol=1e-12)
        assert rows["kept"][i].as_py() == (not rows["base_failed"][i].as_py() and score <= forest.threshold)


def test_threshold_of_all_labelled_rows(spark):
    """The threshold comes from every labelled row, as sorting all their scores gives it."""
    many = 45_000  # more than 20,000 of a kind
    values = {"n_words": "100", "n_lines": "10", "word_chars": "case when id % 9 = 0 then 1300 + id % 700 else 500 end"}
    counts = spark.range(many).selectExpr("id as doc_id", *[f"cast({values.get(n, '0')} as long) as {n}" for n in quality_forest.COUNTS])
    labels = spark.range(many).selectExpr("id as doc_id", "case when id % 9 = 0 and id % 700 > 100 then 0 else 1 end as quality")
    forest = quality_forest.fit_forest(counts, labels)
    rows = counts.join(labels, "doc_id").toArrow()
    scores = forest.scores(quality_forest.features({n: rows[n].to_numpy() for n in quality_forest.COUNTS}))
    good = rows["quality"].to_numpy() == 1
    assert forest.threshold == pytest.approx(quality_forest.calibrate(scores[good], scores[~good]), abs=1e-12)
