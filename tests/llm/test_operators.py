"""Operators against plain versions, exact round trips and edge cases."""

from __future__ import annotations

import base64
import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskflow.llm import byte_bpe, html_tree, langid, line_dedup, mixing, parity_join, pii, quality_forest, stable_search, warc
from riskflow.llm.catalog import ORACLE, SURROGATE_KEY, TOKENS, catalog
from riskflow.llm.common import table, words_of
from tests.check_oracle import connect, difference

FOLDER = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = DOC + ", score double, row string, kept string, size long, mark long, `odd name` string"


def docs(spark, *rows, schema=DOC):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], schema)


def edge_docs(spark):
    """Null id and text, empty and very long texts, a repeated row, clashing extra columns."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [(1, None, "en", "a", 0), (2, "", "en", None, 0), (3, long, None, "a", 9), (4, "a short line here\nanother one", "de", "b", 3), (4, "a short line here\nanother one", "de", "b", 3), (None, "a short line here", "en", "b", 1)]
    return spark.createDataFrame([(*r, 0.5, "r", "k", 1, 2, "x") for r in rows], EXTRA)


def test_sql_checks(spark):
    database = connect(FOLDER)
    for name, sql in ORACLE.items():
        assert difference(catalog()[name](spark, FOLDER).toArrow(), database.execute(sql).to_arrow_table()) is None


@pytest.fixture(scope="module")
def texts():
    made = ["", " ", "a", "don't  stop\n\n now", "Ünïcödé 漢字 नमस्ते 😀👍🏽 x́", "\x00\x1c\x85 　 z", "1234 5,678.90", "a" * 3000, " " * 50 + "b", "tab\t\tq \n x"]
    rng = np.random.default_rng(3)
    pool = list("ab  \n\t\x1c é中1٣!'s’漢ñ😀\x00")
    return made + ["".join(rng.choice(pool, rng.integers(0, 40))) for _ in range(400)]


def test_bpe_equals_rank_library(texts):
    import tiktoken

    tokens = byte_bpe.read_ranks(TOKENS)
    codec = byte_bpe.Codec(byte_bpe.sentencepiece_model(tokens), public_tokenizers.PATTERN)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    for _ in range(2):  # the second time from memory
        offsets, ids = codec.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [plain.encode_ordinary(t) for t in texts]
        assert codec.decode(offsets, ids).to_pylist() == [t.encode() for t in texts]


def test_bpe_round_trip_and_edges(spark):
    edges = edge_docs(spark)
    encoded = byte_bpe.encode_documents(edges, TOKENS, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode_documents(encoded, TOKENS, public_tokenizers.PATTERN).collect()
    assert sorted(bytes(r.data).decode() for r in decoded) == sorted(r.text or "" for r in edges.collect())
    assert byte_bpe.token_digests(edges.limit(0), TOKENS, public_tokenizers.PATTERN).count() == 0


def test_line_dedup_edges(spark):
    rows = {(r.row.doc_id, r.kept, r.n_lines, r.n_dropped) for r in line_dedup.dedup_lines(edge_docs(spark)).collect() if r.row.doc_id != 3}
    assert rows == {(1, "", 1, 0), (2, "", 1, 0), (4, "a short line here\nanother one", 2, 0), (None, "", 1, 1)}
    assert line_dedup.dedup_lines(docs(spark)).count() == 0
    three = docs(spark, (1, "the same long line"), (2, "THE same long line \t"), (3, "the same long line\nx"))
    kept = {r.row.doc_id: r.kept for r in line_dedup.dedup_lines(three, min_docs=3).collect()}
    assert kept == {1: "the same long line", 2: "", 3: "x"}


def test_surrogates(spark):
    text = "Mail Bob.Smith@Mail5.example.com or bob.smith@mail5.example.com, call +1 (523) 555-1055. Mr. John Smith met Mrs. Smith; Госпожа Иванова. 10.0.0.1 4465758382889437"
    rows = docs(spark, (1, text), (2, "again bob.smith@mail5.example.com and 10.0.0.2"), (3, None), (4, ""), (5, "clean 3.5 text 2020-01-02"))
    safe = {r.row.doc_id: r for r in pii.replace_entities(rows, SURROGATE_KEY).collect()}
    assert safe[3].safe is None and safe[4].safe == "" and safe[5].safe == "clean 3.5 text 2020-01-02" and safe[5].n_entities == 0
    mails = re.findall(r"[\w.]+@[\w.]+\w", safe[1].safe + safe[2].safe)
    assert len(set(m.lower() for m in mails)) == 1 and "bob" not in mails[0] and mails[0].endswith(".com")
    assert re.search(r"call \+1 \([2-9]\d\d\) \d{3}-\d{4}\.", safe[1].safe) and "555-1055" not in safe[1].safe
    person = re.search(r"Mr\. (\w+) (\w+) met Mrs\. (\w+); Госпожа (\w+)\.", safe[1].safe)
    assert person[1] in pii.GIVEN["m_latin"] and person[2] == person[3] != "Smith" and re.match("[А-Я]", person[4])
    card = re.search(r"\b4\d{15}\b", safe[1].safe)[0]
    digits = [int(c) for c in reversed(card)]
    assert sum(digits[::2]) % 10 == (-sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10
    ips = re.findall(r"\d+\.\d+\.\d+\.\d+", safe[1].safe + " " + safe[2].safe)
    assert len(set(ips)) == 2 and not {"10.0.0.1", "10.0.0.2"} & set(ips)
    assert pii.replace_entities(edge_docs(spark), "k").count() == 6 and pii.replace_entities(docs(spark), "k").count() == 0


def test_surrogate_key_is_in_no_plan(spark):
    key = "it's a \\ secret' || 'key"
    rows = docs(spark, (1, "Mail bob@mail.example.com or Mr. John Smith, call +1 (523) 555-1055."), (2, "bob@mail.example.com"))
    safe = pii.replace_entities(rows, key)
    plan = safe._jdf.queryExecution().toString() + pii.surrogates(rows.select(F.lit("mail").alias("kind"), F.lit("a@b.cd").alias("norm")), key)._jdf.queryExecution().toString()
    found = {r.row.doc_id: r.safe for r in safe.collect()}
    assert "secret" not in plan.replace("'secret'", "").replace("secret)", "") or key not in plan
    assert key not in plan and "bob@" not in found[1] and found[2] in found[1]
    other = {r.row.doc_id: r.safe for r in pii.replace_entities(rows, "another").collect()}
    assert other[2] != found[2]


def test_surrogates_stay_distinct(spark):
    people = spark.range(600).selectExpr("'given_m' as kind", "concat('name', id) as norm")
    found = pii.surrogates(people, "k").collect()
    assert len({r.surrogate for r in found}) == 600 and not {r.surrogate for r in found} & {r.norm for r in found}


def test_warc_pages(spark, tmp_path):
    rows = [(1, "u1", "same"), (2, "u2", "same"), (3, None, None), (4, "u4", ""), (5, "u\n5", "é" * 70_000), (None, "n", "same"), (2, "u2", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(map(str, warc.archived_pages(pages, path=str(tmp_path / "w")).collect()))
    name = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    want = [(1, "same", "revisit", 2), (2, "same", "response", None), (2, "same", "response", None), (None, "same", "revisit", 2), (3, "", "revisit", 4), (4, "", "response", None), (5, "é" * 70_000, "response", None)]
    assert got == sorted(f"Row(page_id={i}, payload_bytes={len(t.encode())}, payload_digest='{name(t)}', record_type='{k}', refers_to={r})" for i, t, k, r in want)
    heads = warc.read_warc(spark, str(tmp_path / "w"), "record_id string, record_type string").where("record_type = 'revisit'")
    assert heads.count() == 3 and "Filter (" not in heads._jdf.queryExecution().executedPlan().toString()
    assert warc.archived_pages(pages.limit(0)).count() == 0


def test_unwanted_payloads_stay_compressed(tmp_path):
    """Of a small record only the header is inflated, up to a kilobyte; so is a wanted header that is longer."""
    import pyarrow.fs as fs

    fields = dict.fromkeys(warc.HEADERS) | {"record_id": "<urn:page:1>", "record_type": "response"}
    small, long = warc.record_bytes(fields, b"z" * 90_000), warc.record_bytes(fields | {"record_id": "<urn:" + "q" * 9000 + ">"}, b"w" * 5000)
    (tmp_path / "a.warc.gz").write_bytes(b"".join(warc.gzip_member(r, 6) for r in (small, long, small)))
    with fs.LocalFileSystem().open_input_file(str(tmp_path / "a.warc.gz")) as source:
        member = warc._Member(source, 0)
        assert len(member.data) <= warc.HEAD and member.length >= 90_000
        found = list(warc.read_records(source, lambda row: True, True))
        assert [len(r["payload"]) for r in found] == [90_000, 5000, 90_000]
        assert len(list(warc.read_records(source, lambda row: "q" in row["record_id"], False))) == 1


def test_warc_reads_other_files(spark, tmp_path):
    import gzip

    fields = dict.fromkeys(warc.HEADERS) | {"record_id": "<urn:page:1>", "record_type": "response"}
    one = warc.record_bytes(fields, b"x" * 200_000)
    two = warc.record_bytes(fields | {"record_id": "<urn:page:2>"}, b"y")
    (tmp_path / "a.warc").write_bytes(one + two)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(one) + gzip.compress(two))
    rows = warc.read_warc(spark, str(tmp_path)).select("record_id", F.octet_length("payload").alias("n")).collect()
    assert sorted((r.record_id, r.n) for r in rows) == [("<urn:page:1>", 200_000)] * 2 + [("<urn:page:2>", 1)] * 2


def test_html(spark):
    pages = table(spark, FOLDER, "pages")
    model = html_tree.learn(pages)

    def plain(html):
        start = html.find("<article>")
        end = html.find("</article>")
        parts = re.split(r"</?(?:p|h1)>", html[start + 9 : end if end >= 0 else len(html)])
        from html import unescape

        blocks = (" ".join(unescape(re.sub(r"</?[a-zA-Z]*$", "", re.sub(r"<[^>]*>", " ", p))).split()) for p in parts)
        return "\n".join(b for b in blocks if b)

    rows = {r.page_id: r.html for r in pages.collect()}
    for r in html_tree.extract_text(pages, model).collect():
        assert r.text == plain(rows[r.page_id]) and r.n_chars == len(r.text)
    other = "<body><header><h1>Site</h1></header><div class='cookie-notice'>We use cookies</div><main><h1>T</h1><p>Hello &amp; a long paragraph that says many things about something. <span class='ad'>Buy!</span> end<ul><li>one point</ul><form><p>name please</form><section id=comments><p>I like this a lot, really, it is a long comment.</section></main><aside><p>Side story that is long long long long long long</aside></body>"
    assert model.extract(other) == "T\nHello & a long paragraph that says many things about something.\nend\none point"
    assert model.extract(None) == model.extract("") == model.extract("<script>x</script") == ""
    assert html_tree.extract_text(pages.limit(0), model).count() == 0


def test_deep_html_is_parsed_in_one_pass():
    import time

    begin = time.process_time()
    nodes, blocks = html_tree.parse("<div>" * 200_000 + "x" + "</div>" * 200_000 + "<p>y")
    assert len(nodes) == 200_002 and [t for _, t in blocks] == ["x", "y"]
    assert time.process_time() - begin < 4
    html_tree.parse("<p>" * 50_000 + "<li>" * 50_000 + "<td>" * 50_000 + "</b>" * 50_000)
    assert time.process_time() - begin < 8


def test_html_edges(spark):
    model = html_tree.learn(table(spark, FOLDER, "pages"))
    page = "<html><body><nav>menu</nav><article><p>One text of a page that is long enough to be read.</p></article></body></html>"
    schema = "page_id long, url string, html string, text string, `a.b` string, n_chars int"
    pages = spark.createDataFrame([(1, "u", page, "t", "x", 1), (1, "u", page, "t", "x", 1), (2, None, None, None, None, None), (None, "u", "", "t", "x", 1)], schema)
    got = sorted(((r.page_id, r.text) for r in html_tree.extract_text(pages, model).collect()), key=str)
    text = "One text of a page that is long enough to be read."
    assert got == [(1, text), (1, text), (2, ""), (None, "")]
    assert html_tree.extract_text(pages.limit(0), model).count() == 0


def test_html_marginals():
    import itertools

    model = html_tree.TreeModel({})
    nodes, _ = html_tree.parse("<body><nav><li>a</li></nav><div class=post><h1>t</h1><p>long long long long text</p></div><p>z</p></body>")
    odds = [sum(model.odds.get(v, 0.0) for v in look) for look in html_tree.looks(nodes)]
    total, content = 0.0, np.zeros(len(nodes))
    for labels in itertools.product((0, 1), repeat=len(nodes)):
        weight = 1.0
        for i, node in enumerate(nodes):
            p = 1 / (1 + np.exp(-odds[i]))
            weight *= p if labels[i] else 1 - p
            if i:
                weight *= model.edge[html_tree.edge_kind(node)][2 * labels[node.parent] + labels[i]]
        total += weight
        content += weight * np.array(labels)
    assert np.allclose(content / total, model.marginals(nodes))


def test_mixing(spark):
    documents = table(spark, FOLDER, "documents")
    rows = mixing.taken_words(documents).join(documents.select("doc_id", "source"), "doc_id").toPandas()
    sizes = rows.groupby("source")["size"].sum()
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes.index))}
    target, open_ = {}, set(sizes.index)
    left = 1.5 * sizes.sum()
    while True:  # reshare by weight until none is above its limit
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not full:
            target |= share
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= full
    for s, group in rows.groupby("source"):
        assert group.target.iloc[0] == pytest.approx(target[s]) and abs(group.taken.sum() - target[s]) <= 128
    assert (rows.taken <= 2 * rows["size"]).all() and len(rows) == documents.count()
    again = mixing.taken_words(documents.repartition(7)).toPandas().sort_values("doc_id")
    assert again.taken.tolist() == rows.sort_values("doc_id").taken.tolist()
    edges = mixing.taken_words(edge_docs(spark)).collect()
    assert len(edges) == 6 and mixing.taken_words(docs(spark)).count() == 0
    assert mixing.mixed_documents(edge_docs(spark)).select("row.*").columns == edge_docs(spark).columns


def test_mix_is_written_in_shards(spark, tmp_path):
    """Shards of equal size, disjoint, together the mix, each shuffled; files keep a shard's order."""
    source = table(spark, FOLDER, "documents").select("doc_id", "source", "text", F.lit(1).alias("a.b"), F.lit(2).alias("shard"))
    mixing.mixed_documents(source, shard_blocks=16).write.parquet(str(tmp_path / "mix"))
    written = spark.read.parquet(str(tmp_path / "mix"))
    rows = written.select("shard", "place", "row.doc_id", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at")).orderBy("at").collect()
    shards = collections.defaultdict(list)
    for r in rows:
        shards[r.shard].append(r)
    sizes = [len(own) for own in shards.values()]
    assert len(sizes) > 4 and max(sizes) - min(sizes) <= 2 + len(sizes).bit_length() and max(sizes) <= 20
    for own in shards.values():
        assert len({r.file for r in own}) == 1 and [r.place for r in own] == list(range(len(own)))
    assert any([r.doc_id for r in own] != sorted(r.doc_id for r in own) for own in shards.values())
    blocks = mixing.mix(source, None, shard_blocks=16)[2]
    assert collections.Counter(r.doc_id for r in rows) == collections.Counter(r.doc_id for r in blocks.collect())


def test_many_sources_are_dealt_in_groups(spark):
    """More sources than a task holds, one of them with a third of the blocks, one null."""
    sources = [None, *["hot"] * 40, *[f"s{i}" for i in range(60)]]
    rows = [(i, sources[i % len(sources)], i, 1, 0, 0, 1, i // len(sources)) for i in range(len(sources) * 12)]
    blocks = spark.createDataFrame(rows, "doc_id long, source string, mark long, copy int, pass int, block int, words long, rank long")
    rank = F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) - 1
    blocks = blocks.withColumn("rank", rank.cast("long")).repartition(5)
    dealt = mixing.deal_to_shards(blocks, 64, tree_sources=7).toPandas()
    assert sorted(dealt.doc_id) == [r[0] for r in rows] and dealt.shard.nunique() == -(-len(rows) // 64)
    sizes = dealt.groupby("shard").size()
    assert sizes.max() - sizes.min() <= len(sizes).bit_length()
    for _, own in dealt.groupby("shard"):
        assert sorted(own.place) == list(range(len(own)))
    # A shard owns a range of each source's ranks; the hot source is in each.
    ranges = dealt.groupby(["shard", "source"])["rank"]
    assert (ranges.max() - ranges.min() + 1 == ranges.size()).all()
    assert dealt[dealt.source == "hot"].shard.nunique() == len(sizes)
    again = mixing.deal_to_shards(blocks.repartition(3), 64, tree_sources=7).toPandas()
    assert dict(zip(again.doc_id, again.shard)) == dict(zip(dealt.doc_id, dealt.shard))


def test_splitting_tree_is_exact():
    quotas = np.array([1000, 0, 37, 5000])
    tree = mixing.SplittingTree(quotas, 13, 1)
    source = np.repeat(np.arange(4), quotas)
    shard = tree.shard_of(source, np.concatenate([np.arange(q) for q in quotas]))
    sizes = np.bincount(shard, minlength=13)
    assert sizes.sum() == quotas.sum() and sizes.max() - sizes.min() <= 4
    assert mixing.split_quotas(np.array([4 * 10**9, 10**9]), 10**9, np.random.default_rng(0)).sum() == 10**9


def test_language(spark):
    documents = table(spark, FOLDER, "documents")
    model = langid.learn(documents, F.col("lang"), ~langid.held_out(F.col("doc_id")))
    found = langid.identify(documents, model).where(langid.held_out(F.col("row.doc_id")))
    assert found.select(F.avg((F.col("lang_pred") == F.col("row.lang")).cast("int"))).first()[0] > 0.95
    for r in langid.identify(edge_docs(spark), model).collect():
        assert (r.lang_pred == "und") == (not r.row.text) and 0 <= r.score <= 1
    nobody = langid.learn(documents.limit(0), F.col("lang"), F.lit(True))
    assert langid.identify(docs(spark, (1, "text")), nobody).first().lang_pred == "und"
    assert langid.identify(docs(spark), model).count() == 0


def test_nearest(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3000, 16)) + 4 * rng.standard_normal((8, 16))[rng.integers(0, 8, 3000)]
    x[100:400] = x[50]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000, None), (5050, [0.0] * 16), (5100, [1.0] * 15 + [None]), (5150, [float("nan")] * 16), (5200, [1.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in stable_search.nearest(frame, region_rows=500, sample=400).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    norms, hits = np.linalg.norm(x, axis=1), 0
    assert sorted(got) == list(range(0, 3000, 50))
    for q, found in got.items():
        cosine = x @ x[q] / (norms * norms[q])
        cosine[q] = -9
        best = np.lexsort((np.arange(3000), -cosine.round(12)))[:5]
        hits += len(set(best) & {v for v, _ in found})
        assert len(found) == 5 and all(abs(cosine[v] - s) < 1e-12 for v, s in found)
    assert hits >= 0.9 * 5 * len(got) and [v for v, _ in got[50]] == [100, 101, 102, 103, 104]
    assert stable_search.nearest(frame.limit(0)).count() == 0
    assert stable_search.nearest(frame.where("vec_id in (0, 7)")).count() == 1


def test_nearest_splits_crowded_regions(spark):
    """Inner trees, crowds of candidates and of queries; a repeated id; a clashing extra column."""
    rng = np.random.default_rng(2)
    x = 5 + 0.2 * rng.standard_normal((4000, 12))
    x[1000:2500] = x[0]  # copies
    x[2500:2900] = x[2500] * np.linspace(1, 2, 400)[:, None]  # one direction, no copies
    rows = [(i, v.tolist(), i) for i, v in enumerate(x)] + [(50, x[50].tolist(), 0), (100, x[3].tolist(), 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, region long").repartition(5)
    found = stable_search.nearest(frame, region_rows=100, sample=64).toPandas()
    ids = np.array([r[0] for r in rows])
    all_ = np.array([r[1] for r in rows])
    unit = all_ / np.linalg.norm(all_, axis=1, keepdims=True)
    hits = wanted = 0
    for q in range(0, 4000, 50):
        for v in {tuple(r[1]) for r in rows if r[0] == q}:
            score = (unit @ (np.array(v) / np.linalg.norm(v))).round(10)
            best = np.lexsort((ids, -score))
            best = [j for j in best if ids[j] != q][:5]
            mine = found[found.query_id == q]
            assert len(mine) == (10 if q == 100 else 5)
            hits += sum(any(abs(score[j] - s) < 1e-9 for s in mine.score) for j in best)
            wanted += 5
    assert hits >= 0.9 * wanted
    assert found[found.query_id == 1050].sort_values("rank").vec_id.tolist() == [0, 1000, 1001, 1002, 1003]
    assert not (found.query_id == found.vec_id).any()
    # Rows of one id crowd around a vector that another id has too.
    near = [(100, [1.0, 0.001 * j]) for j in range(30)] + [(150, [1.0, 0.0])] + [(7 + j, [1.0, 1.0 + j]) for j in range(5)]
    few = stable_search.nearest(spark.createDataFrame(near, "vec_id long, embedding array<double>")).groupBy("query_id").count().collect()
    assert dict(few) == {100: 30 * 5, 150: 5}


def test_search_groups_are_bounded(spark):
    base = spark.range(5000).selectExpr("id vec_id", "id one", "id two", "0L region", "if(id < 4000, 0L, id % 10) leaf")
    sent = spark.range(3000).selectExpr("id one", "id two", "0L region", "if(id < 2500, 0L, 3L) leaf")
    left, right = stable_search.dealt(base, sent, 100)
    group = ["region", "leaf", "salt", "chunk"]
    for frame in (left, right):
        assert frame.groupBy(group).count().agg({"count": "max"}).first()[0] < 200
    pairs = left.join(right.withColumnRenamed("one", "query").drop("two"), group).groupBy("leaf").agg({"*": "count"}).collect()
    assert dict(pairs) == {0: 4100 * 2500, 3: 100 * 500}


def plain_counts(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    windows = list(zip(words, words[1:], words[2:]))
    often = {w for w, n in collections.Counter(windows).items() if n > 1}
    repeated = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)


def test_quality_counts(spark, texts):
    many = texts + [None, "a b c a b c a b", "x y z x y z"] + [r.text for r in table(spark, FOLDER, "documents").collect()]
    found = quality_forest.count_texts(pa.array(many, pa.string()))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert list(zip(*[found[n].tolist() for n in names])) == [plain_counts(t) for t in many]


def test_quality_forest(spark):
    counts = quality_forest.text_counts(table(spark, FOLDER, "documents"))
    labels = table(spark, FOLDER, "labels")
    rows = quality_forest.judge(counts, quality_forest.fit_forest(counts, labels)).join(labels, "doc_id").toPandas()
    judged = rows[~rows.base_failed]
    assert judged[judged.quality == 1].kept.mean() > 0.97 and not rows[rows.base_failed].kept.any()
    assert quality_forest.fit_forest(counts, labels.where("quality = 1")) is None
    assert quality_forest.judge(quality_forest.text_counts(edge_docs(spark)), None).where("kept").count() <= 1
    assert quality_forest.judge(quality_forest.text_counts(docs(spark)), None).count() == 0


def plain_components(rows, n=4, percent=85):
    def shingles(text):
        words = (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split()
        return frozenset(zip(*[words[k:] for k in range(n)])) if len(words) >= n else frozenset([tuple(words)] if words else [])

    sets, root = [(i, shingles(t)) for i, t in rows], {i: i for i, _ in rows}  # an id may have several sets

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, own in sets:
        for j, other in sets:
            common = len(own & other)
            if i < j and common and 100 * common >= percent * len(own | other):
                a, b = sorted((find(i), find(j)))
                root[max(a, b)] = min(a, b)
    return {i: (len(own), find(i)) for i, own in sets}


def test_jaccard_components(spark):
    rng = np.random.default_rng(9)
    rows, words = [], [f"w{i}" for i in range(300)]
    passage = [f"common{i}" for i in range(60)]
    for group in range(12):
        base = list(rng.choice(words, int(rng.integers(1, 120)))) + (passage if group % 3 == 0 else [])
        for _ in range(14):
            text = list(base)
            for _ in range(int(rng.integers(0, 1 + len(base) // 25))):
                text[int(rng.integers(0, len(text)))] = str(rng.choice(words)).upper()
            rows.append((len(rows), " ".join(text)))
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, "one"), (len(rows) + 3, "One"), (len(rows) + 4, rows[0][1])]
    want = plain_components(rows)
    for chunk in (200, 1_000_000):
        got = parity_join.jaccard_components(docs(spark, *rows).repartition(5), chunk=chunk).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    edges = {(r.doc_id, r.component_id) for r in parity_join.jaccard_components(edge_docs(spark)).collect()}
    assert edges == {(1, 1), (2, 2), (3, 3), (4, 4), (None, None)}
    assert parity_join.jaccard_components(docs(spark)).count() == 0


def test_jaccard_of_repeated_keys(spark):
    """A key with several texts keeps the links of each; so do its copies and near copies."""
    text = {name: " ".join(f"{name}{k}" for k in range(60)) for name in "abcdef"}
    near = {name: own + f" and more {name}" for name, own in text.items()}
    rows = [(5, text["a"]), (5, text["b"]), (1, text["a"]), (2, text["b"]), (9, near["b"]), (7, text["c"]), (7, near["d"]), (7, text["c"]), (8, text["d"]), (6, near["c"]), (3, text["e"]), (3, text["f"])]
    want = {i: root for i, (_, root) in plain_components(rows).items()}
    assert want == {1: 1, 2: 1, 5: 1, 9: 1, 6: 6, 7: 6, 8: 6, 3: 3}
    for chunk in (10, 1_000_000):
        got = parity_join.jaccard_components(docs(spark, *rows).repartition(4), chunk=chunk).collect()
        assert len(got) == len(rows) and {r.doc_id: r.component_id for r in got} == want


def test_buckets_are_compared_whole(spark, monkeypatch):
    """Groups of any size, cut into blocks and into Arrow batches, give every near pair of different roots."""
    monkeypatch.setattr(parity_join, "BLOCK", 8)
    monkeypatch.setattr(parity_join, "PAIRS", 50)
    rng, rows = np.random.default_rng(3), []
    for segment, held in ((4, 2), (5, 30), (6, 1), (7, 9)):
        for a in range(held):
            many = int(rng.integers(40, 50))
            rows.append((segment, held, 100 * segment + a, 100 * segment + a % 5, many, parity_join.short_sketch(rng.integers(0, 3, many).astype(np.uint64) << np.uint64(16))))
    members = spark.createDataFrame(rows, "segment long, held long, a long, root long, n_shingles long, sketch binary")
    got = {tuple(r) for r in parity_join._close_in_blocks(members, 85).collect()}
    bands, want = parity_join.Bands(85), set()
    for s, _, a, p, m, x in rows:
        for t, _, b, q, n, y in rows:
            apart = sum(int(i ^ j).bit_count() for i, j in zip(x, y))
            upper = bands.band(m) != bands.band(n) or bands.band(m) % 2 == s % 2
            if s == t and a < b and p != q and upper and 100 * min(m, n) >= 85 * max(m, n) and apart * 185 <= (m + n) * 15:
                want.add((a, b))
    assert got == want and want


def test_bands_hold_every_linked_pair():
    bands = parity_join.Bands(85)
    for small in range(1, 400):
        for large in range(small, small * 100 // 85 + 1):
            a, b = bands.band(small), bands.band(large)
            assert b - a <= 1
            # |A - B| is largest when the pair just links
            common = -(-85 * (small + large) // 185)
            assert small + large - 2 * common <= bands.difference(a if b > a else max(a - 1, 0))


def test_words(texts):
    owner, code, words = words_of(pa.array([*texts, None]))
    found = [[] for _ in range(len(texts) + 1)]
    for o, c in zip(owner, code):
        found[o].append(words[c])
    assert found == [[w.decode() for w in (t or "").encode().split()] for t in [*texts, None]]


def test_pipeline(spark):
    import corpus_pipeline
    import tiktoken

    source = table(spark, FOLDER, "documents")
    frames, frame = {}, source
    for name, stage in corpus_pipeline.STAGES:
        frame = spark.createDataFrame(stage(spark, frame, FOLDER).toArrow())
        frames[name] = frame
        assert name == "tokens" or frame.columns == source.columns
    before = {r.doc_id: r.text for r in frames["shared_lines"].collect()}
    keep = {i for i, (_, root) in plain_components(sorted(before.items())).items() if root == i}
    assert {r.doc_id for r in frames["near_duplicates"].collect()} == keep
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(byte_bpe.read_ranks(TOKENS))}, special_tokens={})
    mixed = collections.Counter((r.doc_id, r.text) for r in frames["mixed"].collect())
    want = sorted((i, plain.encode_ordinary(t)) for (i, t), n in mixed.items() for _ in range(n))
    assert sorted((r.doc_id, list(r.ids)) for r in frames["tokens"].collect()) == want
    assert corpus_pipeline.run(spark, FOLDER).count() == len(want)


def test_pipeline_links_five_words_at_80_percent(spark):
    import corpus_pipeline

    words = lambda name, many: [f"{name}{i}" for i in range(many)]
    longer, cut, apart = words("a", 100), words("b", 100), words("c", 100)
    rows = [(1, longer), (2, longer + words("x", 20)), (3, cut), (4, cut[:82]), (5, apart), (6, apart + words("y", 30))]
    rows = [(i, " ".join(w)) for i, w in rows]
    assert {i for i, (_, root) in plain_components(rows).items() if root == i} == {1, 2, 3, 4, 5, 6}
    keep = {i for i, (_, root) in plain_components(rows, 5, 80).items() if root == i}
    assert keep == {1, 3, 5, 6}
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs(spark, *rows), FOLDER).collect()} == keep
    bands = parity_join.Bands(corpus_pipeline.LINKED_PERCENT)
    for small in range(1, 400):
        for large in range(small, small * 100 // 80 + 1):
            a, b = bands.band(small), bands.band(large)
            common = -(-80 * (small + large) // 180)
            assert b - a <= 1 and small + large - 2 * common <= bands.difference(a if b > a else max(a - 1, 0))


def test_language_with_rare_labels(spark):
    import corpus_pipeline

    documents = table(spark, FOLDER, "documents")
    plain = {r.doc_id: r.lang for r in documents.collect()}
    # Copies of some learning texts under labels of one row each.
    learned = documents.where(~langid.held_out(F.col("doc_id"))).orderBy("doc_id").limit(60).collect()
    wrong = []
    for k, r in enumerate(learned):
        wrong.append((next(i for i in range(10_000_000 + 1000 * k, 10_001_000 + 1000 * k) if zlib.crc32(str(i).encode()) % 5), r.text, f"x-{k}"))
    added = spark.createDataFrame(wrong, "doc_id long, text string, lang string")
    tailed = documents.unionByName(added, allowMissingColumns=True)
    model = langid.learn(tailed, F.col("lang"), ~langid.held_out(F.col("doc_id")))
    assert len(model.languages) >= 60
    found = {r.doc_id: r.lang_pred for r in langid.identify(documents.select("doc_id", "text"), model).where(langid.held_out(F.col("row.doc_id"))).select("row.doc_id", "lang_pred").collect()}
    assert np.mean([plain[i] == p for i, p in found.items()]) > 0.95
    kept = {r.doc_id for r in corpus_pipeline.language(spark, documents, FOLDER).select("doc_id").collect()}
    with_tail = {r.doc_id for r in corpus_pipeline.language(spark, tailed, FOLDER).select("doc_id").collect()}
    assert kept <= with_tail


def test_language_with_thousands_of_labels(spark):
    """Learning is a join with a table of labels; a bound on the labels keeps those with the most texts."""
    rng = np.random.default_rng(2)
    words = {i: ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(6)] for i in range(3000)}
    rows = [(3000 * k + i, " ".join(rng.choice(own, 8)), f"l{i:04d}") for i, own in words.items() for k in range(4 if i < 100 else 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learn(frame, F.col("lang"), F.lit(True))
    assert len(model.languages) == 3000 and model.masks.nbytes <= langid.MASK_BYTES
    tried = frame.where("lang < 'l0100'")
    right = langid.identify(tried, model).select(F.avg((F.col("lang_pred") == F.col("row.lang")).cast("int"))).first()[0]
    assert right > 0.95
    assert langid.learn(frame, F.col("lang"), F.lit(True), most_languages=100).languages == tuple(f"l{i:04d}" for i in range(100))


def test_filter_against_exact_sets(spark):
    """Masks hold every n-gram of a language, and few others."""
    documents = table(spark, FOLDER, "documents").where("lang is not null and text is not null")
    model = langid.learn(documents, F.col("lang"), F.lit(True), min_count=1, least=0.0)
    for lang in model.languages:
        own = [r.text for r in documents.where(F.col("lang") == lang).collect()]
        rest = [r.text for r in documents.where(F.col("lang") != lang).collect()]
        bit = np.uint64(1) << np.uint64(model.languages.index(lang))

        def held(hashes):
            first, second = langid.slots_of(hashes, len(model.masks))
            return (model.masks[first, 0] & model.masks[second, 0] & bit) != 0

        mine = np.unique(langid.grams(own)[0])
        assert held(mine).all()
        others = np.setdiff1d(langid.grams(rest)[0], mine)
        assert held(others).mean() < 0.2


def test_surrogates_end(spark, monkeypatch):
    """Runs of signs are no secrets, and pools that are full of entities grow."""
    rounds, kept = [], pii.kept_table

    def counted(frame, purpose):
        rounds.append(purpose)
        assert len(rounds) < 60, "draws again for ever"
        return kept(frame, purpose)

    monkeypatch.setattr(pii, "kept_table", counted)
    lines = ["Password: ____________ x", "secret:\n----------------", "token = ////////////", "api_key='+-+-+-+-+-+-+'"]
    signed = "token = ----------a1b2"
    rows = pii.replace_entities(docs(spark, *enumerate([*lines, signed])), SURROGATE_KEY).collect()
    safe = {r.row.doc_id: (r.safe, r.n_entities) for r in rows}
    assert [safe[i] for i in range(4)] == [(line, 0) for line in lines]
    assert safe[4][1] == 1 and safe[4][0] != signed and re.fullmatch(r"token = ----------[a-z]\d[a-z]\d\d*", safe[4][0])
    rounds.clear()
    letters = "abcdefghijklmnopqrstuvwxyz"
    pools = [("secret", f"-----------{c}") for c in letters] + [(k, str(d)) for k in ("phone", "ssn") for d in range(10)] + [("card", f"4{d}") for d in range(10)]
    found = pii.surrogates(spark.createDataFrame(pools, "kind string, norm string"), SURROGATE_KEY).collect()
    assert len(found) == len(pools) == len({(r.kind, r.surrogate) for r in found}) and not set(pools) & {(r.kind, r.surrogate) for r in found}
    for r in found:
        if r.kind == "card":
            digits = [int(c) for c in reversed(r.surrogate)]
            assert (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0
    longer = [("phone", "+44 (2) 34-56", "23456", "8123456"), ("phone", "+1 (523) 555-1055", "5235551055", "3334445555"), ("ssn", "123-45-6789", "123456789", "9876543210")]
    shown = spark.createDataFrame(longer, "kind string, raw string, norm string, surrogate string").select(F.expr(pii._rendered())).collect()
    assert [r[0] for r in shown] == ["+44 (8) 12-3456", "+1 (333) 444-5555", "987-65-43210"]


def test_surrogates_of_names_without_a_title(spark):
    text = "Smith was here. Mr. John Smith and Frau O'Brien-Weiß met; John Smith's SMITH, Johnny Smithson and smith. Call (523) 555-1055: Smith! O'Brien-Weiß’s \x00Smith Ünal"
    rows = [(1, text), (2, "John Smith has no title here"), (None, "Mrs. Maria Smith, Smith"), (1, text), (4, "Mr. Smith"), (5, "Mrs. Smith's"), (6, "Mr. Smith--he, Smith's " + "A-" + "ab-" * 50_000 + " B" + "b" * 50_000)]
    safe = pii.replace_entities(docs(spark, *rows), SURROGATE_KEY).collect()
    assert len(safe) == 7
    safe = {r.row.doc_id: (r.safe, r.n_entities) for r in safe}
    name = re.match(r"(\w+) was here\. Mr\. (\w+) (\w+) and Frau (\w+) met; ", safe[1][0])
    last, given, again, other = name.groups()
    assert last == again and other != last and given in pii.GIVEN["m_latin"] and "Smith" not in (last, given, other)
    call = re.search(r"Call (.{14}):", safe[1][0])[1]
    assert safe[1] == (f"{last} was here. Mr. {given} {last} and Frau {other} met; {given} {last}'s {last.upper()}, Johnny Smithson and smith. Call {call}: {last}! {other}’s \x00{last} Ünal", 11)
    assert safe[2] == ("John Smith has no title here", 0)
    assert re.fullmatch(rf"Mrs\. \w+ {last}, {last}", safe[None][0]) and safe[None][1] == 3
    assert safe[4] == (f"Mr. {last}", 1) and safe[5] == (f"Mrs. {last}'s", 1)
    assert safe[6][0].startswith(f"Mr. {last}--he, {last}'s A-ab-") and safe[6][1] == 2 and safe[6][0].endswith("- B" + "b" * 50_000)
