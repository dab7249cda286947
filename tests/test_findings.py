"""Small cases of faults that reviews found."""

import hashlib
import inspect
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chatloom.llm import toxicity
from chatloom.operators import dialogue as dl
from chatloom.operators import projection as pj
from chatloom.operators import retrieval as rt
from chatloom.plans import retrieval_queries as rq
from chatloom.sources import io
from chatloom.streaming import streams


def test_pair_goes_on_where_the_partition_also_begins_another_conversation(spark):
    turns = spark.createDataFrame([(c, t, "assistant" if t % 2 else "user", f"{c}:{t}") for c in range(40) for t in range(2)], "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted((r.conv_id, r.question, r.answer) for r in dl.qa_pairs(turns).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == [(c, f"{c}:0", f"{c}:1") for c in range(40)]


@pytest.mark.parametrize("block", ["40", "128m"])
def test_corpus_in_parts_is_the_corpus(spark, tmp_path, block):
    texts = {
        "a.txt": "one\n two <b>x</b> <i\nhref=1\n> three < 4 <\n> 5 <> 6 <<a>7\r\n\xa0 https://x.y<i>z &nbsp;\nend < open\nhttp://q",
        "b.txt": "x <\n\n\ny > z\n\n> w <u\n",
        "c.md": " \n<a\nb>\n",
        "d.TXT": "no > tag\n<\n<\n<",
    }
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    want = {r.source_file: (r.source_type, r.text) for r in io.read_corpus(spark, str(tmp_path)).collect()}
    assert len(want) == 3
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        for part in (1, 30):
            parts = io.read_corpus_parts(spark, str(tmp_path), part)
            joined = parts.groupBy("source_file", "source_type").agg(F.array_sort(F.collect_list(F.struct("start", "part", "text"))).alias("p")).collect()
            assert {r.source_file: (r.source_type, " ".join(x.text for x in r.p)) for r in joined} == want
            assert {r.source_file: r.digest for r in io.corpus_digests(parts).collect()} == {n: hashlib.md5(t.encode()).hexdigest() for n, (_, t) in want.items()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_every_label_counts(spark):
    # the last labels alone show that "zorg" is toxic and "plim" isn't
    texts = [(i, f"{'zorg' if i % 2 else 'plim'} w{i % 50} " + " ".join(f"{'zorg' if i % 2 else 'plim'} c{i}x{j} zorg" if i % 2 else f"plim c{i}x{j}" for j in range(3))) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    assert "max_rows" not in inspect.signature(toxicity.fit_toxicity).parameters
    model = toxicity.fit_toxicity(docs, labels)
    got = toxicity.score_toxicity(docs, model).select("doc_id", "score").collect()
    assert all((r.score > 0.5) == bool(r.doc_id % 2) for r in got)


def test_weights_are_those_of_all_rows(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(12_001, 3))
    y = (draw.random(12_001) < 1 / (1 + np.exp(-(x @ [1.0, -2.0, 0.5] - 1)))).astype(int)
    rows = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(y, x, strict=True)], "y int, x array<double>").repartition(7)
    w = np.array(toxicity._logistic(rows, 3))
    z = np.c_[np.ones(len(x)), x]
    # the gradient over all rows is nil there
    assert np.abs(z.T @ (1 / (1 + np.exp(-(z @ w))) - y) + 1e-2 * w).max() < 1e-6


def test_fallback_makes_no_row_for_a_query_and_a_text(spark):
    asked = spark.createDataFrame([(1, "abc"), (2, "xyz"), (3, None)], "query_id long, q string")
    rows = spark.createDataFrame([(7, "abx"), (5, None), (6, "zz"), (4, "abx"), (3, "")], "id long, text string").repartition(3)
    found = rt.fallback(asked, rows, 3)
    # texts of the queries stand in no table beside the rows
    assert "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = sorted((r.query_id, r.place, r.id, r.n) for r in found.collect())
    assert got == [(1, 1, 4, 4), (1, 2, 7, 4), (1, 3, 3, 0), (2, 1, 4, 1), (2, 2, 6, 1), (2, 3, 7, 1), (3, 1, 3, None), (3, 2, 4, None), (3, 3, 5, None)]


def test_sums_of_a_block_come_from_as_many_partitions_as_cores(spark):
    rows = spark.createDataFrame([(i, [(i % 5, 1.0)]) for i in range(60)], "id long, x array<struct<place: int, weight: double>>").repartition(40)
    assert pj._few(rows).rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert np.allclose(pj._back(rows, np.eye(5)), 12 * np.eye(5))


@pytest.mark.parametrize("by_row", [False, True])
def test_more_terms_than_are_sent_join_only_the_rarest(spark, monkeypatch, by_row):
    texts = [(i, None if i == 3 else " ".join(f"w{j}" for j in range(40) if i % (j + 1) == 0) + (" w1 w1" if i % 4 == 0 else "")) for i in range(60)]
    rows, found = spark.createDataFrame(texts, "id long, text string"), rt.words(F.col("text"))
    asked = spark.createDataFrame([("w1",), ("w39",), ("w7",), ("zz",)], "term string")

    def index(only=None):
        made, idf = rt.tfidf(rows, "id", found, by_row=by_row, only=only)
        long = made.select("id", F.explode("x").alias("e")).select("id", "e.*") if by_row else made
        return made, {(r.id, r.term): round(r.weight, 12) for r in long.collect()}, idf

    _, want, idf = index()
    assert len(want) > 200
    few = {k: w for k, w in want.items() if k[1] in ("w1", "w39", "w7")}
    assert index(asked)[1] == few
    monkeypatch.setattr(rt, "MOST_SENT", 12)
    assert 0 < rt._commonest(idf, 12).count() <= 12
    made, got, _ = index()
    assert got == want
    assert index(asked)[1] == few
    # lengths need no window over all entries
    assert "Window" not in made._jdf.queryExecution().optimizedPlan().toString()


def test_grams_are_counted_without_a_string_each(spark, monkeypatch):
    texts = [(1, "abcab  ab\n\nx"), (2, ""), (3, None), (4, "é\U0001f600é\U0001f600"), (5, "a"), (6, "\x00a\x00"), (7, "  b")]
    forms = {i: re.sub(r"[ \t\n\r\f]{2,}", " ", t or "") for i, t in texts}
    tf = {i: Counter(t[j : j + n] for n in (1, 2, 3) for j in range(len(t) - n + 1)) for i, t in forms.items()}
    df = Counter(g for c in tf.values() for g in c)
    w = {i: {g: n * (math.log((1 + len(texts)) / (1 + df[g])) + 1) for g, n in c.items()} for i, c in tf.items()}
    want = {(i, g): round(x / math.sqrt(sum(y * y for y in c.values())), 12) for i, c in w.items() for g, x in c.items()}
    rows = spark.createDataFrame(texts, "id long, text string").coalesce(1)
    ordered = lambda made: {(r.id, r.term): round(r.weight, 12) for r in made.collect()}
    made = rt.tfidf(rows, "id", rt.Grams(F.col("text"), (1, 2, 3)))[0]
    assert ordered(made) == want
    # texts are in no table of their grams
    assert "extract_all" not in made._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(rt, "MOST_SENT", 6)
    assert ordered(rt.tfidf(rows, "id", rt.Grams(F.col("text"), (1, 2, 3)))[0]) == want
    # where characters are so many that few texts can be numbered at once
    monkeypatch.setattr(rt, "NUMBERS", 2000)
    batch = pa.record_batch([pa.array([i for i, _ in texts]), pa.array([forms[i] for i, _ in texts])], names=["id", "r"])
    parts = list(rt._plain(rt._gram_counts((1, 2, 3)))([batch]))
    assert len(parts) > 1
    assert {r["id"]: {e["x"]: e["n"] for e in r["r"]} for p in parts for r in p.to_pylist()} == tf


def test_state_of_a_stream_takes_few_partitions(spark, tmp_path):
    rows = [(k, 600 + 30.0 * i, 1, 1000 * k + i) for k in range(40) for i in range(40)]
    for n in range(4):
        spark.createDataFrame(rows[n * 400 : n * 400 + 400], "k long, s double, bad int, i long").withColumn("ts", F.timestamp_seconds("s")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        out = streams.drained(streams.breach_alerts(stream, "k", "i", F.col("bad") == 1, 90.0, late="1 minute", slot=60.0), str(tmp_path / "o"), str(tmp_path / "c"), 3)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "24"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(list((tmp_path / "c" / "state" / "0").glob("[0-9]*"))) == 3
    # slots of a minute that end by the watermark, 1710 s
    assert sorted((r.key, r.at) for r in out.collect()) == [(k, 600 + 30.0 * i) for k in range(40) for i in range(3, 36)]


def test_packed_rows_hold_the_same_index(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "a b b \U0001f600 c"), (2, "b c d"), (3, ""), (4, None), (5, "a \U0001f600\U0001f601 e f")], "id long, text string").coalesce(1)
    for found in (rt.Grams(F.col("text"), (3,)), rt.words(F.col("text"), 1)):
        by_row, idf = rt.tfidf(rows, "id", found, by_row=True)
        packed, _ = rt.tfidf(rows, "id", found, packed=True)
        terms = [r.term for r in pj.places(idf).orderBy("place").collect()]
        want = {(r.id, e.term): e.weight for r in by_row.collect() for e in r.x}
        got = {}
        for batch in packed.toArrow().to_batches():
            for first, ends, place, w in pj.pieces(batch):
                assert all(np.all(np.diff(place[a:b]) > 0) for a, b in zip(ends, ends[1:]))  # noqa: B905
                ids = batch.column("id").to_pylist()[first:]
                got |= {(ids[i], terms[place[j]]): w[j] for i in range(len(ends) - 1) for j in range(ends[i], ends[i + 1])}
        assert got == want
        # with a vocabulary smaller than the index
        for most in (200_000, 5):
            fits = [pj.fit_projection(ix, dims=2, most_terms=most, idf=i) for ix, i in ((packed, idf), (by_row, idf), (by_row, None))]
            assert max(abs(f.share - fits[0].share) for f in fits) < 1e-9
            v = [{r.id: np.outer(r.v, r.v) for r in pj.project(ix, f).collect()} for f, ix in zip(fits, (packed, by_row, fits[2].rows), strict=True)]
            assert v[0].keys() == v[1].keys() == v[2].keys() and all(np.abs(v[0][i] - o[i]).max() < 1e-9 for o in v for i in o)
        q = rt.tfidf(rows.filter("id in (1, 2)"), "id", found, idf)[0]
        hits = [sorted((r.query_id, r.id, r["rank"], round(r.score, 12)) for r in rt.lexical(q, *ix).collect()) for ix in ((by_row, 3), (packed, 3, 0.0, pj.places(idf)))]
        assert hits[0] == hits[1] and len(hits[0]) >= 2
        # beyond what is sent, rows stay in the longer form
    assert not any("\ud83d" in t for t in terms)


@pytest.mark.parametrize("dense", [0, 7, 60])
def test_sparse_products_in_dense_tables_and_by_entry(monkeypatch, dense):
    rng = np.random.default_rng(2)
    a = rng.random((90, 60)) * (rng.random((90, 60)) < np.linspace(0.9, 0.02, 60))
    i, j = np.nonzero(a)
    order = rng.permutation(len(i))
    shifted = 70_000
    # places beyond 16 bits, weights of equal places added
    twice = pj.pack(pa.array(np.arange(90)), np.append(i, i)[np.append(order, order + len(i))], np.append(j, j)[np.append(order, order + len(i))] + shifted, np.append(a[i, j], a[i, j])[np.append(order, order + len(i))] / 2)
    assert twice.num_rows == len(np.unique(i))
    monkeypatch.setattr(pj, "CELLS", 400)
    for entries in (2_000_000, 50):
        monkeypatch.setattr(pj, "ENTRIES", entries)
        block, total, y = rng.normal(size=(60, 4)), np.zeros((60, 4)), np.zeros((90, 4))
        for first, ends, place, weight in pj.pieces(twice):
            ids = twice.column("id").to_numpy()[first : first + len(ends) - 1]
            y[ids] = pj._times(ends, place - shifted, weight, block, dense, total)
        assert np.abs(y - a @ block).max() < 1e-12 and np.abs(total - a.T @ (a @ block)).max() < 1e-11
        # places below some number alone
        kept = sum(len(place) for _, _, place, _ in pj.pieces(twice, shifted + 10))
        assert kept == (j < 10).sum()


def test_index_to_evaluation_takes_whole_characters(spark, tmp_path, monkeypatch):
    texts = [(i, f"\U0001f600 text number {i} of some that are long enough \U0001f601 to be a chunk", "en", "s", 40) for i in range(12)]
    spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, texts[i][1]) for i in (3, 5)], "item_id long, text string").coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    seen, old = [], rt.tfidf
    monkeypatch.setattr(rt, "tfidf", lambda *a, **k: seen.append(made := old(*a, **k)) or made)
    got = {r.metric: r.value for r in rq.CUR4_index_retrieve(spark, str(tmp_path)).collect()}
    assert got["items"] == 2 and got["recall_5"] == 1.0
    assert {len(r.term) for r in seen[0][1].collect()} == {3}


def test_grams_of_many_texts_rise_by_weight(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"text {i % 7} of {i} words {i * i}") for i in range(300)], "id long, text string").coalesce(1)
    idf = rt.tfidf(rows, "id", rt.Grams(F.col("text"), (1, 2, 3)))[1]
    # with weights, rows aren't dealt out
    made = rt.tfidf(rows, "id", rt.Grams(F.col("text"), (1, 2, 3)), idf)[0]
    weights = [r.weight for r in made.collect()]
    assert len(weights) > 5000 and weights == sorted(weights)


@pytest.mark.parametrize(("words", "most"), [(1_000_000, 7), (40, 30), (40, 500)])
def test_pairs_are_counted_as_numbers(spark, monkeypatch, words, most):
    texts = [(i, None if i == 9 else " ".join(f"w{(i * j) % 11}" for j in range(i % 8))) for i in range(50)]
    tf = {i: Counter((w := (t or "").split()) + [f"{a} {b}" for a, b in zip(w, w[1:])]) for i, t in texts}  # noqa: B905
    total, df = sum(tf.values(), Counter()), Counter(x for c in tf.values() for x in c)
    kept = set(sorted(total, key=lambda x: (-total[x], x))[:most])
    w = {i: {x: n * (math.log((1 + len(texts)) / (1 + df[x])) + 1) for x, n in c.items() if x in kept} for i, c in tf.items()}
    want = {(i, x): round(y / math.sqrt(sum(z * z for z in c.values())), 12) for i, c in w.items() for x, y in c.items()}
    rows = spark.createDataFrame(texts, "id long, text string").coalesce(1)
    monkeypatch.setattr(rt, "WORDS", words)
    made = rt.tfidf(rows, "id", rt.Pairs(rt.words(F.col("text"), 1)), most_terms=most)[0]
    assert {(r.id, r.term): round(r.weight, 12) for r in made.collect()} == want
    # pairs aren't made for each place of a text
    assert "concat_ws" not in made._jdf.queryExecution().optimizedPlan().toString()
    # with more terms than are sent
    if most == 30:
        monkeypatch.setattr(rt, "MOST_SENT", 12)
        made = rt.tfidf(rows, "id", rt.Pairs(rt.words(F.col("text"), 1)), most_terms=most)[0]
        assert {(r.id, r.term): round(r.weight, 12) for r in made.collect()} == want
