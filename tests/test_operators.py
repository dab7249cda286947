"""Small cases with known answers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatloom.functions import text as tx
from chatloom.operators import curation as cu
from chatloom.operators import dialogue as dl
from chatloom.operators import evaluation as ev
from chatloom.operators import gates
from chatloom.operators import logs as lg
from chatloom.operators import parsing as ps
from chatloom.operators import postings
from chatloom.operators import projection as pj
from chatloom.operators import quality
from chatloom.operators import retrieval as rt
from chatloom.operators import rules as rl
from chatloom.operators import sets
from chatloom.operators.evidence import holding
from chatloom.operators.numbering import numbered, numbered_within
from chatloom.operators.quantiles import quantiles
from chatloom.operators.storage import stored
from chatloom.sources import io
from chatloom.streaming import streams


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t")).alias("x")).first().x


def test_normalize_and_mask(spark):
    assert one(spark, "a\r<b>c</b>  https://x.y/z &nbsp; d", tx.normalize) == "a c <URL> d"
    assert one(spark, None, tx.normalize) is None
    assert one(spark, "call 13812345678", lambda t: tx.replace_all(t, [(r"1[3-9]\d{9}", "<PHONE>")])) == "call <PHONE>"


def test_lines(spark):
    assert one(spark, "a\na\n\nb\na", lambda t: tx.unrepeated(tx.lines(t))) == ["a", "b", "a"]
    assert one(spark, "a\na\na\nb", lambda t: tx.longest_run(tx.lines(t))) == 3
    assert one(spark, "Buy now!\nbuy\nBuy  now\n...", lambda t: tx.first_of_each(tx.lines(t), tx.line_form)) == ["Buy now!", "buy"]


def test_meant_terms(spark):
    negations = ["not", "never"]
    assert one(spark, "we do not offer bonus here", lambda t: tx.meant(t, "bonus", negations)) is False
    assert one(spark, "we do not offer bonus here. It is said that a big bonus is yours", lambda t: tx.meant(t, "bonus", negations)) is True
    assert one(spark, "nothing", lambda t: tx.meant(t, "bonus", negations)) is False


def test_think(spark):
    assert one(spark, "<THINK>x\ny</THINK> answer", tx.without_think) == "answer"


def test_payouts(spark):
    df = spark.createDataFrame([("1000", "2.15"), ("1000", "1.0"), (None, "2")], "s string, o string")
    gross, net, error = rl.european(F.col("s"), F.col("o"))
    got = df.select(gross.cast("double").alias("g"), net.cast("double").alias("n"), error.alias("e")).collect()
    assert [tuple(r) for r in got] == [(2150.0, 1150.0, None), (None, None, "OUT_OF_RANGE"), (None, None, "MISSING")]


def test_parlay(spark):
    df = spark.createDataFrame([([1.5, 2.0],), ([],), ([1.0],)], "o array<double>")
    payout, error = rl.parlay(F.col("o"), F.lit("10"))
    assert [(r.p and float(r.p), r.e) for r in df.select(payout.alias("p"), error.alias("e")).collect()] == [(30.0, None), (None, "EMPTY"), (None, "OUT_OF_RANGE")]


def test_md5_mod_and_split(spark):
    import hashlib

    keys = ["a", "b", "abc", ""]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = [r.m for r in df.select(sets.md5_mod(F.col("k"), 10).alias("m")).collect()]
    assert got == [int(hashlib.md5(k.encode()).hexdigest(), 16) % 10 for k in keys]


def test_merge_and_pairs(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "assistant", "d"), (1, 4, "user", "e"), (1, 5, "assistant", "f")], "conv_id long, turn long, role string, text string")
    assert [(r.text, r.merged) for r in dl.merge_same_role(turns).orderBy("turn").collect()] == [("a\nb", 1), ("c\nd", 1), ("e", 0), ("f", 0)]
    assert [(r.pair_id, r.question, r.answer) for r in dl.qa_pairs(turns).orderBy("pair_id").collect()] == [("1_single_0", "b", "c"), ("1_single_1", "e", "f")]


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_runs_and_pairs_over_many_partitions(spark, parts):
    import itertools
    import random

    draw, rows = random.Random(parts), []
    for c in (1, 2, 3, 4):  # the first holds most turns
        rows += [(c, t, draw.choice(["user", "user", "assistant", "assistant", "assistant", "tool"]) if t % 60 > 25 else "assistant" if t % 120 > 59 else "user", f"{c}:{t}") for t in range(400 if c == 1 else draw.randint(1, 25))]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted((r.conv_id, r.turn, r.role, r.text, r.merged) for r in dl.merge_same_role(turns).collect())
        cut = sorted((r.conv_id, r.turn, r.role, r.text) for r in dl.merge_same_role(turns, part=7).collect())
        pairs = sorted((r.conv_id, int(r.pair_id.split("_")[-1]), r.question, r.answer) for r in dl.qa_pairs(turns).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    runs = [(k, list(g)) for k, g in itertools.groupby(rows, lambda r: (r[0], r[2]))]
    assert got == sorted((c, g[0][1], role, "\n".join(r[3] for r in g), len(g) - 1) for (c, role), g in runs)
    assert cut == sorted((c, g[i][1], role, "\n".join(r[3] for r in g[i : i + 7])) for (c, role), g in runs for i in range(0, len(g), 7))
    want = []
    for c, said in itertools.groupby(rows, lambda r: r[0]):
        question, n = None, 0
        for _, _, role, text in said:
            if role == "user":
                question = text
            elif role == "assistant" and question is not None:
                want.append((c, n, question, text))
                question, n = None, n + 1
    assert pairs == sorted(want)


def test_admission_is_greedy(spark):
    events = spark.createDataFrame([(i, 1, s) for i, s in enumerate((0, 10, 20, 61, 65, 71))], "event_id long, user_id long, s long").withColumn("ts", F.timestamp_seconds("s"))
    got = lg.admitted(events, "user_id", 60, 2).orderBy("event_id").collect()
    assert [r.accepted for r in got] == [True, True, False, True, False, True]


def test_cooldown(spark):
    points = spark.createDataFrame([("k", float(t)) for t in (0, 5, 10, 12, 25)], "key string, at double")
    assert [r.action for r in lg.cooled(points, "key", "at", 10).orderBy("at").collect()] == [True, False, True, False, True]


def test_chunks_end_with_the_text(spark):
    df = spark.createDataFrame([(1, "x" * 1000), (2, "y" * 600), (3, "short"), (4, None)], "id long, t string")
    got = rt.chunks(df, "id", F.col("t")).orderBy("id", "chunk_index").collect()
    assert [(r.id, r.chunk_index, r.char_start, r.char_end) for r in got] == [(1, 0, 0, 600), (1, 1, 480, 1000), (2, 0, 0, 600)]


def test_diversity_caps_sources(spark):
    hits = spark.createDataFrame([(1, i, "a1" if i < 4 else "b2", f"{i}x{i}y{i}z", 1.0 - i / 10, i + 1) for i in range(6)], "query_id long, id long, file string, text string, score double, rank int")
    got = rt.diversify(hits, 4, 2).orderBy("place").collect()
    assert [r.file for r in got] == ["a1", "a1", "b2", "b2"]


def test_entry_without_llm():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_entry_imports_without_a_session():
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()))"], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0 and int(done.stdout) > 100


def test_hybrid_falls_back_to_words(spark):
    texts = spark.createDataFrame([(1, "red apple pie", "a"), (2, "green apple tart", "a"), (3, "blue sky", "b")], "id long, text string, file string")
    asked = spark.createDataFrame([(7, "apple pie"), (8, "sky")], "query_id long, q string")
    index, idf = rt.tfidf(texts, "id", rt.words(F.col("text")))
    q, _ = rt.tfidf(asked, "query_id", rt.words(F.col("q")), idf)
    lex = rt.lexical(q, index, rt.candidates(2))
    fitted = pj.fit_projection(index)
    vec = rt.dense(pj.project(q.filter("id = 7"), fitted).withColumn("id", -F.col("id")), pj.project(index, fitted), 3).withColumn("query_id", -F.col("query_id"))
    got = rt.hybrid(asked, texts, lex, vec, 2).orderBy("query_id", "place").collect()
    assert (got[0].query_id, got[0].id, got[0]["mode"]) == (7, 1, "hybrid")
    assert [(r.id, r["mode"]) for r in got if r.query_id == 8] == [(3, "tfidf_fallback")]


def test_source_affinity_and_family(spark):
    row = spark.createDataFrame([("Tell me about Alpha in the guide", "docs/AB12_alpha-notes.md", ["tell", "alphabet"])], "q string, f string, t array<string>")
    got = row.select(rt.source_affinity(F.col("t"), F.col("f")).alias("a"), rt.explicit_match(F.col("q"), F.col("f"), "notes|guide").alias("e"), rt.family(F.col("f")).alias("k"), rt.family(F.lit("ABC.md")).alias("w")).first()
    assert (round(got.a, 6), got.e, got.k, got.w) == (round(1 / 3, 6), 0.5, "12_alpha-notes", "abc")


def test_spread_out_caps_defers_and_refills(spark):
    hits = [("a1", "1", "same words here", 0.9), ("a1", "1", "same words here", 0.8), ("b1", "1", "others", 0.7), ("c1", "1", "third of a family", 0.6), ("d1", "1", "fourth of a family", 0.5), ("e2", "2", "alone", 0.1)]
    short = [("a", "a", "xy", 1.0), ("a", "a", "qrst", 0.9), ("a", "a", "mnop", 0.8)]
    of = lambda h: spark.createDataFrame([(h,)], "h array<struct<file:string,family:string,text:string,score:double>>")
    places = lambda h, *p: of(h).select(rt.spread_out(F.col("h"), *p)).first()[0]
    # the second is too much like the first of its file; the fifth is one too many of its family
    assert places(hits, 4, 2, 3) == [0, 2, 3, 5]
    assert places(hits, 6, 2, 3) == [0, 2, 3, 5, 1, 4]
    assert places(hits, 3, 1, 9) == [0, 2, 3] and places([], 3) == []
    assert places(short, 2, 2, 5) == [0, 1]


def test_arguments_held_by_calls(spark):
    cases = [
        ('{"a": 1, "b": "x", "more": 0}', '{"a": "1", "b": "x"}', True), ('{"a": "2"}', '{"a": 1}', False), ('{"a": 2.0}', '{"a": " 2 "}', True), ('{"a": "02.50"}', '{"a": 2.5}', True),
        ('{"l": [1, "2", {"k": null}]}', '{"l": ["1", 2, {"k": null}]}', True), ('{"l": [1, 2, 3]}', '{"l": [1, 2]}', False), ('{"l": []}', '{"l": {}}', False), ("{}", '{"a": null}', True),
        ('{"a": ""}', '{"a": ""}', True), ('{"a": 0}', '{"a": ""}', False), ('{"o": {"p": {"q": "v/~"}}}', '{"o": {"p": {"q": "v/~"}}}', True), ('{"o": {"p": 1}}', '{"o": {"p": {}}}', False), ('{"a/b": 1}', '{"a": {"b": 1}}', False),
        ("not json", "{}", True), (None, '{"a": 1}', False), ('{"a": true}', '{"a": "true"}', False), ('{"t": "say \\"{1,2]\\" é"}', '{"t": "say \\"{1,2]\\" \\u00e9"}', True), ('{"n": 12345678901234567890}', '{"n": 12345678901234567891}', False), ('{"n": 1e3}', '{"n": 1000}', True),
    ]
    df = spark.createDataFrame(cases, "a string, e string, want boolean").select("*", ps.args_match(F.col("a"), F.col("e")).alias("got"))
    assert [r for r in df.collect() if r.got != r.want] == []
    call = "<tool_call>{{\"name\": \"t\", \"arguments\": {{\"x\": {}}}}}</tool_call>".format
    two = spark.createDataFrame([(call(1) + " then " + call(2), '{"x": 2}')], "t string, e string")
    s = two.select(ps.tool_score(F.col("t"), F.lit("t"), F.col("e"), F.array(F.lit("then"))).alias("s")).first().s
    assert s.matched and abs(s.score - 1.0) < 1e-9


def ranking(spark, rows):
    return spark.createDataFrame(rows, "query_id long, id long, score double, rank int")


def test_hybrid_modes_and_focus(spark):
    asked = spark.createDataFrame([(1, "alpha beta"), (2, "alpha beta")], "query_id long, q string")
    texts = spark.createDataFrame([(10, "nothing at all", "alpha_x.md"), (11, "alpha beta gamma", "zeta1.md"), (12, "beta", "eta2.md")], "id long, text string, file string")
    lex = ranking(spark, [(1, 11, 0.9, 1), (1, 10, 0.5, 2), (2, 12, 0.7, 1), (2, 11, 0.6, 2)])
    vec = ranking(spark, [(1, 12, 0.9, 1), (1, 11, 0.8, 2)])
    for fusion in ("rrf", "weighted"):
        got = rt.hybrid(asked, texts, lex, vec, 2, fusion=fusion, weight_lex=0, weight_vec=0).collect()
        of = {(r.query_id, r.place): (r.id, r["mode"]) for r in got}
        assert of[1, 1] == (11, "hybrid") and of[2, 1] == (12, "tfidf_fallback") and of[2, 2] == (11, "tfidf_fallback")
    # the query mentions one of two aliases of the first file
    rows = asked.filter("query_id = 1").join(texts).withColumns({"terms": F.array(F.lit("alpha"), F.lit("beta")), "fusion": F.lit(0.0)})
    ranked = rt.rerank(rows, 0.0, "zzz").withColumn("j", rt.bigram_jaccard(F.col("q"), F.col("text"))).collect()
    covered, shift = {10: 0.0, 11: 1.0, 12: 0.5}, {10: 0.18 * 0.5, 11: -0.06, 12: -0.06}
    assert all(abs(r.score - (0.2 * covered[r.id] + 0.1 * r.j + shift[r.id])) < 1e-9 for r in ranked) and len(ranked) == 3


def test_modalities_leave_doubles_out(spark):
    asked = spark.createDataFrame([(1, "alpha")], "query_id long, q string")
    units = spark.createDataFrame(
        [(1, "text", "t", "alpha one", None), (2, "text", "t", "alpha one", None), (3, "image", "i", "x", [1.0, 0.0]), (4, "image", "j", "y", [1.0, 0.01]), (5, "image", "k", "z", [0.0, 1.0])],
        "id long, modality string, title string, text string, v array<double>",
    )
    lex = ranking(spark, [(1, 1, 0.9, 1), (1, 2, 0.8, 2)])
    vec = ranking(spark, [(1, 3, 0.9, 1), (1, 4, 0.8, 2), (1, 5, 0.7, 3)])
    got = rt.with_modality(asked, units, lex, vec, 5).orderBy("place").collect()
    assert [r.id for r in got] == [1, 3, 5] and [r.place for r in got] == [1, 2, 3]
    assert len(rt.with_modality(asked, units, lex, vec, 2).collect()) == 2


def test_projection_is_the_truncated_svd(spark):
    draw = np.random.default_rng(1)
    x = draw.random((60, 40)) * (draw.random((60, 40)) < 0.3) + np.outer(draw.random(60), draw.random(40)) * (draw.random((60, 40)) < 0.5)
    index = spark.createDataFrame([(int(i), f"t{j:02d}", float(x[i, j])) for i, j in zip(*np.nonzero(x), strict=True)], "id long, term string, weight double").repartition(3)
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    for dims in (4, 12):
        fitted = pj.fit_projection(index, dims=dims)
        best = (s[:dims] ** 2).sum() / (s**2).sum()
        assert best * 0.99 < fitted.share <= best + 1e-9 and np.abs(fitted.basis.T @ fitted.basis - np.eye(dims)).max() < 1e-6
        rows = pj.project(index, fitted).collect()
        assert len(rows) == 60 and all(len(r.v) == dims and abs(sum(c * c for c in r.v) - 1) < 1e-9 for r in rows)
        assert abs(sum(r.energy for r in rows) / (s**2).sum() - fitted.share) < 1e-9
    # with a direction for every term but one, and rounds enough, products of rows are those of the svd
    fitted = pj.fit_projection(index, dims=100)
    k = fitted.basis.shape[1]
    got = {r.id: np.array(r.v) * np.sqrt(r.energy) for r in pj.project(index, fitted).collect()}
    want = (u[:, :k] * s[:k]) @ (u[:, :k] * s[:k]).T
    assert k == 39 and all(abs(got[a] @ got[b] - want[a, b]) < 1e-9 for a in got for b in got)
    # unknown terms, no rows, one row
    other = spark.createDataFrame([(5, "unknown", 1.0), (6, "t00", 2.0)], "id long, term string, weight double")
    assert [r.id for r in pj.project(other, fitted).collect()] == [6]
    none = pj.fit_projection(index.filter("id < 0"))
    assert none.share == 0.0 and pj.project(index, none).count() == 0
    assert pj.fit_projection(index.filter("id = 1")).basis.shape[1] == 1


def test_rule_checks_of_words_and_numbers(spark):
    says = [
        ("共1170元", "170元", False), ("共170元。", "170元", True), ("亏损1000*0.88=880元", "亏损880", True), ("亏损1000*0.88=8800元", "亏损880", False), ("未中奖，输掉1170", "输1170", True),
        ("没有赢，本金退回", "输1170", False), ("赢了大约500", "盈利500", True), ("亏损为本金500", "亏损本金500", True), ("盈利 很多很多很多很多很多 500", "赢500", False), ("a.b(c", "a.b(c", True), ("1a1b", "1a.b", False), ("x", "", True), ("盈利12.5", "赢12.5", True), ("盈利1205", "赢12.5", False),
    ]
    df = spark.createDataFrame(says, "a string, t string, want boolean").select("*", rl.says(F.regexp_replace("a", " ", ""), F.col("t")).alias("got"))
    assert [r for r in df.collect() if r.got != r.want] == []
    answers = spark.createDataFrame([(1, "The Fee is 12 %"), (2, None), (2, None)], "id long, answer string")
    checks = spark.createDataFrame([(1, "a", ["thefee", "x"], ["12"], ["13"]), (1, "b", ["x"], [], None), (1, "c", None, ["1"], []), (1, "d", [], [], ["the fee"]), (2, "a", [], None, ["z"]), (3, "a", [], [], [])], "id long, check_id string, any array<string>, all array<string>, none array<string>")
    got = {(r.id, r.check_id): r.reason for r in rl.rule_checks(answers, checks).collect()}
    assert got == {(1, "a"): None, (1, "b"): "any", (1, "c"): "all", (1, "d"): "none", (2, "a"): None, (3, "a"): "missing_prediction"}


@pytest.mark.parametrize("most", [8_000_000, 30])
def test_passages_are_found_in_one_reading(spark, most):
    texts = spark.createDataFrame([(1, "abcde xyz"), (2, "cde"), (2, "cde"), (3, None), (4, ""), (5, "日本語テキスト")], "id long, text string")
    passages = spark.createDataFrame([("p", "cde"), ("q", "cde"), ("r", "bcd"), ("s", ""), (None, "xyz"), ("t", None), ("u", "本語"), ("v", "no" * 40)], "key string, passage string")
    got = sorted(((r.key or "-", r.id) for r in holding(texts, passages, most).collect()))
    assert got == [("-", 1), ("p", 1), ("p", 2), ("q", 1), ("q", 2), ("r", 1), ("u", 5)]
    assert holding(texts, passages.filter("false")).count() == 0 and holding(texts.filter("false"), passages).count() == 0


def test_scores_gates_and_comparisons(spark):
    rows = [(1, 1.0, None, 0.5, 1.0, False), (2, None, None, None, None, None), (3, 0.0, 1.0, 1.0, 1.0, True)]
    df = spark.createDataFrame(rows, "id int, intent double, escalation double, include double, exclude double, risk boolean")
    parts = {n: F.col(n) for n in ("intent", "escalation", "include", "exclude")}
    got = {r.id: r.s for r in df.select("id", ev.answer_score(parts, F.col("risk")).alias("s")).collect()}
    assert abs(got[1] - (0.4 + 0.1 + 0.15) / 0.75) < 1e-12 and got[2] == 0.0 and abs(got[3] - 0.6 * 0.4) < 1e-12
    a = spark.createDataFrame([(1, "x", 1.0, True), (2, "x", 0.5, False), (3, None, 0.2, False), (9, "x", 0.0, False)], "id int, c string, score double, passed boolean")
    b = spark.createDataFrame([(1, "x", 0.5, False), (2, "x", 0.5, False), (3, None, 0.9, True)], "id int, c string, score double, passed boolean")
    got = {r.category: (r.n, r.a_better, r.b_better, r.ties, r.both_pass, r.both_fail, r.score_delta and round(r.score_delta, 6), r.decisive) for r in ev.compare_runs(a, b, "id", "c", ["score"]).collect()}
    assert got == {"x": (2, 1, 0, 1, 0, 1, -0.25, 0.0), "": (1, 0, 1, 0, 0, 0, 0.7, 1.0), "TOTAL": (3, 1, 1, 1, 0, 1, round(0.2 / 3, 6), 0.5)}
    values = spark.createDataFrame([(1, "ok", 0.9), (1, "late", 3.0), (2, "ok", 0.95)], "run int, metric string, value double")
    out = {(r.level, r.run, r.metric): r for r in ev.gate_runs(values, [("ok", ">=", 0.9), ("late", "<=", 2.0)], 2).collect()}
    assert out["run", 1, None].errors == ["late=3.0000 > 2.0000"] and out["run", 2, None].errors == ["late=missing > 2.0000"] and not out["overall", None, None].passed
    assert (out["metric", None, "ok"].lowest, out["metric", None, "ok"].highest) == (0.9, 0.95)
    fine = ev.gate_runs(values.filter("metric = 'ok'"), [("ok", ">=", 0.9)], 3).filter("level = 'overall'").first()
    assert not fine.passed and fine.errors == ["runs=2 <> 3"] and ev.gate_runs(values.filter("metric = 'ok'"), [("ok", ">=", 0.9)], 2).filter("level = 'overall'").first().passed


def test_repair_pack_of_confusions(spark):
    failed = spark.createDataFrame([(1, "refund", "odd", True), (2, "refund", "odd", True), (3, "refund", "odd", False), (4, "refund", "other", True), (5, "bonus", "odd", True), (6, "refund", "odd", True), (7, "none", "odd", True)], "id long, gold string, pred string, request_ok boolean")
    cases = spark.createDataFrame([(1, " where is it ", ["refund"]), (2, "  ", []), (5, "my bonus", ["missing"]), (7, "q", [])], "id long, query string, must array<string>")
    say = lambda c: F.concat(F.lit("About "), F.col(c))
    rows, counts = ev.confusion_pack(failed, cases, ["refund", "bonus"], "odd", say("gold"), say("pred"), ["{query}", "Please: {query}!"], 5)
    got = sorted((r.row_id, r.prompt, r.chosen, r.rejected) for r in rows.collect())
    assert got == [("dpo_refund_1_01", "where is it", "About refund", "About odd"), ("dpo_refund_1_02", "Please: where is it!", "About refund", "About odd"), ("sft_refund_1_01", "where is it", "About refund", None), ("sft_refund_1_02", "Please: where is it!", "About refund", None)]
    assert {r.counter: r.n for r in counts.collect()} == {"missing_case": 1, "no_query": 1, "pool": 2, "quality": 1, "rows_sft": 2, "rows_dpo": 2}


def test_commonest_run_of_characters():
    import random
    from collections import Counter

    draw = random.Random(3)
    for _ in range(200):
        text, n = "".join(draw.choice("abé😀") for _ in range(draw.randint(0, 90))), draw.randint(1, 9)
        want = max(Counter(text[i : i + n] for i in range(len(text) - n + 1)).values(), default=None)
        assert quality.most_of_one(text, n) == quality.most_of_one(text, n, held=17) == want
    assert quality.most_of_one("ab" * 3_000_000, 12) == 3_000_000 - 5


def plain_gate(rows, span, limit):
    """Decisions of a greedy pass over (key, at, id)."""
    out, taken = {}, {}
    for k, at, i in sorted(rows, key=lambda r: (r[0] or 0, r[1], r[2])):
        mine = taken.setdefault(k, [])
        mine[:] = [t for t in mine if t > at - span]
        out[k, i] = len(mine) < limit
        if out[k, i]:
            mine.append(at)
    return out


@pytest.mark.parametrize(("limit", "size"), [(1, 7), (1, 4096), (2, 40), (3, 4096)])
def test_gates_are_the_greedy_pass(spark, limit, size):
    import random

    draw, rows = random.Random(limit * size), []
    for i in range(600):  # a third and more of one key, in bursts
        k = draw.choice([1, 1, 1, 2, 3, None])
        rows.append((k, draw.choice([draw.randint(0, 4000), draw.randint(900, 1100)]) + draw.choice([0.0, 0.25, 0.5]), i))
    df = spark.createDataFrame([*rows, (1, None, 999)], "user_id long, at double, event_id long").repartition(5)
    got = {(r.user_id, r.event_id): r.accepted for r in gates.gated(df, "event_id", "user_id", F.col("at"), 30.0, limit, size).collect()}
    assert got.pop((1, 999)) is False and got == plain_gate(rows, 30.0, limit)
    assert gates.gated(df.filter("event_id < 0"), "event_id", "user_id", F.col("at"), 30.0, limit, size).count() == 0


def test_states_that_meet_end_a_second_run():
    import random

    draw = random.Random(2)
    for _ in range(500):
        at = sorted(draw.randint(50, 400) for _ in range(draw.randint(1, 60)))
        limit, a, b = draw.randint(1, 4), sorted(draw.sample(range(50), 2)), sorted(draw.sample(range(50), 1))
        a = a[-limit:]
        assert gates.limited(at, 40, limit, a, gates.limited(at, 40, limit, b), b) == gates.limited(at, 40, limit, a)


def test_search_reads_what_it_must(spark):
    draw = np.random.default_rng(8)
    rows = [(i, t, float(w)) for i in range(400) for t, w in [("the", 0.05 + 0.01 * draw.random()), *((f"w{draw.integers(40)}", draw.random() ** 4) for _ in range(4))]]
    index = stored(spark.createDataFrame(rows, "id long, term string, weight double").groupBy("id", "term").agg(F.max("weight").alias("weight")), "t")
    asked = stored(spark.createDataFrame([(q, t, w) for q in range(6) for t, w in [("the", 0.1), (f"w{q}", 1.0), (f"w{q + 7}", 0.6), (f"w{q + 20}", 0.3)]] + [(9, "nowhere", 1.0), (8, "the", 1.0)], "query_id long, term string, qw double"), "t")
    blocks = stored(postings.posting_blocks(index, size=8, part=60), "t")
    assert blocks.filter("term = 'the'").agg(F.max("part")).first()[0] == 6 and blocks.agg(F.max("size")).first()[0] == 8
    hits, report = postings.search(asked, blocks, index, 5)
    plain = asked.join(index, "term").groupBy("query_id", "id").agg(F.sum(F.col("qw") * F.col("weight")).alias("score")).filter("score > 0")
    best = lambda df: sorted((r.query_id, r["rank"], r.id, round(r.score, 9)) for r in rt.top(df, "query_id", "score", "id", 5).collect())
    assert best(hits) == best(plain) and len(best(hits)) == 35
    read = {r.query_id: (r.blocks, r.read) for r in report.collect()}
    assert 9 not in read and all(r < b for q, (b, r) in read.items() if q < 6)


def test_numbers_without_a_window(spark):
    rows = spark.createDataFrame([(i % 3 if i % 7 else None, (i * 37) % 101 if i % 11 else None, i) for i in range(300)], "g long, o long, x long").repartition(6)
    plain = sorted(((r.o is not None, r.o or 0, r.x) for r in rows.collect()))
    got = numbered(rows, ["o", "x"], "n").collect()
    assert sorted(r.n for r in got) == list(range(300)) and [(r.o is not None, r.o or 0, r.x) for r in sorted(got, key=lambda r: r.n)] == plain
    within, sizes = numbered_within(rows, "g", ["o", "x"], "n")
    for g in (None, 0, 1, 2):
        mine = sorted((r for r in within.collect() if r.g == g), key=lambda r: r.n)
        assert [r.n for r in mine] == list(range(len(mine))) and [(r.o is not None, r.o or 0, r.x) for r in mine] == sorted((r.o is not None, r.o or 0, r.x) for r in mine)
        assert [r["size"] for r in sizes.collect() if r.g == g] == [len(mine)]
    assert numbered(rows.filter("x < 0"), ["o"], "n").count() == 0


def test_fallback_ranks_texts_without_shared_words(spark):
    asked = spark.createDataFrame([(i, q) for i, q in enumerate(["abc", "zzz", ""])], "query_id long, q string")
    rows = spark.createDataFrame([(1, "xbcx"), (2, "a-b-c"), (3, None)], "id long, text string")
    got = {(r.query_id, r.place): (r.id, r.n) for r in rt.fallback(asked, rows, 2, block=2).collect()}
    assert got[0, 1] == (1, 4) and got[0, 2] == (2, 3) and got[1, 1][1] == 0 and (2, 1) in got


def test_runs_and_windows(spark):
    df = spark.createDataFrame([(["b", "a", "b", "b"],), ([],), (None,)], "a array<string>")
    assert [r.m for r in df.select(tx.most_often(F.col("a")).alias("m")).collect()] == [3, None, None]
    assert [(r.x, r.n) for r in df.select(F.explode(tx.runs(F.col("a"))).alias("r")).select("r.*").collect()] == [("a", 1), ("b", 3)]
    assert one(spark, "aXaXa", lambda t: tx.windows(t, "a", 2, 1)) == ["ax", "axax", "axa"]
    assert one(spark, "a.b a.b", lambda t: tx.windows(t, "a.b", 1, 0)) == ["a.b", " a.b"] and one(spark, "none", lambda t: tx.windows(t, "q", 3, 3)) == []


def test_json_objects_and_contents(spark):
    for text, want in (('{"a": {"b": 1}}', '{"a": {"b": 1}}'), ('x ```json\n{"a": 1}\n``` y', '{"a": 1}'), ('so {"a": {"b": 2}} and {"c": 3}', '{"a": {"b": 2}}'), ("} {", None), ("{bad}", None), (None, None), ("", None)):
        assert one(spark, text, ps.json_object) == want
    for text, want in (("plain", "plain"), ('{"content": "c"}', "c"), ('["a", {"text": "b"}, {"type": "image"}]', "ab"), ("[not json", "[not json")):
        assert one(spark, text, ps.flat_content) == want
    assert one(spark, "A: one two B: three", lambda t: ps.section(t, "A", ["A", "B"], 5)) == "one t…" and one(spark, "B: x", lambda t: ps.section(t, "A", ["A", "B"])) == ""


def test_tool_scores(spark):
    call = '<tool_call>{"name": "pay", "arguments": {"n": "12", "to": {"id": 7.0, "tags": ["a", "b"]}}}</tool_call> done'
    for text, args, want in (
        (call, '{"n": 12, "to": {"id": "7.0", "tags": ["a", "b"]}}', (True, True, True, 1.0)),
        (call, '{"n": 12, "to": {"tags": ["a"]}}', (True, False, True, 0.65)),
        (call, '{"n": ""}', (True, False, True, 0.65)),
        (call.replace("pay", "other"), "{}", (False, False, True, 0.25)),
        ("<tool_call><function=pay><parameter=n> 12 </parameter></function></tool_call>", '{"n": 12}', (True, True, True, 0.9)),
        ("<tool_call>broken</tool_call> done", '{"n": 12}', (False, False, False, 0.1)),
    ):
        df = spark.createDataFrame([(text, args)], "t string, a string")
        s = df.select(ps.tool_score(F.col("t"), F.lit("pay"), F.col("a"), F.array(F.lit("done"))).alias("s")).first().s
        assert (s.called, s.matched, s.valid, round(s.score, 6)) == want, text


def test_dispatch(spark):
    df = spark.createDataFrame([("ratio",), ("nope",), (None,)], "f string")
    result, error = rl.dispatched(F.col("f"), {"ratio": rl.ratio(F.lit("10"), F.lit("0.25"))})
    assert [(r.x and float(r.x), r.e) for r in df.select(result.alias("x"), error.alias("e")).collect()] == [(2.5, None), (None, "UNSUPPORTED_FORMULA"), (None, "UNSUPPORTED_FORMULA")]


TURNS = "conv_id long, turn int, role string, text string"


def test_decontaminate(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "Buy now\nA line that is good enough\nA line that is good enough!"), (2, 0, "user", "q"), (2, 1, "assistant", "filler\nfiller two"), (3, 0, "user", "q"), (3, 1, "assistant", "BUY NOW"), (4, 1, "assistant", "this is toxic waste here"), (5, 0, "user", None), (5, 1, "assistant", "A good answer of some length.")]
    done, left = cu.decontaminate(spark.createDataFrame(rows, TURNS), {"bad": "toxic"}, ["buy now"], ["filler.*"])
    got = {r.conv_id: (r.action, r.reasons) for r in done.collect()}
    assert got == {1: ("modify", ["dedupe_lines:1", "drop_line"]), 2: ("drop", ["collapse_filler_only", "too_short_after_clean"]), 3: ("drop", ["drop_line", "empty_after_clean"]), 4: ("drop", ["severe:bad"]), 5: ("keep", [])}
    assert {(r.conv_id, r.turn): r.text for r in left.collect()} == {(1, 0): "q", (1, 1): "A line that is good enough", (5, 0): None, (5, 1): "A good answer of some length."}


def test_reject_reasons_in_order(spark):
    ask, fine = "a question of the user", "an answer with enough text in it"
    rows = [(1, ask, fine), (2, ask, fine), (3, ask, "leak { here and more text"), (4, ask, "soft1 and soft2 in one answer"), (5, ask, "Again and again. " * 3), (6, "buy it all", fine + "!"), (7, ask, "rude words of an answer"), (8, ask, None)]
    turns = spark.createDataFrame([(i, k, r, t) for i, q, a in rows for k, (r, t) in enumerate((("user", q), ("assistant", a)))], TURNS)
    cleaned = cu.cleaned_turns(turns, ["noise"], [])
    gates = cu.Gates(leak=[r"\{"], ticket_soft=["soft1", "soft2"], marketing=["buy"], risk={"rude": ["rude"]})
    got = {r.conv_id: r.reason for r in cu.reject_reason(cleaned, gates).collect()}
    assert got == {1: None, 2: "duplicate", 3: "structured_leak", 4: "ticket_template", 5: "sentence_repetition", 6: "marketing", 7: "risk", 8: "no_reply"}


def test_clean_messages(spark):
    rows = [(1, 0, "System", "rules"), (1, 1, "USER", "hi\r<b>there</b>\nnoise\nx\nx\n 1234567"), (1, 2, "user", "more"), (1, 3, "assistant", "abcdefghijkl" * 20), (1, 4, "assistant", "y" * 1300)]
    got = cu.cleaned_turns(spark.createDataFrame(rows, TURNS), ["^noise"], [("[0-9]{6,}", "<N>")]).collect()
    assert [(r.role, r.text, r.merged) for r in got] == [("user", "hi\nthere\nx\n<N>\nmore", 1)]


def test_dialogues_in_parts(spark):
    turns = spark.createDataFrame([(1, k, "user", f"t{k}") for k in range(2500)] + [(2, 0, "user", "t0")], TURNS)
    a = dl.assemble(turns, part=1000)
    assert sorted((r.conv_id, r.part, len(r.messages)) for r in a.collect()) == [(1, 0, 1000), (1, 1, 1000), (1, 2, 500), (2, 0, 1)]
    assert sorted(map(tuple, dl.explode_turns(a).collect())) == sorted((c, t, r, x) for c, t, r, x in turns.collect())
    assert dl.dialogue_hash(turns).select("hash").distinct().count() == 2


def test_greedy_gates_in_time(spark):
    events = spark.createDataFrame([(i, "k", t) for i, t in enumerate((0, 10, 20, 70, 75, 200))], "event_id long, k string, s long").withColumn("ts", F.timestamp_seconds("s"))
    got = [r.accepted for r in lg.admitted(events, "k", 60, 2).orderBy("event_id").collect()]
    assert got == [True, True, False, True, True, True]
    points = spark.createDataFrame([("k", float(t)) for t in (0, 5, 30, 31, 62)], "k string, at double")
    assert [r.action for r in lg.cooled(points, "k", "at", 30.0).orderBy("at").collect()] == [True, False, True, False, True]


def fed(spark, rows, shape, folder, files):
    """rows written as files one after another, and a stream that takes one a batch."""
    n = -(-len(rows) // files)
    for i in range(files):  # s counts from a day, as rows of the first instant of all are late to begin with
        spark.createDataFrame(rows[i * n : (i + 1) * n], shape).withColumn("ts", F.timestamp_seconds(F.col("s") + 86400)).coalesce(1).write.mode("append").parquet(folder)
    return lambda: spark.readStream.schema(f"{shape}, ts timestamp").option("maxFilesPerTrigger", 1).parquet(folder)


def test_stream_of_breaches(spark, tmp_path):
    rows = [("k", float(t), bad) for t, bad in ((0, 1), (50, 1), (100, 1), (150, 0), (200, 1), (290, 1), (400, 1))]
    order = [3, 0, 1, 2, 5, 4, 6]  # within the watermark, in any order
    stream = fed(spark, [(*rows[i], i) for i in order] + [("z", 9000.0, 0, 9)], "k string, s double, bad int, i int", str(tmp_path / "in"), 4)
    for n, (cooldown, want) in enumerate(((0.0, [(100, 0), (290, 200), (400, 200)]), (150.0, [(100, 0), (290, 200)]))):
        out = streams.drained(streams.breach_alerts(stream(), "k", "i", F.col("bad") == 1, 90.0, cooldown, "500 seconds", 60.0), str(tmp_path / f"o{n}"), str(tmp_path / f"c{n}"))
        assert sorted((int(r["at"]) - 86400, int(r.since) - 86400) for r in out.collect()) == want


def test_stream_of_admissions_over_many_batches_and_a_restart(spark, tmp_path):
    import random

    draw, rows = random.Random(6), []
    for i in range(240):
        rows.append((draw.choice([1, 1, 2, None]), draw.randint(0, 4000) + draw.choice([0.0, 0.5]), i))
    rows.sort(key=lambda r: r[1] + draw.random() * 99)
    shape, folder, late = "k long, s double, i long", str(tmp_path / "in"), (1, 5.0, 998)
    stream = fed(spark, rows[:120], shape, folder, 10)
    made = lambda: streams.admitted(stream(), "k", "i", 60.0, 2, late="100 seconds", slot=50.0)
    place = str(tmp_path / "out"), str(tmp_path / "state")
    before = streams.drained(made(), *place).count()
    # the rest comes after a restart from the checkpoint, with a row that is far too late; a last row moves the watermark on
    fed(spark, [*rows[120:], late, (7, 9000.0, 999)], shape, folder, 10)
    out = streams.drained(made(), *place).collect()
    got = {(r.key, r.id): r.accepted for r in out if r.key != 7}
    assert 0 < before < len(out) == len(got) and (1, 998) not in got and got == plain_gate([(k, t, i) for k, t, i in rows], 60.0, 2)


def test_first_seen_forgets(spark, tmp_path):
    rows = [(f"k{i % 7}", float(i * 40), i) for i in range(100)] + [("end", 90_000.0, 500), ("end", 90_001.0, 501), ("end", 190_000.0, 502)]
    stream = fed(spark, rows, "k string, s double, i long", str(tmp_path / "in"), 5)
    seen = streams.first_seen(stream(), "k", "i", 900.0, late="60 seconds", slot=100.0)
    run = seen.writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    run.awaitTermination()
    got = sorted((r.key, r.id) for r in spark.read.parquet(str(tmp_path / "o")).collect())
    # a key comes every 280 seconds, and so is kept every fourth time
    want = plain_gate([(int(k[1:]), t, i) for k, t, i in rows if k != "end"], 900.0, 1)
    assert got == sorted([(f"k{k}", i) for (k, i), ok in want.items() if ok] + [("end", 500)])
    sizes = [op["numRowsTotal"] for p in run.recentProgress for op in p["stateOperators"]]
    assert max(sizes) > 20 and sizes[-1] < max(sizes) / 2


def test_page_units(spark):
    html = "<html><title> T </title><script>var x = 1;</script><body>" + "word " * 30 + "</body></html>"
    pages = spark.createDataFrame([(1, "http://u", html), (2, "http://v", "<p>" + "other " * 10 + "</p>"), (3, "w", None)], "page_id long, url string, html string")
    got = {r.unit_id: (r.title, r.text) for r in io.page_units(pages).collect()}
    assert got == {"1-0": ("T", "T " + ("word " * 30).strip()), "2-0": ("http://v", ("other " * 10).strip())}


def test_quantiles_equal_sorting(spark):
    draw = np.random.default_rng(2)
    groups = {"a": draw.normal(size=501), "b": np.repeat([1.0, 2.0], [40, 7]), "c": np.array([5.0]), None: draw.integers(0, 9, 60).astype(float)}
    df = spark.createDataFrame([(g, float(x)) for g, v in groups.items() for x in v] + [("a", None), ("d", None)], "g string, x double").repartition(5)
    got = {r.g: (r.p50, r.p95) for r in quantiles(df, ["g"], "x", {"p50": 0.5, "p95": 0.95}, bins=7).collect()}
    near = {r.g: r.p for r in quantiles(df, ["g"], "x", {"p": 0.9}, bins=3, nearest=True).collect()}
    assert set(got) == set(groups) == set(near)
    for g, v in groups.items():
        assert np.allclose(got[g], np.quantile(v, [0.5, 0.95])) and near[g] == np.sort(v)[round(0.9 * (len(v) - 1))]


def test_variants_of_the_registered_query_keep_their_forms(spark):
    from chatloom.plans import dialogue_queries

    assert all(len(form) == 2 for form in dialogue_queries._FORMS)
    assert {name for name, _ in dialogue_queries._FORMS} == {"plain", "please", "short"}


def test_glossary_without_a_pattern_takes_every_text(spark):
    rows = spark.createDataFrame([(1, "one license"), (2, "what license")], "id long, text string")
    entries = [("license", "licence")]
    assert {r.id for r in rt.glossary(rows, F.col("text"), entries).collect()} == {1, 2}
    assert {r.id for r in rt.glossary(rows, F.col("text"), entries, "(?i)what ").collect()} == {2}


def test_scan_in_blocks_equals_brute_force(spark):
    from chatloom.operators import scanning

    rng = np.random.default_rng(3)
    a, b = (np.round(rng.random((n, 12)) * (rng.random((n, 12)) < 0.5), 1) for n in (9, 300))
    long = lambda m, names: spark.createDataFrame([(i, f"t{j}", float(m[i, j])) for i, j in zip(*map(list, np.nonzero(m))) for i, j in [(int(i), int(j))]], names)  # noqa: B905, E731
    q, rows = long(a, ["query_id", "term", "qw"]), rt.rows_of(long(b, ["id", "term", "weight"]))
    score = np.round(a @ b.T, 9)
    want = {(i, int(j)) for i in range(9) for j in np.lexsort((np.arange(300), -score[i]))[:7] if score[i, j] > 0}
    for block, entries in ((256, 50_000), (2, 50_000), (256, 11)):
        got = rt.top(scanning.scan(q, rows, 7, block=block, entries=entries), "query_id", "score", "id", 7)
        assert {(r.query_id, r.id) for r in got.collect()} == want
    assert rt.lexical(q.toDF("id", "term", "weight"), rows.filter("id < 0"), 3).count() == 0


def test_index_by_row_holds_the_same_weights(spark):
    rows = spark.createDataFrame([(1, "a b b"), (2, "b c"), (3, ""), (4, None)], "id long, text string")
    found = rt.words(F.col("text"), 1)
    long, by_row = rt.tfidf(rows, "id", found)[0], rt.tfidf(rows, "id", found, by_row=True)[0]
    flat = by_row.select("id", F.explode("x").alias("e")).select("id", "e.term", "e.weight")
    assert sorted(flat.collect()) == sorted(long.collect())
    v = [{r.id: np.outer(r.v, r.v) for r in pj.project(ix, pj.fit_projection(ix)).collect()} for ix in (long, by_row)]
    assert v[0].keys() == v[1].keys() == {1, 2}


def test_dense_takes_ties_by_id(spark):
    v = spark.createDataFrame([(i, [1.0, 0.0] if i % 3 else [0.6, 0.8]) for i in range(40)], "id long, v array<double>")
    got = rt.dense(v.filter("id = 4"), v, 5, rows=64).orderBy("rank").collect()
    assert [r.id for r in got] == [1, 2, 5, 7, 8]
    assert rt.dense(v.filter("id = 4"), v, 50).count() == 39


@pytest.mark.parametrize("groups", [1, 7])
def test_keys_of_one_group_are_decided_apart(spark, tmp_path, groups):
    rows = [(k, float(1000 + 37 * i), i) for k in range(5) for i in range(k, 60, k + 1)]
    rows.append((9, 90_000.0, 999))  # in the last file, as it moves the watermark on
    stream = fed(spark, rows, "k long, s double, i long", str(tmp_path / "in"), 3)()
    out = streams.drained(streams.admitted(stream, "k", "i", 100.0, 1, late="1 day", slot=60.0, groups=groups), str(tmp_path / "o"), str(tmp_path / "c")).collect()
    want, last = set(), {}
    for k, t, i in sorted(rows, key=lambda r: r[1]):
        if t - last.get(k, -1e9) >= 100.0:
            last[k] = t
            want.add((k, i))
    assert {(r.key, r.id) for r in out if r.accepted} == {w for w in want if w[1] != 999}
    assert len(out) == len(rows) - 1
