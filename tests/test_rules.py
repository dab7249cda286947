"""Known answers of gates, packs and profiles."""

from pyspark.sql import functions as F

from chatloom.functions import text as tx
from chatloom.operators import dialogue as dl
from chatloom.operators import evaluation as ev
from chatloom.operators import logs as lg
from chatloom.operators import quality as ql
from chatloom.operators import retrieval as rt


def test_promotion_is_meant_beside_a_call_to_act(spark):
    said = {"join now for a bonus": True, "a bonus exists": False, "never join for a bonus": False, "do not take a bonus": False, "bonus. then much later, far from it, join": False, "take the bonus, join us": True, "no bonus; join for a bonus": True, "": False}
    df = spark.createDataFrame([(t, w) for t, w in said.items()], "t string, want boolean").select("*", tx.meant(F.col("t"), "bonus", ["not", "no ", "never"], 8, 4, ["join"]).alias("got"))
    assert [(r.t, r.got) for r in df.collect() if r.got != r.want] == []


def test_contaminated_and_curated_texts(spark):
    docs = spark.createDataFrame([(1, "an Idiot here\nfine line"), (2, "same line\nother\nsame line"), (3, "  Analysis: so"), (4, None), (5, "all good")], "id long, text string")
    got = {r.id: (r.groups, r.terms, r.repeated, r.prefixed, r.contaminated) for r in ql.contaminated(docs, "id", F.col("text"), {"insult": ["idiot", "moron"], "law": ["line"]}, "Analysis").collect()}
    assert got == {1: (["insult", "law"], ["idiot", "line"], False, False, True), 2: (["law"], ["line"], True, False, True), 3: ([], [], False, True, True), 4: ([], [], False, False, False), 5: ([], [], False, False, False)}
    pages = spark.createDataFrame([(1, "the first of the lines\nthe 1 2 3 4 5 6 7 8\nshort"), (2, "the one and the other\nscam here"), (3, None), (4, "nothing to be found here")], "id long, text string")
    out = {r.id: (r.kept, r.hits, r.reason) for r in ql.best_lines(pages, "id", F.col("text"), ["the"], banned="scam").collect()}
    assert out == {1: (1, 2, "ok"), 2: (1, 3, "banned"), 3: (0, 0, "no_lines"), 4: (1, 0, "low_relevance")}


def test_verdicts_of_dialogues(spark):
    long = "A reply that is long enough to be kept, as it has over forty characters."
    turns = [(1, "user", "What is the difference between the two of them?"), (1, "assistant", long), (2, "user", "ok"), (2, "assistant", long + " Not in scope."), (3, "user", "Why would that be so, given the rest?"), (3, "assistant", "No."), (4, "assistant", long), (5, "user", "hello there")]
    df = spark.createDataFrame([(c, i, r, t) for i, (c, r, t) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: (r.verdict, r.truncated, r.policy) for r in dl.turn_quality(df, "(?i)^[a-z ]{0,12}$", "(?i)not in", 40, 60).collect()}
    assert got == {1: ("ok", 1, False), 2: ("low_value", 1, True), 3: ("short_reply", 0, False), 4: ("no_user", 1, False), 5: ("no_reply", 0, False)}


def test_profiles_and_glossaries(spark):
    df = spark.createDataFrame([(1, "what is a net win and a parlay"), (2, "net win"), (3, None)], "id long, q string")
    got = {r.id: tuple(r.p) for r in df.select("id", rt.profile(F.col("q"), "and").alias("p")).collect()}
    assert got == {1: (8, 80, True, 1), 2: (5, 40, False, 2), 3: (5, 40, False, 2)}
    entries = [("net win", "NW"), ("win", "NW"), ("parlay", "P"), ("net", "N"), ("a", "A"), ("is", "I"), ("t", "T")]
    assert [(r.id, r["rank"], r.alias) for r in rt.glossary(df, F.col("q"), entries, "what is").orderBy("rank").collect()] == [(1, 1, "net win"), (1, 2, "parlay"), (1, 3, "net"), (1, 4, "is")]


def test_fields_counters_and_packs(spark):
    rows = spark.createDataFrame([("a", 1, None), ("a", 1, 2), ("b", None, None)], "g string, x int, y int")
    required = F.when(F.col("g") == "a", F.array(F.lit("x"), F.lit("y")))
    got = {(r.g, r.field): (r.n, r.rate) for r in ev.field_completeness(rows, "g", {"x": F.col("x").isNotNull(), "y": F.col("y").isNotNull()}, required).collect()}
    assert got == {("a", None): (2, 0.5), ("a", "x"): (2, 1.0), ("a", "y"): (2, 0.5), ("b", None): (1, 1.0)}
    events = spark.createDataFrame([(0, "ok", 3), (5, "ok", None), (9, None, 1), (10, "late", 7)], "s long, status string, n int").withColumn("ts", F.timestamp_seconds("s"))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    out = {(r.kind, r.name): r.n for r in lg.window_counters(events, "1970-01-01 00:00:00", "1970-01-01 00:00:10", {"status": F.col("status")}, {"big": F.col("n") > 2}, {"n": F.col("n")}).collect()}
    assert out == {("status", "ok"): 2.0, ("status", "unknown"): 1.0, ("flag", "big"): 1.0, ("total", "n"): 4.0}
    scored = spark.createDataFrame([(1, 0.5, 1.0), (2, 0.9, None), (3, 0.9, 0.0)], "id long, score double, esc double")
    cases = spark.createDataFrame([(1, "q1"), (2, "q2"), (3, "q3")], "id long, query string")
    pack = sorted((r.id, r.variant, r.prompt, r.reasons) for r in ev.threshold_pack(scored, cases, {"score": 0.8, "esc": 1.0}, F.lit("a"), [("x", "{query}"), ("y", "Now {query}!")]).collect())
    assert pack == [(1, "x", "q1", ["score"]), (1, "y", "Now q1!", ["score"]), (3, "x", "q3", ["esc"]), (3, "y", "Now q3!", ["esc"])]
    teacher = spark.createDataFrame([(1, 0.9, "a"), (2, 0.9, "b"), (3, 0.9, " "), (4, 0.9, "c")], "id long, teacher double, answer string")
    student = spark.createDataFrame([(1, 0.8), (2, 0.6)], "id long, student double")
    assert {r.id: r.weight for r in ev.distilled(teacher, student, "id").collect()} == {1: 2, 2: 4, 4: 4}
    leaks = {r.category: (r.n, r.bad, r.failures, r.size) for r in ev.leak_summary(rows, "g", {"bad": F.col("y").isNull()}, {"size": F.col("x")}).collect()}
    assert leaks == {"a": (2, 0.5, 1, 1.0), "b": (1, 1.0, 1, None), "TOTAL": (3, 2 / 3, 2, 1.0)}
