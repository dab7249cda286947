"""Scores of answers, comparison of runs, gates over repeated runs, leak summaries, and packs that repair what failed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed weights of an answer's parts, and what a risk leaves of its score.
WEIGHTS, RISK = {"intent": 0.40, "escalation": 0.25, "include": 0.20, "exclude": 0.15}, 0.4


def answer_score(parts: dict[str, Column], risk: Column, weights: dict[str, float] | None = None, left: float = RISK) -> Column:
    """The weighted mean of the parts, 0 to 1, that are not null, times `left` on a risk; 0 without parts."""
    weights = weights or WEIGHTS
    there = sum((F.when(parts[n].isNotNull(), F.lit(w)).otherwise(0.0) for n, w in weights.items() if n in parts), F.lit(0.0))
    got = sum((F.coalesce(parts[n].cast("double"), F.lit(0.0)) * w for n, w in weights.items() if n in parts), F.lit(0.0))
    return F.when(there > 0, got / there).otherwise(0.0) * F.when(F.coalesce(risk, F.lit(False)), left).otherwise(1.0)


def share_of_terms(text: Column, terms: Column, empty: float = 1.0) -> Column:
    """The share of terms that a text holds; `empty` without terms."""
    return F.when(F.size(terms) > 0, F.size(F.filter(terms, lambda t: F.contains(text, t))) / F.size(terms)).otherwise(F.lit(empty))


def rubric_share(text: Column, groups: Sequence[Sequence[str]]) -> Column:
    """The share of groups of terms of which a text has one, whatever the case; 0 for a null text."""
    low = F.lower(F.coalesce(text, F.lit("")))
    hit = lambda g: F.exists(F.array(*map(F.lit, g)), lambda t: F.contains(low, t)).cast("int")
    return sum((hit(g) for g in groups), F.lit(0)) / F.lit(float(len(groups)))


def rubric_summary(rows: DataFrame, dimension: str) -> DataFrame:
    """By dimension, of scores a and b: n, the means score and score_b, full_hits (a is 1), wins, wins_b and ties."""
    a, b = F.col("a"), F.col("b")
    return rows.groupBy(dimension).agg(F.count("*").alias("n"), F.avg("a").alias("score"), F.avg("b").alias("score_b"), F.count_if(a == 1).alias("full_hits"), F.count_if(a > b).alias("wins"), F.count_if(b > a).alias("wins_b"), F.count_if(a == b).alias("ties"))


def compare_runs(a: DataFrame, b: DataFrame, id_col: str, category: str, metrics: Sequence[str], score: str = "score", passed: str = "passed", near: float = 1e-9) -> DataFrame:
    """Two runs of the same cases, by category and in all (TOTAL): n, a_better, b_better, ties, both_pass, both_fail, the change of
    each metric's mean from a to b, and decisive, the share of b among cases that aren't ties (null if all are).

    Cases that one run lacks take no part; a null category is its own, named "".
    """
    cols = lambda r, x: r.select(F.col(id_col).alias("id"), *(F.col(c).alias(f"{x}_{c}") for c in dict.fromkeys((score, passed, *metrics))), *([F.coalesce(F.col(category), F.lit("")).alias("category")] if x == "a" else []))
    rows = cols(a, "a").join(cols(b, "b"), "id")
    x, y, p, q = (F.col(f"{r}_{c}") for c in (score, passed) for r in "ab")
    won, lost = F.count_if(y > x + near), F.count_if(x > y + near)
    out = rows.rollup("category").agg(
        F.count("*").alias("n"), lost.alias("a_better"), won.alias("b_better"), F.count_if(F.abs(x - y) <= near).alias("ties"), F.count_if(p & q).alias("both_pass"), F.count_if(~p & ~q).alias("both_fail"),
        *(F.avg(F.col(f"b_{m}") - F.col(f"a_{m}")).alias(f"{m}_delta") for m in metrics), F.when(won + lost > 0, won / (won + lost)).alias("decisive"),
    )
    return out.withColumn("category", F.coalesce("category", F.lit("TOTAL")))


def gate_runs(values: DataFrame, thresholds: Sequence[tuple[str, str, float]], runs: int) -> DataFrame:
    """(level, run, metric, lowest, highest, mean, passed, errors) of values (run, metric, value) beside thresholds (metric, op,
    threshold), op being >= or <=.

    Level run: whether a run keeps all thresholds, and what it breaks; metric: the spread of a metric over the runs; overall: whether
    there are as many runs as there should be and all passed. A metric that a run lacks breaks its threshold.
    """
    gates = F.array(*(F.struct(F.lit(m).alias("metric"), F.lit(op).alias("op"), F.lit(float(t)).alias("threshold")) for m, op, t in thresholds))
    asked = values.select("run").distinct().select("run", F.explode(gates).alias("g")).select("run", "g.*").join(values, ["run", "metric"], "left")
    kept = F.when(F.col("op") == ">=", F.col("value") >= F.col("threshold")).otherwise(F.col("value") <= F.col("threshold"))
    sign = F.when(F.col("op") == ">=", " < ").otherwise(" > ")
    said = F.concat("metric", F.lit("="), F.when(F.col("value").isNull(), "missing").otherwise(F.format_string("%.4f", "value")), sign, F.format_string("%.4f", "threshold"))
    errors = F.array_sort(F.collect_list(F.when(~F.coalesce(kept, F.lit(False)), said)))
    each = asked.groupBy("run").agg(errors.alias("errors"))
    none = F.lit(None)
    number = [none.cast("double").alias(c) for c in ("lowest", "highest", "mean")]
    by_run = each.select(F.lit("run").alias("level"), "run", none.cast("string").alias("metric"), *number, (F.size("errors") == 0).alias("passed"), "errors")
    spread = values.groupBy("metric").agg(F.min("value").alias("lowest"), F.max("value").alias("highest"), F.avg("value").alias("mean"))
    by_metric = spread.select(F.lit("metric").alias("level"), none.cast("int").alias("run"), "metric", "lowest", "highest", "mean", none.cast("boolean").alias("passed"), none.cast("array<string>").alias("errors"))
    count = F.count("*")
    wrong = F.when(count != runs, F.array(F.concat(F.lit("runs="), count.cast("string"), F.lit(f" <> {runs}")))).otherwise(F.array().cast("array<string>"))
    overall = each.agg(((count == runs) & F.coalesce(F.bool_and(F.size("errors") == 0), F.lit(False))).alias("passed"), wrong.alias("errors"))
    overall = overall.select(F.lit("overall").alias("level"), none.cast("int").alias("run"), none.cast("string").alias("metric"), *number, "passed", "errors")
    return by_run.unionByName(by_metric).unionByName(overall)


def leak_summary(answers: DataFrame, category: str, flags: dict[str, Column], means: dict[str, Column]) -> DataFrame:
    """By category and in all (TOTAL): count, the rate of each flag, failures (answers with any flag) and the means; a null category
    is named ""."""
    rows = answers.select(F.coalesce(F.col(category), F.lit("")).alias("category"), *(F.coalesce(c, F.lit(False)).alias(n) for n, c in flags.items()), *(c.cast("double").alias(n) for n, c in means.items()))
    any_ = F.lit(False)
    for n in flags:
        any_ = any_ | F.col(n)
    out = rows.rollup("category").agg(F.count("*").alias("n"), *(F.avg(F.col(n).cast("double")).alias(n) for n in flags), F.count_if(any_).alias("failures"), *(F.avg(n).alias(n) for n in means))
    return out.withColumn("category", F.coalesce("category", F.lit("TOTAL")))


def distilled(teacher: DataFrame, student: DataFrame, id_col: str, least: float = 0.75, gap: float = 0.2, weights: tuple[int, int] = (4, 2)) -> DataFrame:
    """(id, weight) of teacher's rows (id, teacher, answer) beside a student's (id, student): the first weight where the student scores
    under `least` or `gap` or more below the teacher, else the second. A missing student scores 0; empty answers drop out."""
    s = F.coalesce("student", F.lit(0.0))
    rows = teacher.filter(F.trim(F.coalesce("answer", F.lit(""))) != "").join(student, id_col, "left")
    return rows.select(id_col, F.when((s < least) | (F.col("teacher") - s >= gap), weights[0]).otherwise(weights[1]).alias("weight"))


def field_completeness(rows: DataFrame, group: str, present: dict[str, Column], required: Column) -> DataFrame:
    """(group, field, n, coverage, pass_rate): for each group and field how many rows require it and the share of those that have it; in
    the row of no field, how many rows there are and the share that has all it requires. required is an array of names; null
    asks for nothing."""
    has = F.filter(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in present.items())), lambda x: x.isNotNull())
    base = rows.select(F.col(group).alias(group), has.alias("has"), F.coalesce(required, F.array().cast("array<string>")).alias("required"))
    one = lambda field, ok: F.struct(field.alias("field"), ok.cast("int").alias("ok"))
    whole = F.array(one(F.lit(None).cast("string"), F.forall("required", lambda x: F.array_contains("has", x))))
    spread = base.select(group, F.explode(F.concat(whole, F.transform("required", lambda x: one(x, F.array_contains("has", x))))).alias("x"))
    return spread.groupBy(group, "x.field").agg(F.count("*").alias("n"), F.avg("x.ok").alias("rate"))


def threshold_pack(scored: DataFrame, cases: DataFrame, gates: dict[str, float], answer: Column, forms: Sequence[tuple[str, str]]) -> DataFrame:
    """(id, variant, prompt, answer, reasons): answers of which any gated column is under its threshold (null ones pass), joined to
    their cases (id, query), one row for each form (variant, text with {query}); reasons are the names of the gates, in order."""
    failed = F.filter(F.array(*(F.when(F.col(n) < t, F.lit(n)) for n, t in gates.items())), lambda x: x.isNotNull())
    bad = scored.withColumn("reasons", failed).filter(F.size("reasons") > 0).join(cases.select("id", "query"), "id")
    shown = F.array(*(F.struct(F.lit(v).alias("variant"), F.concat(F.lit(f.split("{query}")[0]), F.col("query"), F.lit(f.split("{query}")[1])).alias("prompt")) for v, f in forms))
    return bad.select("id", "reasons", answer.alias("answer"), F.explode(shown).alias("f")).select("id", "f.variant", "f.prompt", "answer", "reasons")


def confusion_pack(failures: DataFrame, cases: DataFrame, targets: Sequence, confusion, chosen: Column, rejected: Column, forms: Sequence[str], cap: int) -> tuple[DataFrame, DataFrame]:
    """Training rows that teach what was confused, and (counter, n) of what became of the failures.

    failures: (id, gold, pred, request_ok); cases: (id, query, must), must being an array of terms. Failures whose gold is among the
    targets and that were taken for `confusion`, of requests that went well, are joined to their cases; those without one, or with
    an empty query, drop out. Of each gold at most `cap` stay, by md5 of the id. chosen and rejected are expressions over (id, gold,
    pred, query, must); where a case has terms and chosen holds none of them, it drops out. Every other one gives a sft and a dpo
    row for each form, whose {query} is the case's: (row_id, kind, prompt, chosen, rejected, id, gold).
    """
    meant = failures.filter(F.col("gold").isin(*targets) & (F.col("pred") == F.lit(confusion)) & F.col("request_ok"))
    joined = meant.join(cases, "id", "left")
    query = F.trim(F.coalesce("query", F.lit("")))
    fate = F.when(F.col("must").isNull() & F.col("query").isNull(), "missing_case").when(query == "", "no_query").otherwise("pool")
    pool = joined.withColumn("fate", fate)
    n = F.row_number().over(Window.partitionBy("gold").orderBy(F.md5(F.col("id").cast("string")), "id"))
    kept = pool.filter("fate = 'pool'").withColumn("query", query).withColumn("n", n).filter(F.col("n") <= cap)
    made = kept.withColumn("chosen", chosen).withColumn("rejected", rejected)
    fits = (F.size("must") == 0) | F.exists("must", lambda t: F.contains(F.col("chosen"), t))
    made = made.withColumn("fits", F.coalesce(fits, F.lit(True)))
    shown = F.array(*(F.struct(F.lit(k + 1).alias("k"), F.concat(F.lit(f.split("{query}")[0]), F.col("query"), F.lit(f.split("{query}")[1])).alias("prompt")) for k, f in enumerate(forms)))
    rows = made.filter("fits").withColumn("f", F.explode(shown)).withColumn("kind", F.explode(F.array(F.lit("sft"), F.lit("dpo"))))
    row_id = F.concat_ws("_", "kind", F.col("gold").cast("string"), F.col("id").cast("string"), F.lpad(F.col("f.k").cast("string"), 2, "0"))
    rows = rows.select(row_id.alias("row_id"), "kind", "f.prompt", "chosen", F.when(F.col("kind") == "dpo", F.col("rejected")).alias("rejected"), "id", "gold")
    counters = pool.groupBy(F.col("fate").alias("counter")).agg(F.count("*").alias("n")).unionByName(made.filter("not fits").agg(F.lit("quality").alias("counter"), F.count("*").alias("n")))
    return rows, counters.unionByName(rows.groupBy(F.concat(F.lit("rows_"), F.col("kind")).alias("counter")).agg(F.count("*").alias("n"))).filter("n > 0")
