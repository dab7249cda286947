"""Evaluation, log, rule and curation queries over the given tables, with SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.operators import evaluation as ev
from chatloom.operators import logs as lg
from chatloom.operators import rules as rl
from chatloom.operators.quantiles import quantiles

from .common import chain_sql, table
from .dialogue_queries import _PREDS, predictions, preds_sql

QUERIES, SQL = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def r6(c):
    return F.round(c, 6)


def _percentiles(rows, group):
    found = quantiles(rows, group, "value", {"p50": 0.5, "p95": 0.95})
    return found.select(*group, *(r6(F.col(p)).alias(p) for p in ("p50", "p95")))


_PCT = ", ".join(f"round(quantile_cont(value, {q}), 6) as p{int(q * 100)}" for q in (0.5, 0.95))


@query(f"select event_type as mode, count(*) as n, round(avg(case when event_type = 'error' then 0.0 else 1.0 end), 6) as ok_rate, round(avg(value), 6) as mean, {_PCT} from events group by event_type")
def EVL4_mode_metrics(spark, d):
    e = table(spark, d, "events")
    means = e.groupBy("event_type").agg(F.count("*").alias("n"), r6(F.avg(F.when(F.col("event_type") == "error", 0.0).otherwise(1.0))).alias("ok_rate"), r6(F.avg("value")).alias("mean"))
    return means.join(_percentiles(e, ["event_type"]), "event_type").withColumnRenamed("event_type", "mode")


@query("""with a as (select user_id, sum(value) as x from events where event_type = 'click' group by user_id), b as (select user_id, sum(value) as x from events where event_type = 'view' group by user_id)
select user_id, round(coalesce(a.x, 0), 6) as a, round(coalesce(b.x, 0), 6) as b, round(coalesce(b.x, 0) - coalesce(a.x, 0), 6) as delta from a full join b using (user_id)""")
def EVL5_paired_deltas(spark, d):
    e = table(spark, d, "events")
    side = lambda t, n: e.filter(F.col("event_type") == t).groupBy("user_id").agg(F.sum("value").alias(n))
    a, b = F.coalesce("a", F.lit(0.0)), F.coalesce("b", F.lit(0.0))
    return side("click", "a").join(side("view", "b"), "user_id", "full").select("user_id", r6(a).alias("a"), r6(b).alias("b"), r6(b - a).alias("delta"))


@query("""with r as (select event_type, value, row_number() over (partition by event_type order by value) as i, count(*) over (partition by event_type) as n from events)
select event_type, round(max(case when i = cast(round_even((n - 1) * 0.95::double, 0) as bigint) + 1 then value end), 6) as nearest, round(quantile_cont(value, 0.95), 6) as linear from r group by event_type""")
def EVL6_percentiles(spark, d):
    e = table(spark, d, "events").select("event_type", "value")
    near = quantiles(e, ["event_type"], "value", {"nearest": 0.95}, nearest=True)
    linear = quantiles(e, ["event_type"], "value", {"linear": 0.95})
    return near.join(linear, "event_type").select("event_type", r6(F.col("nearest")).alias("nearest"), r6(F.col("linear")).alias("linear"))


_RUBRIC = [["license", "copyright"], ["the", "der", "que"]]


def _rubric_sql(x: str) -> str:
    return "(" + " + ".join(f"case when regexp_matches(lower({x}), '{'|'.join(g)}') then 1 else 0 end" for g in _RUBRIC) + f") / {len(_RUBRIC)}.0::double"


@query(f"""with g as (select source, {_rubric_sql('text')} as a, {_rubric_sql('string_split(text, chr(10))[1]')} as b from documents)
select source, count(*) as n, round(avg(a), 6) as score, round(avg(b), 6) as score_b, count(*) filter (where a = 1) as full_hits, count(*) filter (where a > b) as wins, count(*) filter (where b > a) as wins_b, count(*) filter (where a = b) as ties from g group by source""")
def EVL8_rubric(spark, d):
    """Whole texts beside their first lines, by the groups of words that they have one of."""
    docs = table(spark, d, "documents").select("source", ev.rubric_share(F.col("text"), _RUBRIC).alias("a"), ev.rubric_share(F.split("text", "\n")[0], _RUBRIC).alias("b"))
    return ev.rubric_summary(docs, "source").select("source", "n", r6(F.col("score")).alias("score"), r6(F.col("score_b")).alias("score_b"), "full_hits", "wins", "wins_b", "ties")


def _scored_sql(every: int = 7, x: str = "") -> str:
    return f"""p{x} as ({preds_sql(every)}), s{x} as (select *, case when gold = pred then 1.0::double else 0.0::double end as intent, case when contains(lower(text), 'the') then 1.0::double else 0.0::double end as incl,
case when doc_id % 3 = 0 then null when (toxic = 1) = regexp_matches(lower(text), 'idiot|moron|scum') then 1.0::double else 0.0::double end as esc,
case when contains(lower(text), 'password') then 0.0::double else 1.0::double end as excl, contains(lower(text), 'idiot') as risk from p{x}),
sc{x} as (select *, (0.4::double * intent + 0.25::double * coalesce(esc, 0) + 0.2::double * incl + 0.15::double * excl) / (0.75::double + case when esc is null then 0.0::double else 0.25::double end) * case when risk then 0.4::double else 1.0::double end as score from s{x})"""


_SCORED = _scored_sql()


def _scored(spark, d, every: int = 7):
    """Answers with their parts and score. Whether to escalate is told by the toxicity label, and not known for every third one."""
    t, one = F.lower("text"), lambda c: F.when(c, 1.0).otherwise(0.0)
    esc = F.when(F.col("doc_id") % 3 == 0, None).otherwise(one((F.col("toxic") == 1) == t.rlike("idiot|moron|scum")))
    p = predictions(spark, d, every).withColumns({"intent": one(F.col("gold") == F.col("pred")), "esc": esc, "incl": ev.share_of_terms(t, F.array(F.lit("the"))), "excl": one(~F.contains(t, F.lit("password"))), "risk": F.contains(t, F.lit("idiot"))})
    return p.withColumn("score", ev.answer_score({"intent": F.col("intent"), "escalation": F.col("esc"), "include": F.col("incl"), "exclude": F.col("excl")}, F.col("risk")))


_PACK_FORMS = [("plain", "{query}"), ("polite", "Please: {query}"), ("again", "{query} Once more, please.")]


@query(f"""with {_SCORED}, f as (select doc_id as id, list_filter([case when score < 0.8 then 'score' end, case when intent < 1 then 'intent' end, case when esc < 1 then 'esc' end, case when incl < 1 then 'incl' end], lambda x: x is not null) as reasons, gold, trim(string_split(text, chr(10))[1]) as query from sc)
select id, v.variant, v.a || query || v.b as prompt, 'class ' || gold as answer, reasons from f, (values ('plain', '', ''), ('polite', 'Please: ', ''), ('again', '', ' Once more, please.')) v(variant, a, b) where len(reasons) > 0""")
def FBK2_threshold_repair(spark, d):
    """Answers under any gate (score, intent, escalation, include), three rows each."""
    rows = _scored(spark, d).withColumn("id", F.col("doc_id"))
    cases = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.trim(F.split("text", "\n")[0]).alias("query"))
    return ev.threshold_pack(rows, cases, {"score": 0.8, "intent": 1.0, "esc": 1.0, "incl": 1.0}, F.concat(F.lit("class "), F.col("gold").cast("string")), _PACK_FORMS)


@query(f"with {_SCORED} select doc_id, round(score, 4) as score from sc")
def EVL9_answer_score(spark, d):
    return _scored(spark, d).select("doc_id", F.round("score", 4).alias("score"))


@query(f"with {_SCORED} select lang, count(*) as n, round(avg(intent), 6) as accuracy, round(avg(score), 6) as score, count(*) filter (where score < 0.6 or risk) as failures, round(quantile_cont(n_chars::double, 0.95), 6) as p95 from sc group by lang")
def EVL10_summary(spark, d):
    rows = _scored(spark, d)
    means = rows.groupBy("lang").agg(F.count("*").alias("n"), r6(F.avg("intent")).alias("accuracy"), r6(F.avg("score")).alias("score"), F.count_if((F.col("score") < 0.6) | F.col("risk")).alias("failures"))
    p95 = quantiles(rows, ["lang"], "n_chars", {"p95": 0.95}).select(F.col("lang").alias("of"), r6(F.col("p95")).alias("p95"))
    return means.join(p95, F.col("lang").eqNullSafe(F.col("of")), "left").drop("of")


_LINES = "list_filter(list_transform(string_split(text, chr(10)), lambda l: trim(l)), lambda l: length(l) >= 4)"


@query(f"""with a as (select lang, regexp_matches(text, '(?i)idiot|moron') as forbidden, len({_LINES}) > len(list_distinct({_LINES})) as repetition, regexp_matches(text, '^[ \\t\\n]*(Analysis|Thinking|The|Der)') as prefix, regexp_matches(text, '(?i)</?think>') as leak,
(case when contains(text, 'the') then 1 else 0 end + case when contains(text, 'der') then 1 else 0 end) / 2.0::double as must_include, n_chars::double as length from documents)
select coalesce(lang, 'TOTAL') as category, count(*) as n, round(avg(forbidden::int), 6) as forbidden, round(avg(repetition::int), 6) as repetition, round(avg(prefix::int), 6) as prefix, round(avg(leak::int), 6) as leak,
count(*) filter (where forbidden or repetition or prefix or leak) as failures, round(avg(must_include), 6) as must_include, round(avg(length), 6) as length from a group by rollup(lang)""")
def EVL11_leak_summary(spark, d):
    """Forbidden words, lines that repeat, analysis prefixes and think tags, and the share of wanted words, by language and in all."""
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: F.trim(x)), lambda x: F.length(x) >= 4)
    flags = {"forbidden": F.col("text").rlike("(?i)idiot|moron"), "repetition": F.size(lines) > F.size(F.array_distinct(lines)), "prefix": F.col("text").rlike(r"^[ \t\n]*(Analysis|Thinking|The|Der)"), "leak": F.col("text").rlike("(?i)</?think>")}
    out = ev.leak_summary(table(spark, d, "documents"), "lang", flags, {"must_include": ev.share_of_terms(F.col("text"), F.array(F.lit("the"), F.lit("der"))), "length": F.col("n_chars")})
    return out.select("category", "n", *(r6(F.col(c)).alias(c) for c in flags), "failures", *(r6(F.col(c)).alias(c) for c in ("must_include", "length")))


@query(f"""with {_scored_sql(7, 'a')}, {_scored_sql(5, 'b')}, j as (select a.lang, a.score as x, b.score as y, a.score >= 0.6 and not a.risk as p, b.score >= 0.6 and not b.risk as q, b.intent - a.intent as di from sca a join scb b using (doc_id)),
r as (select coalesce(lang, 'TOTAL') as category, count(*) as n, count(*) filter (where x > y + 1e-9) as a_better, count(*) filter (where y > x + 1e-9) as b_better, count(*) filter (where abs(x - y) <= 1e-9) as ties, count(*) filter (where p and q) as both_pass, count(*) filter (where not p and not q) as both_fail,
round(avg(y - x), 6) as score_delta, round(avg(di), 6) as intent_delta from j group by rollup(lang))
select *, case when a_better + b_better > 0 then round(b_better / (a_better + b_better)::double, 6) end as decisive from r""")
def EVL12_run_comparison(spark, d):
    """Two runs: predictions flipped for every seventh document, and for every fifth."""
    run = lambda every: _scored(spark, d, every).withColumn("passed", (F.col("score") >= 0.6) & ~F.col("risk"))
    out = ev.compare_runs(run(7), run(5), "doc_id", "lang", ["score", "intent"])
    return out.select("category", "n", "a_better", "b_better", "ties", "both_pass", "both_fail", *(r6(F.col(c)).alias(c) for c in ("score_delta", "intent_delta", "decisive")))


#: Checks of every prediction: terms of which one, all and none must be said. Every tenth id is asked for once more as one that no
#: prediction has.
_CHECKS = [("mark", ["license", "reserved"], [], []), ("words", [], ["the", "a n d"], []), ("manners", [], [], ["idiot", "moron"]), ("number", ["7", "12"], [], ["2024"])]


def _said_sql(term: str) -> str:
    return f"regexp_matches(t, '(^|[^0-9]){term}([^0-9]|$)')" if any(c.isdigit() for c in term) else f"contains(t, '{term.replace(' ', '')}')"


def _check_sql(name: str, any_: list[str], all_: list[str], none: list[str]) -> str:
    fails = [f"not ({' or '.join(map(_said_sql, any_))})" if any_ else "false", " or ".join(f"not {_said_sql(x)}" for x in all_) or "false", " or ".join(map(_said_sql, none)) or "false"]
    cases = " ".join(f"when {c} then '{n}'" for c, n in zip(["t is null", *fails], ["missing_prediction", "any", "all", "none"], strict=True))
    return f"select id, '{name}' as check_id, case {cases} end as reason from a"


_CHECKED = f"""a as (select doc_id as id, regexp_replace(lower(text), '[ \\t\\n\\x0B\\f\\r]+', '', 'g') as t from ({_PREDS}) union all select -1 - doc_id, null from ({_PREDS}) where doc_id % 10 = 0),
k as ({' union all '.join(_check_sql(*c) for c in _CHECKS)})"""


def _checked(spark, d):
    rows = predictions(spark, d)
    asked = rows.select(F.col("doc_id").alias("id")).union(rows.filter("doc_id % 10 = 0").select(-1 - F.col("doc_id")))
    lists = F.array(*(F.struct(F.lit(n).alias("check_id"), *(F.array(*map(F.lit, x)).cast("array<string>").alias(c) for c, x in zip(("any", "all", "none"), terms, strict=True))) for n, *terms in _CHECKS))
    return rl.rule_checks(rows, asked.select("id", F.explode(lists).alias("c")).select("id", "c.*"), "doc_id", "text")


@query(f"with {_CHECKED} select id, check_id, reason is null as passed, reason from k")
def EVL13_rule_checks(spark, d):
    return _checked(spark, d)


@query(f"with {_CHECKED} select check_id, count(*) as checks, count(*) filter (where reason is null) as passed, round(count(*) filter (where reason is null)::double / count(*), 6) as pass_rate from k group by check_id")
def EVL13_pass_rate(spark, d):
    return _checked(spark, d).groupBy("check_id").agg(F.count("*").alias("checks"), F.count_if("passed").alias("passed"), r6(F.count_if("passed") / F.count("*")).alias("pass_rate"))


@query(f"with {_SCORED} select doc_id, round(0.5::double * incl + 0.2::double * excl + 0.15::double * intent + 0.15::double * case when risk then 0 else 1 end, 6) as score from sc")
def EVL15_knowledge_score(spark, d):
    return _scored(spark, d).select("doc_id", r6(0.5 * F.col("incl") + 0.2 * F.col("excl") + 0.15 * F.col("intent") + 0.15 * F.when(F.col("risk"), 0).otherwise(1)).alias("score"))


_K = "cast(json_extract_string(props, '$.k') as bigint)"


@query(f"""with e as (select event_type, list_filter([case when {_K} >= 20 then 'k' end, case when value >= 5 then 'value' end, case when user_id % 4 > 0 then 'user' end], lambda x: x is not null) as has,
list_concat(['k'], case when event_type = 'error' then ['value', 'user'] when user_id % 2 = 0 then ['user'] else [] end) as req from events),
x as (select event_type, null as field, len(list_filter(req, lambda f: not list_contains(has, f))) = 0 as ok from e union all select event_type, f, list_contains(has, f) from (select event_type, has, unnest(req) as f from e))
select event_type, field, count(*) as n, round(avg(ok::int), 6) as rate from x group by event_type, field""")
def EVL16_field_completeness(spark, d):
    """Fields of events: all need a k of 20 or more, errors a value and a user that is known, others of even users the latter."""
    k = F.get_json_object("props", "$.k").cast("long")
    required = F.concat(F.array(F.lit("k")), F.when(F.col("event_type") == "error", F.array(F.lit("value"), F.lit("user"))).when(F.col("user_id") % 2 == 0, F.array(F.lit("user"))).otherwise(F.array().cast("array<string>")))
    out = ev.field_completeness(table(spark, d, "events"), "event_type", {"k": k >= 20, "value": F.col("value") >= 5, "user": F.col("user_id") % 4 > 0}, required)
    return out.withColumn("rate", r6(F.col("rate")))


#: Three runs, with every seventh, fifth and third prediction flipped, and what each must keep.
_RUNS, _GATE = (7, 5, 3), [("accuracy", ">=", 0.78), ("escalation", ">=", 0.5), ("score", ">=", 0.7), ("failures", "<=", 0.3)]
_GATED = ", ".join(_scored_sql(e, str(i)) for i, e in enumerate(_RUNS)) + ", m as (" + " union all ".join(f"select {i + 1} as run, avg(intent) as accuracy, avg(esc) as escalation, avg(score) as score, avg(case when score < 0.6 or risk then 1.0::double else 0.0::double end) as failures from sc{i}" for i in range(len(_RUNS))) + ")"
_ERRORS = ", ".join(f"case when not coalesce({m} {op} {t}, false) then '{m}=' || coalesce(printf('%.4f', {m}), 'missing') || ' {'<' if op == '>=' else '>'} {t:.4f}' end" for m, op, t in _GATE)


@query(f"""with {_GATED}, e as (select run, list_sort(list_filter([{_ERRORS}], lambda x: x is not null)) as errors from m)
select 'run' as level, run, null as metric, null::double as lowest, null::double as highest, null::double as mean, len(errors) = 0 as passed, errors from e
""" + "".join(f"union all select 'metric', null, '{m}', round(min({m}), 6), round(max({m}), 6), round(avg({m}), 6), null, null from m " for m, *_ in _GATE) + "union all select 'overall', null, null, null, null, null, count(*) = 3 and bool_and(len(errors) = 0), [] from e")
def EVL17_threshold_gate(spark, d):
    """Release gate over three runs: what each breaks, how far metrics spread, and the verdict over all."""
    rows = None
    for i, every in enumerate(_RUNS):
        bad = F.when((F.col("score") < 0.6) | F.col("risk"), 1.0).otherwise(0.0)
        m = _scored(spark, d, every).agg(F.avg("intent").alias("accuracy"), F.avg("esc").alias("escalation"), F.avg("score").alias("score"), F.avg(bad).alias("failures"))
        one = m.select(F.lit(i + 1).alias("run"), F.explode(F.array(*(F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n, *_ in _GATE))).alias("v")).select("run", "v.*")
        rows = one if rows is None else rows.unionByName(one)
    out = ev.gate_runs(rows, _GATE, len(_RUNS))
    return out.select("level", "run", "metric", *(r6(F.col(c)).alias(c) for c in ("lowest", "highest", "mean")), "passed", "errors")


_TERMS = ["license", "password", "idiot", "nowhere"]


@query("select t.term, count(d.doc_id) as rows from (values " + ", ".join(f"('{t}')" for t in _TERMS) + ") t(term) left join documents d on contains(lower(d.text), t.term) group by t.term")
def EVL21_term_coverage(spark, d):
    counts = table(spark, d, "documents").agg(*(F.count_if(F.contains(F.lower("text"), F.lit(t))).alias(t) for t in _TERMS))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(t).alias("term"), F.col(t).alias("rows")) for t in _TERMS))).alias("r")).select("r.*")


@query(f"select gold, pred, lang, count(*) as n from ({_PREDS}) group by grouping sets ((gold, pred), (lang))")
def EVL22_confusion(spark, d):
    return predictions(spark, d).groupingSets([[F.col("gold"), F.col("pred")], [F.col("lang")]], "gold", "pred", "lang").agg(F.count("*").alias("n"))


def _ok():
    return F.col("event_type") != "error"


_A, _B = "2024-01-10 00:00:00", "2024-01-15 00:00:00"


@query(f"select count(*) as events, count(*) filter (where event_type <> 'error') as ok, count(distinct user_id) as keys, round(sum(value), 6) as value from events where ts >= '{_A}' and ts < '{_B}'")
def LOG1_window_summary(spark, d):
    return lg.summary(table(spark, d, "events"), _A, _B, _ok()).withColumn("value", r6(F.col("value")))


_IN = f"from events where ts >= '{_A}' and ts < '{_B}'"


@query(f"""with x as (select 'status' as kind, case when event_type = 'error' then 'error' else 'ok' end as name, 1.0::double as n {_IN} union all select 'route', event_type, 1 {_IN} union all select 'key', (user_id % 10)::varchar, 1 {_IN}
union all select 'flag', 'slow', (value > 100)::int {_IN} union all select 'flag', 'traced', ({_K} >= 50)::int {_IN} union all select 'total', 'trace', {_K} {_IN}) select kind, name, sum(n) as n from x group by kind, name""")
def LOG1_counters(spark, d):
    """Events of the window by status, route and key group, with flags and the sum of traced steps."""
    k = F.get_json_object("props", "$.k").cast("long")
    names = {"status": F.when(_ok(), "ok").otherwise("error"), "route": F.col("event_type"), "key": F.col("user_id") % 10}
    return lg.window_counters(table(spark, d, "events"), _A, _B, names, {"slow": F.col("value") > 100, "traced": k >= 50}, {"trace": k})


@query(f"""with c as (select count(*) filter (where ts >= '{_A}') as events, count(*) filter (where ts < '{_A}') as events_before, count(*) filter (where ts >= '{_A}' and event_type <> 'error') as ok, count(*) filter (where ts < '{_A}' and event_type <> 'error') as ok_before from events where ts >= '2024-01-05' and ts < '{_B}')
select *, events - events_before as events_delta, ok - ok_before as ok_delta from c""")
def LOG2_window_comparison(spark, d):
    return lg.compare_windows(table(spark, d, "events"), _A, _B, _ok())


@query("select user_id, arg_max(event_type, (ts, event_id)) as last_type, arg_max(event_id, (ts, event_id)) filter (where event_type = 'error') as last_error, arg_max(event_type, (ts, event_id)) <> 'error' as recovered from events group by user_id".replace("(ts, event_id)", "epoch_us(ts)::hugeint * 1000000 + event_id"))
def LOG3_latest_state(spark, d):
    at = F.struct("ts", "event_id")
    return table(spark, d, "events").groupBy("user_id").agg(F.max_by("event_type", at).alias("last_type"), F.max_by(F.when(~_ok(), F.col("event_id")), F.when(~_ok(), at)).alias("last_error")).withColumn("recovered", F.col("last_type") != "error")


@query("""with c as (select event_type, user_id, count(*) as n from events group by all), r as (select *, row_number() over (partition by event_type order by n desc, user_id) as rank from c) select event_type, user_id, n, cast(rank as int) as rank from r where rank <= 3""")
def LOG4_top_counts(spark, d):
    return lg.top_counts(table(spark, d, "events"), ["event_type"], "user_id")


@query("""with a as (select unnest(list_filter([case when value < 10 then 'low' end, case when json_extract_string(props, '$.k') is null then 'no_k' end, event_type], lambda x: x is not null and x <> '')) as field from events) select field, count(*) as n from a group by field""")
def LOG5_array_counters(spark, d):
    fields = F.array(F.when(F.col("value") < 10, "low"), F.when(F.get_json_object("props", "$.k").isNull(), "no_k"), F.col("event_type"))
    return table(spark, d, "events").select(F.explode(F.filter(fields, lambda x: x.isNotNull() & (x != ""))).alias("field")).groupBy("field").agg(F.count("*").alias("n"))


@query(f"select event_type, round(avg(value), 6) as mean, {_PCT} from events where value is not null group by event_type")
def LOG6_latency(spark, d):
    e = table(spark, d, "events").filter("value is not null")
    return e.groupBy("event_type").agg(r6(F.avg("value")).alias("mean")).join(_percentiles(e, ["event_type"]), "event_type")


@query("select event_id, event_type, user_id from events where event_type = 'error' order by ts desc, event_id desc limit 20")
def LOG8_newest(spark, d):
    return table(spark, d, "events").filter("event_type = 'error'").orderBy(F.desc("ts"), F.desc("event_id")).limit(20).select("event_id", "event_type", "user_id")


@query("""with l as (select user_id, epoch_us(ts)::hugeint * 1000000 + event_id as pos, case when event_type <> 'view' then 'step ' || json_extract_string(props, '$.k') || '/100 loss=' || value else event_type end as line from events),
p as (select user_id, pos, try_cast(nullif(regexp_extract(line, 'step ([0-9]+)/([0-9]+)', 1), '') as bigint) as step, try_cast(nullif(regexp_extract(line, 'loss=([0-9.]+)', 1), '') as double) as loss from l)
select user_id, arg_max(step, pos) filter (where step is not null) as step, round(arg_max(loss, pos) filter (where loss is not null), 6) as loss, count(step) as lines from p group by user_id""")
def LOG8_latest_steps(spark, d):
    """The latest step that each user's log lines tell, and the last loss that isn't missing."""
    line = F.when(F.col("event_type") != "view", F.concat(F.lit("step "), F.get_json_object("props", "$.k"), F.lit("/100 loss="), F.col("value").cast("string"))).otherwise(F.col("event_type"))
    rows = table(spark, d, "events").select("user_id", F.struct("ts", "event_id").alias("at"), line.alias("line"))
    return lg.latest_steps(rows, "user_id", "at", "line", {"loss": "loss=([0-9.]+)"}).select("user_id", "step", r6(F.col("loss")).alias("loss"), "lines")


@query("select event_id, user_id, count(*) over (partition by user_id order by ts range between interval 3600 seconds preceding and current row) as recent from events")
def LOG9_trailing_count(spark, d):
    return lg.trailing_count(table(spark, d, "events"), "user_id", 3600).select("event_id", "user_id", "recent")


_AT = "select user_id as key, event_id as id, epoch(ts) as tm, event_type from events"


@query(f"with recursive e as ({_AT}), {chain_sql('e', 6 * 3600.0)} select e.id as event_id, e.key as user_id, c.key is not null as accepted from e left join c on c.key = e.key and c.x.id = e.id")
def LOG9_admission(spark, d):
    return lg.admitted(table(spark, d, "events"), "user_id", 6 * 3600, 1)


_POINTS = "select cast(floor(epoch(ts) / 21600) * 21600 as bigint) as slot, count(*) as n, avg(case when event_type = 'error' then 0.0::double else 1.0::double end) as ok_rate, quantile_cont(value, 0.95) as p95 from events group by 1"


def _points(spark, d):
    slot = (F.floor(lg.seconds_of(F.col("ts")) / 21600) * 21600).cast("long")
    rows = table(spark, d, "events").withColumn("slot", slot)
    counts = rows.groupBy("slot").agg(F.count("*").alias("n"), F.avg(F.when(_ok(), 1.0).otherwise(0.0)).alias("ok_rate"))
    return counts.join(quantiles(rows, ["slot"], "value", {"p95": 0.95}), "slot", "left")


@query(f"with p as ({_POINTS}) select slot, list_filter([case when ok_rate < 0.8 then 'ok_rate' end, case when p95 > 150 then 'p95' end], lambda x: x is not null) as breaches from p")
def LOG10_breaches(spark, d):
    found = F.array(F.when(F.col("ok_rate") < 0.8, "ok_rate"), F.when(F.col("p95") > 150, "p95"))
    return _points(spark, d).select("slot", F.filter(found, lambda x: x.isNotNull()).alias("breaches"))


@query(f"with p as ({_POINTS}) select slot, count(*) over w >= 3 and bool_and(ok_rate < 0.82) over w as sustained from p window w as (order by slot range between 64800 preceding and current row)")
def LOG11_sustained(spark, d):
    points = _points(spark, d).withColumn("key", F.lit("all"))
    return lg.sustained(points, "slot", F.col("ok_rate") < 0.82, 64800, 3).select("slot", "sustained")


@query(f"with recursive e as (select * from ({_AT}) where event_type = 'error'), {chain_sql('e', 2 * 86400.0)} select e.key, e.tm as \"at\", c.key is not null as action from e left join c on c.key = e.key and c.x.id = e.id")
def LOG12_cooldown(spark, d):
    errors = table(spark, d, "events").filter(~_ok()).select("user_id", lg.seconds_of(F.col("ts")).alias("at"))
    return lg.cooled(errors, "user_id", "at", 2 * 86400.0)


_RULES = [("legal", "licen[sc]e|copyright"), ("abuse", "idiot|moron|scum"), ("noise", "!!|%%%"), ("plain", "the|der|que|les")]


@query("select doc_id, case " + " ".join(f"when regexp_matches(text, '(?i){p}') then '{n}'" for n, p in _RULES) + " else 'other' end as label from documents")
def RUL1_first_match(spark, d):
    return table(spark, d, "documents").select("doc_id", rl.first_match(F.col("text"), _RULES, "other").alias("label"))


_ALIASES = [("purchase order", "buy"), ("sign", "join"), ("view", "look"), ("err", "fail")]


@query("select event_id, case when lower(trim(event_type)) = '' then 'other' " + " ".join(f"when contains(lower(trim(event_type)), '{a}') or contains('{a}', lower(trim(event_type))) then '{n}'" for a, n in _ALIASES) + " else 'other' end as label from events")
def RUL2_alias(spark, d):
    return table(spark, d, "events").select("event_id", rl.canonical(F.col("event_type"), _ALIASES).alias("label"))


@query(f"""with p as ({_PREDS}) select doc_id, case when contains(lower(text), 'idiot') then 1 else pred end as pred, list_filter([case when contains(lower(text), 'idiot') then 'intent_override' end, case when contains(lower(text), 'password') then 'forced_escalation' end], lambda x: x is not null) as notes from p""")
def RUL3_repair_pass(spark, d):
    rude, secret = F.contains(F.lower("text"), F.lit("idiot")), F.contains(F.lower("text"), F.lit("password"))
    notes = F.filter(F.array(F.when(rude, "intent_override"), F.when(secret, "forced_escalation")), lambda x: x.isNotNull())
    return predictions(spark, d).select("doc_id", F.when(rude, 1).otherwise(F.col("pred")).alias("pred"), notes.alias("notes"))


@query("select item_id, case when regexp_matches(text, '[0-9]+ *[x*] *[0-9]+') then 'calculate' when regexp_matches(lower(text), 'what|how|why') then 'knowledge' else 'chat' end as route from benchmark")
def RUL4_route(spark, d):
    return table(spark, d, "benchmark").select("item_id", F.when(F.col("text").rlike("[0-9]+ *[x*] *[0-9]+"), "calculate").when(F.lower("text").rlike("what|how|why"), "knowledge").otherwise("chat").alias("route"))


@query("""select l_orderkey, l_linenumber, round(l_extendedprice::decimal(18,2) * (1 + l_discount)::decimal(4,2), 2)::double as gross, round(l_extendedprice::decimal(18,2) * l_discount::decimal(4,2), 2)::double as net,
case when l_discount <= 0 then 'OUT_OF_RANGE' end as error from lineitem where l_discount > 0 union all select l_orderkey, l_linenumber, null, null, 'OUT_OF_RANGE' from lineitem where l_discount <= 0""")
def RUL6_payout(spark, d):
    gross, net, error = rl.european(F.col("l_extendedprice"), 1 + F.col("l_discount").cast("decimal(4,2)"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", gross.cast("double").alias("gross"), net.cast("double").alias("net"), error.alias("error"))


_PARLAY = "list_reduce(list_transform(odds, lambda x: x::decimal(18,8)), lambda a, x: round(a * x, 8)::decimal(18,8))"


@query(f"""with o as (select l_orderkey, list((1 + l_discount + case when l_linenumber = 7 then 0 else 0.01 end)::decimal(10,4) order by l_linenumber) as odds, sum(l_quantity)::decimal(14,2) as stake from lineitem group by l_orderkey)
select l_orderkey, len(odds)::int as legs, case when len(list_filter(odds, lambda x: x <= 1)) = 0 then round(round({_PARLAY}, 4) * stake, 2)::double end as payout, case when len(list_filter(odds, lambda x: x <= 1)) > 0 then 'OUT_OF_RANGE' end as error from o""")
def RUL7_parlay(spark, d):
    """Orders as parlays of their lines' odds, with their quantity at stake."""
    odds = (1 + F.col("l_discount") + F.when(F.col("l_linenumber") == 7, 0).otherwise(F.lit(0.01))).cast("decimal(10,4)")
    o = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", odds.alias("o")))).alias("m"), F.sum("l_quantity").alias("stake"))
    o = o.withColumn("odds", F.transform("m", lambda x: x["o"]))
    payout, error = rl.parlay(F.col("odds"), F.col("stake"))
    return o.select("l_orderkey", F.size("odds").alias("legs"), payout.cast("double").alias("payout"), error.alias("error"))


@query("""select l_orderkey, l_linenumber, case l_linenumber % 4 when 0 then 'ratio' when 1 then 'european' when 2 then 'net' else 'nope' end as formula,
case l_linenumber % 4 when 0 then round(l_extendedprice::decimal(18,2) * l_discount::decimal(4,2), 2)::double when 1 then case when l_discount > 0 then round(l_extendedprice::decimal(18,2) * (1 + l_discount)::decimal(4,2), 2)::double end when 2 then case when l_discount > 0 then round(l_extendedprice::decimal(18,2) * l_discount::decimal(4,2), 2)::double end end as result,
case when l_linenumber % 4 = 3 then 'UNSUPPORTED_FORMULA' when l_linenumber % 4 in (1, 2) and l_discount <= 0 then 'OUT_OF_RANGE' end as error from lineitem""")
def RUL8_dispatch(spark, d):
    m, price = F.col("l_linenumber") % 4, F.col("l_extendedprice")
    gross, net, error = rl.european(price, 1 + F.col("l_discount").cast("decimal(4,2)"))
    registry = {"ratio": rl.ratio(price, F.col("l_discount")), "european": (gross, error), "net": (net, error)}
    name = F.when(m == 0, "ratio").when(m == 1, "european").when(m == 2, "net").otherwise("nope")
    result, failed = rl.dispatched(name, registry)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", name.alias("formula"), result.cast("double").alias("result"), failed.alias("error"))
