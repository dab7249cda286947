"""Rule tables as column expressions, and payout formulas in decimals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_match(text: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """The label of the first rule (label, pattern) that matches, whatever the case."""
    out = None
    for label, pattern in rules:
        hit = text.rlike("(?i)" + pattern)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(default)


def canonical(text: Column, aliases: Sequence[tuple[str, str]], default: str = "other") -> Column:
    """The label of the first alias (alias, label) that is in the text or has the text in it; empty texts get the default."""
    t = F.lower(F.trim(text))
    out = F.when(F.coalesce(t, F.lit("")) == "", default)
    for alias, label in aliases:
        out = out.when(F.contains(t, F.lit(alias)) | F.contains(F.lit(alias), t), label)
    return out.otherwise(default)


_MONEY = "decimal(24,8)"


def european(stake: Column, odds: Column, places: int = 2) -> tuple[Column, Column, Column]:
    """(gross, net, error): stake * odds and stake * (odds - 1), rounded half up; an error code instead where inputs are bad."""
    s, o = stake.cast(_MONEY), odds.cast(_MONEY)
    error = F.when(s.isNull() | o.isNull(), "MISSING").when((s <= 0) | (o <= 1), "OUT_OF_RANGE")
    good = error.isNull()
    return F.when(good, F.round(s * o, places)), F.when(good, F.round(s * (o - 1), places)), error


def ratio(amount: Column, share: Column, places: int = 2) -> tuple[Column, Column]:
    """(result, error): amount * share, rounded half up."""
    a, r = amount.cast(_MONEY), share.cast(_MONEY)
    error = F.when(a.isNull() | r.isNull(), "MISSING").when((a < 0) | (r < 0) | (r > 1), "OUT_OF_RANGE")
    return F.when(error.isNull(), F.round(a * r, places)), error


def parlay(odds: Column, stake: Column, places: int = 4) -> tuple[Column, Column]:
    """(payout, error): the product of an array of odds, rounded before it is multiplied by the stake."""
    kind = "decimal(18,8)"
    product = F.aggregate(odds, F.lit(1).cast(kind), lambda a, x: (a * x.cast("decimal(10,4)")).cast(kind))
    error = F.when((F.size(odds) <= 0) | odds.isNull(), "EMPTY").when(F.exists(odds, lambda x: x <= 1), "OUT_OF_RANGE")
    return F.when(error.isNull(), F.round(F.round(product, places) * stake.cast("decimal(14,2)"), 2)), error


def formula_arguments(text: Column, formulas: Sequence[tuple[str, str, Sequence[str]]]) -> Column:
    """struct(formula, numbers): the first formula (name, pattern, labels) whose pattern the text matches, else none, and the numbers
    of its labels in their order; a number without its label is taken by place, and is null if there is none."""
    number = r"([0-9]+(?:\.[0-9]+)?)"
    places = F.transform(F.regexp_extract_all(text, F.lit(number), F.lit(1)), lambda x: x.try_cast("double"))
    out = None
    for name, pattern, labels in formulas:
        labelled = [F.regexp_extract(text, rf"(?i){label}[ :=]*{number}", 1).try_cast("double") for label in labels]
        every = F.array(*(F.coalesce(x, F.get(places, F.lit(i))) for i, x in enumerate(labelled)))
        found, hit = F.struct(F.lit(name).alias("formula"), every.alias("numbers")), text.rlike("(?i)" + pattern)
        out = F.when(hit, found) if out is None else out.when(hit, found)
    none = F.struct(F.lit("none").alias("formula"), F.array().cast("array<double>").alias("numbers"))
    return none if out is None else out.otherwise(none)


def dispatched(name: Column, formulas: dict[str, tuple[Column, Column]]) -> tuple[Column, Column]:
    """(result, error) of the formula that each row names, of a registry name: (result, error); UNSUPPORTED_FORMULA for others."""
    result, error, known = F.lit(None).cast("decimal(38,8)"), F.lit("UNSUPPORTED_FORMULA"), list(formulas.items())
    for key, (r, e) in reversed(known):
        result, error = F.when(name == key, r.cast("decimal(38,8)")).otherwise(result), F.when(name == key, e).otherwise(error)
    return result, error


#: Verbs of settlement, and those that answers say in their place.
SETTLED = {
    "亏损本金": ("亏损本金", "亏损为本金", "亏损"),
    "损失本金": ("损失本金", "损失为本金", "亏损"),
    "亏损": ("亏损",),
    "亏": ("亏", "亏损"),
    "输": ("输", "亏损", "未中奖"),
    "盈利": ("盈利", "赢"),
    "赢": ("赢", "盈利"),
}


def says(answer: Column, term: Column, settled: Mapping[str, Sequence[str]] = SETTLED) -> Column:
    """Whether an answer has a term, both without white space and in lower case.

    A term with digits must not go on in a longer number. A term of a settlement verb and a number is also said where one of the
    verbs that mean the same stands before the number, with at most eight other characters and a formula between. An
    empty term is always said.
    """
    has = F.contains(answer, term)
    escaped = F.regexp_replace(term, r"([\\^$.|?*+()\[\]{}-])", r"\\$1")
    whole = F.regexp_like(answer, F.concat(F.lit("(?<![0-9])"), escaped, F.lit("(?![0-9])")))
    verbs = "|".join(sorted(settled, key=len, reverse=True))
    verb, number = (F.regexp_extract(term, rf"^({verbs})([0-9]+(?:\.[0-9]+)?)$", i) for i in (1, 2))
    others = F.try_element_at(F.create_map(*(F.lit(x) for v, same in settled.items() for x in (v, "|".join(same)))), verb)
    near = F.concat(F.lit("(?:"), others, F.lit(r")[^0-9]{0,8}(?:[0-9]+(?:\.[0-9]+)?[*x×+/=-])*"), F.replace(number, F.lit("."), F.lit(r"\.")), F.lit("(?![0-9])"))
    return F.when(term.rlike("[0-9]"), whole | F.when(number != "", F.coalesce(F.regexp_like(answer, near), F.lit(False))).otherwise(False)).otherwise(has)


def rule_checks(answers: DataFrame, checks: DataFrame, id_col: str = "id", answer_col: str = "answer") -> DataFrame:
    """(id, check_id, passed, reason) of every check (id, check_id, any, all, none: arrays of terms) beside the answer of its id.

    A check passes if one of `any` (when it has some), every one of `all` and none of `none` is said; reason is the first of
    missing_prediction (no row of that id), any, all and none that it fails by, else null. A null answer is an empty one; of
    repeated ids the least answer holds; null lists ask for nothing.
    """
    said = F.lower(F.regexp_replace(F.coalesce(F.col(answer_col), F.lit("")), r"\s+", ""))
    one = answers.groupBy(F.col(id_col).alias("id")).agg(F.min(said).alias("answer"))
    plain = lambda c: F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda t: F.lower(F.regexp_replace(t, r"\s+", "")))
    rows = checks.select("id", "check_id", *(plain(F.col(c)).alias(c) for c in ("any", "all", "none"))).join(one, "id", "left")
    a = F.col("answer")
    fails = {
        "missing_prediction": a.isNull(),
        "any": (F.size("any") > 0) & ~F.exists("any", lambda t: says(a, t)),
        "all": ~F.forall("all", lambda t: says(a, t)),
        "none": F.exists("none", lambda t: says(a, t)),
    }
    reason = F.coalesce(*(F.when(c, F.lit(n)) for n, c in fails.items()))
    return rows.select("id", "check_id", reason.isNull().alias("passed"), reason.alias("reason"))
