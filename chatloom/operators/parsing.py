"""Reading structured content out of free text: JSON objects, message contents, labelled sections, tool calls."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom.functions import text as tx


def is_object(text: Column) -> Column:
    """Whether a text is a JSON object."""
    return F.coalesce(F.ltrim(text).startswith("{") & F.call_function("try_parse_json", text).isNotNull(), F.lit(False))


def balanced(text: Column) -> Column:
    """The first part of a text from an opening brace to the one that closes it; null without one."""
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("depth"), F.lit(0).alias("first"), F.lit(0).alias("last"))

    def step(a: Column, x: Column) -> Column:
        done, opens, closes = a["last"] > 0, x == "{", (x == "}") & (a["depth"] > 0)
        depth = F.when(done, a["depth"]).when(opens, a["depth"] + 1).when(closes, a["depth"] - 1).otherwise(a["depth"])
        first = F.when(~done & opens & (a["depth"] == 0), a["at"] + 1).otherwise(a["first"])
        last = F.when(~done & closes & (a["depth"] == 1), a["at"] + 1).otherwise(a["last"])
        return F.struct((a["at"] + F.length(x)).alias("at"), depth.alias("depth"), first.alias("first"), last.alias("last"))

    tokens = F.regexp_extract_all(text, F.lit(r"[{}]|[^{}]+"), F.lit(0))
    return tx.let(F.aggregate(tokens, start, step), lambda a: F.when(a["last"] > 0, F.substring(text, a["first"], a["last"] - a["first"] + 1)))


def json_object(text: Column) -> Column:
    """The JSON object that a text is, or has in a fence, or else the first balanced one in it; null if that is no JSON."""
    fenced = F.regexp_extract(text, r"(?is)```(?:json)?\s*(\{.*?\})\s*```", 1)
    found = F.coalesce(F.when(is_object(text), text), F.when(is_object(fenced), fenced), balanced(text))
    return F.when(is_object(found), F.trim(found))


def flat_content(content: Column) -> Column:
    """A message's content as one string: itself; of a JSON object its text or content; of a JSON list its parts', one after
    another."""
    part = F.coalesce(F.get_json_object(content, "$.text"), F.get_json_object(content, "$.content"))
    parts = F.from_json(content, "array<string>")
    joined = F.array_join(F.transform(parts, lambda p: F.coalesce(F.get_json_object(p, "$.text"), F.get_json_object(p, "$.content"), F.when(~is_object(p), p), F.lit(""))), "")
    return F.when(is_object(content), F.coalesce(part, F.lit(""))).when(F.ltrim(content).startswith("[") & parts.isNotNull(), joined).otherwise(content)


def section(text: Column, label: str, labels: Sequence[str], most: int | None = None) -> Column:
    """What follows a label and a colon, up to the nearest of the labels or the end; cut at `most` characters with an ellipsis."""
    others = "|".join(re.escape(x) for x in labels if x != label)
    found = F.trim(F.regexp_extract(text, rf"(?s){re.escape(label)}[:：](.*?)(?:(?:{others or '(?!)'})[:：]|$)", 1))
    return found if most is None else F.when(F.length(found) > most, F.concat(F.substring(found, 1, most), F.lit("…"))).otherwise(found)


def tool_calls(text: Column) -> Column:
    """Calls written into a text as <tool_call>…</tool_call>: array<struct<name, args>>, args as JSON.

    A call is a JSON object with name and arguments (or args), or markup: <function=name> with <parameter=key>value</parameter>.
    """

    def markup(x: Column) -> Column:
        pairs = [F.regexp_extract_all(x, F.lit(r"(?s)<parameter=([^>]+)>(.*?)</parameter>"), F.lit(i)) for i in (1, 2)]
        args = F.to_json(F.map_from_arrays(pairs[0], F.transform(pairs[1], lambda v: F.trim(v))))
        return F.struct(F.trim(F.regexp_extract(x, r"<function=([^>]+)>", 1)).alias("name"), args.alias("args"))

    def read(x: Column) -> Column:
        args = F.coalesce(F.get_json_object(x, "$.arguments"), F.get_json_object(x, "$.args"), F.lit("{}"))
        return F.when(is_object(x), F.struct(F.get_json_object(x, "$.name").alias("name"), args.alias("args"))).otherwise(markup(x))

    found = F.regexp_extract_all(text, F.lit(r"(?s)<tool_call>(.*?)</tool_call>"), F.lit(1))
    return F.filter(F.transform(found, read), lambda c: F.coalesce(c["name"], F.lit("")) != "")


#: One piece of JSON: a string, a number, a word or a mark.
_PIECE = r'"(?:[^"\\]|\\.)*+"|[+-]?[0-9][0-9.eE+-]*|true|false|null|[{}\[\],:]'
_LEAVES = "array<struct<path:string,value:string>>"


def leaves(text: Column) -> Column:
    """A JSON text as array<struct<path, value>>: a row for each scalar, each object ("{") and each list ("[" and its length).

    A path is the keys and places on the way, each after a slash (slashes and tildes of keys are written ~1 and ~0). Values begin
    with their kind: "n" numbers, also those written as text, in one notation; "s" other strings; "b" true and false; "0" null.
    """
    start = F.struct(F.array().cast("array<string>").alias("at"), F.lit("").alias("kinds"), F.lit(False).alias("key"), F.lit("").alias("before"), F.array().cast(_LEAVES).alias("out"))
    none = F.array().cast(_LEAVES)
    joined = lambda at: F.concat_ws("", F.transform(at, lambda x: F.concat(F.lit("/"), x)))
    cut = lambda xs: F.slice(xs, 1, F.greatest(F.size(xs) - 1, F.lit(0)))

    def value(x: Column) -> Column:
        string = F.get_json_object(F.concat(F.lit('{"x":'), x, F.lit("}")), "$.x")
        number = F.when(F.trim(string).rlike(r"^[+-]?([0-9]+|[0-9]+\.[0-9]*|\.[0-9]+)$") | ~F.startswith(x, F.lit('"')), F.trim(string).try_cast("double"))
        # whole numbers keep their digits, beyond those of doubles too
        digits = F.when(F.trim(string).rlike("^[+-]?[0-9]+$"), F.regexp_replace(F.regexp_replace(F.trim(string), r"^(-?)\+?0*(?=[0-9])", "$1"), "^-0$", "0"))
        whole = F.when((number == F.floor(number)) & (F.abs(number) < 1e15), number.cast("long").cast("string"))
        plain = F.concat(F.lit("n"), F.coalesce(digits, whole, number.cast("string")))
        return F.when(x == "null", "0").when(x.isin("true", "false"), F.concat(F.lit("b"), x)).otherwise(F.coalesce(plain, F.concat(F.lit("s"), string)))

    def step(a: Column, x: Column) -> Column:
        opens, closes, scalar = x.isin("{", "["), x.isin("}", "]"), ~x.isin("{", "[", "}", "]", ",", ":")
        inside, last = F.right(a["kinds"], F.lit(1)), F.element_at(a["at"], -1)
        named = scalar & a["key"]
        key = F.replace(F.replace(F.get_json_object(F.concat(F.lit('{"x":'), x, F.lit("}")), "$.x"), F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
        length = F.when(a["before"] == "[", F.lit("0")).otherwise((last.cast("int") + 1).cast("string"))
        at = (
            F.when(opens, F.concat(a["at"], F.array(F.when(x == "[", F.lit("0")).otherwise(F.lit("")))))
            .when(closes, cut(a["at"]))
            .when((x == ",") & (inside == "["), F.concat(cut(a["at"]), F.array((last.cast("int") + 1).cast("string"))))
            .when(named, F.concat(cut(a["at"]), F.array(key)))
            .otherwise(a["at"])
        )
        leaf = lambda at, v: F.array(F.struct(joined(at).alias("path"), v.alias("value")))
        more = F.when(x == "{", leaf(a["at"], F.lit("{"))).when(x == "]", leaf(cut(a["at"]), F.concat(F.lit("["), length))).when(scalar & ~a["key"], leaf(a["at"], value(x))).otherwise(none)
        kinds = F.when(opens, F.concat(a["kinds"], x)).when(closes, F.substring(a["kinds"], F.lit(1), F.length(a["kinds"]) - 1)).otherwise(a["kinds"])
        awaits = (x == "{") | ((x == ",") & (inside == "{"))
        return F.struct(at.alias("at"), kinds.alias("kinds"), awaits.alias("key"), x.alias("before"), F.concat(a["out"], more).alias("out"))

    return F.aggregate(F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0)), start, step, lambda a: a["out"])


def _args(text: Column) -> Column:
    return leaves(F.when(is_object(text), text).otherwise(F.lit("{}")))


def holds(actual: Column, expected: Column) -> Column:
    """Whether the leaves of one JSON have all of another: of objects the keys expected, of lists the same length, and equal scalars,
    numbers written as text being numbers. A null is also held where nothing stands."""
    there = lambda e: F.exists(actual, lambda a: (a["path"] == e["path"]) & (a["value"] == e["value"]))
    missing = lambda e: (e["value"] == "0") & ~F.exists(actual, lambda a: a["path"] == e["path"])
    return F.forall(expected, lambda e: there(e) | missing(e))


def args_match(actual: Column, expected: Column) -> Column:
    """holds() of two columns of JSON objects, of any depth; null or broken ones count as empty."""
    return tx.let(F.struct(_args(actual).alias("a"), _args(expected).alias("e")), lambda x: holds(x["a"], x["e"]))


def tool_score(text: Column, tool: Column, args: Column, must: Column) -> Column:
    """struct(called, matched, valid, included, score) of a reply with tool calls beside the tool and arguments expected and the
    terms it must include: .40, .35, .15 and .10 of the score. Any call of the right tool may have the right arguments."""
    calls = tool_calls(text)
    raw = F.regexp_extract_all(text, F.lit(r"(?s)<tool_call>(.*?)</tool_call>"), F.lit(1))
    right = F.filter(calls, lambda c: c["name"] == tool)
    matched = tx.let(_args(args), lambda e: F.exists(right, lambda c: holds(_args(c["args"]), e)))
    included = F.when(F.size(must) > 0, F.size(F.filter(must, lambda m: F.contains(text, m))) / F.size(must)).otherwise(0.0)
    one = lambda c: F.when(c, 1.0).otherwise(0.0)
    called, valid = F.size(right) > 0, F.size(calls) == F.size(raw)
    score = 0.40 * one(called) + 0.35 * one(matched) + 0.15 * one(valid) + 0.10 * included
    return F.struct(called.alias("called"), matched.alias("matched"), valid.alias("valid"), included.alias("included"), score.alias("score"))
