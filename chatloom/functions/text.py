"""Text functions: columns in, columns out. A null text gives null unless a function says otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space that text is stripped of and collapsed at.
WS = r"[ \t\n\x0B\f\r\x{A0}\x{3000}]"
#: Where sentences end, and what doesn't count at the end of a line; defaults of parameters.
SENTENCE_END = r"[.!?;\n…。！？；]+"
LINE_TAIL = r"[\p{P}\p{S}]+$"


def let(value: Column, use) -> Column:
    """use(value), with value computed once however often, and in whatever lambda, use needs it."""
    return F.transform(F.array(value), lambda v: use(v))[0]


def runs(array: Column) -> Column:
    """Distinct elements of an array of any length with how often each occurs: array<struct<x, n>>, by one sort."""

    def counted(a: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(a) - 1), lambda i: (i == 0) | (F.get(a, i) != F.get(a, i - 1)))
        return let(starts, lambda s: F.transform(s, lambda i, k: F.struct(F.get(a, i).alias("x"), (F.coalesce(F.get(s, k + 1), F.size(a)) - i).alias("n"))))

    return F.when(F.size(array) > 0, let(F.sort_array(array), counted))


def most_often(array: Column) -> Column:
    """How often the commonest element of an array occurs; null for an empty one."""
    return F.array_max(F.transform(runs(array), lambda r: r["n"]))


def firsts(array: Column, form) -> Column:
    """Elements whose form(element, place) comes for the first time, in order; empty forms are left out. Sorts, so that long
    arrays take no quadratic time."""

    def kept(s: Column) -> Column:
        fresh = F.filter(s, lambda e, k: (e["f"] != "") & ((k == 0) | (F.get(s, k - 1)["f"] != e["f"])))
        return F.transform(F.array_sort(F.transform(fresh, lambda e: F.struct(e["i"], e["x"]))), lambda e: e["x"])

    return let(F.array_sort(F.transform(array, lambda x, i: F.struct(form(x, i).alias("f"), i.alias("i"), x.alias("x")))), kept)


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, f"^{WS}+|{WS}+$", "")


def squeeze(text: Column) -> Column:
    """Without any white space."""
    return F.regexp_replace(text, f"{WS}+", "")


def normalize(text: Column) -> Column:
    """Carriage returns, tags and &nbsp; become spaces, addresses <URL>; runs of white space collapse; ends are stripped."""
    for pattern, to in ((r"\r", " "), (r"<[^>]+>", " "), (r"(?i)https?://[^ \t\n\x0B\f\r]+", " <URL> "), (r"&nbsp;", " "), (f"{WS}+", " ")):
        text = F.regexp_replace(text, pattern, to)
    return strip(text)


def replace_all(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Rules (pattern, replacement) applied one after another: masking and redaction packs."""
    for pattern, to in rules:
        text = F.regexp_replace(text, pattern, to)
    return text


def lines(text: Column) -> Column:
    """Stripped lines that are not empty."""
    return F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != "")


def clean_lines(text: Column, noise: Sequence[str], longest: int = 2500) -> Column:
    """Lines that are neither empty, nor too long, nor match a noise pattern."""
    found = lines(text)
    pattern = "(?i)" + "|".join(f"(?:{p})" for p in noise)
    return F.filter(found, lambda x: (F.length(x) <= longest) & ~x.rlike(pattern))


def unrepeated(array: Column) -> Column:
    """Without elements equal to the one before."""
    return let(array, lambda a: F.filter(a, lambda x, i: (i == 0) | (x != F.get(a, i - 1))))


def longest_run(array: Column) -> Column:
    """Length of the longest run of equal elements."""
    start = F.struct(F.lit(0).alias("best"), F.lit(0).alias("run"), F.lit(None).cast("string").alias("last"))

    def step(a: Column, x: Column) -> Column:
        run = F.when(a["last"] == x, a["run"] + 1).otherwise(F.lit(1))
        return F.struct(F.greatest(a["best"], run).alias("best"), run.alias("run"), x.alias("last"))

    return F.aggregate(array, start, step, lambda a: a["best"])


def line_form(line: Column, tail: str = LINE_TAIL) -> Column:
    """A line without white space and final punctuation, by which repeats are told."""
    return F.regexp_replace(squeeze(line), tail, "")


def first_of_each(array: Column, form) -> Column:
    """Elements whose form was not seen before, those with an empty form left out; order stays."""
    return firsts(array, lambda x, i: form(x))


def sentences(text: Column, end: str = SENTENCE_END) -> Column:
    """Stripped parts between sentence ends, empty ones left out."""
    return F.filter(F.transform(F.split(text, end), strip), lambda x: x != "")


def new_sentences(text: Column, least: int = 8) -> Column:
    """Sentences without repeats of those of at least `least` characters."""
    return firsts(sentences(text), lambda x, i: F.when(F.length(x) < least, F.concat(F.lit("\n"), i.cast("string"))).otherwise(x))


def without_think(text: Column) -> Column:
    """Without <think> blocks and think fences, whatever their case."""
    return strip(F.regexp_replace(F.regexp_replace(text, r"(?is)<think>.*?</think>", ""), r"(?is)```think.*?```", ""))


def script_lines(text: Column, script: str = r"\p{L}", least: int = 4, share: float = 0.35, symbols: str = r"[%$&*#|!]{3,}") -> Column:
    """Distinct lines with enough characters of a script, as a share of those that are no white space, and no run of symbols."""

    def fine(x: Column) -> Column:
        n = F.regexp_count(x, F.lit(script))
        return (n >= least) & (n >= share * F.length(squeeze(x))) & ~x.rlike(symbols)

    return F.array_distinct(F.filter(lines(text), fine))


def terms(text: Column, stop: Sequence[str] = (), script: str | None = None) -> Column:
    """Distinct lower-case runs of letters and digits without stop terms, in order; then, for a script without spaces, the
    pairs of its characters that follow each other when all else is left out."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    if script:
        found = F.regexp_extract_all(F.lower(text), F.lit(rf"(?:(?!{script})[\p{{L}}\p{{N}}])+"), F.lit(0))
        found = F.concat(found, F.regexp_extract_all(F.regexp_replace(text, rf"(?!{script})(?s:.)", ""), F.lit("(?=(..))"), F.lit(1)))
    found = F.array_distinct(found)
    return F.array_except(found, F.array(*map(F.lit, stop))) if stop else found


def labels_of(text: Column, packs: dict[str, Sequence[str]]) -> Column:
    """Sorted labels any of whose patterns match, whatever the case."""
    found = F.array(*(F.when(text.rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns)), F.lit(label)) for label, patterns in packs.items()))
    return F.array_sort(F.filter(found, lambda x: x.isNotNull()))


def hits(text: Column, patterns: Sequence[str]) -> Column:
    """Number of patterns that match."""
    return sum((F.when(text.rlike("(?i)" + p), 1).otherwise(0) for p in patterns), F.lit(0))


def windows(text: Column, term: str, left: int, right: int) -> Column:
    """What stands around each place of a lower-case term in the lower-cased text, overlaps included: up to left characters
    before it, itself, and up to right after it. One pass over the text, which is padded on the left for it."""
    pad, quoted = "\0", "".join(f"\\x{{{ord(c):x}}}" for c in term)
    found = F.regexp_extract_all(F.concat(F.lit(pad * left), F.lower(text)), F.lit("(?s)(?=(.{%d}%s.{0,%d}))" % (left, quoted, right)), F.lit(1))
    return F.when(F.contains(F.lower(text), F.lit(term)), F.transform(found, lambda w: F.replace(w, F.lit(pad), F.lit("")))).otherwise(F.array().cast("array<string>"))


def meant(text: Column, term: str, negations: Sequence[str], left: int = 14, right: int = 18, actions: Sequence[str] = (), wide: tuple[int, int] = (18, 22), near: tuple[int, int] = (10, 8)) -> Column:
    """Whether a term occurs at least once without a negation in its window. With actions, as for terms of promotion, one of them
    must also be meant in the wider window around that occurrence: it occurs there without a negation near it."""
    pattern = "(?i)" + "|".join(negations)
    if not actions:
        return F.exists(windows(text, term, left, right), lambda w: ~w.rlike(pattern))
    both = F.arrays_zip(windows(text, term, left, right).alias("close"), windows(text, term, *wide).alias("around"))

    def called(w: Column) -> Column:
        any_ = F.lit(False)
        for a in actions:
            any_ = any_ | meant(w, a, negations, *near)
        return any_

    return F.exists(both, lambda w: ~w["close"].rlike(pattern) & called(w["around"]))
