"""Conversation structure repair: least-cost edits to a legal role sequence, by a rank-convergence parallel Viterbi.

Rows of all conversations stand in one order, dealt by ranges, so a conversation may lie in many segments. A row acts on the
costs to go of the four states of the role automaton; what matters of them is how they differ, and of such difference vectors
there are few. Each segment starts at its end from a speculative vector, all in parallel. Fix-up passes hand every segment the
vector of the one after it; it runs again only until its vector differs from the stored one by a constant. With all vectors
right, each segment traces the least audit from every state it may be entered in, and one pass over segments picks the state.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, reachable

#: States: nothing yet, after a system turn, after a user turn, after an assistant turn. A conversation may end in the first and last.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Fixed costs of the edits; an undeleted truncated turn costs as much as one of the threes.
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
#: Where a turn of a role leads from each state (None: illegal), and the one role that may be written in each.
KEEP = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None), "": (None,) * 4}
WRITE = (USER, USER, ASSISTANT, USER)
#: Costs to go where a conversation ends: empty turns up to an assistant's.
END = (0, 2 * INSERT, INSERT, 0)
SPACE = " \t\n\x0b\x0c\r"
NONE = 1 << 30
INITIALS = ("", "s", "u", "a")


def _options(ahead: tuple[int, ...], symbol: int) -> tuple[list[int], list[int | None]]:
    """Costs to go before a row by state, with empty turns put in first where that pays, and where a kept row leads."""
    initial, fault = INITIALS[symbol // 3], symbol % 3
    kept = KEEP[initial] if fault < 2 else (None,) * 4
    cut = CUT * (fault == 1)
    best = []
    for q in range(4):
        c = DELETE + ahead[q]
        if fault < 2:
            c = min(c, REROLE + cut + ahead[WRITE[q]])
            if kept[q] is not None:
                c = min(c, cut + ahead[kept[q]])
        best.append(c)
    u, a = best[USER], best[ASSISTANT]
    best[USER], best[ASSISTANT] = min(u, INSERT + a), min(a, INSERT + u)
    for q in (START, SYSTEM):
        best[q] = min(best[q], INSERT + best[USER])
    return best, list(kept)


class Automaton:
    """Steps over vectors of costs to go, each less its least entry; every step is worked out once."""

    def __init__(self) -> None:
        self.steps: dict = {}
        self.ways: dict = {}

    def before(self, ahead: tuple[int, ...], symbol: int) -> tuple[int, ...]:
        """The vector before a row, from the one after it."""
        found = self.steps.get((ahead, symbol))
        if found is None:
            best, _ = _options(ahead, symbol)
            low = min(best)
            found = self.steps[ahead, symbol] = tuple(c - low for c in best)
        return found

    def way(self, ahead: tuple[int, ...], symbol: int) -> list[tuple[str, int, int]]:
        """By state: initials of the least edits up to and with the row, the state after them, their cost."""
        found = self.ways.get((ahead, symbol))
        if found is None:
            best, kept = _options(ahead, symbol)
            cut, found = CUT * (symbol % 3 == 1), []
            for start in range(4):
                letters, q, cost = "", start, 0
                while True:  # initials in ASCII order: D, I, K, R
                    if DELETE + ahead[q] == best[q]:
                        found.append((letters + "D", q, cost + DELETE))
                    elif INSERT + best[WRITE[q]] == best[q]:
                        letters, q, cost = letters + "I", WRITE[q], cost + INSERT
                        continue
                    elif kept[q] is not None and cut + ahead[kept[q]] == best[q]:
                        found.append((letters + "K", kept[q], cost + cut))
                    else:
                        found.append((letters + "R", WRITE[q], cost + REROLE + cut))
                    break
            self.ways[ahead, symbol] = found
        return found

    def run(self, symbols: bytes, end: tuple[int, ...]) -> tuple[int, ...]:
        """The vector before a segment, from the one after it."""
        at = end
        for s in reversed(symbols):
            at = self.before(at, s)
        return at

    def rerun(self, symbols: bytes, end: tuple[int, ...], stored: tuple[int, ...], out: tuple[int, ...]) -> tuple[int, ...]:
        """As run, but ends where the vector differs by a constant from the run that began with stored and gave out."""
        at = end
        for s in reversed(symbols):
            if at == stored:
                return out
            at, stored = self.before(at, s), self.before(stored, s)
        return at

    def trace(self, symbols: bytes, end: tuple[int, ...], last: bool, starts: range) -> list[tuple[str, int, int]]:
        """For each state a segment may be entered in: edits by row, joined by commas, the state left in, the cost."""
        ways, at = [], end
        for s in reversed(symbols):
            ways.append(self.way(at, s))
            at = self.before(at, s)
        ways.reverse()
        out = []
        for q in starts:
            letters, cost = [], 0
            for w in ways:
                x, q, c = w[q]
                letters.append(x)
                cost += c
            if last:
                letters.append("I" * (END[q] // INSERT))
                cost += END[q]
            out.append((",".join(letters), q, cost))
        return out


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)


_SEG = pa.schema([("c", pa.int64()), ("seg", pa.int64()), ("symbols", pa.binary()), ("faults", pa.binary()), ("poss", pa.list_(pa.int64())), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("turns", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("head", pa.string()), ("tail", pa.string())])
_SEGMENTS = "c long, seg long, symbols binary, faults binary, poss array<bigint>, blank long, duplicate long, truncated long, illegal long, turns long, lo long, hi long, head string, tail string"
LEGAL = frozenset(("su", "ua", "au"))


def _segments(size: int):
    """Rows in order, as segments: symbols of the rows, their places, what is wrong with them, first and last turn and role."""

    def made(rows: list[tuple]) -> tuple:
        initials, faults, turns = [r[3] for r in rows], [r[4] for r in rows], [r[2] for r in rows if r[2] is not None]
        symbols = bytes(3 * (INITIALS.index(i) if i in INITIALS else 0) + (2 if f in (1, 2) else f // 3) for i, f in zip(initials, faults, strict=True))
        pairs = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
        changes = sum(a != b for a, b in zip(turns, turns[1:], strict=False))
        ends = (turns[0], turns[-1]) if turns else (None, None)
        return (rows[0][1], rows[0][0], symbols, bytes(faults), [r[0] for r in rows], faults.count(1), faults.count(2), faults.count(3), pairs, changes + bool(turns), *ends, initials[0], initials[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            out = []
            for r in zip(*(a.to_pylist() for a in batch.columns), strict=True):
                if held and (held[0][1] != r[1] or len(held) == size):
                    out.append(made(held))
                    held = []
                held.append(r)
            if out:
                yield _batch(out, _SEG)
        if held:
            yield _batch([made(held)], _SEG)

    return run


_VEC = pa.schema([("c", pa.int64()), ("seg", pa.int64()), ("end", pa.list_(pa.int64())), ("out", pa.list_(pa.int64()))])
_VECTORS = "c long, seg long, end array<bigint>, out array<bigint>"


def _speculative(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors before segments, from right ends for the last of a conversation and zeros for others."""
    known = Automaton()
    for b in batches:
        rows = zip(*(b.column(n).to_pylist() for n in ("c", "seg", "symbols", "last")), strict=True)
        yield _batch([(c, seg, end := END if last else (0,) * 4, known.run(symbols, end)) for c, seg, symbols, last in rows], _VEC)


def _fixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors again, from what the segment after each now gives."""
    known = Automaton()
    for b in batches:
        out = []
        for c, seg, symbols, end, was, after in zip(*(b.column(n).to_pylist() for n in ("c", "seg", "symbols", "end", "out", "after")), strict=True):
            now = tuple(end if after is None else after)
            out.append((c, seg, now, known.rerun(symbols, now, tuple(end), tuple(was))))
        yield _batch(out, _VEC)


_TRACE = pa.schema([("seg", pa.int64()), ("edits", pa.list_(pa.string())), ("left", pa.list_(pa.int64())), ("cost", pa.list_(pa.int64()))])


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = Automaton()
    for b in batches:
        out = []
        for seg, symbols, end, first, last in zip(*(b.column(n).to_pylist() for n in ("seg", "symbols", "end", "first", "last")), strict=True):
            ways = known.trace(symbols, tuple(end), last, range(1 if first else 4))
            out.append((seg, *map(list, zip(*ways, strict=True))))
        yield _batch(out, _TRACE)


_PICK = pa.schema([("c", pa.int64()), ("seg", pa.int64()), ("enter", pa.int64()), ("edits", pa.string()), ("cost", pa.int64()), ("turns", pa.int64()), ("illegal", pa.int64())])


def _picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state each segment is entered in; turns and pairs of roles that segments share or lie between are put right."""
    state, turn, tail = START, None, ""
    for b in batches:
        out = []
        names = ("c", "seg", "first", "edits", "left", "cost", "turns", "illegal", "lo", "hi", "head", "tail")
        for c, seg, first, edits, left, cost, turns, illegal, lo, hi, head, end in zip(*(b.column(n).to_pylist() for n in names), strict=True):
            if first:
                state, turn = START, None
            else:
                illegal += tail + head not in LEGAL
                turns -= turn is not None and turn == lo
            out.append((c, seg, state, edits[state], cost[state], turns, illegal))
            state, tail, turn = left[state], end, turn if hi is None else hi
        yield _batch(out, _PICK)


def damaged(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows of conversations with faults put in by crc32 of "id:turn", modulo 20: 0 drops a row, 1 empties its text, 2 takes out
    its `[.!?]`, 3 repeats it, 4 makes its role user. Null roles, texts and, in the hashed string, ids and turns are one space.
    Returns id_col, turn_col, role_col, text_col; other columns are not read."""
    c, t = turns[id_col].cast("long"), turns[turn_col].cast("long")
    some = lambda x: F.coalesce(x.cast("string"), F.lit(" "))
    base = turns.select(c.alias("c"), t.alias("t"), some(turns[role_col]).alias("r"), some(turns[text_col]).alias("x"), (F.crc32(F.concat_ws(":", some(c), some(t)).cast("binary")) % 20).alias("k"))
    base = base.filter("k <> 0").withColumn("copy", F.explode(F.when(F.col("k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.translate("x", ".!?", "")).otherwise(F.col("x"))
    return base.select(F.col("c").alias(id_col), F.col("t").alias(turn_col), F.when(F.col("k") == 4, "user").otherwise(F.col("r")).alias(role_col), text.alias(text_col))


class Repair:
    """What `repair_conversations` found: `turns` and `conversations`, each a DataFrame."""

    def __init__(self, rows: DataFrame, segments: DataFrame, picked: DataFrame, names: tuple[str, str, str, str]) -> None:
        self._rows, self._segments, self._picked, self.names = rows, segments, picked, names

    def turns(self) -> DataFrame:
        """A row for each row given: id, place (its order over all conversations), turn, role and text as given, fault ("",
        blank, duplicate, truncated), edits (initials, in order: empty turns put in before the row, what was done with it), tail
        (empty turns put in after it) and repaired, the array of (role, text) that now stand in its place."""
        c, t, r, x = self.names
        each = self._picked.select("seg", "enter", "edits").join(self._segments.select("seg", "symbols", "faults", "poss"), "seg")
        each = each.mapInArrow(_written, "pos long, fault int, edits string, tail string, roles array<string>")
        out = self._rows.drop("fault").join(each, "pos")
        made = F.transform("roles", lambda role: F.struct(F.when(role == "", F.col("r")).otherwise(F.ltrim(role, F.lit("+"))).alias("role"), F.when(F.startswith(role, F.lit("+")), "").otherwise(F.col("x")).alias("text")))
        fault = F.element_at(F.array(*map(F.lit, ("", "blank", "duplicate", "truncated"))), F.col("fault") + 1)
        return out.select(F.col("c").alias(c), F.col("pos").alias("place"), F.col("t").alias(t), F.col("r").alias(r), F.col("x").alias(x), fault.alias("fault"), "edits", "tail", made.alias("repaired"))

    def conversations(self) -> DataFrame:
        """A row for each conversation with rows: id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
        c = self.names[0]
        parts = self._segments.drop("c", "turns", "illegal").join(self._picked, "seg")
        audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg", F.translate("edits", ",", "").alias("e")))), lambda p: p["e"]), "")
        gaps = F.coalesce(F.max("hi") - F.min("lo") + 1 - F.sum("turns"), F.lit(0))
        return parts.groupBy(F.col("c").alias(c)).agg(gaps.alias("gaps"), *(F.sum(n).alias(n) for n in ("blank", "duplicate", "truncated", "illegal", "cost")), audit.alias("audit"))


_WRITTEN = pa.schema([("pos", pa.int64()), ("fault", pa.int32()), ("edits", pa.string()), ("tail", pa.string()), ("roles", pa.list_(pa.string()))])


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the roles written in their place: "" is the row's own, "+role" an empty turn."""
    names = {USER: "user", ASSISTANT: "assistant"}
    for b in batches:
        for q, edits, symbols, faults, poss in zip(*(b.column(n).to_pylist() for n in ("enter", "edits", "symbols", "faults", "poss")), strict=True):
            out, words = [], edits.split(",")
            for i, (pos, s) in enumerate(zip(poss, symbols, strict=True)):
                tail = words[i + 1] if i + 1 == len(poss) < len(words) else ""
                roles = []
                for letter in words[i] + tail:
                    if letter == "K":
                        q = KEEP[INITIALS[s // 3]][q]
                        roles.append("")
                    elif letter != "D":
                        q = WRITE[q]
                        roles.append("+" * (letter == "I") + names[q])
                out.append((pos, faults[i], words[i], tail, roles))
            yield _batch(out, _WRITTEN)


_HASH = pa.schema([("c", pa.int64()), ("h", pa.string())])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the repaired turns of each conversation, whose rows come in order; nothing is held but the running hash."""
    at, now, some = None, None, False
    for b in batches:
        out = []
        for c, repaired in zip(b.column("c").to_pylist(), b.column("repaired").to_pylist(), strict=True):
            if now is None or c != at:
                if now is not None:
                    out.append((at, now.hexdigest()))
                at, now, some = c, hashlib.sha256(), False
            for turn in repaired:
                now.update((("\n" if some else "") + turn["role"] + ":" + turn["text"]).encode())
                some = True
        if out:
            yield _batch(out, _HASH)
    if now is not None:
        yield _batch([(at, now.hexdigest())], _HASH)


def repair_conversations(turns: DataFrame, segment: int = 5000, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> Repair:
    """Repair the order of roles of every conversation by the edits of least cost.

    Rows are taken by turn (null turns first; ties by role, then text). The first fault of a row counts: blank (nothing but
    white space), duplicate (a row of the same role and text came before), truncated (ends otherwise than by `[.!?]`). Edits:
    Keep (0), Rerole to user or assistant (3), Delete (4; blank and duplicate rows must go), Insert an empty turn (3); a
    truncated row that stays costs 3 more. What stays has role initials `(s?(ua)+)?`. Of the cheapest ways the one whose
    initials are least in ASCII order is taken. Rows of a null id form one conversation; null roles and texts count as one
    space; repeated rows are duplicates; roles are told by their first letter, in the case given; an empty table has no rows.
    Columns other than the four are not read. No task holds more than `segment` rows at once; the audit of a conversation is
    one value, of a letter for each edit.
    """
    spark = turns.sparkSession
    reachable(spark)
    some = lambda name: F.coalesce(turns[name].cast("string"), F.lit(" "))
    base = turns.select(turns[id_col].cast("long").alias("c"), turns[turn_col].cast("long").alias("t"), some(role_col).alias("r"), some(text_col).alias("x"))
    # rows alike in all are told apart by a number, so that any number of them can be split
    base = base.withColumn("b", F.left("x", F.lit(64))).withColumn("h", F.xxhash64("x")).withColumn("n", F.rand(7))
    order = [F.asc_nulls_first(n) for n in ("c", "t", "r", "b", "h", "n")]
    rows = base.repartitionByRange(*order).sortWithinPartitions(*order).select(F.monotonically_increasing_id().alias("pos"), "c", "t", "r", "x")
    ended = F.rtrim("x", F.lit(SPACE))
    rows = materialize(rows.withColumn("fault", F.when(ended == "", 1).when(F.right(ended, F.lit(1)).isin(".", "!", "?"), 0).otherwise(3)), "repair-rows")
    same = [F.xxhash64("r", "x").alias("k1"), F.xxhash64(F.lit(1), "x", "r").alias("k2")]
    first = rows.groupBy("c", *same).agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("new"))
    fault = F.when((F.col("fault") == 1) | F.col("new"), F.col("fault")).otherwise(2).alias("fault")
    light = rows.select("pos", "c", "t", F.left("r", F.lit(1)).alias("i"), "fault").join(first, "pos", "left").select("pos", "c", "t", "i", fault)
    # the same order again, now of a few bytes a row
    segments = light.repartitionByRange("pos").sortWithinPartitions("pos").mapInArrow(_segments(segment), _SEGMENTS)
    segments = materialize(segments, "repair-segments")
    w = Window.partitionBy("c").orderBy("seg")
    linked = segments.select("c", "seg", "symbols", F.lag("seg").over(w).isNull().alias("first"), F.lead("seg").over(w).isNull().alias("last"))
    linked = materialize(linked, "repair-linked")
    vectors = linked.mapInArrow(_speculative, _VECTORS)
    many = linked.filter("not first or not last").select("seg", "symbols")
    fixed = materialize(vectors.join(linked.filter("not first or not last").select("seg"), "seg", "left_semi"), "repair-vectors")
    while True:
        after = fixed.withColumn("after", F.lead("out").over(w))
        if not after.filter("after is not null and after <> end").limit(1).count():
            break
        fixed = materialize(after.join(many, "seg").mapInArrow(_fixed, _VECTORS), "repair-vectors")
    alone = linked.filter("first and last").select("seg", "symbols", "first", "last", F.array(*(F.lit(e).cast("long") for e in END)).alias("end"))
    known = linked.filter("not first or not last").join(fixed.select("seg", "end"), "seg").select("seg", "symbols", "first", "last", "end")
    traced = alone.union(known).mapInArrow(_traced, "seg long, edits array<string>, left array<bigint>, cost array<bigint>")
    parts = segments.select("c", "seg", "turns", "illegal", "lo", "hi", "head", "tail").join(linked.select("seg", "first"), "seg").join(traced, "seg")
    picked = parts.repartition("c").sortWithinPartitions(F.asc_nulls_first("c"), "seg").mapInArrow(_picked, "c long, seg long, enter long, edits string, cost long, turns long, illegal long")
    return Repair(rows, segments, materialize(picked, "repair-picked"), (id_col, turn_col, role_col, text_col))


def repaired_digest(repair: Repair) -> DataFrame:
    """(c, repaired_sha256) of each conversation with rows: of its repaired turns as `role:text`, joined by line ends. A hash of
    one text can't be split, so the rows of a conversation pass through one task, in order, one after another."""
    c = repair.names[0]
    rows = repair.turns().select(F.col(c).alias("c"), "place", "repaired")
    return rows.repartition("c").sortWithinPartitions(F.asc_nulls_first("c"), "place").mapInArrow(_hashed, "c long, h string").select(F.col("c").alias(c), F.col("h").alias("repaired_sha256"))
