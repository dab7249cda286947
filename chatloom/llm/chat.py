"""Chat formatting: repair of role sequences at least cost, then rendering.

Legal dialogues: at most one system turn, first; then user and assistant turns in turn, from a user turn to an assistant
turn. A dynamic program over the states of that automaton chooses for every turn the cheapest of: taking it in its role,
relabelling it, merging it into the turn before it, each possibly after an empty turn inserted before it; at the end
an empty assistant turn may be added.

What the program does with a turn is a matrix of costs between states, and matrices combine by (min, +). So a dialogue
needs no single task: turns are range-partitioned by dialogue and place, each partition sums up its part of a dialogue
as one small matrix, the few matrices of a dialogue are chained, and each partition then retraces its part between the
states where the chain enters and leaves it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, reachable

ROLES = ("system", "user", "assistant")
#: States: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
NONE = 1_000_000
#: Costs of what is done: turns of a role that is not known are relabelled for less, as the role says little.
COSTS = {"merge": 1, "relabel": 6, "relabel_unknown": 2, "insert": 4}
#: Order of preference between ways of one cost.
KINDS = ("keep", "merge", "relabel", "merge_relabel")
OPEN = "<|{role}|>\n"
CLOSE = "<|end|>\n"


def steps(role: str | None, costs: dict[str, int]) -> list[tuple[int, int, int, str, str, str]]:
    """Ways to take a turn of a role: (from, to, cost, role taken, kind, roles inserted before)."""
    state = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}
    out = []
    for as_role in ROLES:
        change = 0 if as_role == role else costs["relabel"] if role in ROLES else costs["relabel_unknown"]
        kind = "relabel" if change else "keep"
        for at in (START, SYSTEM, USER, ASSISTANT):
            if as_role == "system":
                legal = {START: ""}
            elif as_role == "user":
                legal = {START: "", SYSTEM: "", ASSISTANT: "", USER: "assistant"}
            else:
                legal = {USER: "", START: "user", SYSTEM: "user", ASSISTANT: "user"}
            if at in legal:
                out.append((at, state[as_role], change + costs["insert"] * bool(legal[at]), as_role, kind, legal[at]))
            if at == state[as_role]:
                out.append((at, at, change + costs["merge"], as_role, "merge_relabel" if change else "merge", ""))
    return sorted(out, key=lambda s: (s[2], KINDS.index(s[4]), s[5], ROLES.index(s[3])))


def end_cost(costs: dict[str, int]) -> list[int]:
    """Cost of ending in each state: an empty assistant turn, after an empty user turn if need be."""
    return [2 * costs["insert"], 2 * costs["insert"], costs["insert"], 0]


def _matrix(role: str | None, costs: dict[str, int], known: dict) -> np.ndarray:
    if role not in known:
        m = np.full((4, 4), NONE, np.int64)
        for a, b, c, *_ in steps(role, costs):
            m[a, b] = min(m[a, b], c)
        known[role] = m
    return known[role]


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(1), NONE)


def repair_part(roles: list[str | None], enter: int, leave: int, costs: dict[str, int]) -> list[tuple[str, str, str]]:
    """(role, kind, role inserted before) of each turn on a cheapest way from one state to another."""
    ways, best = {}, [{enter: 0}]
    back: list[dict] = []
    for role in roles:
        if role not in ways:
            ways[role] = steps(role, costs)
        now, trace = {}, {}
        for s in ways[role]:
            if s[0] in best[-1] and (c := best[-1][s[0]] + s[2]) < now.get(s[1], NONE):
                now[s[1]], trace[s[1]] = c, s
        best.append(now)
        back.append(trace)
    out, at = [], leave
    for trace in reversed(back):
        s = trace[at]
        out.append((s[3], s[4], s[5]))
        at = s[0]
    return out[::-1]


def _escaped(text: str) -> str:
    """Text in which nothing reads as a marker: a zero-width space goes into each "<|"."""
    return text.replace("<|", "<\u200b|")


def _table(rows: list, schema: pa.Schema) -> list[pa.Array]:
    return [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)]


_TURN = pa.schema([("c", pa.int64()), ("seg", pa.int64()), ("k", pa.int64()), ("t", pa.int64()), ("r", pa.string()), ("x", pa.string()), ("n", pa.int64()), ("m", pa.list_(pa.int64()))])
_LINK = pa.schema([("c", pa.int64()), ("seg", pa.int64()), ("enter", pa.int32()), ("leave", pa.int32()), ("before", pa.int64()), ("last", pa.bool_()), ("cost", pa.int64())])
_OUT = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("part", pa.int64()), ("role", pa.string()), ("kind", pa.string()), ("inserted", pa.string()), ("added", pa.string()), ("cost", pa.int64()), ("rendered", pa.string())])


def _segments(costs: dict[str, int], size: int):
    """Turns, in order, with the segment that each is in; the last turn of a segment has its number of turns and matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        held, made, n, m, rows = None, -1, 0, None, []
        for batch in batches:
            for p, c, t, r, x in zip(*(a.to_pylist() for a in batch.columns), strict=True):
                if held is not None and (held[0] != c or n == size):
                    rows.append((*held, n, m.ravel().tolist()))
                    held, m = None, None
                elif held is not None:
                    rows.append((*held, None, None))
                if held is None:
                    made, n = made + 1, 0
                step = _matrix(r, costs, known)
                m = step if m is None else _times(m, step)
                held = (c, (p << 40) + made, n, t, r, x)
                n += 1
            if rows:
                yield pa.record_batch(_table(rows, _TURN), schema=_TURN)
                rows = []
        if held is not None:
            yield pa.record_batch(_table([(*held, n, m.ravel().tolist())], _TURN), schema=_TURN)

    return run


def _runs(key: str, made, schema: pa.Schema):
    """What made gives of the rows of each value of key, which come one after another, in batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            out: list[tuple] = []
            for r in batch.to_pylist():
                if held and held[0][key] != r[key]:
                    out += made(held)
                    held = []
                held.append(r)
            if out:
                yield pa.record_batch(_table(out, schema), schema=schema)
        if held:
            yield pa.record_batch(_table(made(held), schema), schema=schema)

    return run


def _chained(costs: dict[str, int]):
    """The states in which the segments of a dialogue are entered and left on a cheapest way."""

    def made(rows: list[dict]) -> list[tuple]:
        ms = [np.array(r["m"], np.int64).reshape(4, 4) for r in rows]
        best, back = np.full(4, NONE, np.int64), []
        best[START] = 0
        for m in ms:
            ways = best[:, None] + m
            back.append(ways.argmin(0))
            best = np.minimum(ways.min(0), NONE)
        total = best + np.array(end_cost(costs))
        at, cost, out = int(total.argmin()), int(total.min()), []
        after = sum(r["n"] for r in rows)
        for i in range(len(rows) - 1, -1, -1):
            enter = int(back[i][at])
            after -= rows[i]["n"]
            out.append((rows[i]["c"], rows[i]["seg"], enter, at, after, i + 1 == len(rows), cost))
            at = enter
        return out

    return _runs("c", made, _LINK)


def _rendered(costs: dict[str, int]):
    def made(rows: list[dict]) -> list[tuple]:
        way, out = repair_part([r["r"] for r in rows], rows[0]["enter"], rows[0]["leave"], costs), []
        for i, (r, (role, kind, inserted)) in enumerate(zip(rows, way, strict=True)):
            part, text = r["before"] + r["k"], _escaped(r["x"])
            if kind in ("merge", "merge_relabel"):
                shown = "\n" + text
            else:
                shown = CLOSE * (part > 0) + (OPEN.format(role=inserted) + CLOSE if inserted else "") + OPEN.format(role=role) + text
            added = ""
            if r["last"] and i + 1 == len(rows):
                shown += CLOSE
                added = {USER: "assistant", ASSISTANT: ""}.get(r["leave"], "user,assistant")
                shown += "".join(OPEN.format(role=x) + CLOSE for x in added.split(",") if x)
            out.append((r["c"], r["t"], part, role, kind, inserted, added, r["cost"], shown))
        return out

    return _runs("seg", made, _OUT)


def format_chats(turns: DataFrame, costs: dict[str, int] | None = None, segment: int = 5000, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Repair every dialogue at least cost and render it.

    Returns a row for each turn given: id_col, turn, part (its place in the dialogue, from 0), role (repaired), kind (keep,
    merge, relabel, merge_relabel; merged turns continue the turn before them), inserted (role of an empty turn put before
    it, or ""), added (roles of empty turns put at the dialogue's end, on its last row), cost (of the whole dialogue) and
    rendered. The rendered strings of a dialogue, in order of part, one after another, are the repaired dialogue; merged
    texts are joined by a line end.

    Roles are compared trimmed and in lower case; null or unknown ones are relabelled. A null text counts as empty. Turns
    are taken in order of (turn, role, text), null turns first; rows of a null id form one dialogue. Repeated rows are
    turns of their own. An empty table gives an empty one. Other columns are not read. No dialogue is gathered in one
    task: at most `segment` turns are held together.
    """
    reachable(turns.sparkSession)
    costs = COSTS | (costs or {})
    base = turns.select(turns[id_col].cast("long").alias("c"), turns[turn_col].cast("long").alias("t"), F.lower(F.trim(turns[role_col].cast("string"))).alias("r"), F.coalesce(turns[text_col].cast("string"), F.lit("")).alias("x"))
    base = base.withColumn("h", F.xxhash64("x")).repartitionByRange("c", "t", "r", "h").sortWithinPartitions("c", "t", "r", "h", "x")
    base = base.select(F.spark_partition_id().cast("long").alias("p"), "c", "t", "r", "x")
    base = materialize(base.mapInArrow(_segments(costs, segment), "c long, seg long, k long, t long, r string, x string, n long, m array<bigint>"), "turns")
    # a small matrix for each segment; the segments of a dialogue come one after another
    chain = base.filter("m is not null").select("c", "seg", "n", "m").repartition("c").sortWithinPartitions("c", "seg")
    chain = chain.mapInArrow(_chained(costs), "c long, seg long, enter int, leave int, before long, last boolean, cost long")
    placed = base.select("seg", "k", "t", "r", "x").join(chain, "seg")
    out = placed.repartition("seg").sortWithinPartitions("seg", "k").mapInArrow(_rendered(costs), "conv_id long, turn long, part long, role string, kind string, inserted string, added string, cost long, rendered string")
    return out.withColumnRenamed("conv_id", id_col)
