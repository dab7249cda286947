"""Conversation repair beside a plain search, and its edge cases."""

import hashlib
import random
import re
import zlib

import pytest

from chatloom.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, c int, pos string, fault string"
SPACE = " \t\n\x0b\x0c\r"


def plain(rows):
    """Least (cost, audit, repaired) over all ways, kept by the last role written."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        left = text.strip(SPACE)
        faults.append("blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else "")
        seen.add((role, text))
    after, names = {"": "u", "s": "u", "u": "a", "a": "u"}, {"u": "user:", "a": "assistant:"}

    def inserted(ways):
        for _ in range(3):
            for q, (c, a, o) in list(ways.items()):
                n = after[q]
                if n not in ways or (c + 3, a + "I") < ways[n][:2]:
                    ways[n] = (c + 3, a + "I", (*o, names[n]))
        return ways

    ways = {"": (0, "", ())}
    for (_, role, text), fault in zip(rows, faults, strict=True):
        new = {}
        for q, (c, a, o) in inserted(ways).items():
            found = [(q, (c + 4, a + "D", o))]
            if fault not in ("blank", "duplicate"):
                cut = 3 * (fault == "truncated")
                if (role[:1], q) in {("s", ""), ("u", ""), ("u", "s"), ("u", "a"), ("a", "u")}:
                    found.append((role[:1], (c + cut, a + "K", (*o, f"{role}:{text}"))))
                found.append((after[q], (c + 3 + cut, a + "R", (*o, names[after[q]] + text))))
            for n, w in found:
                new[n] = min(new.get(n, w), w)
        ways = new
    c, a, o = min(w for q, w in inserted(ways).items() if q in ("", "a"))
    first, turns = [r[1][:1] for r in rows], [r[0] for r in rows if r[0] is not None]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, "blank": faults.count("blank"), "duplicate": faults.count("duplicate"), "truncated": faults.count("truncated"),
        "illegal": sum(p + q not in ("su", "ua", "au") for p, q in zip(first, first[1:], strict=False)), "cost": c, "audit": a, "repaired_sha256": hashlib.sha256("\n".join(o).encode()).hexdigest(),
    }


def harmed(rows):
    out = []
    for c, t, role, text in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(c, t, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def table_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "p", "f") for r in rows], SCHEMA)


def drawn(seed, sizes):
    draw, rows = random.Random(seed), []
    for c, n in sizes.items():
        for i in range(n):
            role = draw.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "ux"])
            rows.append((c, None if draw.random() < 0.05 else draw.randint(0, 2 * n), role, draw.choice(["a.", "b!", "c", "d?", "", " \n", None, "e. ", f"own {i}.", f"own {i}", "Ж" * 70 + "."])))
    return rows


@pytest.mark.parametrize("segment", [2, 40, 5000])
def test_repair_is_the_plain_search(spark, segment):
    rows = drawn(segment, {None: 9, 1: 30, 2: 1, 3: 5, 9: 120})
    made = repair.repair_conversations(repair.damaged(table_of(spark, rows)), segment=segment)
    got = {r.conv_id: r.asDict() for r in made.conversations().collect()}
    hashes = {r.conv_id: r.repaired_sha256 for r in repair.repaired_digest(made).collect()}
    want: dict = {}
    for c, *r in harmed(rows):
        want.setdefault(c, []).append(tuple(r))
    assert {c: v | {"repaired_sha256": hashes[c]} for c, v in got.items()} == {c: plain(r) | {"conv_id": c} for c, r in want.items()}


def test_repaired_turns_and_edits(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Hi"), (1, 2, "user", "Hi"), (1, 3, "user", " ")]
    made = repair.repair_conversations(table_of(spark, rows))
    got = [(r.fault, r.edits, r.tail, [tuple(x) for x in r.repaired]) for r in made.turns().orderBy("place").collect()]
    assert [g[0] for g in got] == ["", "", "truncated", "duplicate", "blank"]
    assert "".join(g[1] + g[2] for g in got) == made.conversations().first().audit
    flat = [role[0] for g in got for role, _ in g[3]]
    assert re.fullmatch("(s?(ua)+)?", "".join(flat))
    assert plain([r[1:] for r in rows])["audit"] == made.conversations().first().audit


def test_repair_of_nothing_and_of_very_many_alike(spark):
    none = repair.repair_conversations(table_of(spark, []).filter("conv_id < 0"))
    assert (none.conversations().count(), none.turns().count(), repair.repaired_digest(none).count()) == (0, 0, 0)
    # one conversation of one row repeated, and a long text: the first stays, the second becomes the answer, the rest goes
    made = repair.repair_conversations(table_of(spark, [(5, 1, "user", "word " * 100_000 + "end.")] + [(5, 2, "user", "same.")] * 3000), segment=100)
    r = made.conversations().first()
    assert (r.duplicate, r.blank, r.truncated, r.illegal) == (2999, 0, 0, 3000) and r.cost == 4 * 2999 + 3 and r.audit == "KR" + 2999 * "D"


def test_runs_that_meet_stop_early():
    known = repair.Automaton()
    draw = random.Random(3)
    symbols = bytes(draw.randrange(12) for _ in range(400))
    for end in [(0, 6, 3, 0), (0, 0, 0, 0), (9, 0, 2, 1)]:
        out = known.run(symbols, end)
        assert known.rerun(symbols, end, (0, 0, 0, 0), known.run(symbols, (0, 0, 0, 0))) == out
