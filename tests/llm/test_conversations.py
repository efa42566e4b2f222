"""Conversation repair against a search for the cheapest edits, with conversations in one piece and in many."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter

import pytest

from dualpath.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string, conv string, at long, audit string, key string"


def given():
    draw = random.Random(4)
    out = []
    for conv in range(60):
        for turn in range(draw.randint(0, 9)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = draw.choice(["Yes.", "No!", "cut off", None, "", " \t\n", "Really?\n ", f"words {draw.randint(0, 9)}.", "é \U0001f642", " "])
            out.append((conv, turn + draw.choice([0, 0, 2]), role, text))
    out += [(70, None, "user", "a."), (70, None, "assistant", "b."), (70, None, None, None), (71, None, "user", "c."), (None, 1, "user", "d."), (None, None, "system", "e.")]
    out += [(72, 5, "user", "same."), (72, 5, "user", "same."), (72, 5, "assistant", "x" * 50_000), (73, -9, "assistant", "f."), (73, 2**62, "user", "g")]
    out += [(80, t, ("user", "assistant", "system")[t % 7 % 3], f"long {t % 180}" + ("." if t % 11 else "")) for t in range(400)]
    return [(*r, "c", 1, "K", "k") for r in out]


def step(state, initial):
    return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))


def repair(rows):
    """Cheapest (cost, audit) and the lines it leaves, by a best-first search."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, audit, lines
        moves = [(3, "I", i, r[0], (f"{r}:",)) for r in ("user", "assistant") if step(state, r[0])]
        if i < len(rows):
            role, text, fault = rows[i]
            moves.append((4, "D", i + 1, None, ()))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if step(state, role[:1]):
                    moves.append((more, "K", i + 1, role[:1], (f"{role}:{text}",)))
                moves += [(3 + more, "R", i + 1, r[0], (f"{r}:{text}",)) for r in ("user", "assistant") if step(state, r[0])]
        for c, letter, j, to, line in moves:
            heapq.heappush(heap, (cost + c, audit + letter, j, state if to is None else step(state, to), (lines, line)))


def flat(lines):
    out = []
    while lines:
        lines, line = lines
        out = [*line, *out]
    return out


def plain(table):
    out = {}
    for conv in {r[0] for r in table}:
        rows = []
        for _, turn, role, text in [r[:4] for r in table if r[0] == conv]:
            role, text = " " if role is None else role, " " if text is None else text
            fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            rows += [(turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        marked, seen = [], set()
        for _, role, text in rows:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = {t for t, _, _ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        count = Counter(f for _, _, f in marked)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, lines = repair(marked)
        digest = hashlib.sha256("\n".join(flat(lines)).encode()).hexdigest()
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest)
    return out


@pytest.mark.parametrize("piece", [32 << 20, 300])
def test_repair(spark, monkeypatch, piece):
    monkeypatch.setattr(C, "PIECE_BYTES", piece)
    own = C.Repair(spark.createDataFrame(given(), SCHEMA).repartition(5))
    got = {r["conv_id"]: tuple(r)[1:] for r in own.report().collect()}
    want = plain(given())
    assert got == want and own.report().count() == len(want)
    cut = own.pieces.groupBy("conv").count().filter("count > 1").count()
    assert cut > (20 if piece == 300 else 0)
    rows = [r for r in own.repaired().orderBy("conv", "place").collect() if r["conv"] == "80"]
    assert "".join(r["edit"] for r in rows) == want[80][6] and [r["place"] for r in rows] == list(range(len(rows)))
    text = "\n".join(f"{r['role']}:{r['text']}" for r in rows if r["edit"] != "D")
    assert hashlib.sha256(text.encode()).hexdigest() == want[80][7]
    assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in rows if r["edit"] != "D"))


def test_repair_of_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert C.Repair(none).report().count() == 0 and C.Repair(none).repaired().count() == 0
    gone = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    row = C.Repair(spark.createDataFrame([(5, gone, "user", "x.", "c", 1, "K", "k")], SCHEMA)).report().collect()
    assert [tuple(r) for r in row] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_suffixes_are_shared_and_classes_finite():
    assert len(C.AUTOMATON.classes) < 40
    draw = random.Random(2)
    strings = sorted({"".join(draw.choice("0123456789abcdef") for _ in range(draw.randint(1, 8)))[::-1] for _ in range(300)})
    laid = C.SharedSuffixes(0)
    for backwards in strings:
        laid.lay(backwards)
        alone = C.SharedSuffixes(0)
        alone.lay(backwards)
        assert laid.nodes == alone.nodes and laid.costs == alone.costs
        for state in range(4):
            audit, cost, end = laid.walk(state)
            spent = sum({"K": 0, "R": 3, "D": 4, "I": 3}[e] for e in audit)
            kept = [d for d, e in zip(backwards[::-1], audit.replace("I", "")) if e != "D"]
            assert cost == spent + 3 * sum(int(d, 16) % 4 == 1 for d in kept) and all(int(d, 16) % 4 < 2 for d in kept)
            assert end in range(4)
