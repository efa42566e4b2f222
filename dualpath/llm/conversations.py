"""Conversation structure repair on a suffix-shared automaton of role and fault signatures.

Each row is one symbol, its role and its first fault, and a conversation is the string of its symbols. The distinct strings are
laid into an automaton that is shared from the end: a node is a symbol and the node after it, and nodes whose costs to go are
alike in all states of the grammar are one. For a node and a state the cost to go, the best edits up to the next row and
the state after them are found once, whatever the number of conversations that end that way.

Rows are cut by ranges of (conversation, turn), so that a conversation of any length is in several pieces. A piece is a
string of its own; what the pieces after it cost is one of few classes, and a piece maps each class to another, so the pieces
of a conversation are put together from one small row each.

The repaired text of a conversation is hashed in order, by one task at constant memory: that much a digest needs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dualpath.llm import common

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
PIECE_BYTES = 32 << 20
ROLES = "sua"  # initials by number; 3 is any other
FAULTS = ("none", "truncated", "blank", "duplicate")  # by number; the last two must go
LEGAL = {(0, 1), (1, 2), (2, 1)}

# The grammar (s?(ua)+)?: 0 at the start, 1 after s, 2 after u, 3 after a; it may end in 0 and 3.
STEP = ({0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2})
NEEDED = (1, 1, 2, 1)  # the role, user or assistant, that a state can take
NAMES = {1: "user", 2: "assistant"}
TAIL = ("", "II", "I", "")  # what a state inserts to end
LAST = tuple(INSERT * len(t) for t in TAIL)

SPACE = " \t\n\x0b\x0c\r"


class Automaton:
    """Classes of costs to go by grammar state, less their least, and the steps between them, each computed once."""

    def __init__(self):
        self.classes = [LAST]
        self.number = {LAST: 0}
        self.steps: dict[tuple[int, int], tuple] = {}

    def step(self, symbol: int, after: int) -> tuple:
        """Class before the row, its offset, and per state the edits up to the next row and the state after them."""
        found = self.steps.get((symbol, after))
        if found is None:
            found = self.steps[symbol, after] = self._step(symbol, self.classes[after])
        return found

    def _step(self, symbol: int, to_go: tuple) -> tuple:
        role, fault = divmod(symbol, 4)
        best = []
        for state in range(4):
            options = [(DELETE + to_go[state], "D", state)]
            if fault < 2:
                more = TRUNCATED * fault
                if role in STEP[state]:
                    options.append((KEEP + more + to_go[STEP[state][role]], "K", STEP[state][role]))
                to = STEP[state][NEEDED[state]]
                options.append((REROLE + more + to_go[to], "R", to))
            best.append(min(options))
        for _ in range(4):  # inserts before the row: no more than lead through all states
            best = [min(own, (INSERT + best[to][0], "I" + best[to][1], best[to][2])) for own, to in ((best[q], STEP[q][NEEDED[q]]) for q in range(4))]
        least = min(b[0] for b in best)
        costs = tuple(b[0] - least for b in best)
        if costs not in self.number:
            self.number[costs] = len(self.classes)
            self.classes.append(costs)
        return self.number[costs], least, tuple(b[1] for b in best), tuple(b[2] for b in best)

    def close(self) -> Automaton:
        """All classes that any string leads to."""
        done = 0
        while done < len(self.classes):
            for symbol in range(16):
                self.step(symbol, done)
            done += 1
        return self


AUTOMATON = Automaton().close()


class SharedSuffixes:
    """Strings that come in the order of their reverses, each node of the automaton of their suffixes visited once.

    Only the nodes of the present string are held.
    """

    def __init__(self, after: int):
        self.symbols, self.nodes, self.costs = "", [after], [0]

    def lay(self, backwards: str) -> None:
        shared = 0
        for a, b in zip(self.symbols, backwards):
            if a != b:
                break
            shared += 1
        del self.nodes[shared + 1 :], self.costs[shared + 1 :]
        for symbol in backwards[shared:]:
            before, cost, _, _ = AUTOMATON.step(int(symbol, 16), self.nodes[-1])
            self.nodes.append(before)
            self.costs.append(self.costs[-1] + cost)
        self.symbols = backwards

    def walk(self, state: int) -> tuple[str, int, int]:
        """The cheapest edits from a state at the first row on, their cost, and the state after them."""
        out, began = [], state
        for at in range(len(self.symbols), 0, -1):
            _, _, letters, to = AUTOMATON.step(int(self.symbols[at - 1], 16), self.nodes[at - 1])
            out.append(letters[state])
            state = to[state]
        cost = self.costs[-1] + AUTOMATON.classes[self.nodes[-1]][began] - AUTOMATON.classes[self.nodes[0]][state]
        return "".join(out), cost, state


def damaged(conversations: DataFrame) -> DataFrame:
    """conv, conv_id, turn, role, text: the rows after damage; conv is conv_id as text, one space if null.

    By crc32(conv:turn) % 20: 0 drops a row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it the
    user's. Nulls are one space.
    """
    blank = F.lit(" ")
    read = conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), blank).alias("conv"),
        "turn",
        F.coalesce("role", blank).alias("role"),
        F.coalesce("text", blank).alias("text"),
    )
    fault = F.crc32(F.concat("conv", F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)).cast("binary")) % 20
    read = read.withColumn("_fault", fault).filter("_fault <> 0")
    text = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_fault") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("_fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return read.select("conv", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def placed(rows: DataFrame) -> DataFrame:
    """conv, turn, role, text, at, key, fault: the rows in order, written. `at` rises in a conversation; at >> 33 is its piece.

    Rows of a turn are ordered by role, then by the MD5 of their text. Equal rows are told apart by their place in the input,
    so that they too may be cut.
    """
    spark = rows.sparkSession
    size = rows.agg(F.sum(F.octet_length("text") + 40)).first()[0] or 0
    parts = max(common.partitions(spark), common.pieces(size, PIECE_BYTES))
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = F.when(trimmed == "", 2).when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), 1).otherwise(0)
    same = F.concat(F.col("conv"), F.lit(":"), F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    keyed = rows.withColumns({"key": F.unhex(F.md5(same.cast("binary"))), "fault": fault, "_salt": F.monotonically_increasing_id()})
    order = ["conv", F.asc_nulls_first("turn"), "role", F.md5(F.col("text").cast("binary")), "_salt"]
    dealt = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("_salt")
    return common.written(dealt.withColumn("at", F.monotonically_increasing_id()), "conversations")


def signatures(rows: DataFrame) -> DataFrame:
    """conv, piece, sig: per conversation and piece one hexadecimal digit a row, 4 * role + fault."""
    initial = F.left("role", F.lit(1))
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    light = rows.select("conv", "at", "key", "fault", role.alias("r"))
    first = light.groupBy("key").agg(F.min("at").alias("first"))
    fault = F.when((F.col("fault") != 2) & (F.col("at") > F.col("first")), 3).otherwise(F.col("fault"))
    coded = light.join(first, "key").select("conv", "at", F.lower(F.hex(4 * F.col("r") + fault)).alias("c"))
    listed = F.sort_array(F.collect_list(F.struct("at", "c")))
    each = coded.groupBy("conv", F.shiftright("at", 33).alias("piece")).agg(F.array_join(listed["c"], "").alias("sig"))
    return common.written(each, "signatures")


TABLE = "before array<int>, offset array<int>, state array<int>"


def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sig to what each class after it becomes: the class before it, the offset, and the state left by each state."""
    for batch in batches:
        out = []
        for sig in batch.column("sig").to_pylist():
            row = {"sig": sig, "before": [], "offset": [], "state": []}
            for after in range(len(AUTOMATON.classes)):
                laid = SharedSuffixes(after)
                laid.lay(sig[::-1])
                row["before"].append(laid.nodes[-1])
                row["offset"].append(laid.costs[-1])
                row["state"] += [laid.walk(q)[2] for q in range(4)]
            out.append(row)
        ints = pa.list_(pa.int32())
        yield pa.RecordBatch.from_pylist(out, pa.schema([("sig", pa.string()), ("before", ints), ("offset", ints), ("state", ints)]))


PLAN = "conv string, piece long, sig string, after int, state int, last boolean, joint long"


def _put_together(pieces: pd.DataFrame) -> pd.DataFrame:
    """One conversation's pieces: the class after each, the state before it, and whether its join is illegal."""
    pieces = pieces.sort_values("piece")
    after, classes = 0, []
    for before in reversed(pieces["before"].tolist()):
        classes.append(after)
        after = int(before[after])
    classes.reverse()
    state, states, joints, role = 0, [], [], None
    for sig, table, c in zip(pieces["sig"], pieces["state"], classes):
        states.append(state)
        state = int(table[4 * c + state])
        joints.append(int(role is not None and (role, int(sig[0], 16) // 4) not in LEGAL))
        role = int(sig[-1], 16) // 4
    out = pieces[["conv", "piece", "sig"]].copy()
    out["after"], out["state"], out["last"], out["joint"] = classes, states, [False] * (len(out) - 1) + [True], joints
    return out


REPAIR = "sig string, after int, state int, last boolean, audit string, cost long, blank long, duplicate long, truncated long, illegal long"


def repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct strings, sorted by class and reverse, to their edits and counts."""
    laid, of = None, None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if laid is None or of != row["after"]:
                laid, of = SharedSuffixes(row["after"]), row["after"]
            laid.lay(row.pop("backwards"))
            audit, cost, state = laid.walk(row["state"])
            if row["last"]:
                audit, cost = audit + TAIL[state], cost + LAST[state]
            digits = [int(c, 16) for c in row["sig"]]
            faults = [d % 4 for d in digits]
            illegal = sum((a // 4, b // 4) not in LEGAL for a, b in zip(digits, digits[1:]))
            counts = {name: faults.count(FAULTS.index(name)) for name in ("blank", "duplicate", "truncated")}
            out.append({**row, "audit": audit, "cost": cost, **counts, "illegal": illegal})
        kinds = [(n, pa.bool_() if n == "last" else t) for n, t in common.arrow_types(REPAIR).items()]
        yield pa.RecordBatch.from_pylist(out, pa.schema(kinds))


def audits(pieces: DataFrame) -> DataFrame:
    """conv, piece, joint and the columns of REPAIR: the edits of each piece."""
    spark = pieces.sparkSession
    number = pieces.groupBy("conv").agg(F.count(F.lit(1)).alias("pieces"))
    counted = pieces.join(number, "conv")
    alone = counted.filter("pieces = 1").select("conv", "piece", "sig", F.lit(0).alias("after"), F.lit(0).alias("state"), F.lit(True).alias("last"), F.lit(0).cast("long").alias("joint"))
    # A conversation is in several pieces only where a range ends in it.
    cut = counted.filter("pieces > 1").drop("pieces")
    table = cut.select("sig").distinct().mapInArrow(tables, f"sig string, {TABLE}")
    several = cut.join(table, "sig").groupBy("conv").applyInPandas(_put_together, PLAN)
    plan = common.written(alone.unionByName(several), "plan")
    distinct = plan.select("sig", "after", "state", "last").distinct().withColumn("backwards", F.reverse("sig"))
    dealt = distinct.repartitionByRange(common.partitions(spark), "after", "backwards").sortWithinPartitions("after", "backwards")
    found = common.written(dealt.mapInArrow(repairs, REPAIR), "repairs")
    return plan.join(found, ["sig", "after", "state", "last"])


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str | None, int | None, str, str] | tuple[str, None]]:
    """Rows after their piece's audit, to (conv, edit, turn, role, text), and (conv, None) after its last."""
    conv, audit, at, state = None, "", 0, 0

    def inserts():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            at += 1
            role = NEEDED[state]
            state = STEP[state][role]
            yield conv, "I", None, NAMES[role], ""

    for batch in batches:
        for row in batch.to_pylist():
            if row["conv"] != conv:
                if conv is not None:
                    yield from inserts()
                    yield conv, None
                conv, audit, at, state = row["conv"], "", 0, 0
            if row["audit"] is not None:
                yield from inserts()
                audit, at = row["audit"], 0
                continue
            yield from inserts()
            edit, role = audit[at], row["role"]
            at += 1
            if edit == "R":
                state, role = STEP[state][NEEDED[state]], NAMES[NEEDED[state]]
            elif edit == "K":
                state = STEP[state][ROLES.index(role[:1])]
            yield conv, edit, row["turn"], role, row["text"]
    if conv is not None:
        yield from inserts()
        yield conv, None


def _in_order(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The audit of each piece before the piece's rows, each conversation in one partition."""
    marks = found.select("conv", F.shiftleft("piece", 33).alias("at"), F.lit(0).alias("kind"), "audit")
    both = rows.select("conv", "at", F.lit(1).alias("kind"), "turn", "role", "text").unionByName(marks, allowMissingColumns=True)
    order = ["conv", F.shiftright("at", 33), "kind", "at"]
    n = common.partitions(rows.sparkSession)
    return both.repartition(n, "conv").sortWithinPartitions(*order).select("conv", "turn", "role", "text", "audit")


def _to_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, place, of = [], 0, None
    for conv, edit, *rest in _edits(batches):
        if edit is None:
            continue
        place, of = (place + 1 if conv == of else 0), conv
        out.append((conv, place, edit, *rest))
        if len(out) == 1000:
            yield _batch(out)
            out = []
    if out:
        yield _batch(out)


REPAIRED = "conv string, place long, edit string, turn long, role string, text string"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = common.arrow_types(REPAIRED)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.values())], names=list(kinds))


def _to_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own, lines, out = hashlib.sha256(), 0, []
    for conv, edit, *rest in _edits(batches):
        if edit is None:
            out.append((conv, own.hexdigest()))
            own, lines = hashlib.sha256(), 0
        elif edit != "D":
            own.update(("\n" * (lines > 0) + f"{rest[1]}:{rest[2]}").encode())
            lines += 1
        if len(out) == 1000:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], names=["conv", "sha"])
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], names=["conv", "sha"])


class Repair:
    """The repair of a table conversations (conv_id, turn, role, text); other columns are not read.

    Null conv_ids are one conversation. Null turns come first; rows of one turn are ordered by role, then by the MD5 of their
    text, and repeated rows count each. Null roles and texts are one space: no role of the grammar, and blank. An empty table
    gives empty results.
    """

    def __init__(self, conversations: DataFrame, damage=damaged):
        common.tune(conversations.sparkSession)
        self.conversations = conversations
        self.rows = placed(damage(conversations))
        self.pieces = audits(signatures(self.rows))

    def repaired(self) -> DataFrame:
        """conv, place, edit, turn, role, text: every row with its edit (K, R, D or I), in order; all but D stay."""
        return _in_order(self.rows, self.pieces).mapInArrow(_to_rows, REPAIRED)

    def report(self) -> DataFrame:
        """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: one row per conversation."""
        turns = self.rows.select("conv", "turn").distinct().groupBy("conv")
        wide = [F.col(c).cast("decimal(20,0)") for c in ("high", "low", "n")]
        gaps = turns.agg(F.max("turn").alias("high"), F.min("turn").alias("low"), F.count("turn").alias("n")).select(
            "conv", F.least(F.coalesce(wide[0] - wide[1] + 1 - wide[2], F.lit(0)), F.lit((1 << 63) - 1)).cast("long").alias("gaps")
        )
        sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "cost")]
        whole = F.array_join(F.sort_array(F.collect_list(F.struct("piece", "audit")))["audit"], "")
        totals = self.pieces.groupBy("conv").agg(*sums, F.sum(F.col("illegal") + F.col("joint")).alias("illegal"), whole.alias("audit"))
        digests = _in_order(self.rows, self.pieces).mapInArrow(_to_digests, "conv string, sha string")
        named = self.conversations.select("conv_id").distinct().withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")))
        out = named.join(totals, "conv", "left").join(gaps, "conv", "left").join(digests, "conv", "left")
        zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
        none = F.lit(hashlib.sha256(b"").hexdigest())
        return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", none).alias("repaired_sha256"))
