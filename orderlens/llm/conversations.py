"""Cheapest repair of conversations whose rows were lost, emptied, cut, repeated or mislabelled.

A repaired conversation's roles are nothing, or an optional system row and then pairs of a user
and an assistant row. Edits keep, rerole, delete or insert rows; the cheapest sequence of edits is
found by iterative-deepening A*: a depth-first search tries the edits in ASCII order under a cost
bound that grows to the least bound any cut branch needs. A table of failed states keeps the bound
each of them is known to need, so no state is searched twice with too small a bound. The first
accepting path is the answer, as the least bound that has one is reached first.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrowtext import partitions

#: Rows searched together. A longer conversation is cut; stretches are joined by their states.
SEGMENT = 32
#: Results of searches a task remembers, by the rows' kinds.
MEMORY = 50_000
_OUT_BYTES = 4 << 20

# Where the roles' pattern stands: nothing yet, after a system row, after a user's, after a reply.
START, SYSTEM, USER, REPLY = range(4)
_ENDS = frozenset((START, REPLY))
_KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": REPLY}, {"u": USER})
_WANTED = (("user", USER), ("user", USER), ("assistant", REPLY), ("user", USER))
_DELETE, _INSERT, _REROLE, _CUT_OFF = 2, 5, 1, 5

# What is wrong with a row.
FINE, TRUNCATED, UNUSABLE = range(3)
_LEGAL = {"su", "ua", "au"}


def cheapest_edits(rows: list[tuple[str, int]], entry: int = START, ends=_ENDS,
                   last: bool = True) -> tuple[int, str] | None:
    """Cost and edits (initials; the ASCII-least of the cheapest) that lead through ``rows`` (role
    initial, what is wrong) from one state of the pattern to one of ``ends``; None if none does.
    Nothing is inserted behind the rows unless they are the ``last``."""
    n = len(rows)
    least = [0] * (n + 1)       # bound from below: what each row costs at least
    for i in range(n - 1, -1, -1):
        initial, wrong = rows[i]
        alone = _DELETE if wrong else 0 if initial in ("s", "u", "a") else _REROLE
        least[i] = least[i + 1] + alone
    failed: dict[tuple[int, int], int] = {}
    path: list[str] = []

    def search(i: int, q: int, left: int) -> bool:
        if i == n and q in ends:
            return True
        need = 1 << 60

        def tried(edit: str, cost: int, j: int, r: int) -> bool:
            nonlocal need
            lower = cost + max(least[j], failed.get((j, r), 0))
            if lower <= left:
                if search(j, r, left - cost):
                    path.append(edit)
                    return True
                lower = cost + failed[j, r]
            need = min(need, lower)
            return False

        role, then = _WANTED[q]
        if i < n and tried("D", _DELETE, i + 1, q):
            return True
        if (i < n or last) and tried("I", _INSERT, i, then):
            return True
        if i < n and rows[i][1] != UNUSABLE:
            initial, wrong = rows[i]
            more = _CUT_OFF if wrong else 0
            kept = _KEPT[q].get(initial)
            if kept is not None and tried("K", more, i + 1, kept):
                return True
            if tried("R", _REROLE + more, i + 1, then):
                return True
        failed[i, q] = max(need, failed.get((i, q), 0))
        return False

    bound, most = least[0], 2 * n + 3 * _INSERT     # whatever can be reached costs no more
    while bound <= most:
        if search(0, entry, bound):
            return bound, "".join(reversed(path))
        bound = failed[0, entry]
    return None


class _Segments:
    """Searches of stretches of rows, remembered by the kinds of their rows."""

    def __init__(self):
        self.known: dict = {}

    def ways(self, rows: list[tuple[str, int]], entry: int, last: bool):
        """(end state, cost, edits) for every end state that can be reached."""
        key = (tuple(rows), entry, last)
        found = self.known.get(key)
        if found is None:
            targets = [_ENDS] if last else [frozenset((q,)) for q in range(4)]
            found = []
            for ends in targets:
                best = cheapest_edits(rows, entry, ends, last)
                if best is not None:
                    found.append((min(ends) if len(ends) == 1 else REPLY, *best))
            if len(self.known) >= MEMORY:
                self.known.clear()
            self.known[key] = found
        return found


def _repaired(rows: list, edits: str, entry: int) -> Iterator[str]:
    """``role:text`` of the rows that ``edits`` leave."""
    at, q = 0, entry
    for edit in edits:
        role, then = _WANTED[q]
        if edit == "I":
            yield f"{role}:"
            q = then
            continue
        old, text = rows[at]
        at += 1
        if edit == "K":
            yield f"{old}:{text}"
            q = _KEPT[q][old[:1]]
        elif edit == "R":
            yield f"{role}:{text}"
            q = then


class _Conversation:
    """One conversation's rows as they come, in order. Holds at most two segments of rows, and for
    each state of the pattern the cheapest edits that lead there: their cost, the edits since all
    of those agree, and the running digest of the rows they leave."""

    def __init__(self, conv_id, segments: _Segments):
        self.conv_id, self.segments = conv_id, segments
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.turn = self.before = None
        self.rows: list[tuple[str, str]] = []
        self.kinds: list[tuple[str, int]] = []
        self.agreed: list[str] = []
        self.states = {START: (0, "", hashlib.sha256(), False)}

    def add(self, turn, role: str, text: str, fault: int, repeat: int) -> None:
        if turn is not None:
            if self.low is None:
                self.low = turn
            if turn != self.turn or self.turns == 0:
                self.turns += 1
        here = (turn, role, text)
        copied = repeat == 1 or (repeat == 2 and here == self.before)
        if self.before is not None and self.before[1][:1] + role[:1] not in _LEGAL:
            self.illegal += 1
        self.before, self.turn = here, turn
        wrong = FINE
        if fault == 2:
            self.blank, wrong = self.blank + 1, UNUSABLE
        elif copied:
            self.duplicate, wrong = self.duplicate + 1, UNUSABLE
        elif fault == 1:
            self.truncated, wrong = self.truncated + 1, TRUNCATED
        if len(self.rows) == SEGMENT:
            self.advance(False)
        self.rows.append((role, text))
        self.kinds.append((role[:1], wrong))

    def advance(self, last: bool) -> None:
        best = {}
        for entry, (cost, edits, _, _) in self.states.items():
            for end, more, added in self.segments.ways(self.kinds, entry, last):
                way = (cost + more, edits + added, entry, added)
                if end not in best or way[:2] < best[end][:2]:
                    best[end] = way
        states = {}
        for end, (cost, edits, entry, added) in best.items():
            digest, some = self.states[entry][2].copy(), self.states[entry][3]
            for line in _repaired(self.rows, added, entry):
                digest.update((("\n" if some else "") + line).encode("utf-8", "replace"))
                some = True
            states[end] = (cost, edits, digest, some)
        shared = len(os.path.commonprefix([s[1] for s in states.values()]))
        self.agreed.append(next(iter(states.values()))[1][:shared])
        self.states = {q: (c, e[shared:], d, some) for q, (c, e, d, some) in states.items()}
        self.rows, self.kinds = [], []

    def result(self) -> tuple:
        self.advance(True)
        cost, edits, digest, _ = min(self.states.values(), key=lambda s: s[:2])
        gaps = 0 if self.low is None else self.turn - self.low + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal,
                cost, "".join(self.agreed) + edits, digest.hexdigest())


_RESULT = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in (
    "gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()),
    ("repaired_sha256", pa.string())])


def _repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a conversation follow each other in order; one result row per conversation."""
    segments, current, out, held = _Segments(), None, [], 0

    def flush() -> pa.RecordBatch:
        nonlocal out, held
        done = pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*out), _RESULT)], schema=_RESULT)
        out, held = [], 0
        return done

    for batch in batches:
        for conv_id, turn, role, text, fault, repeat in zip(*(
                batch.column(c).to_pylist() for c in (
                    "conv_id", "turn", "role", "text", "fault", "repeat"))):
            if current is None or current.conv_id != conv_id:
                if current is not None:
                    out.append(current.result())
                    held += len(out[-1][7]) + 200
                    if held >= _OUT_BYTES:
                        yield flush()
                current = _Conversation(conv_id, segments)
            if fault >= 0:
                current.add(turn, role, text, fault, repeat)
    if current is not None:
        out.append(current.result())
    if out:
        yield flush()


def conversation_rows(table: DataFrame) -> DataFrame:
    """conv_id, turn, role, text; a null role or text is one space. Other columns are left out."""
    blank = F.lit(" ")
    return table.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
        F.lit(False).alias("dropped"))


def damage(rows: DataFrame) -> DataFrame:
    """Reproducible faults by crc32 of ``conv_id:turn`` (null: one space) modulo 20: 0 drops a row,
    1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 sets the role user. Dropped
    rows stay as marks, so a conversation that loses all of its rows is still there."""
    def shown(column):
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    fault = F.pmod(F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))), F.lit(20))
    hit = rows.withColumn("hit", fault)
    text = F.when(F.col("hit") <= 1, "").when(
        F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("hit") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return hit.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                      (F.col("dropped") | (F.col("hit") == 0)).alias("dropped"),
                      F.explode(copies).alias("copy")).drop("copy")


def repair_conversations(rows: DataFrame) -> DataFrame:
    """One row per conv_id of ``rows`` (as :func:`conversation_rows` or :func:`damage` give them):
    ``gaps`` in its turns, rows whose first fault is blank, duplicate or truncated, ``illegal``
    neighbours, the ``cost`` and ``audit`` of the cheapest edits, and the sha256 of what they leave.

    Rows stand in the order of their turns, nulls first; rows of one turn by role, then text.
    Duplicates are found by a grouping on (conv_id, role, digest of the text), combined before its
    shuffle, so a conversation that repeats itself is no burden. Then a conversation's rows stream
    through one task, as the digest of its whole text needs them one after another; the task holds
    two segments of rows and the edits, whatever its length. A null conv_id is a conversation of
    its own; empty texts are blank; without rows left: zeros, no edits, the digest of nothing. An
    empty table gives no rows. Roles count by their first character; an empty role has none.
    """
    word, end = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"
    fault = F.when(F.col("dropped"), -1).when(~F.col("text").rlike(word), 2).when(
        ~F.col("text").rlike(end), 1).otherwise(0)
    judged = rows.withColumn("fault", fault)
    told = judged.where("fault BETWEEN 0 AND 1").select(
        F.col("conv_id").alias("conv"), F.col("role").alias("said_by"),
        F.sha2("text", 256).alias("said"), F.struct(F.col("turn").isNotNull().alias("known"),
                                                    F.col("turn").alias("at")).alias("at"))
    again = told.groupBy("conv", "said_by", "said").agg(
        F.count("*").alias("times"), F.min("at").alias("first")).where("times > 1")
    digest = judged.withColumn("digest", F.sha2("text", 256))
    met = digest.join(again, F.col("conv_id").eqNullSafe(F.col("conv"))
                      & (F.col("role") == F.col("said_by")) & (F.col("digest") == F.col("said")),
                      "left")
    repeat = F.when(F.col("times").isNull() | (F.col("fault") < 0), 0).when(
        F.col("turn").eqNullSafe(F.col("first.at")), 2).otherwise(1)
    stream = met.select("conv_id", "turn", "role", "text", "fault", repeat.alias("repeat"))
    ordered = stream.repartition(partitions(rows), "conv_id").sortWithinPartitions(
        "conv_id", F.asc_nulls_first("turn"), "role", "text")
    return ordered.mapInArrow(
        _repairs, "conv_id long, gaps long, blank long, duplicate long, truncated long, "
                  "illegal long, cost long, audit string, repaired_sha256 string")
