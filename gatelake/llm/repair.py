"""Repair of conversation structure by cheapest edits.

A conversation is a signature: one letter per row for its role and fault. All
signatures are read from the end through one automaton whose nodes hold the cost
to go and the best edit for every grammar state; signatures with a common suffix
share its nodes. Rows stay spread: they are sorted by range, so that a long
conversation lies in many tasks, and only its letters are brought together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatelake.session import materialize

BLANKS = "\x20\t\n\x0b\f\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5  # costs
SEGMENT = 1 << 20  # letters of a conversation in one row
BATCH_BYTES = 8 << 20
LEGAL = ("su", "ua", "au")
# grammar states: nothing yet, behind system, behind user, behind assistant; the state that each role leads to
ROLES = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
FILL = {0: "u", 1: "u", 2: "a", 3: "u"}  # the role that an inserted or renamed row takes there
NAMES = {"u": "user", "a": "assistant"}
FINAL = (0, 3)


# ------------------------------------------------------------------ automaton
class Automaton:
    """Nodes of the minimal automaton of signature suffixes.

    A node is known by its costs to go relative to the least one, for the four
    grammar states: suffixes with equal relative costs are one node. A step is a
    letter in front of a node; it is worked out once and holds, per grammar state,
    the first edit of the best audit and the state behind it. Of edits with equal
    cost the one with the smaller initial is taken; options never share an initial,
    so this gives the smallest audit.
    """

    def __init__(self):
        self._nodes: dict[tuple[int, ...], int] = {}
        self._costs: list[tuple[int, ...]] = []
        self._known: dict[tuple[int, str], tuple[int, int, int]] = {}
        self.edits: list[tuple[tuple[str, int], ...]] = []  # per step, per grammar state: initial, next state
        self.end = self._step([(0, "", q) if q in FINAL else (1 << 30, "", q) for q in range(4)])

    def _step(self, best: list[tuple[int, str, int]]) -> tuple[int, int, int]:
        """Adds insertions to the best other edits; ``(step, node, base cost)``."""
        for _ in range(2):  # two insertions lead through all states
            for q in range(4):
                to = ROLES[q][FILL[q]]
                best[q] = min(best[q], (best[to][0] + INSERT, "I", to))
        base = min(b[0] for b in best)
        costs = tuple(b[0] - base for b in best)
        if costs not in self._nodes:
            self._nodes[costs] = len(self._costs)
            self._costs.append(costs)
        self.edits.append(tuple(b[1:] for b in best))
        return len(self.edits) - 1, self._nodes[costs], base

    def step(self, letter: str, node: int) -> tuple[int, int, int]:
        """``letter`` before ``node``: the step, its node and the cost it adds to the base."""
        if (node, letter) not in self._known:
            after, role = self._costs[node], letter.lower()
            fault = TRUNCATED if letter in "SUAO" else 0
            best = []
            for q in range(4):
                options = [(DELETE + after[q], "D", q)]
                if letter != "X":
                    if role in ROLES[q]:
                        options.append((KEEP + fault + after[ROLES[q][role]], "K", ROLES[q][role]))
                    to = ROLES[q][FILL[q]]
                    options.append((REROLE + fault + after[to], "R", to))
                best.append(min(options))
            self._known[node, letter] = self._step(best)
        return self._known[node, letter]

    def cost(self, node: int, base: int) -> int:
        return base + self._costs[node][0]


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    return low


class Audits:
    """Cost and audit of signatures that come sorted by their reversed letters: shared suffixes are walked once."""

    def __init__(self):
        self.auto = Automaton()
        self._path = [self.auto.end]  # step, node, base cost of each suffix, the empty one first
        self._last, self._result = "", self._audit()

    def _audit(self) -> tuple[int, str]:
        out, state, at = [], 0, len(self._path) - 1
        while True:
            initial, state = self.auto.edits[self._path[at][0]][state]
            if not initial:
                return self.auto.cost(*self._path[-1][1:]), "".join(out)
            out.append(initial)
            at -= initial != "I"

    def of(self, signature: str) -> tuple[int, str]:
        backwards = signature[::-1]
        if backwards != self._last:
            shared = _common(backwards, self._last)
            del self._path[shared + 1:]
            for letter in backwards[shared:]:
                _, node, base = self._path[-1]
                step, node, more = self.auto.step(letter, node)
                self._path.append((step, node, base + more))
            self._last, self._result = backwards, self._audit()
        return self._result


# ------------------------------------------------------------------ rows in order
def _key(role: Column, text: Column) -> Column:
    """One value for role and text: equal only where both are."""
    return F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256))


def _rows(conversations: DataFrame) -> DataFrame:
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    copies = F.col("copies").cast("bigint") if "copies" in conversations.columns else F.lit(1).cast("bigint")
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.coalesce(copies, F.lit(1)).alias("copies"))


def _thin(rows: DataFrame) -> DataFrame:
    """Distinct rows without their text: ``conv_id, turn, role, key, initial, letter, copies``; equal rows are counted.

    A conversation all of whose rows have no copies keeps one row without values.
    """
    there, end = F.col("copies") > 0, F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    letter = F.when(end == "", "X").when(F.right(end, F.lit(1)).isin(".", "!", "?"), kind).otherwise(F.upper(kind))
    if_there = lambda c: F.when(there, c)
    return rows.select(
        "conv_id", if_there(F.col("turn")).alias("turn"), if_there(F.col("role")).alias("role"), if_there(_key(F.col("role"), F.col("text"))).alias("key"),
        if_there(initial).alias("initial"), if_there(letter).alias("letter"), F.greatest("copies", F.lit(0)).alias("copies"),
    ).groupBy("conv_id", "turn", "role", "key", "initial", "letter").agg(F.sum("copies").alias("copies"))


def _first_seen(thin: DataFrame) -> DataFrame:
    """``thin`` with ``again``: role and text stand at an earlier turn. Messages that occur at one turn only are not joined."""
    thin = materialize(thin, "turns")
    order = F.struct(F.col("turn").isNotNull().alias("set"), F.col("turn"))
    seen = thin.where("letter <> 'X'").groupBy(F.col("conv_id").alias("_c"), F.col("key").alias("_k")).agg(
        F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    joined = thin.join(seen, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("key") == F.col("_k")), "left")
    return joined.withColumn("again", F.coalesce(order != F.col("_first"), F.lit(False))).drop("_c", "_k", "_first")


_SEGMENT = T.StructType([
    T.StructField("at", T.LongType()), T.StructField("letters", T.StringType()), T.StructField("blank", T.LongType()), T.StructField("duplicate", T.LongType()),
    T.StructField("truncated", T.LongType()), T.StructField("illegal", T.LongType()), T.StructField("first", T.StringType()), T.StructField("last", T.StringType()),
    T.StructField("low", T.LongType()), T.StructField("high", T.LongType()), T.StructField("turns", T.LongType())])


class _Segment:
    def __init__(self, conv: Any):
        self.conv, self.letters, self.size = conv, [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def add(self, turn: int | None, initial: str, letter: str, again: bool, copies: int) -> None:
        fresh = letter != "X" and not again
        self.letters.append((letter if fresh else "X") + "X" * (copies - 1))
        self.size += copies
        if letter == "X":
            self.blank += copies
        else:
            self.duplicate += copies - fresh
            self.truncated += fresh and letter in "SUAO"
        self.illegal += copies - 1 + (self.last is not None and self.last + initial not in LEGAL)
        self.first, self.last = initial if self.first is None else self.first, initial
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1

    def row(self, at: int) -> tuple:
        return (at, "".join(self.letters), self.blank, self.duplicate, self.truncated, self.illegal, self.first, self.last, self.low, self.high, self.turns)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation and task, of sorted rows; a longer stretch is split."""
    first = next(batches, None)
    if first is None:
        return
    conv_type, names = first.schema.field("conv_id").type, [f.name for f in _SEGMENT.fields]
    types = [pa.string() if isinstance(f.dataType, T.StringType) else pa.int64() for f in _SEGMENT.fields]
    at, now, done, size = TaskContext.get().partitionId() << 32, None, [], 0

    def flush() -> pa.RecordBatch:
        columns = list(zip(*(row for _, row in done)))
        return pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], conv_type), *(pa.array(c, t) for c, t in zip(columns, types))], ["conv_id", *names])

    for batch in chain([first], batches, [None]):
        rows = zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "letter", "again", "copies"))) if batch is not None else [None]
        for row in rows:
            if now is not None and (row is None or row[0] != now.conv or now.size >= SEGMENT):
                done.append((now.conv, now.row(at)))
                at, size, now = at + 1, size + now.size + 100, None
                if size >= BATCH_BYTES:
                    yield flush()
                    done, size = [], 0
            if row is not None:
                now = now or _Segment(row[0])
                if row[5]:
                    now.add(*row[1:])
    if done:
        yield flush()


def signatures(conversations: DataFrame) -> DataFrame:
    """``(conv_id, letters, gaps, blank, duplicate, truncated, illegal)``: one row per conversation.

    Rows are sorted by range over (conversation, turn, role, text key), so that a
    conversation of any length is spread over tasks; one row per task and
    conversation, of one character per turn, is then brought together.
    """
    thin = _first_seen(_thin(_rows(conversations)))
    keys = ["conv_id", "turn", "role", "key"]
    parts = thin.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(
        _segments, T.StructType([conversations.schema["conv_id"], *_SEGMENT.fields]))
    held = F.filter(F.sort_array("s"), lambda x: x["letters"] != "")
    pairs = F.transform(F.sequence(F.lit(2), F.size("s")), lambda i: F.struct(F.element_at("s", i - 1).alias("a"), F.element_at("s", i).alias("b")))
    pairs = F.when(F.size("s") > 1, pairs)
    count = lambda test: F.coalesce(F.size(F.filter("pairs", test)), F.lit(0)).cast("bigint")
    total = lambda name: F.aggregate("s", F.lit(0).cast("bigint"), lambda a, x: a + x[name])
    turns = total("turns") - count(lambda p: F.coalesce(p["a"]["high"] == p["b"]["low"], F.lit(False)))
    span = F.array_max(F.transform("s", lambda x: x["high"])) - F.array_min(F.transform("s", lambda x: x["low"])) + 1
    return parts.groupBy("conv_id").agg(F.collect_list(F.struct(*[f.name for f in _SEGMENT.fields])).alias("s")).withColumn("s", held).withColumn("pairs", pairs).select(
        "conv_id", F.array_join(F.transform("s", lambda x: x["letters"]), "").alias("letters"), F.coalesce(span - turns, F.lit(0).cast("bigint")).alias("gaps"),
        *[total(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        (total("illegal") + count(lambda p: ~F.concat(p["a"]["last"], p["b"]["first"]).isin(*LEGAL))).alias("illegal"))


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    audits = Audits()
    for batch in batches:
        found = [audits.of(s) for s in batch.column("letters").to_pylist()]
        keep = [c for c in batch.schema.names if c != "letters"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in keep), pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())], [*keep, "cost", "audit"])


def audit(conversations: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)``: one row per conversation.

    Signatures are dealt by range of their reversed letters, the conversation
    breaking ties, so that equal endings meet in one task and a frequent signature
    is still spread over several.
    """
    found = materialize(signatures(conversations), "signatures")
    kept = [f for f in found.schema.fields if f.name != "letters"]
    schema = T.StructType([*kept, T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())])
    back = F.reverse("letters")
    return found.repartitionByRange(back, "conv_id").sortWithinPartitions(back).mapInArrow(_audit, schema)


# ------------------------------------------------------------------ repaired text
def _edited(audit: str) -> Iterator[tuple[str, str | None]]:
    """The edits with the role that an insertion or a new role takes; ``s``, ``u``, ``a`` of kept rows come by ``send``."""
    state = 0
    for e in audit:
        role = FILL[state] if e in "IR" else None
        kept = yield e, NAMES.get(role)
        if e != "D":
            state = ROLES[state][role or kept]


def _apply(out_names: list[str], digest: bool):
    """Streams sorted rows behind the head of their conversation: repaired rows, or one digest for each conversation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, size, types = [], 0, None
        head, place = None, 0
        edits, current, total = iter(()), None, hashlib.sha256()

        def emit(role: str, text: str, edit: str) -> None:
            nonlocal place, size
            if digest:
                total.update(("\n" * (place > 0) + f"{role}:{text}").encode())
            else:
                done.append((head["conv_id"], place, edit, role, text))
                size += len(text) + 50
            place += 1

        def insertions() -> None:
            nonlocal current
            while current is not None and current[0] == "I":
                emit(current[1], "", "I")
                current = next(edits, None)

        def close() -> None:
            nonlocal size
            if head is not None:
                insertions()
                if digest:
                    done.append((*(head[c] for c in out_names[:-1]), total.hexdigest()))
                    size += len(head["audit"]) + 100

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], out_names)

        for batch in batches:
            if types is None:
                given = {f.name: f.type for f in batch.schema}
                types = [given.get(c, {"position": pa.int64()}.get(c, pa.string())) for c in out_names]
            columns = {c: batch.column(c).to_pylist() for c in batch.schema.names if c != "text"}
            texts = batch.column("text")
            for i in range(batch.num_rows):
                if columns["audit"][i] is not None:
                    close()
                    head, place, total = {c: v[i] for c, v in columns.items()}, 0, hashlib.sha256()
                    edits = _edited(head["audit"])
                    current = next(edits, None)
                    continue
                role, text = columns["role"][i], texts[i].as_py()
                for _ in range(columns["copies"][i]):
                    insertions()
                    edit, name = current
                    if edit != "D":
                        emit(name or role, text, edit)
                    try:
                        current = edits.send(role[:1])
                    except StopIteration:
                        current = None
                if size >= BATCH_BYTES:
                    yield flush()
                    done, size = [], 0
        close()
        if done:
            yield flush()

    return run


_HEAD = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def _streamed(conversations: DataFrame, out: T.StructType, digest: bool) -> DataFrame:
    """Heads and rows of each conversation, in order, in one task: the digest of a text is made from its start to its end."""
    rows = _rows(conversations).where("copies > 0")
    numbers = [F.lit(None).cast("bigint").alias(c) for c in _HEAD[:-1]]
    body = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", _key(F.col("role"), F.col("text")).alias("key"), "text", "copies", *numbers, F.lit(None).cast("string").alias("audit"))
    heads = audit(conversations).select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("binary").alias("key"), F.lit(None).cast("string").alias("text"), F.lit(1).cast("bigint").alias("copies"), *_HEAD)
    order = ["conv_id", "kind", "turn", "role", "key"]
    both = heads.unionByName(body).repartition("conv_id").sortWithinPartitions(*order)
    return both.select("conv_id", "role", "text", "copies", *_HEAD).mapInArrow(_apply(out.fieldNames(), digest), out)


def repaired_rows(conversations: DataFrame) -> DataFrame:
    """``(conv_id, position, edit, role, text)``: the rows of the repaired conversations with the edit that made each.

    See ``repair``; conversations whose rows are all deleted have none.
    """
    out = T.StructType([conversations.schema["conv_id"], T.StructField("position", T.LongType()), *(T.StructField(c, T.StringType()) for c in ("edit", "role", "text"))])
    return _streamed(conversations, out, False)


def repair(conversations: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)``: one row per conversation.

    ``conversations`` has ``conv_id``, ``turn``, ``role``, ``text`` and, optionally,
    ``copies``: how often a row stands there (0: not at all, only its conversation is
    known; null: once). Other columns are ignored whatever their names. Rows are
    taken by turn (nulls first); rows of one turn by role, then by the SHA-256 of
    role and text. Null roles and texts are one space; rows with a null ``conv_id``
    are one conversation. Repeated rows stand next to each other, the later ones are
    duplicates. An empty table has no conversations.

    A long conversation is spread over tasks for all but the last step: its digest
    is made by one task that streams its rows and holds one of them and the audit.
    """
    out = T.StructType([conversations.schema["conv_id"], *(T.StructField(c, T.LongType()) for c in _HEAD[:-1]), T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    return _streamed(conversations, out, True)


def damage(conversations: DataFrame) -> DataFrame:
    """Test damage by the CRC-32 of ``conv_id:turn`` (nulls: one space) modulo 20; other columns go.

    0 drops the row, 1 empties its text, 2 takes its ends of sentences out, 3
    repeats it, 4 makes it the user's. Dropped rows stay with no ``copies``.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    kind = F.col("kind")
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20).alias("kind")).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("bigint").alias("copies"))
