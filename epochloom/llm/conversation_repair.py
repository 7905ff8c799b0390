"""Conversation repair: the cheapest edits that give a conversation an orderly structure.

A conversation is orderly if the first letters of its roles read ``(s?(ua)+)?``: perhaps a system
turn, then user and assistant in turn. Each turn's first fault counts: *blank* (no character
outside white space), *duplicate* (role and text stood earlier) or *truncated* (the last such
character is none of ``.!?``). Edits are Keep (0), Rerole to user or assistant (2), Delete (3, and
the only one for blank and duplicate turns) and Insert of an empty user or assistant turn (2);
truncated turns that stay cost 1 more. Of equally cheap repairs the one whose initials in order
are least in ASCII is taken.

The edit lattice has a node per place and state of the pattern. Two Dijkstra searches run on it,
from the start and, along reversed edges, from the accepting ends. They go on until their least
open costs add up to more than the best meeting, so that every crossing of that cost is known;
then the least audit is read along edges on cheapest paths. From a node each initial leads along
one edge only, so the least next initial gives the least audit.

On Spark: rows are counted by equal (conversation, turn, role, text) first, and earlier turns of
the same role and text are found by a group-by on a digest, so repeated turns do not meet in one
task. What a search needs of a turn is one byte; texts are streamed, in order, only when the edits
are applied, one conversation after the other, and are never gathered. An audit is one value by
contract, so its conversation's bytes are in one task.

Null roles and texts count as one space. Null conversation ids are one conversation; null turns
come first. Turns of equal number are ordered by role and a digest of role and text; repeated rows
stand side by side. Roles of other initials, and empty ones, fit no place of the pattern.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Classes of initials, and what a byte of a turn's code adds for its fault.
SYSTEM, USER, ASSISTANT, OTHER = range(4)
FAULT = 4
SOUND, TRUNCATED, BLANK, DUPLICATE = range(4)
#: The costs of edits, and of keeping a truncated turn.
RELABEL, DELETE, INSERT = 2, 3, 2
#: States of the pattern: nothing yet, after s, after u, after a; and where initials lead.
STEP = ((1, 2, -1, -1), (-1, 2, -1, -1), (-1, -1, 3, -1), (-1, 2, -1, -1))
#: Where an inserted or relabelled turn leads: to user, except after user.
OWN = (2, 2, 3, 2)
ENDS = (0, 3)
ROLES = {2: "user", 3: "assistant"}
#: Short conversations recur; a task remembers so many of them, of up to so many turns.
REMEMBERED, SHORT = 1 << 14, 64


def _onward(codes: bytes, node: int) -> Iterator[tuple[str, int, int]]:
    """(initial, cost, next node) of the edges from a node, initials ascending."""
    place, state = node >> 2, node & 3
    code = codes[place] if place < len(codes) else -1
    if code >= 0:
        yield "D", DELETE, node + 4
    yield "I", INSERT, place * 4 + OWN[state]
    if code >= 0 and code < BLANK * FAULT:
        late = code // FAULT
        goal = STEP[state][code % FAULT]
        if goal >= 0:
            yield "K", late, place * 4 + 4 + goal
        yield "R", RELABEL + late, place * 4 + 4 + OWN[state]


def _backward(codes: bytes, node: int) -> Iterator[tuple[int, int]]:
    """(cost, previous node) of the edges into a node."""
    place, state = node >> 2, node & 3
    before = [p for p in range(4) if OWN[p] == state]
    for p in before:
        yield INSERT, place * 4 + p
    if place:
        code, at = codes[place - 1], place * 4 - 4
        yield DELETE, at + state
        if code < BLANK * FAULT:
            late = code // FAULT
            for p in range(4):
                if STEP[p][code % FAULT] == state:
                    yield late, at + p
            for p in before:
                yield RELABEL + late, at + p


def _settle(heap: list, cost: dict, done: set) -> int | None:
    """The next node of a search, whose cost is final; None when there is none."""
    while heap:
        at, node = heappop(heap)
        if node not in done and cost[node] == at:
            done.add(node)
            return node
    return None


def _least_open(heap: list, cost: dict, done: set) -> float:
    while heap and (heap[0][1] in done or cost[heap[0][1]] != heap[0][0]):
        heappop(heap)
    return heap[0][0] if heap else float("inf")


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """Cost and initials of the edits for a conversation of so many turns."""
    ahead, back = {0: 0}, {len(codes) * 4 + q: 0 for q in ENDS}
    first, last = set(), set()
    heaps = [(0, 0)], [(0, node) for node in back]
    best = min((back[n] for n in ahead if n in back), default=float("inf"))
    while True:
        opened = _least_open(heaps[0], ahead, first), _least_open(heaps[1], back, last)
        if opened[0] + opened[1] > best or min(opened) == float("inf"):
            break
        forward = opened[0] <= opened[1]
        mine, other, heap = (ahead, back, heaps[0]) if forward else (back, ahead, heaps[1])
        node = _settle(heap, mine, first if forward else last)
        edges = (
            ((c, n) for _, c, n in _onward(codes, node)) if forward else _backward(codes, node)
        )
        for c, near in edges:
            total = mine[node] + c
            if total < mine.get(near, float("inf")):
                mine[near] = total
                heappush(heap, (total, near))
                if near in other:
                    best = min(best, total + other[near])
    return int(best), _least_audit(codes, ahead, back, first, last, best)


def _least_audit(codes, ahead, back, first, last, best) -> str:
    """The least initials along cheapest paths. ``first`` and ``last`` are the settled nodes, whose
    costs from the start and to the ends are ``ahead`` and ``back``."""
    ends = {len(codes) * 4 + q for q in ENDS}
    crossing = [
        v
        for v in first
        if (v in ends and ahead[v] == best)
        or any(w in last and ahead[v] + c + back[w] == best for _, c, w in _onward(codes, v))
    ]
    useful, todo = set(crossing), crossing
    while todo:
        node = todo.pop()
        for c, near in _backward(codes, node):
            if near in first and near not in useful and ahead[near] + c == ahead[node]:
                useful.add(near)
                todo.append(near)
    out, node, spent = [], 0, 0
    while not (node in ends and spent == best):
        initial, cost, node = next(
            (initial, c, near)
            for initial, c, near in _onward(codes, node)
            if (near in last and spent + c + back[near] == best)
            or (near in useful and spent + c == ahead[near])
        )
        out.append(initial)
        spent += cost
    return "".join(out)


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows harmed by a hash of conversation and turn, of which
    one in twenty each is lost, emptied, without its ``.!?``, there twice, or by the user."""
    space = F.lit(" ")
    name = F.concat_ws(
        ":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))
    )
    kind = F.crc32(name.cast("binary")) % 20
    text = F.coalesce("text", space)
    return conversations.where(kind != 0).select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == 1, F.lit(""))
        .when(kind == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text)
        .alias("text"),
        F.when(kind == 3, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("copies"),
    )


def _order(turn: str = "turn") -> Column:
    return F.struct(F.col(turn).isNotNull().alias("known"), F.col(turn).alias("turn"))


def turns(rows: DataFrame) -> DataFrame:
    """Equal rows once, with how often they occur and a digest of role and text."""
    space = F.lit(" ")
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    plain = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        copies.cast("long").alias("copies"),
    )
    # the length keeps apart what role and text together would mix
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    return (
        plain.groupBy("conv_id", "turn", "role", "text")
        .agg(F.sum("copies").alias("copies"))
        .withColumn("digest", F.unhex(F.sha2(whole, 256)))
    )


def marks(found: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, copies, code, later): one byte for the turn, one for its
    repetitions, which are duplicates or blank."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    whole = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    initial = F.substring("role", 1, 1)
    kind = (
        F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT)
    ).otherwise(OTHER)
    plain = found.select(
        "conv_id", "turn", "role", "digest", "copies", blank.alias("blank"),
        whole.alias("whole"), kind.alias("kind"),
    )
    first = found.groupBy("conv_id", "digest").agg(F.min(_order()).alias("first"))
    same = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (
        F.col("a.digest") == F.col("b.digest")
    )
    seen = _order("a.turn") != F.col("b.first")
    fault = (
        F.when(F.col("a.blank"), BLANK)
        .when(seen, DUPLICATE)
        .when(~F.col("a.whole"), TRUNCATED)
        .otherwise(SOUND)
    )
    later = F.when(F.col("a.blank"), BLANK).otherwise(DUPLICATE)
    code = lambda f: (F.col("a.kind") + f * FAULT).cast("int")
    return (
        plain.alias("a")
        .join(first.alias("b"), same)
        .select("a.conv_id", "a.turn", "a.role", "a.digest", "a.copies",
                code(fault).alias("code"), code(later).alias("later"))
    )


class _Tally:
    """What is known of the conversation that a task is reading."""

    def __init__(self, conv_id):
        self.conv_id, self.codes = conv_id, bytearray()
        self.least = self.most = None
        self.turns = 0

    def add(self, turn, copies: int, code: int, later: int) -> None:
        self.codes.append(code)
        self.codes += bytes([later]) * (copies - 1)
        if turn is not None and turn != self.most:  # turns ascend
            self.least = turn if self.least is None else self.least
            self.most = turn
            self.turns += 1

    def row(self, short) -> tuple:
        codes = np.frombuffer(bytes(self.codes), np.uint8)
        faults = np.bincount(codes // FAULT, minlength=4)
        pairs = codes[:-1] % FAULT * FAULT + codes[1:] % FAULT
        legal = (SYSTEM * FAULT + USER, USER * FAULT + ASSISTANT, ASSISTANT * FAULT + USER)
        cost, audit = (short if len(codes) <= SHORT else cheapest_edits)(bytes(self.codes))
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        counts = faults[BLANK], faults[DUPLICATE], faults[TRUNCATED], (~np.isin(pairs, legal)).sum()
        return self.conv_id, gaps, *map(int, counts), cost, audit


MEASURES = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)


def _lists(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(c.to_pylist() for c in batch.columns), strict=True)


def audits(found: DataFrame) -> DataFrame:
    """conv_id, the counts of faults, cost and audit, for each conversation that has turns."""
    key = found.schema["conv_id"].dataType.simpleString()
    ordered = (
        marks(found)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "digest")
        .select("conv_id", "turn", "copies", "code", "later")
    )
    schema = f"conv_id {key}, {MEASURES}"
    return ordered.mapInArrow(_rows_as_batches(_audit_rows, schema), schema)


def _audit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    tally, short = None, lru_cache(REMEMBERED)(cheapest_edits)
    for batch in batches:
        for conv_id, *turn in _lists(batch):
            if tally is None or tally.conv_id != conv_id:
                if tally is not None:
                    yield tally.row(short)
                tally = _Tally(conv_id)
            tally.add(*turn)
    if tally is not None:
        yield tally.row(short)


def _rows_as_batches(make, schema: str, rows: int = 2000, size: int = 4_000_000):
    """For mapInArrow: the tuples that ``make`` gives, in batches of bounded size."""
    from pyspark.sql.types import StructType

    target = StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(target)
        part, held = [], 0

        def flushed() -> pa.RecordBatch:
            columns = zip(*part, strict=True)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema=arrow)

        for row in make(batches):
            part.append(row)
            held += sum(len(v) for v in row if isinstance(v, str | bytes))
            if len(part) >= rows or held >= size:
                yield flushed()
                part, held = [], 0
        if part:
            yield flushed()

    return run


_EDIT = "place long, edit string, turn long, role string, text string"


def edits(found: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Every edit of every conversation in order: a row with ``place`` -1 and its measures, then
    (place, edit, turn, role, text), of deleted turns too. Rows of a conversation stand together.
    ``ids`` may name conversations that have no turns."""
    key = found.schema["conv_id"].dataType.simpleString()
    measured = audits(found).withColumn("kind", F.lit(1))
    parts = measured.unionByName(found.withColumn("kind", F.lit(2)), allowMissingColumns=True)
    if ids is not None:
        named = ids.select(F.col("conv_id").cast(key)).distinct().withColumn("kind", F.lit(0))
        parts = parts.unionByName(named, allowMissingColumns=True)
    schema = f"conv_id {key}, {MEASURES}, {_EDIT}"
    ordered = parts.repartition("conv_id").sortWithinPartitions(
        "conv_id", "kind", F.col("turn").asc_nulls_first(), "role", "digest"
    )
    names = [part.split()[0] for part in MEASURES.split(", ")]
    return ordered.select("conv_id", "kind", *names, "turn", "role", "text", "copies").mapInArrow(
        _rows_as_batches(_edit_rows, schema), schema
    )


class _Editor:
    """Applies an audit to the turns of one conversation as they come."""

    def __init__(self, conv_id, measures: tuple):
        self.conv_id, self.measures = conv_id, measures
        self.audit, self.at, self.state, self.place = measures[-1], 0, 0, 0

    def head(self) -> tuple:
        return self.conv_id, *self.measures, -1, None, None, None, None

    def _row(self, edit: str, turn, role: str, text: str) -> tuple:
        self.place += 1
        return self.conv_id, *[None] * len(self.measures), self.place - 1, edit, turn, role, text

    def inserted(self) -> Iterator[tuple]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self.state = OWN[self.state]
            yield self._row("I", None, ROLES[self.state], "")

    def turn(self, turn, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = STEP[self.state]["sua".index(role[0])]
        elif edit == "R":
            self.state = OWN[self.state]
            role = ROLES[self.state]
        yield self._row(edit, turn, role, text)


def _edit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    editor = None
    waiting = False  # a conversation that is named, and of which nothing else has come yet
    for batch in batches:
        for conv_id, kind, *rest in _lists(batch):
            if editor is None or editor.conv_id != conv_id:
                if editor is not None:
                    yield from ((editor.head(),) if waiting else editor.inserted())
                editor, waiting = _Editor(conv_id, (*[0] * 6, "")), kind == 0
            if kind == 1:
                editor, waiting = _Editor(conv_id, tuple(rest[:7])), False
                yield editor.head()
            elif kind == 2:
                turn, role, text, copies = rest[7:]
                for _ in range(copies):
                    yield from editor.turn(turn, role, text)
    if editor is not None:
        yield from ((editor.head(),) if waiting else editor.inserted())


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place, edit, turn (null where inserted), role, text."""
    kept = edits(turns(rows)).where("place >= 0 and edit <> 'D'")
    return kept.select("conv_id", "place", "edit", "turn", "role", "text")


def repair_report(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """conv_id, the counts of faults, cost, audit and a SHA-256 of the repaired ``role:text``
    lines, for each conversation in ``rows`` or ``ids``."""
    every = edits(turns(rows), ids)
    key = every.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {key}, {MEASURES}, repaired_sha256 string"
    # a conversation's edits come out of the step before in order and in one partition
    return every.mapInArrow(_rows_as_batches(_digest_rows, schema), schema)


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    head, digest, lines = None, hashlib.sha256(), 0
    for batch in batches:
        for row in _lists(batch):
            place, edit, _, role, text = row[8:]
            if place < 0:
                if head is not None:
                    yield *head, digest.hexdigest()
                head, digest, lines = row[:8], hashlib.sha256(), 0
            elif edit != "D":
                line = f"{role}:{text}"
                digest.update((f"\n{line}" if lines else line).encode("utf-8", "surrogatepass"))
                lines += 1
    if head is not None:
        yield *head, digest.hexdigest()
