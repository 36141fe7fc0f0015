"""Conversation structure repair: the cheapest audit by a persistent DP.

The turns of a conversation pass a four-state machine (nothing yet, system,
user, assistant). Per turn and state the DP keeps one edit string: a node that
links to its prefix, so states share their history. Equal costs are decided by
the strings themselves: nodes carry a rolling hash and binary-lifting
ancestors, so the longest common prefix is found by halving; a prefix that is
equal by hash alone is verified letter by letter.

What all states share is decided for good: it is taken off the chains, its
edits are applied and its texts let go, so memory follows the undecided tail,
not the length of the conversation. Spark shuffles rows once by conversation
and sorts them (spilling); a task streams its conversations.

Of two strings with one cost, state and number of rows, none is a prefix of
the other: it would have to differ by insertions, which cost. So the least
string of a state is extended by the least string of its successors.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_COST = 5  # on top, for a truncated turn that stays
NONE, BLANK, DUPLICATE, TRUNCATED = "", "blank", "duplicate", "truncated"
LEGAL = ("su", "ua", "au")
SPACE = " \t\n\v\f\r"
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a turn of that initial; what a missing turn must be, and then.
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
WANTED = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
#: (state, other, most that the rest costs more from the other): the rest of
#: a START goes from ASSISTANT too if its system turn is deleted instead, that
#: of a SYSTEM as it is, and one insertion leads from USER to ASSISTANT. A
#: state dearer than that is on no cheapest path.
BEATEN = ((START, ASSISTANT, 2), (START, USER, 7), (SYSTEM, ASSISTANT, 0), (SYSTEM, USER, 5))
FLUSH_ROWS = 64
_BASE, _MOD = 1_000_003, (1 << 61) - 1


class Node:
    """An edit string: its last letter, and its prefix as ``up[0]``;
    ``up[k]`` is the prefix 2**k letters shorter."""

    __slots__ = ("depth", "hash", "letter", "up")

    def __init__(self, letter: str = "", parent: Node | None = None):
        self.letter = letter
        if parent is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth, self.hash = parent.depth + 1, (parent.hash * _BASE + ord(letter)) % _MOD
        up, at = [parent], parent
        while len(at.up) >= len(up):
            at = at.up[len(up) - 1]
            up.append(at)
        self.up = tuple(up)

    def ancestor(self, depth: int) -> Node:
        at, over = self, self.depth - depth
        while over:
            k = over.bit_length() - 1
            at, over = at.up[k], over - (1 << k)
        return at


def letters(node: Node, root: Node | None = None) -> str:
    out = []
    while node is not root and node.depth:
        out.append(node.letter)
        node = node.up[0]
    return "".join(reversed(out))


def _verified(a: Node, b: Node) -> bool:
    """Whether two strings of one length and hash are equal, by letter."""
    while a is not b:
        if a.letter != b.letter:
            return False
        a, b = a.up[0], b.up[0]
    return True


def less(a: Node, b: Node) -> bool:
    """Whether string ``a`` sorts before ``b``: longest common prefix first."""
    depth = min(a.depth, b.depth)
    x, y = a.ancestor(depth), b.ancestor(depth)
    if x.hash == y.hash and _verified(x, y):
        return a.depth < b.depth
    if x.hash != y.hash:
        for k in range(len(x.up) - 1, -1, -1):
            if k < len(x.up) and x.up[k].hash != y.up[k].hash:
                x, y = x.up[k], y.up[k]
        if x.letter != y.letter and _verified(x.up[0], y.up[0]):
            return x.letter < y.letter
    return letters(a) < letters(b)  # a collision


class Audit:
    """The DP over one conversation. ``add`` takes a turn; ``decided`` yields
    (edit, role, text) of the repaired and deleted turns known so far."""

    def __init__(self):
        self.best: dict[int, tuple[int, Node]] = {START: (0, Node())}
        self.pending: deque[tuple[str, str]] = deque()
        self.at = START  # state after the decided edits
        self._insert()

    @staticmethod
    def _offer(best: dict, state: int, cost: int, parent: Node, letter: str) -> bool:
        old = best.get(state)
        if old is not None and old[0] < cost:
            return False
        new = Node(letter, parent)
        if old is not None and old[0] == cost and not less(new, old[1]):
            return False
        best[state] = (cost, new)
        return True

    def _insert(self) -> None:
        """Insertions after the turns so far; a chain of more than two comes
        back to a state it left, at a cost."""
        changed = True
        while changed:
            changed = False
            for state, (cost, node) in sorted(self.best.items()):
                changed |= self._offer(self.best, WANTED[state][1], cost + COST[INSERT], node, INSERT)

    def add(self, role: str, text: str, fault: str) -> None:
        best: dict[int, tuple[int, Node]] = {}
        more = TRUNCATED_COST if fault == TRUNCATED else 0
        for state, (cost, node) in self.best.items():
            self._offer(best, state, cost + COST[DELETE], node, DELETE)
            if fault in (BLANK, DUPLICATE):
                continue
            to = NEXT.get((state, role[:1]))
            if to is not None:
                self._offer(best, to, cost + COST[KEEP] + more, node, KEEP)
            self._offer(best, WANTED[state][1], cost + COST[REROLE] + more, node, REROLE)
        self.best = best
        self.pending.append((role, text))
        self._insert()
        for state, cheaper, more in BEATEN:
            if state in best and cheaper in best and best[cheaper][0] + more < best[state][0]:
                del best[state]

    def _apply(self, edits: str) -> Iterator[tuple[str, str, str]]:
        for e in edits:
            role, text = ("", "") if e == INSERT else self.pending.popleft()
            if e == DELETE:
                yield e, role, text
                continue
            if e == KEEP:
                self.at = NEXT[self.at, role[:1]]
            else:
                role, self.at = WANTED[self.at]
            yield e, role, text

    def decided(self) -> Iterator[tuple[str, str, str]]:
        """Edits that every state shares; the chains are cut behind them."""
        nodes = [n for _, n in self.best.values()]
        shared = nodes[0]
        for n in nodes[1:]:
            depth = min(shared.depth, n.depth)
            shared, n = shared.ancestor(depth), n.ancestor(depth)
            while shared is not n:
                k = max((k for k in range(len(shared.up)) if shared.up[k] is not n.up[k]), default=-1)
                shared, n = (shared.up[k], n.up[k]) if k >= 0 else (shared.up[0], n.up[0])
        if shared.depth:
            yield from self._apply(letters(shared))
            root = Node()
            made = {id(shared): root}

            def again(n: Node) -> Node:
                chain = []
                while id(n) not in made:
                    chain.append(n)
                    n = n.up[0]
                new = made[id(n)]
                for old in reversed(chain):
                    new = made[id(old)] = Node(old.letter, new)
                return new

            self.best = {s: (c, again(n)) for s, (c, n) in self.best.items()}

    def finish(self) -> tuple[int, Iterator[tuple[str, str, str]]]:
        """Cost of the best string, and its edits not decided before."""
        ends = [self.best[s] for s in (START, ASSISTANT) if s in self.best]
        cost, node = ends[0]
        for c, n in ends[1:]:
            if c < cost or c == cost and less(n, node):
                cost, node = c, n
        return cost, self._apply(letters(node))


def fault_of(text: str, repeated: bool) -> str:
    seen = text.rstrip(SPACE)
    if not seen:
        return BLANK
    if repeated:
        return DUPLICATE
    return NONE if seen[-1] in ".!?" else TRUNCATED


class Conversation:
    """One conversation as its turns arrive."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.faults = dict.fromkeys((BLANK, DUPLICATE, TRUNCATED), 0)
        self.illegal, self.before = 0, None
        self.first = self.last = None
        self.distinct, self.rows = 0, 0
        self.audit, self.edits, self.turns = Audit(), bytearray(), 0
        self.sha = hashlib.sha256()

    def _take(self, decided, emit) -> None:
        for edit, role, text in decided:
            self.edits += edit.encode()
            if edit != DELETE:
                self.sha.update((f"\n{role}:{text}" if self.turns else f"{role}:{text}").encode())
                emit((self.conv_id, self.turns, edit, role, text))
                self.turns += 1

    def add(self, turn: int | None, role: str, text: str, repeated: bool, emit) -> None:
        fault = fault_of(text, repeated)
        if fault:
            self.faults[fault] += 1
        self.illegal += self.before is not None and self.before + role[:1] not in LEGAL
        self.before = role[:1]
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.distinct = turn, self.distinct + 1
        self.audit.add(role, text, fault)
        self.rows += 1
        if self.rows % FLUSH_ROWS == 0:
            self._take(self.audit.decided(), emit)

    def end(self, emit) -> tuple:
        cost, rest = self.audit.finish()
        self._take(rest, emit)
        gaps = self.last - self.first + 1 - self.distinct if self.distinct else 0
        return (self.conv_id, gaps, *self.faults.values(), self.illegal, cost, self.edits.decode(), self.sha.hexdigest())


AUDIT_SCHEMA = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
TURN_SCHEMA = "place long, edit string, role string, text string"
OUT_ROWS = 4096


def _stream(fields: pa.Schema, turns: bool):
    """Arrow batches of sorted rows to one row per conversation, or to the
    rows of the repaired conversations."""

    def run(batches):
        out: list[tuple] = []
        emit = out.append if turns else (lambda row: None)
        now: Conversation | None = None

        def batch():
            cols = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), fields, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(cols, schema=fields)

        def close():
            done = now.end(emit)
            if not turns:
                out.append(done)

        for b in batches:
            for conv, turn, role, text, present, nth in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if now is None or now.conv_id != conv:
                    if now is not None:
                        close()
                    now = Conversation(conv)
                if present:
                    now.add(turn, role, text, nth > 1, emit)
                if len(out) >= OUT_ROWS:
                    yield batch()
        if now is not None:
            close()
        if out:
            yield batch()

    return run


def _sorted_rows(rows: DataFrame) -> DataFrame:
    present = F.coalesce(F.col("present"), F.lit(True)) if "present" in rows.columns else F.lit(True)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    copy = F.col("copy") if "copy" in rows.columns else F.lit(0)
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), text("role"), text("text"), present.alias("present"), copy.cast("int").alias("copy"))
    rows = rows.repartition("conv_id")  # the one shuffle: window and order below are local to it
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("copy")]
    nth = F.row_number().over(Window.partitionBy("conv_id", "present", "role", "text").orderBy("turn", "copy"))
    rows = rows.withColumn("nth", nth).sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *order)
    return rows.select("conv_id", "turn", "role", "text", "present", "nth")


def _run(rows: DataFrame, schema: str, turns: bool) -> DataFrame:
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, {schema}"
    fields = to_arrow_schema(StructType.fromDDL(schema))
    return _sorted_rows(rows).mapInArrow(_stream(fields, turns), schema)


def repair(rows: DataFrame) -> DataFrame:
    """Per conversation its faults and its cheapest repair.

    ``rows``: conv_id, turn, role, text; null roles and texts are one space.
    Turns go by turn (nulls first), role, text, then ``copy`` (optional: the
    place among rows repeated on purpose). Rows with ``present`` false
    (optional column) only name their conversation. A null conv_id is a
    conversation; other columns are left out; an empty table gives no row.

    Faults, first one counts: blank text, role and text seen earlier,
    truncated (last character none of ``.!?``). ``illegal`` counts neighbours
    whose role initials are none of su, ua, au; ``gaps`` missing turn numbers.
    ``audit`` has the initials of the edits Keep, Rerole, Delete, Insert whose
    result reads ``(s?(ua)+)?``, at the least ``cost``, the ASCII-least of
    these; ``repaired_sha256`` is of its ``role:text`` lines.
    """
    return _run(rows, AUDIT_SCHEMA, False)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the repaired conversations."""
    return _run(rows, TURN_SCHEMA, True)


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row
    (``present`` false), 1 empties its text, 2 removes its ``.!?``, 3 repeats
    it, 4 makes its role user. Nulls are one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    hurt = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), hurt.alias("text"),
        (F.col("kind") != 0).alias("present"), F.explode(copies).alias("copy"),
    )
