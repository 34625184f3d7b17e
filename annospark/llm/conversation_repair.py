"""Cheapest repair of conversations whose turns don't go user, assistant, user, assistant.

A conversation's turns are edited (kept, given another role, deleted, or new ones inserted) so that the roles are one system turn at
most, then user and assistant in turn, and nothing else. A dynamic program over the turns holds, for each of four
states (nothing yet, after the system turn, after a user's, after an assistant's), the least cost and of all audits of that cost the least
in order. An audit is the string of its edits' initials.

Audits are persistent: each is a node that points to the audit it prolongs, so all share their prefixes and a step costs a node, not a string.
A node has binary-lifting ancestors and a rolling hash of its whole string. Of two audits that cost the same, the longest
common prefix is found by lifting both over unequal hashes; the letters after it decide. Equal hashes are believed only where both nodes are the
same one, otherwise the letters are compared.

Edits that all four audits share are final. They are taken off the nodes from time to time, with the turns they belong to, so what is
held follows the part of a conversation that is still open and not its length.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import fitted, stored

#: Costs of edits, and what a cut turn that stays costs more.
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
_MOD, _FACTOR = (1 << 61) - 1, 911_382_323_000_003
_NEVER = 1 << 60
#: Turns after which what is final is taken off.
OPEN_TURNS = 4096


class Audit:
    """A string of edits as a linked node."""

    __slots__ = ("letter", "depth", "print", "up")

    def __init__(self, parent: Audit | None = None, letter: str = "") -> None:
        self.letter, self.up = letter, []
        self.depth = self.print = 0
        if parent is not None:
            self.depth, self.print = parent.depth + 1, (parent.print * _FACTOR + ord(letter)) % _MOD
            node, k = parent, 0
            while True:  # ancestors 1, 2, 4, 8 ... edits before
                self.up.append(node)
                if k >= len(node.up):
                    break
                node, k = node.up[k], k + 1

    def ancestor(self, depth: int) -> Audit:
        node, steps, k = self, self.depth - depth, 0
        while steps:
            if steps & 1:
                node = node.up[k]
            steps >>= 1
            k += 1
        return node

    def letters(self, root: Audit) -> str:
        """The edits after ``root``."""
        out, node = [], self
        while node is not root:
            out.append(node.letter)
            node = node.up[0]
        return "".join(reversed(out))


def _walked(x: Audit, y: Audit) -> int:
    """The order of two audits of one length, letter by letter."""
    order = 0
    while x is not y:
        if x.letter != y.letter:
            order = -1 if x.letter < y.letter else 1
        x, y = x.up[0], y.up[0]
    return order


def before(x: Audit, y: Audit) -> bool:
    """Whether audit ``x`` comes before ``y`` in the order of strings."""
    depth = min(x.depth, y.depth)
    a, b = x.ancestor(depth), y.ancestor(depth)
    if a is b:
        return x.depth < y.depth
    if a.print == b.print:  # equal strings in two nodes, or a collision
        order = _walked(a, b)
        return order < 0 or (not order and x.depth < y.depth)
    for k in reversed(range(len(a.up))):
        if k < len(a.up) and a.up[k].print != b.up[k].print:
            a, b = a.up[k], b.up[k]
    if a.up[0] is not b.up[0]:  # verify that the prefixes are equal
        order = _walked(a.up[0], b.up[0])
        if order:
            return order < 0
    return a.letter < b.letter


#: States: nothing yet, after the system turn, after a user's turn, after an assistant's; what may follow by a turn's initial.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_KEPT = {"s": ((NOTHING, SYSTEM),), "u": ((NOTHING, USER), (SYSTEM, USER), (ASSISTANT, USER)), "a": ((USER, ASSISTANT),)}
_TURNED = ((NOTHING, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))


class Repair:
    """The dynamic program over one conversation. ``turn`` takes the turns in order; ``edits`` gives what is final so far."""

    def __init__(self) -> None:
        self.root = Audit()
        self.best: list[tuple[int, Audit | None]] = [(0, self.root), (_NEVER, None), (_NEVER, None), (_NEVER, None)]
        self.open, self.pause = 0, OPEN_TURNS
        self._insert()

    def _offer(self, best: list, state: int, cost: int, parent: Audit, letter: str) -> None:
        held = best[state]
        if cost < held[0]:
            best[state] = (cost, Audit(parent, letter))
        elif cost == held[0]:
            node = Audit(parent, letter)
            if before(node, held[1]):
                best[state] = (cost, node)

    def _insert(self) -> None:
        # a user's turn may come in anywhere but after one, and then an assistant's
        base = list(self.best)
        for state in (NOTHING, SYSTEM, ASSISTANT):
            if base[state][1] is not None:
                self._offer(self.best, USER, base[state][0] + INSERT, base[state][1], "I")
        if self.best[USER][1] is not None:
            self._offer(self.best, ASSISTANT, self.best[USER][0] + INSERT, self.best[USER][1], "I")

    def turn(self, initial: str, must_go: bool, cut: bool) -> None:
        old, new = self.best, [(_NEVER, None)] * 4
        for state, (cost, node) in enumerate(old):
            if node is not None:
                self._offer(new, state, cost + DELETE, node, "D")
        if not must_go:
            more = CUT if cut else 0
            for letter, cost, moves in (("K", more, _KEPT.get(initial, ())), ("R", more + REROLE, _TURNED)):
                for state, after in moves:
                    if old[state][1] is not None:
                        self._offer(new, after, old[state][0] + cost, old[state][1], letter)
        self.best = new
        self._insert()
        self._forget()
        self.open += 1

    def _forget(self) -> None:
        """Drops the states before the first pair once they can't win: another state takes their way at 4 more (a system turn deleted) and 3 after a user's turn."""
        paired = min(self.best[ASSISTANT][0], self.best[USER][0] + INSERT)
        if paired < self.best[SYSTEM][0]:
            self.best[SYSTEM] = (_NEVER, None)
        if paired + DELETE < self.best[NOTHING][0]:
            self.best[NOTHING] = (_NEVER, None)

    def edits(self) -> str:
        """Edits that all audits share and that were not given before; called again when as many turns as are open have come."""
        nodes = [n for _, n in self.best if n is not None]
        shared = nodes
        while len(shared := list({id(n): n for n in shared}.values())) > 1:
            deepest = max(n.depth for n in shared)
            shared = [n.up[0] if n.depth == deepest else n for n in shared]
        final = shared[0].letters(self.root)
        root, made = Audit(), {}
        made[id(shared[0])] = root
        for node in nodes:  # the rest anew, without ancestors that are final
            chain = []
            while id(node) not in made:
                chain.append(node)
                node = node.up[0]
            for x in reversed(chain):
                made[id(x)] = Audit(made[id(x.up[0])], x.letter)
        self.best = [(c, None if n is None else made[id(n)]) for c, n in self.best]
        self.root, self.open = root, 0
        self.pause = max(OPEN_TURNS, max(n.depth for _, n in self.best if n is not None))
        return final

    def end(self) -> tuple[int, str]:
        """The least cost of all, and the edits not given before."""
        found, paired = self.best[NOTHING], self.best[ASSISTANT]
        if paired[0] < found[0] or (paired[0] == found[0] and before(paired[1], found[1])):
            found = paired
        return found[0], found[1].letters(self.root)


class Repaired:
    """Turns of the repaired conversation from its turns and edits."""

    def __init__(self) -> None:
        self.waiting: deque[tuple[str, str]] = deque()
        self.state = NOTHING

    def apply(self, edits: str) -> Iterator[tuple[str, str, str]]:
        """``edit, role, text`` of the turns that stay or come in."""
        for edit in edits:
            role, text = ("", "") if edit == "I" else self.waiting.popleft()
            if edit == "D":
                continue
            if edit == "K" and role[:1] == "s":
                self.state = SYSTEM
                yield edit, role, text
                continue
            self.state = ASSISTANT if self.state == USER else USER
            yield edit, role if edit == "K" else ("assistant" if self.state == ASSISTANT else "user"), text


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: conversations spoilt for tests, by a checksum of conversation and turn.

    Of 20 remainders 0 drops the turn (no copies), 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it, 4 makes it a user's. Nulls of any column
    count as one space (a null turn stays null, and so does a null conversation).
    """
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rest = F.pmod(F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))), F.lit(20))
    text = F.when(rest == 1, "").when(rest == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    return turns.select("conv_id", "turn", F.when(rest == 4, "user").otherwise(shown("role")).alias("role"), text.alias("text"), F.when(rest == 0, 0).when(rest == 3, 2).otherwise(1).alias("copies"))


def _same(role: Column, text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


def _flagged(turns: DataFrame) -> DataFrame:
    """Turns in order within partitions by conversation, with ``blank, again`` (seen in an earlier turn) and ``cut``.

    What occurs in several turns of a conversation is found by grouping digests, combined before the shuffle; that table is small, so the texts move
    once, to their conversation's task.
    """
    if "copies" not in turns.columns:
        turns = turns.withColumn("copies", F.lit(1))
    nulls = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = turns.select("conv_id", "turn", nulls("role"), nulls("text"), "copies").withColumn("same", _same(F.col("role"), F.col("text")))
    seen = rows.where("copies > 0").groupBy("conv_id", "same").agg(F.min("turn").alias("first"), F.max(F.col("turn").isNull()).alias("unplaced"), F.max("turn").alias("latest"))
    seen = stored(seen.where("latest > first OR (unplaced AND latest IS NOT NULL)"), "repeats").select(F.col("conv_id").alias("c"), F.col("same").alias("s"), F.when(~F.col("unplaced"), F.col("first")).alias("first"))
    joined = rows.join(fitted(seen), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("same") == F.col("s")), "left")
    again = F.col("s").isNotNull() & F.col("turn").isNotNull() & (F.col("first").isNull() | (F.col("turn") > F.col("first")))
    return joined.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        "role",
        "text",
        "copies",
        again.alias("again"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*+\z")).alias("cut"),
    ).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


_LEGAL = {"su", "ua", "au"}


class _Conversation:
    """Counts and repair of the conversation that rows come from just now."""

    def __init__(self, conv_id, write) -> None:
        self.conv_id, self.write = conv_id, write
        self.repair, self.repaired = Repair(), Repaired()
        self.low = self.high = self.last = None
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.initial = None
        self.audit: list[str] = []

    def _give(self, edits: str) -> None:
        self.audit.append(edits)
        for turn in self.repaired.apply(edits):
            self.write(turn)

    def add(self, turn, role: str, text: str, again: bool, blank: bool, cut: bool) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.distinct += 1
        again = again or (turn, role, text) == self.last
        self.last = (turn, role, text)
        duplicate = again and not blank
        cut = cut and not blank and not duplicate
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += cut
        if self.initial is not None and self.initial + role[:1] not in _LEGAL:
            self.illegal += 1
        self.initial = role[:1]
        self.repaired.waiting.append((role, text))
        self.repair.turn(role[:1], blank or duplicate, cut)
        if self.repair.open >= self.repair.pause:
            self._give(self.repair.edits())

    def end(self) -> list:
        cost, edits = self.repair.end()
        self._give(edits)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return [gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, "".join(self.audit)]


def _conversations(batches: Iterator[pa.RecordBatch], write) -> Iterator[_Conversation | None]:
    """Each conversation when its last row has come, and None after each batch. ``write(conv_id)`` gives the function that takes repaired turns."""
    now = None
    for batch in batches:
        for conv_id, turn, role, text, copies, again, blank, cut in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    yield now
                now = _Conversation(conv_id, write(conv_id))
            for _ in range(copies):
                now.add(turn, role, text, again, blank, cut)
        yield None
    if now is not None:
        yield now


def repaired_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, position, edit, role, text``: the turns of the repaired conversations, numbered from 0, with the edit each comes from.

    Treats nulls, repeats and the like as :func:`audits` does. Rows are given as soon as their edits are final.
    """
    rows = _flagged(turns)
    schema = rows.limit(0).selectExpr("conv_id", "0L position", "'' edit", "'' role", "'' text").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, kind = [], None

        def write(conv_id):
            counted = iter(range(1 << 62))
            return lambda turn: out.append((conv_id, next(counted), *turn))

        def given() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 5
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (kind, pa.int64(), *[pa.string()] * 3))], names=["conv_id", "position", "edit", "role", "text"])

        def noted():
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field(0).type
                yield batch

        for conversation in _conversations(noted(), write):
            if conversation is not None:
                conversation.end()
            elif len(out) >= 10_000:
                yield given()
        if kind is not None:
            yield given()

    return rows.mapInArrow(run, schema)


def audits(turns: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` for every conversation of ``conv_id, turn, role, text``.

    Turns come in order of ``turn`` (nulls first, ties by role and text). A column ``copies``, if there is one, says how often a row counts; a
    conversation whose rows all count 0 times has zeros and an empty audit. Null roles and texts are one space, a null
    ``conv_id`` is a conversation too, repeated rows are duplicates; an empty table gives an empty result; other columns are ignored.
    The repaired turns are digested (``role:text``, joined by newlines) where they are made, as they become final. A text may be of any
    length; a conversation streams through one task, since its digest is one sequence.
    """
    rows = _flagged(turns)
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    schema = rows.limit(0).selectExpr("conv_id", *(f"0L {n}" for n in names[:6]), "'' audit", "'' repaired_sha256").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests, out, kind = {}, [], None

        def write(conv_id):
            digest = digests[conv_id] = hashlib.sha256()
            begun = False

            def put(turn):
                nonlocal begun
                digest.update((("\n" if begun else "") + turn[1] + ":" + turn[2]).encode())
                begun = True

            return put

        def noted():
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field(0).type
                yield batch

        def given() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 9
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (kind, *[pa.int64()] * 6, pa.string(), pa.string()))], names=["conv_id", *names])

        for conversation in _conversations(noted(), write):
            if conversation is not None:
                row = conversation.end()
                out.append((conversation.conv_id, *row, digests.pop(conversation.conv_id).hexdigest()))
            elif len(out) >= 1000:
                yield given()
        if kind is not None:
            yield given()

    return rows.mapInArrow(run, schema)
