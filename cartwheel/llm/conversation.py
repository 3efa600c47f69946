"""Conversation structure repair by a survivor-coalescence Viterbi search.

A repaired conversation's role initials match ``(s?(ua)+)?``.  Every turn is kept (0), given the role user or assistant
(3) or deleted (4; blank and repeated turns must be), turns without text are inserted anywhere (3 each), and a truncated
turn that is not deleted costs 3 more.  Of the cheapest repairs the one whose edits' initials are ASCII-least wins.

Spark marks each (conversation, role, text)'s first turn by a partial aggregate, hash-partitions turns and marks by
conversation and sorts them; a task then walks its conversations as a stream, with one survivor for each of the four
states (nothing yet, after s, after u, after a).  Survivors are leaves of a backpointer tree with reference counts: a
node whose last child goes is freed, one with a single child is joined with it, and once all survivors share an
ancestor its edits are emitted.  What stays is at most seven nodes and one byte for every edit on which survivors
still differ; texts are not kept, since every survivor carries the running SHA-256 of its repair.  No two survivors'
edits are prefixes of one another (each ends with its edit of the last turn), so the order of their complete
unresolved edits is kept as a rank, and a tie is settled by comparing (rank, new edits).

A survivor is dropped early when another one can do whatever it can still do at a strictly lower total cost.

One conversation is one task's stream (SHA-256 is sequential), in constant memory beyond its own audit.

Defined results: a null role or text counts as one space; turns are taken by turn number (nulls first), then by role, then by
the SHA-256 of the text; a null conversation id is a conversation of its own; repeated rows are repeated turns; other
columns are ignored; an empty table gives no row.  A turn with an empty role has no initial, so it cannot be kept as it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 3, 4, 3, 3
START, AFTER_S, AFTER_U, AFTER_A = range(4)
WHITE = " \t\n\x0b\x0c\r"

# edits as bytes: delete, insert user / assistant, keep, rerole to user / assistant
DELETE, INSERT_U, INSERT_A, KEEP, REROLE_U, REROLE_A = b"DiIKrR"
INITIAL = bytes.maketrans(b"DiIKrR", b"DIIKRR")
_ROLE = {INSERT_U: b"user", INSERT_A: b"assistant", REROLE_U: b"user", REROLE_A: b"assistant"}

_INSERTS = {START: [(START, b""), (AFTER_U, b"i"), (AFTER_A, b"iI")], AFTER_S: [(AFTER_S, b""), (AFTER_U, b"i"), (AFTER_A, b"iI")],
            AFTER_U: [(AFTER_U, b""), (AFTER_A, b"I")], AFTER_A: [(AFTER_A, b""), (AFTER_U, b"i")]}
_AFTER = {"s": {START: AFTER_S}, "u": {START: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U}, "a": {AFTER_U: AFTER_A}}
# _SLACK[p][q]: what the rest of a repair can cost from state p beyond its cost from state q
_SLACK = {START: {AFTER_S: 0, AFTER_U: INSERT_COST, AFTER_A: 0},
          AFTER_S: {START: 2 * INSERT_COST, AFTER_U: INSERT_COST, AFTER_A: 2 * INSERT_COST},
          AFTER_U: {START: INSERT_COST + DELETE_COST, AFTER_S: INSERT_COST, AFTER_A: INSERT_COST},
          AFTER_A: {START: DELETE_COST, AFTER_S: 0, AFTER_U: INSERT_COST}}


def _moves(initial: str, must_go: bool, truncated: bool) -> list[tuple[int, int, int, bytes, bytes]]:
    """(from state, to state, cost, edits, their initials) of one turn, inserts before it included."""
    out = []
    extra = TRUNCATED_COST if truncated else 0
    for p, ways in _INSERTS.items():
        for q, inserts in ways:
            steps = [(q, DELETE_COST, DELETE)]
            if not must_go:
                kept = _AFTER.get(initial, {}).get(q)
                if kept is not None:
                    steps.append((kept, KEEP_COST + extra, KEEP))
                steps.append((AFTER_A, REROLE_COST + extra, REROLE_A) if q == AFTER_U else (AFTER_U, REROLE_COST + extra, REROLE_U))
            for r, cost, edit in steps:
                edits = inserts + bytes([edit])
                out.append((p, r, cost + INSERT_COST * len(inserts), edits, edits.translate(INITIAL)))
    return out


MOVES = {(i, go, cut): _moves(i, go, cut) for i in ("s", "u", "a", "") for go in (False, True) for cut in (False, True)}


class Node:
    """Edits on the way from ``parent``; ``refs`` counts children."""
    __slots__ = ("edits", "parent", "refs")

    def __init__(self, parent: Node | None, edits: bytes = b""):
        self.parent, self.edits, self.refs = parent, bytearray(edits), 0


class Survivor:
    __slots__ = ("cost", "hash", "node", "rank")

    def __init__(self, cost: int, rank: int, node: Node, hash_):
        self.cost, self.rank, self.node, self.hash = cost, rank, node, hash_


class Search:
    """The survivors of one conversation; ``emit`` takes edits as soon as they are certain."""

    def __init__(self, emit: Callable[[bytes], None]):
        self.emit = emit
        self.root = Node(None)
        self.alive = {START: Survivor(0, 0, self.root, hashlib.sha256())}

    def _say(self, hash_, state: int, edits: bytes, role: bytes, text: bytes) -> None:
        any_before = state != START
        for e in edits:
            if e == DELETE:
                continue
            if any_before:
                hash_.update(b"\n")
            any_before = True
            hash_.update(role if e == KEEP else _ROLE[e])
            hash_.update(b":")
            if e not in (INSERT_U, INSERT_A):
                hash_.update(text)

    def _free(self, node: Node) -> None:
        """Drop a leaf; a parent left with one child is joined with it."""
        parent = node.parent
        while parent is not None:
            parent.refs -= 1
            if parent.refs:
                break
            node, parent = parent, parent.parent

    def _join(self) -> None:
        """Join single children with their parents and emit what all survivors share."""
        for s in self.alive.values():
            node = s.node
            while node.parent is not None and node.parent is not self.root:
                up = node.parent
                if up.refs == 1:
                    up.edits += node.edits
                    node.edits, node.parent = up.edits, up.parent
                else:
                    node = up
        while self.root.refs == 1:
            node = next(iter(self.alive.values())).node
            while node.parent is not self.root:
                node = node.parent
            self.emit(bytes(node.edits))
            node.edits, node.parent = bytearray(), None
            self.root = node

    def step(self, role: bytes, text: bytes, must_go: bool, truncated: bool) -> None:
        """Take one turn."""
        initial = chr(role[0]) if role[:1] in (b"s", b"u", b"a") else ""
        old = self.alive
        best: dict[int, tuple] = {}
        for p, q, cost, edits, initials in MOVES[initial, must_go, truncated]:
            s = old.get(p)
            if s is not None:
                cand = (s.cost + cost, s.rank, initials, p, edits)
                if q not in best or cand < best[q]:
                    best[q] = cand
        for q in list(best):
            if any(best[q][0] > best[p][0] + _SLACK[p][q] for p in best if p != q):
                del best[q]
        order = sorted(best, key=lambda q: best[q][1:3])
        new = {}
        for rank, q in enumerate(order):
            cost, _, _, p, edits = best[q]
            s = old[p]
            hash_ = s.hash.copy()
            self._say(hash_, p, edits, role, text)
            s.node.refs += 1
            new[q] = Survivor(cost, rank, Node(s.node, edits), hash_)
        self.alive = new
        for s in old.values():
            if not s.node.refs:
                self._free(s.node)
        self._join()

    def finish(self) -> tuple[int, str]:
        """(cost, SHA-256) of the cheapest repair; the rest of its edits is emitted."""
        ends = {START: b"", AFTER_S: b"iI", AFTER_U: b"I", AFTER_A: b""}
        state = min(self.alive, key=lambda q: (self.alive[q].cost + INSERT_COST * len(ends[q]), self.alive[q].rank))
        s, tail = self.alive[state], ends[state]
        path, node = [tail], s.node
        while node is not None:
            path.append(bytes(node.edits))
            node = node.parent
        self.emit(b"".join(reversed(path)))
        self._say(s.hash, state, tail, b"", b"")
        return s.cost + INSERT_COST * len(tail), s.hash.hexdigest()


# ---------------------------------------------------------------- Spark

PRESENT, FIRST, TURN = range(3)  # kinds of rows in the stream, in order


def _stream(turns: DataFrame, ids: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Turns, marks of first occurrences and conversation ids, by conversation in order."""
    said = F.coalesce(F.col(text).cast("string"), F.lit(" "))
    bare = F.rtrim(said, F.lit(WHITE))
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
                        F.unhex(F.sha2(said, 256)).alias("mark"), F.lit(TURN).cast("byte").alias("kind"), F.encode(said, "UTF-8").alias("text"),
                        (bare == "").alias("blank"), ((bare != "") & ~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    # the least turn number, nulls before all others, as the order of the stream has them
    first = (rows.groupBy("conv", "role", "mark").agg(F.min("turn").alias("low"), F.max(F.col("turn").isNull()).alias("none"))
             .select("conv", F.when(~F.col("none"), F.col("low")).alias("turn"), "role", "mark", F.lit(FIRST).cast("byte").alias("kind")))
    present = ids.select(F.col(conv).alias("conv")).distinct().withColumn("kind", F.lit(PRESENT).cast("byte"))
    everything = rows.unionByName(first, allowMissingColumns=True).unionByName(present, allowMissingColumns=True)
    return everything.repartition("conv").sortWithinPartitions("conv", "turn", F.col("role").asc_nulls_first(), F.col("mark").asc_nulls_first(), "kind")


def _initial(role: bytes) -> str:
    return chr(role[0]) if role[:1] in (b"s", b"u", b"a") else "?"


class _Walk:
    """One conversation as its rows come: counts, search, audit."""

    def __init__(self, conv, emit: Callable[[bytes], None]):
        self.conv = conv
        self.blank = self.duplicate = self.truncated = self.illegal = self.rows = 0
        self.low = self.high = None
        self.distinct = 0
        self.before: str | None = None
        self.search = Search(emit)

    def turn(self, turn: int | None, role: bytes, text: bytes, blank: bool, cut: bool, first: bool) -> None:
        self.rows += 1
        if turn is not None:
            self.distinct += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        now = _initial(role)
        self.illegal += self.before is not None and self.before + now not in ("su", "ua", "au")
        self.before = now
        duplicate = not blank and not first
        cut = cut and not duplicate
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += cut
        self.search.step(role, text, blank or duplicate, cut)

    def gaps(self) -> int:
        return 0 if self.high is None else min(self.high - self.low + 1 - self.distinct, (1 << 63) - 1)


def _walk(batches: Iterator[pa.RecordBatch], emitter: Callable[[object], Callable[[bytes], None]]) -> Iterator[tuple[str, _Walk, tuple]]:
    """("turn" or "end", the conversation, its turn) over a sorted stream."""
    walk, mark = None, None
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in ("conv", "kind", "turn", "role", "mark", "text", "blank", "cut")], strict=True):
            conv, kind, turn, role, digest, text, blank, cut = row
            if walk is None or conv != walk.conv:
                if walk is not None:
                    yield "end", walk, ()
                walk, mark = _Walk(conv, emitter(conv)), None
            if kind == FIRST:
                mark = (turn, role, digest)
            elif kind == TURN:
                first = mark == (turn, role, digest)
                mark = None
                walk.turn(turn, role.encode(), text, blank, cut, first)
                yield "turn", walk, (turn, role, text)
    if walk is not None:
        yield "end", walk, ()


def summarise(turns: DataFrame, ids: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row a conversation of ``ids`` (of ``turns`` by default): faults, cost, audit and digest of the repair."""
    kind = turns.schema[conv].dataType
    out = f"`{conv}` {kind.simpleString()}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, n_turns long"
    names = [conv, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256", "n_turns"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit = bytearray()
        done, size = [], 0
        conv_type = None

        def emitter(conv):
            audit.clear()
            return audit.extend

        def table() -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, conv_type if k == 0 else None) for k, c in enumerate(zip(*done, strict=True))], names)

        def typed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal conv_type
            for batch in batches:
                conv_type = batch.schema.field("conv").type
                yield batch

        for what, walk, _ in _walk(typed(batches), emitter):
            if what == "end":
                cost, digest = walk.search.finish()
                told = audit.translate(INITIAL).decode()
                done.append((walk.conv, walk.gaps(), walk.blank, walk.duplicate, walk.truncated, walk.illegal, cost, told, digest, walk.rows))
                size += len(told)
                if len(done) >= 2000 or size > 1 << 22:
                    yield table()
                    done, size = [], 0
        if done:
            yield table()

    return _stream(turns, turns if ids is None else ids, conv, turn, role, text).mapInArrow(run, out)


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The edits of every conversation, a row each: (conv_id, position, edit, turn, role, text).

    ``position`` counts a conversation's edits from 0; ``edit`` is keep, rerole, delete or insert.  The walk passes a
    turn's text on when it reads it and the turn's edit when it is certain; a grouping by (conversation, turn's place)
    joins the two, so no task holds the texts of unresolved turns.
    """
    kind = turns.schema[conv].dataType
    shape = f"conv {kind.simpleString()}, place long, position long, edit string, new_role string, turn long, role string, text binary"
    names = ["conv", "place", "position", "edit", "new_role", "turn", "role", "text"]
    said = {DELETE: ("delete", None), INSERT_U: ("insert", "user"), INSERT_A: ("insert", "assistant"), KEEP: ("keep", None),
            REROLE_U: ("rerole", "user"), REROLE_A: ("rerole", "assistant")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        conv_type, size = None, 0

        def emitter(conv):
            place = position = 0

            def emit(edits: bytes) -> None:
                nonlocal place, position
                for e in edits:
                    edit, new = said[e]
                    inserted = edit == "insert"
                    out.append((conv, None if inserted else place, position, edit, new, None, None, None))
                    place, position = place + (not inserted), position + 1
            return emit

        def table() -> pa.RecordBatch:
            types = [conv_type, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

        def typed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal conv_type
            for batch in batches:
                conv_type = batch.schema.field("conv").type
                yield batch

        for what, walk, row in _walk(typed(batches), emitter):
            if what == "end":
                walk.search.finish()
            else:
                out.append((walk.conv, walk.rows - 1, None, None, None, *row))
                size += len(row[2])
            if len(out) >= 2000 or size > 1 << 22:
                yield table()
                out.clear()
                size = 0
        if out:
            yield table()

    stream = _stream(turns, turns, conv, turn, role, text).mapInArrow(run, shape)
    spread = F.coalesce(F.col("place"), -1 - F.col("position"))  # an inserted turn is a group of its own
    one = stream.groupBy("conv", spread.alias("spread")).agg(*[F.max(c).alias(c) for c in names[2:]])
    return one.select(F.col("conv").alias(conv), "position", "edit", F.col("turn").alias(turn), F.coalesce("new_role", "role").alias(role),
                      F.coalesce(F.decode("text", "UTF-8"), F.lit("")).alias(text))


def damage(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Faults dealt by crc32(`conv:turn`) % 20: 0 drops a turn, 1 empties it, 2 removes its [.!?], 3 repeats it, 4 makes it the user's."""
    def told(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(told(conv), F.lit(":"), told(turn))) % 20
    hurt = turns.select(conv, turn, role, text, fault.alias("fault")).where("fault != 0")
    new_text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate(told(text), ".!?", "")).otherwise(told(text))
    times = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return hurt.select(conv, turn, F.when(F.col("fault") == 4, "user").otherwise(told(role)).alias(role), new_text.alias(text), F.explode(times).alias("copy")).drop("copy")
