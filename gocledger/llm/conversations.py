"""Conversation structure repair: the cheapest edits that make turns alternate.

Rows are dealt out by conversation and sorted by turn (secondary sort), so every
task streams whole conversations in order, whatever the Arrow batches cut.  What
is carried from row to row is the state of a dynamic program over the repaired
form ``(system? (user assistant)+)?``: for each of the four states of that form
the least cost and, among equally cheap edits, the place of the ASCII-least
sequence of initials.  A row adds four bytes of backpointers.

Backpointers, texts and the digests of texts seen are kept in memory up to a
bound and then written to an unnamed temporary file of the task, so a
conversation of any length takes bounded memory (but for one byte a row: its
edits).  Such a file holds nothing that another task needs: it vanishes with the
task, and a task that is run again writes its own.

Ties in the initials: a row's edits are one of ``D K R IK IR`` (``I`` before ``D``
can always be put off, and more than one ``I`` before a row never pays), none of
which begins another; so two sequences compare token by token, and the order among
the states' best sequences is all that has to be carried.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gocledger.llm.common import pa_type

#: Bytes of texts, of backpointers and of digests that a conversation keeps in memory.
SPILL_BYTES = 16 << 20

DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
_TOKENS = (b"D", b"K", b"R", b"IK", b"IR")
_EMPTY, _SYSTEM, _USER, _ASSISTANT = range(4)
#: (state, role initial) -> state; initials: s, u, a, any other.
_NEXT = {(_EMPTY, 0): _SYSTEM, (_EMPTY, 1): _USER, (_SYSTEM, 1): _USER, (_USER, 2): _ASSISTANT, (_ASSISTANT, 1): _USER}
_ROLES = {1: b"user", 2: b"assistant"}
_LEGAL = {(0, 1), (1, 2), (2, 1)}
_GAP = "\t\n\x0b\x0c\r "

#: (cost above the least, place of its sequence among the states'), or None where a state cannot be reached.
State = tuple[tuple[int, int] | None, ...]
_START: State = ((0, 0), None, None, None)


def _wanted(state: int) -> int:
    """The initial that an inserted or re-roled row takes in a state."""
    return 2 if state == _USER else 1


def _step(state: State, initial: int, fault: int) -> tuple[State, int, bytes]:
    """State after a row (fault: 0 none, 1 truncated, 2 to be deleted), what the least cost rose
    by, and for each state reached the state it came from and its token."""
    best: dict[int, tuple[int, int, bytes, int]] = {}
    for s, known in enumerate(state):
        if known is None:
            continue
        cost, place = known
        moves = [(DELETE, b"D", s)]
        if fault < 2:
            for more, token, at in ((0, b"", s), (INSERT, b"I", _NEXT[s, _wanted(s)])):
                if (at, initial) in _NEXT:
                    moves.append((more + fault * TRUNCATED, token + b"K", _NEXT[at, initial]))
                moves.append((more + REROLE + fault * TRUNCATED, token + b"R", _NEXT[at, _wanted(at)]))
        for price, token, to in moves:
            found = (cost + price, place, token, s)
            if to not in best or found < best[to]:
                best[to] = found
    least = min(b[0] for b in best.values())
    ranked = sorted(best, key=lambda to: best[to][1:3])
    after = tuple((best[to][0] - least, ranked.index(to)) if to in best else None for to in range(4))
    back = bytes(best[to][3] | _TOKENS.index(best[to][2]) << 2 if to in best else 255 for to in range(4))
    return after, least, back


def _finish(state: State) -> tuple[int, int, bytes]:
    """(state, cost above the least, closing inserts) of the cheapest complete form."""
    open_ends = {_EMPTY: b"", _ASSISTANT: b"", _USER: b"I", _SYSTEM: b"II"}
    cost, _, inserts, at = min((known[0] + INSERT * len(open_ends[s]), known[1], open_ends[s], s)
                               for s, known in enumerate(state) if known is not None)
    return at, cost, inserts


class _Spool:
    """Bytes appended in order, read back forwards or in equal records backwards; beyond ``bound`` in a file."""

    def __init__(self, bound: int) -> None:
        self.bound, self.held, self.file, self.size = bound, bytearray(), None, 0

    def add(self, data: bytes) -> None:
        self.held += data
        self.size += len(data)
        if len(self.held) > self.bound:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            self.file.write(self.held)
            self.held.clear()

    def read(self, at: int, n: int) -> bytes:
        filed = self.size - len(self.held)
        if at >= filed:
            return bytes(self.held[at - filed:at - filed + n])
        self.file.seek(at)
        got = self.file.read(min(n, filed - at))
        self.file.seek(0, 2)
        return got + bytes(self.held[:n - len(got)])

    def blocks(self, n: int) -> Iterator[bytes]:
        for at in range(0, self.size, n):
            yield self.read(at, n)

    def blocks_back(self, n: int) -> Iterator[bytes]:
        for at in range((self.size - 1) // n * n, -1, -n):
            yield self.read(at, n)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class _Seen:
    """128-bit digests met before: a set, and beyond the bound sorted runs in a file."""

    def __init__(self, bound: int) -> None:
        self.most, self.recent, self.runs, self.file = max(1, bound // 64), set(), [], None

    def add(self, digest: bytes) -> bool:
        """True if the digest is new."""
        if digest in self.recent:
            return False
        if self.runs:
            want = np.frombuffer(digest, ">u8")
            for high, low in self.runs:
                at, end = np.searchsorted(high, want[0], "left"), np.searchsorted(high, want[0], "right")
                if (low[at:end] == want[1]).any():
                    return False
        self.recent.add(digest)
        if len(self.recent) >= self.most:
            self._spill()
        return True

    def _spill(self) -> None:
        both = np.frombuffer(b"".join(sorted(self.recent)), ">u8").reshape(-1, 2)
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        for part in (both[:, 0], both[:, 1]):
            self.file.write(part.astype(np.uint64).tobytes())
        self.file.flush()
        n, at = len(both), self.file.tell()
        self.runs.append(tuple(np.memmap(self.file, np.uint64, "r", at - 8 * n * k, (n,)) for k in (2, 1)))
        self.recent.clear()

    def close(self) -> None:
        self.runs.clear()
        if self.file is not None:
            self.file.close()


class _Conversation:
    """One conversation as its rows stream by."""

    def __init__(self, key: object, spill: int, steps: dict[tuple[State, int, int], tuple[State, int, bytes]]) -> None:
        self.key, self.n, self.steps = key, 0, steps
        self.state, self.cost, self.last = _START, 0, None
        self.low = self.high = self.turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.rows, self.back, self.seen = _Spool(spill), _Spool(spill), _Seen(spill)

    def add(self, turn: int | None, role: bytes, text: bytes, initial: int, fault: int) -> None:
        if turn is not None and turn != self.turn:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        self.turn = turn
        if self.n and (self.last, initial) not in _LEGAL:
            self.illegal += 1
        self.last = initial
        new = self.seen.add(hashlib.blake2b(b"%d:%b%b" % (len(role), role, text), digest_size=16).digest())
        if fault == 2:
            self.blank += 1
        elif not new:
            self.duplicate += 1
            fault = 2
        elif fault == 1:
            self.truncated += 1
        if (call := (self.state, initial, fault)) not in self.steps:
            self.steps[call] = _step(*call)
        self.state, rose, back = self.steps[call]
        self.cost += rose
        self.back.add(back)
        self.rows.add(b"%d %d %d \n" % (len(role), len(text), initial) + role + text)
        self.n += 1

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns

    def edits(self) -> tuple[bytearray, bytes]:
        """Sets the full cost; returns the number of each row's token, and the closing inserts."""
        at, more, inserts = _finish(self.state)
        self.cost += more
        tokens = bytearray()
        for block in self.back.blocks_back(1 << 18):
            for i in range(len(block) - 4, -1, -4):
                b = block[i + at]
                tokens.append(b >> 2)
                at = b & 3
        tokens.reverse()
        return tokens, inserts

    def originals(self) -> Iterator[tuple[bytes, bytes, int]]:
        held, blocks, at = b"", self.rows.blocks(1 << 20), 0
        while True:
            end = held.find(b"\n", at)
            n = [int(x) for x in held[at:end].split()] if end >= 0 else None
            if n is None or end + 1 + n[0] + n[1] > len(held):
                need = 1 if n is None else end + 1 + n[0] + n[1] - len(held)
                parts = [held[at:]]
                while need > 0:
                    block = next(blocks, None)
                    if block is None:
                        return
                    parts.append(block)
                    need -= len(block)
                held, at = b"".join(parts), 0
                continue
            role = held[end + 1:end + 1 + n[0]]
            at = end + 1 + n[0] + n[1]
            yield role, held[at - n[1]:at], n[2]

    def repaired(self, tokens: bytearray, inserts: bytes) -> Iterator[tuple[bytes, bytes, bytes, int | None]]:
        """(edit, role, text, number of the original row) of every row of the repaired conversation."""
        at = _EMPTY
        for i, ((role, text, initial), token) in enumerate(zip(self.originals(), tokens)):
            name = _TOKENS[token]
            if name[:1] == b"I":
                yield b"I", _ROLES[_wanted(at)], b"", None
                at = _NEXT[at, _wanted(at)]
            if name[-1:] == b"K":
                yield b"K", role, text, i
                at = _NEXT[at, initial]
            elif name[-1:] == b"R":
                yield b"R", _ROLES[_wanted(at)], text, i
                at = _NEXT[at, _wanted(at)]
        for _ in inserts:
            yield b"I", _ROLES[_wanted(at)], b"", None
            at = _NEXT[at, _wanted(at)]

    def close(self) -> None:
        for part in (self.rows, self.back, self.seen):
            part.close()


_LONG = (1 << 63) - 1


def _report(c: _Conversation) -> Iterator[tuple]:
    tokens, inserts = c.edits()
    digest, first = hashlib.sha256(), True
    for _, role, text, _ in c.repaired(tokens, inserts):
        digest.update(b"%b%b:%b" % (b"" if first else b"\n", role, text))
        first = False
    audit = b"".join(map(_TOKENS.__getitem__, tokens)) + inserts
    yield (c.key, min(c.gaps(), _LONG), c.blank, c.duplicate, c.truncated, c.illegal, c.cost, audit, digest.hexdigest())


def _lines(c: _Conversation) -> Iterator[tuple]:
    for slot, (edit, role, text, row) in enumerate(c.repaired(*c.edits())):
        yield c.key, slot, edit, role, text, row


def _streamed(emit: Callable[[_Conversation], Iterator[tuple]], names: list[str], types: list[pa.DataType], spill: int):
    """mapInArrow function over rows sorted by conversation and turn."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal held
            columns = list(zip(*out)) if out else [()] * len(names)
            out.clear()
            held = 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        def ended(c: _Conversation) -> Iterator[pa.RecordBatch]:
            nonlocal held
            for row in emit(c):
                out.append(row)
                held += 64 + sum(len(v) for v in row if isinstance(v, bytes))
                if held > spill:
                    yield flush()
            c.close()

        now: _Conversation | None = None
        steps: dict = {}  # cost differences are bounded, so only a few hundred steps differ
        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(n)).to_pylist()
                    for n in ("conv", "turn", "role", "text", "initial", "fault")]
            for conv, turn, role, text, initial, fault in zip(*cols):
                if now is None or now.key != conv:
                    if now is not None:
                        yield from ended(now)
                    now = _Conversation(conv, spill, steps)
                if fault is not None:
                    now.add(turn, role, text, initial, fault)
        if now is not None:
            yield from ended(now)
        if out:
            yield flush()

    return run


def _sorted(rows: DataFrame, conv_id: str, turn: str, role: str, text: str, present: str | None) -> DataFrame:
    """Rows dealt by conversation and sorted by turn, with role initial and own fault; a row that is
    not present only names its conversation (no fault, no text)."""
    here = F.coalesce(F.col(present), F.lit(False)) if present else F.lit(True)
    said, whose = F.coalesce(F.col(text), F.lit(" ")), F.coalesce(F.col(role), F.lit(" "))
    end = F.rtrim(said, F.lit(_GAP))
    first = F.left(whose, F.lit(1))
    of = rows.select(
        F.col(conv_id).alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.when(here, whose.cast("binary")).alias("role"), F.when(here, said.cast("binary")).alias("text"),
        F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3).alias("initial"),
        F.when(here, F.when(end == "", 2).when(F.right(end, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1)).alias("fault"))
    return of.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")


def repair_report(rows: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text", present: str | None = "present", spill_bytes: int = SPILL_BYTES) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256.

    ``present`` names a boolean column (if the rows have it): a row where it is not true
    only names its conversation.  Null roles and texts count as one space; null turns
    come first and make no gap; a null conv_id is a conversation of its own.  Rows of
    one turn go by role and text, bytewise; equal ones are duplicates of the first.
    A conversation without rows: zeros, empty audit, the digest of nothing.  No rows
    at all: none.  Columns of other names play no part.
    """
    present = present if present in rows.columns else None
    key = rows.schema[conv_id].dataType
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    types = [pa_type(key), *[pa.int64()] * 6, pa.string(), pa.string()]
    schema = f"conv_id {key.simpleString()}, " + ", ".join(f"{n} long" for n in names[1:7]) + ", audit string, repaired_sha256 string"
    return _sorted(rows, conv_id, turn, role, text, present).mapInArrow(
        _streamed(_report, names, types, spill_bytes), schema)


def repaired_rows(rows: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text", present: str | None = "present", spill_bytes: int = SPILL_BYTES) -> DataFrame:
    """The repaired conversations: conv_id, slot (from 0), edit (K kept, R re-roled, I inserted), role,
    text, source_row (the row's number within its conversation, from 0; null if inserted).
    Same rules as :func:`repair_report`; a conversation repaired to nothing has no rows."""
    present = present if present in rows.columns else None
    key = rows.schema[conv_id].dataType
    names = ["conv_id", "slot", "edit", "role", "text", "source_row"]
    types = [pa_type(key), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
    schema = f"conv_id {key.simpleString()}, slot long, edit string, role string, text string, source_row long"
    return _sorted(rows, conv_id, turn, role, text, present).mapInArrow(
        _streamed(_lines, names, types, spill_bytes), schema)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults, by crc32(``conv_id:turn``) mod 20: 0 the row goes
    (``present`` false), 1 its text is emptied, 2 loses its ``.!?``, 3 the row stands twice,
    4 it is the user's.  Nulls in any column count as one space in the key, the role and the text."""
    def filled(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(filled(F.col("conv_id")), F.lit(":"), filled(F.col("turn"))).cast("binary")) % 20
    text = filled(F.col("text"))
    of = rows.select(
        "conv_id", "turn", kind.alias("kind"), F.when(kind == 4, F.lit("user")).otherwise(filled(F.col("role"))).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind != 0).alias("present"))
    again = F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return of.withColumn("copy", again).drop("copy", "kind")
