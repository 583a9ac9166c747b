"""Structure repair of conversations: cheapest edits that make the roles alternate.

*Faults.* A turn is blank (no visible character), else a duplicate (its role and
text were seen earlier in the conversation), else truncated (its last visible
character ends no sentence).

*Edits.* The roles of a repaired conversation are nothing, or an optional system
turn and then pairs of user and assistant. Keeping a turn costs 0, giving it
the role user or assistant 1, deleting it 2 (a must for blank ones and duplicates),
inserting an empty one of user or assistant anywhere 5; a truncated turn that
stays costs 5 more.

*Search.* A state of the grammar is nothing yet, or the role last seen. The
cost-to-go of each state is computed from the last turn to the first; then the
turns are walked forward from the empty state, and of the edits that are tight (their
cost and the cost-to-go behind them add up to that at hand) the first by letter
is taken: D, I, K, R. The edits' letters so are the least of all cheapest ones.

*Long conversations.* Turns come in segments of ``1 << SEGMENT`` turn numbers.
What a segment costs between any two states is a matrix of 16 numbers; these
matrices, not the turns, are composed backward to the cost-to-go at each
segment's end, and only for conversations of several segments. The forward walk
then reads turn after turn and holds one segment, so a conversation of any length
takes the memory of a segment and of its edits' letters (turns of one number are
one segment). One digest of all texts in their order can only be computed in one
place: a conversation is walked by one task, which streams it.

Which turns were seen earlier is found by key among all turns (no set of a
conversation's texts is held) and, like the cost-to-go, is sent to the walk as a
note in front of a segment. So texts are shuffled once, and once more for
long conversations.

Defined cases: null ids, roles and texts count as one space, a null id is a
conversation of its own that comes back with a null id; null turns come first.
Equal turns are in the order of role, then text. Repeated rows are duplicates.
Other columns are ignored. Empty tables give empty ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandframe.llm._names import col
from strandframe.llm._store import Scratch, ready

#: Turn numbers of a segment, as a power of two.
SEGMENT = 8
KEEP_, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
BLANK_CHARS, ENDS = "\x20\x09\x0a\x0b\x0c\x0d", ".!?"
LEGAL = {"su", "ua", "au"}
ROLES = {2: "user", 3: "assistant"}
# States: 0 nothing yet, 1 system, 2 user, 3 assistant last. The role that the grammar wants next but for system:
NEXT = (2, 2, 3, 2)
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: Cost-to-go behind the last turn.
END = (0, 10, 5, 0)
_FAR = 1 << 60

REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
TURNS = "conv_id long, place long, role string, text string, edit string"


def damage(talks: DataFrame) -> DataFrame:
    """Conversations with seeded faults: by a hash of id and turn, turns are dropped, emptied, cut, repeated or get another role."""
    turns = turns_of(talks)
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.struct(role.alias("role"), text.alias("text")), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1))
    return turns.select("conv_id", "turn", F.explode(copies).alias("x")).select("conv_id", "turn", "x.*")


def turns_of(talks: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The columns that count, nulls of role and text as one space."""
    text = lambda c: F.coalesce(col(c).cast("string"), F.lit(" "))
    return talks.select(col(conv_col).cast("long").alias("conv_id"), col(turn_col).cast("long").alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"))


def key_of(conv: int | None, role: str, text: str) -> bytes:
    """The same key as _key's."""
    return hashlib.md5(f"{' ' if conv is None else conv}|{len(role)}|{role}|{text}".encode()).digest()


def _key() -> Column:
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))
    return F.unhex(F.md5(F.concat(conv, F.lit("|"), F.length("role").cast("string"), F.lit("|"), "role", F.lit("|"), "text").cast("binary")))


def _seg() -> Column:
    return F.coalesce(F.shiftright("turn", SEGMENT), F.lit(-(1 << 63)))


# --- one segment -------------------------------------------------------------------------


def backward(codes: list[tuple[str, bool, bool]], tail: tuple[int, ...]) -> list[list[int]]:
    """Cost-to-go of each state before each turn (initial, must go, truncated), and behind the last one."""
    out = [list(tail)]
    for initial, must, cut in reversed(codes):
        ahead, now, extra = out[-1], [], CUT if cut else 0
        for q in range(4):
            best = DELETE + ahead[q]
            if not must:
                kept = KEPT.get((q, initial))
                if kept is not None:
                    best = min(best, KEEP_ + extra + ahead[kept])
                best = min(best, REROLE + extra + ahead[NEXT[q]])
            now.append(best)
        for _ in range(3):
            for q in range(4):
                now[q] = min(now[q], INSERT + now[NEXT[q]])
        out.append(now)
    return out[::-1]


def matrix(codes: list[tuple[str, bool, bool]]) -> list[int]:
    """Costs from each state before a segment to each behind it, row by row."""
    columns = [backward(codes, tuple(0 if q == end else _FAR for q in range(4)))[0] for end in range(4)]
    return [min(columns[end][q], _FAR) for q in range(4) for end in range(4)]


def forward(codes: list[tuple[str, bool, bool]], costs: list[list[int]], state: int, last: bool) -> tuple[list[tuple[str, int, int]], int]:
    """Edits (letter, turn, state behind it) from a state through a segment, and the state reached."""
    out, i = [], 0
    while i < len(codes) or (last and costs[i][state]):
        now = costs[i][state]
        if i < len(codes):
            initial, must, cut = codes[i]
            extra, ahead = CUT if cut else 0, costs[i + 1]
            if now == DELETE + ahead[state]:
                out.append(("D", i, state))
                i += 1
                continue
        if now == INSERT + costs[i][NEXT[state]]:
            state = NEXT[state]
            out.append(("I", i, state))
            continue
        kept = KEPT.get((state, initial))
        if kept is not None and now == KEEP_ + extra + ahead[kept]:
            state = kept
            out.append(("K", i, state))
        else:
            state = NEXT[state]
            out.append(("R", i, state))
        i += 1
    return out, state


# --- the stream of segments --------------------------------------------------------------


@dataclass
class Segment:
    conv: int | None
    seg: int
    tail: tuple[int, ...] | None = None
    seen: set[tuple[bytes, int]] = field(default_factory=set)
    rows: list[tuple[int | None, str, str]] = field(default_factory=list)

    def codes(self) -> tuple[list[tuple[str, bool, bool]], list[str]]:
        """Codes for the search, and the fault of each turn."""
        codes, faults, before = [], [], None
        for row in self.rows:
            turn, role, text = row
            bare = text.rstrip(BLANK_CHARS)
            if not bare:
                fault = "blank"
            elif row == before or (self.seen and (key_of(self.conv, role, text), turn) in self.seen):
                fault = "duplicate"
            else:
                fault = "" if bare[-1] in ENDS else "truncated"
            codes.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
            faults.append(fault)
            before = row
        return codes, faults


def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[Segment]:
    """Sorted rows as segments; notes precede the turns of theirs."""
    now = None
    for batch in batches:
        for conv, seg, kind, turn, role, text, seen, tail in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or (now.conv, now.seg) != (conv, seg):
                if now is not None:
                    yield now
                now = Segment(conv, seg)
            if kind:
                now.rows.append((turn, role, text))
            elif tail is not None:
                now.tail = tuple(tail)
            else:
                now.seen.add((seen, turn))
    if now is not None:
        yield now


class Walk:
    """One conversation on its way forward."""

    def __init__(self, conv: int | None, turns: bool):
        self.conv, self.state, self.cost, self.before, self.place = conv, 0, None, None, 0
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.lowest, self.highest, self.different = 0, None, None, 0
        self.letters, self.digest = [], hashlib.sha256()
        self.turns = [] if turns else None

    def take(self, s: Segment) -> None:
        codes, faults = s.codes()
        last = s.tail is None
        costs = backward(codes, s.tail or END)
        if self.cost is None:
            self.cost = costs[0][0]
        edits, self.state = forward(codes, costs, self.state, last)
        for letter, i, state in edits:
            self.letters.append(letter)
            if letter != "D":
                role = s.rows[i][1] if letter == "K" else ROLES[state]
                text = "" if letter == "I" else s.rows[i][2]
                self.digest.update(f"{'\n' if self.place else ''}{role}:{text}".encode())
                if self.turns is not None:
                    self.turns.append((self.conv, self.place, role, text, letter))
                self.place += 1
        for (turn, role, _), fault in zip(s.rows, faults, strict=True):
            if fault:
                self.counts[fault] += 1
            if self.before is not None and self.before + role[:1] not in LEGAL:
                self.illegal += 1
            self.before = role[:1]
            if turn is not None:
                self.lowest = turn if self.lowest is None else self.lowest
                self.different += turn != self.highest
                self.highest = turn

    def report(self) -> tuple:
        gaps = 0 if self.lowest is None else self.highest - self.lowest + 1 - self.different
        return self.conv, gaps, *self.counts.values(), self.illegal, self.cost, "".join(self.letters), self.digest.hexdigest()


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def _walks(turns: bool):
    names = [f.split()[0] for f in (TURNS if turns else REPORT).split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()] if turns else [*[pa.int64()] * 7, pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, size = None, [], 0
        for s in segments(batches):
            if now is None or now.conv != s.conv:
                if now is not None and not turns:
                    rows.append(now.report())
                    size += 100 + len(now.letters)
                now = Walk(s.conv, turns)
            now.take(s)
            if turns:
                rows += now.turns
                size += sum(100 + len(t[3]) for t in now.turns)
                now.turns.clear()
            if size > 1 << 22:
                yield _batch(rows, names, types)
                rows, size = [], 0
        if now is not None and not turns:
            rows.append(now.report())
        if rows:
            yield _batch(rows, names, types)

    return run


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for s in segments(batches):
        yield _batch([(s.conv, s.seg, matrix(s.codes()[0]))], ["conv_id", "seg", "m"], [pa.int64(), pa.int64(), pa.list_(pa.int64())])


def _tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cost-to-go at the end of every segment but the last, from matrices in backward order."""
    conv, cost = (), None
    for batch in batches:
        rows = []
        for now, seg, m in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (now,) == conv:
                rows.append((now, seg, cost))
            else:
                conv, cost = (now,), list(END)
            cost = [min(m[4 * q + end] + cost[end] for end in range(4)) for q in range(4)]
        if rows:
            yield _batch(rows, ["conv_id", "seg", "tail"], [pa.int64(), pa.int64(), pa.list_(pa.int64())])


def _notes(df: DataFrame, seen: str | None = None, tail: str | None = None) -> DataFrame:
    turn = F.col("turn") if seen else F.lit(None)
    return df.select(
        "conv_id", "seg", F.lit(0).alias("kind"), turn.cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
        (F.col(seen) if seen else F.lit(None)).cast("binary").alias("seen"), (F.col(tail) if tail else F.lit(None)).cast("array<long>").alias("tail"),
    )


def _stream(turns: DataFrame, turns_out: bool) -> DataFrame:
    """The walks of all conversations of (conv_id, turn, role, text)."""
    spark = turns.sparkSession
    ready(spark)
    scratch = Scratch(spark, "repair")
    rows = turns.withColumn("seg", _seg())
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    slim = rows.select("conv_id", "turn", "seg", _key().alias("key"), place.alias("at"))
    firsts = slim.groupBy("key").agg(F.min("at").alias("first"), F.max("at").alias("last")).filter("first < last")
    again = slim.join(scratch.save(firsts.drop("last"), "firsts"), "key").filter("at > first").select("conv_id", "turn", "seg", "key").distinct()
    again = scratch.save(again, "again")
    said = rows.select("conv_id", "seg", F.lit(1).alias("kind"), "turn", "role", "text", F.lit(None).cast("binary").alias("seen"), F.lit(None).cast("array<long>").alias("tail"))
    everything = said.unionByName(_notes(again, seen="key"))
    order = ["seg", "kind", F.asc_nulls_first("turn"), "role", "text"]
    spans = rows.groupBy("conv_id").agg(F.min("seg").alias("lo"), F.max("seg").alias("hi")).filter("lo < hi").select(F.col("conv_id").alias("long_id"))
    spans = scratch.save(spans, "long")
    if not spans.isEmpty():
        some = everything.join(spans, F.col("conv_id").eqNullSafe(F.col("long_id")), "left_semi")
        parts = some.repartition("conv_id", "seg").sortWithinPartitions("conv_id", *order).mapInArrow(_matrices, "conv_id long, seg long, m array<long>")
        tails = parts.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("seg")).mapInArrow(_tails, "conv_id long, seg long, tail array<long>")
        everything = everything.unionByName(_notes(scratch.save(tails, "tails"), tail="tail"))
    return everything.repartition("conv_id").sortWithinPartitions("conv_id", *order).mapInArrow(_walks(turns_out), TURNS if turns_out else REPORT)


def report(turns: DataFrame) -> DataFrame:
    """One row per conversation that has turns: faults, cost, letters of the edits and digest of the repaired turns."""
    return _stream(turns_of(turns), False)


def repaired(turns: DataFrame) -> DataFrame:
    """The turns of all repaired conversations in their order, with the edit that each comes from (K, R or I)."""
    return _stream(turns_of(turns), True)


def damaged_report(talks: DataFrame) -> DataFrame:
    """The report of every conversation after damage; those left without turns have zeros."""
    found = report(damage(talks)).withColumnRenamed("conv_id", "found_id")
    ids = talks.select(col("conv_id").cast("long").alias("conv_id")).distinct()
    joined = ids.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    nothing = hashlib.sha256(b"").hexdigest()
    return joined.select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
