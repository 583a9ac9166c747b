"""Sharding by a permutation-filled lookup table.

Every shard has its own permutation of the slots of a prime-sized table, an
offset and a skip hashed from its name. The shards take turns; at its turn a
shard claims the first slot of its permutation that is still free. A key is
placed by its hash modulo the table size. When a shard is added or removed most
slots keep their shard, and the shards' slots differ by one at most.

The table has ``slots`` entries, a parameter, and is all that is broadcast. It
is filled once on the driver, as its turns are sequential; rows are placed by
SQL functions alone.

Defined cases: a null key is placed as the empty string is. Equal keys share a
shard; an empty table gives an empty one. An input column named as an output is
kept with ``_in`` appended. Shard names must be different and not null; at least one is needed.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandframe.llm._names import all_of, col, make_room, prefix

SLOTS = 4093
SHARDS = tuple(f"shard-{i:02d}" for i in range(24))


def number(text: str) -> int:
    """The first 15 hexadecimal digits of the MD5 of a text."""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill(shards: tuple[str, ...], slots: int) -> list[int]:
    """The shard number of every slot."""
    if not shards or len(set(shards)) != len(shards) or slots < len(shards):
        raise ValueError("shards must be different, one at least, and fewer than slots")
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be prime")
    at = [number(f"offset:{s}") % slots for s in shards]
    skip = [number(f"skip:{s}") % (slots - 1) + 1 for s in shards]
    table, turn = [-1] * slots, 0
    for _ in range(slots):
        while table[at[turn]] >= 0:
            at[turn] = (at[turn] + skip[turn]) % slots
        table[at[turn]] = turn
        turn = (turn + 1) % len(shards)
    return table


def slot_of(key: Column, slots: int) -> Column:
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(slots)).cast("int")


def place(docs: DataFrame, key_col: str = "doc_id", shards: tuple[str, ...] = SHARDS, slots: int = SLOTS, name: str = "shard", slot_name: str | None = None) -> DataFrame:
    """docs with the shard of every row, and with its slot if slot_name is given; no shuffle.

    Input columns named as these are kept with ``_in`` appended.
    """
    docs = make_room(docs, [name, *([slot_name] if slot_name else [])], [key_col])
    p, names = prefix(docs), docs.columns
    rows = [(i, shards[s]) for i, s in enumerate(fill(shards, slots))]
    table = docs.sparkSession.createDataFrame(rows, f"{p}slot int, {p}shard string")
    out = docs.withColumn(f"{p}at", slot_of(col(key_col), slots)).join(F.broadcast(table), F.col(f"{p}at") == F.col(f"{p}slot"), "left")
    extra = [F.col(f"{p}at").alias(slot_name)] if slot_name else []
    return out.select(*all_of(names), *extra, F.col(f"{p}shard").alias(name))


def oracle(table: str, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> str:
    """The same placement in DuckDB SQL, turn by turn."""
    names = ", ".join(f"({i}, '{s}')" for i, s in enumerate(shards))
    n = len(shards)
    return f"""
WITH RECURSIVE shards(i, name) AS (VALUES {names}),
seeds AS (SELECT i, name, ('0x' || substr(md5('offset:' || name), 1, 15))::BIGINT % {slots} AS first_slot,
                 ('0x' || substr(md5('skip:' || name), 1, 15))::BIGINT % {slots - 1} + 1 AS skip FROM shards),
wishes AS (SELECT i, list((first_slot + r.j * skip) % {slots} ORDER BY r.j) AS wish
           FROM seeds, range(0, {slots}) r(j) GROUP BY i),
turns(t, slot, taken) AS (
  SELECT -1, -1::BIGINT, list_transform(range(0, {slots}), lambda x: FALSE)
  UNION ALL
  SELECT t + 1, pick, list_transform(range(0, {slots}), lambda x: taken[x + 1] OR x = pick)
  FROM (SELECT t, taken, list_filter(wish, lambda x: NOT taken[x + 1])[1] AS pick
        FROM turns JOIN wishes ON wishes.i = (turns.t + 1) % {n} WHERE t + 1 < {slots}))
SELECT doc_id, s.slot::INTEGER AS slot, name AS shard
FROM (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {slots} AS slot FROM {table}) s
JOIN turns ON turns.slot = s.slot AND turns.t >= 0 JOIN shards ON shards.i = turns.t % {n}
"""
