"""Sharding by a permutation-filled lookup table."""

from __future__ import annotations

from functools import lru_cache
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelab.llm.common import text_key

#: Slots of the table, a prime; with at least a hundred slots per shard the shards differ by less than one in a hundred.
SLOTS = 65_537
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


@lru_cache(maxsize=8)
def lookup_table(shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> tuple[int, ...]:
    """The shard number of every slot.

    A shard's order of preference is a permutation of the slots: an offset and a step, both hashed from its name; the
    prime size makes every step a full cycle.  Shards take turns, and each claims the first slot of its order that is
    still free.  The table depends on names, their order and the size alone.
    """
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards must be different names, no more than slots")
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be a prime")
    number = [int.from_bytes(md5(name.encode()).digest(), "big") for name in shards]
    at = [n % slots for n in number]
    step = [(n >> 64) % (slots - 1) + 1 for n in number]
    table = [-1] * slots
    claimed = 0
    while True:
        for shard in range(len(shards)):
            while table[at[shard]] >= 0:
                at[shard] = (at[shard] + step[shard]) % slots
            table[at[shard]] = shard
            claimed += 1
            if claimed == slots:
                return tuple(table)


def table_frame(spark: SparkSession, shards: tuple[str, ...], slots: int) -> DataFrame:
    """(slot, shard): one row per slot, ``slots`` in all."""
    numbers = F.lit(",".join(map(str, lookup_table(shards, slots))))
    rows = spark.range(1).select(F.posexplode(F.split(numbers, ",")).alias("slot", "number"))
    names = F.split(F.lit("\n".join(shards)), "\n")
    return rows.select(F.col("slot").cast("long"), F.get(names, F.col("number").cast("int")).alias("shard"))


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(text_key(F.coalesce(key.cast("string"), F.lit(""))), F.lit(slots)).cast("long")


def shard(rows: DataFrame, key: str, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``rows`` in a struct ``row``, with ``slot`` and ``shard`` of their key.

    A key's slot is its hash modulo the table size; the table, ``slots`` rows whatever the input, is broadcast.  Rows are
    not moved, so a key that many rows share costs no more than others.  Rows without key are placed as the empty
    key; rows that repeat a key share its shard; clashing column names stay inside the struct.  An empty table gives
    an empty one.  When a shard goes, nearly all keys of the others stay where they are.
    """
    placed = rows.select(F.struct(*rows.columns).alias("row"), slot_of(F.col(key), slots).alias("slot"))
    return placed.join(F.broadcast(table_frame(rows.sparkSession, shards, slots)), "slot").select("row", "slot", "shard")


def write_shards(rows: DataFrame, key: str, path: str, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> None:
    """Write every shard to its folder ``shard=...``; large shards are written by several tasks."""
    placed = shard(rows, key, shards, slots).select(F.struct("shard").alias("place"), "row")
    taken = [c for c in rows.columns if c.lower() != "shard"]
    placed = placed.select(*[F.col(f"row.`{c}`") for c in taken], F.col("place.shard").alias("shard"))
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
