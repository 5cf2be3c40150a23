"""Sharding by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a prime-sized table (an offset
and a stride taken from a digest of its name). The shards take turns, and at its turn a
shard claims the first slot of its order that is still free, until the table is full. Shards
hold equally many slots, give or take one, and when a shard leaves or joins, nearly all
slots of the others stay. A row's slot is a digest of its key modulo the table's size, so
placing it takes one look into the table, which every task has: the table's size is a
parameter, and a table above ``MAX_SLOTS`` is refused, so its broadcast is bounded.

Key: the document id; rows without one go by their text (null: empty), so they do not
gather in one slot. Repeated rows share a shard. Empty tables give empty results. Where the
input has columns named like the added ones, those are added under the next free name, with
underscores in front. Placement depends on the row alone: a hot source or group of copies does not skew
shards, and a task that runs again places its rows alike.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indistar.llm.common import free_name

SHARDS = 32
#: Prime, and over a hundred times the shards, which keeps shares within one percent.
SLOTS = 4099
MAX_SLOTS = 1_000_003
DIGEST_HEX = 15


def _digest(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:DIGEST_HEX], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def shard_names(shards: int) -> list[str]:
    return [f"shard-{i}" for i in range(shards)]


def lookup_table(names: list[str], slots: int = SLOTS) -> list[int]:
    """For every slot the index of its shard."""
    if not names or len(set(names)) != len(names):
        raise ValueError("shard names must be distinct, and at least one")
    if not is_prime(slots) or not len(names) <= slots <= MAX_SLOTS:
        raise ValueError(f"slots must be a prime from the number of shards to {MAX_SLOTS}")
    offset = [_digest(f"{n}/offset") % slots for n in names]
    stride = [_digest(f"{n}/stride") % (slots - 1) + 1 for n in names]
    at = [0] * len(names)
    table, free = [-1] * slots, slots
    while free:
        for i in range(len(names)):
            if not free:
                break
            while table[slot := (offset[i] + at[i] * stride[i]) % slots] >= 0:
                at[i] += 1
            table[slot] = i
            free -= 1
    return table


def table_frame(spark: SparkSession, table: list[int]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(table)), "slot long, shard int")


def slot_of(key: Column, slots: int) -> Column:
    digest = F.conv(F.substring(F.md5(key.cast("binary")), 1, DIGEST_HEX), 16, 10).cast("long")
    return F.pmod(digest, F.lit(slots).cast("long"))


def assign(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS,
           slot_col: str = "slot", shard_col: str = "shard") -> DataFrame:
    """``docs`` with the slot (long) and the shard (int) of every row appended."""
    slot_col, shard_col = free_name(docs, slot_col), free_name(docs, shard_col)
    key = F.coalesce(F.col("doc_id").cast("string"),
                     F.concat(F.lit("text:"), F.coalesce(F.col("text").cast("string"), F.lit(""))))
    table = table_frame(docs.sparkSession, lookup_table(shard_names(shards), slots)).select(
        F.col("slot").alias(slot_col), F.col("shard").alias(shard_col))
    placed = docs.withColumn(slot_col, slot_of(key, slots)).join(F.broadcast(table), slot_col)
    return placed.select(*docs.columns, slot_col, shard_col)


def write_shards(assigned: DataFrame, path: str, shard_col: str = "shard") -> None:
    """Write one folder per shard. Tasks write their rows where they are, without a shuffle;
    files per shard grow with the tasks, so repartition by shard and a salt beforehand if
    there are very many tasks."""
    assigned.write.partitionBy(shard_col).parquet(path)
