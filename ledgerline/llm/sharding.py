"""Sharding by a lookup table that the shards fill in turns.

Every shard walks the slots of a prime-sized table in an order of its own (offset and skip
from hashes of its name) and, turn by turn, claims the next slot that is still free. The
table is a few thousand times smaller than any corpus and its size is fixed by a parameter,
so it is broadcast; a row's place is one hash and one lookup, without a shuffle. Adding or
removing a shard moves little more than that shard's share of the slots.

Defined cases: a null key has a slot like any other value; equal keys share a shard; an
empty input gives an empty result; a table smaller than the number of shards, or one whose
size isn't prime, is refused.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: slots of the table, prime: about a thousand for each of 64 shards, so shares differ by under 0.2 %
SLOTS = 65_537
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))
#: the table may be broadcast up to this size; 16 bytes a slot
MAX_SLOTS = 4_000_037


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big")


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """For every slot the position of its shard; the shards claim slots in turns."""
    if len(set(shards)) != len(shards) or not shards:
        raise ValueError("shards need distinct names")
    if not is_prime(slots) or not len(shards) <= slots <= MAX_SLOTS:
        raise ValueError(f"slots must be a prime from {len(shards)} to {MAX_SLOTS}")
    offset = [_number(s, "offset") % slots for s in shards]
    skip = [_number(s, "skip") % (slots - 1) + 1 for s in shards]
    taken, at, table, filled = [False] * slots, list(offset), [-1] * slots, 0
    order = sorted(range(len(shards)), key=lambda i: shards[i])  # the order of the names, not of the argument
    while True:
        for i in order:
            while taken[at[i]]:
                at[i] = (at[i] + skip[i]) % slots
            taken[at[i]], table[at[i]] = True, i
            filled += 1
            if filled == slots:
                return table


def table_frame(spark: SparkSession, shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    rows = [(slot, i, shards[i]) for slot, i in enumerate(lookup_table(shards, slots))]
    return spark.createDataFrame(rows, "shard_slot int, shard_no int, shard string")


def with_shard(df: DataFrame, key: str, shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``df`` with ``shard_slot``, ``shard_no`` and ``shard``; columns of these names are replaced."""
    table = table_frame(df.sparkSession, shards, slots)
    plain = df.drop("shard_slot", "shard_no", "shard")
    placed = plain.withColumn("shard_slot", F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(slots)).cast("int"))
    return placed.join(F.broadcast(table), "shard_slot").select(*plain.columns, "shard_slot", "shard_no", "shard")
