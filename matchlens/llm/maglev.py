"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size. Shards take turns,
each claiming the first free slot of its order, until the table is full. A key hashes to a slot, and the slot
names the shard. Shares differ by at most one turn, and when a shard leaves, few keys of the others move.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_SIZE = 65_537
SHARDS = tuple(f"shard-{i:03d}" for i in range(128))


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_table(shards: Sequence[str], size: int = TABLE_SIZE, weights: Mapping[str, int] | None = None) -> np.ndarray:
    """Index of the owning shard for every slot.

    A shard of weight w claims w slots in each round. Names must be distinct and no more than slots. The
    result does not depend on the order of ``shards``, because turns go by name.
    """
    if not _is_prime(size):
        raise ValueError("the table size must be prime, so that every step visits all slots")
    if not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("shards must be distinct, at least one and at most as many as slots")
    turns = sorted(range(len(shards)), key=lambda i: shards[i])
    place = {i: xxhash.xxh64_intdigest(shards[i], seed=1) % size for i in turns}
    step = {i: xxhash.xxh64_intdigest(shards[i], seed=2) % (size - 1) + 1 if size > 2 else 1 for i in turns}
    owner = np.full(size, -1, dtype=np.int32)
    free = size
    while True:
        for i in turns:
            for _ in range((weights or {}).get(shards[i], 1)):
                slot = place[i]
                while owner[slot] >= 0:
                    slot = (slot + step[i]) % size
                owner[slot] = i
                place[i] = (slot + step[i]) % size
                free -= 1
                if not free:
                    return owner


def lookup_frame(spark: SparkSession, shards: Sequence[str], size: int, weights: Mapping[str, int] | None) -> DataFrame:
    """The table as rows (slot, shard): ``size`` rows, whatever the data."""
    owner = fill_table(shards, size, weights)
    rows = pd.DataFrame({"slot": np.arange(size, dtype=np.int32), "shard": np.asarray(shards, dtype=object)[owner]})
    return spark.createDataFrame(rows, "slot int, shard string")


def place(
    df: DataFrame,
    key: str,
    shards: Sequence[str] = SHARDS,
    size: int = TABLE_SIZE,
    weights: Mapping[str, int] | None = None,
) -> DataFrame:
    """``df`` with the columns ``slot`` and ``shard``; columns of those names are replaced.

    The lookup table is broadcast: it has ``size`` rows (a parameter, under 2 MB by default), so a row is placed
    in constant time without a shuffle. Keys are compared as text and a null key counts as empty text. Equal
    keys always meet in one shard. An empty table gives an empty result.
    """
    table = lookup_frame(df.sparkSession, shards, size, weights)
    hashed = F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")))
    slotted = df.drop("shard").withColumn("slot", F.pmod(hashed, F.lit(size)).cast("int"))
    return slotted.join(F.broadcast(table), "slot").select(*slotted.columns, "shard")


def write_shards(placed: DataFrame, path: str, writers: int = 4) -> None:
    """Write one folder per shard; ``writers`` tasks share a shard, so no task holds a whole one."""
    salt = F.pmod(F.xxhash64(*placed.columns), F.lit(writers))
    placed.repartition("shard", salt).write.partitionBy("shard").parquet(path)
