"""Sharding by a permutation-filled lookup table.

Each shard has a preference order of the slots of a prime-sized table: an offset and
a step, both hashed from its name. The shards take turns; each claims the next slot
of its order that is still free, until all are taken. Shards differ by one slot at
most, and when a shard goes, most slots keep theirs. Placing a key is one hash and
one look at the table, which is small by its parameter and broadcast.

The key's text form is hashed, so equal keys meet in one shard. Rows without any key,
of which there may be very many, are placed by the text of all their columns instead, so
that they spread like others. Repeated rows are kept and share a shard, as do null and
empty texts of rows that differ in nothing else; very long texts are hashed whole. A key
held by many rows can be spread by naming more columns as its key. Empty tables give no
rows; all columns are kept, whatever their names, and placing columns are added under
the names given.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A prime, a hundred times the shards or more for an even share (fixed value).
TABLE_SIZE = 65_537


def _number(text: str, salt: str) -> int:
    return int(hashlib.md5(f"{salt}:{text}".encode()).hexdigest()[:15], 16)


def filled_table(shards: list[str], size: int = TABLE_SIZE) -> list[int]:
    """The number of the shard that holds each slot."""
    if not shards or len(set(shards)) < len(shards) or size < len(shards):
        raise ValueError("give distinct shards, no more than there are slots")
    offset = [_number(name, "offset") % size for name in shards]
    step = [_number(name, "step") % (size - 1) + 1 for name in shards]
    slots, free = [-1] * size, size
    while free:
        for shard in range(len(shards)):
            while slots[offset[shard]] >= 0:
                offset[shard] = (offset[shard] + step[shard]) % size
            slots[offset[shard]] = shard
            free -= 1
            if not free:
                break
    return slots


def _digest(columns: Sequence[Column]) -> Column:
    texts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("\x1f", *texts))


def slot_of(*keys: Column, size: int = TABLE_SIZE, content: Sequence[Column] = ()) -> Column:
    """The slot of a row by 60 bits of the MD5 of its keys as text; of ``content`` as text
    where all keys are null."""
    digest = _digest(keys)
    if content:
        absent = reduce(Column.__and__, [k.isNull() for k in keys])
        digest = F.when(absent, _digest(content)).otherwise(digest)
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(size))


def placed(
    rows: DataFrame, keys: list[str], shards: list[str], size: int = TABLE_SIZE,
    slot: str = "slot", shard: str = "shard",
) -> DataFrame:
    """All rows with the ``slot`` and the name of the ``shard`` that they belong to.

    Nothing is shuffled: the table has ``size`` rows and is broadcast.
    """
    spark = rows.sparkSession
    names = F.array(*[F.lit(name) for name in shards])
    numbers = F.from_json(F.lit(str(filled_table(shards, size))), "array<int>")
    lookup = spark.range(1).select(F.posexplode(numbers).alias("table_slot", "number"))
    lookup = lookup.select(
        F.col("table_slot").cast("long").alias("table_slot"),
        F.element_at(names, F.col("number") + 1).alias("table_shard"),
    )
    kept = [rows[f"`{c}`"] for c in rows.columns]
    at = slot_of(*[rows[f"`{k}`"] for k in keys], size=size, content=kept)
    return rows.join(F.broadcast(lookup), at == lookup["table_slot"]).select(
        *kept, lookup["table_slot"].alias(slot), lookup["table_shard"].alias(shard)
    )


def write_shards(rows: DataFrame, path: str, shard: str = "shard") -> None:
    """One folder for each shard, of files of a sensible size.

    One shuffle brings the rows of a shard together: without it every task would write a
    small file into every folder. It splits shards that are larger than others.
    """
    rows.hint("rebalance", shard).write.partitionBy(shard).parquet(path)


def read_shards(spark: SparkSession, path: str, rows: DataFrame, shard: str = "shard") -> DataFrame:
    """The rows of all shards, with the columns of the ``rows`` that were written; shard
    names come back as text. A filter on the shard opens its folder only."""
    return spark.read.schema(rows.schema).parquet(path).select(*[f"`{c}`" for c in rows.columns])
