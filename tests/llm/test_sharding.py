import hashlib
from collections import Counter

import pytest

from ratewise.llm import sharding

SHARDS = [f"s{i}" for i in range(7)]


def test_fill_by_hand():
    """Against preference lists written out in full."""
    size = 31
    prefer = []
    for name in SHARDS:
        offset, step = (int(hashlib.md5(f"{salt}:{name}".encode()).hexdigest()[:15], 16) for salt in ("offset", "step"))
        prefer.append([(offset + j * (step % (size - 1) + 1)) % size for j in range(size)])
    assert all(sorted(p) == list(range(size)) for p in prefer)
    table, turn = {}, 0
    while len(table) < size:
        shard = turn % len(SHARDS)
        table[next(s for s in prefer[shard] if s not in table)] = shard
        turn += 1
    assert sharding.filled_table(SHARDS, size) == [table[i] for i in range(size)]


def test_even_and_stable():
    table = sharding.filled_table(SHARDS, 4099)
    counts = Counter(table)
    assert max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.filled_table(SHARDS[:-1], 4099)
    moved = sum(a != b for a, b in zip(table, fewer) if a != len(SHARDS) - 1)
    assert moved < 4099 * 0.12
    for bad in ([], ["a", "a"], SHARDS):
        with pytest.raises(ValueError):
            sharding.filled_table(bad, 5)


def test_placing(spark, tmp_path):
    rows = [(i % 40, "t", "x", 1) for i in range(100)] + [(None, None, "y", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, slot string, table_slot int")
    found = sharding.placed(df, ["doc_id"], SHARDS, 4099, slot="place")
    assert found.columns == [*df.columns, "place", "shard"] and found.count() == 101
    table = sharding.filled_table(SHARDS, 4099)
    for r in found.collect():
        text = "\x1fy\x1f2".join(["\x1f", ""]) if r["doc_id"] is None else str(r["doc_id"])
        slot = int(hashlib.md5(text.encode()).hexdigest()[:15], 16) % 4099
        assert (r["place"], r["shard"]) == (slot, SHARDS[table[slot]])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Python" not in plan
    path = str(tmp_path / "shards")
    sharding.write_shards(found, path)
    assert spark.read.parquet(path).count() == 101
    assert sharding.placed(df.limit(0), ["doc_id"], SHARDS, 4099, slot="place").count() == 0
    spread = sharding.placed(df, ["doc_id", "slot"], SHARDS, 4099, slot="place")
    assert spread.count() == 101


def test_rows_without_a_key_spread_by_their_content(spark, tmp_path):
    """A third of the rows has no key; shards stay even, and rows come back whole."""
    rows = [(None if i % 3 == 0 else i, f"text {i}", "é" * (i % 5)) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    placed = sharding.placed(df, ["doc_id"], SHARDS, 4099)
    counts = [r["count"] for r in placed.groupBy("shard").count().collect()]
    assert len(counts) == len(SHARDS) and max(counts) < 1.2 * min(counts)
    path = str(tmp_path / "shards")
    sharding.write_shards(placed, path)
    again = sharding.read_shards(spark, path, placed)
    assert again.columns == placed.columns
    assert again.exceptAll(placed).count() == 0 and placed.exceptAll(again).count() == 0
    plan = again.where("shard = 's3'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard" in plan
