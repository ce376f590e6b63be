"""The prefix trie against a plain trie of all prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ratewise.llm import conversation_trie as trie
from ratewise.llm import queries
from tests import compare

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def plain_sequences(rows):
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            turns[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts, key=lambda t: t[:3])] for c, ts in turns.items()}


def plain_rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def plain_nodes(sequences):
    """The contract's rows by a plain look at every prefix."""
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    rows = []
    for node, convs in members.items():
        below = [other for other in members if other[: len(node)] == node]
        saved = sum((len(members[o]) - 1) * len(o[-1][1]) for o in below if o)
        digest = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        leaves = sum(not children[o] for o in below)
        rows.append((min(convs), len(node), parent, len(convs), len(children[node]), leaves, saved, digest))
    return sorted(rows, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def invented(seed, conversations, deepest, words):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        for turn in range(rng.randint(0, deepest)):
            rows.append((c, turn, "user" if turn % 2 else None, rng.choice(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("range_rows, last", [(16, 3), (64, 40), (10_000, 4_096)])
def test_equal_to_plain_trie(spark, range_rows, last):
    rows = invented(1, 150, 7, ["", "a", "é😀"]) + [(900, t, "user", "long") for t in range(60)]
    rows += [(901, t, "user", "long") for t in range(40)]
    turns = spark.createDataFrame(rows, SCHEMA)
    paths = trie.sequences(turns).select("conv_id", trie.path(F.col("turns")).alias("path"))
    assert rows_of(trie.prefix_trie(paths, range_rows, last)) == plain_nodes(plain_sequences(rows))


def test_query_equals_plain_trie(spark, tmp_path):
    rows = invented(2, 330, 8, ["x", "y"])
    rows += [(1000 + i, 0, "user", "x") for i in range(250) if i % 100]  # no first of its hundred
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    own = plain_sequences(rows)
    assert rows_of(queries.op12_prefix_trie(spark, str(tmp_path))) == plain_nodes(plain_rebuilt(own))


def test_query_equals_its_sql_with_odd_rows(spark, tmp_path):
    rows = [(1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "user", "b"),
            (1, 0, "assistant", "z"), (2, 1, "user", "w " * 60_000), (None, 0, "user", "lost"),
            (100, 0, "", ""), (101, 5, None, None), (103, 1, "user", "a")]
    table = spark.createDataFrame([(*r, 7, "n") for r in rows], f"{SCHEMA}, depth int, path string")
    table.coalesce(1).write.parquet(f"{tmp_path}/parts")
    (tmp_path / "conversations.parquet").symlink_to(next((tmp_path / "parts").glob("*.parquet")))
    folder = str(tmp_path)
    assert compare.compare(spark, compare.database(folder), "op12_prefix_trie", folder) is None
    root = queries.op12_prefix_trie(spark, folder).where("depth = 0").first()
    assert (root["conv_id"], root["n_convs"], root["parent_conv_id"]) == (1, 5, None)


def test_many_conversations_of_the_same_turns(spark):
    """More ids than one chunk holds end at one node."""
    n = 2 * trie.CHUNK + 5
    paths = spark.range(n).select(F.col("id").alias("conv_id"), F.lit(b"x" * trie.WIDTH).alias("path"))
    rows = {r["depth"]: r for r in trie.prefix_trie(paths).collect()}
    want = hashlib.sha256(",".join(map(str, range(n))).encode()).hexdigest()
    assert rows[1]["ends_sha256"] == want and rows[0]["ends_sha256"] == trie.EMPTY_DIGEST
    assert rows[0]["n_leaves"] == 1 and rows[0]["n_convs"] == rows[1]["n_convs"] == n


def test_no_conversations(spark):
    assert trie.prefix_trie(spark.createDataFrame([], "conv_id long, path binary")).count() == 0
    turns = spark.createDataFrame([(None, 1, "user", "a")], SCHEMA)
    assert trie.sequences(turns).count() == 0


def test_turns_are_told_apart(spark):
    """Role and text do not run into one another."""
    rows = [(1, 0, "a", "bc"), (2, 0, "ab", "c"), (3, 0, "", "abc"), (4, 0, "1:a", "x"), (5, 0, "", "1:ax")]
    assert trie.sequences(spark.createDataFrame(rows, SCHEMA)).select("turns").distinct().count() == 5
