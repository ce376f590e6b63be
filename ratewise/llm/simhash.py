"""SimHash near-duplicates by a self-join of a binary trie over the fingerprints.

Texts that differ in a few shingles have fingerprints that differ in a few bits.
To join all fingerprints within ``budget`` bits, their trie is walked together with
itself: a pair of nodes carries the bits in which its two prefixes differ and is
dropped as soon as these exceed the budget.

The walk is dealt out by bands: of ``budget + 1`` bands of bits, two fingerprints
within the budget agree in one at least. Each group holds the distinct fingerprints
with one value of one band and walks their trie. A group over ``GROUP_LIMIT`` is
split into parts, and each pair of its parts is a group of its own, so memory stays
bounded and no link is lost.

A group emits a spanning forest of its links, never all pairs. Exact copies share
a fingerprint and enter the join once.

Null and empty texts and texts of white space have no shingles: fingerprint zero,
linked like any other. Repeated rows are kept, each with its component. Null ids
are kept and get the component's id; a component of null ids alone has a null id.
Extra columns of the input are ignored, whatever their names. Whole texts are hashed, a
fraction of a megabyte of them at a time, so memory follows the longest. An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm import packed
from ratewise.llm.components import components
from ratewise.session import durable

SEED = 42
LANE = 64
GROUP_LIMIT = 1 << 16
FRONTIER = 1 << 18
#: Members, of groups large and small, that one call walks side by side.
BUCKET_ROWS = 1 << 13
#: Node pairs of so few fingerprint pairs are not walked further down but compared.
LEAF_PAIRS = 16


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 of each run of ``width`` words, repeats included."""
    words = text.lower().split()  # of bytes: ASCII case and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)


@dataclass(frozen=True)
class Similarity:
    """How texts are compared: fingerprints of 64 bits over shingles of ``width`` words,
    linked if they differ in ``budget`` bits at most."""

    width: int
    budget: int


CLOSE = Similarity(width=3, budget=3)


def fingerprint(hashes: np.ndarray) -> bytes:
    """The bits set in over half of the hashes; zero of none."""
    votes = np.zeros(LANE, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)]
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        # sums of 255 rows fit a byte, and adding bytes is what takes the time
        whole = len(bits) // 255 * 255
        sums = bits[:whole].reshape(-1, 255, LANE).sum(axis=1, dtype=np.uint8)
        votes += sums.sum(axis=0, dtype=np.int64)
        votes += bits[whole:].sum(axis=0, dtype=np.int64)
    return np.packbits(2 * votes > len(hashes)).tobytes()


def fingerprints(docs: DataFrame, like: Similarity = CLOSE) -> DataFrame:
    """(doc_id, fp): the SimHash of every whole text, highest bit first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in packed.text_chunks(batch.column("text")):
                found = [fingerprint(shingle_hashes(t, like.width)) for t in texts]
                ids = batch.column("doc_id").slice(start, len(texts))
                yield pa.RecordBatch.from_arrays([ids, pa.array(found, pa.binary())], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp binary")


def trie_pairs(
    left: np.ndarray,
    right: np.ndarray | None,
    budget: int,
    bits: int = LANE,
    roots: list[np.ndarray] | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted values that differ in ``budget`` of their top ``bits`` at most.

    The other bits are zero; equal values are within any budget. With ``right`` absent
    the trie is joined with itself and each pair comes once. ``roots`` are the ranges
    (from, to, other from, other to) of the tries to join, each sorted in itself;
    without it there is one trie of all values.

    A node is a range of the sorted array; frontiers of node pairs are kept on a
    stack, so memory does not grow with the number of pairs.
    """
    selfed = right is None
    right = left if selfed else right
    if not len(left) or not len(right):
        return
    ones: dict[tuple[bool, int], np.ndarray] = {}

    def split(values: np.ndarray, low: np.ndarray, high: np.ndarray, side: bool, depth: int):
        """Where the ones of the next bit begin in each range."""
        if (side, depth) not in ones:
            bit = (values >> np.uint64(LANE - 1 - depth)) & np.uint64(1)
            ones[side, depth] = np.concatenate([[0], np.cumsum(bit, dtype=np.int64)])
        count = ones[side, depth]
        return high - (count[high] - count[low])

    if roots is None:
        roots = [np.array([x]) for x in (0, len(left), 0, len(right))]
    stack = [(0, [*roots, np.zeros(len(roots[0]), np.int64)])]
    while stack:
        depth, (a, b, c, d, used) = stack.pop()
        if len(a) > FRONTIER:
            half = len(a) // 2
            stack.append((depth, [x[half:] for x in (a, b, c, d, used)]))
            stack.append((depth, [x[:half] for x in (a, b, c, d, used)]))
            continue
        pairs = (b - a) * (d - c)
        leaf = pairs <= LEAF_PAIRS if depth < bits else np.ones(len(a), bool)
        if len(a) > 1 and pairs[leaf].sum() > 8 * FRONTIER:
            half = len(a) // 2
            stack.append((depth, [x[half:] for x in (a, b, c, d, used)]))
            stack.append((depth, [x[:half] for x in (a, b, c, d, used)]))
            continue
        if leaf.any():
            each, wide = pairs[leaf], (d - c)[leaf]
            place = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            wide = np.repeat(wide, each)
            i = np.repeat(a[leaf], each) + place // wide
            j = np.repeat(c[leaf], each) + place % wide
            near = np.bitwise_count(left[i] ^ right[j]) <= budget
            if selfed:
                near &= i < j
            if near.any():
                yield i[near], j[near]
            a, b, c, d, used = (x[~leaf] for x in (a, b, c, d, used))
        if not len(a):
            continue
        m, n = split(left, a, b, False, depth), split(right, c, d, selfed is False, depth)
        children = []
        for lo, hi, other_lo, other_hi, cost in (
            (a, m, c, n, 0), (m, b, n, d, 0), (a, m, n, d, 1), (m, b, c, n, 1),
        ):
            kept = (hi > lo) & (other_hi > other_lo) & (used + cost <= budget)
            if selfed:
                kept &= lo <= other_lo  # each unordered pair of nodes once
            children.append([x[kept] for x in (lo, hi, other_lo, other_hi, used + cost)])
        stack.append((depth + 1, [np.concatenate(x) for x in zip(*children, strict=True)]))


class Forest:
    """Union-find over the numbers below ``size``; the root is the least of a tree."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        root = self.root
        while len(i):
            a, b = root[i], root[j]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                above = root[root]
                if np.array_equal(above, root):
                    break
                root[:] = above


def bucket_links(
    prints: np.ndarray, groups: np.ndarray, parts: np.ndarray, like: Similarity
) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within the groups, as row numbers of ``prints``.

    ``groups`` numbers the group of each member. ``parts`` is 0 for all of a whole group;
    in a pair of parts of a split one, 0 marks the first part and 1 the second.
    """
    order = np.lexsort((prints, parts, groups))
    value, groups, parts = prints[order], groups[order], parts[order]
    number = np.arange(groups[-1] + 1)
    begin, end = np.searchsorted(groups, number), np.searchsorted(groups, number, "right")
    ones = np.concatenate([[0], np.cumsum(parts)])
    middle = end - (ones[end] - ones[begin])
    forest = Forest(len(prints))
    for two in (False, True):
        at = np.flatnonzero((middle < end) == two)
        sides = (begin, middle, middle, end) if two else (begin, end, begin, end)
        if not len(at):
            continue
        roots = [side[at] for side in sides]
        for i, j in trie_pairs(value, value if two else None, like.budget, LANE, roots):
            forest.link(order[i], order[j])
    child = np.flatnonzero(forest.root != np.arange(len(prints)))
    return child, forest.root[child]


def links(prints: DataFrame, like: Similarity = CLOSE, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Edges (u, v) that connect all distinct ``fp`` that are alike."""
    bands = like.budget + 1
    width = LANE // 8 // bands
    banded = F.array(
        *[
            F.struct(F.lit(at).alias("at"), F.substring("fp", at + 1, width).alias("value"))
            for at in range(0, width * bands, width)
        ]
    )
    band = ["at", "value"]
    keyed = prints.select("fp", F.inline(banded))
    sizes = keyed.groupBy(*band).agg(F.count(F.lit(1)).alias("members"))
    peopled = durable(sizes.where("members > 1"), "bands")
    members = peopled.agg(F.sum("members")).first()[0] or 0
    buckets = 1 + members // BUCKET_ROWS
    placed = keyed.join(
        peopled.withColumn("parts", F.ceil(F.col("members") * 2 / group_limit))
        .withColumn("parts", F.when(F.col("members") > group_limit, F.col("parts")).otherwise(1)),
        band,
    ).withColumn("home", F.pmod(F.xxhash64("fp"), F.col("parts")))
    #: A member of a split group goes to each pair of parts that its own part is in.
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda p: F.struct(
            F.least("home", p).alias("first"),
            F.greatest("home", p).alias("second"),
            (F.col("home") > p).cast("int").alias("part"),
        ),
    )
    group = F.struct(*band, "first", "second")
    dealt = placed.select("fp", *band, F.inline(pairs)).select(
        "fp", "part", F.xxhash64(group).alias("group"),
        F.pmod(F.xxhash64(group, F.lit(1)), F.lit(buckets)).alias("bucket"),
    )

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        u, v = bucket_links(
            np.frombuffer(b"".join(rows["fp"]), ">u8").astype(np.uint64),
            np.unique(rows["group"].to_numpy(), return_inverse=True)[1],
            rows["part"].to_numpy(),
            like,
        )
        fp = rows["fp"].to_numpy()
        return pd.DataFrame({"u": fp[u], "v": fp[v]})

    return dealt.groupBy("bucket").applyInPandas(run, "u binary, v binary")


def named(prints: DataFrame, like: Similarity) -> DataFrame:
    """(fp, root, component_id) of each distinct fingerprint of (doc_id, fp) rows.

    ``root`` is the least fingerprint of its component, ``component_id`` the least id.
    """
    distinct = durable(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fp")
    joined = components(links(distinct.select("fp"), like))
    rooted = distinct.join(joined, distinct["fp"] == joined["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(smallest, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, like: Similarity = CLOSE) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``."""
    prints = durable(fingerprints(docs, like), "fingerprints")
    return prints.join(named(prints, like), "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, like: Similarity = CLOSE) -> DataFrame:
    """The rows of ``docs``, all columns, without near copies of a row that stays.

    Of each component the row with the least id stays. Rows whose id is null or not
    unique are judged row by row: of those in one component that are no copies of a
    row with a lesser id, the one with the least hash of its content stays.
    """
    prints = durable(fingerprints(docs, like), "fingerprints")
    names = durable(named(prints, like), "components")
    ids = (
        prints.join(names, "fp")
        .where(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("left_id"))
        .agg(F.count(F.lit(1)).alias("rows"), F.max("component_id").alias("to"))
    )
    left = durable(ids.where((F.col("rows") > 1) | (F.col("to") != F.col("left_id"))), "left-out")
    key = docs["doc_id"]
    plain = docs.where(key.isNotNull()).join(left, key == left["left_id"], "left_anti")
    repeated = left.where("rows > 1").select("left_id")
    if repeated.isEmpty() and prints.where("doc_id IS NULL").isEmpty():
        return plain
    odd = docs.where(key.isNotNull()).join(repeated, key == repeated["left_id"], "left_semi")
    odd = odd.unionAll(docs.where(key.isNull()))

    @F.pandas_udf("binary")
    def print_of(texts: pd.Series) -> pd.Series:
        whole = texts.fillna("").map(str.encode)
        return whole.map(lambda t: fingerprint(shingle_hashes(t, like.width)))

    content = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = odd.select(
        content.alias("row"), F.col("doc_id").alias("own_id"), print_of("text").alias("own_fp")
    )
    single = (
        rows.join(names, rows["own_fp"] == names["fp"])
        .where(F.coalesce("component_id", "own_id").eqNullSafe(F.col("own_id")))
        .groupBy("root")
        .agg(F.min_by("row", F.xxhash64("row")).alias("row"))
        .select("row.*")
    )
    return plain.unionAll(single)
