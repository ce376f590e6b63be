"""Prefix trie of conversations, peeled from its deepest turns upwards.

A node of the trie is a distinct sequence of first turns. It is found by truncation: from
the greatest depth down, the conversations that end at a depth are merged with the nodes
that survive there, their sums are complete and the nodes are given out; then the last
turn is stripped and what is left is grouped again. Nodes and sums come from one pass, and
no conversation is spread out into all its prefixes.

A turn is a token of 20 bytes, a digest of role and text and the text's length, made where
the turn is read: texts are never shuffled. Conversations with the same turns are counted
first. The distinct sequences are then range-partitioned, so that a task has a stretch of
them in order, whatever their prefixes have in common; it peels ``RANGE`` of them at a
time. All nodes but those on the way to the first or last sequence of a range lie within
it and are complete. Of these two ways the sums so far go on, as two rows, to the next
round, where the ways are sequences themselves; each round divides their number by
thousands, and the last has ``LAST`` rows at most. A hot first turn is thus no hot key.

The digest of the conversations that end at a node is one chain over all their ids; they
are sorted by ranges, joined into chunks of text there, and only the chunks of a node meet
in one task, which reads them one after the other.

Turns are taken in their order, a null one first, ties by role and digest; a null role or
text is empty. Rows without a conversation id belong to none and are left out. Repeated
rows are turns like others. Long texts weigh no more than short ones; work and memory
within a range go with the square of the longest conversation's turns. Extra columns are
ignored, whatever their names. Without any conversation there is no root and no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ratewise.session import durable

#: Bytes of a turn: of its digest, and of the number of characters of its text.
DIGEST, LENGTH = 16, 4
WIDTH = DIGEST + LENGTH
#: Sequences peeled at a time and about how many bytes of them, rows that one last task
#: may close, rows of a batch that leaves, ids of one chunk of text.
RANGE, RANGE_BYTES = 10_000, 1 << 24
LAST = 4_096
BATCH = 8_192
CHUNK = 10_000

#: Sums of a node so far: conversations through it and their least id, children, leaves
#: and saved tokens below it, conversations that end at it and their least id.
SUMS = "convs bigint, conv_id bigint, children bigint, leaves bigint, saved bigint, ends bigint, end_id bigint"
#: Rows of a round: complete nodes, or a way (``path``, sums of nodes on it by depth).
PEELED = (
    "key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
    f"n_children long, n_leaves long, saved_tokens long, ends long, end_id long, path binary, "
    f"parts array<struct<depth: int, {SUMS.replace(' ', ': ').replace(',:', ',')}>>"
)
EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()


def turn_token(role: Column, text: Column) -> Column:
    """A turn as 40 hex digits: digest of role and text, and the text's code points."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    size = F.lpad(F.hex(F.length(text)), 2 * LENGTH, "0")
    return F.concat(F.substring(F.sha2(whole, 256), 1, 2 * DIGEST), size)


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the tokens of each conversation of ``turns`` (conv_id, turn, role, text)."""
    role = F.coalesce("role", F.lit("")).alias("role")
    one = F.struct("turn", role, turn_token(F.col("role"), F.col("text")).alias("token"))
    found = turns.where("conv_id IS NOT NULL").select("conv_id", one.alias("one"))
    listed = found.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("all"))
    return listed.select("conv_id", F.col("all")["token"].alias("turns"))


def path(turns: Column) -> Column:
    """Tokens as one binary path."""
    return F.unhex(F.array_join(turns, ""))


def _key(of: Column) -> Column:
    return F.substring(F.unhex(F.sha2(of, 256)), 1, DIGEST)


def _add(level: dict[bytes, list], way: bytes, sums: list, child: int | None = None) -> None:
    node = level.get(way)
    if node is None:
        level[way] = [*sums, [] if child is None else [child]]
        return
    for i in (0, 2, 3, 4, 5):
        node[i] += sums[i]
    for i in (1, 6):
        if sums[i] is not None and (node[i] is None or sums[i] < node[i]):
            node[i] = sums[i]
    if child is not None:
        node[7].append(child)


def peel(pieces: list[tuple[bytes, list]], closing: bool) -> tuple[list[list], list[tuple[bytes, list]]]:
    """Complete nodes of a sorted stretch of paths, and the open rest as paths again.

    A piece is a path and the sums of nodes on it, (depth, sums ...). A node on the way to
    the first or last path may go on in another stretch: it stays open, unless ``closing``.
    """
    first, last = pieces[0][0], pieces[-1][0]
    ended: dict[int, dict[bytes, list]] = {}
    for way, parts in pieces:
        for depth, *sums in parts:
            _add(ended.setdefault(depth, {}), way[: depth * WIDTH], sums)
    closed: list[list] = []
    open_nodes: list[tuple[bytes, list]] = []
    level: dict[bytes, list] = {}
    for depth in range(max(ended), -1, -1):
        for way, node in ended.pop(depth, {}).items():
            _add(level, way, node[:7])
        above: dict[bytes, list] = {}
        for way, node in level.items():
            if not closing and (first.startswith(way) or last.startswith(way)):
                open_nodes.append((way, node))
                continue
            convs, conv_id, children, leaves, saved, ends, end_id, below = node
            leaves = leaves if children else 1
            saved += (convs - 1) * int.from_bytes(way[-LENGTH:])
            parent = way[:-WIDTH] if depth else None
            for row in below:
                closed[row][4] = conv_id
            closed.append([
                hashlib.sha256(way).digest()[:DIGEST],
                None if parent is None else hashlib.sha256(parent).digest()[:DIGEST],
                conv_id, depth, None, convs, children, leaves, saved, ends, end_id,
            ])
            if parent is not None:
                _add(above, parent, [convs, conv_id, 1, leaves, saved, 0, None], len(closed) - 1)
        level = above
    rest = []
    ways = [[x for x in open_nodes if first.startswith(x[0])], [x for x in open_nodes if not first.startswith(x[0])]]
    for nodes in ways:
        if nodes:
            deepest = max((way for way, _ in nodes), key=len)
            rest.append((deepest, [(len(way) // WIDTH, *node[:7]) for way, node in nodes]))
    return closed, rest


def _peeled(pieces: DataFrame, closing: bool, range_rows: int) -> DataFrame:
    """One round over sorted pieces (path, parts)."""
    kinds = StructType.fromDDL(PEELED)
    schema, names, sums = to_arrow_schema(kinds), kinds.names, kinds["parts"].dataType.elementType.names

    def rows(stretch: list[tuple[bytes, list]]) -> Iterator[pa.RecordBatch]:
        closed, rest = peel(stretch, closing)
        for i in range(0, len(closed), BATCH):
            out = [dict(zip(names, row)) for row in closed[i : i + BATCH]]
            yield pa.RecordBatch.from_pylist(out, schema)
        out = [{"path": way, "parts": [dict(zip(sums, p, strict=True)) for p in nodes]} for way, nodes in rest]
        yield pa.RecordBatch.from_pylist(out, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretch: list[tuple[bytes, list]] = []
        size = 0
        for batch in batches:
            for way, nodes in zip(batch.column("path").to_pylist(), batch.column("parts").to_pylist(), strict=True):
                stretch.append((way, [tuple(node.values()) for node in nodes]))
                size += len(way)
                # of many paths two go on, so every round has far fewer rows
                full = len(stretch) >= range_rows or (size >= RANGE_BYTES and len(stretch) >= 16)
                if full and not closing:
                    yield from rows(stretch)
                    stretch, size = [], 0
        if stretch:
            yield from rows(stretch)

    return pieces.select("path", "parts").mapInArrow(run, kinds)


def _several_ends(paths: DataFrame, distinct: DataFrame) -> DataFrame:
    """(key, digest) of the ids of paths on which several conversations end."""
    several = distinct.where("convs > 1").select(_key(F.col("path")).alias("key"))
    ids = paths.select(_key(F.col("path")).alias("key"), "conv_id").join(several, "key", "left_semi")
    ids = durable(ids, "ends")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []

        def chunk() -> pa.RecordBatch:
            text = ",".join(map(str, ids))
            return pa.RecordBatch.from_arrays(
                [pa.array([key]), pa.array([ids[0]]), pa.array([text])], ["key", "first", "ids"]
            )

        for batch in batches:
            for next_key, conv_id in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if ids and (next_key != key or len(ids) == CHUNK):
                    yield chunk()
                    ids = []
                key = next_key
                ids.append(conv_id)
        if ids:
            yield chunk()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, chain = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key]), pa.array([chain.hexdigest()])], ["key", "digest"])

        for batch in batches:
            for next_key, text in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if next_key == key:
                    chain.update(b",")
                else:
                    if chain:
                        yield row()
                    key, chain = next_key, hashlib.sha256()
                chain.update(text.encode())
        if chain:
            yield row()

    order = ids.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    chunks = order.mapInArrow(joined, "key binary, first long, ids string")
    return chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digests, "key binary, digest string")


def prefix_trie(paths: DataFrame, range_rows: int = RANGE, last: int = LAST) -> DataFrame:
    """A row per node of the trie of ``paths`` (conv_id, path), each id once.

    conv_id: least member; depth; parent_conv_id: that of its parent; n_convs: members;
    n_children; n_leaves: nodes without children in its subtree; saved_tokens: over its
    subtree the characters of last texts that members but one repeat; ends_sha256: digest
    of the ids, ascending, that end there. ``range_rows`` and ``last`` (three at least)
    say how the work is dealt out and change no result.
    """
    counted = paths.groupBy("path").agg(F.count(F.lit(1)).alias("convs"), F.min("conv_id").alias("conv_id"))
    distinct = durable(counted, "sequences")
    zero = F.lit(0).cast("long")
    part = F.struct(
        F.floor(F.length("path") / WIDTH).cast("int").alias("depth"), "convs", "conv_id",
        zero.alias("children"), zero.alias("leaves"), zero.alias("saved"),
        F.col("convs").alias("ends"), F.col("conv_id").alias("end_id"),
    )
    pieces = distinct.select("path", F.array(part).alias("parts"))
    rounds: list[DataFrame] = []
    closing = False
    while not closing:
        count = pieces.count()
        closing = count <= last
        if closing:
            ranges = pieces.repartition(1)
        elif not rounds:
            ranges = pieces.repartitionByRange("path")
        else:  # in fewer tasks than that, each with many rows, of which two go on
            ranges = pieces.repartitionByRange(max(count // range_rows, 1), "path")
        peeled = durable(_peeled(ranges.sortWithinPartitions("path"), closing, range_rows), "peeled")
        rounds.append(peeled.where("parts IS NULL").drop("parts", "path"))
        pieces = peeled.where("parts IS NOT NULL").select("path", "parts")
    nodes = rounds[0]
    if len(rounds) > 1:
        # only a node that stayed open once has children whose rows left before its own
        later = rounds[1]
        for more in rounds[2:]:
            later = later.unionAll(more)
        nodes = nodes.unionAll(later)
        waits = "depth > 0 AND parent_conv_id IS NULL"
        parents = later.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent"))
        waiting = nodes.where(waits).join(parents, "parent_key").withColumn("parent_conv_id", F.col("parent"))
        nodes = nodes.where(f"NOT ({waits})").unionByName(waiting.drop("parent"))
    several = _several_ends(paths, distinct)
    digest = F.when(F.col("ends") == 0, F.lit(EMPTY_DIGEST)).when(
        F.col("ends") == 1, F.sha2(F.col("end_id").cast("string"), 256)
    ).otherwise(F.col("digest"))
    return nodes.join(several, "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        digest.alias("ends_sha256"),
    )
