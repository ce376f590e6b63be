"""Language-model scores by a hierarchical Pitman-Yor process.

Words are dishes. Each word has a restaurant of the words that follow it, whose customers
are the tokens learned from; the end of a text comes before its first word. The parent of
all these is one restaurant of words, whose customers are their tables. A new table there
is laid by the spelling model: the word's bytes, each drawn in the
restaurant of the three bytes before it, whose parent is that of the two bytes before,
and so on to the empty context, whose parent is uniform. Contexts that end alike share
parents, and a table of a child is a customer of its parent. Of the second and third
byte back only some bits tell contexts apart, which bounds their number.

Seating is sampled by Gibbs sweeps. Given the rest, the number of tables of a dish
with ``c`` customers is drawn from its exact conditional: generalised Stirling number
times the weight of that many new tables. Beyond ``EXACT`` customers of a dish the
others come in doubling batches. Within a sweep, dishes see the tables of the other
dishes as of the sweep's start, so a sweep is one pass over the vocabulary on Spark.
After ``BURN_IN`` sweeps, the predictive probabilities of ``SAMPLES`` sweeps are
averaged. Draws are hashes of the sweep and the dish: a repeated task draws alike.

What grows stays on Spark: token counts, vocabulary, word pairs, the seating of pairs and
words, and the joins that bring their state back to the texts. A pair met once has one
table for certain, so only pairs met again are sampled. There are 2^19 byte
restaurants at most whatever the corpus; they are sampled on the driver.

Null and empty texts are one end token. Null ids are learned from. Repeated rows
count and are scored as often as they occur. Extra columns of the input are ignored.
With no text to learn from all probabilities come from the uniform spelling. An
empty table gives no rows. Very long texts are taken whole, a chunk of their own, so
memory follows the longest; columns of other names are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm import packed
from ratewise.session import discard, discard_partition, durable, forget_shuffles

#: Bytes of text whose words share a dictionary.
CHUNK = 10_000_000
EXACT = 48
#: Customers of a dish up to which the weights of its tables are multiplied as they are.
FEW = 8
BURN_IN, SAMPLES = 2, 4
#: Discount and concentration of the word restaurant, and of the byte restaurants by
#: the length of their contexts.
WORDS = (0.8, 10.0)
#: The same of the restaurants of following words.
PAIRS = (0.8, 2.0)
#: Tokens for each bucket of word pairs.
BUCKET_TOKENS = 500_000
#: Bytes of text for each part of the vocabulary.
PART_BYTES = 16_000_000
BYTES = ((0.2, 1.0), (0.3, 1.0), (0.5, 1.0), (0.6, 1.0))
#: Bits of the context code by its length: all of the last byte, 6 of the one before
#: it, 5 of the third. A parent's code is the lower bits of its child's.
CODE_BITS = (0, 8, 14, 19)
PART_SCHEMA = (
    "chunk long, lid int, word binary, learned long, h long, "
    "hs binary, ids binary, known_ids binary, held binary, sizes binary, lids binary"
)
#: The same with the words of a chunk packed, a row for each part of the vocabulary.
PACKED_SCHEMA = f"{PART_SCHEMA}, part long, lengths binary"


def _planes(values: np.ndarray) -> bytes:
    """How many low bytes the values need, then these byte by byte: high ones compress well."""
    flat = np.ascontiguousarray(values)
    width = flat.itemsize
    if flat.dtype.kind in "iu" and len(flat) and flat.min() >= 0:
        width = max(1, (int(flat.max()).bit_length() + 7) // 8)
    planes = flat.view(np.uint8).reshape(len(flat), flat.itemsize)[:, :width].T
    return bytes([width]) + planes.tobytes()


def _from_planes(data: bytes, at: int, count: int, kind: np.dtype) -> tuple[np.ndarray, int]:
    """The values, and where what follows them begins."""
    width, out = data[at], np.zeros((count, kind.itemsize), np.uint8)
    end = at + 1 + count * width
    out[:, :width] = np.frombuffer(data, np.uint8, end - at - 1, at + 1).reshape(width, count).T
    return out.reshape(-1).view(kind), end


def _squeezed(values: np.ndarray) -> bytes:
    data = len(values).to_bytes(8, "little") + _planes(values)
    return zstandard.ZstdCompressor(1).compress(data)


def _array(blob: bytes, kind: str) -> np.ndarray:
    data = zstandard.ZstdDecompressor().decompress(blob)
    return _from_planes(data, 8, int.from_bytes(data[:8], "little"), np.dtype(kind))[0]


def _runs_of(values: np.ndarray) -> list[tuple[int, int]]:
    """Where each run of equal values begins and ends."""
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    return list(pairwise([0, *cuts.tolist(), len(values)])) if len(values) else []


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, a place of each, and the number of each key among them."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.append(True, ordered[1:] != ordered[:-1])[: len(keys)]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return ordered[new], order[new], number


def text_parts(docs: DataFrame, held_out: Column, parts: int | None = None) -> DataFrame:
    """The chunks of a corpus: a row for each word of a chunk's dictionary, with its
    count in the texts to learn from, and one with the chunk's texts as word numbers.
    With ``parts``, words are packed: a row for each chunk and part of the vocabulary."""
    marked = docs.select("doc_id", "text", held_out.alias("held"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 24
        for batch in batches:
            ids = batch.column("doc_id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            numbers = ids.fill_null(0).to_numpy(zero_copy_only=False)
            held = batch.column("held").to_numpy(zero_copy_only=False).astype(bool)
            for start, texts in packed.text_chunks(batch.column("text"), CHUNK):
                at = slice(start, start + len(texts))
                yield from _chunk_rows(chunk, texts, numbers[at], known[at], held[at], parts)
                chunk += 1

    return marked.mapInArrow(run, PACKED_SCHEMA if parts else PART_SCHEMA)


def _runs(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The texts in runs that are tokenised at a time."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size > packed.CHUNK_BYTES:
            yield texts[start : i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield texts[start:]


def _chunk_rows(chunk: int, texts: list[bytes], ids, known, held, parts) -> Iterator[pa.RecordBatch]:
    hashes, starts, lengths, sizes, base, whole = [], [], [], [], 0, []
    for some in _runs(texts):
        data, offsets = packed.pack(some)
        tokens = packed.Tokens(data, offsets, packed.SPACED_CLASSES)
        hashes.append(tokens.hash)
        starts.append(tokens.start + base)
        lengths.append((tokens.end - tokens.start).astype(np.int32))
        sizes.append(tokens.count)
        whole.append(data.tobytes())
        base += len(data)
    text = b"".join(whole).lower()
    whole.clear()
    sizes = np.concatenate(sizes)
    distinct, first, number = _numbered(np.concatenate(hashes))
    number = number.astype(np.uint32)
    hashes.clear()
    learned = np.bincount(number[np.repeat(~held, sizes)], minlength=len(first))
    begin = np.concatenate(starts)[first]
    end = begin + np.concatenate(lengths)[first]
    words = [text[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
    words.append(b"")  # the end of a text
    learned = np.append(learned, (~held).sum())
    count = len(words)
    keys = np.append(distinct.view(np.int64), 0)
    names = ["chunk", "lid", "word", "learned", "h", "hs", "ids", "known_ids", "held", "sizes", "lids"]
    types = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), *[pa.binary()] * 6]
    if parts:
        names, types = [*names, "part", "lengths"], [*types, pa.int64(), pa.binary()]
    schema = pa.schema(list(zip(names, types, strict=True)))
    if parts:
        rows = _word_packs(chunk, words, learned, keys, parts)
    else:
        rows = {"chunk": np.full(count, chunk), "lid": np.arange(count, dtype=np.int32),
                "word": words, "learned": learned, "h": keys}
    yield _batch(rows, schema)
    blob = _packed_lids(number, len(distinct))
    values = [ids.astype("<i8"), known.astype("u1"), held.astype("u1"), sizes.astype("<i8")]
    row = dict(zip(("ids", "known_ids", "held", "sizes"), ([v.tobytes()] for v in values), strict=True))
    hashes = {} if parts else {"hs": [keys.tobytes()]}
    yield _batch({"chunk": [chunk], **hashes, **row, "lids": [blob]}, schema)


def _packed_lids(number: np.ndarray, words: int) -> bytes:
    """A chunk's word numbers as ranks by frequency, which are small, and how often each occurs,
    from which the ranks follow."""
    counts = np.bincount(number, minlength=words)
    rank = np.empty(words, "<u4")
    rank[np.argsort(-counts, kind="stable")] = np.arange(words)
    head = _squeezed(counts)
    return len(head).to_bytes(8, "little") + head + _squeezed(rank[number])


def _unpacked_lids(blob: bytes) -> np.ndarray:
    end = 8 + int.from_bytes(blob[:8], "little")
    order = np.argsort(-_array(blob[8:end], "<i8"), kind="stable")
    return order.astype(np.uint32)[_array(blob[end:], "<u4")]


def _batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    """Columns that are not given are null."""
    count = len(next(iter(columns.values())))
    filled = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(count, f.type) for f in schema]
    return pa.RecordBatch.from_arrays(filled, schema=schema)


def _word_packs(chunk: int, words: list[bytes], learned: np.ndarray, keys: np.ndarray, parts: int) -> dict:
    """A chunk's words by part: parts are ranges of unsigned hashes, whose order is that of the
    words' numbers, but for the end."""
    lids = np.append(len(words) - 1, np.arange(len(words) - 1)).astype("<i4")
    hashes, counts = keys[lids], learned[lids]
    words = [words[-1], *words[:-1]]
    part = ((hashes.view(np.uint64) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    spans = _runs_of(part)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return {
        "chunk": np.full(len(spans), chunk), "part": part[[a for a, _ in spans]],
        "word": [zstandard.ZstdCompressor(1).compress(b"".join(words[a:b])) for a, b in spans],
        "lengths": [_squeezed(np.stack([lengths[a:b], counts[a:b]], axis=1).reshape(-1)) for a, b in spans],
        "hs": [hashes[a:b].astype("<i8").tobytes() for a, b in spans],
        "lids": [_squeezed(lids[a:b]) for a, b in spans],
    }


@dataclass
class ChunkTexts:
    """The texts of a chunk as word numbers, and their pairs of neighbours."""

    ids: np.ndarray
    known: np.ndarray
    held: np.ndarray
    sizes: np.ndarray
    #: What each word is called outside of the chunk.
    names: np.ndarray
    lids: np.ndarray

    @classmethod
    def of(cls, row, names: np.ndarray | None = None) -> ChunkTexts:
        """Words are called by their hashes, if not by ``names``."""
        types = {"ids": "<i8", "known_ids": "u1", "held": "u1", "sizes": "<i8"}
        names = np.frombuffer(row["hs"], "<i8") if names is None else names
        return cls(*[np.frombuffer(row[n], t) for n, t in types.items()], names, _unpacked_lids(row["lids"]))

    def pairs(self) -> tuple[np.ndarray, ...]:
        """By distinct pair, in the order of word numbers: first word, second word, count in
        the texts to learn from; and the pair of each token and end of all texts in turn."""
        count = len(self.names)
        each = self.sizes + 1
        ends = np.cumsum(each) - 1
        follow = np.full(each.sum(), count - 1, np.int64)
        inside = np.ones(len(follow), bool)
        inside[ends] = False
        follow[inside] = self.lids
        before = np.append(count - 1, follow[:-1])
        code, _, at = _numbered(before * count + follow)
        learned = np.bincount(at[np.repeat(self.held == 0, each)], minlength=len(code))
        return code // count, code % count, learned, at


#: A chunk's pairs within a bucket: steps from place to place in the chunk, both words, count.
PAIR = np.dtype([("step", "<i4"), ("u", "<i8"), ("w", "<i8"), ("n", "<i4")])


def _columns(rows: np.ndarray) -> bytes:
    """Column by column, which compresses better."""
    data = len(rows).to_bytes(8, "little") + b"".join(_planes(rows[n]) for n in rows.dtype.names)
    return zstandard.ZstdCompressor(1).compress(data)


def _rows(blob: bytes, kind: np.dtype) -> np.ndarray:
    data = zstandard.ZstdDecompressor().decompress(blob)
    out, at = np.empty(int.from_bytes(data[:8], "little"), kind), 8
    for name in kind.names:
        out[name], at = _from_planes(data, at, len(out), kind[name])
    return out


def pair_parts(texts: DataFrame, buckets: int, names: DataFrame | None = None) -> DataFrame:
    """(bucket, chunk, pairs): the distinct pairs of each chunk, dealt by a hash. Words are
    called by their hashes, or as ``names`` (chunk, lids, names) has it."""

    def dealt(texts: ChunkTexts, chunk: int) -> pd.DataFrame:
        u, w, n, _ = texts.pairs()
        rows = np.empty(len(u), PAIR)
        rows["u"], rows["w"], rows["n"] = texts.names[u], texts.names[w], n
        key = packed.paired(rows["u"].view(np.uint64), rows["w"].view(np.uint64))
        bucket = (key % np.uint64(buckets)).astype(np.min_scalar_type(buckets))
        order = np.argsort(bucket, kind="stable")
        rows, bucket, blobs, spans = rows[order], bucket[order], [], _runs_of(bucket[order])
        for a, b in spans:
            own = rows[a:b]
            own["step"] = np.diff(order[a:b], prepend=0)
            blobs.append(_columns(own))
        found = bucket[[a for a, _ in spans]].astype(np.int64)
        return pd.DataFrame({"bucket": found, "chunk": chunk, "pairs": blobs})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = dealt(ChunkTexts.of(row), row["text_chunk"])
                yield pa.RecordBatch.from_pandas(found, preserve_index=False)

    def named(text: pd.DataFrame, names: pd.DataFrame) -> pd.DataFrame:
        row = text.iloc[0]
        return dealt(ChunkTexts.of(row, _chunk_names(names)), row["text_chunk"])

    schema = "bucket long, chunk long, pairs binary"
    one = texts.select("text_chunk", "ids", "known_ids", "held", "sizes", "hs", "lids")
    if names is None:
        return one.mapInArrow(run, schema)
    return one.groupBy("text_chunk").cogroup(names.groupBy("chunk")).applyInPandas(named, schema)


def _chunk_names(names: pd.DataFrame) -> np.ndarray:
    """The names of a chunk's words in the order of their numbers there."""
    lids = np.concatenate([_array(x, "<i4") for x in names["lids"]])
    out = np.empty(len(lids), np.int64)
    out[lids] = np.concatenate([_array(x, "<i8") for x in names["names"]])
    return out


#: Where in a chunk a pair is whose count its chunk cannot know: steps from place to place, and
#: its number among the repeated pairs of the bucket, -1 for a pair learned once.
PLACED = np.dtype([("step", "<i4"), ("j", "<i4")])
#: The repeated pairs of a bucket: both words by their numbers among its words, count.
REPEATED = np.dtype([("u", "<i4"), ("w", "<i4"), ("c", "<i8")])


def _packed_pairs(u: np.ndarray, w: np.ndarray, c: np.ndarray) -> dict[str, list[bytes]]:
    """Repeated pairs, and the names of their words in order."""
    words, _, number = _numbered(np.concatenate([u, w]))
    rows = np.empty(len(u), REPEATED)
    rows["u"], rows["w"], rows["c"] = number[: len(u)], number[len(u) :], c
    return {"names": [_squeezed(words)], "pairs": [_columns(rows)]}


def tallied(parts: DataFrame, with_once: bool = True, pack: bool = False) -> DataFrame:
    """Three kinds of rows of each bucket: repeated pairs (u, w, c, j); how many pairs learned
    once have a word first (u, c) or second (w, c), if asked for; and ``places`` of a chunk.
    With ``pack``, repeated pairs are one row, in the order of j: ``names`` and ``pairs``."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        pieces = [_rows(b, PAIR) for b in group["pairs"]]
        u, w, count = (np.concatenate([p[n] for p in pieces]) for n in ("u", "w", "n"))
        place = np.concatenate([np.cumsum(p["step"]) for p in pieces])
        part = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
        pieces.clear()
        _, first, number = _numbered(packed.paired(u.view(np.uint64), w.view(np.uint64)))
        c = np.bincount(number, count, len(first)).astype(np.int64)
        times = np.bincount(number)
        again = np.flatnonzero(c > 1)
        j = np.full(len(first), -1, np.int32)
        j[again] = np.arange(len(again))
        repeated = u[first[again]], w[first[again]], c[again]
        out = []
        if not pack:
            out.append(pd.DataFrame({**dict(zip("uwc", repeated, strict=True)), "j": j[again]}))
        elif len(again):
            out.append(pd.DataFrame(_packed_pairs(*repeated)))
        once = first[c == 1]
        for side in ("u", "w") if with_once else ():
            word, n = np.unique({"u": u, "w": w}[side][once], return_counts=True)
            out.append(pd.DataFrame({side: word, "c": n}))
        told = np.flatnonzero(((c > 1) | ((c == 1) & (times > 1)))[number])
        chunks, blobs = [], []
        for a, b in _runs_of(part[told]):
            at = told[a:b]
            placed = np.empty(len(at), PLACED)
            placed["step"], placed["j"] = np.diff(place[at], prepend=0), j[number[at]]
            chunks.append(group["chunk"].iloc[part[at[0]]])
            blobs.append(_columns(placed))
        out.append(pd.DataFrame({"chunk": np.array(chunks, np.int64), "places": blobs}))
        numbers = ("u", "w", "c", "j", "chunk")
        whole = pd.concat([f.astype({n: "Int64" for n in numbers if n in f}) for f in out], ignore_index=True)
        whole = whole.assign(bucket=group["bucket"].iloc[0]).reindex(columns=["bucket", *numbers, "places", "names", "pairs"])
        for n in ("places", "names", "pairs"):
            whole[n] = whole[n].astype(object).where(whole[n].notna(), None)
        return whole.astype({n: "Int64" for n in numbers})

    schema = "bucket long, u long, w long, c long, j long, chunk long, places binary, names binary, pairs binary"
    return parts.groupBy("bucket").applyInPandas(run, schema)


def log_stirling(discount: float, most: int = EXACT) -> np.ndarray:
    """log S(c, t) for all c and t up to ``most``: the ways to seat c customers at t tables."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[0, 0] = 0
    for c in range(most):
        stay = np.log(np.maximum(c - discount * np.arange(most + 1), 1e-300)) + out[c]
        stay[0] = -np.inf if c else out[c, 0] - np.inf
        out[c + 1, 1:] = np.logaddexp(out[c, :-1], stay[1:])
    return out


def uniform(keys: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on key and salt alone."""
    h = packed.mixed(packed.mixed(keys ^ np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)) + np.uint64(salt))
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53


@dataclass(frozen=True)
class Restaurants:
    """Draws the tables of dishes; one discount and concentration for all."""

    discount: float
    strength: float

    def tables(self, customers, others, prior, keys, sweep: int) -> np.ndarray:
        """Tables of each dish: its customers, the tables of its restaurant's other
        dishes, the parent's probability of it, and a key for the draw."""
        d = self.discount
        out = np.minimum(customers, 1)
        some = np.flatnonzero(customers > 1)
        # dishes of few customers together: rows of the arrays are as wide as the most customers
        some = some[np.argsort(customers[some], kind="stable")]
        stirling = log_stirling(d)
        for start in range(0, len(some), 1 << 13):
            at = some[start : start + (1 << 13)]
            seated, prior_at, others_at = np.minimum(customers[at], EXACT), prior[at], others[at]
            most = int(seated.max())
            ways = stirling[:, 1 : most + 1].T[:, seated]
            if most <= FEW:  # a few factors need no logarithms
                weight = np.exp(ways)
                factor = np.ones(len(at))
                for t in range(1, most):
                    factor = factor * ((self.strength + d * (others_at + t)) * prior_at)
                    weight[t] *= factor
            else:
                weight = np.log(self.strength + d * (others_at + np.arange(most)[:, None]))
                weight += np.log(np.maximum(prior_at, 1e-300))
                weight = np.cumsum(weight, axis=0) + ways
                weight = np.exp(weight - weight.max(axis=0))
            total = np.cumsum(weight, axis=0)
            draw = uniform(keys[at], 3 * sweep) * total[-1]
            out[at] = 1 + (total < draw).sum(axis=0)
        return self._beyond(out, customers, others, prior, keys, sweep)

    def _beyond(self, out, customers, others, prior, keys, sweep: int) -> np.ndarray:
        """Seat the customers after the first ``EXACT`` in batches that double."""
        at = np.flatnonzero(customers > EXACT)
        seated, turn = EXACT, 0
        while len(at):
            batch = np.minimum(customers[at] - seated, seated).astype(np.float64)
            new = (self.strength + self.discount * (others[at] + out[at])) * prior[at]
            p = new / (new + seated - self.discount * out[at] + batch / 2)
            salt = 3 * sweep + 1000 * (turn + 1)
            z = np.sqrt(-2 * np.log(uniform(keys[at], salt + 1))) * np.cos(
                2 * np.pi * uniform(keys[at], salt + 2)
            )
            more = np.rint(batch * p + z * np.sqrt(batch * p * (1 - p)))
            out[at] += np.clip(more, 0, batch).astype(out.dtype)
            seated, turn = seated * 2, turn + 1
            at = at[customers[at] > seated]
        return out

    def predictive(self, customers, tables, all_customers, all_tables, prior):
        """Probability of a dish given its counts, its restaurant's, and the parent's."""
        left = (self.strength + self.discount * all_tables) * prior
        return (np.maximum(customers - self.discount * tables, 0) + left) / (
            self.strength + all_customers
        )


class Spelling:
    """Probabilities of bytes by the bytes before; a blank stands for start and end.

    Only contexts that occur have a row, and only bytes that occur a column; bytes
    that do not are all alike and share the last one.
    """

    def __init__(self):
        self.column = np.zeros(256, np.int64)
        self.rows = [np.full((1, 1), 1 / 256, np.float32) for _ in CODE_BITS]
        #: By level: the row of each context code, -1 for none.
        self.row_of = [np.full(1 << bits, -1, np.int32) for bits in CODE_BITS]
        self.row_of[0][0] = 0

    def p(self, code: np.ndarray, byte: np.ndarray, level: int = len(CODE_BITS) - 1) -> np.ndarray:
        """By the longest context known, of those up to ``level``."""
        column = self.column[byte]
        found = self.rows[0][0, column]
        for at in range(1, level + 1):
            row = self.row_of[at][code & ((1 << CODE_BITS[at]) - 1)]
            found = np.where(row >= 0, self.rows[at][row, column], found)
        return found

    @staticmethod
    def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """context code * 256 + byte of each byte and the end of each word, and their number."""
        data = np.frombuffer(b"   " + b"   ".join(words) + b"   ", np.uint8).astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        first = np.cumsum(sizes + 2) - (sizes + 2) + 3
        at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        code = data[at - 1] | (data[at - 2] & 63) << 8 | (data[at - 3] & 31) << 14
        return code << 8 | data[at], sizes

    def probability(self, words: list[bytes]) -> np.ndarray:
        """Probability that a new table gets each of the words."""
        keys, sizes = self.grams(words)
        return self.of_grams(keys, slice(None), sizes)

    def of_grams(self, keys: np.ndarray, at: np.ndarray | slice, sizes: np.ndarray) -> np.ndarray:
        """The same for words whose grams are ``keys[at]``, ``sizes`` of them each."""
        p = self.p(keys >> 8, keys & 255)
        return np.exp(np.maximum(packed.sums(np.log(np.maximum(p, 1e-30))[at], sizes), -690.0))


class ByteSeating:
    """The sampled tables of the byte restaurants, and what they make of a spelling."""

    def __init__(self):
        self.levels = [Restaurants(*x) for x in BYTES]
        self.spelling = Spelling()
        #: By level: tables of each restaurant after the last sweep.
        self.tables = [np.zeros(1 << bits, np.int64) for bits in CODE_BITS]

    def sweep(self, keys: np.ndarray, customers: np.ndarray, number: int) -> None:
        """Sample all levels, from the longest contexts to the empty one, and take the
        probabilities from there up. ``keys``: context code * 256 + byte."""
        seated, tables = [], []
        for level in reversed(range(len(CODE_BITS))):
            context, byte = keys >> 8, keys & 255
            if level:
                prior = self.spelling.p(context, byte, level - 1).astype(np.float64)
            else:
                prior = np.full(len(keys), 1 / 256)
            drawn = self.levels[level].tables(
                customers, np.maximum(self.tables[level][context] - 1.0, 0), prior,
                keys.astype(np.uint64) + np.uint64(level << 40), number,
            )
            tables.append(np.bincount(context, drawn, 1 << CODE_BITS[level]).astype(np.int64))
            seated.append((context, byte, customers, drawn))
            if level:
                above = (context & ((1 << CODE_BITS[level - 1]) - 1)) << 8 | byte
                sent = np.bincount(above, drawn).astype(np.int64)
                keys = np.flatnonzero(sent)
                customers = sent[keys]
        self.tables = tables[::-1]
        self.spelling = self._spelling(seated[::-1])

    def _spelling(self, seated: list[tuple[np.ndarray, ...]]) -> Spelling:
        new = Spelling()
        known = np.unique(seated[-1][1])
        new.column = np.full(256, len(known))
        new.column[known] = np.arange(len(known))
        prior: np.ndarray | float = 1 / 256
        for level, (context, byte, c, t) in enumerate(seated):
            contexts, row = np.unique(context, return_inverse=True)
            counts, tables = np.zeros((2, len(contexts), len(known) + 1))
            counts[row, new.column[byte]], tables[row, new.column[byte]] = c, t
            if level:
                parents = contexts & ((1 << CODE_BITS[level - 1]) - 1)
                prior = new.rows[level - 1][new.row_of[level - 1][parents]]
            new.rows[level] = self.levels[level].predictive(
                counts, tables, counts.sum(axis=1, keepdims=True),
                tables.sum(axis=1, keepdims=True), prior,
            ).astype(np.float32)
            new.row_of[level][contexts] = np.arange(len(contexts))
        return new


@dataclass
class Sample:
    """State of one sweep: all tables of the word restaurant, and the spelling model."""

    number: int
    all_tables: int
    spelling: Spelling

    def tables(self, words: list[bytes], counts: np.ndarray, keys: np.ndarray):
        """Tables and spelling probability of words."""
        prior = self.spelling.probability(words)
        return self.drawn(counts, prior, keys), prior

    def drawn(self, counts: np.ndarray, prior: np.ndarray, keys: np.ndarray) -> np.ndarray:
        others = np.full(len(counts), max(self.all_tables - 1, 0), np.float64)
        return Restaurants(*WORDS).tables(counts, others, prior, keys, self.number)


#: A part of the vocabulary: its words that were learned more than once, or the others. Their
#: names in order, hashes, counts, bytes, and grams as places among the part's own. A name
#: modulo the number of parts is the word's part. Rows of a chunk tell it its words' names.
VOCABULARY = (
    "part long, often boolean, n long, distinct long, names binary, hs binary, c binary, words binary, "
    "sizes binary, grams binary, at binary, chunk long, lids binary"
)


def _vocabulary_rows(part: int, names: np.ndarray, hashes: np.ndarray, c: np.ndarray, words: list[bytes]) -> pd.DataFrame:
    """Two rows: the words learned more than once, and the others."""
    rows = []
    for often in (True, False):
        some = np.flatnonzero((c > 1) == often)
        own = [words[i] for i in some.tolist()]
        grams, sizes = Spelling.grams(own)
        found, _, at = _numbered(grams)
        rows.append(
            {"part": part, "often": often, "n": int(c[some].sum()), "distinct": int((c[some] > 0).sum()),
             "names": _squeezed(names[some].astype("<i8")), "hs": hashes[some].tobytes(),
             "c": _squeezed(c[some].astype("<i8")),
             "words": zstandard.ZstdCompressor(1).compress(b"".join(own)), "sizes": _squeezed(sizes.astype("<i4")),
             "grams": _squeezed(found.astype("<i8")), "at": _squeezed(at.astype("<i4"))}
        )
    return pd.DataFrame(rows)


def _sliced(data: bytes, lengths: np.ndarray) -> list[bytes]:
    ends = np.cumsum(lengths)
    return [data[a:b] for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]


def merged_words(packs: DataFrame, parts: int) -> DataFrame:
    """The vocabulary of all chunks' packed words, whose names are numbers: small ones for frequent
    words. Words are told apart by 64-bit hashes, as within a chunk."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        own = [np.frombuffer(h, "<u8") for h in group["hs"]]
        lengths, learned = np.concatenate([_array(x, "<i8").reshape(-1, 2) for x in group["lengths"]]).T
        data = b"".join(zstandard.ZstdDecompressor().decompress(w) for w in group["word"])
        hashes, first, number = _numbered(np.concatenate(own))
        c = np.bincount(number, learned).astype(np.int64)
        order = np.lexsort((hashes, -c))
        part, rank = int(group["part"].iloc[0]), np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        ends = np.cumsum(lengths)[first[order]]
        begins = ends - lengths[first[order]]
        words = [data[a:b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
        names = np.split(rank[number] * parts + part, np.cumsum([len(h) for h in own])[:-1])
        told = {"chunk": group["chunk"].astype("Int64"), "lids": group["lids"], "names": [_squeezed(x) for x in names]}
        return pd.concat(
            [_vocabulary_rows(part, np.arange(len(order)) * parts + part, hashes[order], c[order], words),
             pd.DataFrame(told).assign(part=part)]
        ).reindex(columns=[f.split()[0] for f in VOCABULARY.split(", ")]).astype(_NUMBERS)

    return packs.select("part", "chunk", "hs", "lids", "lengths", "word").groupBy("part").applyInPandas(run, VOCABULARY)


_NUMBERS = {"n": "Int64", "distinct": "Int64", "chunk": "Int64", "often": "boolean"}


def packed_words(vocabulary: DataFrame, parts: int) -> DataFrame:
    """The same of a row (word, h, c) for each word, whose names are their hashes."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        hashes = group["h"].to_numpy().astype(np.int64)
        order = np.argsort(hashes)
        words = [bytes(group["word"].iloc[i]) for i in order.tolist()]
        names, c = hashes[order], group["c"].to_numpy()[order]
        found = _vocabulary_rows(int(group["part"].iloc[0]), names, names.view(np.uint64), c, words)
        return found.reindex(columns=[f.split()[0] for f in VOCABULARY.split(", ")]).astype(_NUMBERS)

    part = F.pmod("h", F.lit(parts)).alias("part")
    return vocabulary.select("word", "h", "c", part).groupBy("part").applyInPandas(run, VOCABULARY)


@dataclass
class PartWords:
    """Words of a part of the vocabulary, and the grams of their spelling."""

    hashes: np.ndarray
    names: np.ndarray
    counts: np.ndarray
    sizes: np.ndarray
    grams: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, row) -> PartWords:
        blobs = (("names", "<i8"), ("c", "<i8"), ("sizes", "<i4"), ("grams", "<i8"), ("at", "<i4"))
        return cls(np.frombuffer(row["hs"], "<u8"), *[_array(row[n], kind) for n, kind in blobs])

    def prior(self, spelling: Spelling) -> np.ndarray:
        return spelling.of_grams(self.grams, self.at, self.sizes)

    def sent(self, tables: np.ndarray) -> np.ndarray:
        """Customers of the byte restaurants, by gram."""
        return np.bincount(self.at, np.repeat(tables, self.sizes), len(self.grams)).astype("<i8")

    def state(self, sample: Sample, customers: np.ndarray, total: int) -> np.ndarray:
        """Probability of each word in the restaurant of all words, of ``total`` customers."""
        prior = self.prior(sample.spelling)
        tables = sample.drawn(customers, prior, self.hashes)
        p = Restaurants(*WORDS).predictive(customers, tables, total, sample.all_tables, prior)
        return np.maximum(p, 1e-307)


def _gram_sums(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sums by gram of what packed words send, or send with one table for each customer; of
    2^27 grams at most, whatever the vocabulary."""
    counted = "sent" not in words.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if counted:
                    own = PartWords.of(row)
                    grams, sent = own.grams, own.sent(own.counts)
                else:
                    grams, sent = (_array(row[n], "<i8") for n in ("grams", "sent"))
                yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(sent)], ["gram", "n"])

    rows = (
        words.mapInArrow(run, "gram long, n long")
        .groupBy("gram").agg(F.sum("n").alias("n")).where("n > 0").orderBy("gram").toArrow()
    )
    return rows["gram"].to_numpy(), rows["n"].to_numpy()


def sampled(vocabulary: DataFrame, following: Following | None = None) -> list[Sample]:
    """The states of the sweeps that count. The customers of words are the tables of
    ``following``, which takes part in each sweep, or else the counts of the vocabulary."""
    kept, seating, sample = [], ByteSeating(), None
    following = following or Following(vocabulary)
    for number in range(BURN_IN + SAMPLES):
        tables, grams, sent = following.seat(number, sample)
        if len(grams):
            seating.sweep(grams, sent, number)
        sample = Sample(number + 1, tables, seating.spelling)
        following.observe(number, sample)
        if number >= BURN_IN:
            kept.append(sample)
    return kept


#: A part of the vocabulary in a sweep: its words' customers, their tables as first words, what
#: they send to the byte restaurants, and the places of the words that each bucket asks for.
SEATED = (
    "part long, names binary, hs binary, c binary, sizes binary, grams binary, at binary, customers binary, "
    "tables binary, sent binary, all_customers long, all_tables long, buckets array<long>, asked array<binary>"
)


class Following:
    """The sampled tables of the restaurants of following words, as tables on Spark.

    A word is the first of as many pairs as it has tokens, and the second of as many. A pair
    learned once has one table. So a word's tables as the first and its customers as the
    second are its tokens less the repeated pairs' customers beyond their tables. A word
    learned once at most is in no repeated pair: it stays as it is in all sweeps.

    ``vocabulary`` and ``tally`` come packed or as rows; ``parts`` is the number of parts."""

    def __init__(self, vocabulary: DataFrame, tally: DataFrame | None = None, parts: int = 1):
        if "word" in vocabulary.columns:
            vocabulary = durable(packed_words(vocabulary, parts), "lm-vocabulary")
        self.vocabulary, self.parts = vocabulary, parts
        self.words = vocabulary.where("often").select("part", "names", "hs", "c", "sizes", "grams", "at")
        self.pairs = None if tally is None else _repeated(tally)
        self.rare: tuple[int, np.ndarray, np.ndarray] | None = None
        self.seated: DataFrame | None = None
        #: Of the sweeps that count: the tables of repeated pairs by bucket, in their order, the
        #: state of words by part, and the customers of all words.
        self.drawn: list[DataFrame] = []
        self.states: list[DataFrame] = []
        self.totals: list[int] = []

    def _rare_words(self) -> tuple[int, np.ndarray, np.ndarray]:
        """The number of words learned once, and what they send to the byte restaurants."""
        rare = self.vocabulary.where("NOT often")
        sent = _gram_sums(rare.select("names", "hs", "c", "sizes", "grams", "at"))
        return rare.agg(F.sum("n")).first()[0] or 0, *sent

    def _sums(self, number: int) -> DataFrame:
        """Seat all pairs given the last sweep: by bucket their tables, and by part of the
        vocabulary what the bucket's pairs spare its words as the second and as the first."""
        parts = self.parts
        schema = "part long, bucket long, names binary, less binary, t binary"

        def run(pairs: pd.DataFrame, states: pd.DataFrame | None = None) -> pd.DataFrame:
            out = []
            for row in pairs.to_dict("records"):
                names, rows = _array(row["names"], "<i8"), _rows(row["pairs"], REPEATED)
                u, w, c = (rows[n] for n in REPEATED.names)
                # words by part, as their states come
                order = np.argsort(names % parts, kind="stable")
                if states is None:
                    t = np.ones(len(c), np.int64)
                else:
                    own = states.sort_values("part")
                    of_words = []
                    for n, kind in (("tables", "<i8"), ("p", "<f8"), ("hs", "<u8")):
                        told = np.concatenate([_array(x, kind) for x in own[n]])
                        of_words.append(np.empty_like(told))
                        of_words[-1][order] = told
                    all_tables, p, hashes = of_words
                    keys = packed.paired(hashes[u], hashes[w])
                    t = Restaurants(*PAIRS).tables(c, np.maximum(all_tables[u] - 1.0, 0), p[w], keys, number)
                less = np.stack([np.bincount(x, c - t, len(names)) for x in (w, u)], axis=1).astype("<i8")[order]
                names = names[order]
                for a, b in _runs_of(names % parts):
                    out.append({"part": names[a] % parts, "bucket": row["bucket"], "names": _squeezed(names[a:b]),
                                "less": _squeezed(less[a:b].reshape(-1)), "t": None})
                out.append({"part": None, "bucket": row["bucket"], "names": None, "less": None, "t": _squeezed(t.astype("<i8"))})
            return pd.DataFrame(out, columns=["part", "bucket", "names", "less", "t"]).astype({"part": "Int64"})

        if not number:
            return self.pairs.groupBy("bucket").applyInPandas(lambda pairs: run(pairs), schema)
        asked = self.state.where("bucket IS NOT NULL").groupBy("bucket")
        return self.pairs.groupBy("bucket").cogroup(asked).applyInPandas(lambda p, s: run(p, s), schema)

    def seat(self, number: int, sample: Sample | None) -> tuple[int, np.ndarray, np.ndarray]:
        """Seat all pairs and then all words given the last sweep (one table each without it).
        Returns the tables of all words and the customers that they send to the byte restaurants.

        What only this sweep needs is discarded as soon as it is added up."""
        spark = self.vocabulary.sparkSession
        shared, sums = spark.sparkContext.broadcast(sample), None
        if self.pairs is not None:
            sums = self._sums(number)
            if number >= BURN_IN:
                sums = durable(sums, "lm-drawn")
                self.drawn.append(sums)

        def run(vocabulary: pd.DataFrame, sums: pd.DataFrame | None = None) -> pd.DataFrame:
            out, sample = [], shared.value
            for row in vocabulary.to_dict("records"):
                words = PartWords.of(row)
                less, asked = np.zeros((len(words.hashes), 2), np.int64), []
                for names, spared in zip(sums["names"], sums["less"], strict=True) if sums is not None else ():
                    at = np.searchsorted(words.names, _array(names, "<i8"))
                    less[at] += _array(spared, "<i8").reshape(-1, 2)
                    asked.append(_squeezed(at.astype("<i4")))
                customers, left = np.maximum(words.counts[:, None] - less, 0).T
                tables = np.minimum(customers, 1)
                if sample is not None:
                    tables = sample.drawn(customers, words.prior(sample.spelling), words.hashes)
                out.append(
                    row | {"customers": _squeezed(customers), "tables": _squeezed(left), "sent": _squeezed(words.sent(tables)),
                           "all_customers": int(customers.sum()), "all_tables": int(tables.sum()),
                           "buckets": [] if sums is None else sums["bucket"].tolist(), "asked": asked}
                )
            return pd.DataFrame(out, columns=[f.split()[0] for f in SEATED.split(", ")])

        by_part = self.words.groupBy("part")
        if sums is None:
            seated = by_part.applyInPandas(lambda words: run(words), SEATED)
        else:
            told = sums.where("part IS NOT NULL").select("part", "bucket", "names", "less").groupBy("part")
            seated = by_part.cogroup(told).applyInPandas(lambda words, sums: run(words, sums), SEATED)
        self.seated = durable(seated, "lm-seated")
        shared.destroy()
        if self.rare is None:
            self.rare = self._rare_words()
        once, *rare = self.rare
        total = self.seated.agg(F.sum("all_customers"), F.sum("all_tables")).first()
        self.total = (total[0] or 0) + once
        grams, sent = _gram_sums(self.seated.select("grams", "sent"))
        found, at = np.unique(np.concatenate([grams, rare[0]]), return_inverse=True)
        n = np.bincount(at, np.concatenate([sent, rare[1]]), len(found)).astype(np.int64)
        if number and self.pairs is not None:
            discard(self.state)
        return (total[1] or 0) + once, found, n

    def customers(self, number: int) -> DataFrame:
        """Seat all words before the first sweep has ended; (word, h, c, tables) of every word:
        its customers as the second of pairs, and its tables as the first."""
        self.seat(number, None)

        def run(vocabulary: pd.DataFrame, seated: pd.DataFrame) -> pd.DataFrame:
            out = []
            for row in vocabulary.to_dict("records"):
                words = PartWords.of(row)
                data = zstandard.ZstdDecompressor().decompress(row["words"])
                both = [words.counts] * 2
                if row["often"]:
                    both = [_array(seated[n].iloc[0], "<i8") for n in ("customers", "tables")]
                names = ("word", "h", "c", "tables")
                values = _sliced(data, words.sizes - 1), words.hashes.view(np.int64), *both
                out.append(pd.DataFrame(dict(zip(names, values, strict=True))))
            return pd.concat(out)

        by_part = self.vocabulary.where("chunk IS NULL").groupBy("part").cogroup(self.seated.groupBy("part"))
        return by_part.applyInPandas(run, "word binary, h long, c long, tables long")

    def observe(self, number: int, sample: Sample) -> None:
        """The state of words after a sweep: for each bucket that of its own words, and of
        the sweeps that count that of all."""
        if self.pairs is None:
            return discard(self.seated)
        shared, total, kept = self.vocabulary.sparkSession.sparkContext.broadcast(sample), self.total, number >= BURN_IN
        last = number == BURN_IN + SAMPLES - 1
        schema = "part long, bucket long, tables binary, p binary, hs binary, c binary"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    words = PartWords.of(row)
                    customers, tables = (_array(row[n], "<i8") for n in ("customers", "tables"))
                    p = words.state(shared.value, customers, total)
                    places = [] if last else [_array(x, "<i4") for x in row["asked"]]
                    buckets = [] if last else list(row["buckets"])
                    if kept:
                        places, buckets = [*places, slice(None)], [*buckets, None]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["part"]] * len(places), pa.int64()), pa.array(buckets, pa.int64()),
                         pa.array([_squeezed(tables[x]) for x in places], pa.binary()),
                         pa.array([_squeezed(p[x]) for x in places], pa.binary()),
                         pa.array([_squeezed(words.hashes[x]) for x in places], pa.binary()),
                         pa.array([_squeezed(words.counts) if b is None else None for b in buckets], pa.binary())],
                        ["part", "bucket", "tables", "p", "hs", "c"],
                    )

        self.state = durable(self.seated.drop("sent").mapInArrow(run, schema), "lm-state")
        shared.destroy()
        discard(self.seated)
        if kept:
            self.states.append(durable(self.state.where("bucket IS NULL").select("part", "c", "tables", "p"), "lm-words"))
            self.totals.append(total)
        if last:
            discard(self.state)


def _repeated(tally: DataFrame) -> DataFrame:
    """The repeated pairs of each bucket as one row, from one or from a row for each."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        rows = group.sort_values("j")
        u, w, c = (rows[n].to_numpy().astype(np.int64) for n in ("u", "w", "c"))
        return pd.DataFrame({"bucket": group["bucket"].iloc[:1].to_numpy(), **_packed_pairs(u, w, c)})

    schema = "bucket long, names binary, pairs binary"
    one = tally.where("pairs IS NOT NULL").select("bucket", "names", "pairs")
    rows = tally.where("j IS NOT NULL").select("bucket", "u", "w", "c", "j")
    return one.unionAll(rows.groupBy("bucket").applyInPandas(run, schema))


def word_states(following: Following, samples: list[Sample]) -> DataFrame:
    """(chunk, lids, words): count, tables and probabilities by sample of each chunk's words."""
    totals, parts = following.totals, following.parts
    shared = following.vocabulary.sparkSession.sparkContext.broadcast(samples)
    columns = ("part", "names", "hs", "c", "sizes", "grams", "at", "chunk", "lids")
    told = following.vocabulary.where("often IS NULL OR NOT often").select(*columns)
    for number, state in enumerate(following.states):
        own = state.select("part", F.lit(number).alias("s"), "c", "tables", "p")
        told = told.unionByName(own, allowMissingColumns=True)
    kind = _word_type(len(samples))

    def run(told: pd.DataFrame) -> pd.DataFrame:
        # names are numbers, so they say where a word is among those of its part: first those
        # learned more than once
        often = told[told["s"].notna()].sort_values("s").to_dict("records")
        counts = _array(often[0]["c"], "<i8") if often else np.zeros(0, np.int64)
        states = [np.empty(len(counts), kind)]
        states[0]["c"] = counts
        for s, row in enumerate(often):
            states[0][f"tables{s}"], states[0][f"p{s}"] = _array(row["tables"], "<i8"), _rounded(_array(row["p"], "<f8"))
        for row in told[told["sizes"].notna()].to_dict("records"):
            words = PartWords.of(row)
            states.append(np.empty(len(words.names), kind))
            states[-1]["c"] = words.counts
            for s, sample in enumerate(shared.value):
                states[-1][f"tables{s}"] = words.counts
                states[-1][f"p{s}"] = _rounded(words.state(sample, words.counts, totals[s]))
        whole = np.concatenate(states)
        for s in range(1, len(shared.value)):  # samples are alike, so their differences are short
            whole[f"p{s}"] ^= whole["p0"]
        asked = told[told["chunk"].notna()]
        blobs = [_columns(whole[_array(names, "<i8") // parts]) for names in asked["names"]]
        return pd.DataFrame({"chunk": asked["chunk"].to_numpy(), "lids": asked["lids"].to_numpy(), "words": blobs})

    return told.groupBy("part").applyInPandas(run, "chunk long, lids binary, words binary")


#: Bits of a probability that texts are not sent: 28 of its 52 remain, and the spelling model has 23.
SPARED_BITS = 24


def _rounded(p: np.ndarray) -> np.ndarray:
    return (p.view(np.uint64) + np.uint64(1 << SPARED_BITS - 1)) >> np.uint64(SPARED_BITS)


def _word_type(samples: int) -> np.dtype:
    own = [x for s in range(samples) for x in ((f"tables{s}", "<i8"), (f"p{s}", "<u8"))]
    return np.dtype([("c", "<i8"), *own])


def _chunk_words(told: pd.DataFrame, samples: int) -> np.ndarray:
    """The states of a chunk's words in the order of their numbers."""
    own = told[told["lids"].notna()]
    lids = [_array(x, "<i4") for x in own["lids"]]
    out = np.empty(sum(map(len, lids)), _word_type(samples))
    for at, words in zip(lids, own["words"], strict=True):
        out[at] = _rows(words, out.dtype)
    for s in range(1, samples):
        out[f"p{s}"] ^= out["p0"]
    return out


def pair_states(tally: DataFrame, drawn: list[DataFrame]) -> DataFrame:
    """(chunk, places): steps, count and tables by sample of the pairs told to each chunk."""
    samples = len(drawn)
    states = tally.where("pairs IS NOT NULL").select("bucket", F.lit(-1).alias("s"), F.col("pairs").alias("t"))
    for number, one in enumerate(drawn):
        states = states.unionAll(one.where("t IS NOT NULL").select("bucket", F.lit(number).alias("s"), "t"))
    placed = tally.where("places IS NOT NULL").select("bucket", "chunk", "places")

    def run(placed: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
        blob = dict(zip(states["s"], states["t"], strict=True))
        once = np.ones(1, np.int64)  # the last, for pairs learned once
        c = np.append(_rows(blob[-1], REPEATED)["c"], once) if blob else once
        t = [np.append(_array(blob[s], "<i8"), once) if blob else once for s in range(samples)]
        blobs = []
        for blob in placed["places"]:
            at = _rows(blob, PLACED)
            out = np.empty(len(at), _state_type(samples))
            out["step"], out["c"] = at["step"], c[at["j"]]
            for s in range(samples):
                out[f"t{s}"] = t[s][at["j"]]
            blobs.append(_columns(out))
        return pd.DataFrame({"chunk": placed["chunk"].to_numpy(), "places": blobs})

    return placed.groupBy("bucket").cogroup(states.groupBy("bucket")).applyInPandas(run, "chunk long, places binary")


def _state_type(samples: int) -> np.dtype:
    return np.dtype([("step", "<i4"), ("c", "<i8"), *((f"t{s}", "<i8") for s in range(samples))])


def scored(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and the
    perplexity of every row; rows where ``held_out`` holds are not learned from."""
    n_parts = 1 + (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PART_BYTES
    marked = text_parts(docs, held_out, n_parts).withColumn("packed", F.col("part").isNotNull())
    parts = durable(marked, "lm-parts", "packed")
    packs = parts.where("packed")
    texts = parts.where("NOT packed").select(
        F.col("chunk").alias("text_chunk"), "hs", "ids", "known_ids", "held", "sizes", "lids"
    )
    vocabulary = durable(merged_words(packs, n_parts), "lm-vocabulary", "often")
    discard_partition(parts, "packed=true")
    total = vocabulary.agg(F.sum("n"), F.sum("distinct")).first()
    tokens, distinct = total[0] or 0, total[1] or 0
    names = vocabulary.where("chunk IS NOT NULL").select("chunk", "lids", "names")
    pairs = pair_parts(texts, 1 + tokens // BUCKET_TOKENS, names)
    tally = durable(tallied(pairs, with_once=False, pack=True), "lm-pairs")
    forget_shuffles(docs.sparkSession)
    following = Following(vocabulary, tally, n_parts)
    samples = sampled(vocabulary, following)
    # stored, so that its sources and the widest shuffles go before the words' states make theirs
    told = durable(pair_states(tally, following.drawn), "lm-told")
    discard(tally, *following.drawn)
    discard_partition(vocabulary, "often=true")
    named = word_states(following, samples)
    told = named.unionByName(told, allowMissingColumns=True)

    def run(key: tuple, text: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        words = _chunk_words(told, SAMPLES)
        texts = ChunkTexts.of(text.iloc[0], np.arange(len(words)))
        sizes, lids = texts.sizes, texts.lids
        counts = words["c"]
        base = np.log10((counts + 0.1) / (tokens + 0.1 * (distinct + 1)))
        of_words = {"known": (counts > 0).astype(np.float64), "base": base}
        found = {n: packed.sums(v[lids], sizes) + v[-1] for n, v in of_words.items()}  # and the end
        u, w, c, at = texts.pairs()
        pair_tables = np.repeat(np.minimum(c, 1)[None], SAMPLES, axis=0)
        for blob in told["places"].dropna():
            states = _rows(blob, _state_type(SAMPLES))
            place = np.cumsum(states["step"])
            c[place] = states["c"]
            for s in range(SAMPLES):
                pair_tables[s, place] = states[f"t{s}"]
        mean = np.zeros(len(c))
        for s in range(SAMPLES):
            all_tables, p = words[f"tables{s}"], (words[f"p{s}"] << np.uint64(SPARED_BITS)).view(np.float64)
            mean += Restaurants(*PAIRS).predictive(c, pair_tables[s], counts[u], all_tables[u], p[w])
        model = np.log10(np.maximum(mean / SAMPLES, 1e-307))
        return pd.DataFrame(
            {
                "doc_id": pd.array(texts.ids, "Int64"),
                "held_out": texts.held.astype(bool),
                "n_tokens": sizes + 1,
                "n_known": np.rint(found["known"]).astype(np.int64),
                "base_score": found["base"],
                "score": packed.sums(model[at], sizes + 1),
            }
        ).assign(doc_id=lambda t: t["doc_id"].mask(texts.known == 0))

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    out = texts.groupBy("text_chunk").cogroup(told.groupBy("chunk")).applyInPandas(run, schema)
    return out.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
        "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
