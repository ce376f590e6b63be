"""Token-id files: documents in id order, as blocks of arithmetic code.

Texts are encoded by the tokenizers library; each document ends with an end id. The
ids of a partition are cut into blocks of ``BLOCK`` ids whatever documents they are
of, and each block is coded alone by ``mixcoder`` with its length and CRC-32. A table
row is a block with the documents that it has parts of, so Spark's writer commits the
files, a lost task writes its file again, and any reader can start at any block.

Null texts are encoded like empty ones: the end id alone. Documents with null ids
come first. Rows with equal ids are ordered by a hash of their text; equal rows are
alike, so their order does not show. Extra columns of the input are ignored. Empty
tables give files without blocks.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ratewise.llm import mixcoder, packed
from ratewise.llm.pretokens import word_pieces

BLOCK = 4096
#: Text encoded at a time: the library is asked for all new words at once.
CHUNK_BYTES = 1 << 20
#: Blocks coded side by side; each needs about 50 KB of models.
LANES = 1536
#: Words remembered by each Python worker; a full memory is emptied.
REMEMBERED = 400_000
SCHEMA = (
    "part int, block int, first long, n_ids int, ids_crc32 long, code binary, "
    "documents array<struct<number:long,doc_id:long,at:int,n_ids:int,begins:boolean,ends:boolean>>"
)
#: Normal forms and lower case leave all but these as single code points, one by one.
_UNUSUAL = re.compile("[İ̀-\U0010ffff]|<\\|")


class WordTokenizer:
    """The tokenizers library, asked once for each word.

    Its pipeline treats words alone, so the ids of a text are those of its words in a
    row. Texts with characters that its normalizer may join, or with strings of
    special tokens, are handed over whole.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.known: dict[str, tuple[int, ...]] = {}
        self.by_word = self._by_word()

    def _by_word(self) -> bool:
        """Whether the file's pipeline is the one that ``word_pieces`` knows."""
        sample = "Don't  stop\tÉté 12,5 -- it's x\n"
        whole = self.library.encode(sample, add_special_tokens=False)
        pieces = word_pieces(sample.lower())
        alone = [self.library.encode(p, add_special_tokens=False).ids for p in pieces]
        return whole.ids == list(chain.from_iterable(alone))

    def _learn(self, words: list[str]) -> None:
        for start in range(0, len(words), 5000):
            some = words[start : start + 5000]
            found = self.library.encode(" ".join(some), add_special_tokens=False)
            ids, word = found.ids, np.array(found.word_ids, np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(word)) + 1).tolist(), len(ids)]
            own = [tuple(ids[a:b]) for a, b in pairwise(cuts)] if some else []
            self.known.update(zip(some, own, strict=True))

    def encode(self, texts: list[str]) -> list[list[int]]:
        parted = [
            word_pieces(t.lower()) if self.by_word and not _UNUSUAL.search(t) else None
            for t in texts
        ]
        needed = set().union(*[p for p in parted if p is not None])
        if len(self.known) + len(needed) > REMEMBERED:
            self.known.clear()
        self._learn(sorted(needed - self.known.keys()))
        known = self.known.__getitem__
        return [
            self.library.encode(text, add_special_tokens=False).ids
            if pieces is None
            else list(chain.from_iterable(map(known, pieces)))
            for text, pieces in zip(texts, parted, strict=True)
        ]


@functools.cache
def loaded(path: str) -> WordTokenizer:
    """The tokenizer of a file, read once by each Python worker."""
    return WordTokenizer(path)


def _blocks_of(documents: Iterator[tuple[int | None, list[int]]]) -> Iterator[tuple[np.ndarray, list[dict]]]:
    """Ids in blocks, with the parts of documents in each."""
    ids, parts = [], []
    for number, (doc_id, own) in enumerate(documents):
        begin = 0
        while begin < len(own):
            taken = own[begin : begin + BLOCK - len(ids)]
            parts.append(
                {"number": number, "doc_id": doc_id, "at": len(ids), "n_ids": len(taken),
                 "begins": begin == 0, "ends": begin + len(taken) == len(own)}
            )
            ids += taken
            begin += len(taken)
            if len(ids) == BLOCK:
                yield np.array(ids), parts
                ids, parts = [], []
    if ids:
        yield np.array(ids), parts


def _id_bytes(ids: np.ndarray) -> bytes:
    return ids.astype("<u4").tobytes()


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Write the token-id file of ``docs``; ``tokenizer`` is readable on each executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = loaded(tokenizer), TaskContext.get().partitionId()

        def documents() -> Iterator[tuple[int | None, list[int]]]:
            for batch in batches:
                ids = batch.column("doc_id")
                for start, texts in packed.text_chunks(batch.column("text"), CHUNK_BYTES):
                    found = words.encode([text.decode() for text in texts])
                    for i, own in enumerate(found):
                        yield ids[start + i].as_py(), [*own, end_id]

        held, block, first = [], 0, 0

        def coded() -> pa.RecordBatch:
            nonlocal block, first
            codes = mixcoder.encode([ids for ids, _ in held])
            rows = []
            for (ids, parts), code in zip(held, codes, strict=True):
                rows.append(
                    {"part": part, "block": block, "first": first, "n_ids": len(ids),
                     "ids_crc32": zlib.crc32(_id_bytes(ids)), "code": code, "documents": parts}
                )
                block, first = block + 1, first + len(ids)
            held.clear()
            return pa.RecordBatch.from_pylist(rows, schema=_arrow_schema())

        for found in _blocks_of(documents()):
            held.append(found)
            if len(held) == LANES:
                yield coded()
        if held:
            yield coded()

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    sorted_docs = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_docs.mapInArrow(run, SCHEMA).write.parquet(path)


def _arrow_schema() -> pa.Schema:
    part = pa.struct(
        [("number", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int32()), ("n_ids", pa.int32()),
         ("begins", pa.bool_()), ("ends", pa.bool_())]
    )
    return pa.schema(
        [("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int32()),
         ("ids_crc32", pa.int64()), ("code", pa.binary()),
         ("documents", pa.list_(part))]
    )


def decoded_blocks(batch: pa.RecordBatch) -> Iterator[tuple[dict, np.ndarray]]:
    """Header and ids of each block; a block that fails its checksum raises."""
    for start in range(0, batch.num_rows, LANES):
        rows = batch.slice(start, LANES).to_pylist()
        codes, lengths = [r["code"] for r in rows], [r["n_ids"] for r in rows]
        for row, ids in zip(rows, mixcoder.decode(codes, lengths), strict=True):
            if zlib.crc32(_id_bytes(ids)) != row["ids_crc32"]:
                raise ValueError(f"block {row['block']} of part {row['part']} is damaged")
            yield row, ids


def read(spark: SparkSession, path: str) -> DataFrame:
    """(part, number, doc_id, first, begins, ends, ids) of the part of each document in
    each block; ``first`` counts the ids of the partition before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, ids in decoded_blocks(batch):
                for d in row["documents"]:
                    out.append(
                        {"part": row["part"], "number": d["number"], "doc_id": d["doc_id"],
                         "first": row["first"] + d["at"], "begins": d["begins"], "ends": d["ends"],
                         "ids": ids[d["at"] : d["at"] + d["n_ids"]].astype("<u4").tobytes()}
                    )
                if len(out) > 2000:
                    yield pa.RecordBatch.from_pylist(out, schema=_piece_schema())
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_piece_schema())

    schema = "part int, number long, doc_id long, first long, begins boolean, ends boolean, ids binary"
    return spark.read.schema(SCHEMA).parquet(path).mapInArrow(run, schema)


def _piece_schema() -> pa.Schema:
    return pa.schema(
        [("part", pa.int32()), ("number", pa.int64()), ("doc_id", pa.int64()), ("first", pa.int64()),
         ("begins", pa.bool_()), ("ends", pa.bool_()), ("ids", pa.binary())]
    )


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, start): the ids of all partitions before each; a row for each file."""
    totals = spark.read.schema(SCHEMA).parquet(path).groupBy("part").agg(F.sum("n_ids").alias("n"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("start"))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    whole = F.col("begins") & F.col("ends")
    pieces = read(spark, path).select(
        "part", "number", "doc_id", "first",
        F.expr("CAST(octet_length(ids) / 4 AS BIGINT)").alias("n"),
        F.when(whole, F.crc32("ids")).alias("crc"),
        F.when(~whole, F.struct("first", "ids")).alias("piece"),
    )
    parts = F.array_sort(F.collect_list("piece"))
    joined = F.aggregate(parts, F.lit(b""), lambda ids, piece: F.concat(ids, piece["ids"]))
    documents = pieces.groupBy("part", "number").agg(
        F.min("doc_id").alias("doc_id"),
        F.min("first").alias("first"),
        F.sum("n").alias("n_tokens"),
        F.coalesce(F.max("crc"), F.crc32(joined)).alias("ids_crc32"),
    )
    return documents.join(part_starts(spark, path), "part").select(
        "doc_id", (F.col("start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )
