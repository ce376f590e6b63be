"""Byte-pair encoding and decoding with a public byte-level vocabulary.

A short word is a row of contiguous arrays: the ids of its parts and the ranks of
the pairs at its inner boundaries. The least rank is searched by scanning the row,
its boundary is deleted, and the two ranks beside it are refreshed, until no pair
has a rank. Words of a text chunk that were not met before go through this side by
side, one matrix for each power of two in length. Words over ``SHORT`` bytes use a
heap, as scanning them would take quadratic time.

Null texts are encoded like empty ones, as no ids, and decoded to the empty text.
Strings of special tokens in a text become their ids. Repeated rows and null ids
are kept. Extra columns of the input are ignored, whatever their names. Very long texts
are encoded whole and memory follows the longest. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import heapq
import json
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ratewise.llm import packed
from ratewise.llm.pretokens import pieces

SHORT = 64
#: Text encoded at a time: new words are merged side by side.
CHUNK_BYTES = 1 << 19
#: Words remembered by each Python worker; a full memory is emptied.
REMEMBERED = 160_000
_NONE = np.int32(2**31 - 1)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabulary files.

    Printable bytes stand for themselves, the others follow from code point 256.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class ByteBpe:
    """Vocabulary, merges and special tokens of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        letters = byte_letters()
        byte_of = {letter: b for b, letter in enumerate(letters)}
        vocabulary: dict[str, int] = model["vocab"]
        special = {t["content"]: t["id"] for t in content["added_tokens"]}
        size = max(chain(vocabulary.values(), special.values())) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in vocabulary.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in token)
        for token, i in special.items():
            self.bytes_of[i] = token.encode()
        self.special = special
        self.special_pattern = regex.compile("|".join(map(regex.escape, special)) or r"(?!)")
        self.single = np.array([vocabulary[letter] for letter in letters], np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocabulary[a] for a, _ in merges], np.int64)
        right = np.array([vocabulary[b] for _, b in merges], np.int64)
        #: By rank: the id that a merge makes.
        self.made = np.array([vocabulary[a + b] for a, b in merges], np.int32)
        keys = left << 32 | right
        order = np.argsort(keys)
        self.keys, self.key_rank = keys[order], order.astype(np.int32)
        first, second = np.meshgrid(self.single, self.single, indexing="ij")
        self.byte_rank = self.ranks(first.ravel(), second.ravel()).reshape(256, 256)
        self.rank_of = dict(zip(keys.tolist(), range(len(keys)), strict=True))
        self.known: dict[str, tuple[int, ...]] = {}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, the largest number where there is no merge."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.key_rank[at], _NONE)

    def merge_short(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of words of similar length, ``SHORT`` bytes at most."""
        width = max(map(len, words))
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8)
        raw = raw.reshape(len(words), width)
        size = np.fromiter(map(len, words), np.int64, len(words))
        parts = self.single[raw]
        rank = np.full((len(words), width), _NONE, np.int32)
        inner = np.arange(1, width) < size[:, None]
        rank[:, :-1] = np.where(inner, self.byte_rank[raw[:, :-1], raw[:, 1:]], _NONE)
        row = np.arange(len(words))
        done: list[tuple[int, ...]] = [()] * len(words)
        column = np.arange(width)
        while len(row):
            line = np.arange(len(row))
            at = rank.argmin(axis=1)
            least = rank[line, at]
            ended = least == _NONE
            if ended.any():
                for i, ids, n in zip(
                    row[ended].tolist(), parts[ended].tolist(), size[ended].tolist(), strict=True
                ):
                    done[i] = tuple(ids[:n])
                live = ~ended
                row, at, least, parts, rank, size = (
                    x[live] for x in (row, at, least, parts, rank, size)
                )
                line = np.arange(len(row))
                if not len(row):
                    break
            # delete the boundary: what lies behind it moves one place forward
            source = np.minimum(column + (column > at[:, None]), width - 1)
            parts = np.take_along_axis(parts, source, axis=1)
            source = np.minimum(column + (column >= at[:, None]), width - 1)
            rank = np.take_along_axis(rank, source, axis=1)
            size = size - 1
            rank[:, -1] = _NONE
            parts[line, at] = self.made[least]
            # refresh the ranks on both sides of the new part
            right = np.flatnonzero(at + 1 < size)
            rank[right, at[right]] = self.ranks(
                parts[right, at[right]], parts[right, at[right] + 1]
            )
            closed = np.flatnonzero(at + 1 >= size)
            rank[closed, at[closed]] = _NONE
            left = np.flatnonzero(at > 0)
            rank[left, at[left] - 1] = self.ranks(parts[left, at[left] - 1], parts[left, at[left]])
        return done

    def merge_long(self, word: bytes) -> tuple[int, ...]:
        """Ids of one word of any length, by a heap of ranked boundaries."""
        parts: list[int] = self.single[np.frombuffer(word, np.uint8)].tolist()
        after = [*range(1, len(parts)), -1]
        before = [*range(-1, len(parts) - 1)]
        rank_of = self.rank_of
        heap = []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else -1
            if j >= 0 and (rank := rank_of.get(parts[i] << 32 | parts[j])) is not None:
                heapq.heappush(heap, (rank, i, parts[i], parts[j]))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue  # one of the two was merged meanwhile
            parts[i], parts[j] = int(self.made[rank]), -1
            after[i] = after[j]
            after[j] = -1
            if after[i] >= 0:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return tuple(p for p in parts if p >= 0)

    def learn(self, words: set[str]) -> None:
        """Remember the ids of words."""
        groups: dict[int, list[str]] = {}
        for word in words:
            size = len(word.encode())
            groups.setdefault(size.bit_length() if size <= SHORT else 0, []).append(word)
        for size, group in groups.items():
            raw = [word.encode() for word in group]
            if size:
                for start in range(0, len(raw), 20_000):
                    part = slice(start, start + 20_000)
                    self.known.update(zip(group[part], self.merge_short(raw[part]), strict=True))
            else:
                self.known.update(zip(group, map(self.merge_long, raw), strict=True))

    def split(self, text: str) -> list[str]:
        """Pieces of a text; strings of special tokens are pieces of their own."""
        found = self.special_pattern.search(text)
        if found is None:
            return pieces(text)
        out, start = [], 0
        for found in self.special_pattern.finditer(text):
            out += [*pieces(text[start : found.start()]), found[0]]
            start = found.end()
        return out + pieces(text[start:])

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        parted = [self.split(text) for text in texts]
        needed = set().union(*parted) - self.special.keys()
        if len(self.known) + len(needed) > REMEMBERED:
            self.known.clear()
        self.learn(needed - self.known.keys())
        known = self.known
        if any(token in part for token in self.special for part in parted):
            known = known | {token: (i,) for token, i in self.special.items()}
        return [list(chain.from_iterable(map(known.__getitem__, part))) for part in parted]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@functools.cache
def loaded(path: str) -> ByteBpe:
    """The tokenizer of a file, read once by each Python worker."""
    return ByteBpe(path)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every row; ``path`` must be readable on each executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            for start, texts in packed.text_chunks(batch.column("text"), CHUNK_BYTES):
                found = bpe.encode([text.decode() for text in texts])
                ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
                flat = np.fromiter(chain.from_iterable(found), np.int32, ends[-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, len(texts)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    ],
                    ["doc_id", "ids"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text) of rows of (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = [bpe.decode(ids or []) for ids in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("ids"), pa.array(texts, pa.string())],
                    ["doc_id", "ids", "text"],
                )

    schema = "doc_id long, ids array<int>, text string"
    return rows.select("doc_id", "ids").mapInArrow(run, schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoding and decoding every row.

    One Python process per task does both, so neither ids nor texts travel back.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        decimal = [str(i) for i in range(len(bpe.bytes_of))].__getitem__
        for batch in batches:
            for start, texts in packed.text_chunks(batch.column("text"), CHUNK_BYTES):
                sizes, listed, decoded_texts = [], [], []
                for ids in bpe.encode([text.decode() for text in texts]):
                    sizes.append(len(ids))
                    listed.append(sha256(",".join(map(decimal, ids)).encode()).hexdigest())
                    decoded_texts.append(sha256(bpe.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, len(texts)),
                        pa.array(sizes, pa.int64()),
                        pa.array(listed, pa.string()),
                        pa.array(decoded_texts, pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
