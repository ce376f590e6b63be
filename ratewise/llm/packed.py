"""Token hashing over the UTF-8 bytes of many texts at once, in numpy.

Tasks work on a fraction of a megabyte of text at a time, whatever the size of the Arrow
batch. One text is never cut, so memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK_BYTES = 1 << 18
SPACE, WORD, MARK = 0, 1, 2

_random = np.random.default_rng(20240607)
BYTE_VALUES = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_VALUES[65:91] = BYTE_VALUES[97:123]  # A-Z count as a-z
_POWERS = np.cumprod(np.full(65536, 0x9E3779B97F4A7C15 | 1, np.uint64))


def _byte_classes() -> np.ndarray:
    """White space, word bytes (digits, letters, all beyond ASCII) and marks."""
    kinds = np.full(256, MARK, np.uint8)
    kinds[[9, 10, 11, 12, 13, 32]] = SPACE
    kinds[48:58] = kinds[65:91] = kinds[97:123] = kinds[128:] = WORD
    return kinds


BYTE_CLASSES = _byte_classes()
#: Everything between white space is one token.
SPACED_CLASSES = (BYTE_CLASSES != SPACE).astype(np.uint8)
#: Words only, marks part them.
WORD_CLASSES = (BYTE_CLASSES == WORD).astype(np.uint8)


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """The texts of a string column as UTF-8, in runs of about ``limit`` bytes.

    Yields the first row of each run and its texts; a null text is empty.
    """
    start, size, run = 0, 0, []
    for row, text in enumerate(column.cast(pa.large_binary())):
        value = text.as_py() or b""
        if run and size + len(value) > limit:
            yield start, run
            start, size, run = row, 0, []
        run.append(value)
        size += len(value) + 1
    if run:
        yield start, run


def pack(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, each followed by a space, and where each begins."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return data, np.concatenate([[0], np.cumsum(lengths)])


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all their bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class Tokens:
    """Runs of bytes of one class: place, class, text number and 64-bit hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, classes: np.ndarray = BYTE_CLASSES):
        kind = classes[data]
        edge = np.empty(len(data), bool)
        edge[0] = True
        np.not_equal(kind[1:], kind[:-1], out=edge[1:])
        runs = np.flatnonzero(edge)
        ends = np.append(runs[1:], len(data))
        place = np.arange(len(data)) - np.repeat(runs, ends - runs)
        value = BYTE_VALUES[data] * _POWERS[place & 65535]
        run_kind = kind[runs]
        kept = run_kind != SPACE
        self.kind = run_kind[kept]
        self.start, self.end = runs[kept], ends[kept]
        self.hash = mixed(np.add.reduceat(value, runs)[kept])
        self.count = np.diff(np.searchsorted(self.start, offsets))
        self.text = np.repeat(np.arange(len(offsets) - 1), self.count)

    def __len__(self) -> int:
        return len(self.start)


def paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One hash for two hashes in order."""
    return mixed(left * np.uint64(0xD6E8FEB86659FD93) + right)


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each run of values; runs follow each other and may be empty."""
    out = np.zeros(len(counts))
    full = counts > 0
    if full.any():
        out[full] = np.add.reduceat(values, (np.cumsum(counts) - counts)[full], dtype=np.float64)
    return out


def kept_rows(docs: DataFrame, keep: Callable[[list[bytes]], np.ndarray]) -> DataFrame:
    """The rows of ``docs``, all columns, whose text ``keep`` says to keep."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [keep(texts) for _, texts in text_chunks(batch.column("text"))]
            if kept:
                yield batch.filter(pa.array(np.concatenate(kept)))

    return docs.mapInArrow(run, docs.schema)


def scored_rows(docs: DataFrame, score: Callable[[list[bytes]], np.ndarray]) -> DataFrame:
    """(doc_id, score) of every row; ``score`` is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(score)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_chunks(batch.column("text")):
                ids = batch.column("doc_id").slice(start, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(shared.value(texts), pa.float64())], ["doc_id", "score"]
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
