"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over a few words in a row that ignores some positions. The
hashes of all seeds of the benchmark are joined with those of the documents, so a
substituted word at an ignored position does not hide an overlap. Around each hit
the two texts are laid side by side and compared word by word.

A document overlaps an item where ``window`` words in a row (or a whole shorter
item) agree in all but a fifth of the words. The two masks find every such window,
wherever its substitutions are: there is no text that only chance would find.

Words are runs of letters, digits and characters beyond ASCII; case does not count.
Items of less than ``SHORTEST_ITEM`` words overlap where all their words stand in a row,
found by one hash of the whole item, if ``shortest`` lets them take part; they do not
unless told to: few words in common are no reason to drop a document. Items of five to
seven words must agree in every word. Null and empty texts overlap nothing; very long texts are
taken whole, and memory follows the longest. Null item ids are items of their
own. Repeated documents each get their rows, repeated items (same id and text) one.
Extra columns of the inputs are ignored. An empty benchmark or document
table gives no overlaps. A benchmark of several blocks is gone through block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm import packed

#: Offsets of the words that a seed looks at. These two hit every window of 8 to 16
#: words with a fifth of its words substituted (tests try all patterns). Shorter
#: items must agree in every word.
MASKS = ((0, 1, 2, 4), (0, 1, 4, 5))
WINDOW = 16
SHORTEST_ITEM = 5
#: Benchmark texts are taken in blocks of about so many bytes; tasks hold one block.
BLOCK_BYTES = 16_000_000
FILTER_BITS = 22
SCHEMA = "doc_id long, item_id long, start int, item_start int, words int, matched int"

_FACTORS = packed.mixed(np.arange(1, 32, dtype=np.uint64)) | np.uint64(1)


def folded(texts: list[bytes]) -> list[bytes]:
    """Texts in lower case; ASCII letters are equal in either case when hashed."""
    return [t if t.isascii() else t.decode().lower().encode() for t in texts]


def tolerated(width: int) -> int:
    """Words of a window that may differ."""
    return width // 5 if width >= 8 else 0


def seed_hashes(words: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """The hash of the seed that begins at each word, as far as the mask fits."""
    count = max(0, len(words) - mask[-1])
    total = np.zeros(count, np.uint64)
    for k, offset in enumerate(mask):
        total += words[offset : offset + count] * _FACTORS[k]
    return packed.mixed(total)


class BenchmarkBlock:
    """Words and sorted seed hashes of a bounded number of items."""

    def __init__(self, items: list[tuple[int | None, bytes]], window: int = WINDOW, shortest: int = 1):
        self.window = window
        data, offsets = packed.pack(folded([text for _, text in items]))
        words = packed.Tokens(data, offsets, packed.WORD_CLASSES)
        self.ids = [item for item, _ in items]
        self.words = words.hash
        self.count = words.count
        self.first = np.cumsum(words.count) - words.count
        seeded = [(mask, words.count >= max(SHORTEST_ITEM, shortest)) for mask in MASKS]
        # a short item is one seed that looks at all of its words
        seeded += [(tuple(range(n)), words.count == n) for n in range(max(shortest, 1), SHORTEST_ITEM)]
        self.seeds = []
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        for mask, allowed in seeded:
            if not allowed.any():
                continue
            h = seed_hashes(words.hash, mask)
            at = np.arange(len(h))
            whole = (words.text[at] == words.text[at + mask[-1]]) & allowed[words.text[at]]
            h, at = h[whole], at[whole]
            order = np.argsort(h, kind="stable")
            self.seeds.append((mask, h[order], at[order], words.text[at[order]]))
            self.filter[h >> np.uint64(64 - FILTER_BITS)] = True

    def hits(self, words: packed.Tokens) -> np.ndarray:
        """Distinct (text, item, shift) rows where a seed of a text meets one of an item.

        The shift is the place in the text less the place in the item.
        """
        found = [np.zeros((0, 3), np.int64)]
        first = np.cumsum(words.count) - words.count
        for mask, hashes, places, items in self.seeds:
            h = seed_hashes(words.hash, mask)
            at = np.flatnonzero(self.filter[h >> np.uint64(64 - FILTER_BITS)])
            at = at[words.text[at] == words.text[at + mask[-1]]]
            low, high = np.searchsorted(hashes, h[at]), np.searchsorted(hashes, h[at], "right")
            each = high - low
            text = np.repeat(words.text[at], each)
            place = np.repeat(at - first[words.text[at]], each)
            seed = np.repeat(low, each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            item = items[seed]
            found.append(np.stack([text, item, place - (places[seed] - self.first[item])], axis=1))
        return np.unique(np.concatenate(found), axis=0)

    def overlaps(self, texts: list[bytes]) -> list[tuple[int, int | None, int, int, int, int]]:
        """(text, item id, start, item start, words, matched) of each overlap.

        Starts count words from 0; the span runs from the first to the last window
        of one alignment that agrees well enough.
        """
        data, offsets = packed.pack(folded(texts))
        words = packed.Tokens(data, offsets, packed.WORD_CLASSES)
        if not len(words):
            return []
        first = np.cumsum(words.count) - words.count
        out = []
        for text, item, shift in self.hits(words).tolist():
            begin = max(0, shift)
            end = min(int(words.count[text]), shift + int(self.count[item]))
            width = min(self.window, int(self.count[item]))
            if end - begin < width:
                continue
            own = words.hash[first[text] + begin : first[text] + end]
            other = self.first[item] + begin - shift
            same = own == self.words[other : other + end - begin]
            total = np.concatenate([[0], np.cumsum(same)])
            good = np.flatnonzero(total[width:] - total[:-width] >= width - tolerated(width))
            if len(good):
                a, b = int(good[0]), int(good[-1]) + width
                out.append((text, self.ids[item], begin + a, begin - shift + a, b - a,
                            int(total[b] - total[a])))
        return out


def _overlaps_with(docs: DataFrame, block: BenchmarkBlock) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for start, texts in packed.text_chunks(batch.column("text")):
                rows = shared.value.overlaps(texts)
                columns = list(zip(*rows, strict=True)) or [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array([start + i for i in columns[0]], pa.int64())),
                        pa.array(columns[1], pa.int64()),
                        *[pa.array(c, pa.int32()) for c in columns[2:]],
                    ],
                    ["doc_id", "item_id", "start", "item_start", "words", "matched"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int | None, bytes]]]:
    """Items in runs of about ``block_bytes`` of text, one run at a time on the driver."""
    size, run = 0, []
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    for row in items.orderBy("item_id", "text").toLocalIterator():
        text = row["text"].encode()
        if run and size + len(text) > block_bytes:
            yield run
            size, run = 0, []
        run.append((row["item_id"], text))
        size += len(text)
    if run:
        yield run


def overlaps(
    docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, shortest: int = SHORTEST_ITEM
) -> DataFrame:
    """One row for each alignment of a document with a benchmark item that overlaps, of
    items of ``shortest`` words and more.

    The documents are never shuffled: each block of the benchmark, whose size is
    bounded, goes to all tasks. A benchmark of more blocks costs as many scans.
    """
    found = None
    for items in _blocks(benchmark, block_bytes):
        part = _overlaps_with(docs, BenchmarkBlock(items, shortest=shortest))
        found = part if found is None else found.unionAll(part)
    return docs.sparkSession.createDataFrame([], SCHEMA) if found is None else found


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, shortest: int = SHORTEST_ITEM
) -> DataFrame:
    """The rows of ``docs``, all columns, that overlap no benchmark item of ``shortest``
    words and more.

    Rows with null ids are judged by their text like all others.
    """
    for items in _blocks(benchmark, block_bytes):
        docs = _without(docs, BenchmarkBlock(items, shortest=shortest))
    return docs


def _without(docs: DataFrame, block: BenchmarkBlock) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def keep(texts: list[bytes]) -> np.ndarray:
        kept = np.ones(len(texts), bool)
        kept[[row[0] for row in shared.value.overlaps(texts)]] = False
        return kept

    return packed.kept_rows(docs, keep)
