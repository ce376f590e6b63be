"""Periodic runs of words, found by internal pattern matching.

A run is a longest stretch of consecutive words with smallest period q that holds q at
least four times and six words at least. For each B = 2, 4, 8, ... a text is laid out in
dyadic blocks of B words. A run with B / 2 < q <= B holds a whole block, and that block
occurs again q words behind it or q words before it: so for every block the occurrences
that begin in the B places before and behind it are looked up. They form a progression,
and its difference is the only candidate for a period there.

The lookups are range successor queries: a suffix array (prefix doubling, all texts of a
chunk at once, so its steps give the interval of every block) and a wavelet matrix over
it, of the suffixes only whose first two words occur twice in their text. Candidates of
one period that share a period's length are one stretch; each is extended word by word
as far as its period holds, which is at most two blocks each way.

Everything happens within one text, so rows are never shuffled: tasks take a fraction of
a megabyte of whole texts at a time and memory follows the longest text. Null, empty and
blank texts have no words and no runs. Repeated rows are kept, each with its result; a
null id is kept. Other columns are ignored, whatever their names. An empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import from_arrow_schema

from ratewise.llm import packed

#: A run holds its period so often, and so many words, at least.
EXPONENT = 4
LEAST_WORDS = 6
#: Words compared at a time when stretches are extended.
COMPARED = 1 << 20


class WaveletMatrix:
    """Order statistics of ranges of an array of numbers, by bits from the highest on."""

    def __init__(self, values: np.ndarray):
        self.bits = max(int(values.max(initial=0)).bit_length(), 1)
        self.zeros: list[np.ndarray] = []
        for bit in range(self.bits - 1, -1, -1):
            low = (values >> bit) & 1 == 0
            self.zeros.append(np.concatenate([[0], np.cumsum(low)]).astype(np.int32))
            values = np.concatenate([values[low], values[~low]])

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of each range are below its bound."""
        count = np.zeros(len(low), np.int64)
        past = bound >> self.bits > 0
        count[past] = (high - low)[past]
        open_ = ~past
        low, high = low.copy(), high.copy()
        for level, zeros in enumerate(self.zeros):
            one = (bound >> (self.bits - 1 - level)) & 1 == 1
            a, b = zeros[low], zeros[high]
            count += np.where(one & open_, b - a, 0)
            low = np.where(one, zeros[-1] + low - a, a)
            high = np.where(one, zeros[-1] + high - b, b)
        return count

    def ordered(self, low: np.ndarray, high: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The value at a place, from 0, of each range in ascending order."""
        value = np.zeros(len(low), np.int64)
        low, high, place = low.copy(), high.copy(), place.copy()
        for zeros in self.zeros:
            a, b = zeros[low], zeros[high]
            one = place >= b - a
            value = value * 2 + one
            place -= np.where(one, b - a, 0)
            low = np.where(one, zeros[-1] + low - a, a)
            high = np.where(one, zeros[-1] + high - b, b)
        return value

    def successor(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The least value of each range that is ``bound`` or more; -1 if there is none."""
        place = self.below(low, high, bound)
        found = np.full(len(low), -1, np.int64)
        some = np.flatnonzero(place < high - low)
        found[some] = self.ordered(low[some], high[some], place[some])
        return found


@dataclass(frozen=True)
class Blocks:
    """Aligned blocks of one size whose words occur again in their text: where each
    begins, and the interval of the suffixes that begin with it."""

    size: int
    start: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted order of keys, and for each place the first and behind the last of its group."""
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    edge = np.ones(len(key), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=edge[1:])
    first = np.flatnonzero(edge)
    sizes = np.diff(np.append(first, len(key)))
    low = np.repeat(first, sizes)
    return order, low, low + np.repeat(sizes, sizes)


def suffixes(
    words: np.ndarray, begin: np.ndarray, end: np.ndarray
) -> tuple[np.ndarray, np.ndarray, list[Blocks]]:
    """Suffix array of texts, where in it suffixes share their first two words with
    others, and the dyadic blocks that occur in it more than once.

    ``words`` are the numbers of all words, ``begin`` and ``end`` the bounds of the text
    that each belongs to. Suffixes are sorted text by text, so a block meets only its own
    text, and as far only as some run may reach.
    """
    n = len(words)
    widest = int((end - begin).max(initial=0))
    following = np.full(n, -1, np.int64)
    inner = np.flatnonzero(np.arange(1, n + 1) < end)
    following[inner] = words[inner + 1]
    span = int(words.max(initial=0)) + 2
    text = np.cumsum(np.arange(n) == begin)
    order, low, high = _groups((text * span + words) * span + following + 1)
    suffix = order.copy()
    rank = np.empty(n, np.int64)
    rank[order] = low
    repeated = high - low > 1
    shared = np.flatnonzero(repeated)  # places in the suffix array, not words
    found, size = [], 2
    while len(shared) and 2 * size < widest:
        at, low_, high_ = suffix[shared], low[shared], high[shared]
        aligned = (at - begin[at]) % size == 0
        found.append(Blocks(size, at[aligned], low_[aligned], high_[aligned]))
        behind = at + size
        inside = behind < end[at]
        next_rank = np.where(inside, rank[np.where(inside, behind, 0)], -1)
        key = low_ * (n + 1) + next_rank + 1
        order, first, last = _groups(key)
        # groups keep their places, so the sorted members fill the same places again
        suffix[shared] = at[order]
        low[shared], high[shared] = shared[first], shared[first] + (last - first)
        rank[at[order]] = low[shared]
        shared = shared[last - first > 1]
        size *= 2
    return suffix, repeated, found


def _merged(
    size: int, start: np.ndarray, stop: np.ndarray, period: np.ndarray, text: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One stretch for all of one text and period that overlap by a period or more."""
    order = np.lexsort((start, period, text))
    start, stop, period, text = start[order], stop[order], period[order], text[order]
    new = np.ones(len(start), bool)
    # stretches of one period and block size are of one length: stops ascend as well
    new[1:] = (
        (text[1:] != text[:-1]) | (period[1:] != period[:-1])
        | (start[1:] + period[1:] > stop[:-1])
    )
    first = np.flatnonzero(new)
    return start[first], stop[np.append(first[1:], len(start)) - 1], period[first]


def _reach(equal: Callable[[np.ndarray, np.ndarray], np.ndarray], count: int, most: int) -> np.ndarray:
    """How many steps in a row are equal, up to ``most``, for each of ``count`` stretches."""
    reach = np.zeros(count, np.int64)
    rows = max(COMPARED // max(most, 1), 1)
    steps = np.arange(most)
    for i in range(0, count, rows):
        part = np.arange(i, min(i + rows, count))
        same = equal(part[:, None], steps[None, :])
        reach[part] = np.where(same.all(axis=1), most, same.argmin(axis=1))
    return reach


def runs(words: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, period) of every run of every text, in the order of start and period."""
    n = len(words)
    suffix, repeated, found = suffixes(words, begin, end)
    empty = (np.zeros(0, np.int64),) * 3
    if not any(len(blocks.start) for blocks in found):
        return empty
    # intervals of blocks hold no other suffixes than these; their places are renumbered
    index = np.concatenate([[0], np.cumsum(repeated)])
    places = np.sort(suffix[repeated])
    matrix = WaveletMatrix(np.searchsorted(places, suffix[repeated]))

    def occurrence(low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Where the next occurrence of each block begins, from ``bound`` on; far off if nowhere."""
        value = matrix.successor(index[low], index[high], np.searchsorted(places, bound))
        return np.where(value >= 0, places[value], 3 * n)

    results = []
    for blocks in found:
        size, at, low, high = blocks.size, blocks.start, blocks.low, blocks.high
        behind = occurrence(low, high, at + 1)
        near = behind - at <= size
        stretches = [(at[near], behind[near] + size, (behind - at)[near])]
        before = occurrence(low, high, np.maximum(at - size, begin[at]))
        some = np.flatnonzero(before < at)
        second = occurrence(low[some], high[some], before[some] + 1)
        # all occurrences from there to the block are one progression, which ends in it
        stretches.append((before[some], at[some] + size, second - before[some]))
        start, stop, period = (np.concatenate(x) for x in zip(*stretches, strict=True))
        if not len(start):
            continue
        # a progression of more than two is cut into stretches of equal length
        start = np.maximum(start, stop - size - period)
        start, stop, period = _merged(size, start, stop, period, begin[start])
        text_begin, text_end = begin[start], end[start]

        def right(row: np.ndarray, step: np.ndarray) -> np.ndarray:
            place = stop[row] + step
            inside = place < text_end[row]
            place = np.where(inside, place, stop[row] - 1)
            return inside & (words[place] == words[place - period[row]])

        def left(row: np.ndarray, step: np.ndarray) -> np.ndarray:
            place = start[row] - 1 - step
            inside = place >= text_begin[row]
            place = np.where(inside, place, start[row])
            return inside & (words[place] == words[place + period[row]])

        most = 3 * size
        stop = stop + _reach(right, len(start), most)
        start = start - _reach(left, len(start), most)
        whole = stop - start >= np.maximum(LEAST_WORDS, EXPONENT * period)
        results.append((start[whole], stop[whole], period[whole]))
    if not results:
        return empty
    start, stop, period = (np.concatenate(x) for x in zip(*results, strict=True))
    order = np.lexsort((period, stop, start))
    start, stop, period = start[order], stop[order], period[order]
    least = np.ones(len(start), bool)  # of one stretch the smallest period
    least[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    start, stop, period = start[least], stop[least], period[least]
    order = np.lexsort((period, start))
    return start[order], stop[order], period[order]


Change = Callable[[object, list[bytes]], list[bytes]]

#: Of each row: its runs, the longest of them, digests, and the text without repeats.
COLUMNS = {
    "doc_id": pa.int64(), "n_runs": pa.int64(), "start": pa.int64(), "length": pa.int64(),
    "period": pa.int64(), "exponent_milli": pa.int64(), "runs_sha256": pa.string(),
    "collapsed_sha256": pa.string(), "collapsed": pa.string(),
}


def text_runs(ids: list, texts: list[list[bytes]]) -> Iterator[tuple]:
    """A row of ``COLUMNS`` for each text, given as its words."""
    numbers: dict[bytes, int] = {}
    counts = np.fromiter(map(len, texts), np.int64, len(texts))
    words = np.fromiter(
        (numbers.setdefault(word, len(numbers)) for text in texts for word in text),
        np.int64, int(counts.sum()),
    )
    ends = np.cumsum(counts)
    begins = ends - counts
    starts, stops, periods = runs(words, np.repeat(begins, counts), np.repeat(ends, counts))
    first = np.searchsorted(starts, begins)
    last = np.searchsorted(starts, ends)
    for doc_id, text, base, a, b in zip(ids, texts, begins.tolist(), first.tolist(), last.tolist(), strict=True):
        found = [
            (start - base, stop - start, period)
            for start, stop, period in zip(starts[a:b].tolist(), stops[a:b].tolist(), periods[a:b].tolist(), strict=True)
        ]
        kept = text
        if found:
            edges = np.zeros(len(text) + 1, np.int64)
            for start, length, period in found:
                edges[start + period] += 1
                edges[start + length] -= 1
            kept = [text[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]
        longest = max(found, key=lambda run: (run[1], -run[0], -run[2]), default=None)
        listed = "".join(f"{start},{length},{period}\n" for start, length, period in found)
        collapsed = b" ".join(kept)
        yield (
            doc_id, len(found), *(longest or (None,) * 3),
            1000 * longest[1] // longest[2] if longest else None,
            hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(collapsed).hexdigest(),
            collapsed.decode(),
        )


def periodic_runs(docs: DataFrame, change: Change | None = None, with_text: bool = True) -> DataFrame:
    """The runs of every row of ``docs`` (doc_id, text): how many, the longest, and a digest
    of all; and the text without the words that runs repeat, their digest too.

    A word is dropped if any run holds it behind its first period. ``change`` may replace
    the words of a text by others, given the id. Without ``with_text`` only the digest of
    the collapsed text is returned.
    """
    kinds = pa.schema([c for c in COLUMNS.items() if with_text or c[0] != "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in packed.text_chunks(batch.column("text")):
                ids = batch.column("doc_id").slice(row, len(texts)).to_pylist()
                words = [text.split() for text in texts]  # of bytes: ASCII white space only
                if change:
                    words = [change(key, text) for key, text in zip(ids, words, strict=True)]
                columns = zip(*text_runs(ids, words), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(columns, kinds.types)], schema=kinds
                )

    return docs.select("doc_id", "text").mapInArrow(run, from_arrow_schema(kinds))
