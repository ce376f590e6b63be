"""Tokens and terms of many documents as numbers, for steps that run on Arrow batches.

Tokens are told apart once, by Arrow's dictionary; from there on a unigram is a number and a
bigram a pair of them, so terms are counted by sorting numbers. Only terms that leave a step
become strings again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Tokens numbered at a time; a document is never cut, so memory follows the longest.
CHUNK_TOKENS = 2_000_000


def numbered_chunks(
    batch: pa.RecordBatch, limit: int = CHUNK_TOKENS
) -> Iterator[tuple[pa.RecordBatch, NumberedTokens]]:
    """The rows of ``batch`` in runs of about ``limit`` tokens, with their ``tokens`` numbered.

    A document counts as one token more than it has, so that rows are bounded, too.
    """
    sizes = pc.list_value_length(batch.column("tokens")).to_numpy(zero_copy_only=False)
    upto = np.cumsum(sizes.astype(np.int64) + 1)
    start = 0
    while start < batch.num_rows:
        before = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, before + limit, side="right")))
        some = batch.slice(start, end - start)
        yield some, NumberedTokens(some.column("tokens"))
        start = end


@dataclass
class Counted:
    """Terms of documents, in the order of the documents: ``row`` is a document's place,
    ``code`` the term's number, ``tf`` how often the one holds the other."""

    tokens: NumberedTokens
    pairs: bool
    row: np.ndarray
    code: np.ndarray
    tf: np.ndarray

    def where(self, kept: np.ndarray) -> Counted:
        return Counted(self.tokens, self.pairs, self.row[kept], self.code[kept], self.tf[kept])

    def terms(self) -> pa.Array:
        return self.tokens.terms(self.code, self.pairs)

    def listed(self, values: pa.Array) -> pa.ListArray:
        """``values`` of the terms, a list for each document."""
        ends = np.cumsum(np.bincount(self.row, minlength=self.tokens.rows))
        return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), values)


class NumberedTokens:
    """A column of lists of tokens. Unigrams have the tokens' numbers; a bigram's number is
    that of its first token times ``size`` and that of its second. With ``CHUNK_TOKENS``
    tokens, or one document, documents and bigrams together stay below 2^63."""

    def __init__(self, tokens: pa.ListArray):
        flat = tokens.flatten().dictionary_encode(null_encoding="encode")
        self.rows = len(tokens)
        self.words = flat.dictionary
        self.size = max(1, len(self.words))
        self.code = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        lengths = pc.list_value_length(tokens).fill_null(0).to_numpy(zero_copy_only=False)
        self.row = np.repeat(np.arange(self.rows), lengths)

    def _codes(self, pairs: bool) -> tuple[np.ndarray, np.ndarray, int]:
        """Document and number of each term, and how many numbers there may be."""
        if not pairs:
            return self.row, self.code, self.size
        inside = np.flatnonzero(self.row[1:] == self.row[:-1])
        return self.row[inside], self.code[inside] * self.size + self.code[inside + 1], self.size**2

    def by_document(self, pairs: bool) -> Counted:
        """How often each document holds each of its terms."""
        row, code, size = self._codes(pairs)
        key, tf = _runs(np.sort(row * size + code))
        return Counted(self, pairs, key // size, key % size, tf)

    def over_all(self, pairs: bool) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Each term, how often it occurs, and in how many of the documents."""
        row, code, _ = self._codes(pairs)
        key, tf = _runs(np.sort(code * max(1, self.rows) + row))
        code, df = _runs(key // max(1, self.rows))
        first = np.cumsum(df) - df
        cf = np.add.reduceat(tf, first) if len(first) else df
        return self.terms(code, pairs), cf, df

    def terms(self, code: np.ndarray, pairs: bool) -> pa.Array:
        if not pairs:
            return self.words.take(pa.array(code))
        left, right = (self.words.take(pa.array(part)) for part in (code // self.size, code % self.size))
        return pc.binary_join_element_wise(left, right, " ")


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of a sorted array, and how often each occurs."""
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)])
    return ordered[first], np.diff(np.append(first, len(ordered)))
