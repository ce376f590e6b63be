"""Toxicity: averaged subword embeddings under a linear softmax, learned in numpy.

A word is a bag of itself and its n-grams of 3 to 6 bytes, word edges included, so
a misspelt or never seen word shares vectors with its relatives. The vectors of a
text's distinct subwords are averaged, the mean is scaled by the root of their
number (else long texts drown their few telling words), and goes into a two-class
softmax; vectors and softmax are trained jointly.

A text without words (null, empty, marks only) has a zero mean vector: its score is
the softmax of the bias. Without labelled rows of both classes every score is 0.5.
Repeated rows are scored alike, and of each sampled id one row is learned from. Extra
columns of the input are ignored, whatever their names. Very long texts are taken whole
and memory follows the longest. An empty document table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ratewise.llm import packed
from ratewise.llm.labelled import training_sample

#: Labelled documents of each class that may be learned from.
SAMPLE_PER_CLASS = 1500
BUCKET_BITS = 19
SHORTEST, LONGEST = 3, 6

_VALUES = (packed.BYTE_VALUES >> np.uint64(32)).astype(np.uint32)
_VALUES[packed.WORD_CLASSES == 0] = 0x5BD1E995  # all that is no word byte is an edge
_FACTORS = np.cumprod(np.full(LONGEST, 0x01000193, np.uint32), dtype=np.uint32)


def subwords(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of the words and n-grams of each text in turn, and their number.

    An n-gram holds two word bytes at least and no edge but at its ends.
    """
    data, offsets = packed.pack([b" " + text for text in texts])  # an edge of its own
    size = len(data)
    words = packed.Tokens(data, offsets, packed.WORD_CLASSES)
    found = [(words.hash >> np.uint64(64 - BUCKET_BITS)).astype(np.uint32)]
    where = [words.start]
    value = _VALUES[data]
    inside = packed.WORD_CLASSES[data]
    seen = np.concatenate([[0], np.cumsum(inside, dtype=np.int32)])
    rolling = value * _FACTORS[0]
    for n in range(2, LONGEST + 1):
        if n > size:
            break
        rolling = rolling[:-1] + value[n - 1 :] * _FACTORS[n - 1]
        if n < SHORTEST:
            continue
        whole = seen[n - 1 : size] - seen[1 : size - n + 2] == n - 2
        whole &= inside[: size - n + 1] + inside[n - 1 :] + (n - 2) >= 2
        at = np.flatnonzero(whole)
        h = rolling[at] * np.uint32(0x9E3779B1 + 2 * n)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA77)
        found.append(h >> np.uint32(32 - BUCKET_BITS))
        where.append(at)
    cuts = [np.searchsorted(at, offsets) for at in where]
    last = np.zeros(2**BUCKET_BITS, np.int32)
    bags = []
    for i in range(len(texts)):
        pairs = zip(found, cuts, strict=True)
        bag = np.concatenate([run[cut[i] : cut[i + 1]] for run, cut in pairs])
        order = np.arange(len(bag), dtype=np.int32)
        last[bag] = order  # of equal buckets the last one stays
        bags.append(bag[last[bag] == order])
    return np.concatenate(bags), np.fromiter(map(len, bags), np.int64, len(bags))


@dataclass
class SubwordSoftmax:
    """Joint training of subword vectors and a two-class softmax.

    Stochastic gradient steps that shrink from pass to pass; both classes weigh alike.
    """

    dimensions: int = 8
    rate: float = 2.0
    passes: int = 4
    seed: int = 7

    def fit(self, rows: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, float]:
        """What each bucket adds to the log odds of toxic, and the bias.

        The softmax is linear in the mean vector, so the product of a vector with
        the difference of the two class vectors is all that scoring needs.
        """
        rng = np.random.default_rng(self.seed)
        size = 2**BUCKET_BITS
        vectors = rng.uniform(-1, 1, (size, self.dimensions)).astype(np.float32) / self.dimensions
        classes = rng.uniform(-1, 1, (2, self.dimensions))
        bias = np.zeros(2)
        class_sum, bias_sum = np.full((2, 1), 1e-6), 1e-6
        toxic = sum(y for _, y in rows)
        weight = (len(rows) / 2 / (len(rows) - toxic), len(rows) / 2 / toxic)
        for turn in range(self.passes):
            rate = self.rate * (1 - turn / self.passes)
            for i in rng.permutation(len(rows)):
                at, y = rows[i]
                share = 1 / np.sqrt(max(1, len(at)))
                own = vectors[at]
                mean = own.sum(axis=0) * share
                logits = classes @ mean + bias
                error = np.exp(logits - logits.max())
                error /= error.sum()
                error[y] -= 1
                error *= weight[y]
                vectors[at] = own - (rate * share * (error @ classes)).astype(np.float32)
                gradient = np.outer(error, mean)
                class_sum += (gradient**2).sum(axis=1, keepdims=True)
                classes -= 0.1 * gradient / np.sqrt(class_sum)
                bias_sum += error @ error
                bias -= 0.1 * error / np.sqrt(bias_sum)
        return (vectors @ (classes[1] - classes[0])).astype(np.float32), float(bias[1] - bias[0])


def _sparse_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        label = batch.column("label").to_pylist()
        ids = batch.column("doc_id").to_pylist()
        for start, texts in packed.text_chunks(batch.column("text")):
            grams, counts = subwords(texts)
            bags = np.split(grams.astype(np.int32), np.cumsum(counts)[:-1])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(ids[start : start + len(texts)], pa.int64()),
                    "label": pa.array(label[start : start + len(texts)], pa.int32()),
                    "bag": pa.array([np.sort(bag).tobytes() for bag in bags], pa.binary()),
                }
            )


Model = tuple[np.ndarray, float]


def train(
    docs: DataFrame, labels: DataFrame, label: str, held_out, per_class: int = SAMPLE_PER_CLASS
) -> Model | None:
    """A model learned from ``per_class`` labelled documents of each class at most.

    All of them are held on the driver as distinct subwords, however long they are.
    ``held_out`` is a column of the label table; rows where it holds are not
    learned from. ``None`` if one class has no rows.
    """
    sample = training_sample(docs, labels, label, per_class, held_out)
    sparse = sample.select("doc_id", "text", sample["label"].cast("int").alias("label"))
    sparse = sparse.mapInArrow(_sparse_rows, "doc_id long, label int, bag binary")
    rows = [
        (np.frombuffer(row["bag"], np.int32), row["label"])
        for row in sparse.orderBy("doc_id").toLocalIterator()
    ]
    if len({y for _, y in rows}) < 2:
        return None
    return SubwordSoftmax().fit(rows)


class Scorer:
    """Scores of texts by a fixed model, which travels with the tasks (2 MB)."""

    def __init__(self, model: Model | None):
        self.table, self.bias = model or (np.zeros(2**BUCKET_BITS, np.float32), 0.0)

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        bags, counts = subwords(texts)
        margin = packed.sums(self.table[bags], counts) / np.sqrt(np.maximum(counts, 1)) + self.bias
        return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) of every row."""
    return packed.scored_rows(docs, Scorer(model))


def accepted(docs: DataFrame, model: Model | None, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(Scorer(model))
    return packed.kept_rows(docs, lambda texts: shared.value(texts) < threshold)
