"""Quality classifier: hashed word n-grams, logistic regression learned by FTRL.

A text is a sparse row of relative n-gram counts; its score is the logistic
function of that row's product with the weights, a few of which are non-zero.

Null and empty texts have no n-grams: their score is that of the bias alone.
Without labelled rows of both classes every score is 0.5. Repeated rows are scored
alike, and of each sampled id one row is learned from. Extra columns of the input are
ignored, whatever their names. Very long texts are taken whole, a fraction of a megabyte
of texts at a time, so memory follows the longest. An empty document table gives no rows.
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
SAMPLE_PER_CLASS = 3000
BUCKET_BITS = 18


def word_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of each text in turn, and how many each text has.

    Four n-grams start at each word: it, it and the word before, and the same of
    the shapes. Words are runs of letters and digits, and runs of marks. A shape
    tells capitals, length class and whether the word repeats the one before.
    """
    data, offsets = packed.pack(texts)
    words = packed.Tokens(data, offsets)
    count = len(words)
    if not count:
        return np.zeros(0, np.int64), words.count * 4
    capitals = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90))])
    small = np.concatenate([[0], np.cumsum((data >= 97) & (data <= 122))])
    big = capitals[words.end] - capitals[words.start]
    low = small[words.end] - small[words.start]
    before = np.empty(count, np.uint64)
    before[0], before[1:] = 0, words.hash[:-1]
    first = np.zeros(count, bool)
    first[np.cumsum(words.count)[:-1][words.count[1:] > 0]] = True
    first[0] = True
    before[first] = 0
    size = np.minimum(words.end - words.start, 8) // 3
    form = np.where(low > 0, np.minimum(big, 2), 3 + np.minimum(big, 2)) * 4 + size
    shape = (form * 6 + words.kind * 2 + (before == words.hash)).astype(np.uint64)
    marks = words.kind == packed.MARK
    shape = packed.mixed((shape + np.uint64(1)) * np.uint64(0x2545F4914F6CDD1D))
    shape[marks] ^= words.hash[marks]
    shape_before = np.empty(count, np.uint64)
    shape_before[0], shape_before[1:] = 0, shape[:-1]
    shape_before[first] = 0
    grams = np.stack(
        [words.hash, packed.paired(before, words.hash), shape, packed.paired(shape_before, shape)],
        axis=1,
    )
    return (grams.ravel() >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), words.count * 4


@dataclass
class FollowTheLeader:
    """FTRL-proximal state of a logistic regression (McMahan et al., 2013)."""

    alpha: float = 2.0
    beta: float = 0.01
    l1: float = 0.001
    l2: float = 0.0001
    passes: int = 3

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> np.ndarray:
        """Weights learned from (buckets, values, label) rows; the last one is the bias."""
        size = 2**BUCKET_BITS + 1
        z, n = np.zeros(size), np.zeros(size)
        for turn in range(self.passes):
            for i in np.random.default_rng(turn).permutation(len(rows)):
                at, x, y = rows[i]
                w = self.weights(z[at], n[at])
                g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
                squares = n[at]
                step = (np.sqrt(squares + g * g) - np.sqrt(squares)) / self.alpha
                z[at] += g - step * w
                n[at] = squares + g * g
        return self.weights(z, n)

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * self.l1 - z
        return np.where(
            np.abs(z) > self.l1, shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2), 0.0
        )


def sparse_row(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets with relative counts; the bias comes last."""
    at, counts = np.unique(buckets, return_counts=True)
    shares = counts / max(1, len(buckets))
    return np.append(at, 2**BUCKET_BITS), np.append(shares * 10, 1.0)


def _sparse_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        label = batch.column("label").to_pylist()
        ids = batch.column("doc_id").to_pylist()
        for start, texts in packed.text_chunks(batch.column("text")):
            grams, counts = word_grams(texts)
            rows = [sparse_row(g) for g in np.split(grams, np.cumsum(counts)[:-1])]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(ids[start : start + len(texts)], pa.int64()),
                    "label": pa.array(label[start : start + len(texts)], pa.int32()),
                    "at": pa.array([at for at, _ in rows], pa.list_(pa.int32())),
                    "x": pa.array([x for _, x in rows], pa.list_(pa.float32())),
                }
            )


def train(
    docs: DataFrame, labels: DataFrame, label: str, held_out, per_class: int = SAMPLE_PER_CLASS
) -> np.ndarray | None:
    """Weights learned from ``per_class`` labelled documents of each class at most.

    All of them are held on the driver as distinct n-grams, however long they are.
    ``held_out`` is a column of the label table; rows where it holds are not
    learned from. ``None`` if one class has no rows.
    """
    sample = training_sample(docs, labels, label, per_class, held_out)
    sparse = sample.select("doc_id", "text", sample["label"].cast("int").alias("label"))
    sparse = sparse.mapInArrow(_sparse_rows, "doc_id long, label int, at array<int>, x array<float>")
    rows = [
        (np.array(row["at"], np.int32), np.array(row["x"], np.float64), row["label"])
        for row in sparse.orderBy("doc_id").toLocalIterator()
    ]
    if len({y for _, _, y in rows}) < 2:
        return None
    return FollowTheLeader().fit(rows)


class Scorer:
    """Scores of texts by fixed weights, which travel with the tasks (1 MB)."""

    def __init__(self, weights: np.ndarray | None):
        if weights is None:
            weights = np.zeros(2**BUCKET_BITS + 1)
        self.table, self.bias = weights[:-1].astype(np.float32), float(weights[-1])

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        grams, counts = word_grams(texts)
        margin = packed.sums(self.table[grams], counts) * 10 / np.maximum(counts, 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))


def scored(docs: DataFrame, weights: np.ndarray | None) -> DataFrame:
    """(doc_id, score) of every row."""
    return packed.scored_rows(docs, Scorer(weights))


def accepted(docs: DataFrame, weights: np.ndarray | None, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that score ``threshold`` at least."""
    shared = docs.sparkSession.sparkContext.broadcast(Scorer(weights))
    return packed.kept_rows(docs, lambda texts: shared.value(texts) >= threshold)
