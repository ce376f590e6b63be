"""The two classifiers' learning and scoring against loops over dictionaries."""

import math

import numpy as np
import pytest

from ratewise.llm import quality, toxicity


def _ftrl_by_hand(rows, settings):
    """FTRL-proximal of one coordinate at a time."""
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= settings.l1:
            return 0.0
        sign = math.copysign(1.0, z[i])
        return (sign * settings.l1 - z[i]) / ((settings.beta + math.sqrt(n[i])) / settings.alpha + settings.l2)

    for turn in range(settings.passes):
        for r in np.random.default_rng(turn).permutation(len(rows)):
            at, x, y = rows[r]
            w = {int(i): weight(int(i)) for i in at}
            margin = sum(w[int(i)] * v for i, v in zip(at, x))
            error = 1 / (1 + math.exp(-max(-35.0, min(35.0, margin)))) - y
            for i, v in zip(at, x):
                g, i = error * v, int(i)
                before = n.get(i, 0.0)
                n[i] = before + g * g
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n[i]) - math.sqrt(before)) / settings.alpha * w[i]
    return weight


def test_follow_the_leader_equals_plain_loops():
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(80):
        y = int(rng.integers(2))
        buckets = rng.integers(0, 30, int(rng.integers(1, 12))) + 10 * y
        rows.append((*quality.sparse_row(buckets), y))
    settings = quality.FollowTheLeader()
    weights = settings.fit(rows)
    by_hand = _ftrl_by_hand(rows, settings)
    for i in [*range(60), 2**quality.BUCKET_BITS]:
        assert weights[i] == pytest.approx(by_hand(i), abs=1e-9)
    assert np.count_nonzero(weights) <= 41


def test_quality_score_equals_a_plain_sum():
    rng = np.random.default_rng(3)
    weights = rng.normal(size=2**quality.BUCKET_BITS + 1)
    texts = [b"", b"one", b"Some words, some MARKS!! and some words", b"a " * 500]
    found = quality.Scorer(weights)(texts)
    for text, score in zip(texts, found, strict=True):
        grams, counts = quality.word_grams([text])
        total = sum(float(np.float32(weights[g])) for g in grams.tolist())
        margin = total * 10 / max(int(counts[0]), 1) + weights[-1]
        assert score == pytest.approx(1 / (1 + math.exp(-max(-35, min(35, margin)))), abs=1e-6)


def _softmax_by_hand(rows, settings):
    """Subword vectors, class vectors and biases, number by number."""
    rng = np.random.default_rng(settings.seed)
    k = settings.dimensions
    start = rng.uniform(-1, 1, (2**toxicity.BUCKET_BITS, k)).astype(np.float32) / k
    classes = rng.uniform(-1, 1, (2, k)).tolist()
    vectors = {int(i): [float(v) for v in start[i]] for at, _ in rows for i in at}
    bias, class_sum, bias_sum = [0.0, 0.0], [1e-6, 1e-6], 1e-6
    toxic = sum(y for _, y in rows)
    weight = (len(rows) / 2 / (len(rows) - toxic), len(rows) / 2 / toxic)
    for turn in range(settings.passes):
        rate = settings.rate * (1 - turn / settings.passes)
        for r in rng.permutation(len(rows)):
            at, y = rows[r]
            share = 1 / math.sqrt(max(1, len(at)))
            mean = [sum(vectors[int(i)][d] for i in at) * share for d in range(k)]
            logits = [sum(classes[c][d] * mean[d] for d in range(k)) + bias[c] for c in range(2)]
            powers = [math.exp(v - max(logits)) for v in logits]
            error = [(p / sum(powers) - (c == y)) * weight[y] for c, p in enumerate(powers)]
            for i in at:
                for d in range(k):
                    vectors[int(i)][d] -= rate * share * sum(error[c] * classes[c][d] for c in range(2))
            for c in range(2):
                class_sum[c] += sum((error[c] * m) ** 2 for m in mean)
            bias_sum += sum(e * e for e in error)
            for c in range(2):
                for d in range(k):
                    classes[c][d] -= 0.1 * error[c] * mean[d] / math.sqrt(class_sum[c])
                bias[c] -= 0.1 * error[c] / math.sqrt(bias_sum)
    apart = [classes[1][d] - classes[0][d] for d in range(k)]
    return {i: sum(a * b for a, b in zip(v, apart)) for i, v in vectors.items()}, bias[1] - bias[0]


def test_joint_softmax_equals_plain_loops():
    rng = np.random.default_rng(5)
    rows = []
    for i in range(40):
        y = i % 2
        at = np.unique(rng.integers(0, 25, 8) + 12 * y).astype(np.int32)
        rows.append((at, y))
    settings = toxicity.SubwordSoftmax(passes=2)
    table, bias = settings.fit(rows)
    wanted, wanted_bias = _softmax_by_hand(rows, settings)
    assert bias == pytest.approx(wanted_bias, abs=1e-4)
    for i, value in wanted.items():
        assert table[i] == pytest.approx(value, rel=2e-3, abs=2e-3)


def test_toxicity_score_equals_a_plain_sum():
    rng = np.random.default_rng(6)
    table = rng.normal(size=2**toxicity.BUCKET_BITS).astype(np.float32)
    texts = [b"", b"word", b"some words and misspelt wrods " * 3]
    found = toxicity.Scorer((table, 0.25))(texts)
    for text, score in zip(texts, found, strict=True):
        bag, _ = toxicity.subwords([text])
        assert len(set(bag.tolist())) == len(bag)
        margin = sum(float(table[b]) for b in bag) / math.sqrt(max(len(bag), 1)) + 0.25
        assert score == pytest.approx(1 / (1 + math.exp(-max(-35, min(35, margin)))), abs=1e-4)
