"""Periodic runs against a plain search for every period."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ratewise.llm import periodic, queries

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def plain_runs(words):
    """{(start, stop): period} by comparing the words with themselves, period by period."""
    found = {}
    for period in range(1, len(words) // 4 + 1):
        i = 0
        while i < len(words) - period:
            j = i
            while j < len(words) - period and words[j] == words[j + period]:
                j += 1
            if j > i and j + period - i >= max(6, 4 * period):
                found.setdefault((i, j + period), period)
            i = max(j, i) + 1
    return found


def plain_row(words):
    found = sorted((start, stop - start, period) for (start, stop), period in plain_runs(words).items())
    found.sort(key=lambda run: (run[0], run[2]))
    dropped = {i for start, length, period in found for i in range(start + period, start + length)}
    longest = max(found, key=lambda run: (run[1], -run[0], -run[2]), default=(None,) * 3)
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in found)
    text = " ".join(w for i, w in enumerate(words) if i not in dropped)
    exponent = longest[1] * 1000 // longest[2] if found else None
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, text)]
    return (len(found), *longest, exponent, *digests)


def of_texts(texts):
    counts = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(counts)
    begins = ends - counts
    words = np.array([w for t in texts for w in t], np.int64)
    start, stop, period = periodic.runs(words, np.repeat(begins, counts), np.repeat(ends, counts))
    got = [{} for _ in texts]
    for a, b, q in zip(start.tolist(), stop.tolist(), period.tolist(), strict=True):
        i = int(np.searchsorted(ends, a, "right"))
        got[i][a - int(begins[i]), b - int(begins[i])] = q
    return got


words = st.lists(st.integers(0, 2), max_size=60)
powers = st.lists(
    st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 60)), max_size=5
).map(lambda parts: [w for unit, size in parts for w in (unit * size)[:size]])


@settings(max_examples=300, deadline=None)
@given(st.lists(words | powers, min_size=1, max_size=4))
def test_equal_to_plain_search(texts):
    assert of_texts(texts) == [plain_runs(t) for t in texts]


@pytest.mark.parametrize("seed", range(4))
def test_long_periods(seed):
    rng = np.random.default_rng(seed)
    text = []
    for _ in range(6):
        unit = rng.integers(0, int(rng.integers(2, 300)), int(rng.integers(1, 150))).tolist()
        text += (unit * 12)[: int(rng.integers(1, 900))]
    texts = [text[: len(text) // 2], text, text]
    assert of_texts(texts) == [plain_runs(t) for t in texts]


def test_runs_end_at_the_bounds_of_their_text():
    assert of_texts([[1, 1, 1], [1, 1, 1, 1], [1] * 6]) == [{}, {}, {(0, 6): 1}]
    assert of_texts([[1, 2] * 4, [1, 2, 1, 2, 1, 2, 1]]) == [{(0, 8): 2}, {}]


def test_wavelet_matrix():
    rng = np.random.default_rng(7)
    values = rng.permutation(300)
    matrix = periodic.WaveletMatrix(values)
    low = rng.integers(0, 300, 500)
    high = low + rng.integers(0, 301 - low)
    bound = rng.integers(0, 400, 500)
    want = [min((v for v in values[a:b] if v >= x), default=-1) for a, b, x in zip(low, high, bound)]
    assert matrix.successor(low, high, bound).tolist() == want


def test_query_equals_plain_search(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op11_periodic_runs(spark, FOLDER).collect()}
    assert len(got) == len(docs) and any(row[0] for row in got.values())
    for doc in docs:
        text = (doc["text"] or "").encode().split()
        n, h = len(text), zlib.crc32(str(doc["doc_id"]).encode())
        if n and h % 10 == 0:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            text = [w if i < a else text[a + (i - a) % p] for i, w in enumerate(text)]
        assert got[doc["doc_id"]] == plain_row([w.decode() for w in text])


def test_odd_rows(spark):
    line = "to be or not " * 4
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, line), (4, line), (4, line), (5, "w " * 50_000),
            (6, "é\u00a0é " * 7), (7, " ".join(str(i) for i in range(30_000)))]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], f"{SCHEMA}, start string, period int")
    got = sorted(map(tuple, periodic.periodic_runs(docs).drop("collapsed_sha256").collect()), key=str)
    none = hashlib.sha256(b"").hexdigest()

    def digest(lines):
        return hashlib.sha256(lines.encode()).hexdigest()

    whole = (1, 0, 16, 4, 4000, digest("0,16,4\n"), "to be or not")
    want = [(i, 0, *(None,) * 4, none, "") for i in (1, 2, 3)]
    want += [(None, *whole), (4, *whole), (4, *whole)]
    want += [(5, 1, 0, 50_000, 1, 50_000_000, digest("0,50000,1\n"), "w")]
    want += [(6, 1, 0, 7, 1, 7000, digest("0,7,1\n"), "é\u00a0é")]
    want += [(7, 0, *(None,) * 4, none, " ".join(str(i) for i in range(30_000)))]
    assert got == sorted(want, key=str)
    assert periodic.periodic_runs(docs.limit(0)).count() == 0


def test_words_two_runs_share_go_if_either_repeats_them(spark):
    docs = spark.createDataFrame([(1, "a b " * 4 + "b " * 6 + "end")], SCHEMA)
    row = periodic.periodic_runs(docs).first()
    assert (row["n_runs"], row["start"], row["length"], row["period"]) == (2, 0, 8, 2)
    assert row["collapsed"] == "a b end"
