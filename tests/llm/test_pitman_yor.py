import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewise.llm import pitman_yor as lm
from ratewise.llm.labelled import in_fold


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    words = [f"{a}{b}" for a in "bcdfg" for b in ("an", "el", "or", "u", "ié")]
    out = [(i, " ".join(rng.choices(words[: 5 + i % 20], k=rng.randrange(1, 60)))) for i in range(200)]
    return out + [(300, None), (301, ""), (302, "\t \n"), (303, "BAN\x0bban unseenword"), (None, "ban bel"), out[0], (304, "a " * 30_000)]


def test_base_scores_and_counts_by_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK", 1500)
    docs = spark.createDataFrame([(k, t, 1.0) for k, t in rows], "doc_id long, text string, score double")
    found = lm.scored(docs.repartition(3), in_fold(F.col("doc_id"), 10, 0)).collect()

    def tokens(text):
        return [*(text or "").encode().lower().split(), b""]

    held = {k for k, _ in rows if k is not None and zlib.crc32(str(k).encode()) % 10 == 0}
    counts = Counter(w for k, t in rows if k not in held for w in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    wanted = []
    for k, t in rows:
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens(t))
        wanted.append((str(k), k in held, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total, round(base, 6)))
    got = [(str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found]
    assert sorted(got) == sorted(wanted)
    assert all(r["score"] < 0 for r in found)
    again = lm.scored(docs.repartition(5), in_fold(F.col("doc_id"), 10, 0)).collect()
    for a, b in zip(sorted(found, key=str), sorted(again, key=str)):
        assert a["score"] == pytest.approx(b["score"], rel=1e-9)


def _vocabulary(spark, counts):
    frame = spark.createDataFrame([(bytearray(w), c) for w, c in counts.items()], "word binary, c long")
    return frame.withColumn("h", F.xxhash64("word"))


def test_probabilities_add_up(spark):
    """Words of up to three letters over two letters, and the rest by the spelling model."""
    counts = {b"": 40, b"a": 30, b"ab": 12, b"b": 5, b"ba": 1, b"aab": 3}
    samples = lm.sampled(_vocabulary(spark, counts))
    assert len(samples) == lm.SAMPLES
    total = sum(counts.values())
    for sample in samples:
        words = list(counts)
        keys = np.arange(len(words)).astype(np.uint64)
        tables, prior = sample.tables(words, np.array(list(counts.values())), keys)
        assert (tables >= 1).all() and (tables <= list(counts.values())).all()
        # all tables seated anew: their own sum, as the draws depend on the keys
        p = lm.Restaurants(*lm.WORDS).predictive(np.array(list(counts.values())), tables, total, tables.sum(), prior)
        unseen = (lm.WORDS[1] + lm.WORDS[0] * tables.sum()) / (lm.WORDS[1] + total) * (1 - prior.sum())
        assert p.sum() + unseen == pytest.approx(1, abs=1e-6)
        every = np.arange(256)
        for code in (0x20 | 0x20 << 8 | 0 << 14, 97, 12345):
            assert sample.spelling.p(np.full(256, code), every).sum() == pytest.approx(1, abs=1e-4)


def test_stirling_numbers_and_draws():
    d = 0.5
    table = np.exp(lm.log_stirling(d, 6))
    assert table[1, 1] == pytest.approx(1) and table[2, 1] == pytest.approx(1 - d) and table[2, 2] == pytest.approx(1)
    assert table[3, 1] == pytest.approx((1 - d) * (2 - d)) and table[3, 2] == pytest.approx(3 * (1 - d))
    # two customers of a dish: the odds of two tables against one are a : (1 - d)
    n, prior = 200_000, 0.3
    drawn = lm.Restaurants(d, 2.0).tables(np.full(n, 2), np.full(n, 4.0), np.full(n, prior), np.arange(n).astype(np.uint64), 1)
    a = (2.0 + d * 5) * prior
    assert (drawn == 2).mean() == pytest.approx(a / (a + 1 - d), abs=0.01)
    many = lm.Restaurants(d, 2.0).tables(np.full(500, 100_000), np.zeros(500), np.full(500, 0.5), np.arange(500).astype(np.uint64), 2)
    assert many.min() >= 1 and many.max() < 100_000


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert lm.scored(docs, in_fold(F.col("doc_id"), 10, 0)).count() == 0
    only_held = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    row = lm.scored(only_held, F.lit(True)).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"]) == (3, 0, 0, 0.0)
    assert row["score"] < 0


def test_the_word_before_tells(spark):
    """Held-out texts of the same words in a known and in an unknown order."""
    words = [f"w{i}" for i in range(12)]
    rng = random.Random(2)
    rows = []
    for i in range(60):
        start = rng.randrange(12)
        rows.append((i, " ".join(words[(start + k) % 12] for k in range(24))))
    order = " ".join(words * 2)
    rows += [(1000, order), (1001, " ".join(reversed(order.split())))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r for r in lm.scored(docs, F.col("doc_id") >= 1000).collect()}
    assert found[1000]["base_score"] == pytest.approx(found[1001]["base_score"])
    assert found[1000]["score"] > found[1001]["score"] + 10


def test_following_words_add_up(spark, monkeypatch):
    """All words after each word, as texts of one pair each, by plain counts of the pairs."""
    monkeypatch.setattr(lm, "CHUNK", 40)
    learned = ["a b a b c", "a b", "c c a", "b", "a c b a b"]
    counts = Counter()
    for text in learned:
        tokens = ["", *text.split(), ""]
        counts.update(zip(tokens, tokens[1:]))
    rows = list(enumerate(learned))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    parts = lm.text_parts(docs, F.lit(False)).where("word IS NULL").withColumnRenamed("chunk", "text_chunk")
    tally = lm.tallied(lm.pair_parts(parts, 3)).collect()
    repeated = [r["c"] for r in tally if r["j"] is not None]
    assert sorted(repeated) == sorted(c for c in counts.values() if c > 1)
    for side in ("u", "w"):
        other = "w" if side == "u" else "u"
        once = [r["c"] for r in tally if r["j"] is None and r[side] is not None and r[other] is None]
        assert sum(once) == sum(c == 1 for c in counts.values())


def test_customers_follow_without_rows_of_pairs_learned_once(spark, monkeypatch):
    """By plain counts of distinct pairs, each with one table before the first draws. Pairs of
    texts that are held out count for nothing, and their words are there with none."""
    monkeypatch.setattr(lm, "CHUNK", 40)
    learned = ["a b a b c", "a b", "c c a", "b", "a c b a b", "", "d e"]
    counts = Counter()
    for text in learned:
        tokens = ["", *text.split(), ""]
        counts.update(zip(tokens, tokens[1:]))
    docs = spark.createDataFrame([*enumerate(learned), (100, "a d f")], "doc_id long, text string").repartition(2)
    parts = lm.text_parts(docs, F.col("doc_id") >= 100)
    texts = parts.where("word IS NULL").withColumnRenamed("chunk", "text_chunk")
    tally = lm.tallied(lm.pair_parts(texts, 3), with_once=False)
    assert tally.where("j IS NULL AND places IS NULL").count() == 0
    words = parts.where("word IS NOT NULL").groupBy("word", "h").agg(F.sum("learned").alias("c"))
    found = {bytes(r["word"]).decode(): (r["c"], r["tables"]) for r in lm.Following(words, tally).customers(0).collect()}
    firsts, seconds = (Counter(pair[side] for pair in counts) for side in (0, 1))
    assert found == {w: (seconds[w], firsts[w]) for w in ["", *"abcdef"]}


def test_sweeps_store_a_row_for_each_bucket_and_part(spark, monkeypatch):
    """Not one for each word or pair, of which there are hundreds; words dealt to several parts
    and pairs to several buckets leave the scores as they are."""
    stored, durable = {}, lm.durable

    def counted(df, name, *columns):
        out = durable(df, name, *columns)
        stored[name] = max(stored.get(name, 0), out.count())
        return out

    rng = random.Random(4)
    words = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "lmnrst"]
    rows = [(i, " ".join(rng.choices(words, k=30))) for i in range(60)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    one = {r["doc_id"]: r["score"] for r in lm.scored(docs, F.col("doc_id") % 7 == 0).collect()}
    monkeypatch.setattr(lm, "durable", counted)
    monkeypatch.setattr(lm, "PART_BYTES", 6000)
    monkeypatch.setattr(lm, "BUCKET_TOKENS", 1200)
    many = {r["doc_id"]: r["score"] for r in lm.scored(docs, F.col("doc_id") % 7 == 0).collect()}
    assert many == pytest.approx(one, rel=1e-9)
    assert {"lm-parts", "lm-pairs", "lm-seated", "lm-state"} <= stored.keys()
    assert max(stored.values()) < 60  # 151 words and more repeated pairs than that
