import itertools
import random

import numpy as np
import pytest

from ratewise.llm import decontam

rng = random.Random(6)
VOCABULARY = [f"w{i}" for i in range(3000)]
ITEMS = [(i, " ".join(rng.choices(VOCABULARY, k=n))) for i, n in enumerate((16, 30, 60, 15, 5, 4))]


def test_masks_hit_every_window():
    for length in range(8, 17):
        for wrong in itertools.combinations(range(length), decontam.tolerated(length)):
            assert any(
                all(s + o not in wrong for o in mask)
                for mask in decontam.MASKS for s in range(length - mask[-1])
            )


def _within(text, passage, at):
    words = text.split()
    return " ".join(words[:at] + passage.split() + words[at:])


@pytest.fixture(scope="module")
def rows():
    def clean():
        return " ".join(rng.choices(VOCABULARY, k=120))

    found = [(0, _within(clean(), ITEMS[0][1], 7), {0}), (1, _within(clean(), ITEMS[2][1].upper(), 0), {2})]
    changed = ITEMS[1][1].split()
    for at in range(3, 30, 6):
        changed[at] = "zzz"
    found.append((2, _within(clean(), " ".join(changed), 120), {1}))
    found.append((3, _within(clean(), ITEMS[2][1].replace(" ", ", "), 50), {2}))
    half = " ".join(ITEMS[2][1].split()[20:40])
    found.append((4, _within(clean(), half, 50), {2}))
    found.append((5, _within(clean(), " ".join(ITEMS[2][1].split()[20:32]), 50), set()))
    found.append((6, _within(clean(), ITEMS[4][1], 9), {4}))
    found.append((7, _within(_within(clean(), ITEMS[3][1], 9), ITEMS[0][1], 0), {0, 3}))
    found += [(10 + i, clean(), set()) for i in range(60)]
    odd = [(100, None, set()), (101, "", set()), (None, ITEMS[0][1], {0}), (102, ITEMS[5][1], set())]
    return found + odd + [found[0], (103, "x " * 50_000 + ITEMS[1][1], {1})]


@pytest.mark.parametrize("block_bytes", [16_000_000, 100])
def test_planted_passages(spark, rows, block_bytes):
    docs = spark.createDataFrame([(k, t, 1) for k, t, _ in rows], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(*i, "x") for i in ITEMS] + [(0, ITEMS[0][1], "y"), (9, None, "z")],
                                  "item_id long, text string, source string")
    found = decontam.overlaps(docs, items, block_bytes)
    by_doc = {}
    for r in found.collect():
        by_doc.setdefault(r["doc_id"], set()).add(r["item_id"])
        assert r["matched"] >= r["words"] * 0.7 or r["words"] < 8
    assert by_doc == {k: i for k, _, i in rows if i}
    kept = decontam.clean_documents(docs, items, block_bytes)
    assert kept.schema == docs.schema
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(k) for k, _, i in rows if not i)


def test_every_overlap_of_random_texts_is_found():
    """Against sliding every item along every text."""
    words = ["a", "b", "c"]
    for seed in range(40):
        pick = random.Random(seed)
        item = pick.choices(words, k=pick.randrange(5, 30))
        text = pick.choices(words, k=60)
        text[20:20] = [w if pick.random() > 0.15 else "d" for w in item]
        width = min(16, len(item))
        wanted = any(
            sum(x == y for x, y in zip(text[i : i + width], item[j : j + width]))
            >= width - decontam.tolerated(width)
            for i in range(len(text) - width + 1) for j in range(len(item) - width + 1)
        )
        block = decontam.BenchmarkBlock([(1, " ".join(item).encode())])
        assert bool(block.overlaps([" ".join(text).encode()])) == wanted


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontam.overlaps(docs, items).count() == 0
    assert decontam.clean_documents(docs, items).count() == 1
    assert decontam.overlaps(docs.limit(0), items).count() == 0
    assert np.all(decontam.seed_hashes(np.zeros(2, np.uint64), (0, 1, 2, 4)) == 0)


def test_short_items_match_whole_and_exactly(spark):
    items = [(1, "Paris"), (2, "forty two"), (3, "the red fox"), (4, "a b c d"), (5, None), (6, "fox")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    texts = [(10, "the RED fox, Paris! forty two"), (11, "red fox the forty - two forty"), (12, "a b c x d a b c d"), (13, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"], r["start"], r["words"]) for r in decontam.overlaps(docs, benchmark, shortest=1).collect()}
    assert found == {
        (10, 3, 0, 3), (10, 6, 2, 1), (10, 1, 3, 1), (10, 2, 4, 2), (11, 6, 1, 1), (11, 2, 3, 2), (12, 4, 5, 4),
    }
    assert decontam.clean_documents(docs, benchmark).count() == 4
    kept = decontam.clean_documents(docs, benchmark, shortest=1)
    assert [r["doc_id"] for r in kept.collect()] == [13]
