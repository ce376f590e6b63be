import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ratewise.llm import simhash
from ratewise.llm.components import components


def brute_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [words[i : i + width] for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(b" ".join(run), 42) for run in runs]
    return sum(
        1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)
    )


def brute_components(ids, prints, budget=3):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= budget:
                root[find(i)] = find(j)
    members = {}
    for i, key in enumerate(ids):
        members.setdefault(find(i), []).append(key)
    least = {r: min((k for k in keys if k is not None), default=None) for r, keys in members.items()}
    return [least[find(i)] for i in range(len(ids))]


@pytest.mark.parametrize("bits", [64, 32, 16])
@pytest.mark.parametrize("budget", [0, 1, 3, 5])
def test_trie_finds_all_pairs(bits, budget):
    rng = np.random.default_rng(budget)
    seeds = rng.integers(0, 2**bits, 12, dtype=np.uint64)
    near = [s ^ sum((np.uint64(1) << np.uint64(b) for b in rng.integers(0, bits, 4)), np.uint64(0))
            for s in seeds for _ in range(12)]
    values = np.sort(np.concatenate([seeds, near, seeds[:3]]).astype(np.uint64))
    values = values << np.uint64(64 - bits)
    values.sort()
    wanted = {
        (i, j) for i in range(len(values)) for j in range(i + 1, len(values))
        if (int(values[i]) ^ int(values[j])).bit_count() <= budget
    }
    found = [p for i, j in simhash.trie_pairs(values, None, budget, bits) for p in zip(i.tolist(), j.tolist())]
    assert len(found) == len(set(found)) and set(found) == wanted
    left, right = values[::2], values[1::2]
    wanted = {
        (i, j) for i in range(len(left)) for j in range(len(right))
        if (int(left[i]) ^ int(right[j])).bit_count() <= budget
    }
    found = [p for i, j in simhash.trie_pairs(left, right, budget, bits) for p in zip(i.tolist(), j.tolist())]
    assert len(found) == len(set(found)) and set(found) == wanted


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(3)
    base = [" ".join(f"w{w}" for w in rng.integers(0, 500, 200)) for _ in range(12)]
    out = list(base)
    for text in base[:6]:
        words = text.split()
        for _ in range(6):
            copy = list(words)
            copy[int(rng.integers(0, 200))] = "changed"
            out.append(" ".join(copy))
    return out + [base[0], base[0].upper(), "", " \t\n", None, "one", "one two", "É é", "x " * 3000]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i * 7 % 101, text, "x") for i, text in enumerate(texts)]
    rows += [(None, texts[0], "y"), (None, "lone words of nobody else here", "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, fp string")


def test_fingerprints_and_components_equal_brute_force(docs):
    rows = [(r["doc_id"], brute_fingerprint(r["text"])) for r in docs.collect()]
    wanted = brute_components([k for k, _ in rows], [p for _, p in rows])
    found = simhash.near_duplicates(docs).collect()
    assert sorted((str(r["doc_id"]), int.from_bytes(r["fp"], "big"), str(r["component_id"])) for r in found) == sorted(
        (str(k), p, str(c)) for (k, p), c in zip(rows, wanted, strict=True)
    )


def test_split_groups_lose_no_link(spark):
    rng = np.random.default_rng(1)
    values = {int(v) for v in rng.integers(0, 2**63, 4)}
    for v in list(values):
        values |= {v ^ 1 << int(a) ^ 1 << int(b) for a, b in rng.integers(0, 20, (60, 2))}
    prints = [v.to_bytes(8, "big") for v in sorted(values)]
    frame = spark.createDataFrame([(bytearray(p),) for p in prints], "fp binary")
    wanted = brute_components(list(range(len(prints))), [int.from_bytes(p, "big") for p in prints])
    for limit in (8, 50, 10_000):
        joined = components(simhash.links(frame, group_limit=limit))
        root = {bytes(r["node"]): bytes(r["root"]) for r in joined.collect()}
        assert [prints.index(root.get(p, p)) for p in prints] == wanted


def test_one_of_each(spark, docs, texts):
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    ids = [r["doc_id"] for r in rows]
    assert len(ids) == len(set(ids))  # here ids are unique, and one row has none
    assert None in ids and 0 in ids
    every = [(r["doc_id"], brute_fingerprint(r["text"])) for r in docs.collect()]
    wanted = brute_components([k for k, _ in every], [p for _, p in every])
    assert set(ids) == set(wanted)
    assert len([r for r in rows if not (r["text"] or "").split()]) == 1


def test_repeated_rows_leave_one(spark):
    text = "some words that are long enough to have shingles of five"
    other = "entirely different words which nobody could take for the former ones"
    rows = [(5, text), (5, text), (5, other), (7, text), (8, other)]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == sorted([(5, text), (5, other)])


def test_very_long_texts_and_clashing_columns(spark):
    long = " ".join(f"w{i}" for i in range(120_000))
    rows = [(1, long, 5, "a"), (2, long + " tail", 6, "b"), (3, "w " * 200_000, 7, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int, root string")
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 3}
    assert sorted(map(tuple, simhash.one_of_each(docs).collect())) == [rows[0], rows[2]]


def test_the_stage_links_by_the_bits_of_the_contract(spark):
    """What goes is what is within the bits of a row that stays, and nothing else."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in docs.collect()}
    wanted = brute_components(list(prints), list(prints.values()))
    kept = {r["doc_id"] for r in simhash.one_of_each(docs).collect()}
    assert kept == set(wanted) and len(kept) < len(prints)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.one_of_each(docs).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert {r["root"] for r in components(edges).collect()} == {0}
