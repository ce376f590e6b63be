"""The ledger of quality rules against plain counts."""

import re
from collections import Counter

import pytest

from ratewise.llm import quality_rules as rules
from ratewise.llm import queries
from tests import compare

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 8)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
        "n_alpha_words": sum(any(c.isascii() and c.isalpha() or ord(c) > 127 for c in w) for w in words),
        "n_shouted_words": sum(
            len(w) > 1 and bool(re.search("[A-Z]", w)) and not re.search("[a-z]", w) for w in words
        ),
        "n_bullet_lines": sum(bool(re.match(r"[\s]*([-*•]|[0-9]+[.)])[ \t-\r]", x)) for x in lines),
        "n_open_lines": sum(x.rstrip(" \t\n\v\f\r").endswith(("...", "…")) for x in lines),
        "longest_word": max(map(len, words), default=0),
    }


def test_documents_equal_plain_counts(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = rules.measured(docs).collect()
    assert len(found) == len(texts)
    for row in found:
        assert row.asDict() == {"doc_id": row["doc_id"], **plain(texts[row["doc_id"]])}


ODD = [
    (1, None), (2, ""), (3, " \n\t\r"), (None, "A lone word"), (4, "x"), (4, "x"),
    (5, "a b c d e f g h " * 3), (6, "a b c d e f g h i a b c d e f g h"), (7, "w " * 60_000),
    (8, "- one\n- one\n* two...\n3) THREE …\n• four\n \n- one"), (9, "é😀 ### ÉÉ ABC AB1 A 12 x|y<z>"),
    (10, " ".join(f"w{i}" for i in range(30_000))), (11, "a b c \u0085 d"), (12, "1\n1\r\n1"),
]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(*r, 5, "x") for r in ODD], f"{SCHEMA}, n_words int, failures string").coalesce(1)
    found = [r.asDict() for r in rules.ledger(docs).collect()]
    assert len(found) == len(ODD)
    for (doc_id, text), row in zip(ODD, found, strict=True):
        bits = row.pop("failures")
        assert row == {"doc_id": doc_id, **plain(text)}
        failed = [rule.name for i, rule in enumerate(rules.RULES) if bits >> i & 1]
        assert ("few_words" in failed) == (row["n_words"] < 20)
        assert ("repeated_windows" in failed) == (100 * row["n_repeat_words"] > 30 * row["n_words"])
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[5]["n_repeat_words"] == 24 and by_id[6]["n_repeat_words"] == 16
    assert rules.ledger(docs.limit(0)).count() == 0


def test_query_equals_its_sql_with_odd_rows(spark, tmp_path):
    spark.createDataFrame(ODD, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/parts")
    (tmp_path / "documents.parquet").symlink_to(next((tmp_path / "parts").glob("*.parquet")))
    folder = str(tmp_path)
    assert compare.compare(spark, compare.database(folder), "op13_quality_rules", folder) is None


def test_policies_are_masks_of_a_stored_ledger(spark):
    a, b, c = (rules.bit(name) for name in ("few_words", "symbols", "many_words"))
    lines = spark.createDataFrame([(0,), (a,), (a | b,), (b,), (c,), (b | c,)], "failures long")
    kept = rules.verdicts(lines, [rules.BASE, rules.SHORT, rules.WEB_1]).select("base_1", "short_1", "web_1")
    assert [tuple(r) for r in kept.collect()] == [
        (True, True, True), (False, False, False), (False, False, False), (True, True, False),
        (True, False, True), (True, False, False),
    ]
    with pytest.raises(ValueError):
        rules.bit("no_such_rule")


def test_ablation_equals_plain_counts(spark):
    bits = [(i * 7919) % (1 << len(rules.RULES)) for i in range(500)] + [0] * 40
    lines = spark.createDataFrame([(i % 3, b) for i, b in enumerate(bits)], "source long, failures long")
    for row in rules.ablation(lines).collect():
        policy = next(p for p in rules.POLICIES if (p.name, p.version) == (row["policy"], row["version"]))
        own, mask = rules.bit(row["rule"]), policy.mask
        assert row["documents"] == len(bits)
        assert row["kept"] == sum(not b & mask for b in bits)
        assert row["failed"] == sum(bool(b & own) for b in bits)
        assert row["failed_alone"] == sum(b & mask == own for b in bits)
        assert row["kept_without"] == row["kept"] + row["failed_alone"]
    moves = rules.moved(lines, rules.WEB_1, rules.WEB).collect()
    lost = sum(not b & rules.WEB_1.mask and bool(b & rules.WEB.mask) for b in bits)
    assert sum(r["documents"] for r in moves) == lost and not any(r["after"] for r in moves)
    for row in rules.fingerprints(lines, "source").collect():
        own = [b for i, b in enumerate(bits) if i % 3 == row["source"]]
        any_, all_ = 0, own[0]
        for b in own:
            any_, all_ = any_ | b, all_ & b
        assert (row["documents"], row["any_fails"], row["all_fail"]) == (len(own), any_, all_)
    empty = rules.ablation(lines.limit(0)).collect()
    assert len(empty) == sum(len(p.rules) for p in rules.POLICIES)
    assert all(tuple(row)[3:] == (0,) * 5 for row in empty)


def test_good_documents_stay(spark):
    lines = queries.op13_quality_rules(spark, "/root/testdata/sf0.01").where("NOT base_failed")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = lines.join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    count = {(r["quality"], r["kept"]): r["count"] for r in rows}
    assert count.get((1, False), 0) <= 0.01 * count[1, True]
    assert count[0, False] > count.get((0, True), 0)


def test_stays_out_of_python(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    plan = rules.evaluated(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
