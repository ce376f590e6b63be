"""The registered queries over the smallest tables, and the pipeline stage by stage."""

import hashlib
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from ratewise.llm import decontam, quality, queries, toxicity
from ratewise.llm.labelled import in_fold
from tests import compare
from tests.llm.test_simhash import brute_components, brute_fingerprint

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_quality": "doc_id held_out score predicted",
    "op2_search": "query_id rank vec_id score",
    "op3_decontamination": "doc_id item_id start item_start words matched",
    "op4_licenses": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op5_token_file": "doc_id start n_tokens ids_crc32",
    "op6_toxicity": "doc_id held_out score predicted",
    "op7_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op8_simhash": "doc_id fingerprint component_id",
    "op9_sharding": "doc_id slot shard",
    "op10_pitman_yor": "doc_id held_out n_tokens n_known train_tokens base_score score perplexity",
    "op11_periodic_runs": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op12_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op13_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept failures",
}


def test_all_are_registered():
    assert set(queries.QUERIES) == set(COLUMNS)
    assert set(COLUMNS) | {"pipeline"} <= set(contract.queries())
    assert set(queries.SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    df = contract.queries()[name](spark, FOLDER)
    assert df.columns == COLUMNS[name].split()
    rows = df.count()
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    others = ("op2_search", "op3_decontamination", "op12_prefix_trie")
    assert rows == documents if name not in others else rows > 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    assert compare.compare(spark, compare.database(FOLDER), name, FOLDER) is None


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, schema = docs.count(), docs.schema
        path = f"{tmp_path}/{number}"
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.count() <= before and (docs.schema == schema or name == "encoding")
        assert docs.count() > before * 0.5, name
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    again = corpus_pipeline.run(spark, FOLDER)
    assert again.exceptAll(docs).count() == 0 and docs.exceptAll(again).count() == 0


def test_pipeline_over_odd_rows(spark, tmp_path):
    folder = str(tmp_path / "tables")
    tables = {
        "documents": ([(1, None, "en", None, 0), (2, "", None, "s", 0), (None, "some words", "en", "s", 10),
                       (3, "x " * 5000, "en", "s", 3), (3, "x " * 5000, "en", "s", 3)],
                      "doc_id long, text string, lang string, source string, n_chars long"),
        "labels": ([], "doc_id long, quality int, toxic int"),
        "benchmark": ([(None, None)], "item_id long, text string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    found = corpus_pipeline.run(spark, folder)
    assert sorted(str(r["doc_id"]) for r in found.collect()) == ["1", "3", "None"]
    empty = spark.createDataFrame([], tables["documents"][1])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0


def test_pipeline_equals_a_plain_version(spark):
    """Stage by stage over the rows that a plain version of the stage before kept."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    held_out = in_fold(F.col("doc_id"), 3, 1)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for module, label, keeps in ((quality, "quality", lambda s: s >= 0.5), (toxicity, "toxic", lambda s: s < 0.7)):
        rows = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")
        score = module.Scorer(module.train(rows, labels, label, held_out))
        texts = {k: t for k, t in texts.items() if keeps(score([t.encode()])[0])}
    prints = {k: brute_fingerprint(t) for k, t in texts.items()}
    named = brute_components(list(prints), list(prints.values()))
    texts = {k: texts[k] for k in set(named)}
    items = [r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    passages = [plain_words(item) for item in items]
    passages = [p for p in passages if len(p) >= decontam.SHORTEST_ITEM]
    clean = {k: t for k, t in texts.items() if not any(plain_overlap(plain_words(t), p) for p in passages)}
    assert len(clean) < len(texts)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = []
    for k, text in clean.items():
        ids = library.encode(text, add_special_tokens=False).ids
        digests = (",".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))
        wanted.append((k, len(ids), *(hashlib.sha256(d.encode()).hexdigest() for d in digests)))
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(wanted)


def plain_words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", text.lower())


def plain_overlap(words, item):
    """Whether a window of the item (or the whole) agrees in all words but a fifth."""
    width = min(decontam.WINDOW, len(item))
    for start in range(len(item) - width + 1):
        window = item[start : start + width]
        seen = set(window)
        for i in range(len(words) - width + 1):
            if words[i] in seen or words[i + 1] in seen:
                same = sum(a == b for a, b in zip(window, words[i : i + width]))
                if same >= width - decontam.tolerated(width):
                    return True
    return False


def test_pipeline_with_clashing_columns_and_long_texts(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(40)
    long = docs.limit(1).withColumn("text", F.repeat(F.lit("good words of a long text "), 20_000))
    names = ["fp", "component_id", "left_id", "rows", "label", "score", "labelled_id", "h", "root", "item_id"]
    docs = docs.unionAll(long.withColumn("doc_id", F.lit(10**9).cast("long")))
    docs = docs.select("*", *[F.lit(i).alias(name) for i, name in enumerate(names)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, FOLDER)
        assert kept.columns == docs.columns, name
        assert {tuple(r[n] for n in names) for r in kept.collect()} == {tuple(range(len(names)))}
