"""BPE against the tokenizers library, token files by exact round trips."""

import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ratewise.llm import bpe, mixcoder, pretokens, tokenfile

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " ", "\n\n  a  b\t", "Don't stop, it's 12 o'clock", "<|endoftext|> a<|endoftext|>", "<|endoftext|",
    "x" * 5000, "ab" * 200, "é" * 300, "日本語 テキスト", "İstanbul ǅ é K", "🙂🙂 ok", "\x1c\x85　 z", "A1b22C333", "!!!??.. --",
    "word " * 20_000,
]
ALPHABET = st.text(alphabet="ab é1２ \n\t'sStreldmv.,!?🙂日ǅ́İ<|", max_size=40)


@pytest.fixture(scope="module")
def tokenizers():
    return Tokenizer.from_file(BYTES), bpe.ByteBpe(BYTES), Tokenizer.from_file(WORDS), tokenfile.WordTokenizer(WORDS)


@settings(max_examples=400, deadline=None)
@given(ALPHABET)
def test_texts_like_the_library(tokenizers, text):
    library, own, word_library, words = tokenizers
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode([text]) == [ids]
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)
    assert words.encode([text]) == [word_library.encode(text, add_special_tokens=False).ids]


def test_classes_of_all_code_points(tokenizers):
    library = tokenizers[0].pre_tokenizer
    for point in [*range(0, 0xD800, 7), *range(0xE000, 0x30000, 17)]:
        text = f"a{chr(point)}1{chr(point)}!{chr(point) * 2}b"
        assert [p for p in pretokens.pieces(text)] == [text[a:b] for _, (a, b) in library.pre_tokenize_str(text)]


def test_memory_is_emptied(tokenizers, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    monkeypatch.setattr(tokenfile, "REMEMBERED", 5)
    texts = ["some words here", "other words there and more of them", "some words here"]
    for library, own in (tokenizers[:2], tokenizers[2:]):
        assert own.encode(texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def _docs(spark):
    rows = [(i * 3 % 50, t, 1) for i, t in enumerate(TEXTS)] + [(None, "no id", 1), (4, "twice"  , 1), (4, "again", 2)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, ids int")


def test_digests_by_hand(spark, tokenizers):
    library = tokenizers[0]
    rows, docs = _docs(spark)
    wanted = []
    for key, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        wanted.append((str(key), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                       hashlib.sha256(back.encode()).hexdigest()))
    found = [(str(r[0]), *r[1:]) for r in bpe.digests(docs, BYTES).collect()]
    assert sorted(found) == sorted(wanted)
    round_trip = bpe.decoded(bpe.encoded(docs, BYTES), BYTES).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in round_trip) == sorted((str(k), t or "") for k, t, _ in rows)
    assert bpe.digests(docs.limit(0), BYTES).count() == 0


@pytest.mark.parametrize("sizes", [[], [0], [1], [0, 1, 2, 300, 5000], [255, 256, 257, 512, 513]])
@pytest.mark.parametrize("kind", ["random", "one", "cycle", "large"])
def test_codes_decode_to_what_was_coded(sizes, kind):
    rng = np.random.default_rng(1)
    make = {
        "random": lambda n: rng.integers(0, 49408, n), "one": lambda n: np.full(n, 7),
        "cycle": lambda n: np.arange(n) % 5, "large": lambda n: 2**31 + rng.geometric(0.1, n),
    }[kind]
    blocks = [make(n) for n in sizes]
    codes = mixcoder.encode(blocks)
    back = mixcoder.decode(codes, [len(b) for b in blocks])
    assert all(np.array_equal(a, b) for a, b in zip(blocks, back, strict=True))
    if kind == "cycle" and 5000 in sizes:
        assert len(codes[-1]) < 400  # predictions drive the coder


def test_tables_of_the_mixer_are_monotone():
    stretch, squash = mixcoder.logistic_tables()
    assert (np.diff(stretch) >= 0).all() and (np.diff(squash) >= 0).all()


def test_token_file(spark, tokenizers, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfile, "BLOCK", 64)
    rows, docs = _docs(spark)
    path = str(tmp_path / "ids")
    tokenfile.write(docs.repartition(3), path, WORDS, 1)
    found = tokenfile.digests(spark, path).orderBy("start").collect()
    start, by_text = 0, {}
    for key, text, _ in rows:
        ids = [*tokenizers[2].encode(text or "", add_special_tokens=False).ids, 1]
        by_text.setdefault(key, []).append((len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
    keys = [r["doc_id"] for r in found]
    assert keys[0] is None and keys[1:] == sorted(keys[1:]) and len(keys) == len(rows)
    for r in found:
        assert r["start"] == start
        start += r["n_tokens"]
        by_text[r["doc_id"]].remove((r["n_tokens"], r["ids_crc32"]))
    assert not any(by_text.values())
    damaged = spark.read.parquet(path).withColumn("ids_crc32", F.col("ids_crc32").bitwiseXOR(F.lit(1)))
    damaged.write.parquet(f"{path}-damaged")
    with pytest.raises(Exception, match="is damaged"):
        tokenfile.read(spark, f"{path}-damaged").collect()
    tokenfile.write(docs.limit(0), f"{path}-empty", WORDS, 1)
    assert tokenfile.digests(spark, f"{path}-empty").count() == 0


def test_words_of_random_prose(tokenizers):
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcdeéü'1.", k=rng.randrange(1, 9))) for _ in range(200)) for _ in range(20)]
    assert tokenizers[3].encode(texts) == [e.ids for e in tokenizers[2].encode_batch(texts, add_special_tokens=False)]
