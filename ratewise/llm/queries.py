"""The operators as queries over the given tables, with their SQL where there is one."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.llm import (
    bpe,
    conversation_trie,
    decontam,
    licenses,
    periodic,
    pitman_yor,
    quality,
    quality_rules,
    search,
    sharding,
    simhash,
    tokenfile,
    toxicity,
)
from ratewise.llm.labelled import in_fold
from ratewise.session import durable, new_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _classified(scores: DataFrame, threshold: float) -> DataFrame:
    return scores.select(
        "doc_id",
        in_fold(F.col("doc_id"), 3, 1).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


@query
def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality scores of every document, learned from the labels of two folds of three."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    weights = quality.train(docs, labels, "quality", in_fold(F.col("doc_id"), 3, 1))
    return _classified(quality.scored(docs, weights), 0.5)


@query
def op2_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one, by exact integer products. Of rows
    that share an id only the query's own is no candidate."""
    vectors = search.integer_vectors(table(spark, folder, "embeddings"), "vec_id", "embedding")
    return search.top_k(vectors, F.col("id") % 100 == 0, 10, same_id=True)


SQL["op2_search"] = """
WITH usable AS (
    SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), cells AS (
    SELECT r, vec_id, unnest(range(1, len(embedding) + 1)) AS d, unnest(embedding) AS x FROM usable
), bad AS (
    SELECT DISTINCT r FROM cells WHERE x IS NULL OR NOT isfinite(x)
), weights AS (
    SELECT r, vec_id, d, CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) AS w
    FROM cells WHERE r NOT IN (SELECT r FROM bad)
), scores AS (
    SELECT q.r, q.vec_id AS query_id, c.vec_id, c.r AS other, CAST(sum(q.w * c.w) AS BIGINT) AS score
    FROM weights q JOIN weights c ON q.d = c.d AND q.vec_id <> c.vec_id
    WHERE q.vec_id % 100 = 0 GROUP BY ALL
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS place FROM scores
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10
"""


@query
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every overlap of a document with a benchmark item, the shortest included."""
    return decontam.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"), shortest=1)


def _license_sql() -> str:
    """The scan as joins: words, keywords with their windows, rules, better intervals."""
    listed = ", ".join(
        f"({r.number}, '{r.keyword}', '{r.label}', {r.priority}, {r.score}, '( {r.pattern} )')"
        for r in licenses.RULES
    )
    base = ", ".join(
        f"('{label}', ' {phrase} ', {phrase.split(' ').index(next(w for w in phrase.split(' ') if '<' in w))})"
        for label, phrase in licenses.BASE
    )
    reach = licenses.REACH
    return f"""
WITH rules(number, keyword, label, priority, score, pattern) AS (VALUES {listed}),
base(label, phrase, before) AS (VALUES {base}),
lowered AS (
  SELECT row_number() OVER () AS r, doc_id,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM documents
), words AS (
  SELECT r, doc_id, regexp_extract_all(low, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM lowered
), places AS (
  SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM words
), windows AS (
  SELECT r, i, w[i] AS keyword, least(i - 1, {reach}) AS before,
         ' ' || array_to_string(w[greatest(1, i - {reach}):i - 1] || ['<' || w[i] || '>']
                                || w[i + 1:i + {reach}], ' ') || ' ' AS span
  FROM places WHERE w[i] IN (SELECT keyword FROM rules UNION SELECT 'mit' UNION SELECT 'apache' UNION SELECT 'cc')
), hits AS (
  SELECT r, i, before, span, number, label, priority, score, regexp_extract(span, pattern) AS m
  FROM windows JOIN rules USING (keyword) WHERE regexp_matches(span, pattern)
), found AS (
  SELECT r, number, label, priority, score,
         i - 1 - before + length(regexp_replace(left(span, strpos(span, m)), '[^ ]', '', 'g')) - 1 AS a,
         length(regexp_replace(m, '[^ ]', '', 'g')) - 1 AS size
  FROM hits
), kept AS (
  SELECT * FROM found d WHERE NOT EXISTS (
    SELECT 1 FROM found e
    WHERE e.r = d.r AND e.a <= d.a AND e.a + e.size >= d.a + d.size
      AND (e.priority < d.priority OR (e.priority = d.priority
           AND (e.size > d.size OR (e.a = d.a AND e.size = d.size AND e.number < d.number)))))
), phrases AS (
  SELECT r, b.label, i - 1 - b.before AS a FROM windows JOIN base b ON contains(span, phrase)
), by_phrase AS (
  SELECT r, count(*) AS n, min(a) AS first_word, max(a) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS names FROM phrases GROUP BY r
), by_label AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS names, max(score) AS score FROM (
    SELECT r, label, CAST(score AS DOUBLE) AS score FROM kept
    UNION ALL SELECT r, label, CAST(0.95 AS DOUBLE) FROM phrases
  ) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(p.n, 0) AS BIGINT) AS n_base,
       CAST(p.first_word AS BIGINT) AS first_word, CAST(p.last_word AS BIGINT) AS last_word,
       coalesce(p.names, '') AS base_labels, coalesce(l.names, '') AS labels,
       coalesce(l.score, CAST(0 AS DOUBLE)) AS score
FROM words LEFT JOIN by_phrase p USING (r) LEFT JOIN by_label l USING (r)"""


SQL["op4_licenses"] = _license_sql()


@query
def op4_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and notices in every whole text."""
    return licenses.scanned(table(spark, folder, "documents")).drop("matches")


@query
def op5_token_file(spark: SparkSession, folder: str) -> DataFrame:
    """Token files of all documents, written, read back and digested."""
    path = new_path(spark, "token-ids")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    tokenfile.write(table(spark, folder, "documents"), path, tokenizer, end_id=1)
    return tokenfile.digests(spark, path)


@query
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity scores of every document, learned from the labels of two folds of three."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.train(docs, labels, "toxic", in_fold(F.col("doc_id"), 3, 1))
    return _classified(toxicity.scored(docs, model), 0.7)


@query
def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every whole text encoded and decoded, as digests."""
    return bpe.digests(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


@query
def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and class of near copies of every document."""
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    digits = F.lower(F.hex("fp"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query
def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents written into their shards and read back: the place of each row."""
    rows = sharding.placed(table(spark, folder, "documents"), ["doc_id"], SHARDS)
    path = new_path(spark, "shards")
    sharding.write_shards(rows, path)
    return sharding.read_shards(spark, path, rows).select("doc_id", "slot", "shard")


#: Named like the files of a data set of 100 shards.
SHARDS = [f"shard-{i:05d}" for i in range(100)]


@query
def op10_pitman_yor(spark: SparkSession, folder: str) -> DataFrame:
    """Log probability of every document under the model of nine folds of ten."""
    return pitman_yor.scored(table(spark, folder, "documents"), in_fold(F.col("doc_id"), 10, 0))


def planted_words(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of one text in ten end in copies of a stretch of their own."""
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is None or not n or h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


@query
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of words that repeat four times and more in every whole text."""
    return periodic.periodic_runs(table(spark, folder, "documents"), planted_words, with_text=False)


def rebuilt_paths(turns: DataFrame) -> DataFrame:
    """(conv_id, path) of the rebuilt conversations: the first h turns of the first
    conversation of each hundred, then a conversation's own behind its first h."""
    own = conversation_trie.sequences(turns)
    heads = own.where("conv_id % 100 = 0").select(
        F.col("conv_id").alias("head_id"), F.slice("turns", 1, 5).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % 6).cast("int")
    head = F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), h)
    tail = F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))
    joined = own.join(heads, F.col("conv_id") - F.col("conv_id") % 100 == F.col("head_id"), "left")
    return joined.select("conv_id", conversation_trie.path(F.concat(head, tail)).alias("path"))


@query
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations."""
    paths = durable(rebuilt_paths(table(spark, folder, "conversations")), "paths")
    return conversation_trie.prefix_trie(paths)


#: CRC-32 of the digits of ``conv_id``, bit by bit.
_CRC32_SQL = """xor(4294967295, list_reduce(
    [4294967295::BIGINT] || flatten(list_transform(string_split(conv_id::VARCHAR, ''),
        lambda c: list_transform(range(8), lambda k: ((ascii(c) >> k::INTEGER) & 1)::BIGINT))),
    lambda s, b: xor(s >> 1, 3988292384 * xor(s & 1, b))))"""

SQL["op12_prefix_trie"] = f"""
WITH told AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role,
        left(sha256(length(role) || ':' || role || text), 32)) AS u, {_CRC32_SQL} % 6 AS h
    FROM told GROUP BY conv_id
), rebuilt AS (
    SELECT o.conv_id, coalesce(b.u[1:o.h], []) || o.u[o.h + 1:] AS p
    FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100
), spread AS (
    SELECT conv_id, p, unnest(range(0, len(p) + 1)) AS d FROM rebuilt
), nodes AS (
    SELECT p[1:d] AS p, d, min(conv_id) AS conv_id, count(*) AS n_convs FROM spread GROUP BY ALL
), childhood AS (
    SELECT p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), figures AS (
    SELECT nodes.p, (c.n IS NULL)::BIGINT AS leaf,
           CASE WHEN d > 0 THEN (n_convs - 1) * length(nodes.p[d].text) ELSE 0 END AS saved, d
    FROM nodes LEFT JOIN childhood c ON c.p = nodes.p
), above AS (
    SELECT p[1:e] AS p, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT p, leaf, saved, unnest(range(0, d + 1)) AS e FROM figures) GROUP BY ALL
), ended AS (
    SELECT p, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM rebuilt GROUP BY p
)
SELECT n.conv_id, n.d::BIGINT AS depth, parent.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(c.n, 0)::BIGINT AS n_children, a.n_leaves::BIGINT AS n_leaves,
       a.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n JOIN above a ON a.p = n.p LEFT JOIN childhood c ON c.p = n.p LEFT JOIN ended e ON e.p = n.p
LEFT JOIN nodes parent ON n.d > 0 AND parent.p = n.p[1:n.d - 1]"""


@query
def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger of every document, and the verdicts of the base and the current policy."""
    lines = quality_rules.ledger(table(spark, folder, "documents"))
    return lines.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes(quality_rules.BASE)).alias("base_failed"),
        quality_rules.passes(quality_rules.WEB).alias("kept"),
        "failures",
    )


def _rules_sql() -> str:
    """The ledger with windows as words, not as hashes."""
    bits = " + ".join(
        f"CASE WHEN {rule.fails} THEN {1 << i} ELSE 0 END" for i, rule in enumerate(quality_rules.RULES)
    )
    blank = r"\x20\x09-\x0D"
    ahead = " || ".join(f"' ' || lead(word, {k}) OVER ahead" for k in range(1, quality_rules.WINDOW))
    return f"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), parts AS (
    SELECT r, doc_id, t, regexp_extract_all(t, '[^{blank}]+') AS w,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{blank}]')) AS lines
    FROM texts
), words AS (
    SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM parts
), windows AS (
    SELECT r, i, word || {ahead} AS win FROM words WINDOW ahead AS (PARTITION BY r ORDER BY i)
), repeats AS (
    SELECT r, unnest(list(i)) AS i FROM windows WHERE win IS NOT NULL GROUP BY r, win HAVING count(*) > 1
), covered AS (
    SELECT r, sum(least(8, coalesce(following - i, 8))) AS n
    FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS following FROM repeats)
    GROUP BY r
), measured AS (
    SELECT r, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
           len(regexp_extract_all(t, '{quality_rules.SYMBOLS}')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
           len(lines) AS n_lines,
           len(list_filter(w, lambda x: regexp_matches(x, '{quality_rules.LETTER}'))) AS n_alpha_words,
           len(list_filter(w, lambda x: length(x) > 1 AND regexp_matches(x, '{quality_rules.SHOUTED}'))) AS n_shouted_words,
           len(list_filter(lines, lambda x: regexp_matches(x, '{quality_rules.BULLET}'))) AS n_bullet_lines,
           len(list_filter(lines, lambda x: regexp_matches(x, '{quality_rules.OPEN_END}'))) AS n_open_lines,
           coalesce(list_max(list_transform(w, lambda x: length(x))), 0) AS longest_word
    FROM parts LEFT JOIN covered USING (r)
), ledger AS (
    SELECT *, {bits} AS failures FROM measured
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       (failures & {quality_rules.BASE.mask}) <> 0 AS base_failed,
       (failures & {quality_rules.WEB.mask}) = 0 AS kept, failures::BIGINT AS failures
FROM ledger"""


SQL["op13_quality_rules"] = _rules_sql()
