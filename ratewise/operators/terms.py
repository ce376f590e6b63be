"""Term counts, vocabularies and TF-IDF as plain tables."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewise.functions.numbered import NumberedTokens, numbered_chunks
from ratewise.functions.text import STOP_WORDS, bigrams, term_tokens
from ratewise.session import BROADCAST_BYTES, durable, fits_broadcast

UNIGRAM, BIGRAM = "unigram", "bigram"
KINDS = (UNIGRAM, BIGRAM)
DOCUMENT = "document"

# Size of each vocabulary and least number of documents per term.
VOCAB_SIZE = 50_000
MIN_DOCUMENTS = 5


def with_tokens(
    df: DataFrame, words: Sequence[str] = STOP_WORDS, unicode_words: bool = False
) -> DataFrame:
    """Replace ``text`` by ``tokens``: cleaned, split, stop words removed."""
    tokens = term_tokens(F.col("text"), words, unicode_words)
    others = [name for name in df.columns if name != "text"]
    return df.select(*others, tokens.alias("tokens"))


def _runs(kind: str, ordered: Column, starts: Column) -> Column:
    """(kind, term, tf) for every run of equal terms in a sorted array."""

    def run(start: Column, i: Column) -> Column:
        end = F.coalesce(F.get(starts, i + 1), F.size(ordered))
        return F.struct(
            F.lit(kind).alias("kind"),
            F.get(ordered, start).alias("term"),
            (end - start).cast("long").alias("tf"),
        )

    return F.transform(starts, run)


def _starts(ordered: Column) -> Column:
    """Where the runs of a sorted array begin."""
    return F.array_compact(
        F.transform(
            ordered,
            lambda term, i: F.when((i == 0) | (term != F.get(ordered, i - 1)), i),
        )
    )


def _present_tokens() -> Column:
    """The tokens, none for a missing text."""
    return F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens")


def _terms_of(kind: str) -> Column:
    return F.col("tokens") if kind == UNIGRAM else bigrams(F.col("tokens"))


def _runs_by_kind(docs: DataFrame, kinds: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    """``docs`` with sorted terms and where their runs begin, and the runs of each kind."""
    carried = [name for name in docs.columns if name != "tokens"]
    ordered = docs.select(*carried, _present_tokens()).select(
        *carried, *[F.sort_array(_terms_of(kind)).alias(f"{kind}_terms") for kind in kinds]
    )

    marked = ordered.select(
        "*", *[_starts(F.col(f"{kind}_terms")).alias(f"{kind}_starts") for kind in kinds]
    )
    return marked, [_runs(kind, F.col(f"{kind}_terms"), F.col(f"{kind}_starts")) for kind in kinds]


def _counts_type(kinds: Sequence[str]) -> T.StructType:
    more = T.StructType().add("term", "string").add("tf", "long")
    counted = T.StructType().add("once", T.ArrayType(T.StringType())).add("more", T.ArrayType(more))
    return T.StructType([T.StructField(kind, counted) for kind in kinds])


def _counts_array(tokens: NumberedTokens, kinds: Sequence[str]) -> pa.StructArray:
    """``counts`` of the documents, as ``term_table`` has it."""

    def counted(kind: str) -> pa.StructArray:
        found = tokens.by_document(kind == BIGRAM)
        once, more = found.where(found.tf == 1), found.where(found.tf > 1)
        pairs = pa.StructArray.from_arrays([more.terms(), pa.array(more.tf)], ["term", "tf"])
        return pa.StructArray.from_arrays(
            [once.listed(once.terms()), more.listed(pairs)], ["once", "more"]
        )

    return pa.StructArray.from_arrays([counted(kind) for kind in kinds], list(kinds))


def term_table(docs: DataFrame, kinds: Sequence[str] = KINDS) -> DataFrame:
    """One row per document, stored: its other columns and ``counts``, how often it holds
    each term: by kind the terms that it holds ``once``, and (term, tf) of those it holds
    ``more`` often. ``term_counts`` gives them as rows.

    Vocabulary, weights and scores all come from this table, so texts are tokenized once.
    All tokens of a document are in its row, so nothing is shuffled to count them: they
    are numbered and sorted as numbers, in Arrow batches.
    """
    carried = [name for name in docs.columns if name != "tokens"]
    spread = docs.select(*carried, _present_tokens())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, tokens in numbered_chunks(batch):
                columns = [some.column(name) for name in carried]
                yield pa.RecordBatch.from_arrays([*columns, _counts_array(tokens, kinds)], [*carried, "counts"])

    schema = T.StructType([*spread.schema.fields[:-1], T.StructField("counts", _counts_type(kinds))])
    return durable(spread.mapInArrow(run, schema), "term-table")


def _table_counts(table: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """(kind, term, tf) with the document's columns, of a ``term_table``; the terms held once
    and those held more often are read apart."""
    carried = [name for name in table.columns if name != "counts"]
    parts = []
    for kind in kinds:
        named = [*carried, F.lit(kind).alias("kind")]
        once, more = (F.col("counts")[kind][part] for part in ("once", "more"))
        parts.append(
            table.select(*named, F.explode(once).alias("term")).withColumn("tf", F.lit(1).cast("long"))
        )
        parts.append(table.select(*named, F.inline(more)))
    return reduce(DataFrame.unionAll, parts)


def is_term_table(docs: DataFrame) -> bool:
    return "counts" in docs.columns and "tokens" not in docs.columns


def term_counts(docs: DataFrame, kinds: Sequence[str] = KINDS) -> DataFrame:
    """How often each term occurs in each document: one row per (row, kind, term).

    ``docs`` holds ``tokens`` and the columns to carry along, or is a ``term_table``, of
    whose kinds those in ``kinds`` are read. All tokens of a document are in its row, so they are sorted and
    counted there; no (document, term) pair is shuffled. Unigrams and bigrams come out of
    the same pass.
    """
    carried = [name for name in docs.columns if name not in ("tokens", "counts")]
    if is_term_table(docs):
        held = docs.schema["counts"].dataType.names
        return _table_counts(docs, [kind for kind in held if kind in kinds])
    marked, runs = _runs_by_kind(docs, kinds)
    # The array is an expression here, not a column: for a column the optimizer
    # adds a filter on its size, which would tokenize every text a second time.
    together = F.concat(*runs) if len(runs) > 1 else runs[0]
    return marked.select(*carried, F.inline(together))


def _table_statistics(table: DataFrame, kinds: Sequence[str], min_documents: int) -> DataFrame:
    """The statistics of a stored table: it is read, not tokenized, and has one row to add
    for each document and term. The number of documents is that of its rows."""
    terms = (
        _table_counts(table.select("counts"), kinds)
        .groupBy("kind", "term")
        .agg(F.sum("tf").alias("cf"), F.count(F.lit(1)).alias("df"))
    )
    documents = table.agg(F.count(F.lit(1)).alias("df")).select(
        F.lit(DOCUMENT).alias("kind"), F.lit("").alias("term"), F.lit(0).cast("long").alias("cf"), "df"
    )
    return terms.unionAll(documents).where(F.col("df") >= min_documents)


def term_statistics(
    docs: DataFrame, kinds: Sequence[str] = KINDS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """Corpus and document frequency of each term that is not too rare.

    One pass: the tokens of an Arrow batch are numbered, and its terms added up as numbers
    before any of them is sent. One more row of each batch, of kind ``document``, brings
    the number of its documents along.
    """
    if is_term_table(docs):
        return _table_statistics(docs, kinds, min_documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, tokens in numbered_chunks(batch):
                yield _statistics_batch(DOCUMENT, pa.array([""]), [0], [some.num_rows])
                for kind in kinds:
                    yield _statistics_batch(kind, *tokens.over_all(kind == BIGRAM))

    sums = docs.select(_present_tokens()).mapInArrow(run, "kind string, term string, cf long, df long")
    return (
        sums.groupBy("kind", "term")
        .agg(F.sum("cf").alias("cf"), F.sum("df").alias("df"))
        .where(F.col("df") >= min_documents)
    )


def _statistics_batch(kind: str, term: pa.Array, cf: Sequence[int], df: Sequence[int]) -> pa.RecordBatch:
    columns = [pa.array([kind] * len(term), pa.string()), term, pa.array(cf, pa.int64()), pa.array(df, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["kind", "term", "cf", "df"])


def _stored_statistics(docs: DataFrame, kinds: Sequence[str], min_documents: int) -> DataFrame:
    """Term statistics in the work folder."""
    return durable(term_statistics(docs, kinds, min_documents), "term-statistics")


def _first_terms(tied: DataFrame, room: int, spare: int) -> Column:
    """Condition that holds for the first ``room`` terms of ``tied`` and ``spare`` more at most.

    Terms are counted by the next two bytes behind what all of them share, 65,793 groups
    at most; those before the group where the room ends are in, that group is looked at
    again. Every round parts it, and no round orders or gathers terms.
    """
    code = F.col("term").cast("binary")
    left = tied.agg(F.count(F.lit(1)).alias("n"), F.min("term").alias("a"), F.max("term").alias("z"))
    group, taken, keep = left.first(), 0, F.lit(True)
    while taken + group["n"] > room + spare:
        shared = os.path.commonprefix([group["a"].encode(), group["z"].encode()])
        head = F.substring(code, 1, len(shared) + 2)
        groups = (
            tied.where(F.substring(code, 1, len(shared)) == F.lit(shared))
            .groupBy(head.alias("head"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("term").alias("a"), F.max("term").alias("z"))
        )
        so_far = F.sum("n").over(Window.orderBy("head"))
        reached = groups.withColumn("upto", so_far).where(F.col("upto") >= room - taken)
        group = reached.agg(F.min(F.struct("upto", "n", "a", "z", "head")).alias("group")).first()["group"]
        taken += group["upto"] - group["n"]
        last = bytes(group["head"])
        keep = F.substring(code, 1, len(last)) <= F.lit(last)
    return keep


def _best_terms(stored: DataFrame, kinds: Sequence[str], vocab_size: int) -> DataFrame:
    """The ``vocab_size`` best terms of each kind, numbered.

    How many terms have each frequency, a small table, says at which frequency the
    vocabulary is full. All terms above it are in; those tied at it are narrowed down by
    their first letters until ``vocab_size`` too many are left at most. So a task numbers
    no more than ``2 * vocab_size`` terms, however many are tied.
    """
    sizes = (
        stored.where(F.col("kind").isin(*kinds))
        .groupBy("kind", "cf")
        .agg(F.count(F.lit(1)).alias("terms"))
    )
    upto = F.sum("terms").over(Window.partitionBy("kind").orderBy(F.desc("cf")))
    before = F.col("upto") - F.col("terms")
    cut = (
        sizes.withColumn("upto", upto)
        .where(before < vocab_size)
        .groupBy("kind")
        .agg(F.min(F.struct("cf", "upto", "terms")).alias("cut"))
    )
    kept = F.lit(False)
    for kind, (frequency, reached, ties) in cut.collect():
        of_kind = F.col("kind") == kind
        tied = F.col("cf") == frequency
        if reached <= 2 * vocab_size:
            kept = kept | (of_kind & (F.col("cf") >= frequency))
        else:
            first = _first_terms(stored.where(of_kind & tied), vocab_size - (reached - ties), vocab_size)
            kept = kept | (of_kind & ((F.col("cf") > frequency) | (tied & first)))
    best_first = Window.partitionBy("kind").orderBy(F.desc("cf"), "term")
    return (
        stored.where(kept)
        .withColumn("term_index", (F.row_number().over(best_first) - 1).cast("long"))
        .where(F.col("term_index") < vocab_size)
        .select("kind", "term", "term_index", "cf", "df")
    )


def vocabulary(
    docs: DataFrame,
    kinds: Sequence[str] = KINDS,
    vocab_size: int = VOCAB_SIZE,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """The most frequent terms of each kind in ``docs``, numbered from 0.

    Equal frequencies are ordered by the term, so the cut is always the same. The
    statistics are stored first, so the texts are read once for all kinds. ``docs`` holds
    ``tokens``, or is a ``term_table``.
    """
    return _best_terms(_stored_statistics(docs, kinds, min_documents), kinds, vocab_size)


def top_terms(docs: DataFrame, k: int, kinds: Sequence[str] = KINDS) -> DataFrame:
    """The ``k`` most frequent terms of each kind, however few documents hold them."""
    return vocabulary(docs, kinds, k, min_documents=1)


def vocabulary_size(
    docs: DataFrame,
    kinds: Sequence[str] = KINDS,
    vocab_size: int = VOCAB_SIZE,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """Terms in the vocabulary of each kind; nothing is ordered to count them."""
    found = term_statistics(docs, kinds, min_documents).where(F.col("kind").isin(*kinds))
    size = F.least(F.count(F.lit(1)), F.lit(vocab_size)).cast("long")
    return found.groupBy("kind").agg(size.alias("terms"))


def inverse_document_frequency(rows: Column, df: Column) -> Column:
    return F.ln((rows + 1) / (df + 1))


def fit_terms(
    docs: DataFrame,
    kinds: Sequence[str] = KINDS,
    vocab_size: int = VOCAB_SIZE,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """Vocabulary and IDF learned from ``docs``, stored in the work folder.

    At most ``vocab_size`` rows per kind. The texts are read once: terms and
    documents are counted together. A ``term_table`` is read in their place.
    """
    stored = _stored_statistics(docs, kinds, min_documents)
    rows = stored.where(F.col("kind") == DOCUMENT).select("df").scalar()
    terms = _best_terms(stored, kinds, vocab_size)
    idf = inverse_document_frequency(rows, F.col("df")).alias("idf")
    return durable(terms.select("*", idf), "terms")


def fit_for_broadcast(terms: DataFrame) -> bool:
    """Whether ``terms``, which are read for it, are few enough to be sent to every task, a
    row counted as its term and 64 bytes."""
    size = F.sum(F.octet_length("term") + 64)
    return fits_broadcast(terms.sparkSession, lambda: terms.agg(size).first()[0] or 0, BROADCAST_BYTES)


def for_broadcast(terms: DataFrame) -> DataFrame:
    """``terms`` with a hint to broadcast them, if they are few: joined by shuffle, every
    term of every document would move."""
    return F.broadcast(terms) if fit_for_broadcast(terms) else terms


def known_terms(counts: DataFrame, terms: DataFrame) -> DataFrame:
    """Counts of vocabulary terms only."""
    known = for_broadcast(terms.select("kind", "term"))
    return counts.join(known, ["kind", "term"], "left_semi")


def tfidf(counts: DataFrame, terms: DataFrame) -> DataFrame:
    """Counts of vocabulary terms with their document frequency and weight."""
    learned = for_broadcast(terms.select("kind", "term", "term_index", "df", "idf"))
    return counts.join(learned, ["kind", "term"]).withColumn(
        "tfidf", F.col("tf") * F.col("idf")
    )
