"""The logistic regression as a table: weights of terms, joined with counts of terms.

A linear model over TF-IDF is a weight per term. Scoring is then a join of the term table
with the weights and a sum per document, and the loss and its gradient are sums over the
same rows. Nothing is turned into vectors and no vocabulary has to reach the driver, so the
weights may be any number of terms; they are broadcast where they are few enough.

Documents keep their columns. ``row`` is a number that tells documents apart; columns of a
document are grouped with it, so carry few. A document without a known term, null or empty
text included, has the intercept as its margin.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewise.operators.terms import (
    BIGRAM,
    UNIGRAM,
    fit_for_broadcast,
    for_broadcast,
    term_counts,
    term_table,
)
from ratewise.session import durable

#: Rows of the term table whose terms are looked up at a time.
SLICE_ROWS = 2_000
#: From so many documents on, terms are looked up in Arrow batches and not joined: fewer are
#: joined sooner than Python workers are ready.
MANY_DOCUMENTS = 5_000
#: Kinds of the rows that ``_sums`` adds to those of terms.
TOTALS = DOCUMENTS, LABELED, LOSS, RESIDUAL = "documents", "labeled", "loss", "residual"


def numbered_table(tokens: DataFrame) -> DataFrame:
    """The stored term table of ``tokens`` with a number ``row`` for each document.

    The number is stored with the document, so it is the same in every later reading.
    """
    return term_table(tokens.withColumn("row", F.monotonically_increasing_id()))


def model_terms(model: LogisticRegressionModel, learned: DataFrame) -> DataFrame:
    """(kind, term, idf, coefficient) of a model fitted on the vocabulary ``learned``.

    A coefficient's place in the vector is the ``term_index``, bigrams behind unigrams.
    As many rows as the model has features leave the driver, where the model is anyway.
    """
    unigrams = learned.where(F.col("kind") == UNIGRAM).count()
    place = F.col("term_index") + F.when(F.col("kind") == BIGRAM, unigrams).otherwise(0)
    listed = list(enumerate(model.coefficients.toArray().tolist()))
    coefficients = learned.sparkSession.createDataFrame(listed, "place long, coefficient double")
    placed = learned.select("kind", "term", "idf", place.alias("place"))
    return durable(placed.join(coefficients, "place").drop("place"), "model-terms")


def _margins(table: DataFrame, weights: DataFrame, intercept: float) -> DataFrame:
    """The table's columns without the counts, and the margin of each document."""
    few = fit_for_broadcast(weights)
    if few and table.count() >= MANY_DOCUMENTS:
        return _sent_margins(table, weights, intercept)
    return _joined_margins(table, weights, intercept, few)


def _sent_margins(table: DataFrame, weights: DataFrame, intercept: float) -> DataFrame:
    """Few weights are sent to the tasks: the margin of a document comes from its row, so
    no term becomes a row of its own and nothing is shuffled."""
    carried = [field for field in table.schema.fields if field.name != "counts"]
    names = [*[field.name for field in carried], "margin"]
    start_at = float(intercept)
    shared = table.sparkSession.sparkContext.broadcast(_lookup(weights, table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, coefficients = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                some = batch.slice(start, SLICE_ROWS)
                margin = _margin(some.num_rows, start_at, coefficients, _entries(some.column("counts"), terms))
                columns = [some.column(name) for name in names[:-1]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(margin)], names)

    return table.mapInArrow(run, T.StructType([*carried, T.StructField("margin", T.DoubleType())]))


def _joined_margins(table: DataFrame, weights: DataFrame, intercept: float, few: bool) -> DataFrame:
    carried = [name for name in table.columns if name != "counts"]
    x = F.col("tf") * F.col("idf")

    def of_kind(kind: str) -> DataFrame:
        """Joined by the term alone, which is looked up faster than with its kind."""
        some = weights.where(F.col("kind") == kind).drop("kind")
        known = term_counts(table, [kind]).join(F.broadcast(some) if few else some, "term")
        return known.select(*carried, (x * F.col("coefficient")).alias("share"))

    shares = reduce(DataFrame.unionAll, map(of_kind, table.schema["counts"].dataType.names))
    # a row without a share for documents without a known term
    every = table.select(*carried, F.lit(None).cast("double").alias("share"))
    margin = F.coalesce(F.sum("share"), F.lit(0.0)) + F.lit(float(intercept))
    return shares.unionAll(every).groupBy(*carried).agg(margin.alias("margin"))


def probability(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))


def score_terms(table: DataFrame, weights: DataFrame, intercept: float) -> DataFrame:
    """Prediction, probability and margin of every document of a ``numbered_table``.

    ``weights`` is (kind, term, idf, coefficient). All terms of a document come from one
    row, so a task adds them up before the shuffle: a row per document is sent. If there are
    few weights and many documents, nothing is shuffled.
    """
    carried = [name for name in table.columns if name != "counts"]
    scored = _margins(table, weights, intercept)
    kept = [name for name in carried if name != "row"]
    margin = F.col("margin")
    return scored.select(
        *kept,
        (margin > 0).cast("double").alias("prediction"),
        probability(margin).alias("probability"),
        margin.alias("score"),
    )


def _residuals(table: DataFrame, weights: DataFrame, intercept: float) -> DataFrame:
    """Per document: row, label, margin, and probability less label; stored."""
    margins = _margins(table.select("row", "label", "counts"), weights, intercept)
    residual = probability(F.col("margin")) - F.col("label")
    return durable(margins.withColumn("residual", residual), "residuals")


def _loss(margin: Column, label: Column) -> Column:
    """ln(1 + exp(margin)) - label * margin, without overflow."""
    return F.greatest(margin, F.lit(0.0)) + F.log1p(F.exp(-F.abs(margin))) - label * margin


def gradient(table: DataFrame, weights: DataFrame, intercept: float) -> DataFrame:
    """(kind, term, gradient) of the average log loss over the documents of ``table``.

    ``table`` is a ``numbered_table`` with a ``label`` of 0 or 1. Terms without a weight
    and documents of other weight tables have no part; every known term has a row.
    """
    if fit_for_broadcast(weights):
        sums = _sums(table, [(weights, intercept)])
        documents = sums.where(F.col("kind") == DOCUMENTS).select("value").scalar()
        of_terms = sums.where(~F.col("kind").isin(*TOTALS))
        return of_terms.select("kind", "term", (F.col("value") / documents).alias("gradient"))
    return _gradient(table, weights, _residuals(table, weights, intercept))


def _gradient(table: DataFrame, weights: DataFrame, rows: DataFrame) -> DataFrame:
    """Documents meet their residuals as whole rows of the table, not term by term."""
    documents = rows.agg(F.count(F.lit(1))).scalar()
    known = for_broadcast(weights.select("kind", "term", "idf"))
    weighed = table.select("row", "counts").join(rows.select("row", "residual"), "row").drop("row")
    x = F.col("tf") * F.col("idf")
    return (
        term_counts(weighed)
        .join(known, ["kind", "term"])
        .groupBy("kind", "term")
        .agg((F.sum(F.col("residual") * x) / documents).alias("gradient"))
    )


#: Weights and intercept.
Model = tuple[DataFrame, float]


def _sums(table: DataFrame, models: Sequence[Model]) -> DataFrame:
    """(model, kind, term, value), stored: of each known term the sum of residual and x; and
    of the documents their number, that of those with a label, and the sums of loss and
    residual. ``model`` is the place among ``models``.

    One pass: margin, residual and share in the gradient of a document come from its row, so
    no document moves. A task sends a row for each term that it knows. The weights, which
    must be few enough, are sent to the tasks; terms are looked up once for models that
    have the same.
    """
    lookups, known = [], []
    for weights, intercept in models:
        terms, coefficients = _lookup(weights, table)
        same = [i for i, others in enumerate(lookups) if _same_terms(terms, others)]
        if not same:
            lookups.append(terms)
        known.append((same[0] if same else len(lookups) - 1, coefficients, float(intercept)))
    shared = table.sparkSession.sparkContext.broadcast((lookups, known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookups, known = shared.value
        parts = [_PartSums(lookups[i], *model) for i, *model in known]
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                some = batch.slice(start, SLICE_ROWS)
                found = [_entries(some.column("counts"), terms) for terms in lookups]
                label = some.column("label").cast(pa.float64()).to_numpy(zero_copy_only=False)
                for (i, *_), part in zip(known, parts, strict=True):
                    part.add(label, found[i])
        for number, part in enumerate(parts):
            yield from part.rows(number)

    schema = "model int, kind string, term string, value double"
    parts = table.select("label", "counts").mapInArrow(run, schema)
    return durable(parts.groupBy("model", "kind", "term").agg(F.sum("value").alias("value")), "loss-sums")


#: Of a kind: the terms, and their IDF.
Terms = dict[str, tuple[pa.Array, np.ndarray]]


def _lookup(weights: DataFrame, table: DataFrame) -> tuple[Terms, dict[str, np.ndarray]]:
    """By kind of the table the terms with their IDF, and the coefficients."""
    kinds = table.schema["counts"].dataType.names
    rows = weights.where(F.col("kind").isin(*kinds)).orderBy("kind", "term").toArrow().combine_chunks()
    terms, coefficients = {}, {}
    for kind in kinds:
        some = rows.filter(pc.equal(rows.column("kind"), kind))
        terms[kind] = (some.column("term").combine_chunks(), some.column("idf").fill_null(0.0).to_numpy())
        # a missing coefficient adds nothing to a margin
        coefficients[kind] = some.column("coefficient").fill_null(0.0).to_numpy()
    return terms, coefficients


def _same_terms(some: Terms, others: Terms) -> bool:
    return all(t.equals(others[kind][0]) and np.array_equal(x, others[kind][1]) for kind, (t, x) in some.items())


def _entries(counts: pa.StructArray, known: Terms) -> Entries:
    """Kind, row, place among the known terms, and tf * idf of the terms that are known."""
    out = []
    for kind, (terms, idf) in known.items():
        for part in ("once", "more"):
            lists = pc.struct_field(counts, [kind, part])
            row, flat = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False), lists.flatten()
            word = flat if part == "once" else pc.struct_field(flat, "term")
            place = pc.index_in(word, value_set=terms).fill_null(-1).to_numpy(zero_copy_only=False)
            at = np.flatnonzero(place >= 0)
            x = idf[place[at]]
            if part == "more":
                x = x * pc.struct_field(flat, "tf").to_numpy(zero_copy_only=False)[at]
            out.append((kind, row[at], place[at], x))
    return out


#: Kind, row, place among the known terms, and tf * idf.
Entries = list[tuple[str, np.ndarray, np.ndarray, np.ndarray]]


def _margin(rows: int, intercept: float, coefficients: dict[str, np.ndarray], entries: Entries) -> np.ndarray:
    margin = np.full(rows, intercept)
    for kind, row, place, x in entries:
        margin += np.bincount(row, x * coefficients[kind][place], rows)
    return margin


class _PartSums:
    """What the documents of a task add to loss and gradient of a model."""

    def __init__(self, terms: Terms, coefficients: dict[str, np.ndarray], intercept: float):
        self.terms, self.coefficients, self.intercept = terms, coefficients, intercept
        self.gradient = {kind: np.zeros(len(c)) for kind, c in coefficients.items()}
        self.met = {kind: np.zeros(len(c), bool) for kind, c in coefficients.items()}
        self.totals = dict.fromkeys(TOTALS, 0.0)

    def add(self, label: np.ndarray, entries: Entries) -> None:
        margin = _margin(len(label), self.intercept, self.coefficients, entries)
        small = np.exp(-np.abs(margin))
        residual = np.where(margin > 0, 1.0, small) / (1 + small) - label
        loss = np.maximum(margin, 0) + np.log1p(small) - label * margin
        labeled = ~np.isnan(label)
        residual[~labeled] = 0
        for kind, row, place, x in entries:
            self.gradient[kind] += np.bincount(place, residual[row] * x, len(self.gradient[kind]))
            self.met[kind][place] = True
        more = (len(label), labeled.sum(), loss[labeled].sum(), residual.sum())
        for name, value in zip(TOTALS, more, strict=True):
            self.totals[name] += float(value)

    def rows(self, number: int) -> Iterator[pa.RecordBatch]:
        if not self.totals[DOCUMENTS]:
            return
        parts = [(name, pa.array([""]), np.array([value])) for name, value in self.totals.items()]
        for kind, (terms, _) in self.terms.items():
            at = np.flatnonzero(self.met[kind])
            parts.append((kind, terms.take(pa.array(at)), self.gradient[kind][at]))
        for kind, term, value in parts:
            named = [pa.array([number] * len(term), pa.int32()), pa.array([kind] * len(term), pa.string())]
            yield pa.RecordBatch.from_arrays([*named, term, pa.array(value)], ["model", "kind", "term", "value"])


def log_loss(table: DataFrame, weights: DataFrame, intercept: float) -> DataFrame:
    """One row: documents, average log loss, and the gradient's norm and part by intercept.

    One pass over the term table gives all sums. Where the weights are too many to send
    them to each task, one pass gives the residuals, which are stored; the loss is a sum
    over them, the gradient one over the table with them. No documents: a loss of null and a
    norm of zero.
    """
    return log_losses(table, (weights, intercept))[0]


def log_losses(table: DataFrame, *models: Model) -> list[DataFrame]:
    """``log_loss`` of each of the models, which share the pass if their weights are few."""
    if all(fit_for_broadcast(weights) for weights, _ in models):
        sums = _sums(table, models)
        return [_loss_of_sums(sums.where(F.col("model") == i)) for i in range(len(models))]
    return [_joined_loss(table, *model) for model in models]


def _joined_loss(table: DataFrame, weights: DataFrame, intercept: float) -> DataFrame:
    rows = _residuals(table, weights, intercept)
    by_term = _gradient(table, weights, rows).agg(F.coalesce(F.sum(F.col("gradient") ** 2), F.lit(0.0)).alias("squares"))
    sums = rows.agg(
        F.count(F.lit(1)).alias("documents"),
        F.avg(_loss(F.col("margin"), F.col("label"))).alias("loss"),
        F.avg("residual").alias("intercept_gradient"),
    )
    return _loss_row(sums.join(by_term))


def _loss_of_sums(sums: DataFrame) -> DataFrame:
    total = {name: F.sum(F.when(F.col("kind") == name, F.col("value"))) for name in TOTALS}
    documents = F.coalesce(total[DOCUMENTS], F.lit(0.0))
    squares = F.sum(F.when(~F.col("kind").isin(*TOTALS), F.col("value") ** 2))
    rows = sums.agg(
        documents.cast("long").alias("documents"),
        F.try_divide(total[LOSS], total[LABELED]).alias("loss"),
        F.try_divide(total[RESIDUAL], total[LABELED]).alias("intercept_gradient"),
        F.coalesce(F.try_divide(squares, documents**2), F.lit(0.0)).alias("squares"),
    )
    return _loss_row(rows)


def _loss_row(rows: DataFrame) -> DataFrame:
    whole = F.col("squares") + F.coalesce(F.col("intercept_gradient"), F.lit(0.0)) ** 2
    return rows.select("documents", "loss", F.sqrt(whole).alias("gradient_norm"), "intercept_gradient")
