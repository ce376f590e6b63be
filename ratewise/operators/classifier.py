"""Feature vectors and the logistic regression, through MLlib."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    NGram,
    RegexTokenizer,
    SQLTransformer,
    StopWordsRemover,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.functions.text import (
    MIN_TOKEN_LENGTH,
    SPACE_PATTERN,
    SPLIT_PATTERN,
    STOP_WORDS,
    URL_PATTERN,
    URL_STARTS,
    term_tokens,
)
from ratewise.operators.labeling import assign_split
from ratewise.operators.terms import (
    BIGRAM,
    KINDS,
    MIN_DOCUMENTS,
    UNIGRAM,
    VOCAB_SIZE,
    fit_terms,
    with_tokens,
)
from ratewise.schema import REVIEW_COLUMNS, project_existing, require_columns
from ratewise.session import durable

# Settings of the classifier.
MAX_ITERATIONS = 30
REGULARISATION = 0.0
ELASTIC_NET = 0.0

#: Column of the tokens that count.
TOKENS = "tokens_nostop"

#: A missing text is cleaned like an empty one.
CLEAN_STATEMENT = f"""
SELECT *, trim(regexp_replace(lower(
    CASE WHEN contains(text, '{URL_STARTS[0]}') OR contains(text, '{URL_STARTS[1]}')
         THEN regexp_replace(text, r'{URL_PATTERN}', ' ') ELSE coalesce(text, '') END
  ), r'{SPACE_PATTERN}', ' ')) AS text_clean
FROM __THIS__"""


@dataclass(frozen=True)
class FeatureModel:
    """A fitted feature pipeline, the sizes of its two vocabularies, and their terms with
    the IDF weights as a stored table."""

    stages: PipelineModel
    unigrams: int
    bigrams: int
    terms: DataFrame


def fit_features(
    labeled: DataFrame,
    vocab_size: int = VOCAB_SIZE,
    min_documents: int = MIN_DOCUMENTS,
    words: tuple[str, ...] = STOP_WORDS,
    unicode_words: bool = False,
) -> FeatureModel:
    """Learn both vocabularies and the IDF weights from ``labeled``.

    One pass over the texts in place of one per estimator: the relational count
    gives the terms of both vocabularies, ties broken by term, and their document
    frequencies. The count vectorizers take those terms in the order of their
    ``term_index``, and no IDF stage is left to fit. Only the vocabularies, at most
    ``vocab_size`` terms each, reach the driver, as MLlib needs them there.
    """
    require_columns(labeled, ["text"])
    tokens = with_tokens(labeled.select("text"), words, unicode_words)
    return _fit(tokens, vocab_size, min_documents, words, unicode_words)


def _fit(
    tokens: DataFrame, vocab_size: int, min_documents: int, words: tuple[str, ...], unicode_words: bool
) -> FeatureModel:
    learned = fit_terms(tokens, KINDS, vocab_size, min_documents)
    known = {kind: [] for kind in KINDS}
    for row in sorted(learned.collect(), key=lambda row: row["term_index"]):
        known[row["kind"]].append(row)
    empty = [kind for kind in KINDS if not known[kind]]
    if empty:
        raise ValueError(f"no term in {min_documents} or more documents: {', '.join(empty)}")
    counters = [
        _counter([row["term"] for row in known[kind]], column, counted)
        for kind, column, counted in (
            (UNIGRAM, TOKENS, "tf_uni"),
            (BIGRAM, "bigrams", "tf_bi"),
        )
    ]
    weights = [row["idf"] for kind in KINDS for row in known[kind]]
    stages = [
        SQLTransformer(statement=CLEAN_STATEMENT),
        RegexTokenizer(
            inputCol="text_clean",
            outputCol="tokens",
            pattern=f"(?U){SPLIT_PATTERN}" if unicode_words else SPLIT_PATTERN,
            minTokenLength=MIN_TOKEN_LENGTH,
            toLowercase=False,
        ),
        StopWordsRemover(
            inputCol="tokens", outputCol=TOKENS, stopWords=list(words)
        ),
        NGram(n=2, inputCol=TOKENS, outputCol="bigrams"),
        *counters,
        VectorAssembler(inputCols=["tf_uni", "tf_bi"], outputCol="tf"),
        ElementwiseProduct(scalingVec=Vectors.dense(weights), inputCol="tf", outputCol="features"),
    ]
    return FeatureModel(PipelineModel(stages), len(known[UNIGRAM]), len(known[BIGRAM]), learned)


def _counter(vocabulary: list[str], column: str, counted: str) -> CountVectorizerModel:
    """``CountVectorizerModel.from_vocabulary``, which would send each term in a call of its
    own: here all go in one, as lines. No term holds a line end."""
    jvm = SparkContext._active_spark_context._jvm
    terms = jvm.java.util.regex.Pattern.compile("\n").split("\n".join(vocabulary))
    model = CountVectorizerModel(jvm.org.apache.spark.ml.feature.CountVectorizerModel(terms))
    return model.setInputCol(column).setOutputCol(counted)


def add_features(model: PipelineModel, reviews: DataFrame) -> DataFrame:
    """The review columns plus ``features``; the steps in between are dropped."""
    kept = [*REVIEW_COLUMNS, "split", "features"]
    return project_existing(model.transform(reviews), kept)


def split_features(
    labeled: DataFrame,
    key: str = "review_id",
    fit_on: str = "train",
    vocab_size: int = VOCAB_SIZE,
    min_documents: int = MIN_DOCUMENTS,
    words: tuple[str, ...] = STOP_WORDS,
    unicode_words: bool = False,
) -> tuple[FeatureModel, DataFrame]:
    """Split by key, learn the features, and apply them to both sides.

    They are learned from the training side, so the test rows stay unseen;
    ``fit_on="all"`` learns from every row. Texts are tokenized once: the tokens are
    stored with the rows, and both the vocabularies and the vectors come from there.
    """
    require_columns(labeled, ["text"])
    rows = project_existing(assign_split(labeled, key), [*REVIEW_COLUMNS, "split"])
    tokens = term_tokens(F.col("text"), words, unicode_words)
    stored = durable(rows.withColumn(TOKENS, tokens), "tokens")
    seen = stored if fit_on == "all" else stored.where(F.col("split") == fit_on)
    model = _fit(seen.select(F.col(TOKENS).alias("tokens")), vocab_size, min_documents, words, unicode_words)
    # a missing text has the features of an empty one
    present = F.coalesce(TOKENS, F.array().cast("array<string>"))
    behind = [i for i, stage in enumerate(model.stages.stages) if isinstance(stage, StopWordsRemover)][0] + 1
    return model, add_features(PipelineModel(model.stages.stages[behind:]), stored.withColumn(TOKENS, present))


def train_classifier(
    train: DataFrame,
    max_iterations: int = MAX_ITERATIONS,
    regularisation: float = REGULARISATION,
    elastic_net: float = ELASTIC_NET,
    aggregation_depth: int = 2,
) -> LogisticRegressionModel:
    """Fit the binary logistic regression on ``label`` and ``features``.

    A wider cluster takes a deeper ``aggregation_depth``, so that no single
    merge has to add up the gradients of very many tasks.
    """
    require_columns(train, ["label", "features"])
    return LogisticRegression(
        featuresCol="features",
        labelCol="label",
        maxIter=max_iterations,
        regParam=regularisation,
        elasticNetParam=elastic_net,
        aggregationDepth=aggregation_depth,
    ).fit(train.select("label", "features"))


def score_rows(model: LogisticRegressionModel, features: DataFrame) -> DataFrame:
    """Prediction, probability and margin of the positive class.

    ``score`` is the raw margin. It orders rows as the probability does but does
    not run into ties near 0 and 1.
    """
    scored = model.transform(features)
    margin = vector_to_array("rawPrediction")[1]
    positive = vector_to_array("probability")[1]
    kept = [c for c in features.columns if c not in ("features", "text")]
    return scored.select(
        *kept, "prediction", positive.alias("probability"), margin.alias("score")
    )


def score_text(
    features: PipelineModel, model: LogisticRegressionModel, reviews: DataFrame
) -> DataFrame:
    """Score raw text with the saved features and the saved classifier."""
    require_columns(reviews, ["text"])
    return score_rows(model, add_features(features, reviews))


def save_model(model: PipelineModel | LogisticRegressionModel, path: str) -> None:
    """Save a fitted model, replacing an older one at the same path."""
    model.write().overwrite().save(path)


def load_features(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_classifier(path: str) -> LogisticRegressionModel:
    return LogisticRegressionModel.load(path)
