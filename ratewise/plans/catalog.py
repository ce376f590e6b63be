"""The query catalog: every operator run over the given tables.

A query takes a session and the folder of the tables and returns a table whose
columns carry the same names as its SQL counterpart in ``oracles``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise import schema
from ratewise.functions import numbers, text
from ratewise.operators import classifier, labeling, metrics, profile, scaling, term_model, terms
from ratewise.session import INPUT_PARTITIONS, new_path
from ratewise.sources import reviews as tables
from ratewise.sources import runlog

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EVENTS = (
    "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
)


def query(run: Query) -> Query:
    """Register a query under the name of its function."""
    QUERIES[run.__name__] = run
    return run


# --- inputs ---------------------------------------------------------------


def _reviews(spark: SparkSession, folder: str) -> DataFrame:
    return tables.table_reviews(spark, folder)


def _partitions(spark: SparkSession) -> int | None:
    """Over how many tasks the session wants texts dealt that take hard work."""
    wanted = spark.conf.get(INPUT_PARTITIONS, None)
    return int(wanted) if wanted else None


def _spread_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """The reviews for queries that work hard on each text."""
    return tables.table_reviews(spark, folder, _partitions(spark))


def _damaged(spark: SparkSession, folder: str) -> DataFrame:
    """The reviews with missing, blank and off-scale values in known rows."""
    digit = F.col("review_id") % 10
    return _reviews(spark, folder).select(
        "review_id",
        "user_id",
        "business_id",
        F.when(digit == 2, 6.0).when(digit != 3, F.col("stars")).alias("stars"),
        F.when(digit == 1, "   ").when(digit != 0, F.col("text")).alias("text"),
    )


def _repeated_keys(spark: SparkSession, folder: str) -> DataFrame:
    """The damaged reviews with every key shared by two rows, and some without a key."""
    halved = F.when(F.col("review_id") % 10 != 7, F.floor(F.col("review_id") / 2))
    return _damaged(spark, folder).withColumn("review_id", halved)


def _labeled(spark: SparkSession, folder: str) -> DataFrame:
    return labeling.labeled_reviews(_reviews(spark, folder))


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    return tables.table_texts(spark, folder, _partitions(spark)).select("review_id", "text")


def _tokens(spark: SparkSession, folder: str) -> DataFrame:
    return terms.with_tokens(_texts(spark, folder))


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet")


def _predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled reviews with a score that needs no model, and some without one."""
    score = (F.length("text") % 97) / 97.0
    return (
        _labeled(spark, folder)
        .select("label", "review_id", score.alias("score"))
        .withColumn("prediction", F.when(F.col("score") >= 0.5, 1.0).otherwise(0.0))
        .withColumn("score", F.when(F.col("review_id") % 10 != 4, F.col("score")))
    )


def _runs(spark: SparkSession, folder: str) -> DataFrame:
    """Run times per phase and core count, summed up from the events; one phase is null."""
    return (
        _events(spark, folder)
        .groupBy(
            F.when(F.col("event_type") != "view", F.col("event_type")).alias("phase"),
            (F.col("user_id") % 16 + 1).alias("cores"),
        )
        .agg(F.round(F.sum("value"), 2).alias("duration_sec"))
    )


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(
        *[
            F.round(name, digits).alias(name) if kind == "double" else F.col(name)
            for name, kind in df.dtypes
        ]
    )


# --- scans and sinks ------------------------------------------------------


@query
def scan_json_lines(spark: SparkSession, folder: str) -> DataFrame:
    source = _reviews(spark, folder)
    path = new_path(spark, "json")
    source.write.json(path)
    return tables.scan_json_lines(spark, path, source.schema)


@query
def labeled_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "labeled")
    tables.write_labeled(_labeled(spark, folder), path)
    return tables.scan_labeled(spark, path).select(
        "review_id", "user_id", "business_id", "stars", "text", "label"
    )


@query
def scan_labeled(spark: SparkSession, folder: str) -> DataFrame:
    """Class sizes of a compacted labelled table; the text column is never read."""
    path = new_path(spark, "labeled")
    tables.write_labeled(_labeled(spark, folder), path, compact=True)
    found = tables.scan_labeled(spark, path).groupBy("label", "business_id")
    return found.agg(F.count(F.lit(1)).alias("cnt"), F.sum("review_id").alias("key_sum"))


@query
def labeled_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs of one labelled table, one of them written again with other rows; all read
    as one table, the newest by its own folder alone."""
    path = new_path(spark, "labeled-runs")
    rows = _labeled(spark, folder)
    even = F.col("review_id") % 2 == 0
    tables.write_run(rows, path, "007")
    tables.write_run(rows.where(~even), path, "010")
    tables.write_run(rows.where(even & (F.col("label") == 1)), path, "007")
    sizes = [F.count(F.lit(1)).alias("cnt"), F.sum("review_id").alias("key_sum")]
    every = tables.scan_runs(spark, path).groupBy("run_id", "label").agg(*sizes)
    newest = tables.scan_runs(spark, path, newest=True).groupBy("run_id", "label").agg(*sizes)
    return every.withColumn("part", F.lit("all")).unionAll(newest.withColumn("part", F.lit("newest")))


@query
def metric_report(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "report")
    runlog.write_report(profile.validation_profile(_repeated_keys(spark, folder)), path)
    return spark.read.schema("metric string, value double").option("header", True).csv(path)


@query
def run_log_append(spark: SparkSession, folder: str) -> DataFrame:
    runs = (
        _events(spark, folder)
        .groupBy("event_type", "user_id")
        .agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.count_if(F.col("value") > 10).alias("vocab_uni"),
            F.count_if(F.col("value") > 20).alias("vocab_bi"),
        )
        .withColumn("run_id", F.concat_ws("-", "event_type", "user_id"))
        .withColumn("out_parquet", F.concat(F.lit("features/"), "run_id"))
    )
    path = new_path(spark, "run-log")
    bought = F.col("event_type") == "purchase"
    runlog.append_run(runs.where(bought), path, schema.FEATURE_LOG)
    runlog.append_run(runs.where(~bought), path, schema.FEATURE_LOG)
    return runlog.scan_run_log(spark, path, schema.FEATURE_LOG)


@query
def scan_run_log(spark: SparkSession, folder: str) -> DataFrame:
    """A hand-kept log with untidy header names and cells, made numeric."""
    events = _events(spark, folder)
    untidy = events.select(
        F.col("event_id").cast("string"),
        F.concat(F.lit("  "), (F.col("user_id") % 16 + 1).cast("string"), F.lit(" ")),
        F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(
            F.col("value").cast("string")
        ),
    ).toDF(" Event_ID", "CORES ", " Duration_Sec ")
    path = new_path(spark, "run-csv")
    untidy.write.option("header", True).csv(path)
    rows = runlog.scan_run_csv(spark, path, ["cores", "duration_sec"])
    return scaling.numeric_runs(rows).select(
        F.col("event_id").cast("long").alias("event_id"), "cores", "duration_sec"
    )


@query
def latest_run(spark: SparkSession, folder: str) -> DataFrame:
    log = _events(spark, folder).select("event_id", "user_id", "event_type", "value")
    return runlog.latest_run(log, "event_id")


@query
def latest_path(spark: SparkSession, folder: str) -> DataFrame:
    log = _events(spark, folder).select(
        F.col("event_id").alias("run_id"),
        F.concat(F.lit("features/"), F.col("event_id").cast("string")).alias("out_parquet"),
    )
    return runlog.latest_value(log, "out_parquet")


@query
def csv_columns(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "summary")
    summary = scaling.scaling_summary(_runs(spark, folder))
    runlog.write_columns(summary, path, ["phase", "cores", "speedup", "auc"])
    return (
        spark.read.schema("phase string, cores long, speedup double, auc double")
        .option("header", True)
        .csv(path)
    )


# --- schema checks, projections and filters -------------------------------


@query
def column_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.column_profile(_damaged(spark, folder))


@query
def merged_profile(spark: SparkSession, folder: str) -> DataFrame:
    """The profile of two runs, merged from their stored states, without their rows: exact
    counts and lengths, and whether the estimates are as near as their sketches allow."""
    rows = _damaged(spark, folder)
    path = new_path(spark, "profile-states")
    even = F.col("review_id") % 2 == 0
    for run in (rows.where(even), rows.where(~even)):
        profile.profile_state(run).write.mode("append").parquet(path)
    found = profile.read_profile(profile.merge_profiles(spark.read.parquet(path)))
    exact = profile.column_profile(rows).select("column_name", F.col("distinct_values").alias("exact"))
    ranks = rows.agg(F.percentile("stars", 0.45).alias("low"), F.percentile("stars", 0.55).alias("high"))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= 1 + 0.05 * F.col("exact")
    middle = (F.col("column_name") != "stars") | F.col("median").between(F.col("low"), F.col("high"))
    return found.join(exact, "column_name").join(ranks).select(
        "position", "column_name", "data_type", "rows", "nulls", "least_length",
        F.round("average_length", 6).alias("average_length"), "greatest_length",
        near.alias("distinct_near"), middle.alias("median_near"),
    )


@query
def project_existing(spark: SparkSession, folder: str) -> DataFrame:
    return schema.project_existing(_reviews(spark, folder), schema.REVIEW_COLUMNS)


@query
def invalid_rating(spark: SparkSession, folder: str) -> DataFrame:
    return profile.invalid_ratings(_damaged(spark, folder)).select("review_id", "stars")


@query
def null_rows(spark: SparkSession, folder: str) -> DataFrame:
    return profile.null_rows(_damaged(spark, folder)).select("review_id", "stars", "text")


@query
def blank_text(spark: SparkSession, folder: str) -> DataFrame:
    return profile.blank_rows(_damaged(spark, folder)).select("review_id", "text")


@query
def clean_rows(spark: SparkSession, folder: str) -> DataFrame:
    return labeling.clean_rows(_damaged(spark, folder)).select("review_id", "stars", "text")


@query
def label_rows(spark: SparkSession, folder: str) -> DataFrame:
    return labeling.labeled_reviews(_damaged(spark, folder)).select("review_id", "stars", "label")


@query
def dedup_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Texts repeated under other keys, the same key and no key leave one row each."""
    reviews = _reviews(spark, folder)
    twice = reviews.where(F.col("review_id") % 10 < 3)
    keyless = twice.withColumn("review_id", F.lit(None).cast("long"))
    return labeling.drop_repeated_texts(reviews.unionAll(twice).unionAll(keyless))


@query
def dedup_keys(spark: SparkSession, folder: str) -> DataFrame:
    return labeling.drop_repeated_keys(_repeated_keys(spark, folder))


# --- aggregations, sorts and limits ---------------------------------------


@query
def row_count(spark: SparkSession, folder: str) -> DataFrame:
    return profile.row_count(_reviews(spark, folder))


@query
def rating_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return profile.histogram(_damaged(spark, folder), "stars")


@query
def label_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return profile.histogram(_labeled(spark, folder), "label")


@query
def text_length_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(profile.text_length_stats(_damaged(spark, folder)))


@query
def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    return profile.duplicate_keys(_repeated_keys(spark, folder))


@query
def validation_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.validation_profile(_repeated_keys(spark, folder))


@query
def labeling_report(spark: SparkSession, folder: str) -> DataFrame:
    return profile.labeling_report(_damaged(spark, folder))


@query
def class_balance(spark: SparkSession, folder: str) -> DataFrame:
    return profile.class_balance(_damaged(spark, folder))


@query
def sample_rows(spark: SparkSession, folder: str) -> DataFrame:
    return profile.sample_rows(_reviews(spark, folder))


# --- numbers and scaling --------------------------------------------------


@query
def safe_numeric(spark: SparkSession, folder: str) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value").cast("string")
    cell = (
        F.when(kind == "click", F.concat(F.lit("  "), value, F.lit("\t")))
        .when(kind == "view", F.concat(F.lit("-"), value, F.lit("e1")))
        .when(kind == "error", F.concat(value, F.lit("d")))
        .when(kind == "signup", F.lit(""))
    )
    return _events(spark, folder).select(
        "event_id",
        numbers.safe_long(cell).alias("as_long"),
        F.round(numbers.safe_double(cell), 6).alias("as_double"),
        F.round(numbers.safe_double(cell, None), 6).alias("or_null"),
    )


@query
def scaling_baseline(spark: SparkSession, folder: str) -> DataFrame:
    return scaling.baselines(_runs(spark, folder))


@query
def scaling_summary(spark: SparkSession, folder: str) -> DataFrame:
    return scaling.scaling_summary(_runs(spark, folder))


@query
def scaling_fill(spark: SparkSession, folder: str) -> DataFrame:
    """One phase already measured, the others without speedup or core counts."""
    runs = _runs(spark, folder)
    measured = F.coalesce(F.col("phase") == "click", F.lit(False))
    partial = runs.select(
        "phase",
        F.when(measured | (F.col("cores") != 3), F.col("cores")).alias("cores"),
        "duration_sec",
        F.when(measured, F.col("cores") / 2).alias("speedup"),
        F.lit(0.5).alias("eff"),
    )
    return _rounded(scaling.fill_scaling(partial), 4)


# --- text and term features -----------------------------------------------


@query
def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = text.clean_text(F.col("text"))
    return _texts(spark, folder).select("review_id", cleaned.alias("text_clean"))


def _joined(column: Column) -> Column:
    return F.array_join(column, "|")


@query
def tokenize(spark: SparkSession, folder: str) -> DataFrame:
    tokens = text.tokenize(text.clean_text(F.col("text")))
    return _texts(spark, folder).select("review_id", _joined(tokens).alias("tokens"))


@query
def remove_stopwords(spark: SparkSession, folder: str) -> DataFrame:
    return _tokens(spark, folder).select("review_id", _joined(F.col("tokens")).alias("tokens"))


@query
def bigrams(spark: SparkSession, folder: str) -> DataFrame:
    pairs = text.bigrams(F.col("tokens"))
    return _tokens(spark, folder).select("review_id", _joined(pairs).alias("bigrams"))


def _known_counts(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    table = terms.term_table(_tokens(spark, folder), [kind])
    known = terms.known_terms(terms.term_counts(table), terms.fit_terms(table, [kind]))
    return known.select("review_id", "term", "tf")


@query
def term_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _known_counts(spark, folder, terms.UNIGRAM)


@query
def bigram_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _known_counts(spark, folder, terms.BIGRAM)


def _vocabulary(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    found = terms.vocabulary(_tokens(spark, folder), [kind])
    return found.select("term", "term_index", "cf", "df")


@query
def vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    return _vocabulary(spark, folder, terms.UNIGRAM)


@query
def bigram_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    return _vocabulary(spark, folder, terms.BIGRAM)


@query
def vocabulary_size(spark: SparkSession, folder: str) -> DataFrame:
    return terms.vocabulary_size(_tokens(spark, folder))


@query
def top_terms(spark: SparkSession, folder: str) -> DataFrame:
    found = terms.top_terms(_tokens(spark, folder), 1000)
    return found.select("kind", "term", "term_index", "cf", "df")


def _weights(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    table = terms.term_table(_tokens(spark, folder), [kind])
    weighted = terms.tfidf(terms.term_counts(table), terms.fit_terms(table, [kind]))
    return weighted.select("review_id", "term", "tf", "df", F.round("tfidf", 6).alias("tfidf"))


@query
def tfidf_unigram(spark: SparkSession, folder: str) -> DataFrame:
    return _weights(spark, folder, terms.UNIGRAM)


@query
def tfidf_bigram(spark: SparkSession, folder: str) -> DataFrame:
    return _weights(spark, folder, terms.BIGRAM)


@query
def feature_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Both kinds of weighted terms of the labelled reviews, as one table."""
    labeled = labeling.labeled_reviews(_spread_reviews(spark, folder))
    table = terms.term_table(terms.with_tokens(labeled.select("review_id", "label", "text")))
    weighted = terms.tfidf(terms.term_counts(table), terms.fit_terms(table))
    return weighted.select(
        "review_id", "label", "kind", "term", F.round("tfidf", 6).alias("tfidf")
    )


# --- split, model and metrics ---------------------------------------------


@query
def split_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows without a key are split by their content."""
    key = F.when(F.col("review_id") % 10 != 5, F.col("review_id"))
    keyed = _reviews(spark, folder).withColumn("review_id", key)
    return labeling.assign_split(keyed).select("review_id", "stars", "split")


@query
def split_without_keys(spark: SparkSession, folder: str) -> DataFrame:
    """JSON lines without keys: found out from the file, then split by content."""
    path = new_path(spark, "json")
    _reviews(spark, folder).select("stars", "text").write.json(path)
    rows = labeling.assign_split(tables.scan_json_lines(spark, path))
    return rows.groupBy("stars", "split").agg(F.count(F.lit(1)).alias("cnt"))


@query
def one_hot_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """A saved and reloaded model on one-hot features, which has a closed form: the
    margin of a cell is its log odds."""
    items = spark.read.parquet(f"{folder}/lineitem.parquet")
    cells = items.select(
        F.concat_ws("/", "l_returnflag", "l_linestatus").alias("cell"),
        (F.col("l_quantity") > 20).cast("double").alias("label"),
    )
    names = [row["cell"] for row in cells.select("cell").distinct().orderBy("cell").collect()]
    features = array_to_vector(F.array(*[(F.col("cell") == n).cast("double") for n in names]))
    rows = cells.withColumn("features", features)
    model = classifier.train_classifier(rows, max_iterations=200)
    path = new_path(spark, "classifier")
    classifier.save_model(model, path)
    scored = classifier.score_rows(classifier.load_classifier(path), rows)
    return scored.groupBy("cell").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.round(F.avg("score"), 3).alias("score"),
        F.round(F.avg("probability"), 4).alias("probability"),
        F.max("prediction").alias("prediction"),
    )


def _features(spark: SparkSession, folder: str) -> tuple[classifier.FeatureModel, DataFrame]:
    """The feature table of the labelled reviews, written and scanned back."""
    labeled = labeling.labeled_reviews(_spread_reviews(spark, folder))
    model, features = classifier.split_features(labeled.select("review_id", "text", "label"))
    path = new_path(spark, "features")
    tables.write_features(features.drop("text"), path)
    return model, tables.scan_features(spark, path)


def _side(features: DataFrame, split: str) -> DataFrame:
    return features.where(F.col("split") == split)


@query
def feature_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Entries of each stored vector: how many, their sum and sum of squares."""
    _, features = _features(spark, folder)
    entries = F.filter(F.unwrap_udt("features")["values"], lambda v: v != 0)
    measured = features.select("review_id", "label", "split", entries.alias("entries"))
    start = F.lit(0.0)
    return measured.select(
        "review_id",
        "label",
        "split",
        F.size("entries").cast("long").alias("terms"),
        F.round(F.aggregate("entries", start, lambda s, v: s + v), 4).alias("weight"),
        F.round(F.aggregate("entries", start, lambda s, v: s + v * v), 4).alias("squares"),
    )


def _fitted(
    spark: SparkSession, folder: str
) -> tuple[classifier.FeatureModel, DataFrame, classifier.LogisticRegressionModel]:
    """Feature model, feature table and the classifier trained on its training side."""
    sizes, features = _features(spark, folder)
    return sizes, features, classifier.train_classifier(_side(features, "train"))


def _labeled_table(spark: SparkSession, folder: str, split: str | None = None) -> DataFrame:
    """Term table of the labelled reviews, of all or of one side of the split."""
    labeled = labeling.assign_split(labeling.labeled_reviews(_spread_reviews(spark, folder)))
    asked = labeled if split is None else _side(labeled, split)
    return term_model.numbered_table(terms.with_tokens(asked.select("review_id", "split", "label", "text")))


def _agree(left: Column, right: Column, tolerance: float = 1e-6) -> Column:
    return F.abs(left - right) <= tolerance * (1 + F.abs(right))


@query
def train_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """What a training run counts, and proof of its fit, as (metric, value) rows.

    The log loss over the term table, which is made without MLlib, must equal the last
    objective of the fit; and it and its gradient must be below those of zero weights.
    """
    sizes, features, model = _fitted(spark, folder)
    scored = classifier.score_rows(model, _side(features, "test"))
    found = metrics.evaluation_metrics(scored)
    train = _labeled_table(spark, folder, "train").drop("split")
    weights = term_model.model_terms(model, sizes.terms)
    none = weights.withColumn("coefficient", F.lit(0.0))
    at_fit, at_zero = term_model.log_losses(train, (weights, model.intercept), (none, 0.0))
    at_zero = at_zero.toDF(*[f"zero_{c}" for c in at_fit.columns])
    objective = F.lit(float(model.summary.objectiveHistory[-1]))
    rows = at_fit.join(at_zero).join(found.select("rows_test", "tp", "fp", "tn", "fn", "auc"))
    values = {
        "vocab_uni": F.lit(sizes.unigrams),
        "vocab_bi": F.lit(sizes.bigrams),
        "rows_train": F.col("documents"),
        "rows_test": F.col("rows_test"),
        "outcomes": F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn"),
        "zero_loss": F.col("zero_loss"),
        "loss_is_objective": _agree(F.col("loss"), objective),
        "loss_fell": F.col("loss") < F.col("zero_loss"),
        "gradient_fell": F.col("gradient_norm") < F.col("zero_gradient_norm"),
        "area_is_share": F.coalesce(F.col("auc").between(0, 1), F.lit(True)),
    }
    lines = [
        F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"))
        for name, value in values.items()
    ]
    return _rounded(rows.select(F.inline(F.array(*lines))))


@query
def log_loss(spark: SparkSession, folder: str) -> DataFrame:
    """Loss and gradient of the labelled reviews at weights that a rule gives."""
    table = _labeled_table(spark, folder)
    return _rounded(term_model.log_loss(table, _given_weights(table), 0.25), 5)


@query
def loss_gradient(spark: SparkSession, folder: str) -> DataFrame:
    """The gradient by term, at the same weights."""
    table = _labeled_table(spark, folder)
    return _rounded(term_model.gradient(table, _given_weights(table), 0.25), 5)


def _given_weights(table: DataFrame) -> DataFrame:
    """Weights of all terms of a table that follow from their place in the vocabulary."""
    learned = terms.fit_terms(table)
    return learned.select(
        "kind", "term", "idf", ((F.col("term_index") % 7 - 3) / 400).alias("coefficient")
    )


@query
def score_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Every review, labelled or not, scored from the term table at given weights."""
    table = term_model.numbered_table(_tokens(spark, folder))
    return _rounded(term_model.score_terms(table, _given_weights(table), 0.25), 5)


@query
def score_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Each test row scored through vectors, and whether its three figures go together."""
    _, features, model = _fitted(spark, folder)
    scored = classifier.score_rows(model, _side(features, "test"))
    p, score = F.col("probability"), F.col("score")
    together = (
        p.between(0, 1)
        & (F.abs(1 / (1 + F.exp(-score)) - p) < 1e-9)
        & ((F.col("prediction") == 1) == (p > 0.5))
        & ((score > 0) == (p > 0.5))
    )
    return scored.select("review_id", "label", together.alias("together"))


@query
def training_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Terms of both vocabularies and rows of both sides, as a training run has them."""
    sizes, features = _features(spark, folder)
    rows = features.groupBy(F.concat(F.lit("rows_"), "split").alias("metric")).agg(
        F.count(F.lit(1)).alias("value")
    )
    terms_of = {"vocab_uni": sizes.unigrams, "vocab_bi": sizes.bigrams}
    return rows.unionAll(spark.createDataFrame(list(terms_of.items()), "metric string, value long"))


@query
def scores_from_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Whether margin, probability and prediction of each test row follow from the
    model's coefficients and the term table, which is made without MLlib."""
    sizes, features, model = _fitted(spark, folder)
    scored = classifier.score_rows(model, _side(features, "test"))
    table = _labeled_table(spark, folder, "test").drop("label", "split")
    return _followed(scored, table, sizes, model, "review_id", "label")


@query
def score_raw_text(spark: SparkSession, folder: str) -> DataFrame:
    """Every review, labelled or not, scored by saved and reloaded models, and whether the
    weights as a table score it alike."""
    sizes, _, model = _fitted(spark, folder)
    stages_path, model_path = new_path(spark, "stages"), new_path(spark, "classifier")
    classifier.save_model(sizes.stages, stages_path)
    classifier.save_model(model, model_path)
    reloaded = classifier.load_classifier(model_path)
    scored = classifier.score_text(
        classifier.load_features(stages_path), reloaded, _texts(spark, folder)
    )
    table = term_model.numbered_table(_tokens(spark, folder))
    return _followed(scored, table, sizes, reloaded, "review_id")


def _followed(
    scored: DataFrame,
    table: DataFrame,
    sizes: classifier.FeatureModel,
    model: classifier.LogisticRegressionModel,
    *kept: str,
) -> DataFrame:
    """Each scored row, and whether the term table gives the same figures."""
    weights = term_model.model_terms(model, sizes.terms)
    theirs = ["prediction", "probability", "score"]
    ours = term_model.score_terms(table, weights, model.intercept).toDF(
        "review_id", *[f"table_{name}" for name in theirs]
    )
    same = [_agree(F.col(name), F.col(f"table_{name}")) for name in theirs[1:]]
    # a margin of about zero may fall on either side
    near = F.abs("score") < 1e-6
    same.append((F.col("prediction") == F.col("table_prediction")) | near)
    follows = F.coalesce(same[0] & same[1] & same[2], F.lit(False))
    return scored.join(ours, "review_id", "left").select(*kept, follows.alias("follows"))


@query
def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.roc_auc(_predictions(spark, folder)))


@query
def roc_auc_many_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The same on a score with nearly as many values as rows."""
    items = spark.read.parquet(f"{folder}/lineitem.parquet")
    scored = items.select(
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("score"),
    )
    return _rounded(metrics.roc_auc(scored))


@query
def class_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.class_metrics(_predictions(spark, folder)))


@query
def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion_matrix(_predictions(spark, folder))


@query
def positive_pr(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.positive_pr(_predictions(spark, folder)))


@query
def evaluation_report(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.evaluation_metrics(_predictions(spark, folder)))
