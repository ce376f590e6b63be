"""Data-quality profile of a review table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.functions.numbers import ratio
from ratewise.functions.ratings import (
    NEGATIVE_STARS,
    NEUTRAL_STARS,
    POSITIVE_STARS,
    has_text,
    is_blank,
    is_invalid_rating,
    label_from_stars,
)
from ratewise.functions.text import shorten
from ratewise.schema import SAMPLE_COLUMNS, project_existing, require_columns
from ratewise.session import durable


def _long_form(one_row: DataFrame) -> DataFrame:
    """A one-row table of metrics as (metric, value) rows."""
    pairs = [
        F.struct(F.lit(name).alias("metric"), F.col(name).cast("double").alias("value"))
        for name in one_row.columns
    ]
    return one_row.select(F.inline(F.array(*pairs)))


def _count_stars(stars: tuple[int, ...]) -> Column:
    return F.count_if(F.col("stars").isin(*stars))


def column_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Name, type, row count, nulls and distinct values of every column.

    Exact counts take one aggregation per column, which reads that column alone;
    strings are compared by digest, so long texts are never shuffled. Approximate
    counts (two percent off as a rule) are one pass over all columns with no more
    than a sketch per column and task to shuffle.
    """
    if not approximate and len(df.columns) > 1:
        parts = [
            column_profile(df.select(f"`{name}`")).withColumn("position", F.lit(i).cast("long"))
            for i, name in enumerate(df.columns)
        ]
        return reduce(DataFrame.unionAll, parts)
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    measures = [F.count(F.lit(1)).alias("rows")]
    for i, (name, kind) in enumerate(df.dtypes):
        value = F.sha2(F.col(name), 256) if kind == "string" else F.col(name)
        measures.append(F.count_if(F.col(name).isNull()).alias(f"nulls_{i}"))
        measures.append(distinct(value).alias(f"distinct_{i}"))
    lines = [
        F.struct(
            F.lit(i).cast("long").alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("data_type"),
            F.col("rows"),
            F.col(f"nulls_{i}").alias("nulls"),
            F.col(f"distinct_{i}").alias("distinct_values"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return df.agg(*measures).select(F.inline(F.array(*lines)))


#: State of a column's profile: counts that add up, and sketches that merge.
STATE = (
    "position bigint, column_name string, data_type string, rows bigint, nulls bigint, "
    "least_length bigint, greatest_length bigint, total_length bigint, "
    "distinct_sketch binary, value_sketch binary"
)
#: Registers (power of two) of a distinct count, 0.8 % off as a rule, and the accuracy
#: of quantiles, about one rank in a hundred.
DISTINCT_BITS = 14
QUANTILE_SIZE = 400
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def profile_state(df: DataFrame) -> DataFrame:
    """What a profile of ``df`` needs, one small row per column, from one scan of all columns.

    States of several runs merge without their rows: see ``merge_profiles``. Only a sketch
    per column and task is shuffled. Values other than numbers, strings, dates, timestamps
    and booleans are compared by their text.
    """
    measures = [F.count(F.lit(1)).alias("rows")]
    lines = []
    for i, (name, kind) in enumerate(df.dtypes):
        value = F.col(f"`{name}`")
        number = kind in NUMBERS or kind.startswith("decimal")
        length = F.length(value) if kind == "string" else F.lit(None).cast("int")
        text = value if kind in ("string", "binary") else value.cast("string")
        # a hash in place of long values: rows keep their own sketch small
        measures += [
            F.count(value).alias(f"present_{i}"),
            F.min(length).cast("long").alias(f"least_{i}"),
            F.max(length).cast("long").alias(f"greatest_{i}"),
            F.sum(length).cast("long").alias(f"total_{i}"),
            F.hll_sketch_agg(F.when(value.isNotNull(), F.xxhash64(text)), DISTINCT_BITS).alias(f"distinct_{i}"),
        ]
        sketch = F.lit(None).cast("binary")
        if number:
            real = F.when(~F.isnan(value.cast("double")), value.cast("double"))
            measures.append(F.kll_sketch_agg_double(real, QUANTILE_SIZE).alias(f"values_{i}"))
            sketch = F.col(f"values_{i}")
        lines.append(
            F.struct(
                F.lit(i).cast("long"), F.lit(name), F.lit(kind), F.col("rows"),
                F.col("rows") - F.col(f"present_{i}"), F.col(f"least_{i}"), F.col(f"greatest_{i}"),
                F.col(f"total_{i}"), F.col(f"distinct_{i}"), sketch,
            ).cast(f"struct<{STATE.replace(' ', ': ').replace(',:', ',')}>")
        )
    return df.agg(*measures).select(F.inline(F.array(*lines)))


def merge_profiles(states: DataFrame) -> DataFrame:
    """One state of all runs whose states the rows are, by the name and type of columns."""
    return states.groupBy("column_name", "data_type").agg(
        F.min("position").alias("position"),
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.min("least_length").alias("least_length"),
        F.max("greatest_length").alias("greatest_length"),
        F.sum("total_length").alias("total_length"),
        F.hll_union_agg("distinct_sketch", F.lit(True)).alias("distinct_sketch"),
        F.kll_merge_agg_double("value_sketch").alias("value_sketch"),
    ).select(*[column.split()[0] for column in STATE.split(", ")])


def read_profile(state: DataFrame) -> DataFrame:
    """A profile from its state: exact counts and lengths, estimated distinct values, and
    the median and quartiles of numbers within a rank or two in a hundred."""
    counted = F.col("rows") - F.col("nulls")

    def quantile(rank: float) -> Column:
        known = F.when(
            F.col("value_sketch").isNotNull() & (F.kll_sketch_get_n_double("value_sketch") > 0),
            F.col("value_sketch"),
        )
        return F.kll_sketch_get_quantile_double(known, F.lit(rank))

    return state.select(
        "position",
        "column_name",
        "data_type",
        "rows",
        "nulls",
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_values"),
        "least_length",
        ratio(F.col("total_length"), counted, None).alias("average_length"),
        "greatest_length",
        quantile(0.25).alias("lower_quartile"),
        quantile(0.5).alias("median"),
        quantile(0.75).alias("upper_quartile"),
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def histogram(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of ``column``, in order of the value."""
    require_columns(df, [column])
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("cnt")).orderBy(column)


def sample_rows(
    reviews: DataFrame, order: str = "review_id", rows: int = 5, width: int = 100
) -> DataFrame:
    """The first rows by key, familiar columns only, long texts shortened.

    The keys are found from the key column alone; then only their rows are read on,
    and as many of them put in order as repeated keys add.
    """
    keys = reviews.select(F.col(order).alias("shown_key")).orderBy("shown_key").limit(rows)
    found = reviews.join(
        F.broadcast(keys.distinct()), F.col(order).eqNullSafe(F.col("shown_key")), "left_semi"
    )
    first = found.orderBy(order).limit(rows)
    shown = [order, *SAMPLE_COLUMNS]
    return project_existing(first, shown).withColumn("text", shorten(F.col("text"), width))


def invalid_ratings(reviews: DataFrame) -> DataFrame:
    return reviews.where(is_invalid_rating(F.col("stars")))


def null_rows(reviews: DataFrame) -> DataFrame:
    """Rows without a rating or without a text."""
    return reviews.where(F.col("stars").isNull() | F.col("text").isNull())


def blank_rows(reviews: DataFrame, strict: bool = False) -> DataFrame:
    return reviews.where(is_blank(F.col("text"), strict))


def text_length_stats(reviews: DataFrame) -> DataFrame:
    """Least, mean and greatest text length over rows that have a text."""
    size = F.length("text")
    return reviews.agg(
        F.min(size).cast("long").alias("min_len"),
        F.avg(size).alias("avg_len"),
        F.max(size).cast("long").alias("max_len"),
    )


def duplicate_keys(reviews: DataFrame, key: str = "review_id") -> DataFrame:
    """How many key values occur more than once; null without the column.

    Only the key is read and shuffled, and each task sends one row per value it
    saw, so a key on a third of all rows costs no more than any other.
    """
    if key not in reviews.columns:
        return reviews.sparkSession.range(1).select(
            F.lit(None).cast("long").alias("duplicate_values")
        )
    repeated = reviews.groupBy(key).agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1")
    return repeated.agg(F.count(F.lit(1)).alias("duplicate_values"))


def class_balance(reviews: DataFrame) -> DataFrame:
    """Planned class counts and shares when the neutral rating is dropped."""
    counts = reviews.agg(
        _count_stars(NEGATIVE_STARS).alias("neg"),
        _count_stars(POSITIVE_STARS).alias("pos"),
        _count_stars(NEUTRAL_STARS).alias("neu"),
    )
    neg, pos = F.col("neg"), F.col("pos")
    return counts.select(
        "neg",
        "pos",
        "neu",
        (neg + pos).alias("kept"),
        F.round(ratio(pos * 100, neg + pos), 4).alias("pos_pct"),
        F.round(ratio(neg * 100, neg + pos), 4).alias("neg_pct"),
    )


def quality_facts(reviews: DataFrame, key: str = "review_id") -> DataFrame:
    """What the data-quality report needs of each row: no text, only its size."""
    require_columns(reviews, ["text", "stars"])
    text = F.col("text")
    kept = [key] if key in reviews.columns else []
    return reviews.select(
        *kept, "stars", F.length(text).alias("text_len"), is_blank(text).alias("blank")
    )


def validation_profile(
    reviews: DataFrame, key: str = "review_id", store_facts: bool = False
) -> DataFrame:
    """The whole data-quality report as (metric, value) rows.

    Rating and text go through one conditional aggregation, the key alone through
    the duplicate count. On a columnar source these two scans share no column. A
    row-based source is better parsed once: ``store_facts`` then writes a few
    bytes per row to the work folder and makes both counts from those.
    """
    facts = quality_facts(reviews, key)
    if store_facts:
        facts = durable(facts, "quality-facts")
    stars, size = F.col("stars"), F.col("text_len")
    counts = facts.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(is_invalid_rating(stars)).alias("invalid_stars"),
        F.count_if(stars.isNull()).alias("stars_nulls"),
        F.count_if(size.isNull()).alias("text_nulls"),
        F.count_if("blank").alias("blank_texts"),
        F.min(size).alias("text_min_len"),
        F.avg(size).alias("mean_len"),
        F.max(size).alias("text_max_len"),
        _count_stars(NEGATIVE_STARS).alias("label_neg_planned"),
        _count_stars(POSITIVE_STARS).alias("label_pos_planned"),
        _count_stars(NEUTRAL_STARS).alias("label_neu_planned"),
    )
    neg, pos = F.col("label_neg_planned"), F.col("label_pos_planned")
    metrics = counts.select(
        "total_rows",
        "invalid_stars",
        "stars_nulls",
        "text_nulls",
        "blank_texts",
        "text_min_len",
        F.round("mean_len", 2).alias("text_avg_len"),
        "text_max_len",
        "label_neg_planned",
        "label_pos_planned",
        "label_neu_planned",
        F.round(ratio(pos * 100, neg + pos), 4).alias("label_pos_pct_planned"),
        F.round(ratio(neg * 100, neg + pos), 4).alias("label_neg_pct_planned"),
    )
    repeated = duplicate_keys(facts, key).select(
        F.col("duplicate_values").alias(f"dup_{key}")
    )
    return _long_form(metrics).unionByName(_long_form(repeated))


def labeling_report(reviews: DataFrame) -> DataFrame:
    """Rows before and after labelling and the class shares, from one scan."""
    require_columns(reviews, ["text", "stars"])
    label = F.when(has_text(F.col("text")), label_from_stars(F.col("stars")))
    counts = reviews.select(label.alias("label")).agg(
        F.count(F.lit(1)).alias("total_before"),
        F.count("label").alias("total_after"),
        F.count_if(F.col("label") == 0.0).alias("label_neg"),
        F.count_if(F.col("label") == 1.0).alias("label_pos"),
    )
    return _labeling_lines(counts)


def stored_labeling_report(labeled: DataFrame, total_before: int) -> DataFrame:
    """The same from a stored labelled table and the number of rows before."""
    counts = labeled.agg(
        F.lit(total_before).alias("total_before"),
        F.count("label").alias("total_after"),
        F.count_if(F.col("label") == 0.0).alias("label_neg"),
        F.count_if(F.col("label") == 1.0).alias("label_pos"),
    )
    return _labeling_lines(counts)


def _labeling_lines(counts: DataFrame) -> DataFrame:
    neg, pos = F.col("label_neg"), F.col("label_pos")
    return _long_form(
        counts.select(
            "total_before",
            "total_after",
            "label_neg",
            "label_pos",
            F.round(ratio(neg * 100, neg + pos), 4).alias("label_neg_pct"),
            F.round(ratio(pos * 100, neg + pos), 4).alias("label_pos_pct"),
        )
    )
