"""SQL counterparts of the query catalog, for an independent engine (DuckDB).

They are written from the meaning of each query, not from its Spark plan. Queries that
fit a model return what must hold of any fit; SQL has its sizes and the figures at given
weights.
"""

from __future__ import annotations

from ratewise.functions.text import STOP_WORDS

REVIEWS = """
reviews AS (
  SELECT d.doc_id AS review_id, d.lang AS user_id, d.source AS business_id,
         CAST(CASE WHEN l.quality = 0 AND l.toxic = 1 THEN 1
                   WHEN l.quality = 0 AND l.toxic = 0 THEN 2
                   WHEN l.quality = 1 AND l.toxic = 1 THEN 4
                   WHEN l.quality = 1 AND l.toxic = 0 THEN 5
                   ELSE 3 END AS DOUBLE) AS stars,
         d.text
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""

DAMAGED = (
    REVIEWS
    + """,
damaged AS (
  SELECT review_id, user_id, business_id,
         CASE review_id % 10 WHEN 2 THEN CAST(6 AS DOUBLE)
                             WHEN 3 THEN NULL ELSE stars END AS stars,
         CASE review_id % 10 WHEN 0 THEN NULL WHEN 1 THEN '   ' ELSE text END AS text
  FROM reviews
)"""
)

REPEATED = (
    DAMAGED
    + """,
repeated AS (
  SELECT CASE WHEN review_id % 10 <> 7 THEN review_id // 2 END AS review_id,
         user_id, business_id, stars, text FROM damaged
)"""
)


def _labeled(source: str) -> str:
    return f"""
labeled AS (
  SELECT *, CAST(CASE WHEN stars IN (4, 5) THEN 1 ELSE 0 END AS DOUBLE) AS label
  FROM {source}
  WHERE stars IN (1, 2, 4, 5) AND text IS NOT NULL AND length(trim(text, ' ')) > 0
)"""


LABELED = REVIEWS + "," + _labeled("reviews")
LABELED_DAMAGED = DAMAGED + "," + _labeled("damaged")

_CLEAN = r"""trim(regexp_replace(lower(regexp_replace(text, 'http\S+|www\.\S+', ' ', 'g')),
                         '\s+', ' ', 'g'), ' ')"""
_TOKENS = (
    f"list_filter(regexp_split_to_array({_CLEAN}, '\\W+'), lambda x: length(x) >= 2)"
)
_STOPS = ", ".join("'" + word.replace("'", "''") + "'" for word in STOP_WORDS)


def _tokens(source: str, columns: str = "review_id") -> str:
    return f""",
split_words AS (SELECT {columns}, {_TOKENS} AS words FROM {source}),
tokens AS (
  SELECT {columns}, list_filter(words, lambda x: x NOT IN ({_STOPS})) AS toks
  FROM split_words
)"""


_BIGRAMS = "[toks[i] || ' ' || toks[i + 1] for i in range(1, len(toks))]"


def _terms(columns: str = "review_id") -> str:
    """Counts per document of both kinds, and the vocabulary with its ranks."""
    return f""",
occurrences AS (
  SELECT {columns}, 'unigram' AS kind, unnest(toks) AS term FROM tokens
  UNION ALL
  SELECT {columns}, 'bigram' AS kind, unnest({_BIGRAMS}) AS term FROM tokens
),
counts AS (
  SELECT {columns}, kind, term, count(*) AS tf FROM occurrences GROUP BY ALL
)"""


def _vocabulary(counts: str = "counts", size: int = 50_000, least: int = 5) -> str:
    return f""",
stats AS (
  SELECT kind, term, CAST(sum(tf) AS BIGINT) AS cf, count(*) AS df
  FROM {counts} GROUP BY kind, term HAVING count(*) >= {least}
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY kind ORDER BY cf DESC, term) - 1 AS term_index
  FROM stats
),
vocab AS (SELECT * FROM ranked WHERE term_index < {size})"""


TERMS = REVIEWS + _tokens("reviews") + _terms()
VOCABULARY = TERMS + _vocabulary()


def _counts(kind: str) -> str:
    return f"""WITH {VOCABULARY}
SELECT review_id, term, tf FROM counts SEMI JOIN vocab USING (kind, term)
WHERE kind = '{kind}'"""


def _ranks(kind: str) -> str:
    return f"""WITH {VOCABULARY}
SELECT term, term_index, cf, df FROM vocab WHERE kind = '{kind}'"""


def _tfidf(kind: str) -> str:
    return f"""WITH {VOCABULARY}
SELECT review_id, term, tf, df,
       round(tf * ln(((SELECT count(*) FROM tokens) + 1) / CAST(df + 1 AS DOUBLE)), 6) AS tfidf
FROM counts JOIN vocab USING (kind, term) WHERE kind = '{kind}'"""


def _bucket(key: str) -> str:
    return f"('0x' || substr(md5('42:' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT % 100"


def _side(key: str) -> str:
    return f"CASE WHEN {_bucket(key)} < 80 THEN 'train' ELSE 'test' END AS split"


_SPLIT = _side("review_id")
_CONTENT = "md5(CAST(stars AS VARCHAR) || '|' || text)"

PREDICTIONS = (
    LABELED
    + """,
scored AS (
  SELECT label, review_id, (length(text) % 97) / CAST(97 AS DOUBLE) AS score FROM labeled
),
predictions AS (
  SELECT label, CASE WHEN review_id % 10 <> 4 THEN score END AS score,
         CAST(CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS DOUBLE) AS prediction
  FROM scored
),
confusion AS (
  SELECT CAST(count_if(label = 1 AND prediction = 1) AS BIGINT) AS tp,
         CAST(count_if(label = 0 AND prediction = 1) AS BIGINT) AS fp,
         CAST(count_if(label = 0 AND prediction = 0) AS BIGINT) AS tn,
         CAST(count_if(label = 1 AND prediction = 0) AS BIGINT) AS fn,
         count(*) AS rows_test
  FROM predictions
),
measures AS (
  SELECT *, (tp + fn) / rows_test AS share1, (tn + fp) / rows_test AS share0,
         coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1,
         coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0
  FROM confusion
),
totals AS (
  SELECT *, (tp + tn) / rows_test AS accuracy,
         share1 * coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0)
           + share0 * coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f1,
         share1 * p1 + share0 * p0 AS weighted_precision,
         share1 * r1 + share0 * r0 AS weighted_recall
  FROM measures
)"""
)


def _auc(source: str) -> str:
    """Area under the ROC curve by mean ranks of the positives."""
    return f""",
ranks AS (
  SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0
           AS mean_rank
  FROM {source} WHERE score IS NOT NULL
),
area AS (
  SELECT (sum(CAST(mean_rank AS DOUBLE)) FILTER (WHERE label = 1)
            - count_if(label = 1) * (count_if(label = 1) + 1) / 2)
         / (CAST(count_if(label = 1) AS DOUBLE) * count_if(label = 0)) AS auc
  FROM ranks
)"""


_STAR_COUNTS = """CAST(count_if(stars IN (1, 2)) AS DOUBLE) AS neg,
         CAST(count_if(stars IN (4, 5)) AS DOUBLE) AS pos,
         CAST(count_if(stars = 3) AS DOUBLE) AS neu"""

_PROFILE = f"""WITH {REPEATED},
p AS (
  SELECT CAST(count(*) AS DOUBLE) AS total_rows,
         CAST(count_if(stars NOT IN (1, 2, 3, 4, 5)) AS DOUBLE) AS invalid_stars,
         CAST(count_if(stars IS NULL) AS DOUBLE) AS stars_nulls,
         CAST(count_if(text IS NULL) AS DOUBLE) AS text_nulls,
         CAST(count_if(text IS NOT NULL AND length(trim(text, ' ')) = 0) AS DOUBLE) AS blank_texts,
         CAST(min(length(text)) AS DOUBLE) AS text_min_len,
         round(avg(length(text)), 2) AS text_avg_len,
         CAST(max(length(text)) AS DOUBLE) AS text_max_len,
         {_STAR_COUNTS}
  FROM repeated
),
d AS (
  SELECT CAST(count(*) AS DOUBLE) AS n
  FROM (SELECT review_id FROM repeated GROUP BY review_id HAVING count(*) > 1)
)
SELECT 'total_rows' AS metric, total_rows AS value FROM p
UNION ALL SELECT 'invalid_stars', invalid_stars FROM p
UNION ALL SELECT 'stars_nulls', stars_nulls FROM p
UNION ALL SELECT 'text_nulls', text_nulls FROM p
UNION ALL SELECT 'blank_texts', blank_texts FROM p
UNION ALL SELECT 'text_min_len', text_min_len FROM p
UNION ALL SELECT 'text_avg_len', text_avg_len FROM p
UNION ALL SELECT 'text_max_len', text_max_len FROM p
UNION ALL SELECT 'dup_review_id', n FROM d
UNION ALL SELECT 'label_neg_planned', neg FROM p
UNION ALL SELECT 'label_pos_planned', pos FROM p
UNION ALL SELECT 'label_neu_planned', neu FROM p
UNION ALL SELECT 'label_pos_pct_planned', round(pos / (pos + neg) * 100, 4) FROM p
UNION ALL SELECT 'label_neg_pct_planned', round(neg / (pos + neg) * 100, 4) FROM p"""

_LABELING = f"""WITH {LABELED_DAMAGED},
n AS (
  SELECT (SELECT CAST(count(*) AS DOUBLE) FROM damaged) AS before_n,
         CAST(count(*) AS DOUBLE) AS after_n,
         CAST(count_if(label = 0) AS DOUBLE) AS neg, CAST(count_if(label = 1) AS DOUBLE) AS pos
  FROM labeled
)
SELECT 'total_before' AS metric, before_n AS value FROM n
UNION ALL SELECT 'total_after', after_n FROM n
UNION ALL SELECT 'label_neg', neg FROM n
UNION ALL SELECT 'label_pos', pos FROM n
UNION ALL SELECT 'label_neg_pct', round(neg / (neg + pos) * 100, 4) FROM n
UNION ALL SELECT 'label_pos_pct', round(pos / (neg + pos) * 100, 4) FROM n"""

_BALANCE = f"""WITH {DAMAGED},
c AS (SELECT {_STAR_COUNTS} FROM damaged)
SELECT CAST(neg AS BIGINT) AS neg, CAST(pos AS BIGINT) AS pos, CAST(neu AS BIGINT) AS neu,
       CAST(neg + pos AS BIGINT) AS kept,
       round(pos / (neg + pos) * 100, 4) AS pos_pct, round(neg / (neg + pos) * 100, 4) AS neg_pct
FROM c"""

_COLUMNS = (
    ("review_id", "bigint"),
    ("user_id", "string"),
    ("business_id", "string"),
    ("stars", "double"),
    ("text", "string"),
)
_COLUMN_PROFILE = f"WITH {DAMAGED}\n" + "\nUNION ALL\n".join(
    f"""SELECT CAST({i} AS BIGINT) AS position, '{name}' AS column_name, '{kind}' AS data_type,
       count(*) AS rows, count(*) - count({name}) AS nulls,
       count(DISTINCT {name}) AS distinct_values
FROM damaged"""
    for i, (name, kind) in enumerate(_COLUMNS)
)

RUNS = """
runs AS (
  SELECT CASE WHEN event_type <> 'view' THEN event_type END AS phase,
         user_id % 16 + 1 AS cores, round(sum(value), 2) AS duration_sec
  FROM events GROUP BY ALL
),
base AS (
  SELECT phase, cores AS base_cores, duration_sec AS base_sec
  FROM runs
  QUALIFY row_number() OVER (PARTITION BY phase ORDER BY cores, duration_sec) = 1
),
summary AS (
  SELECT runs.phase, cores, duration_sec,
         CASE WHEN duration_sec > 0 THEN base_sec / duration_sec ELSE 0 END AS speedup,
         base_cores
  FROM runs JOIN base ON runs.phase IS NOT DISTINCT FROM base.phase
)"""

_FEATURE_VECTORS = f"""WITH {LABELED},
sided AS (SELECT *, {_SPLIT} FROM labeled)
{_tokens("sided", "review_id, label, split")}{_terms("review_id, label, split")},
train_counts AS (SELECT * FROM counts WHERE split = 'train')
{_vocabulary("train_counts")},
entries AS (
  SELECT c.review_id,
         tf * ln(((SELECT count(*) FROM tokens WHERE split = 'train') + 1)
                 / CAST(df + 1 AS DOUBLE)) AS v
  FROM counts c JOIN vocab USING (kind, term)
)
SELECT t.review_id, t.label, t.split, CAST(coalesce(count_if(v <> 0), 0) AS BIGINT) AS terms,
       round(coalesce(sum(v), 0), 4) AS weight, round(coalesce(sum(v * v), 0), 4) AS squares
FROM tokens t LEFT JOIN entries e ON t.review_id = e.review_id
GROUP BY ALL"""

_EVENT_CELL = """CASE event_type WHEN 'click' THEN value
                            WHEN 'view' THEN -value * 10 END"""

_TRAINING_SIZES = f"""WITH {LABELED},
sided AS (SELECT *, {_SPLIT} FROM labeled)
{_tokens("sided", "review_id, split")}{_terms("review_id, split")},
train_counts AS (SELECT * FROM counts WHERE split = 'train')
{_vocabulary("train_counts")}
SELECT CASE kind WHEN 'unigram' THEN 'vocab_uni' ELSE 'vocab_bi' END AS metric, count(*) AS value
FROM vocab GROUP BY kind
UNION ALL SELECT 'rows_' || split, count(*) FROM sided GROUP BY split"""

_TRAINING_REPORT = f"""
WITH sizes AS ({_TRAINING_SIZES})
SELECT metric, CAST(value AS DOUBLE) AS value FROM sizes
UNION ALL SELECT 'outcomes', CAST(value AS DOUBLE) FROM sizes WHERE metric = 'rows_test'
UNION ALL SELECT 'zero_loss', round(ln(CAST(2 AS DOUBLE)), 6)
UNION ALL SELECT unnest(['loss_is_objective', 'loss_fell', 'gradient_fell', 'area_is_share']),
                 CAST(1 AS DOUBLE)"""

#: Weights that follow from a term's place in the vocabulary, and margins of documents.
_GIVEN = """,
rows AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM tokens),
weighted AS (
  SELECT kind, term, ln(((SELECT n FROM rows) + 1) / (df + 1)) AS idf,
         (term_index % 7 - 3) / 400.0::DOUBLE AS coefficient
  FROM vocab
),
entries AS (
  SELECT review_id, kind, term, tf * idf AS x, tf * idf * coefficient AS share
  FROM counts JOIN weighted USING (kind, term)
),
margins AS (
  SELECT t.review_id, 0.25::DOUBLE + coalesce(sum(share), 0) AS margin
  FROM tokens t LEFT JOIN entries e ON t.review_id = e.review_id GROUP BY t.review_id
)"""
_GIVEN_LABELED = f"""WITH {LABELED}{_tokens("labeled", "review_id, label")}
{_terms("review_id, label")}{_vocabulary()}{_GIVEN},
residuals AS (
  SELECT m.review_id, margin, l.label, 1 / (1 + exp(-margin)) - l.label AS residual
  FROM margins m JOIN labeled l ON l.review_id = m.review_id
),
gradients AS (
  SELECT kind, term, sum(residual * x) / (SELECT n FROM rows) AS gradient
  FROM entries JOIN residuals USING (review_id) GROUP BY kind, term
)"""

SQL: dict[str, str] = {
    "training_sizes": _TRAINING_SIZES,
    "scores_from_terms": f"""WITH {LABELED}, sided AS (SELECT *, {_SPLIT} FROM labeled)
SELECT review_id, label, true AS follows FROM sided WHERE split = 'test'""",
    "train_classifier": _TRAINING_REPORT,
    "score_rows": f"""WITH {LABELED}, sided AS (SELECT *, {_SPLIT} FROM labeled)
SELECT review_id, label, true AS together FROM sided WHERE split = 'test'""",
    "score_raw_text": "SELECT doc_id AS review_id, true AS follows FROM documents",
    "score_terms": f"""WITH {VOCABULARY}{_GIVEN}
SELECT review_id, CAST(CASE WHEN margin > 0 THEN 1 ELSE 0 END AS DOUBLE) AS prediction,
       round(1 / (1 + exp(-margin)), 5) AS probability, round(margin, 5) AS score
FROM margins""",
    "log_loss": f"""{_GIVEN_LABELED}
SELECT count(*) AS documents,
       round(avg(greatest(margin, 0) + ln(1 + exp(-abs(margin))) - label * margin), 5) AS loss,
       round(sqrt((SELECT sum(gradient ** 2) FROM gradients) + avg(residual) ** 2), 5) AS gradient_norm,
       round(avg(residual), 5) AS intercept_gradient
FROM residuals""",
    "loss_gradient": f"""{_GIVEN_LABELED}
SELECT kind, term, round(gradient, 5) AS gradient FROM gradients""",
    "scan_json_lines": f"WITH {REVIEWS} SELECT * FROM reviews",
    "labeled_roundtrip": f"""WITH {LABELED}
SELECT review_id, user_id, business_id, stars, text, label FROM labeled""",
    "scan_labeled": f"""WITH {LABELED}
SELECT label, business_id, count(*) AS cnt, CAST(sum(review_id) AS BIGINT) AS key_sum
FROM labeled GROUP BY label, business_id""",
    "labeled_runs": f"""WITH {LABELED},
runs AS (
  SELECT '007' AS run_id, * FROM labeled WHERE review_id % 2 = 0 AND label = 1
  UNION ALL SELECT '010', * FROM labeled WHERE review_id % 2 <> 0
),
sized AS (
  SELECT run_id, label, count(*) AS cnt, CAST(sum(review_id) AS BIGINT) AS key_sum
  FROM runs GROUP BY ALL
)
SELECT *, 'all' AS part FROM sized
UNION ALL SELECT *, 'newest' FROM sized WHERE run_id = '010'""",
    "merged_profile": f"WITH {DAMAGED}\n" + "\nUNION ALL\n".join(
        f"""SELECT CAST({i} AS BIGINT) AS position, '{name}' AS column_name, '{kind}' AS data_type,
       count(*) AS rows, count(*) - count({name}) AS nulls,
       {f"min(length({name}))" if kind == "string" else "NULL::BIGINT"} AS least_length,
       {f"round(avg(length({name})), 6)" if kind == "string" else "NULL::DOUBLE"} AS average_length,
       {f"max(length({name}))" if kind == "string" else "NULL::BIGINT"} AS greatest_length,
       true AS distinct_near, true AS median_near
FROM damaged"""
        for i, (name, kind) in enumerate(_COLUMNS)
    ),
    "metric_report": _PROFILE,
    "run_log_append": """
SELECT event_type || '-' || user_id AS run_id, count(*) AS total_rows,
       CAST(count_if(value > 10) AS INTEGER) AS vocab_uni,
       CAST(count_if(value > 20) AS INTEGER) AS vocab_bi,
       'features/' || event_type || '-' || user_id AS out_parquet,
       CAST(NULL AS VARCHAR) AS out_model
FROM events GROUP BY event_type, user_id""",
    "scan_run_log": """
SELECT event_id, user_id % 16 + 1 AS cores,
       CASE WHEN event_type = 'error' THEN 0 ELSE coalesce(value, 0) END AS duration_sec
FROM events""",
    "latest_run": """
SELECT event_id, user_id, event_type, value FROM events ORDER BY event_id DESC LIMIT 1""",
    "latest_path": "SELECT 'features/' || max(event_id) AS out_parquet FROM events",
    "csv_columns": f"""WITH {RUNS}
SELECT phase, cores, round(speedup, 4) AS speedup, CAST(NULL AS DOUBLE) AS auc FROM summary""",
    "column_profile": _COLUMN_PROFILE,
    "project_existing": f"""WITH {REVIEWS}
SELECT review_id, user_id, business_id, stars, text FROM reviews""",
    "invalid_rating": f"""WITH {DAMAGED}
SELECT review_id, stars FROM damaged WHERE stars NOT IN (1, 2, 3, 4, 5)""",
    "null_rows": f"""WITH {DAMAGED}
SELECT review_id, stars, text FROM damaged WHERE stars IS NULL OR text IS NULL""",
    "blank_text": f"""WITH {DAMAGED}
SELECT review_id, text FROM damaged WHERE length(trim(text, ' ')) = 0""",
    "clean_rows": f"""WITH {DAMAGED}
SELECT review_id, stars, text FROM damaged WHERE length(trim(text, ' ')) > 0""",
    "label_rows": f"WITH {LABELED_DAMAGED} SELECT review_id, stars, label FROM labeled",
    "dedup_rows": f"""WITH {REVIEWS}
SELECT * FROM reviews QUALIFY row_number() OVER (PARTITION BY text ORDER BY review_id) = 1""",
    "dedup_keys": f"""WITH {REPEATED}
SELECT * FROM repeated
QUALIFY review_id IS NULL OR row_number() OVER (PARTITION BY review_id
  ORDER BY user_id, business_id, stars NULLS FIRST, text NULLS FIRST) = 1""",
    "row_count": f'WITH {REVIEWS} SELECT count(*) AS "rows" FROM reviews',
    "rating_histogram": f"""WITH {DAMAGED}
SELECT stars, count(*) AS cnt FROM damaged GROUP BY stars ORDER BY stars""",
    "label_histogram": f"""WITH {LABELED}
SELECT label, count(*) AS cnt FROM labeled GROUP BY label ORDER BY label""",
    "text_length_stats": f"""WITH {DAMAGED}
SELECT min(length(text)) AS min_len, round(avg(length(text)), 6) AS avg_len,
       max(length(text)) AS max_len FROM damaged""",
    "duplicate_keys": f"""WITH {REPEATED}
SELECT count(*) AS duplicate_values
FROM (SELECT review_id FROM repeated GROUP BY review_id HAVING count(*) > 1)""",
    "validation_profile": _PROFILE,
    "labeling_report": _LABELING,
    "class_balance": _BALANCE,
    "sample_rows": f"""WITH {REVIEWS}
SELECT review_id, stars,
       CASE WHEN length(text) > 100 THEN substr(text, 1, 97) || '...' ELSE text END AS text,
       user_id, business_id
FROM reviews ORDER BY review_id LIMIT 5""",
    "safe_numeric": f"""
WITH cells AS (SELECT event_id, {_EVENT_CELL} AS v FROM events)
SELECT event_id, CAST(trunc(coalesce(v, 0)) AS BIGINT) AS as_long,
       round(coalesce(v, 0), 6) AS as_double, round(v, 6) AS or_null
FROM cells""",
    "scaling_baseline": f"WITH {RUNS} SELECT phase, base_cores, base_sec FROM base",
    "scaling_summary": f"""WITH {RUNS}
SELECT phase, cores, duration_sec, round(speedup, 4) AS speedup,
       round(CASE WHEN cores > 0 THEN speedup / (cores / base_cores) ELSE 0 END, 4) AS eff
FROM summary""",
    "scaling_fill": f"""WITH {RUNS}
SELECT phase, cores, duration_sec, round(speedup, 4) AS speedup,
       round(speedup / (cores / base_cores), 4) AS eff
FROM summary WHERE coalesce(phase, '') <> 'click' AND cores <> 3
UNION ALL
SELECT phase, cores, duration_sec, round(cores / 2, 4), CAST(0.5 AS DOUBLE)
FROM summary WHERE phase = 'click'""",
    "clean_text": f"WITH {REVIEWS} SELECT review_id, {_CLEAN} AS text_clean FROM reviews",
    "tokenize": f"""WITH {REVIEWS}
SELECT review_id, array_to_string({_TOKENS}, '|') AS tokens FROM reviews""",
    "remove_stopwords": f"""WITH {REVIEWS}{_tokens("reviews")}
SELECT review_id, array_to_string(toks, '|') AS tokens FROM tokens""",
    "bigrams": f"""WITH {REVIEWS}{_tokens("reviews")}
SELECT review_id, array_to_string({_BIGRAMS}, '|') AS bigrams FROM tokens""",
    "term_counts": _counts("unigram"),
    "bigram_counts": _counts("bigram"),
    "vocabulary": _ranks("unigram"),
    "bigram_vocabulary": _ranks("bigram"),
    "vocabulary_size": f"""WITH {VOCABULARY}
SELECT kind, count(*) AS terms FROM vocab GROUP BY kind""",
    "top_terms": f"""WITH {TERMS}{_vocabulary(size=1000, least=1)}
SELECT kind, term, term_index, cf, df FROM vocab""",
    "tfidf_unigram": _tfidf("unigram"),
    "tfidf_bigram": _tfidf("bigram"),
    "feature_rows": f"""WITH {LABELED}{_tokens("labeled", "review_id, label")}
{_terms("review_id, label")}{_vocabulary()}
SELECT review_id, label, kind, term,
       round(tf * ln(((SELECT count(*) FROM tokens) + 1) / CAST(df + 1 AS DOUBLE)), 6) AS tfidf
FROM counts JOIN vocab USING (kind, term)""",
    "split_rows": f"""WITH {REVIEWS},
keyed AS (
  SELECT CASE WHEN review_id % 10 <> 5 THEN review_id END AS review_id, stars, text FROM reviews
)
SELECT review_id, stars, {_side(f"coalesce(CAST(review_id AS VARCHAR), {_CONTENT})")} FROM keyed""",
    "split_without_keys": f"""WITH {REVIEWS},
sided AS (SELECT stars, {_side(_CONTENT)} FROM reviews)
SELECT stars, split, count(*) AS cnt FROM sided GROUP BY stars, split""",
    "one_hot_classifier": """
WITH cells AS (
  SELECT l_returnflag || '/' || l_linestatus AS cell, count(*) AS cnt,
         count_if(l_quantity > 20) / CAST(count(*) AS DOUBLE) AS p
  FROM lineitem GROUP BY 1
)
SELECT cell, cnt, round(ln(p / (1 - p)), 3) AS score, round(p, 4) AS probability,
       CAST(CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS DOUBLE) AS prediction
FROM cells""",
    "feature_vectors": _FEATURE_VECTORS,
    "roc_auc": f"WITH {PREDICTIONS}{_auc('predictions')} SELECT round(auc, 6) AS auc FROM area",
    "roc_auc_many_scores": f"""
WITH scored AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
         l_extendedprice * (1 - l_discount) AS score
  FROM lineitem
){_auc("scored")}
SELECT round(auc, 6) AS auc FROM area""",
    "class_metrics": f"""WITH {PREDICTIONS}
SELECT round(accuracy, 6) AS accuracy, round(f1, 6) AS f1,
       round(weighted_precision, 6) AS weighted_precision,
       round(weighted_recall, 6) AS weighted_recall
FROM totals""",
    "confusion_matrix": f"WITH {PREDICTIONS} SELECT tp, fp, tn, fn FROM confusion",
    "positive_pr": f"""WITH {PREDICTIONS}
SELECT round(p1, 6) AS pos_precision, round(r1, 6) AS pos_recall FROM measures""",
    "evaluation_report": f"""WITH {PREDICTIONS}{_auc("predictions")}
SELECT rows_test, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1,
       round(weighted_precision, 6) AS weighted_precision,
       round(weighted_recall, 6) AS weighted_recall,
       round((SELECT auc FROM area), 6) AS auc, tp, fp, tn, fn,
       round(p1, 6) AS pos_precision, round(r1, 6) AS pos_recall
FROM totals""",
}
