"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the folder of the tables, ``BENCH_CPUS`` the cores.
Queries write into Spark's ``noop`` sink, so every row is computed and none is
collected. Each query runs twice and the second run counts, when its code is compiled.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from ratewise.plans.catalog import QUERIES
from ratewise.session import local_session, work_tables

HEADLINE = (
    "validation_profile",
    "labeling_report",
    "labeled_roundtrip",
    "dedup_rows",
    "clean_text",
    "bigrams",
    "vocabulary",
    "bigram_vocabulary",
    "tfidf_unigram",
    "tfidf_bigram",
    "feature_rows",
    "feature_vectors",
    "train_classifier",
    "score_raw_text",
    "class_metrics",
    "evaluation_report",
    "roc_auc_many_scores",
    "scaling_summary",
)


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names or HEADLINE:
        with work_tables(spark):
            run(spark, name, folder)
            seconds[name] = run(spark, name, folder)
    scale = re.search(r"sf([\d.]+)$", folder)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:])
