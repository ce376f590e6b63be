import os
import subprocess
import sys

import pytest

from ratewise import session
from ratewise.session import durable, new_path, work_dir, work_tables

ALONE = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from ratewise.session import durable, work_dir
print("rows", durable(spark.range(5).toDF("id"), "t").count(), work_dir(spark) == work_dir(spark))
"""


def test_a_session_without_settings(tmp_path):
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", ALONE], env=env, capture_output=True, text=True, timeout=300)
    assert "rows 5 True" in done.stdout, done.stderr[-2000:]


def test_work_tables_are_removed(spark):
    with work_tables(spark):
        table = durable(spark.range(3).toDF("id"), "short-lived")
        assert table.count() == 3
        folder = work_dir(spark).removeprefix("file:")
        assert any(name.startswith("short-lived-") for name in os.listdir(folder))
    assert not any(name.startswith("short-lived-") for name in os.listdir(folder))
    assert new_path(spark, "kept") != new_path(spark, "kept")


def test_discarded_tables_are_gone(spark):
    kept, gone = (session.durable(spark.range(5), name) for name in ("kept", "gone"))
    assert gone.count() == 5
    session.discard(gone)
    assert kept.count() == 5
    with pytest.raises(Exception, match="(?i)not.*exist"):
        spark.read.parquet(gone._stored_at).count()
    session.discard()
