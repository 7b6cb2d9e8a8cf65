"""Tables stored between passes need a folder that is named, and can be removed."""

import os
import subprocess
import sys

import pytest

from bugtide import storage

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_without_a_folder_the_error_says_so(tmp_path):
    script = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
from bugtide.storage import written
try:
    written(spark.range(3))
except ValueError as error:
    print("ERROR", error)
"""
    clean = {k: x for k, x in os.environ.items() if not k.startswith(("PYTHONPATH", "PYSPARK", "SPARK"))}
    clean["SPARK_CONF_DIR"] = str(tmp_path)
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=180)
    assert "ERROR set spark.checkpoint.dir" in done.stdout, done.stderr[-2000:]


def test_stored_tables_can_be_released(spark):
    df = storage.written(spark.range(3))
    folder = storage._folders[-1]
    assert df.count() == 3 and os.path.exists(folder)
    others, storage._folders[:] = storage._folders[:-1], [folder]
    storage.release(spark)
    storage._folders[:] = others
    assert not os.path.exists(folder)


def test_only_tables_of_one_step_are_released(spark):
    first = storage.written(spark.range(2))
    before = storage.stored()
    storage.written(spark.range(3))
    last = storage.written(spark.range(4))
    gone = storage._folders[before]
    storage.release(spark, since=before, keep=1)
    assert not os.path.exists(gone) and storage.stored() == before + 1
    assert (first.count(), last.count()) == (2, 4)
