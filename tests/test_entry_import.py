"""The entry point imports without Spark's jars, and outside the repository folder."""

import os
import subprocess
import sys

from pyspark.ml.feature import StopWordsRemover

from callsight.functions import stopwords
from conftest import ROOT


def test_entry_imports_without_jars(tmp_path):
    code = ("import sys, pyspark; pyspark.__path__.insert(0, '/nowhere'); pyspark.__file__ = '/nowhere/__init__.py'; "
            f"sys.path.insert(0, {ROOT!r}); import __spark_entry__ as e; assert len(e.queries()) > 60; e.oracle_sql()")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=120)


def test_entry_imports_without_a_package_of_the_corpus_operators(tmp_path):
    code = (f"import sys; sys.modules['xxhash'] = None; sys.path.insert(0, {ROOT!r}); import __spark_entry__ as e; "
            "assert len(e.queries()) > 80 and 'monthly_conversion' in e.queries()")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=120)


def test_stopwords_equal_mllib(spark):
    for language in ("spanish", "english"):
        assert list(stopwords.default_stopwords(language)) == list(StopWordsRemover.loadDefaultStopWords(language))


def test_ids_above_nine_digits(spark):
    from callsight.functions.scalar import format_id
    from pyspark.sql import functions as F
    assert spark.range(1).select(format_id("C", F.lit(12345678901)).alias("x")).first().x == "C12345678901"
