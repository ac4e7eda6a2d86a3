"""Every registered query against its SQL on the smallest tables."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from bindings.registry import QUERIES
from oracle import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) and set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(queries()[name](spark, SF), con, oracle_sql()[name]) == []


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["date", "primary_language", "total_commits", "month_total", "share"]
    assert df.count() > 0


def test_metadata_files_are_bounded(spark, monkeypatch):
    from bindings import queries as bound
    from repotrends.sources import read_metadata

    monkeypatch.setattr(bound, "IN_ARRAY", 10)
    path = bound._stored_metadata(spark, SF)
    sizes = [r.n for r in read_metadata(spark, path).groupBy("_metadata.file_path").agg(
        F.count(F.lit(1)).alias("n")).collect()]
    users = spark.read.parquet(f"{SF}/events.parquet").select("user_id").distinct().count()
    assert sum(sizes) == users and len(sizes) >= users / 10 and max(sizes) <= 40


@pytest.mark.parametrize("package", ["tokenizers", "public_tokenizers", "xxhash"])
def test_queries_without_a_third_party_package(package):
    """What the optional part needs may be absent; the library's queries are still there."""
    code = ("import sys, warnings; warnings.simplefilter('ignore'); sys.modules[%r] = None; import __spark_entry__ as e; "
            "print(len(e.queries()), len(set(e.oracle_sql()) - set(e.queries())))" % package)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) >= len(QUERIES) and out[1] == "0"
