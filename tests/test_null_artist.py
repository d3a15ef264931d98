"""The cap with a null artist: the query and its twin on the same rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from verso.plans.catalog import QUERIES
from verso.plans.oracle import ORACLE_SQL
from verso.session import scratch_path


@pytest.fixture(scope="module")
def nulls(spark):
    """Documents of which some have no source."""
    folder = scratch_path(spark, "nulls")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs.withColumn("source", F.when(F.col("doc_id") % 7 != 3, F.col("source"))).write.parquet(f"{folder}/documents.parquet")
    return folder


@pytest.mark.parametrize("name", ["cap_at_target", "songs_per_artist"])
def test_null_artist(spark, nulls, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{nulls.removeprefix('file:')}/documents.parquet/*.parquet')")
    got, want = QUERIES[name](spark, nulls), con.sql(ORACLE_SQL[name])
    rows = [tuple(r[c] for c in want.columns) for r in got.collect()]
    assert any(None in r for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, want.fetchall()))
