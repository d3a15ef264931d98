"""Driver contract: entry runs, every SQL twin matches its query (sf0.001)."""

import hashlib
import math

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from verso.plans.catalog import QUERIES
from verso.plans.oracle import ORACLE_SQL

def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keyed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha1("\n".join(keyed).encode()).hexdigest()


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "artist_name", "track_name", "release_date", "genre", "lyrics"]
    assert df.count() > 0


def test_every_query_has_a_twin():
    q, o = set(entry.queries()), set(entry.oracle_sql())
    assert o <= q
    assert set(QUERIES) == set(ORACLE_SQL) <= q


SPARK_TYPES = {"string": "str", "int": "int32", "bigint": "int64", "double": "float64"}
DUCK_TYPES = {"VARCHAR": "str", "INTEGER": "int32", "BIGINT": "int64", "DOUBLE": "float64"}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql_twin(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(entry.oracle_sql()[name])
    spark_types = {f.name: SPARK_TYPES.get(f.dataType.simpleString()) for f in df.schema.fields}
    duck_types = {c: DUCK_TYPES.get(str(t)) for c, t in zip(rel.columns, rel.types)}
    assert spark_types == duck_types
    res = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _digest(df.columns, rows) == _digest(dcols, drows)
