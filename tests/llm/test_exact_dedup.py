"""Exact dedup: SQL twin, brute force, filter properties, hot groups."""

import hashlib
from collections import defaultdict

import duckdb
from pyspark.sql import functions as F

from conftest import SF_SMALL
from verso.llm import exact_dedup as X
from verso.llm.queries import ORACLE_SQL, QUERIES

SCHEMA = "doc_id long, text string"


def brute(rows):
    groups = defaultdict(list)
    for i, (d, t) in enumerate(rows):
        groups[t or ""].append((-1 << 70 if d is None else d, i))
    out = []
    for t, members in groups.items():
        top = max(members)
        for d, i in members:
            # of rows with one id and one text it is open which stays
            out.append((rows[i][0], rows[top[1]][0], len(members), d == top[0], hashlib.sha256(t.encode()).hexdigest()))
    return out


def check(spark, rows, **sizes):
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.sha).hex()) for r in X.mark(spark.createDataFrame(rows, SCHEMA), **sizes).collect()]
    want = brute(rows)
    assert sorted(map(str, [g[:3] + g[4:] for g in got])) == sorted(map(str, [w[:3] + w[4:] for w in want]))
    assert {g for g in got if g[3]} <= set(want)  # one of the largest id stays
    assert sorted(g[4] for g in got if g[3]) == sorted({w[4] for w in want})  # one a text


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    got = QUERIES["op13_exact_dedup"](spark, SF_SMALL)
    want = con.sql(ORACLE_SQL["op13_exact_dedup"])
    assert got.columns == want.columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall()))


def test_nulls_ties_repeated_rows(spark):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, ""), (None, "a"), (None, None), (None, "z"), (None, "z"), (5, "A"), (6, "a "), (7, "é" * 9), (9, "é" * 9)]
    check(spark, rows)
    check(spark, rows, bits_a_row=1)  # a full filter: every row is shuffled, same result
    check(spark, rows, slice_rows=3)


def test_empty_table_and_long_text(spark):
    assert X.mark(spark.createDataFrame([], SCHEMA)).collect() == []
    assert X.distinct(spark.createDataFrame([], SCHEMA)).collect() == []
    long = "word " * 400_000
    check(spark, [(1, long), (2, long + "x"), (3, long)])


def test_hot_text_and_hot_id(spark):
    """A third of the rows has one text, a third one id with texts of its own."""
    hot = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("text"),
    )
    got = X.mark(hot, slice_rows=8_000)
    seen = got.groupBy("group_size").agg(F.count("*").alias("rows"), F.sum(F.col("kept").cast("int")).alias("kept"), F.max("keep_id").alias("top")).orderBy("group_size").collect()
    assert [tuple(r) for r in seen] == [(1, 20_000, 20_000, 29_999), (10_000, 10_000, 1, 29_997)]


def test_filter_never_misses_and_mostly_spares(spark):
    texts = spark.range(20_000).select(F.concat(F.lit("t"), (F.col("id") % 19_000).cast("string")).alias("text"))
    narrow = texts.select("text", X.text_hash(F.col("text")).alias("sha"))
    flagged = X.possibly_repeated(narrow, 20_000 * X.BITS_A_ROW // 64)
    again = texts.groupBy("text").count()
    seen = flagged.join(again, "text").groupBy(F.col("count") > 1, "maybe").count().collect()
    n = {(r[0], r["maybe"]): r["count"] for r in seen}
    assert (True, False) not in n and n[True, True] == 2_000
    assert n[False, True] < 0.05 * 18_000


def test_alone_rows_are_not_shuffled(spark):
    """Between the scan and the output of the alone rows there is no exchange of rows."""
    narrow = spark.range(100).select(F.col("id").alias("doc_id"), X.text_hash(F.col("id").cast("string")).alias("sha"))
    plan = X.possibly_repeated(narrow, 25)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_distinct_keeps_all_columns(spark):
    rows = [(1, "a", "x", 1), (2, "a", "y", 2), (3, "b", "z", 3), (3, "b", "z", 3), (None, None, "n", 4), (8, "", "m", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sha string, maybe int")
    want = [(2, "a", "y", 2), (3, "b", "z", 3), (8, "", "m", 5)]
    for slice_rows in (X.SLICE_ROWS, 2):
        got = X.distinct(docs, slice_rows=slice_rows)
        assert got.columns == docs.columns
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
