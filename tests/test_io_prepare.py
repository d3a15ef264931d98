"""CSV round trip, column checks, preparation and the hash split."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verso.operators.prepare import hash_split, prepare_rows, prepare_text_rows, with_fold
from verso.schema import SONG_SCHEMA, MissingColumnsError, require_columns
from verso.session import scratch_path
from verso.sources.csv import corrupt_records, read_songs_csv, write_songs_csv


def test_csv_round_trip_quotes_commas_newlines(spark):
    rows = [
        ("Band's Name", 'He said "hi", then left', 2009, "K-Pop", "line one\nline two, with comma"),
        ("  padded  ", "title", None, "K-Pop", 'quote " alone'),
        ("a", "", 1999, None, "tab\there"),
    ]
    df = spark.createDataFrame(rows, SONG_SCHEMA)
    path = scratch_path(spark, "test-csv")
    write_songs_csv(df, path)
    back = sorted(read_songs_csv(spark, path).collect(), key=lambda r: r["artist_name"])
    assert back[0]["artist_name"] == "  padded  " and back[0]["release_date"] is None
    assert back[2]["track_name"] is None  # "" comes back null
    assert back[2]["genre"] is None and back[2]["lyrics"] == "tab\there"
    assert back[1]["track_name"] == 'He said "hi", then left'
    assert back[1]["lyrics"] == "line one\nline two, with comma"
    assert back[0]["lyrics"] == 'quote " alone'
    assert len(back) == 3


def test_csv_bad_year_is_null_not_failure(spark):
    path = scratch_path(spark, "test-csv-bad")
    df = spark.createDataFrame([("a", "t", "n/a", "g", "text text text")], "artist_name string, track_name string, release_date string, genre string, lyrics string")
    write_songs_csv(df, path)
    back = read_songs_csv(spark, path).collect()
    assert back[0]["release_date"] is None and back[0]["lyrics"] == "text text text"


def test_csv_columns_by_header_name(spark):
    path = scratch_path(spark, "test-csv-names")
    other = spark.createDataFrame(
        [(0, "la, \"la\" la", "mukesh", "song", "1950", "pop", "x"), (1, "text\nmore", "b", "t", "bad", None, "y")],
        "id int, lyrics string, artist_name string, track_name string, release_date string, genre string, topic string")
    write_songs_csv(other.withColumnRenamed("id", ""), path)
    back = read_songs_csv(spark, path)
    assert back.schema == SONG_SCHEMA
    assert sorted(tuple(r) for r in back.collect()) == [("b", "t", None, None, "text\nmore"), ("mukesh", "song", 1950, "pop", 'la, "la" la')]
    with pytest.raises(MissingColumnsError):
        write_songs_csv(other.drop("genre"), path)
        read_songs_csv(spark, path)


def test_csv_records_that_do_not_fit_the_header(spark):
    import os

    from conftest import local_path

    path = scratch_path(spark, "test-csv-corrupt")
    write_songs_csv(spark.createDataFrame([("a", "t", 1999, "g", "some text")], SONG_SCHEMA).coalesce(1), path)
    name = next(n for n in os.listdir(local_path(path)) if n.startswith("part-"))
    with open(f"{local_path(path)}/{name}", "a", encoding="utf-8") as f:
        f.write('"b","only two"\n')
    os.unlink(f"{local_path(path)}/.{name}.crc")
    assert corrupt_records(spark, path) == 1
    assert [r["artist_name"] for r in read_songs_csv(spark, path).collect()] == ["a"]
    assert read_songs_csv(spark, path).count() == 1 == read_songs_csv(spark, path).select("artist_name").count()


def test_csv_files_with_different_headers_are_an_error(spark):
    path = scratch_path(spark, "test-csv-mixed")
    df = spark.createDataFrame([("a", "t", 1999, "g", "some text")], SONG_SCHEMA)
    df.coalesce(1).write.option("header", True).csv(path)
    df.select("lyrics", "artist_name", "track_name", "release_date", "genre").coalesce(1).write.mode("append").option("header", True).csv(path)
    with pytest.raises(Exception, match="header"):
        read_songs_csv(spark, path).collect()


def test_require_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    require_columns(df, ["a"])
    with pytest.raises(MissingColumnsError):
        require_columns(df, ["a", "lyrics"])


def test_missing_path_raises(spark):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        read_songs_csv(spark, "/nonexistent/verso/songs.csv").collect()


def test_prepare_rows_rules(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType())] + [
        T.StructField(f.name, T.StringType()) for f in SONG_SCHEMA.fields
    ])
    rows = [
        (1, "a", "t", "1999", "g", "x" * 11),
        (2, "a", "t", "1999", "g", "x" * 10),  # not longer than 10
        (3, "a", "t", None, "g", "x" * 20),  # no year
        (4, "a", "t", "n/a", "g", "x" * 20),  # bad year -> null -> dropped
        (5, None, "t", "2000", "g", "x" * 20),  # null artist
        (6, "a", "t", "2000", "g", None),
    ]
    df = spark.createDataFrame(rows, schema)
    assert [r["doc_id"] for r in prepare_rows(df, keep=("doc_id",)).collect()] == [1]
    text = sorted(r["doc_id"] for r in prepare_text_rows(df, keep=("doc_id",)).collect())
    assert text == [1, 3, 4, 5]
    assert dict(prepare_rows(df, keep=("doc_id",)).dtypes)["release_date"] == "int"


def test_hash_split_disjoint_complete_repeatable(spark):
    df = spark.range(2000).withColumnRenamed("id", "doc_id")
    tr, te = hash_split(df)
    a = {r[0] for r in tr.collect()}
    b = {r[0] for r in te.collect()}
    assert not (a & b) and len(a | b) == 2000
    assert 0.75 < len(a) / 2000 < 0.85
    tr2, _ = hash_split(df.repartition(13))
    assert {r[0] for r in tr2.collect()} == a


def test_folds_cover_range(spark):
    df = with_fold(spark.range(300).withColumnRenamed("id", "doc_id"), folds=3)
    counts = {r["fold"]: r["count"] for r in df.groupBy("fold").count().collect()}
    assert set(counts) == {0, 1, 2} and all(c > 60 for c in counts.values())


def test_csv_sink_writes_nothing_for_no_rows(spark):
    import os

    path = scratch_path(spark, "test-csv-empty")
    empty = spark.createDataFrame([], SONG_SCHEMA)
    from conftest import local_path

    assert write_songs_csv(empty, path) is False
    assert not os.path.exists(local_path(path))
    assert write_songs_csv(spark.createDataFrame([("a", "t", 1, "g", "x")], SONG_SCHEMA), path) is True
    assert os.path.isdir(local_path(path))


def test_prepare_year_strings(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType())] + [
        T.StructField(f.name, T.StringType()) for f in SONG_SCHEMA.fields
    ])
    years = ["1999", "1999-05-01", "", None, "n/a"]
    rows = [(i, "a", "t", y, "g", "x" * 20) for i, y in enumerate(years)]
    out = {r["doc_id"]: r["release_date"] for r in prepare_rows(spark.createDataFrame(rows, schema), keep=("doc_id",)).collect()}
    # only a clean integer survives the cast; the rest become null and leave with the null check
    assert out == {0: 1999}
