"""Corpus operators: dedup, cap, top-k, prefix sums, look-ups, payloads."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verso.operators import corpus as corp
from verso.operators.prefix import exclusive_prefix_sum
from verso.sources.payload import payload_records

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("artist_name", T.StringType()),
        T.StructField("track_name", T.StringType()),
        T.StructField("lyrics", T.StringType()),
    ]
)


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_dedup_keeps_first_and_does_not_join_keys(spark):
    data = [
        (3, "a", "t", "third"),
        (1, "a", "t", "first"),
        (2, "a", "T", "case differs"),
        (4, "a|b", "c", "pipe left"),
        (5, "a", "b|c", "pipe right"),
        (6, None, "t", "null artist"),
        (7, None, "t", "null artist again"),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    got = _rows(corp.dedup_first(df), "doc_id", "lyrics")
    assert got == [(1, "first"), (2, "case differs"), (4, "pipe left"), (5, "pipe right"), (6, "null artist")]


def test_dedup_and_cap_repeatable_under_repartition(spark):
    rnd = random.Random(7)
    data = [(i, f"ar{rnd.randint(0, 6)}", f"t{rnd.randint(0, 5)}", f"x{i}") for i in range(400)]
    df = spark.createDataFrame(data, SCHEMA)
    base = _rows(corp.cap_at_target(corp.dedup_first(df), target=15), "doc_id")
    for n in (1, 3, 11):
        again = _rows(corp.cap_at_target(corp.dedup_first(df.repartition(n)), target=15), "doc_id")
        assert again == base


def _python_cap(counts, target):
    kept, total = [], 0
    for artist in sorted(counts):
        kept.append(artist)
        total += counts[artist]
        if total >= target:
            break
    return kept


@pytest.mark.parametrize("target", [1, 5, 10, 11, 30, 1000])
def test_cap_matches_collector_loop(spark, target):
    counts = {"a": 4, "b": 6, "c": 1, "d": 9, "e": 3}
    data = []
    i = 0
    for artist, n in counts.items():
        for _ in range(n):
            data.append((i, artist, f"t{i}", "x"))
            i += 1
    df = spark.createDataFrame(data, SCHEMA)
    kept = sorted({r[0] for r in corp.cap_at_target(df, target=target).select("artist_name").collect()})
    assert kept == _python_cap(counts, target)


def test_prefix_sum_matches_brute_force(spark):
    rnd = random.Random(3)
    vals = [(f"k{i:04d}", rnd.randint(1, 9)) for i in range(500)]
    rnd.shuffle(vals)
    df = spark.createDataFrame(vals, "k string, v int").repartition(7)
    got = {r["k"]: r["prior"] for r in exclusive_prefix_sum(df, ["k"], "v", "prior").collect()}
    running = 0
    for k, v in sorted(vals):
        assert got[k] == running
        running += v


def test_top_per_group_ties_by_id(spark):
    data = [(i, "a" if i < 6 else "b", f"t{i}", "x") for i in range(9)]
    df = spark.createDataFrame(data, SCHEMA).withColumn("pop", F.lit(1))
    top = corp.top_per_group(df, ["artist_name"], [F.desc("pop"), F.asc("doc_id")], 2)
    assert _rows(top, "doc_id") == [(0,), (1,), (6,), (7,)]


def test_top_per_group_plan_limits_before_shuffle(spark):
    df = spark.range(100).selectExpr("id as doc_id", "cast(id % 3 as string) as artist_name", "id as pop")
    top = corp.top_per_group(df, ["artist_name"], [F.desc("pop"), F.asc("doc_id")], 10)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_matched_and_unmatched_split_songs(spark):
    songs = spark.createDataFrame([(1, "a", "t1", "x"), (2, "a", "t2", "y"), (3, "b", "t1", "z")], SCHEMA)
    hits = spark.createDataFrame([("a", "t1"), ("a", "t1"), ("b", "t9")], "artist_name string, track_name string")
    keys = ["artist_name", "track_name"]
    assert _rows(corp.matched_records(songs, hits, keys), "doc_id") == [(1,)]
    assert _rows(corp.unmatched_records(songs, hits, keys), "doc_id") == [(2,), (3,)]


def test_merge_keeps_duplicates_by_name(spark):
    a = spark.createDataFrame([(1, "a", "t", "x")], SCHEMA)
    b = spark.createDataFrame([(1, "a", "t", "x")], SCHEMA).select("lyrics", "track_name", "artist_name", "doc_id")
    merged = corp.merge_corpora(a, b, ["doc_id", "artist_name", "track_name", "lyrics"])
    assert merged.count() == 2 and merged.columns == ["doc_id", "artist_name", "track_name", "lyrics"]


def test_count_and_totals(spark):
    df = spark.createDataFrame([(1, "a", "t", "x"), (2, "a", "u", "x"), (3, "b", "t", "x")], SCHEMA)
    assert _rows(corp.count_per_group(df), "artist_name", "songs") == [("a", 2), ("b", 1)]
    t = corp.totals(df).collect()[0]
    assert (t["records"], t["groups"]) == (3, 2)


def test_payload_year_fallback_and_malformed(spark):
    rows = [
        {"artist": {"name": "A"}, "song": {"id": 1, "title": "S1", "lyrics": "la"},
         "detail": {"song": {"release_date": "2001-02-03", "album": {"release_date": "1999"}}}},
        {"artist": {"name": "A"}, "song": {"id": 2, "title": "S2"},
         "detail": {"song": {"release_date": None, "album": {"release_date": "1998-01-01"}}}},
        {"artist": {"name": "B"}, "song": {"id": 3, "title": "S3"}, "detail": {"song": {}}},
        {"artist": {"name": "B"}, "song": {"id": 4, "title": "S4"}},
    ]
    texts = [json.dumps(r) for r in rows] + ["{not json"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, payload string")
    got = {r["i"]: r for r in payload_records(df, "payload", keep=("i",)).collect()}
    assert [got[i]["release_year"] for i in range(5)] == ["2001", "1998", None, None, None]
    assert got[0]["artist_name"] == "A" and got[0]["song_id"] == 1 and got[0]["lyrics"] == "la"
    assert got[4]["track_name"] is None


def test_kept_groups_with_own_order_column(spark):
    # groups taken in order of their first doc_id, not by name
    data = [(10, "z", "t1", "x"), (11, "z", "t2", "x"), (20, "a", "t1", "x"), (30, "m", "t1", "x")]
    df = spark.createDataFrame(data, SCHEMA)
    kept = {r["artist_name"]: (r["songs"], r["prior_songs"]) for r in corp.kept_groups(df, "artist_name", "doc_id", 3).collect()}
    assert kept == {"z": (2, 0), "a": (1, 2)}


def test_spread_only_when_few_splits(spark):
    from verso.session import spread

    many = spark.range(1000).repartition(16)
    assert spread(many, 8) is many
    assert spread(spark.range(10).coalesce(1), 8).rdd.getNumPartitions() == 8


def test_hot_key_third_of_rows_matches_brute_force(spark):
    # one artist and one (artist, title) pair hold a third of all rows
    rnd = random.Random(11)
    data = []
    for i in range(900):
        if i % 3 == 0:
            data.append((i, "hot", "same title", f"x{i}"))
        else:
            data.append((i, f"ar{rnd.randint(0, 40)}", f"t{rnd.randint(0, 3)}", f"x{i}"))
    rnd.shuffle(data)
    df = spark.createDataFrame(data, SCHEMA).repartition(9)
    dedup = _rows(corp.dedup_first(df), "doc_id")
    first = {}
    for i, a, t, _ in sorted(data):
        first.setdefault((a, t), i)
    assert dedup == sorted((i,) for i in first.values())
    pop = df.withColumn("pop", F.col("doc_id") % 7)
    top = _rows(corp.top_per_group(pop, ["artist_name"], [F.desc("pop"), F.asc("doc_id")], 10), "doc_id")
    by_artist = {}
    for i, a, _, _ in data:
        by_artist.setdefault(a, []).append((-(i % 7), i))
    expect = sorted((i,) for rows in by_artist.values() for _, i in sorted(rows)[:10])
    assert top == expect


def test_dedup_plan_aggregates_before_shuffle(spark):
    df = spark.range(100).selectExpr("id as doc_id", "'a' as artist_name", "'t' as track_name", "'x' as lyrics")
    plan = corp.dedup_first(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min_by") > plan.index("Exchange")  # partial sits below (after) the exchange in the tree text


def test_payload_corpus_end_to_end(spark):
    from verso.plans.corpus import build_corpus
    from verso.sources.payload import corpus_records_from_payloads

    def p(artist, sid, title, lyrics, song_date=None, album_date=None, detail=True):
        d = {"artist": {"name": artist}, "song": {"id": sid, "title": title, "lyrics": lyrics}}
        if detail:
            d["detail"] = {"song": {"release_date": song_date, "album": {"release_date": album_date}}}
        return json.dumps(d)

    rows = [
        (1, 50, p("A", 1, "one", "[Intro]\nla la la la la", "2001-02-03", "1999")),
        (2, 40, p("A", 2, "two", "short", "2002")),  # too short: skipped
        (3, 30, p("A", 3, "one", "duplicate title text", None, "1998-01-01")),  # dup of 1
        (4, 20, p("B", 4, "Song (Remix)", "remix lyrics here", "2004")),  # excluded title
        (5, 10, p("B", 5, "five", "album only year here", None, "1997", )),
        (6, 5, p("C", 6, "six", "no detail record at all", detail=False)),
        (7, 1, "{broken json"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, popularity long, payload string")
    out = {r["doc_id"]: r for r in build_corpus(corpus_records_from_payloads(df), None).collect()}
    assert sorted(out) == [1, 5, 6]  # 7 has no artist: its own group, but null lyrics fail the length test
    assert out[1]["lyrics"] == "la la la la la" and out[1]["release_date"] == 2001
    assert out[5]["release_date"] == 1997 and out[6]["release_date"] is None
    assert {r["genre"] for r in out.values()} == {"K-Pop"}


RECORD = "doc_id long, artist_name string, track_name string, popularity long, song_date string, genre string, lyrics string"


def test_build_corpus_uses_the_hits_it_finds(spark):
    from verso.plans.corpus import build_corpus

    recs = spark.createDataFrame(
        [(1, "A", "found", 9, "2001", "g", "own lyrics, not used"), (2, "A", "missing", 8, None, "g", "long enough lyrics"),
         (3, "A", "found too", 1, None, "g", "long enough lyrics"), (4, "B", "short hit", 1, None, "g", "long enough lyrics")], RECORD)
    hits = spark.createDataFrame(
        [(71, "A", "found", "the hit's [x] lyrics"), (70, "A", "found", "the first hit's lyrics"), (72, "A", "found too", "long enough too"),
         (73, "B", "short hit", "short")], "hit_id long, artist_name string, track_name string, lyrics string")
    pages = spark.createDataFrame([(70, "in 1987"), (1, "in 1901")], "page_id long, html string")
    # the limit (k=2) comes before the look-up, so doc 3 never reaches it
    out = [tuple(r) for r in build_corpus(recs, pages, top_k=2, hits=hits).collect()]
    assert out == [(1, "A", "found", 2001, "g", "the first hit's lyrics")]
    undated = recs.withColumn("song_date", F.lit(None).cast("string"))
    assert build_corpus(undated, pages, top_k=2, hits=hits).first()["release_date"] == 1987  # the hit's detail record


def collector_loop(records, artists, target, top_k=10):
    """The collector's loop, in plain Python: (doc_id, ...) in order of collection."""
    out, seen = [], set()
    for artist in artists:
        own = sorted((r for r in records if r[1] == artist and not any(t in (r[2] or "").lower() for t in ("remix", "live", "cover", "instrumental"))),
                     key=lambda r: (-r[3], r[0]))[:top_k]
        for r in own:
            if r[6] and len(r[6]) >= 10 and (artist, r[2]) not in seen:
                seen.add((artist, r[2]))
                out.append(r[0])
        if len(out) >= target:
            break
    return sorted(out)


@pytest.mark.parametrize("target", [1, 7, 20, 1000])
def test_build_corpus_equals_the_collector_loop(spark, target):
    from verso.plans.corpus import build_corpus

    rnd = random.Random(21)
    names = ["zed", "abba", None, "mid", "Beat", "zz"]
    records = []
    for i in range(300):  # popularity and id disagree; titles repeat; some texts are short
        records.append((i, rnd.choice(names), rnd.choice(["one", "two", "three", "four Live", "five", "six", None]) , rnd.randint(0, 40),
                        rnd.choice([None, "1999-01-01", "x"]), "g", rnd.choice(["long enough lyrics", "short", None, "another long text"])))
    df = spark.createDataFrame(records, RECORD).repartition(7)
    by_name = sorted({r[1] for r in records}, key=lambda a: (a is not None, a))
    got = sorted(r["doc_id"] for r in build_corpus(df, None, target=target).collect())
    assert got == collector_loop(records, by_name, target)
    listed = ["mid", "absent", "zz", "abba"]
    got = sorted(r["doc_id"] for r in build_corpus(df, None, target=target, artists=listed).collect())
    assert got == collector_loop(records, listed, target)


def test_build_corpus_without_limits_keeps_every_distinct_song(spark):
    from verso.plans.corpus import build_corpus

    records = [(i, "a" if i % 2 else None, f"t{i % 30}", i, None, "g", "long enough lyrics") for i in range(200)]
    out = build_corpus(spark.createDataFrame(records, RECORD), None, top_k=None, target=None).collect()
    assert len(out) == 30


def test_no_text_is_shuffled_before_the_winners_are_known(spark):
    from verso.plans.corpus import corpus_records_from_documents, kept_songs

    docs = spark.createDataFrame([(i, f"text {i} long enough", "en", f"s{i % 3}", 20) for i in range(50)], "doc_id long, text string, lang string, source string, n_chars long")
    import verso.plans.corpus as plan

    seen = []
    real = plan.materialize
    plan.materialize = lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or real(df)
    try:
        kept_songs(corpus_records_from_documents(docs)).count()
    finally:
        plan.materialize = real
    above = [line for line in seen[0].split("\n") if "Exchange" in line or "Sort " in line]
    assert above and not any("text#" in line or "lyrics#" in line or "track_name#" in line for line in above)


def test_prefix_sum_without_aqe_and_many_partitions(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "37")
        vals = [(f"k{i:03d}", (i * 7) % 11 + 1) for i in range(300)]
        df = spark.createDataFrame(vals, "k string, v int").repartition(5)
        got = {r["k"]: r["prior"] for r in exclusive_prefix_sum(df, ["k"], "v", "prior").collect()}
        running = 0
        for k, v in sorted(vals):
            assert got[k] == running
            running += v
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
