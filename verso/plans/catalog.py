"""Registered queries over the driver tables, and their DuckDB twins.

Every query reads whole tables and whole texts (no id subsets, no row caps; the
only limits are the features themselves: top-10 per artist, the 100-song cap and
the 10,000-term vocabulary) and uses the reference's settings. Doubles are rounded
to 6 places on both sides so the value hash does not depend on summation order.
Where the driver tables hold nothing for a rule to act on, the query derives its
input from them by id (a bracket, a title suffix, a payload), and so does the twin.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verso.functions.text import (
    DEFAULT_GENRE,
    SITE_ARTIFACT,
    clean_lyrics,
    first_year,
    json_field,
    reject_reason,
    request_text,
    to_text_or_empty,
)
from verso.operators import corpus as corp
from verso.operators import features as feat
from verso.operators.evaluate import classification_metrics, confusion_counts, metrics_report
from verso.operators.filters import (
    collect_filter,
    exclude_titles,
    filter_record_kind,
    tag_constant_label,
    to_song_schema,
    with_default_year,
)
from verso.operators.counts import RowCounts
from verso.operators.growing_corpus import GrowingCorpus
from verso.operators.model import ForestSettings, tune_classifier
from verso.operators.prepare import (
    TRAIN_BUCKETS,
    class_distribution,
    hash_bucket,
    hash_split,
    prepare_rows,
    prepare_text_rows,
    sample_hash,
    sample_per_class,
)
from verso.operators.score import decode_label, labels_array, percent, score, score_json
from verso.plans.corpus import build_corpus, corpus_from_documents, corpus_records_from_documents, corpus_report
from verso.plans.jobs import corpus_job
from verso.plans.training import evaluate, train_and_evaluate, train_merged
from verso.schema import SONG_COLUMNS, SONG_SCHEMA
from verso.session import materialize, scratch_path, spread
from verso.sources.csv import read_songs_csv, write_songs_csv
from verso.sources.landing import parsed
from verso.sources.models import load_model, save_model
from verso.sources.payload import corpus_records_from_payloads, payload_records
from verso.sources.tables import read_table, song_years, songs
from verso.streaming.score_stream import run_score_stream
from verso.streaming.split_stream import done_batches, read_split, start_split_stream

Query = Callable[[SparkSession, str], DataFrame]

ROUND = 6
TUNING_FITS = 8  # most forests that the tuning queries train side by side
F1_FLOOR = 0.5  # of a fit on the whole table; a check that it learned, not a target


def _docs(spark, d):
    # documents is the one wide text table; a file with a single row group
    # arrives as one split, so spread it (a no-op for inputs already split
    # into many partitions).
    return spread(read_table(spark, d, "documents"))


# --------------------------------------------------------------- text (T*)

def q_clean_lyrics(spark, d):
    """A third of the texts get the site artifact and section headers."""
    marked = F.concat(F.lit("[Verse 1]"), F.col("text"), F.lit(" [a\n[b] " + SITE_ARTIFACT))
    return _docs(spark, d).select("doc_id", clean_lyrics(F.when(F.col("doc_id") % 3 == 0, marked).otherwise(F.col("text"))).alias("lyrics"))


def q_release_year(spark, d):
    return _docs(spark, d).select("doc_id", first_year("text").alias("release_year"))


def q_release_year_fallback(spark, d):
    return song_years(spark, d).withColumnRenamed("release_date", "release_year")


def q_tokenize(spark, d):
    counts = feat.row_term_counts(feat.tokenize(_docs(spark, d).select("doc_id", "text"), "text", "words"))
    return feat.exploded_counts(counts).withColumnRenamed("tf", "n")


def q_token_order(spark, d):
    """Every token with its position in the text."""
    words = feat.tokenize(_docs(spark, d).select("doc_id", "text"), "text", "words")
    rows = words.select("doc_id", F.posexplode_outer("words").alias("position", "term"))
    return rows.where(F.col("term").isNotNull())


def q_validate_input(spark, d):
    return _docs(spark, d).select("doc_id", reject_reason("text").alias("error"))


def q_default_year(spark, d):
    return with_default_year(song_years(spark, d)).select("doc_id", "release_date")


def q_stringify_nulls(spark, d):
    return songs(spark, d).select("doc_id", *[to_text_or_empty(c).alias(c) for c in SONG_COLUMNS])


def q_percent_rounding(spark, d):
    li = read_table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", percent(F.col("l_extendedprice") / 100000.0).alias("pct"))


def q_json_payload_fields(spark, d):
    landed = landed_payloads(spark, d)
    return payload_records(landed, "payload", keep=("doc_id", "payload")).select(
        "doc_id",
        json_field("payload", "$.artist.name").alias("artist_field"),
        F.coalesce("artist_name", F.lit("")).alias("artist_name"),
        F.coalesce("release_year", F.lit("")).alias("release_year"),
        json_field("payload", "$.song.none").alias("missing_field"),
    )


def q_request_text(spark, d):
    """Requests: even ids send JSON (every third of all ids without the field), odd
    ids a form field."""
    docs = _docs(spark, d)
    body = F.when(F.col("doc_id") % 3 == 0, F.lit('{"other": 1}')).otherwise(F.to_json(F.struct(F.col("text").alias("lyrics"))))
    form = F.when(F.col("doc_id") % 3 != 0, F.col("text"))
    return docs.select("doc_id", request_text(F.col("doc_id") % 2 == 0, body, form).alias("lyrics"))


# ------------------------------------------------------- corpus (P*, J*, A*, W*)

def q_collect_filter(spark, d):
    return collect_filter(songs(spark, d)).select("doc_id", "artist_name", "track_name")


def q_exclude_titles(spark, d):
    """Titles of some ids get a suffix that the rule excludes, or nearly."""
    suffix = F.element_at(F.array(*map(F.lit, [" (Remix)", " live version", " Cov.er", " INSTRUMENTAL", ""])), (F.col("doc_id") % 5 + 1).cast("int"))
    titled = songs(spark, d).withColumn("track_name", F.concat("track_name", suffix))
    return exclude_titles(titled).select("doc_id", "track_name")


def q_job_counts(spark, d):
    """Rows that the corpus job and a training preparation read, reject and keep, counted
    by their own jobs. Titles of some ids get a suffix that the title rule excludes, others
    have no lyrics."""
    counts = RowCounts()
    suffix = F.when(F.col("doc_id") % 5 == 0, " (Remix)").otherwise("")
    lyrics = F.when(F.col("doc_id") % 7 != 0, F.col("lyrics"))
    records = corpus_records_from_documents(_docs(spark, d)).withColumn("track_name", F.concat("track_name", suffix)).withColumn("lyrics", lyrics)
    corpus_job(records, None, scratch_path(spark, "counted-corpus"), counts=counts, top_k=None, target=None)
    rows = prepare_rows(songs(spark, d).withColumn("lyrics", lyrics), keep=("doc_id",), counts=counts, step="initial")
    train, _ = hash_split(rows, counts=counts)
    materialize(class_distribution(train))
    return spark.createDataFrame(sorted(counts.get().items()), "step string, n bigint")  # one row a count


def q_filter_record_kind(spark, d):
    conv = read_table(spark, d, "conversations")
    return filter_record_kind(conv, "role", ["user"]).select("conv_id", "turn", "text")


def q_tag_constant_label(spark, d):
    s = tag_constant_label(songs(spark, d), DEFAULT_GENRE)
    return to_song_schema(s, keep=("doc_id",))


def search_table(spark, d):
    """A look-up table that Spark derives from the documents: two thirds of the
    songs can be found, with ids and lyrics of their own; one in five twice."""
    docs = read_table(spark, d, "documents").where(F.col("doc_id") % 3 != 0)
    twice = F.explode(F.when(F.col("doc_id") % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return docs.withColumn("_copy", twice).select(
        (F.col("doc_id") * 10 + F.col("_copy")).alias("hit_id"), F.col("source").alias("artist_name"), F.col("text").alias("track_name"),
        F.concat(F.lit("hit "), F.col("text")).alias("lyrics"),
    )


def _keyed(df):
    return df.withColumn("title_key", corp.text_key("track_name")).drop("track_name", "lyrics")


def q_unmatched_records(spark, d):
    mine = _keyed(songs(spark, d)).select("doc_id", "artist_name", "title_key")
    return corp.unmatched_records(mine, _keyed(search_table(spark, d)), ["artist_name", "title_key"])


def q_matched_records(spark, d):
    mine = _keyed(songs(spark, d)).select("doc_id", "artist_name", "title_key")
    return corp.matched_records(mine, _keyed(search_table(spark, d)), ["artist_name", "title_key"])


def q_search_hits(spark, d):
    return corp.search_hits(songs(spark, d), search_table(spark, d))


def q_top_songs_per_artist(spark, d):
    docs = _docs(spark, d).select("source", "doc_id", "n_chars")
    return corp.top_per_group(docs, ["source"], [F.desc("n_chars"), F.asc("doc_id")], corp.SONGS_PER_ARTIST, "rank")


def _dedup(spark, d):
    # Titles travel as keys: the query reports ids and keys, and no text is shuffled.
    keys = songs(spark, d).select("doc_id", "artist_name", corp.text_key("track_name").alias("title_key"))
    return corp.dedup_first(keys, ("artist_name", "title_key"), "doc_id")


def _capped(spark, d):
    # The count and the rows both read the narrow kept set: it is made once.
    return corp.cap_at_target(materialize(_dedup(spark, d)), "artist_name")


def q_dedup_songs(spark, d):
    return _dedup(spark, d).select("doc_id", "artist_name", "title_key")


def q_append_corpus(spark, d):
    """All songs appended in two runs, odd ids after even ones: a song of the second run
    is new only if the first did not have it."""
    rows = songs(spark, d).select("doc_id", "artist_name", "track_name")
    corpus = GrowingCorpus(spark, scratch_path(spark, "growing"), rows.schema)
    for run in (0, 1):
        corpus.append(rows.where(F.pmod("doc_id", F.lit(2)) == run), run)
    return corpus.songs().select("doc_id", "artist_name", corp.text_key("track_name").alias("title_key"), "run")


def q_cap_at_target(spark, d):
    return _capped(spark, d).select("doc_id", "artist_name", "title_key")


def q_songs_per_artist(spark, d):
    # kept_groups holds the count of each group already.
    return corp.kept_groups(_dedup(spark, d), "artist_name").select("artist_name", "songs")


def q_corpus_totals(spark, d):
    kept = corp.kept_groups(_dedup(spark, d), "artist_name")
    return kept.agg(F.coalesce(F.sum("songs"), F.lit(0)).alias("records"), F.count("artist_name").alias("groups"))


def _two_corpora(spark, d):
    """Documents, and conversation turns as a second corpus (role as genre)."""
    turns = spread(read_table(spark, d, "conversations"))
    other = turns.select((-1 - F.col("conv_id") * 1000 - F.col("turn")).alias("doc_id"), F.col("role").alias("genre"), F.col("text").alias("lyrics"))
    return songs(spark, d).select("doc_id", "genre", "lyrics"), other


def q_merge_corpora(spark, d):
    first, second = (prepare_text_rows(c, keep=("doc_id",)) for c in _two_corpora(spark, d))
    return corp.merge_corpora(first, second, ("doc_id", "genre", "lyrics"))


def q_build_corpus(spark, d):
    return corpus_from_documents(_docs(spark, d), read_table(spark, d, "pages"))


ARTISTS = ["src7", "src0", "nobody", "src13", "src2", "src19", "src4", "src11"]


def q_artist_list_corpus(spark, d):
    """The configured artist list as filter and order; 40 songs are enough."""
    return corpus_from_documents(_docs(spark, d), read_table(spark, d, "pages"), artists=ARTISTS, target=40)


def q_hit_corpus(spark, d):
    """Songs are looked up; the hit's own lyrics go into the corpus."""
    return build_corpus(corpus_records_from_documents(_docs(spark, d)), None, hits=search_table(spark, d))


def landed_payloads(spark, d):
    """API-style payloads that Spark derives from the tables: the text as
    the song's date and lyrics, the page html of the same id as the album's
    date (missing page: no album date)."""
    docs = _docs(spark, d)
    pages = read_table(spark, d, "pages")
    joined = docs.join(pages, docs["doc_id"] == pages["page_id"], "left")
    payload = F.struct(
        F.struct(F.col("source").alias("name")).alias("artist"),
        F.struct(F.col("doc_id").alias("id"), F.col("text").alias("title"),
                 F.col("text").alias("lyrics")).alias("song"),
        F.struct(F.struct(F.col("text").alias("release_date"),
                          F.struct(F.col("html").alias("release_date")).alias("album")).alias("song")).alias("detail"),
    )
    return joined.select("doc_id", F.col("n_chars").alias("popularity"), F.to_json(payload).alias("payload"))


def q_landed_variants(spark, d):
    """A payload of some kind from every document: as landed, with unknown keys, with a
    wrong type, empty, a list, cut off."""
    docs, k = _docs(spark, d), F.col("doc_id") % 6
    artist = F.struct(F.col("source").alias("name")).alias("artist")
    good = F.to_json(F.struct(artist, F.struct(F.col("doc_id").alias("id"), F.col("text").alias("lyrics")).alias("song")))
    unknown = F.to_json(F.struct(F.struct(F.col("text").alias("lyrics")).alias("song"), F.struct("lang", "n_chars").alias("about")))
    wrong = F.to_json(F.struct(artist, F.struct(F.concat(F.lit("id "), "text").alias("id")).alias("song")))
    payload = (
        F.when(k == 0, good).when(k == 1, unknown).when(k == 2, wrong).when(k == 3, F.lit(" "))
        .when(k == 4, F.concat(F.lit("["), good, F.lit("]"))).otherwise(F.left(good, F.length(good) - 1))
    )
    rows = parsed(docs.select("doc_id", payload.alias("payload")), keep=("doc_id",))
    return rows.select("doc_id", "artist_name", "song_id", F.sha2("lyrics", 256).alias("lyrics_key"), json_field("other", "$.about.lang", None).alias("about_lang"), "reason")


def q_payload_corpus(spark, d):
    records = corpus_records_from_payloads(landed_payloads(spark, d), "payload")
    return build_corpus(records, None)


def q_corpus_report(spark, d):
    return corpus_report(q_build_corpus(spark, d))


def _csv_schema():
    return T.StructType([T.StructField("doc_id", T.LongType()), *SONG_SCHEMA.fields])


def q_csv_round_trip(spark, d):
    path = scratch_path(spark, "songs-csv")
    write_songs_csv(songs(spark, d), path)
    return read_songs_csv(spark, path, _csv_schema())


def q_csv_by_name(spark, d):
    """Shuffled and extra columns in the file: taken by header name."""
    path = scratch_path(spark, "songs-csv")
    rows = songs(spark, d).withColumn("topic", F.lit("x, \"y\"")).withColumn("", F.col("doc_id") * 2)
    write_songs_csv(rows.select("lyrics", "", "genre", "doc_id", "release_date", "topic", "track_name", "artist_name"), path)
    return read_songs_csv(spark, path, _csv_schema())


# ------------------------------------------------------------ prepare

def q_prepare_rows(spark, d):
    return prepare_rows(songs(spark, d), keep=("doc_id",))


def q_prepare_text_rows(spark, d):
    return prepare_text_rows(songs(spark, d), keep=("doc_id",))


def q_genre_distribution(spark, d):
    return class_distribution(prepare_text_rows(songs(spark, d)), "genre")


def q_hash_split(spark, d):
    b = hash_bucket("doc_id")
    return _docs(spark, d).select(
        "doc_id", b.alias("bucket"), F.when(b < TRAIN_BUCKETS, "train").otherwise("test").alias("split")
    )


SAMPLE_ROWS = 100


def q_class_sample(spark, d):
    """The labelled rows that a bounded fit uses: of each class those of the smallest
    id hash; next to them the class's size."""
    rows = prepare_text_rows(songs(spark, d), keep=("doc_id",)).select("doc_id", "genre")
    taken = sample_per_class(rows, SAMPLE_ROWS).groupBy("genre").agg(F.count(F.lit(1)).alias("taken"), F.max(sample_hash("doc_id")).alias("_last"))
    # of the class, the rows up to the last one taken: as many as were taken
    both = rows.join(taken, "genre").groupBy("genre", "taken").agg(F.count(F.lit(1)).alias("n"), F.count_if(sample_hash("doc_id") <= F.col("_last")).alias("smallest"))
    return both.select("genre", "n", "taken", "smallest")


# ------------------------------------------------------------ features

def q_label_index(spark, d):
    return feat.label_index(prepare_text_rows(songs(spark, d)), "genre")


def q_decode_label(spark, d):
    docs = _docs(spark, d)
    idx = feat.label_index(docs.select(F.col("lang").alias("genre")), "genre")
    # The label list has one entry per class: bounded, fine to collect.
    labels = [r["genre"] for r in idx.orderBy("label").collect()]
    guess = (F.col("n_chars") % (len(labels) + 1)).cast("int")
    return docs.select(
        "doc_id", guess.alias("prediction_index"), decode_label(guess, labels_array(labels)).alias("predicted_label")
    )


def _tokens(spark, d):
    return feat.tokenize(_docs(spark, d).select("doc_id", "text"), "text", "words")


def q_term_frequencies(spark, d):
    return feat.term_stats(_tokens(spark, d), "words")


def q_frequent_terms(spark, d):
    """Statistics of the terms that a vocabulary may hold; rare ones go before the shuffle."""
    return feat.frequent_term_stats(_tokens(spark, d), feat.MIN_DF, "words")


def _vocab(spark, d):
    return feat.vocabulary(feat.term_stats(_tokens(spark, d), "words"), feat.VOCAB_SIZE, feat.MIN_DF)


def q_vocabulary(spark, d):
    return _vocab(spark, d).select("term", "tf", "df", "index")


def _idf(spark, d):
    n_docs = read_table(spark, d, "documents").select(F.count(F.lit(1))).scalar()  # metadata-only count
    return feat.idf_weights(_vocab(spark, d), n_docs)


def q_idf_weights(spark, d):
    return _idf(spark, d).select("term", "df", F.round("idf", ROUND).alias("idf"))


def q_tfidf_terms(spark, d):
    # The vocabulary holds at most VOCAB_SIZE rows: a bounded broadcast. Counts
    # are row-local, so no (document, term) pair is shuffled.
    idf = F.broadcast(_idf(spark, d).select("term", "idf"))
    return feat.exploded_counts(feat.row_term_counts(_tokens(spark, d))).join(idf, "term").select(
        "doc_id", "term", "tf", F.round(F.col("tf") * F.col("idf"), ROUND).alias("tfidf")
    )


# ---------------------------------------------------------- evaluate

def _label_pairs(spark, d):
    return read_table(spark, d, "labels").select(
        F.col("quality").cast("double").alias("label"), F.col("toxic").cast("double").alias("prediction")
    )


def q_confusion_counts(spark, d):
    return confusion_counts(_label_pairs(spark, d))


def q_classification_metrics(spark, d):
    m = classification_metrics(_label_pairs(spark, d))
    return m.select(*[F.round(c, ROUND).alias(c) for c in ("accuracy", "precision", "recall", "f1")], "n")


def q_metrics_report(spark, d):
    return metrics_report(classification_metrics(_label_pairs(spark, d)))


# ----------------------------------------------------------- model (M*, R1)
#
# A forest has no SQL twin, but what must hold for every row and every fit has:
# the twins state row by row which rows are scored, rejected, held out or equal.


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("int")


def _fitted(spark, d):
    return train_and_evaluate(songs(spark, d))


def _fit_checks(spark, result) -> DataFrame:
    metrics = result.metrics.select(F.col("n").alias("n_test"), _flag(F.col("f1") >= F1_FLOOR).alias("f1_ok"))
    forest = result.model.stages[-1]
    return metrics.select(F.lit(result.train.count()).cast("bigint").alias("n_train"), "n_test", "f1_ok", F.lit(forest.getNumTrees).alias("trees"), F.lit(forest.getMaxDepth()).alias("depth"))


def q_train_and_evaluate(spark, d):
    return _fit_checks(spark, _fitted(spark, d))


def q_train_with_year(spark, d):
    return _fit_checks(spark, train_and_evaluate(songs(spark, d), ForestSettings(use_year=True), with_year=True))


def q_model_round_trip(spark, d):
    res = _fitted(spark, d)
    loaded = load_model(save_model(res.model, scratch_path(spark, "model")))
    a = score(res.model, res.test, keep=("doc_id",)).select("doc_id", F.to_json(F.struct("predicted_label", "probabilities")).alias("before"))
    b = score(loaded, res.test, keep=("doc_id",)).select("doc_id", F.to_json(F.struct("predicted_label", "probabilities")).alias("after"))
    return a.join(b, "doc_id").select("doc_id", _flag(F.col("before") == F.col("after")).alias("equal"))


def _scored_checks(scored: DataFrame, *keys: str) -> DataFrame:
    """Per row: is there a label, do the percentages add up, is the label a most
    probable class, is the confidence that class's percentage (-1: rejected)."""
    shares = F.map_values("probabilities")
    total = F.aggregate(shares, F.lit(0.0), lambda a, x: a + x)
    own = F.try_element_at("probabilities", F.col("predicted_label"))
    check = lambda c: F.when(F.col("error").isNull(), _flag(c)).otherwise(-1)
    return scored.select(
        *keys, "error", F.col("predicted_label").isNotNull().cast("int").alias("has_label"),
        check(F.abs(total - 100.0) <= 0.006 * F.size(shares)).alias("probabilities_sum_ok"),
        check(own == F.array_max(shares)).alias("label_is_argmax"), check(own == F.col("confidence")).alias("confidence_ok"),
    )


def q_score_batch(spark, d):
    return _scored_checks(score(_fitted(spark, d).model, _docs(spark, d), text_col="text", keep=("doc_id",)), "doc_id")


def q_score_conversations(spark, d):
    """Scoring on a second text table (every conversation turn)."""
    conv = spread(read_table(spark, d, "conversations"))
    return _scored_checks(score(_fitted(spark, d).model, conv, text_col="text", keep=("conv_id", "turn")), "conv_id", "turn")


def q_score_json(spark, d):
    """The reply records, parsed again."""
    reply = score_json(score(_fitted(spark, d).model, _docs(spark, d), text_col="text", keep=("doc_id",)))
    form = "labels array<string>, data array<double>, predictedLabel string, confidence double, error string"
    p = reply.select("doc_id", F.from_json("reply", form).alias("p"))
    back = p.select("doc_id", F.col("p.error").alias("error"), F.col("p.predictedLabel").alias("predicted_label"), F.col("p.confidence").alias("confidence"),
                    F.map_from_arrays("p.labels", "p.data").alias("probabilities"))
    return _scored_checks(back, "doc_id")


def q_score_stream(spark, d):
    """Every document scored by a stream, next to its batch score."""
    model = _fitted(spark, d).model
    landing = scratch_path(spark, "landing")
    _docs(spark, d).select("doc_id", "text").write.parquet(landing)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    streamed = spark.read.parquet(run_score_stream(spark, model, landing, schema, text_col="text", max_files_per_trigger=4))
    batch = score(model, spark.read.parquet(landing), text_col="text", keep=("doc_id",))
    both = streamed.select("doc_id", F.to_json(F.struct("*")).alias("a")).join(batch.select("doc_id", F.to_json(F.struct("*")).alias("b")), "doc_id")
    return both.select("doc_id", _flag(F.col("a") == F.col("b")).alias("equal"))


def q_score_stream_split(spark, d):
    """Every document through the stream with rejects: which table it is in, why, and the
    counts that its batch reported."""
    model, landing, sink = _fitted(spark, d).model, scratch_path(spark, "landing"), scratch_path(spark, "split")
    _docs(spark, d).select("doc_id", "text").write.parquet(landing)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    start_split_stream(spark, model, landing, schema, sink, scratch_path(spark, "split-ckpt"), text_col="text", max_files_per_trigger=4).awaitTermination()
    accepted = read_split(spark, sink, "accepted", "doc_id long, predicted_label string").select("doc_id", F.lit("accepted").alias("kind"), F.lit(None).cast("string").alias("error"), _flag(F.col("predicted_label").isNotNull()).alias("has_label"), "batch")
    rejected = read_split(spark, sink, "rejected", "doc_id long, error string").select("doc_id", F.lit("rejected").alias("kind"), "error", F.lit(0).alias("has_label"), "batch")
    rows = accepted.unionByName(rejected)
    seen = rows.groupBy("batch").agg(F.count_if(F.col("kind") == "accepted").alias("_a"), F.count_if(F.col("kind") == "rejected").alias("_r"))
    equal = _flag((F.col("accepted") == F.col("_a")) & (F.col("rejected") == F.col("_r"))).alias("counts_ok")
    return rows.join(done_batches(spark, sink).join(seen, "batch").select("batch", equal), "batch").drop("batch")


def q_tune_classifier(spark, d):
    train, test = hash_split(prepare_text_rows(songs(spark, d), keep=("doc_id",)))
    model, avg = tune_classifier(train, ForestSettings(layout_parts=MERGED_LAYOUT, max_part_mb=MERGED_PART_MB), parallelism=TUNING_FITS)
    return evaluate(model, test).select(
        F.lit(len(avg)).alias("grid_points"), F.col("n").alias("n_test"), _flag(F.col("f1") >= F1_FLOOR).alias("f1_ok"),
        _flag(F.lit(max(avg)) >= F1_FLOOR).alias("cv_f1_ok"),
    )


#: Fewest parts of the tuning queries' layout (``ForestSettings.layout_parts``): about 1,500
#: rows at sf0.01, so the default of 32 parts would be tasks of 50 rows. More rows get more.
MERGED_LAYOUT = 4
#: Most MB of binned rows in a part there: twice the default, for 24 and more fits shuffle
#: node histograms, as many as there are parts.
MERGED_PART_MB = 384


def q_train_merged(spark, d):
    primary, secondary = _two_corpora(spark, d)
    out = train_merged(primary, secondary, ForestSettings(layout_parts=MERGED_LAYOUT, max_part_mb=MERGED_PART_MB), hold_out=True, parallelism=TUNING_FITS)
    best = max(out.cv_f1)
    return out.metrics.select(
        F.lit(len(out.cv_f1)).alias("grid_points"), F.lit(out.n_rows).cast("bigint").alias("n_trained"), F.col("n").alias("n_test"),
        _flag(F.col("f1") >= F1_FLOOR).alias("f1_ok"), _flag(F.lit(best) >= F1_FLOOR).alias("cv_f1_ok"),
    )


QUERIES: dict[str, Query] = {
    "clean_lyrics": q_clean_lyrics,
    "release_year": q_release_year,
    "release_year_fallback": q_release_year_fallback,
    "tokenize": q_tokenize,
    "token_order": q_token_order,
    "validate_input": q_validate_input,
    "default_year": q_default_year,
    "stringify_nulls": q_stringify_nulls,
    "percent_rounding": q_percent_rounding,
    "json_payload_fields": q_json_payload_fields,
    "request_text": q_request_text,
    "collect_filter": q_collect_filter,
    "exclude_titles": q_exclude_titles,
    "job_counts": q_job_counts,
    "filter_record_kind": q_filter_record_kind,
    "tag_constant_label": q_tag_constant_label,
    "unmatched_records": q_unmatched_records,
    "matched_records": q_matched_records,
    "search_hits": q_search_hits,
    "top_songs_per_artist": q_top_songs_per_artist,
    "dedup_songs": q_dedup_songs,
    "append_corpus": q_append_corpus,
    "cap_at_target": q_cap_at_target,
    "songs_per_artist": q_songs_per_artist,
    "corpus_totals": q_corpus_totals,
    "merge_corpora": q_merge_corpora,
    "build_corpus": q_build_corpus,
    "artist_list_corpus": q_artist_list_corpus,
    "hit_corpus": q_hit_corpus,
    "corpus_report": q_corpus_report,
    "landed_variants": q_landed_variants,
    "payload_corpus": q_payload_corpus,
    "csv_round_trip": q_csv_round_trip,
    "csv_by_name": q_csv_by_name,
    "prepare_rows": q_prepare_rows,
    "prepare_text_rows": q_prepare_text_rows,
    "genre_distribution": q_genre_distribution,
    "hash_split": q_hash_split,
    "class_sample": q_class_sample,
    "label_index": q_label_index,
    "decode_label": q_decode_label,
    "term_frequencies": q_term_frequencies,
    "frequent_terms": q_frequent_terms,
    "vocabulary": q_vocabulary,
    "idf_weights": q_idf_weights,
    "tfidf_terms": q_tfidf_terms,
    "confusion_counts": q_confusion_counts,
    "classification_metrics": q_classification_metrics,
    "metrics_report": q_metrics_report,
    # models: the twins state what holds for every row
    "train_and_evaluate": q_train_and_evaluate,
    "train_with_year": q_train_with_year,
    "model_round_trip": q_model_round_trip,
    "score_batch": q_score_batch,
    "score_json": q_score_json,
    "score_conversations": q_score_conversations,
    "score_stream": q_score_stream,
    "score_stream_split": q_score_stream_split,
    "tune_classifier": q_tune_classifier,
    "train_merged": q_train_merged,
}
