"""DuckDB twins of the registered queries (same column names and types).

Regex notes: Spark runs Java regexes, DuckDB runs RE2. Cleaning uses
``\\[[^\\n]*?\\]`` for Java's ``(?d)\\[.*?\\]`` and the class
``[\\s\\v\\x1c-\\x1f\\x{85}\\p{Z}]`` for Java's ``(?U)[\\s\\x1c-\\x1f]``.
Tokens split on single ASCII white-space characters in both.
"""

from __future__ import annotations

_YEAR = r"nullif(regexp_extract({c}, '(\d{{4}})', 1), '')"


def _year(c: str) -> str:
    return _YEAR.format(c=c)


_CLEAN = (
    "trim(regexp_replace(regexp_replace(replace(coalesce({c}, ''), 'EmbedShare URLCopyEmbedCopy', ''), "
    r"'\[[^\n]*?\]', '', 'g'), '[\s\v\x1c-\x1f\x{{85}}\p{{Z}}]+', ' ', 'g'))"
)


def _clean(c: str) -> str:
    return _CLEAN.format(c=c)


_PAGE_YEARS = f"""page_years AS (
  SELECT page_id AS detail_id, min({_year('html')}) AS detail_year
  FROM pages WHERE {_year('html')} IS NOT NULL GROUP BY page_id)"""

_SONG_DATE = ("(CASE WHEN doc_id % 11 <> 0 THEN (CASE WHEN doc_id % 13 = 0 THEN '0000' "
              "ELSE CAST(doc_id % 73 + 1950 AS VARCHAR) END) || '-06-15' END)")

_SONGS = f"""songs AS (
  SELECT doc_id, source AS artist_name, text AS track_name,
         TRY_CAST({_year(_SONG_DATE)} AS INTEGER) AS release_date, lang AS genre, text AS lyrics
  FROM documents)"""

# The song's date is its text; none or year 0000 for some ids.
_OWN_DATE = "(CASE WHEN doc_id % 13 = 0 THEN '0000-06-15' WHEN doc_id % 11 <> 0 THEN text END)"

_SONG_YEARS = f"""{_PAGE_YEARS},
song_years AS (
  SELECT d.doc_id, TRY_CAST(coalesce({_year(_OWN_DATE)}, py.detail_year) AS INTEGER) AS release_date
  FROM documents d LEFT JOIN page_years py ON d.doc_id = py.detail_id)"""

_PREPARED_TEXT = f"""{_SONGS},
prepared AS (SELECT doc_id, genre, lyrics FROM songs
             WHERE length(lyrics) > 10 AND genre IS NOT NULL AND lyrics IS NOT NULL)"""

_PREPARED = f"""{_SONGS},
prepared AS (SELECT doc_id, artist_name, track_name, release_date, genre, lyrics FROM songs
             WHERE length(lyrics) > 10 AND artist_name IS NOT NULL AND track_name IS NOT NULL
               AND release_date IS NOT NULL AND genre IS NOT NULL)"""

# The look-up table: two thirds of the songs, one in five of them twice.
_HITS = """hits AS (
  SELECT doc_id * 10 + copy AS hit_id, source AS artist_name, text AS track_name, 'hit ' || text AS lyrics
  FROM documents, (SELECT 1 AS copy UNION ALL SELECT 2) WHERE doc_id % 3 <> 0 AND (copy = 1 OR doc_id % 5 = 0)),
best AS (SELECT artist_name, track_name, min(hit_id) AS hit_id FROM hits GROUP BY ALL)"""

_TURNS = """turns AS (SELECT -1 - conv_id * 1000 - turn AS doc_id, role AS genre, text AS lyrics FROM conversations
             WHERE length(text) > 10 AND role IS NOT NULL)"""

_BUCKET = "CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % 10 AS INTEGER)"

_DEDUP = f"""{_SONGS},
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY artist_name, track_name ORDER BY doc_id) AS rn FROM songs)
  WHERE rn = 1)"""

_CAPPED = f"""{_DEDUP},
per_artist AS (SELECT artist_name, count(*) AS n FROM dedup GROUP BY artist_name),
kept AS (
  SELECT artist_name FROM (
    SELECT artist_name, coalesce(sum(n) OVER (ORDER BY artist_name NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior
    FROM per_artist)
  WHERE prior < 100),
capped AS (SELECT d.* FROM dedup d JOIN kept k ON d.artist_name IS NOT DISTINCT FROM k.artist_name)"""

_TOKENS = r"""tokens AS (
  SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[ \t\n\x0b\f\r]')) AS term FROM documents)"""

_STATS = f"""{_TOKENS},
stats AS (SELECT term, count(*)::BIGINT AS tf, count(DISTINCT doc_id)::BIGINT AS df FROM tokens GROUP BY term)"""

_VOCAB = f"""{_STATS},
vocab AS (
  SELECT term, tf, df, CAST(row_number() OVER (ORDER BY tf DESC, term) - 1 AS INTEGER) AS index
  FROM (SELECT * FROM stats WHERE df >= 5 ORDER BY tf DESC, term LIMIT 10000))"""

_IDF = f"""{_VOCAB},
idf AS (SELECT term, df, ln(((SELECT count(*) FROM documents) + 1.0) / (df + 1.0)) AS idf FROM vocab)"""

_METRICS = """pairs AS (SELECT CAST(quality AS DOUBLE) AS label, CAST(toxic AS DOUBLE) AS prediction FROM labels),
cc AS (SELECT label, prediction, count(*) AS n FROM pairs GROUP BY ALL),
actual AS (SELECT label, sum(n) AS actual, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp FROM cc GROUP BY label),
predicted AS (SELECT prediction AS label, sum(n) AS predicted FROM cc GROUP BY prediction),
pc AS (
  SELECT a.label, a.actual, a.tp,
         CASE WHEN coalesce(p.predicted, 0) > 0 THEN a.tp / p.predicted ELSE 0.0 END AS precision,
         CASE WHEN a.actual > 0 THEN a.tp / a.actual ELSE 0.0 END AS recall
  FROM actual a LEFT JOIN predicted p ON a.label = p.label),
pcf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM pc)"""

# C1, written from the collector's loop: an artist's records, most popular first,
# at most ten; each is looked up (maybe), skipped when its lyrics are short; a title
# that the artist already has is skipped; artists are taken in order until the total
# reaches the target. {artists}: the order (rank), {source}: title and lyrics.
_BUILD_TEMPLATE = """{page_years},
recs AS (
  SELECT doc_id, source AS artist_name, text AS track_name, n_chars AS popularity, lang AS genre, {rank} AS artist_rank
  FROM documents
  WHERE {rank} IS NOT NULL
    AND NOT coalesce(regexp_matches(text, '(?i)((Remix))|((Live))|((Cover))|(Instrumental)'), false)),
top AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY artist_name ORDER BY popularity DESC, doc_id) AS rk FROM recs)
  WHERE rk <= 10),
looked_up AS ({look_up}),
processed AS (SELECT * FROM looked_up WHERE coalesce(length(lyrics), 0) >= 10),
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY artist_name, track_name ORDER BY rk) AS rn FROM processed)
  WHERE rn = 1),
per_artist AS (SELECT artist_name, min(artist_rank) AS artist_rank, count(*) AS n FROM dedup GROUP BY artist_name),
kept AS (
  SELECT artist_name FROM (
    SELECT artist_name, coalesce(sum(n) OVER (ORDER BY artist_rank NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior
    FROM per_artist)
  WHERE prior < {target}),
corpus AS (
  SELECT d.doc_id, d.artist_name, d.track_name, TRY_CAST(coalesce({song_year}, py.detail_year) AS INTEGER) AS release_date,
         {genre} AS genre, {clean} AS lyrics
  FROM dedup d JOIN kept k ON d.artist_name IS NOT DISTINCT FROM k.artist_name
  LEFT JOIN page_years py ON d.detail_id = py.detail_id)"""

_OWN = "SELECT t.*, t.doc_id AS detail_id, t.track_name AS lyrics FROM top t"
_BY_NAME = "coalesce(source, '')"


def _build(**changes: str) -> str:
    base = {"page_years": _PAGE_YEARS, "rank": _BY_NAME, "look_up": _OWN, "target": "100", "genre": "d.genre",
            "song_year": _year("d.track_name"), "clean": _clean("d.lyrics")}
    return _BUILD_TEMPLATE.format(**{**base, **changes})


_BUILD = _build()
# Payload path: the album date is the whole page html of the same id, and
# every record carries the run's constant label.
_BUILD_PAYLOAD = _build(genre="'K-Pop'")
_ARTISTS = "['src7', 'src0', 'nobody', 'src13', 'src2', 'src19', 'src4', 'src11']"
_BUILD_ARTISTS = _build(rank=f"nullif(list_position({_ARTISTS}, source), 0)", target="40")
# No detail records are given here: the page years do not count.
_BUILD_HITS = _build(
    page_years=f"page_years AS (SELECT 0 AS detail_id, NULL AS detail_year WHERE false), {_HITS}",
    look_up="SELECT t.*, h.hit_id AS detail_id, h.lyrics FROM top t JOIN best b ON t.artist_name = b.artist_name AND t.track_name = b.track_name "
    "JOIN hits h ON h.hit_id = b.hit_id",
)

_ERROR = "CASE WHEN coalesce(length(text), 0) < 10 THEN 'Please provide lyrics with at least 10 characters' END"
_CHECKED = (
    "CAST(error IS NULL AS INTEGER) AS has_label, CASE WHEN error IS NULL THEN 1 ELSE -1 END AS probabilities_sum_ok, "
    "CASE WHEN error IS NULL THEN 1 ELSE -1 END AS label_is_argmax, CASE WHEN error IS NULL THEN 1 ELSE -1 END AS confidence_ok"
)
_SCORED = f"SELECT doc_id, error, {_CHECKED} FROM (SELECT doc_id, {_ERROR} AS error FROM documents)"
_SPLIT = (f"CAST(count(*) FILTER ({_BUCKET} < 8) AS BIGINT) AS n_train, CAST(count(*) FILTER ({_BUCKET} >= 8) AS BIGINT) AS n_test, "
          "1 AS f1_ok, 100 AS trees, 10 AS depth")


ORACLE_SQL: dict[str, str] = {
    "clean_lyrics": (
        "SELECT doc_id, " + _clean("(CASE WHEN doc_id % 3 = 0 THEN '[Verse 1]' || text || ' [a' || chr(10) || '[b] EmbedShare URLCopyEmbedCopy' ELSE text END)")
        + " AS lyrics FROM documents"
    ),
    "release_year": f"SELECT doc_id, {_year('text')} AS release_year FROM documents",
    "release_year_fallback": f"WITH {_SONG_YEARS} SELECT doc_id, release_date AS release_year FROM song_years",
    "tokenize": f"WITH {_TOKENS} SELECT doc_id, term, count(*)::BIGINT AS n FROM tokens GROUP BY doc_id, term",
    "token_order": (
        "SELECT doc_id, CAST(i - 1 AS INTEGER) AS position, words[i] AS term FROM ("
        "SELECT doc_id, words, unnest(generate_series(1, n)) AS i FROM ("
        "SELECT doc_id, words, coalesce(list_max(list_filter(generate_series(1, len(words)), lambda k: words[k] <> '')), CASE WHEN text = '' THEN 1 ELSE 0 END) AS n FROM ("
        r"SELECT doc_id, text, regexp_split_to_array(lower(text), '[ \t\n\x0b\f\r]') AS words FROM documents)))"
    ),
    "validate_input": (
        "SELECT doc_id, CASE WHEN coalesce(length(text), 0) < 10 "
        "THEN 'Please provide lyrics with at least 10 characters' END AS error FROM documents"
    ),
    "default_year": f"WITH {_SONG_YEARS} SELECT doc_id, coalesce(nullif(release_date, 0), 2000) AS release_date FROM song_years",
    "stringify_nulls": (
        f"WITH {_SONGS} SELECT doc_id, coalesce(CAST(artist_name AS VARCHAR), '') AS artist_name, "
        "coalesce(CAST(track_name AS VARCHAR), '') AS track_name, "
        "coalesce(CAST(release_date AS VARCHAR), '') AS release_date, "
        "coalesce(CAST(genre AS VARCHAR), '') AS genre, coalesce(CAST(lyrics AS VARCHAR), '') AS lyrics FROM songs"
    ),
    # Python's rule: the nearest hundredth by the binary value, ties to even. Scaled by
    # 2^60 the double is a whole number, so the comparison with the half is exact.
    "percent_rounding": (
        "SELECT l_orderkey, l_linenumber, CAST(CASE WHEN 2 * rest > unit OR (2 * rest = unit AND k % 2 = 1) THEN k + 1 ELSE k END AS DOUBLE) / 100.0 AS pct FROM ("
        "SELECT l_orderkey, l_linenumber, CAST(1152921504606846976 AS HUGEINT) AS unit, CAST(v * 1152921504606846976.0 AS HUGEINT) * 100 // 1152921504606846976 AS k, "
        "CAST(v * 1152921504606846976.0 AS HUGEINT) * 100 % 1152921504606846976 AS rest FROM ("
        "SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DOUBLE) / 100000.0 * 100.0 AS v FROM lineitem))"
    ),
    "json_payload_fields": (
        "SELECT d.doc_id, coalesce(d.source, '') AS artist_field, coalesce(d.source, '') AS artist_name, "
        f"coalesce({_year('d.text')}, {_year('p.html')}, '') AS release_year, '' AS missing_field "
        "FROM documents d LEFT JOIN pages p ON d.doc_id = p.page_id"
    ),
    "request_text": (
        "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE coalesce(text, '') END AS lyrics FROM documents"
    ),
    "collect_filter": (
        f"WITH {_SONGS} SELECT doc_id, artist_name, track_name FROM songs "
        "WHERE coalesce(length(lyrics), 0) >= 10"
    ),
    "exclude_titles": (
        "WITH titled AS (SELECT doc_id, text || [' (Remix)', ' live version', ' Cov.er', ' INSTRUMENTAL', ''][doc_id % 5 + 1] AS track_name FROM documents) "
        "SELECT doc_id, track_name FROM titled WHERE NOT coalesce("
        "regexp_matches(track_name, '(?i)((Remix))|((Live))|((Cover))|(Instrumental)'), false)"
    ),
    "job_counts": (
        "WITH r AS (SELECT doc_id, source, lang, n_chars AS popularity, text, text || CASE WHEN doc_id % 5 = 0 THEN ' (Remix)' ELSE '' END AS title, "
        "CASE WHEN doc_id % 7 <> 0 THEN text END AS lyrics FROM documents), "
        "f AS (SELECT *, coalesce(regexp_matches(title, '(?i)((Remix))|((Live))|((Cover))|(Instrumental)'), false) AS excluded, "
        f"coalesce(length(lyrics), 0) AS n_chars, TRY_CAST({_year(_SONG_DATE)} AS INTEGER) AS release_date, TRY_CAST({_year('text')} AS INTEGER) AS text_year FROM r), "
        "kept AS (SELECT source, title, arg_min(text_year IS NULL, (-popularity, doc_id)) AS undated FROM f WHERE NOT excluded AND n_chars >= 10 GROUP BY ALL), "
        "p AS (SELECT doc_id, n_chars > 10 AS long, n_chars > 10 AND source IS NOT NULL AND text IS NOT NULL AND release_date IS NOT NULL AND lang IS NOT NULL AS prepared FROM f) "
        "SELECT 'records.read' AS step, count(*)::BIGINT AS n FROM f "
        "UNION ALL SELECT 'records.excluded', count(*) FROM f WHERE excluded "
        "UNION ALL SELECT 'records.too_short', count(*) FROM f WHERE NOT excluded AND n_chars < 10 "
        "UNION ALL SELECT 'corpus.written', count(*) FROM kept "
        "UNION ALL SELECT 'corpus.without_year', count(*) FROM kept WHERE undated "
        "UNION ALL SELECT 'initial.read', count(*) FROM p "
        "UNION ALL SELECT 'initial.too_short', count(*) FROM p WHERE NOT long "
        "UNION ALL SELECT 'initial.incomplete', count(*) FROM p WHERE long AND NOT prepared "
        "UNION ALL SELECT 'initial.prepared', count(*) FROM p WHERE prepared "
        f"UNION ALL SELECT 'split.train', count(*) FROM p WHERE prepared AND {_BUCKET} < 8 "
        f"UNION ALL SELECT 'split.test', count(*) FROM p WHERE prepared AND {_BUCKET} >= 8"
    ),
    "filter_record_kind": "SELECT conv_id, turn, text FROM conversations WHERE role IN ('user')",
    "tag_constant_label": (
        f"WITH {_SONGS} SELECT doc_id, artist_name, track_name, release_date, 'K-Pop' AS genre, lyrics FROM songs"
    ),
    "unmatched_records": (
        f"WITH {_HITS} SELECT doc_id, source AS artist_name, sha256(text) AS title_key FROM documents d "
        "WHERE NOT EXISTS (SELECT 1 FROM hits h WHERE h.artist_name = d.source AND h.track_name = d.text)"
    ),
    "matched_records": (
        f"WITH {_HITS} SELECT doc_id, source AS artist_name, sha256(text) AS title_key FROM documents d "
        "WHERE EXISTS (SELECT 1 FROM hits h WHERE h.artist_name = d.source AND h.track_name = d.text)"
    ),
    "search_hits": (
        f"WITH {_HITS} SELECT d.doc_id, b.hit_id FROM documents d JOIN best b ON b.artist_name = d.source AND b.track_name = d.text"
    ),
    "top_songs_per_artist": (
        "SELECT * FROM (SELECT source, doc_id, n_chars, CAST(row_number() OVER "
        "(PARTITION BY source ORDER BY n_chars DESC, doc_id) AS INTEGER) AS rank FROM documents) WHERE rank <= 10"
    ),
    "dedup_songs": f"WITH {_DEDUP} SELECT doc_id, artist_name, sha256(track_name) AS title_key FROM dedup",
    "append_corpus": (
        "SELECT doc_id, source AS artist_name, sha256(text) AS title_key, run FROM (SELECT *, CAST(doc_id & 1 AS BIGINT) AS run, "
        "row_number() OVER (PARTITION BY source, text ORDER BY doc_id & 1, doc_id) AS rn FROM documents) WHERE rn = 1"
    ),
    "cap_at_target": f"WITH {_CAPPED} SELECT doc_id, artist_name, sha256(track_name) AS title_key FROM capped",
    "songs_per_artist": f"WITH {_CAPPED} SELECT artist_name, count(*)::BIGINT AS songs FROM capped GROUP BY artist_name",
    "corpus_totals": (
        f"WITH {_CAPPED} SELECT count(*)::BIGINT AS records, count(DISTINCT artist_name)::BIGINT AS groups FROM capped"
    ),
    "merge_corpora": f"WITH {_PREPARED_TEXT}, {_TURNS} SELECT doc_id, genre, lyrics FROM prepared UNION ALL SELECT doc_id, genre, lyrics FROM turns",
    "build_corpus": f"WITH {_BUILD} SELECT * FROM corpus",
    "corpus_report": f"WITH {_BUILD} SELECT artist_name, count(*)::BIGINT AS songs FROM corpus GROUP BY artist_name",
    "landed_variants": (
        "SELECT doc_id, CASE WHEN k = 0 THEN source END AS artist_name, CASE WHEN k = 0 THEN doc_id END AS song_id, CASE WHEN k < 2 THEN sha256(text) END AS lyrics_key, "
        "CASE WHEN k = 1 THEN lang END AS about_lang, CASE WHEN k > 1 THEN ['wrong type: song.id', 'empty', 'not an object', 'malformed'][k - 1] END AS reason "
        "FROM (SELECT *, doc_id % 6 AS k FROM documents)"
    ),
    "payload_corpus": f"WITH {_BUILD_PAYLOAD} SELECT * FROM corpus",
    "artist_list_corpus": f"WITH {_BUILD_ARTISTS} SELECT * FROM corpus",
    "hit_corpus": f"WITH {_BUILD_HITS} SELECT * FROM corpus",
    "csv_round_trip": (
        f"WITH {_SONGS} SELECT doc_id, nullif(artist_name, '') AS artist_name, nullif(track_name, '') AS track_name, "
        "release_date, nullif(genre, '') AS genre, nullif(lyrics, '') AS lyrics FROM songs"
    ),
    "csv_by_name": (
        f"WITH {_SONGS} SELECT doc_id, nullif(artist_name, '') AS artist_name, nullif(track_name, '') AS track_name, "
        "release_date, nullif(genre, '') AS genre, nullif(lyrics, '') AS lyrics FROM songs"
    ),
    "prepare_rows": f"WITH {_PREPARED} SELECT * FROM prepared",
    "prepare_text_rows": f"WITH {_PREPARED_TEXT} SELECT doc_id, genre, lyrics FROM prepared",
    "genre_distribution": f"WITH {_PREPARED_TEXT} SELECT genre, count(*)::BIGINT AS n FROM prepared GROUP BY genre",
    "hash_split": (
        "SELECT doc_id, CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % 10 AS INTEGER) AS bucket, "
        "CASE WHEN ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % 10 < 8 "
        "THEN 'train' ELSE 'test' END AS split FROM documents"
    ),
    "class_sample": (
        f"WITH {_PREPARED_TEXT} SELECT genre, count(*)::BIGINT AS n, least(count(*), 100)::BIGINT AS taken, least(count(*), 100)::BIGINT AS smallest "
        "FROM prepared GROUP BY genre"
    ),
    "label_index": (
        f"WITH {_PREPARED_TEXT} SELECT genre, n, CAST(row_number() OVER (ORDER BY n DESC, genre) - 1 AS DOUBLE) AS label "
        "FROM (SELECT genre, count(*)::BIGINT AS n FROM prepared WHERE genre IS NOT NULL GROUP BY genre)"
    ),
    "decode_label": (
        "WITH idx AS (SELECT genre, row_number() OVER (ORDER BY n DESC, genre) - 1 AS label FROM "
        "(SELECT lang AS genre, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang)) "
        "SELECT d.doc_id, CAST(d.n_chars % ((SELECT count(*) FROM idx) + 1) AS INTEGER) AS prediction_index, "
        "coalesce(i.genre, 'Unknown') AS predicted_label FROM documents d "
        "LEFT JOIN idx i ON i.label = d.n_chars % ((SELECT count(*) FROM idx) + 1)"
    ),
    "term_frequencies": f"WITH {_STATS} SELECT term, tf, df FROM stats",
    "frequent_terms": f"WITH {_STATS} SELECT term, tf, df FROM stats WHERE df >= 5",
    "vocabulary": f"WITH {_VOCAB} SELECT term, tf, df, index FROM vocab",
    "idf_weights": f"WITH {_IDF} SELECT term, df, round(idf, 6) AS idf FROM idf",
    "tfidf_terms": (
        f"WITH {_IDF}, dtc AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM tokens GROUP BY doc_id, term) "
        "SELECT dtc.doc_id, dtc.term, dtc.tf, round(dtc.tf * idf.idf, 6) AS tfidf FROM dtc JOIN idf ON dtc.term = idf.term"
    ),
    "confusion_counts": f"WITH {_METRICS} SELECT label, prediction, n::BIGINT AS n FROM cc",
    "classification_metrics": (
        f"WITH {_METRICS} SELECT round(sum(tp) / sum(actual), 6) AS accuracy, "
        "round(sum(precision * actual) / sum(actual), 6) AS precision, "
        "round(sum(recall * actual) / sum(actual), 6) AS recall, "
        "round(sum(f1 * actual) / sum(actual), 6) AS f1, sum(actual)::BIGINT AS n FROM pcf"
    ),
    "metrics_report": (
        f"WITH {_METRICS}, m AS (SELECT sum(tp) / sum(actual) AS accuracy, sum(precision * actual) / sum(actual) AS precision, "
        "sum(recall * actual) / sum(actual) AS recall, sum(f1 * actual) / sum(actual) AS f1 FROM pcf) "
        "SELECT 'Accuracy' AS metric, round(accuracy, 4) AS value FROM m UNION ALL "
        "SELECT 'Precision', round(precision, 4) FROM m UNION ALL SELECT 'Recall', round(recall, 4) FROM m "
        "UNION ALL SELECT 'F1', round(f1, 4) FROM m"
    ),
    # Models: what must hold for every row.
    "train_and_evaluate": f"WITH {_PREPARED_TEXT} SELECT {_SPLIT} FROM prepared",
    "train_with_year": f"WITH {_PREPARED} SELECT {_SPLIT} FROM prepared",
    "model_round_trip": f"WITH {_PREPARED_TEXT} SELECT doc_id, 1 AS equal FROM prepared WHERE {_BUCKET} >= 8",
    "score_batch": _SCORED,
    "score_json": _SCORED,
    "score_conversations": f"SELECT conv_id, turn, error, {_CHECKED} FROM (SELECT conv_id, turn, {_ERROR} AS error FROM conversations)",
    "score_stream": "SELECT doc_id, 1 AS equal FROM documents",
    "score_stream_split": (
        f"SELECT doc_id, CASE WHEN error IS NULL THEN 'accepted' ELSE 'rejected' END AS kind, error, CAST(error IS NULL AS INTEGER) AS has_label, 1 AS counts_ok "
        f"FROM (SELECT doc_id, {_ERROR} AS error FROM documents)"
    ),
    "tune_classifier": (
        f"WITH {_PREPARED_TEXT} SELECT 8 AS grid_points, CAST(count(*) AS BIGINT) AS n_test, 1 AS f1_ok, 1 AS cv_f1_ok FROM prepared WHERE {_BUCKET} >= 8"
    ),
    "train_merged": (
        f"WITH {_PREPARED_TEXT}, {_TURNS}, merged AS (SELECT doc_id FROM prepared UNION ALL SELECT doc_id FROM turns) "
        f"SELECT 8 AS grid_points, CAST(count(*) AS BIGINT) AS n_trained, CAST(count(*) FILTER ({_BUCKET} >= 8) AS BIGINT) AS n_test, 1 AS f1_ok, 1 AS cv_f1_ok FROM merged"
    ),
}
