"""Text functions on the edge rows of FIXTURES.md, with expected values worked
out by hand from the reference's rules (Python ``re`` / ``str``)."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verso.functions import text as tx


def _python_clean(s):
    # Python semantics of the fixed values, as the property-test oracle.
    s = (s or "").replace(tx.SITE_ARTIFACT, "")
    s = re.sub(tx.BRACKET_PATTERN, "", s)
    return re.sub(tx.WHITESPACE_PATTERN, " ", s).strip()


def _one_col(spark, values, typ=T.StringType()):
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", typ)])
    return spark.createDataFrame(list(enumerate(values)), schema)


def _apply(spark, values, fn, typ=T.StringType()):
    rows = _one_col(spark, values, typ).select("i", fn(F.col("v")).alias("o")).collect()
    return [r["o"] for r in sorted(rows, key=lambda r: r["i"])]


CASES = [
    (None, ""),
    ("", ""),
    ("  hello  world  ", "hello world"),
    ("a\tb\nc", "a b c"),
    ("x [a\nb] y [c] z", "x [a b] y z"),
    ("[Chorus]\nla la\n[Verse 1]\nna", "la la na"),
    ("word EmbedShare URLCopyEmbedCopy", "word"),
    ("no break em　ideo", "no break em ideo"),
    ("line sep\u0085nel", "line sep nel"),
    ("info\x1cseps\x1f", "info seps"),
    ("a [b\rc] d", "a d"),
    ("[unclosed text", "[unclosed text"),
    ("​zero width stays", "​zero width stays"),
]


def test_clean_lyrics_edge_rows(spark):
    got = _apply(spark, [c[0] for c in CASES], tx.clean_lyrics)
    assert got == [c[1] for c in CASES]
    assert got == [_python_clean(c[0]) for c in CASES]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab [ ]\n\t  x\x1dé")), max_size=30), min_size=1, max_size=8))
def test_clean_lyrics_matches_python(spark, values):
    assert _apply(spark, values, tx.clean_lyrics) == [_python_clean(v) for v in values]


def test_clean_output_properties(spark):
    out = _apply(spark, [c[0] for c in CASES], tx.clean_lyrics)
    for s in out:
        assert "\t" not in s and "\n" not in s and "  " not in s
        assert s == s.strip(" ")


def test_first_year_and_fallback(spark):
    vals = ["1999-05-01", "released 2003", "n/a", "", None, "12345", "99"]
    assert _apply(spark, vals, tx.first_year) == ["1999", "2003", None, None, None, "1234", None]
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    df = spark.createDataFrame([("2001-01-01", "1990"), (None, "1990-02-02"), ("", "x"), (None, None)], schema)
    got = [r[0] for r in df.select(tx.year_with_fallback("a", "b")).collect()]
    assert got == ["2001", "1990", None, None]


def test_three_length_limits(spark):
    vals = [None, "", "123456789", "1234567890", "12345678901"]
    assert _apply(spark, vals, lambda c: tx.has_min_chars(c, 10)) == [False, False, False, True, True]
    assert _apply(spark, vals, lambda c: tx.has_min_chars(c, 10, strict=True)) == [False, False, False, False, True]
    assert _apply(spark, vals, tx.reject_reason) == [tx.REJECT_MESSAGE] * 3 + [None, None]


def test_length_counts_code_points(spark):
    assert _apply(spark, ["é" * 10, "😀" * 3], tx.char_length) == [10, 3]


def test_default_year(spark):
    assert _apply(spark, [None, 0, 1999], tx.default_year, T.IntegerType()) == [2000, 2000, 1999]


def test_to_text_or_empty(spark):
    assert _apply(spark, [None, 5], tx.to_text_or_empty, T.IntegerType()) == ["", "5"]


def test_json_field_default(spark):
    vals = ['{"lyrics": "la la"}', '{"other": 1}', "not json", None]
    assert _apply(spark, vals, lambda c: tx.json_field(c, "$.lyrics")) == ["la la", "", "", ""]


def test_title_pattern_groups_brackets():
    pat = re.compile(tx.title_exclusion_pattern().replace("(?i)", ""), re.IGNORECASE)
    assert pat.search("Song (REMIX)")
    assert pat.search("alive")  # brackets group, so the bare word matches
    assert not pat.search("Plain Song")
    lit = re.compile(tx.title_exclusion_pattern(literal=True).replace("(?i)", ""), re.IGNORECASE)
    assert lit.search("Song (Live)") and not lit.search("alive")


def test_request_text_json_or_form(spark):
    rows = [(True, '{"lyrics": "from json"}', "form"), (True, '{"x": 1}', "form"), (False, None, "from form"),
            (False, '{"lyrics": "ignored"}', None)]
    df = spark.createDataFrame(rows, "j boolean, body string, form string")
    got = [r[0] for r in df.select(tx.request_text("j", "body", "form")).collect()]
    assert got == ["from json", "", "from form", ""]
