"""Column expressions for text cleaning, years, lengths and tokens.

All of these are native Spark expressions (no Python UDF), so they run in
generated code next to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for right results.
SITE_ARTIFACT = "EmbedShare URLCopyEmbedCopy"
BRACKET_PATTERN = r"\[.*?\]"
WHITESPACE_PATTERN = r"\s+"
YEAR_PATTERN = r"(\d{4})"
REJECT_MESSAGE = "Please provide lyrics with at least 10 characters"
RAW_MIN_CHARS = 10  # collection: skip when shorter than this
TRAIN_MIN_CHARS = 10  # training: keep when strictly longer than this
SCORE_MIN_CHARS = 10  # scoring: reject when shorter than this
DEFAULT_YEAR = 2000
DEFAULT_GENRE = "K-Pop"
EXCLUDED_TITLE_TERMS = ["(Remix)", "(Live)", "(Cover)", "Instrumental"]

# The two patterns above are Python regexes; the Java forms that match the
# same text: (?d) makes only "\n" a line end, as Python's "." does (Java
# would also stop at \r, U+0085, U+2028, U+2029); Python's Unicode "\s" is
# Java's Unicode white space plus the separators U+001C..U+001F.
_BRACKETS = "(?d)" + BRACKET_PATTERN
_WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_lyrics(c: Column | str) -> Column:
    """T1-T6 in the reference's order: null/empty -> "", drop the site
    artifact, drop [..] on one line, fold every white-space run (newline and
    tab included) to one blank, strip both ends."""
    text = F.coalesce(_col(c), F.lit(""))
    text = F.replace(text, F.lit(SITE_ARTIFACT), F.lit(""))
    text = F.regexp_replace(text, _BRACKETS, "")
    text = F.regexp_replace(text, _WHITESPACE_RUN, " ")
    # Only single blanks can be left at the ends now, so trim (blanks only)
    # equals Python's strip() here.
    return F.trim(text)


def first_year(c: Column | str) -> Column:
    """T7 (one source): first run of four digits, else null."""
    return F.nullif(F.regexp_extract(_col(c), YEAR_PATTERN, 1), F.lit(""))


def year_with_fallback(primary: Column | str, fallback: Column | str) -> Column:
    """Year from the song date, else from the album date, else null."""
    return F.coalesce(first_year(primary), first_year(fallback))


def char_length(c: Column | str) -> Column:
    """Length in code points (as Python's len)."""
    return F.length(_col(c))


def has_min_chars(c: Column | str, n: int, strict: bool = False) -> Column:
    """Length test that is false (not null) for a null text."""
    length = F.coalesce(char_length(c), F.lit(0))
    return length > n if strict else length >= n


def song_key(artist: Column | str, title: Column | str) -> Column:
    """The reference's joined ``artist|title`` key. Kept for reports
    only; dedup groups on the two columns so ("a|b","c") and ("a","b|c")
    stay apart."""
    return F.concat_ws("|", _col(artist), _col(title))


def default_year(c: Column | str, default: int = DEFAULT_YEAR) -> Column:
    """Missing or zero year -> default (Python ``year or 2000``)."""
    return F.coalesce(F.nullif(_col(c), F.lit(0)), F.lit(default))


def to_text_or_empty(c: Column | str) -> Column:
    """Value as string, null -> ""."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def json_field(json_text: Column | str, path: str, default: str | None = "") -> Column:
    """P10: one field out of a JSON text; missing or malformed -> default."""
    value = F.get_json_object(_col(json_text), path)
    return value if default is None else F.coalesce(value, F.lit(default))


def request_text(is_json: Column | str, json_body: Column | str, form_value: Column | str,
                 path: str = "$.lyrics") -> Column:
    """P10: the text field of a request: from the JSON body when the request
    is JSON, else from the form field; missing -> ""."""
    from_json_body = json_field(json_body, path, "")
    from_form = F.coalesce(_col(form_value), F.lit(""))
    return F.when(_col(is_json), from_json_body).otherwise(from_form)


def reject_reason(c: Column | str, min_chars: int = SCORE_MIN_CHARS) -> Column:
    """Error text for null, empty or too-short input, else null."""
    return F.when(~has_min_chars(c, min_chars), F.lit(REJECT_MESSAGE))


def title_exclusion_pattern(terms=None, literal: bool = False) -> str:
    """Case-insensitive pattern of the excluded title terms.

    By default each term acts as a regular expression, so the brackets in
    "(Remix)" group and do not match themselves; ``literal=True`` quotes
    the terms instead.
    """
    import re

    terms = EXCLUDED_TITLE_TERMS if terms is None else list(terms)
    parts = [re.escape(t) if literal else f"({t})" for t in terms]
    return "(?i)" + "|".join(parts)
