"""Payloads of any shape (S7, T11): records with unknown keys kept, the rest with a reason.

``payload_records`` reads the declared keys and leaves nulls for all else. Here a payload is
parsed once as ``VARIANT``, so nothing is lost: what is no JSON, no object, or has a
declared key of another type becomes a rejected row with the reason and the payload as
it came; every other payload gives a record, and the keys that no field declares are kept as
JSON. Row-local, no shuffle.

Field rules, for the paths of ``FIELDS``: a missing key or a JSON null is null at any level.
A value of the declared type is taken; a number where a text is declared (or the other way
round), an object or a list is the reason ``wrong type: PATH``, the first in the order of
``FIELDS``. A level above a field that is no object is reported as that level.

Cases: a null payload is ``empty``, so is one of ASCII white space; ``malformed`` is what is not
exactly one JSON value; ``not an object`` a list, text, number, boolean or JSON null. Repeated keys in an
object are malformed. Very long payloads are read whole (VARIANT holds up to 128 MB, more
is ``malformed``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verso.functions.text import year_with_fallback

# Declared fields: name, path, type. The keys of the collector's payloads.
FIELDS = [
    ("artist_name", "artist.name", "string"),
    ("song_id", "song.id", "bigint"),
    ("track_name", "song.title", "string"),
    ("lyrics", "song.lyrics", "string"),
    ("song_date", "detail.song.release_date", "string"),
    ("album_date", "detail.song.album.release_date", "string"),
]


def one_value(raw: Column) -> Column:
    """The JSON value of a text as VARIANT; null if the text is not exactly one value.

    The parser stops after the first value. Inside a list, whatever follows the value is a
    syntax error or a second element; a text that closes the list itself does not close an
    object as well.
    """
    inside = F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]")))
    alone = F.try_variant_get(inside, "$[1]", "variant").isNull()
    closes = raw.contains("]") & F.try_parse_json(F.concat(F.lit('{"v":'), raw, F.lit("}"))).isNull()
    return F.when(alone & ~closes, F.try_variant_get(inside, "$[0]", "variant"))


def _levels() -> list[str]:
    """Paths of the objects above the fields, outer ones first."""
    out: dict[str, None] = {}
    for _, path, _ in FIELDS:
        parts = path.split(".")
        out.update({".".join(parts[:i]): None for i in range(1, len(parts))})
    return sorted(out, key=lambda p: (p.count("."), p))


def _kind(v: Column, path: str) -> Column:
    """OBJECT, STRING, BIGINT, ... of the value at ``path``; null if there is none (a JSON
    null counts as none)."""
    found = F.schema_of_variant(F.try_variant_get(v, f"$.{path}", "variant"))
    return F.when(found.startswith("OBJECT"), F.lit("OBJECT")).when(found != "VOID", found)


def reject_payload(raw: Column, v: Column) -> Column:
    """Why a payload gives no record, else null. ``v`` is the parsed ``raw``."""
    empty = ~F.coalesce(raw.rlike(r"\S"), F.lit(False))
    top = F.schema_of_variant(v)
    wrong = F.lit(None).cast("string")
    for name in reversed(_levels()):
        kind = _kind(v, name)
        wrong = F.when(kind.isNotNull() & (kind != "OBJECT"), F.lit(f"wrong type: {name}")).otherwise(wrong)
    for _, path, kind in reversed(FIELDS):
        want = "STRING" if kind == "string" else "BIGINT"
        wrong = F.coalesce(F.when(_kind(v, path) != want, F.lit(f"wrong type: {path}")), wrong) if path else wrong
    return (
        F.when(empty, F.lit("empty")).when(v.isNull(), F.lit("malformed"))
        .when(~top.startswith("OBJECT"), F.lit("not an object")).otherwise(wrong)
    )


def other_keys(v: Column) -> Column:
    """The top-level keys that no field declares, as one JSON object; null if none."""
    known = sorted({path.split(".")[0] for _, path, _ in FIELDS})
    whole = F.from_json(F.to_json(v), "map<string,variant>")
    rest = F.map_filter(whole, lambda k, _: ~k.isin(known))
    return F.when(F.size(rest) > 0, F.to_json(rest))


def parsed(df: DataFrame, json_col: str = "payload", keep: Sequence[str] = ()) -> DataFrame:
    """``keep``, the payload, the fields, ``release_year``, ``other`` (undeclared keys) and
    ``reason`` (null for a record)."""
    rows = df.select(*keep, F.col(json_col).alias("_raw")).withColumn("_v", one_value(F.col("_raw")))
    rows = rows.withColumn("reason", reject_payload(F.col("_raw"), F.col("_v")))
    ok = F.col("reason").isNull()
    fields = [F.when(ok, F.try_variant_get("_v", f"$.{path}", kind)).alias(name) for name, path, kind in FIELDS]
    out = rows.select(*keep, F.col("_raw").alias("payload"), *fields, F.when(ok, other_keys(F.col("_v"))).alias("other"), "reason")
    return out.withColumn("release_year", year_with_fallback("song_date", "album_date")).drop("song_date", "album_date")


def split_payloads(df: DataFrame, json_col: str = "payload", keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(records, rejected): records have the fields, ``release_year`` and ``other``; rejected
    rows the payload and the reason."""
    rows = parsed(df, json_col, keep)
    records = rows.where("reason IS NULL").drop("reason", "payload")
    return records, rows.where("reason IS NOT NULL").select(*keep, "payload", "reason")
