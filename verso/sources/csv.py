"""CSV sink and source for the song table.

The reference writes every field quoted with doubled quotes and reads with a
plain reader, which cuts fields holding a quote and a comma and splits rows
at newlines. Here both sides agree: ``escape='"'`` and ``multiLine``.

Columns are taken by header name: any order, extra columns ignored, missing
ones an error. CSV is for import and export (a multi-line file cannot be
split); the jobs hand tables on as parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verso.functions.text import to_text_or_empty
from verso.operators.counts import RowCounts
from verso.schema import SONG_SCHEMA, require_columns

CORRUPT = "_corrupt_record"

#: A multi-line file is read by one task; above this size a reader refuses it.
MAX_FILE_BYTES = 1 << 30


class FileTooLargeError(ValueError):
    """Raised for a CSV file that one task should not read."""


def check_file_sizes(spark: SparkSession, path: str, max_file_bytes: int | None = MAX_FILE_BYTES) -> None:
    """Refuse a file or folder with a file above ``max_file_bytes`` (None: any size).
    Records may hold line breaks, so Spark cannot split a file. Sizes come from the file
    listing; no content is read."""
    if max_file_bytes is None:
        return
    files = spark.read.format("binaryFile").load(path)
    large = files.where(F.col("length") > max_file_bytes).select(F.max(F.struct("length", "path"))).first()[0]
    if large is not None:
        raise FileTooLargeError(f"{large.path} has {large.length} bytes, more than {max_file_bytes}; write it as several CSV files, or as parquet")


def stringify(df: DataFrame) -> DataFrame:
    """Every column as string, null -> ""."""
    return df.select(*[to_text_or_empty(c).alias(c) for c in df.columns])


def write_songs_csv(df: DataFrame, path: str, stringify_nulls: bool = True, skip_empty: bool = True) -> bool:
    """Header, every field quoted, quotes doubled, UTF-8, overwrite.

    One file per partition; the folder is the table. As in the reference,
    nothing is written for an empty frame (returns False). That check is a
    ``limit 1`` job, which for an input behind a shuffle still runs the
    shuffle's map side; pass ``skip_empty=False`` to write unconditionally.
    """
    if skip_empty and df.isEmpty():
        return False
    out = stringify(df) if stringify_nulls else df
    (
        out.write.mode("overwrite")
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        # Spark trims fields on write by default; the text must survive whole.
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return True


def _reader(spark: SparkSession):
    return (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def read_csv_text(spark: SparkSession, path: str, max_file_bytes: int | None = MAX_FILE_BYTES) -> DataFrame:
    """All columns as strings, named by the header (of the first file),
    plus ``_corrupt_record``: the raw text of a record whose fields do not fit
    the header, else null. A file of the folder with another header is an error,
    not a misread. A file above ``max_file_bytes`` is an error."""
    check_file_sizes(spark, path, max_file_bytes)
    # As data, because a reader renames empty and repeated names in a header.
    first = _reader(spark).option("header", False).csv(path).first()
    names = [v or "" for v in first] if first is not None else []
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    reader = _reader(spark).schema(schema).option("enforceSchema", False).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    # A record is compared with the whole header, whichever columns are read.
    return reader.option("columnPruning", False).csv(path)


def read_songs_csv(spark: SparkSession, path: str, schema: T.StructType = SONG_SCHEMA, counts: RowCounts | None = None, step: str = "file") -> DataFrame:
    """S1 + S3: the columns of ``schema`` by name, cast to its types.

    A column the header lacks raises ``MissingColumnsError``; others are
    ignored. A quoted empty field comes back as null; a value that does not
    cast (a non-numeric year) becomes null instead of failing the read.
    Records that do not fit the header are dropped here. ``counts`` gets the
    records and the dropped ones from the scan that reads the rows;
    ``corrupt_records`` counts them by a scan of its own.
    """
    rows = require_columns(read_csv_text(spark, path), schema.names)
    if counts is not None:
        rows = counts.watch(rows, step, records=F.lit(True), corrupt=F.col(CORRUPT).isNotNull())
    # Spark refuses a query on the marker alone (a count): a column is read beside it.
    rows = rows.where(F.col(CORRUPT).isNull() & (F.coalesce(F.length(schema.names[0]), F.lit(0)) >= 0))
    return rows.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def corrupt_records(spark: SparkSession, path: str) -> int:
    """Number of records whose fields do not fit the header."""
    rows = read_csv_text(spark, path)
    # The whole row is read: with the marker column alone nothing would be parsed.
    return rows.agg(F.sum(F.when(F.col(CORRUPT).isNotNull(), 1).otherwise(0)), F.max(F.xxhash64("*"))).first()[0] or 0
