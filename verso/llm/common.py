"""Small helpers shared by the text operators."""

from __future__ import annotations

import atexit
import functools
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verso.session import materialize, scratch_path

__all__ = ["arrow_map", "documents", "fold", "is_held_out", "materialize", "scratch_path", "written"]


@functools.lru_cache(maxsize=1)
def _package_zip() -> str:
    """This package as a zip in the driver's temp folder; Spark ships it."""
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    fd, path = tempfile.mkstemp(prefix="verso-", suffix=".zip")
    os.close(fd)
    atexit.register(lambda: os.path.exists(path) and os.unlink(path))
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    return path


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (once a context)."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        spark.sparkContext.addPyFile(_package_zip())
        _shipped.add(app)


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` whose workers can import this package."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(doc_id: str, n: int):
    """crc32 of the id as text, modulo ``n``: a fold that no data order moves."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(n))


def is_held_out(doc_id: str, n: int, rest: int = 2):
    """True in the held-out fold; a null id is in no fold and counts as training."""
    return F.coalesce(fold(doc_id, n) == rest, F.lit(False))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to a fresh table in the shared folder and read it back (cuts lineage)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
