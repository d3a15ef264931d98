"""Versions of a fitted pipeline (S8, S9): a save never touches a version in use.

    STORE/versions/ID/            a model as MLlib writes it, never overwritten
    STORE/manifest/version=0007/  one row (id, note): the version, published last

``save_version`` writes a new folder and then publishes it by one small manifest file that is
moved into place. A save that fails half way leaves a folder that no manifest names:
readers keep the versions they had. Two savers cannot publish one number: the rename fails
for the second, which takes the next number.

``load_version`` loads the latest version or a pinned one; a long-running reader (a stream)
pins the version it started with. ``drop_versions`` deletes old ones, never the latest.
"""

from __future__ import annotations

import json
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession


def _files(spark: SparkSession, store: str):
    """(file system, function from a name below the store to its Hadoop path)."""
    root = spark._jvm.org.apache.hadoop.fs.Path(store.rstrip("/"))
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), lambda name: spark._jvm.org.apache.hadoop.fs.Path(root, name)


def versions(spark: SparkSession, store: str) -> dict[int, dict]:
    """Published versions: number -> {"id", "note"}; one small file each."""
    files, at = _files(spark, store)
    if not files.exists(at("manifest")):
        return {}
    out = {}
    for status in files.listStatus(at("manifest")):
        name = status.getPath().getName()
        if name.startswith("version="):
            stream = files.open(status.getPath())
            try:
                out[int(name.split("=")[1])] = json.loads(bytes(stream.readAllBytes()).decode())
            finally:
                stream.close()
    return dict(sorted(out.items()))


def _publish(spark: SparkSession, store: str, entry: dict) -> int:
    files, at = _files(spark, store)
    files.mkdirs(at("manifest"))
    draft = at(f"manifest/_draft-{entry['id']}")
    stream = files.create(draft, True)
    try:
        stream.write(bytearray(json.dumps(entry).encode()))
    finally:
        stream.close()
    number = max(versions(spark, store), default=0) + 1
    while files.exists(at(f"manifest/version={number:08d}")) or not files.rename(draft, at(f"manifest/version={number:08d}")):
        number += 1
    return number


def save_version(model: PipelineModel, store: str, note: str = "") -> int:
    """Save ``model`` as the store's next version; returns its number."""
    spark = SparkSession.getActiveSession()
    entry = {"id": uuid.uuid4().hex, "note": note}
    model.write().save(f"{store.rstrip('/')}/versions/{entry['id']}")
    return _publish(spark, store, entry)


def version_path(spark: SparkSession, store: str, version: int | None = None) -> str:
    """Folder of a version (None: the latest)."""
    known = versions(spark, store)
    if not known or (version is not None and version not in known):
        raise LookupError(f"no version {version if version is not None else ''} in {store}: {sorted(known)}")
    return f"{store.rstrip('/')}/versions/{known[version if version is not None else max(known)]['id']}"


def load_version(spark: SparkSession, store: str, version: int | None = None) -> PipelineModel:
    """The latest version, or a pinned one."""
    return PipelineModel.load(version_path(spark, store, version))


def drop_versions(spark: SparkSession, store: str, keep: int = 3) -> list[int]:
    """Delete all but the ``keep`` latest versions (at least one stays), and folders of
    failed saves are left alone (another save may be writing one). The manifest entry goes
    first, so no reader finds a version without its files."""
    files, at = _files(spark, store)
    known = versions(spark, store)
    old = sorted(known)[: -max(1, keep)]
    for number in old:
        files.delete(at(f"manifest/version={number:08d}"), False)
        files.delete(at(f"versions/{known[number]['id']}"), True)
    return old
