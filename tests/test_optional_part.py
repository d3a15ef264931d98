"""The library without its optional part: entry point and queries still import."""

import os
import shutil
import subprocess
import sys

TOP = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROBE = """
import __spark_entry__ as e
from verso.plans.catalog import QUERIES
assert set(e.queries()) == set(QUERIES) == set(e.oracle_sql()), sorted(e.queries())
assert all(m.split(".")[:2] != ["verso", "llm"] for m in __import__("sys").modules)
"""


def _probe(tmp_path, without):
    copy = tmp_path / "copy"
    shutil.copytree(f"{TOP}/verso", copy / "verso", ignore=shutil.ignore_patterns("__pycache__", *without))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in without and os.path.exists(f"{TOP}/{name}"):
            shutil.copy(f"{TOP}/{name}", copy / name)
    return subprocess.run([sys.executable, "-c", PROBE], cwd=copy, env={**os.environ, "PYTHONPATH": str(copy)}, capture_output=True, text=True)


def test_without_the_folder_and_its_pipeline(tmp_path):
    out = _probe(tmp_path, ("llm", "corpus_pipeline.py"))
    assert out.returncode == 0, out.stderr


def test_without_the_folder_only(tmp_path):
    out = _probe(tmp_path, ("llm",))
    assert out.returncode == 0, out.stderr
