"""The contract holds without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

from swident.plans.catalogue import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAY = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"


def names(folder):
    out = subprocess.run([sys.executable, "-B", "-c", SAY], cwd=folder, env=os.environ | {"PYTHONPATH": ""}, capture_output=True, text=True, check=True)
    return [set(line.split()) for line in out.stdout.splitlines()]


def test_queries_stand_without_the_folders(tmp_path):
    for gone in (["swident/llm", "tests/llm"], ["swident/llm", "tests/llm", "corpus_pipeline.py"]):
        copy = tmp_path / str(len(gone))
        shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", *(os.path.basename(g) for g in gone)))
        queries, sql = names(copy)
        assert "classify" in queries and sql <= queries
        assert not any(q.startswith("op") or q == "pipeline" for q in queries)


def test_all_queries_are_there():
    queries, sql = names(ROOT)
    assert sql <= queries
    if os.path.isdir(os.path.join(ROOT, "swident", "llm")):
        more = queries - set(QUERIES)
        assert "pipeline" in more and len(more) == 11
