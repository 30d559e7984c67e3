"""The entry point, with and without what the text operators need; folders that end with the driver."""

from __future__ import annotations

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(code: str) -> str:
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr
    return done.stdout.strip()


def test_core_queries_load_without_a_dependency_of_the_text_operators():
    for missing in ("zstandard", "regex", "corpus_pipeline", "renalis.llm"):
        code = (
            f"import sys; sys.modules[{missing!r}] = None\n"
            "import __spark_entry__ as e\n"
            "q, s = e.queries(), e.oracle_sql()\n"
            "assert 'aki_onsets' in q and 'aki_onsets' in s and set(s) <= set(q)\n"
            "print(len(q), sum(n.startswith('op') or n == 'pipeline' for n in q))"
        )
        found, of_text = map(int, run(code).split())
        assert found > 100 and of_text == 0, missing


def test_workspaces_go_with_the_driver(tmp_path):
    code = f"""
from pyspark.sql import SparkSession
from renalis.session import Workspace
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate())
kept, cleared = Workspace(spark), Workspace(spark)
rows = kept.cut(spark.range(3), "rows")
cleared.cut(rows, "rows")
cleared.clear()
import os
assert rows.count() == 3
print(len([d for d in os.listdir({str(tmp_path)!r}) if d.startswith("renalis-")]))
spark.stop()
"""
    assert run(code) == "1"
    assert [d for d in os.listdir(tmp_path) if d.startswith("renalis-")] == []
