"""The entry points of a copy without the optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import __spark_entry__ as entry
from webloom.plans.oracles import ORACLES
from webloom.plans.queries import QUERIES
assert entry.queries() == QUERIES and entry.oracle_sql() == ORACLES
import bench
assert set(bench.HEADLINE) <= set(entry.queries())
"""


@pytest.mark.parametrize("also", [[], ["corpus_pipeline.py"]])
def test_without_the_subpackage(tmp_path, also):
    left_out = shutil.ignore_patterns("llm", ".git", "__pycache__", "spark-warehouse", *also)
    shutil.copytree(ROOT, tmp_path / "copy", ignore=left_out)
    # What a deletion may leave behind.
    (tmp_path / "copy/webloom/llm/__pycache__").mkdir(parents=True)
    subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path / "copy", check=True, timeout=120)


def test_with_the_subpackage():
    import __spark_entry__ as entry
    from webloom.plans.oracles import ORACLES
    from webloom.plans.queries import QUERIES

    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
