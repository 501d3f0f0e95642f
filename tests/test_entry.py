"""The driver's entry point imports whether or not the optional parts are there."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LISTING = "import __spark_entry__ as e; print('NAMES', *sorted(e.queries())); print('SQL', *sorted(e.oracle_sql()))"


def _listed(tmp_path, *left_out):
    """The queries and statements that the entry point of a copy of the tree
    names, with some of its parts left out."""
    top = tmp_path / "tree"
    skipped = {os.path.join(ROOT, *name.split("/")) for name in left_out}

    def ignore(folder, names):
        return [n for n in names if n in {".git", "__pycache__", "tests", "spark-warehouse"} or os.path.join(folder, n) in skipped]

    shutil.copytree(ROOT, top, ignore=ignore)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, "-c", LISTING], cwd=top, env=env, capture_output=True, text=True)
    assert ran.returncode == 0, ran.stderr
    names, sql = (next(line.split()[1:] for line in ran.stdout.splitlines() if line.startswith(w)) for w in ("NAMES", "SQL"))
    return set(names), set(sql)


@pytest.mark.parametrize("left_out", [("ledgerlens/llm",), ("ledgerlens/llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_entry_imports_without_the_optional_parts(tmp_path, left_out):
    from ledgerlens.plans.registry import QUERIES

    if not os.path.isdir(os.path.join(ROOT, "ledgerlens", "llm")):
        left_out = ()
    names, sql = _listed(tmp_path, *left_out)
    assert set(QUERIES) <= names and set(QUERIES) <= sql
    assert "pipeline" not in names
    if "ledgerlens/llm" in left_out:
        assert names == set(QUERIES)
