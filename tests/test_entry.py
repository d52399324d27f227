"""The entry module, with and without the subpackage on training text."""

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry
import pytest

ROOT = Path(entry.__file__).resolve().parent


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("gone", [["chartspark/llm", "corpus_pipeline.py"], ["chartspark/llm"], ["corpus_pipeline.py"]])
def test_the_subpackage_can_be_left_out(tmp_path, gone):
    shutil.copytree(ROOT / "chartspark", tmp_path / "chartspark", ignore=lambda d, names: [n for n in names if n == "__pycache__" or (n == "llm" and "chartspark/llm" in gone)])
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in gone and (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path / name)
    script = "import __spark_entry__ as e; print(len(e.queries()), sum(n.startswith('op') or n == 'pipeline' for n in e.queries()))"
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env={"PATH": "", "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert done.stdout.split() == [str(len(entry.QUERIES)), "0"]


def test_a_library_that_only_the_subpackage_needs_may_be_missing(tmp_path):
    script = "import sys; sys.modules['zstandard'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.LLM_QUERIES))"
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env={"PATH": "", "PYTHONPATH": str(ROOT)}, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert done.stdout.split() == [str(len(entry.QUERIES)), "0"] and "left out" in done.stderr


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "chartspark").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "chartspark.llm" not in path.read_text()
