"""The library without its training-data part."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import __spark_entry__ as e
names = set(e.queries())
assert names and not any(n.startswith("op") and n[2].isdigit() for n in names) and "pipeline" not in names
assert set(e.oracle_sql()) <= names
import textkiln.streaming.events, textkiln.sources.archive
"""


@pytest.mark.parametrize("gone", [("textkiln/llm", "tests/llm"), ("textkiln/llm", "tests/llm", "corpus_pipeline.py")])
def test_the_rest_imports_alone(tmp_path, gone):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    for name in gone:
        shutil.rmtree(copy / name) if (copy / name).is_dir() else (copy / name).unlink(missing_ok=True)
    done = subprocess.run([sys.executable, "-c", CODE], cwd=copy, env={"PYTHONPATH": str(copy), "PATH": "/usr/bin:/bin"}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_it():
    for p in (ROOT / "textkiln").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT / "textkiln").parts:
            assert "textkiln.llm" not in p.read_text(), p
