"""The entry points do not need the text operators."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry_without_the_text_operators(tmp_path):
    ignore = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", "tests")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=ignore)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'confusion_wide' in q and set(e.oracle_sql()) <= set(q); print(len(q))"
    run = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    assert int(run.stdout) > 60 and "llm" not in run.stderr


def test_nothing_else_imports_the_text_operators():
    for path in (ROOT / "pixelproof").rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text(), path
