"""The driver contract in a copy without the text operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_the_text_operators(tmp_path):
    copy = tmp_path / "repo"
    left_out = shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "tests")
    shutil.copytree(ROOT, copy, ignore=left_out)
    assert not os.path.exists(copy / "procurelens" / "llm")
    code = "import __spark_entry__ as e; names = set(e.queries()); print(len(names), sorted(names - set(e.oracle_sql())))"
    run = subprocess.run([sys.executable, "-B", "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    number, rest = run.stdout.split(maxsplit=1)
    assert int(number) > 70 and rest.strip() == "[]"
