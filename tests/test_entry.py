"""The entry module with and without its optional part."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
OPTIONAL = ("runweave/llm", "tests/llm")


@pytest.mark.parametrize("pipeline", [True, False])
def test_imports_without_the_optional_part(tmp_path, pipeline):
    copy = tmp_path / "copy"
    skipped = {os.path.join(ROOT, p) for p in OPTIONAL}
    if not pipeline:
        skipped.add(os.path.join(ROOT, "corpus_pipeline.py"))

    def left_out(folder, names):
        return [n for n in names if os.path.join(folder, n) in skipped or n in (".git", "__pycache__")]

    shutil.copytree(ROOT, copy, ignore=left_out)
    code = "import __spark_entry__ as e, json; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"
    made = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert made.returncode == 0, made.stderr
    from runweave.plans import ORACLE, QUERIES

    import json

    assert json.loads(made.stdout) == [sorted(QUERIES), sorted(ORACLE)]
