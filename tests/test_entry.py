"""The driver's module with and without the corpus add-on."""

import os
import shutil
import subprocess
import sys

import pytest

from checks.queries import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


@pytest.mark.parametrize("pipeline_left", [True, False])
def test_imports_without_the_add_on(folder, pipeline_left):
    skipped = shutil.ignore_patterns("llm", ".git", "__pycache__", *([] if pipeline_left else ["corpus_pipeline.py"]))
    copy = shutil.copytree(ROOT, os.path.join(folder, "copy"), ignore=skipped)
    assert os.path.exists(f"{copy}/corpus_pipeline.py") == (pipeline_left and os.path.exists(f"{ROOT}/corpus_pipeline.py"))
    env = {**os.environ, "PYTHONPATH": copy}
    names, sql = subprocess.run([sys.executable, "-c", COUNT], cwd=copy, env=env, capture_output=True, text=True, check=True).stdout.splitlines()
    assert names.split() == sql.split() == sorted(QUERIES)
