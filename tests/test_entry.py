import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from checks.oracles import ORACLES
from checks.queries import QUERIES

REPO = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("pipeline", [True, False], ids=["pipeline left", "pipeline gone"])
def test_entry_imports_without_the_training_data_operators(folder, pipeline):
    gone = [] if pipeline else ["corpus_pipeline.py"]
    shutil.copytree(REPO, f"{folder}/repo", ignore=shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache", *gone))
    code = "import __spark_entry__ as e; print(sorted(e.queries())); print(sorted(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=f"{folder}/repo", capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr
    assert said.stdout.splitlines() == [str(sorted(QUERIES)), str(sorted(ORACLES))]
