"""The library without its optional part."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"


def copy(to, *without):
    shutil.copytree(ROOT, to, ignore=lambda d, names: [n for n in names if n in (".git", *without)])
    return to


@pytest.mark.parametrize("without", [("llm",), ("llm", "corpus_pipeline.py")])
def test_entry_and_collection_without_llm(tmp_path, without):
    folder = copy(tmp_path / "repo", *without)
    # What a deleted folder may leave behind.
    os.makedirs(folder / "murmura" / "llm" / "__pycache__")
    out = subprocess.run([sys.executable, "-c", COUNT], cwd=folder, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    n, n_sql, pipeline = out.stdout.split()[-3:]
    assert int(n) > 80 and int(n_sql) > 80 and pipeline == "False"
    tests = [sys.executable, "-m", "pytest", "tests", "--collect-only", "-q"]
    assert subprocess.run(tests, cwd=folder, capture_output=True, timeout=240).returncode == 0


def test_faults_of_the_optional_part_are_not_hidden(tmp_path):
    folder = copy(tmp_path / "repo")
    with open(folder / "murmura" / "llm" / "common.py", "a") as f:
        f.write("\nimport a_module_that_is_not_there\n")
    out = subprocess.run([sys.executable, "-c", COUNT], cwd=folder, capture_output=True, text=True, timeout=120)
    assert out.returncode != 0 and "a_module_that_is_not_there" in out.stderr
