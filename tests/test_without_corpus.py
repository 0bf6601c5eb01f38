"""The library and its queries without the corpus subpackage, in a copy of the repository."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
SHOW = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), [q for q in e.queries() if q.startswith('op') and q[2].isdigit() or q == 'pipeline'])"


def copy(folder, *without):
    def skipped(path, names):
        here = Path(path).relative_to(ROOT)
        return [n for n in names if n in {".git", "__pycache__", ".pytest_cache"} or str(here / n) in without]

    shutil.copytree(ROOT, folder, ignore=skipped)
    return folder


def registered(folder):
    done = subprocess.run([sys.executable, "-c", SHOW], cwd=folder, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    return done.stdout.strip()


@pytest.mark.parametrize(
    "without",
    [
        ("tradeledger/llm", "tests/llm"),  # the pipeline's file left in place
        ("tradeledger/llm", "tests/llm", "corpus_pipeline.py"),
    ],
)
def test_entry_without_the_corpus_folders(tmp_path, without):
    assert registered(copy(tmp_path / "copy", *without)).endswith("[]")


def test_entry_with_an_empty_corpus_folder(tmp_path):
    folder = copy(tmp_path / "copy", "tradeledger/llm", "tests/llm")
    (folder / "tradeledger/llm").mkdir()
    assert registered(folder).endswith("[]")
