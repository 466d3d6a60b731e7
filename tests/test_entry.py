"""What the driver's entry registers, with and without the training-text operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
COUNT = (
    "import re, __spark_entry__ as e; found = e.queries(); "
    "print(sum(not re.match(r'op\\d+_|pipeline$', n) for n in found), set(e.oracle_sql()) <= set(found))"
)


def count(folder, before=""):
    done = subprocess.run([sys.executable, "-c", before + COUNT], cwd=folder, capture_output=True, text=True, check=True)
    return done.stdout.split()


@pytest.fixture
def copy(tmp_path):
    """The repository without the folder of the training-text operators and their pipeline."""
    for name in ("opinara", "__spark_entry__.py"):
        kind = shutil.copytree if (ROOT / name).is_dir() else shutil.copy
        kind(ROOT / name, tmp_path / name, **({"ignore": shutil.ignore_patterns("llm", "__pycache__")} if (ROOT / name).is_dir() else {}))
    return tmp_path


def test_without_the_folder(copy):
    assert count(copy) == count(ROOT)


def test_with_an_empty_folder_left(copy):
    (copy / "opinara" / "llm" / "__pycache__").mkdir(parents=True)
    shutil.copy(ROOT / "__spark_entry__.py", copy / "corpus_pipeline.py")
    assert count(copy) == count(ROOT)


def test_without_a_package(copy):
    assert count(ROOT, "import sys; sys.modules['xxhash'] = None; ") == count(ROOT)
