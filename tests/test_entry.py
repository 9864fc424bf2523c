"""The entry keeps the trip queries where the optional part, or a library that it needs, cannot be imported."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
COUNT = "import __spark_entry__ as e; from fareloom.plans.registry import QUERIES; print(len(e.queries()) - len(QUERIES))"
BLOCK = "import sys; sys.modules['ahocorasick'] = None; "


def _run(folder, code):
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return int(done.stdout.split()[-1])


@pytest.fixture
def copy(tmp_path):
    """The library without the optional part."""
    shutil.copytree(ROOT / "fareloom", tmp_path / "fareloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    return tmp_path


def test_a_missing_library():
    assert _run(ROOT, BLOCK + COUNT) == 0


def test_the_part_is_left_out(copy):
    assert _run(copy, COUNT) == 0


def test_only_a_cache_folder_is_left(copy):
    (copy / "fareloom" / "llm" / "__pycache__").mkdir(parents=True)
    assert _run(copy, COUNT) == 0
