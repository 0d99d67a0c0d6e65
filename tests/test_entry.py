"""The driver's contract, also without the training-data operators."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
REST = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert len(q) > 80 and set(s) <= set(q); assert not [n for n in q if n.startswith('op')] and 'pipeline' not in q"


def load(where, code):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=where, env=env, check=True)


def copy(tmp_path, *gone):
    shutil.copytree(ROOT, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "__pycache__", "*.md", *gone))
    return tmp_path / "r"


@pytest.mark.parametrize("gone", [("llm",), ("llm", "corpus_pipeline.py")])
def test_without_the_llm_folders(tmp_path, gone):
    load(copy(tmp_path, *gone), REST)


def test_without_a_library_of_theirs(tmp_path):
    load(copy(tmp_path), "import sys; sys.modules['xxhash'] = None; " + REST)


def test_without_the_pipeline(tmp_path):
    load(copy(tmp_path, "corpus_pipeline.py"), "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and (not any(n.startswith('op1_') for n in q) or len(q) > 100)")


def test_every_operator_of_the_list_is_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    if any(n.startswith("op") and n[2:3].isdigit() for n in names):
        assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names
