"""The driver's contract, with and without the optional part."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); print('NAMES', *q)"


def names(before=""):
    done = subprocess.run([sys.executable, "-c", before + LIST], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return set(done.stdout.rpartition("NAMES")[2].split()), done.stderr


@pytest.mark.parametrize("absent", ["tiktoken", "tokenizers", "public_tokenizers", "seasonframe.llm", "seasonframe.llm.queries"])
def test_the_library_stands_without_the_optional_part(absent):
    from seasonframe.plans.queries import QUERIES

    found, said = names(f"import sys; sys.modules[{absent!r}] = None; ")
    assert found == set(QUERIES)
    assert "without the training-data queries" in said


def test_the_pipeline_may_be_absent_alone():
    found, _ = names("import sys; sys.modules['corpus_pipeline'] = None; ")
    assert "pipeline" not in found


def test_all_queries_are_there():
    from seasonframe.plans.queries import QUERIES

    assert names()[0] >= set(QUERIES)
