"""The registered names do not depend on the optional training-data operators."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as E
from zerobill.plans.registry import QUERIES

ROOT = os.path.dirname(os.path.abspath(E.__file__))


@pytest.mark.parametrize("hidden", ["numpy", "pyarrow", "corpus_pipeline", "zerobill.llm"])
def test_queries_of_the_job_survive_a_missing_part(hidden, tmp_path):
    code = (
        "import sys\n"
        f"sys.path.insert(0, {ROOT!r})\n"
        f"sys.modules[{hidden!r}] = None\n"
        "import __spark_entry__ as E\n"
        "print(*sorted(E.queries()))\n"
        "assert set(E.oracle_sql()) >= set(E.queries())\n"
    )
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path)
    assert run.returncode == 0, run.stderr
    assert run.stdout.split() == sorted(QUERIES)


def test_names_are_unique_per_kind():
    names = E.queries()
    assert set(QUERIES) <= set(names)
    assert set(E.oracle_sql()) <= set(names)
