"""The driver's entry where parts of the repository or its libraries are not there."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("hidden", ["public_tokenizers", "tripweave.llm", "corpus_pipeline"])
def test_trip_queries_need_nothing_of_the_corpus_package(hidden):
    code = (
        f"import sys; sys.modules[{hidden!r}] = None\n"
        "import __spark_entry__ as e\n"
        "from oracle_queries import ORACLE\n"
        "assert set(ORACLE) <= set(e.queries()) and set(ORACLE) <= set(e.oracle_sql())\n"
        "assert not any(name.startswith('op') for name in e.queries())\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
