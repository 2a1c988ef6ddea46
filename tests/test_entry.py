"""The entry file without what only the training-data operators need."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("missing", ["xxhash", "public_tokenizers", "shelfwise.llm"])
def test_pricing_queries_survive(missing):
    code = (f"import sys; sys.modules[{missing!r}] = None\n"
            "import __spark_entry__ as e\n"
            "names = set(e.queries()); assert 'feature_mart' in names and set(e.oracle_sql()) <= names\n"
            "assert not any(n.startswith('op') or n == 'pipeline' for n in names), names")
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
