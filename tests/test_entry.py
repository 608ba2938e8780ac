"""The driver's contract, and that nothing outside the optional subpackage needs it."""

from __future__ import annotations

import re
import subprocess
import sys
from pathlib import Path

import __spark_entry__

ROOT = Path(__file__).resolve().parents[1]


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_names():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_no_import_of_the_subpackage():
    for path in (ROOT / "offerledger").rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"import .*\bllm\b|from .*\bllm\b", path.read_text()), path


def test_a_missing_dependency_takes_no_other_query_along():
    """Without a module that the optional subpackage needs, the rest is registered, and it is said aloud."""
    code = "import sys, warnings; sys.modules['public_tokenizers'] = None; warnings.simplefilter('always'); import __spark_entry__ as e; print(len(e.queries()), any(q.startswith('op') and q[2].isdigit() for q in e.queries()), len(e.oracle_sql()))"
    ran = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    n, has_llm, n_sql = ran.stdout.split()[-3:]
    assert int(n) >= 49 and has_llm == "False" and int(n_sql) >= 42 and "public_tokenizers" in ran.stderr
