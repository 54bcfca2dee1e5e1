"""The register can be read before a session exists."""

import subprocess
import sys
from pathlib import Path


def test_register_needs_no_session():
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), len(o))"
    out = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    queries, statements = map(int, out.stdout.split())
    assert queries >= 185 and statements >= 177
