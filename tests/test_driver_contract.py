import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from helpers import ROOT, SMALL_SF


def test_entry_runs_on_smoke_data(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["custid", "version"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 30


@pytest.mark.skipif(not os.path.isdir(SMALL_SF), reason="test data missing")
def test_queries_match_oracle_at_smallest_scale():
    """Every registered query against its DuckDB statement (sf0.001)."""
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "tools", "compare.py"), SMALL_SF],
        capture_output=True, text=True, timeout=1800, cwd=ROOT,
    )
    lines = [x for x in out.stdout.splitlines() if x.strip()]
    assert lines and lines[-1] == "ALL OK", "\n".join(lines[-40:])
