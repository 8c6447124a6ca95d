"""What several test modules share. Not in conftest: every folder may have one of that name."""

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SMALL_SF = "/root/testdata/sf0.001"


def rows(df, order=None):
    """Collect as sorted list of tuples (small test outputs only)."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple("" if v is None else str(v) for v in t))
