import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def scratch():
    """A fresh scratch folder per test session (never reused or cleared)."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="session")
def spark(scratch):
    from catchment.session import get_spark

    s = get_spark(
        master="local[4]",
        shuffle_partitions=4,
        extra={"spark.checkpoint.dir": f"{scratch}/checkpoints", "spark.driver.memory": "4g", "spark.ui.enabled": "false"},
    )
    yield s
    s.stop()


def _key(t):
    return [(v is None, type(v).__name__, v if v is not None else 0) for v in t]


def srt(xs):
    """Sort tuples that may hold NULLs (NULL last per position)."""
    return sorted(xs, key=_key)


def rows(df, *cols):
    """Sorted list of tuples (all columns when none given)."""
    sel = df.select(*cols) if cols else df
    return srt(tuple(r) for r in sel.collect())
