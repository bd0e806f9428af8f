import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    s = get_session("local[4]", "millrace-tests", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": str(base / "checkpoint"),
        "spark.sql.warehouse.dir": str(base / "warehouse"),
    })
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted plain tuples of a frame (all columns, or the named ones)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()),
                  key=lambda r: tuple((v is None, "" if v is None else v) for v in r))
