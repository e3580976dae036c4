import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from signalmart.session import get_spark
    s = get_spark("local[4]", app="signalmart-tests", shuffle_partitions=4)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="signalmart-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="signalmart-test-")


def rows(df, *cols):
    """Collect selected columns as a sorted list of tuples."""
    sel = df.select(*cols) if cols else df
    key = lambda t: tuple((0, 0) if v is None else (1, v) for v in t)
    return sorted((tuple(r) for r in sel.collect()), key=key)


def plan_text(df, mode="formatted"):
    """The physical plan as printed by df.explain()."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
