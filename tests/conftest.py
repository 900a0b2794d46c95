import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tickwise.session import get_session
    scratch = tempfile.mkdtemp(prefix="tickwise-tests-")
    s = get_session("tickwise-tests", master="local[4]", shuffle_partitions=8,
                    conf={"spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
                          "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tickwise-run-")


def plan_text(df, mode="formatted") -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
