import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from gazette.session import get_spark

    ckpt = tempfile.mkdtemp(prefix="gazette-test-ckpt-")
    s = get_spark("local[4]", 8, app_name="gazette-tests",
                  extra={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
