import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tierload.session import build_session
    extra = {}
    # tests only: a checkpoint folder of our own when none is configured
    if not os.environ.get("SPARK_CHECKPOINT_DIR"):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="tierload-test-")
    extra["spark.sql.warehouse.dir"] = tempfile.mkdtemp(prefix="tierload-wh-")
    s = build_session("local[*]", app="tierload-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g", **extra})
    s.sparkContext.setLogLevel("ERROR")
    yield s


def rows(df, order=None):
    cols = df.columns
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))
