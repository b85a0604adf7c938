import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rateflow.session import build_session, checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", 8, app_name="rateflow-tests",
                      extra={"spark.driver.memory": "8g"})
    # Tests run on one machine: a scratch checkpoint directory is fine here.
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="rateflow-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="rateflow-test-")


def ratings_df(spark, rows):
    return spark.createDataFrame(rows, "user_id long, item_id long, rating double")


def rows_of(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
