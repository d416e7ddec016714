import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from memberscope.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="memberscope-tests", shuffle_partitions=4,
                      extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as tuples (in ``cols`` order when given)."""
    if cols:
        df = df.select(*cols)
    return [tuple(r) for r in df.collect()]


_FRAMES = {}


def query_frame(spark, key):
    """The frame of a registered query over the smallest tables, made once: many
    queries write tables of their own before they return."""
    from memberscope.plans import catalog
    if key not in _FRAMES:
        _FRAMES[key] = catalog.QUERIES[key](spark, SF_SMALL)
    return _FRAMES[key]
