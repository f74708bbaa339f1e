import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from fetchplan.session import get_spark  # noqa: E402

from fetchplan.sources.seed import SEED_AS_OF  # noqa: E402, F401


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", shuffle_partitions=8, app="fetchplan-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def seed(spark):
    from fetchplan.sources.seed import seed_tables
    return seed_tables(spark)


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return [tuple(r[c] for c in cols) for r in df.collect()]
