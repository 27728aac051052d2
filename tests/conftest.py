import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wayfarer.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("catalog")
    s = local_session(4, shuffle_partitions=4, app="wayfarer-tests",
                      extra={"spark.sql.warehouse.dir": str(warehouse)})
    yield s


@pytest.fixture(scope="session")
def fx():
    from wayfarer.plans import FIXTURE_PARAMS
    return FIXTURE_PARAMS


def rows(df, *cols):
    """Sorted list of tuples (optionally of a column subset) for order-free comparison."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
