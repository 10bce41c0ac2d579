import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabloom.session import local_session, shared_dir  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "tests", "4g", 4)
    shared_dir(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def orders(spark):
    from tabloom.catalog.registry import fx_orders
    return fx_orders(spark, SF_DIR)


class Actions:
    """Counts the Spark actions inside a ``with`` block: every SQL execution takes the next number."""

    def __init__(self, spark):
        self.spark = spark

    def executions(self):
        bus = self.spark.sparkContext._jsc.sc().listenerBus()
        bus.waitUntilEmpty()
        seen = self.spark._jsparkSession.sharedState().statusStore().executionsList()
        return seen.apply(seen.size() - 1).executionId() + 1 if seen.size() else 0

    def __enter__(self):
        self.before = self.executions()
        return self

    def __exit__(self, *_):
        self.count = self.executions() - self.before


@pytest.fixture
def actions(spark):
    return lambda: Actions(spark)


@pytest.fixture(scope="session")
def visits(spark):
    """Visits of a shop: some devices and durations are unknown, a few sums are wild."""
    rows = []
    for i in range(400):
        branch = ("north", "south", "west")[i % 3]
        device = None if i % 37 == 0 else ("phone", "desk", "kiosk")[(i // 2) % 3]
        minutes = None if i % 9 == 0 else (i * 11 % 53) / 2
        spend = 900.0 + i if i % 80 == 0 else 10.0 + (i * 29) % 97
        rows.append((i, int(i % 7 < 2 or (branch == "west" and i % 4 == 0)), minutes, (i * 5) % 13, spend, device, branch))
    return spark.createDataFrame(rows, "id int, booked int, minutes double, pages int, spend double, device string, branch string")
