import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from docgraph.plans.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session("tests", "local[8]", **{"spark.sql.shuffle.partitions": "4",
                                        "spark.driver.memory": "6g",
                                        "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def rows():
    def collect(df, *order):
        return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return collect
