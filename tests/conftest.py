import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sampletide.plans.fixtures import Fixture  # noqa: E402
from sampletide.session import session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    made = session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "6g",
                                  "spark.ui.showConsoleProgress": "false"})
    made.sparkContext.setLogLevel("ERROR")
    return made


@pytest.fixture(scope="session")
def lake_inputs(spark):
    return Fixture(spark, SF)


@pytest.fixture(scope="session")
def lake(spark, lake_inputs):
    """One lake built end to end."""
    from sampletide.plans import lake as plan
    from sampletide.session import scratch
    return plan.build(lake_inputs, scratch(spark, "test-lake"))
