import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from crashlake.session import configure
    session = (SparkSession.builder.master("local[4]").appName("crashlake-tests")
               .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
               .config("spark.driver.memory", "4g").getOrCreate())
    session.sparkContext.setLogLevel("OFF")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def events(spark):
    """Context over the smallest test tables."""
    from crashlake.plans.registry import Context
    return Context(spark, "/root/testdata/sf0.001")
