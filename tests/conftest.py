import os
import sys

import numpy as np
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tabfeat.spec import FeatureSpec  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "8g")
               .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def sample(spark):
    """100 rows of normal features, some missing, and a target that depends on two of them."""
    rng = np.random.default_rng(42)
    x = rng.normal(size=(100, 5))
    y = 2 * x[:, 0] + 1.5 * x[:, 1] + 0.1 * rng.normal(size=100)
    x[5:10, 0] = np.nan
    y[5:10] = np.nan
    columns = [f"feature_{i}" for i in range(5)]
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r], None if np.isnan(t) else float(t))
            for i, (r, t) in enumerate(zip(x, y))]
    schema = "id int, " + ", ".join(f"{c} double" for c in columns) + ", target double"
    return spark.createDataFrame(rows, schema).cache()


@pytest.fixture(scope="session")
def sample_spec():
    return FeatureSpec(("id",), tuple(f"feature_{i}" for i in range(5)), "target")
