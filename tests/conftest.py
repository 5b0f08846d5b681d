import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .appName("cohortlens-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def pairs(spark):
    """Build a cohort table from (group, truth, estimate) tuples."""

    def build(rows):
        data = [(i, g, None if t is None else float(t), None if e is None else float(e)) for i, (g, t, e) in enumerate(rows)]
        return spark.createDataFrame(data, "ID bigint, GIA string, lpa_nmol_max double, lpa_pred_nm double")

    return build
