import tempfile
import uuid

import pytest
from pyspark.sql import SparkSession

from lakesync.session import configure

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="lakesync-")
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.sql.warehouse.dir", scratch + "/warehouse")
               .config("spark.checkpoint.dir", scratch + "/checkpoints")
               .config("spark.driver.memory", "4g")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def namespace(spark):
    name = "t_" + uuid.uuid4().hex[:8]
    yield "spark_catalog." + name
    spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")
