import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
for folder in (ROOT, ROOT / "tests"):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))

from quayside.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    folder = tmp_path_factory.mktemp("spark")
    SparkSession.builder.config("spark.sql.warehouse.dir", str(folder / "warehouse")).config(
        "spark.checkpoint.dir", str(folder / "checkpoints")).config("spark.driver.memory", "6g").config(
        "spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").master("local[8]").getOrCreate()
    session = local_session(8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small() -> str:
    return SMALL


@pytest.fixture(scope="session")
def warehouse(spark, small):
    from quayside.plans.warehouse import Warehouse

    return Warehouse(spark, small)
