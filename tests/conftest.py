import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyshelf.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session("tests", **{
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    spark.sparkContext.setLogLevel("ERROR")
    yield spark


@pytest.fixture
def many_blocks(spark):
    """Every shuffle partition stays a task of its own, so that small tables span several."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
