import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from inkveil import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session.build(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.maxPlanStringLength": "2000",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def lines(spark):
    def make(*texts):
        rows = [(i + 1, t) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "line_no bigint, line string")

    return make


@pytest.fixture
def blocks(spark):
    def make(*texts):
        return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")

    return make
