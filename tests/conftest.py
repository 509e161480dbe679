import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import local_session  # noqa: E402


# started before the test modules load, as they build column expressions at the top
SESSION = local_session("4", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture
def values(spark):
    """Values of one expression over a one-column table."""

    def run(expression, data, schema):
        rows = [(i, v) for i, v in enumerate(data)]
        table = spark.createDataFrame(rows, f"i bigint, v {schema}")
        return [r["out"] for r in table.select("i", expression.alias("out")).orderBy("i").collect()]

    return run
