import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from doclake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=4,
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate one expression over a list of inputs."""

    def run(expression, inputs, schema="x string"):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, {schema}")
        found = rows.select("i", expression(F.col(schema.split()[0])).alias("y")).collect()
        return [r["y"] for r in sorted(found, key=lambda r: r["i"])]

    return run


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
