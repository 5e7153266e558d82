import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hirelens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"}
    session = build_session("tests", "local[4]", **conf)
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluate a one-column expression over a list of values."""
    from pyspark.sql import functions as F

    def run(values, expression, kind="string"):
        frame = spark.createDataFrame(
            [(i, v) for i, v in enumerate(values)], f"i int, v {kind}"
        )
        rows = frame.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()
        return [row["out"] for row in rows]

    return run
