import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from costledger.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    session = build_session(
        "tests",
        "local[4]",
        spark_ui_showConsoleProgress="false",
        spark_driver_memory="4g",
        spark_checkpoint_dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def column(spark):
    """Values of one expression over a list of texts, in order."""

    def run(values, expression):
        df = spark.createDataFrame(list(enumerate(values)), "i int, c string")
        return [r["x"] for r in df.select("i", expression.alias("x")).orderBy("i").collect()]

    return run
