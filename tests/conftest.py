import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import get_spark

    session = get_spark("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows_read(spark):
    """The rows that all stages so far have read from files."""
    store, jvm = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._jvm

    def count() -> int:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        none = spark.sparkContext._gateway.new_array(jvm.double, 0)
        stages = store.stageList(None, False, False, none, jvm.java.util.ArrayList())
        return sum(stages.apply(i).inputRecords() for i in range(stages.size()))

    return count
