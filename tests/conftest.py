import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ledgerline.session import build_session
    warehouse = tmp_path_factory.mktemp("warehouse")
    s = build_session("local[4]", app_name="ledgerline-tests", shuffle_partitions=4,
                      extra_conf={"spark.sql.warehouse.dir": str(warehouse)})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def scratch(spark):
    from ledgerline.session import scratch_path
    return lambda name: scratch_path(spark, name)


@pytest.fixture(scope="module", autouse=True)
def no_views_left():
    """Views that a module's tests registered show up in every database of the shared session: drop them."""
    yield
    from pyspark.sql import SparkSession
    session = SparkSession.getActiveSession()
    if session:
        for table in session.catalog.listTables():
            if table.isTemporary:
                session.catalog.dropTempView(table.name)
