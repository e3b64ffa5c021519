import pytest

from nephogrid.session import session


@pytest.fixture(scope="session")
def spark():
    s = session("local[4]", {"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.sql.warehouse.dir": "/tmp/nephogrid-warehouse"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
