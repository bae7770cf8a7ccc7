import pytest

from curaspark.session import get_spark


@pytest.fixture(scope="session")
def spark():
    s = get_spark("tests", 4, **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "3g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
