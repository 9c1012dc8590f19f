import pytest

from tests import oracle


@pytest.fixture(scope="session")
def spark():
    session = oracle.session()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def con():
    return oracle.duck(oracle.folder("0.001"))


@pytest.fixture
def no_broadcast(spark):
    """Shuffled joins only, as between tables too large to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
