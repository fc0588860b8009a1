import pytest

from tankwise.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_slices(spark):
    """Makes every arrangement cut slices of about 25 rows."""
    spark.conf.set("spark.tankwise.rowsPerSlice", "25")
    yield 25
    spark.conf.unset("spark.tankwise.rowsPerSlice")
