import pytest

from casefile.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = local_session(8, 8, **{"spark.checkpoint.dir": str(folder)})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one_row(spark):
    """Evaluate a column over a single value of the column x."""

    def evaluate(column, value):
        return spark.createDataFrame([(value,)], "x string").select(column.alias("y")).first()["y"]

    return evaluate
