import pytest

from tests.session import local_session


@pytest.fixture(scope="session")
def spark():
    spark = local_session()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    return spark


@pytest.fixture
def rows():
    """The rows of a DataFrame as a sorted list of tuples."""
    return lambda df: sorted(tuple(row) for row in df.collect())
