import pytest

from tests.oracle_check import database, session


@pytest.fixture(scope="session")
def spark():
    spark = session()
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def small_folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small_db(small_folder):
    return database(small_folder)
