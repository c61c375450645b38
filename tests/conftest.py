import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from skybasin.session import local_session

    session = local_session("8")
    session.sparkContext.setLogLevel("ERROR")
    # Small fixtures: fewer partitions keep the tests short.
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture()
def store(spark):
    from skybasin.session import working_dir
    from skybasin.sources.tables import TableStore

    tables = TableStore(spark, working_dir(spark, "test"))
    tables.create_all()
    return tables
