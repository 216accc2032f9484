import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from orderloom.session import local_session

    session = local_session("*", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tables(spark, folder):
    from orderloom.bindings import Tables

    return Tables(spark, folder)


@pytest.fixture(scope="session")
def con(folder):
    from oracle import connect

    return connect(folder)
