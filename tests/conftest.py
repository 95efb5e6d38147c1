import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from shardleaf import local_session

    session = local_session(8, "shardleaf-tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rows(df, *cols):
    """Rows as a sorted list of tuples."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
