import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="run-", dir="/tmp"),
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def many_partitions(spark):
    """Keep Spark from merging small test partitions into one."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


@pytest.fixture(params=["plain", "spread"])
def window_mode(request, monkeypatch, many_partitions):
    """Both ways of ranking: the ordinary window for small tables and the range-partitioned one."""
    from tidemark.functions import ordering

    if request.param == "spread":
        monkeypatch.setattr(ordering, "PLAIN_WINDOW_ROWS", 0)
    return request.param
