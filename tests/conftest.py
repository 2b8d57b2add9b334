import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from siltbed.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        8,
        **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("work")), "spark.sql.shuffle.partitions": "4"},
    )
    yield session
    session.stop()


@pytest.fixture
def folders():
    """Data folders of a log row, without the id of the attempt that wrote them."""
    return lambda entry: [re.sub("/attempt=a[0-9a-f]+", "", part) for part in entry["parts"]]


@pytest.fixture
def plan():
    """Physical plan of a frame as text."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString()
