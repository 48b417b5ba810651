import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from jobloom.session import local_session  # noqa: E402


# started here because column expressions at module level need a session
SESSION = local_session(4, memory="4g")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = SESSION
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session


@pytest.fixture(scope="session")
def one(spark):
    """Values of expressions over a single row."""

    def evaluate(*columns):
        row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()
        return row[0] if len(columns) == 1 else tuple(row)

    return evaluate
