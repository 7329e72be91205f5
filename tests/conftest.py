import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidegrid.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate a column function on a list of values."""

    def run(function, *items, kind="string"):
        frame = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
        rows = frame.select("i", function(frame.v).alias("r")).collect()
        return [r.r for r in sorted(rows, key=lambda r: r.i)]

    return run
