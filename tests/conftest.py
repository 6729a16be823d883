import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMOKE = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerlake.session import build_session

    session = build_session(
        "local[4]",
        app_name="ledgerlake-tests",
        shuffle_partitions=4,
        conf={"spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def bronze_smoke(spark):
    from ledgerlake.sources.fixtures import bronze_sources

    return bronze_sources(spark, SF_SMOKE)


def rows(df, *cols):
    """Sorted tuples of the selected columns (None sorts first)."""
    data = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(data, key=lambda t: tuple((v is not None, v) for v in t))
