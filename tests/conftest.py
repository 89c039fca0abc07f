import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from fundtide.session import local_session

    session = local_session(cpus=8, shuffle_partitions=8)
    session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fundtide-tests-"))
    yield session
    session.stop()


@pytest.fixture()
def folder(spark):
    from fundtide.sources.workspace import new_folder

    return lambda name: new_folder(spark, name)


@pytest.fixture()
def bars(spark):
    """Build a bar table from {ticker: [closes, oldest first]}; one bar per day from 2026-01-01 on."""
    from datetime import date, timedelta

    def build(series, first=date(2026, 1, 1)):
        rows = [
            (t, first + timedelta(days=i), float(c), 1)
            for t, closes in series.items()
            for i, c in enumerate(closes)
            if c is not None
        ]
        return spark.createDataFrame(rows, "ticker string, trade_date date, close_price double, volume bigint")

    return build
