import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import __spark_entry__  # noqa: F401  (makes the package available to workers)
    from kpiloom.session import local_session

    session = local_session(8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def series(spark):
    """Build a table of series from ``{cell: [values]}``, one minute apart; None = NULL."""
    import datetime as dt

    from kpiloom.schema import KPIS

    def make(cells, kpis=KPIS, skip=()):
        start = dt.datetime(2024, 1, 1)
        rows = [
            (cell, start + dt.timedelta(minutes=i), *[None if v is None else float(v) for _ in kpis])
            for cell, values in cells.items()
            for i, v in enumerate(values)
            if i not in skip
        ]
        return spark.createDataFrame(rows, "cell_id string, ts timestamp, " + ", ".join(f"{k} double" for k in kpis))

    return make
