import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelcast.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", 8, str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def friday(i: int, start=dt.date(2010, 2, 5)) -> dt.date:
    return start + dt.timedelta(days=7 * i)


FACT = "Store int, Dept int, Date date, Weekly_Sales double, IsHoliday boolean"


@pytest.fixture(scope="session")
def gappy(spark):
    """Three series: one complete, one with gaps, one short; week indexes are returned too."""
    weeks = {
        (1, 1): list(range(150)),
        (1, 2): [i for i in range(140) if i % 7 not in (3, 4) and not 60 <= i < 66],
        (2, 1): list(range(100, 130)),
    }
    rows = [
        (s, d, friday(i), float((i * 37 + s * 11 + d * 5) % 101 + i), i % 13 == 0)
        for (s, d), idx in weeks.items() for i in idx]
    return spark.createDataFrame(rows, FACT), rows
