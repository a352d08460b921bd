import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from mesada.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Small inputs: few partitions keep the many short jobs short.
    s = local_session(
        4, "mesada-tests", **{"spark.sql.shuffle.partitions": "2", "spark.default.parallelism": "1"}
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


# Fixture holidays, 2023-12 to 2025-01.
HOLIDAYS = [
    dt.date.fromisoformat(d)
    for d in (
        "2024-01-01 2024-01-08 2024-03-25 2024-03-28 2024-03-29 2024-05-01 2024-06-03 "
        "2024-07-01 2024-08-07 2024-08-19 2024-11-04 2024-11-11 2024-12-25 2025-01-01 "
        "2025-01-06"
    ).split()
]


@pytest.fixture(scope="session")
def holidays(spark):
    return spark.createDataFrame([(d,) for d in HOLIDAYS], "fecha date").cache()
