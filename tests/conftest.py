import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from recordloom.config import CustomerRules, EmployeeRules, session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def rules():
    return EmployeeRules(as_of=dt.date(2026, 1, 1))


@pytest.fixture
def customer_rules():
    return CustomerRules(as_of=dt.date(2026, 1, 1))
