from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from millrace.session import local_session  # noqa: E402
from millrace.sources.lines import collection  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, partitions=2, app="millrace-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return TESTDATA


@pytest.fixture(scope="session")
def make(spark):
    """``make(rows, ddl)``: a table with ``seq``."""
    return lambda rows, schema: collection(spark, rows, schema)


@pytest.fixture(scope="session")
def rows_of():
    """The rows of a result as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


LOGIN = "user_id LONG, ip STRING, event_type STRING, event_time LONG"
START = 1_700_000_000
# Chained failures, a gap of exactly the limit, a success in between, two failures in one second.
LOGINS_1 = [
    (31, "10.1.0.7", "fail", START + 5), (31, "10.1.0.7", "fail", START + 6), (31, "10.1.0.8", "fail", START + 7),
    (31, "10.1.0.8", "fail", START + 9), (32, "10.2.0.1", "fail", START + 20), (32, "10.2.0.1", "success", START + 21),
    (32, "10.2.0.1", "fail", START + 21), (32, "10.2.0.2", "fail", START + 21), (33, "10.3.0.1", "fail", START + 30),
]
# One strict pair, with or without keys; the last gap is the limit.
LOGINS_2 = [
    (41, "10.4.0.1", "fail", START + 2), (41, "10.4.0.1", "success", START + 3), (41, "10.4.0.2", "fail", START + 4),
    (42, "10.4.0.9", "success", START + 5), (42, "10.4.0.3", "fail", START + 50), (42, "10.4.0.4", "fail", START + 51),
    (42, "10.4.0.5", "fail", START + 53),
]
ORDER = "order_id LONG, event_type STRING, event_time LONG"
# Paid late, paid in time, never paid.
ORDERS = [
    (71, "create", START + 100), (72, "create", START + 110), (72, "other", START + 115), (73, "create", START + 120),
    (72, "pay", START + 400), (71, "pay", START + 1300),
]
# The second reading of probe_c stands exactly on the deadline of the first.
SENSOR_LINES = [
    f"probe_a, {START + 12}, 35.5", f"probe_b, {START + 13}, 12.25", f"probe_c, {START + 15}, 36.0",
    f"probe_c, {START + 17}, 24.5", f"probe_c, {START + 26}, 33.0",
]


@pytest.fixture(scope="session")
def logins_1(make):
    return make(LOGINS_1, LOGIN)


@pytest.fixture(scope="session")
def logins_2(make):
    return make(LOGINS_2, LOGIN)


@pytest.fixture(scope="session")
def orders(make):
    return make(ORDERS, ORDER)


@pytest.fixture(scope="session")
def sensor_lines(make):
    return make([(line,) for line in SENSOR_LINES], "value STRING")
