import pytest

from pennyflow.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        spark__master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def events(spark):
    """Make an event log from (user, type, time[, source[, context]]) rows; created_at is the time."""
    from pennyflow import schemas as S

    def make(rows):
        full = []
        for row in rows:
            user, kind, t, source, context = (*row, *("INTERNAL_SERVICES", "")[len(row) - 3 :])
            full.append((user, kind, t, source, t, t, context))
        return spark.createDataFrame(full, S.EVENTS)

    return make


@pytest.fixture
def payments(spark):
    """Make money movements from (user, kind, amount in whole currency, time) rows."""
    from pennyflow import schemas as S

    def make(rows):
        full = [
            (u, f"acc-{u}", kind, int(a * 10_000), "HUNDREDTH_CENT", "ZAR", t, t, t) for u, kind, a, t in rows
        ]
        return spark.createDataFrame(full, S.BEHAVIOUR)

    return make
