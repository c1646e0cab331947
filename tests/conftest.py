import pytest

from marlstone.session import build_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions="4",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


def rows(df):
    """Rows as plain tuples, in a fixed order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    """Text of the physical plan: the first one before the rows are asked for, the last one after."""
    return df._jdf.queryExecution().executedPlan().toString()
