import pytest

from trendloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]",
        "tests",
        spark__sql__shuffle__partitions=4,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__sql__debug__maxToStringFields=100000,
        spark__sql__maxMetadataStringLength=100000,
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Collected rows as sorted tuples, NULLs first."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        found = [tuple(r) for r in picked.collect()]
        return sorted(found, key=lambda r: [(v is not None, str(type(v)), v) for v in r])

    return collect
