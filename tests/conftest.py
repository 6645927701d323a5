import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from adstrata import session

    home = tmp_path_factory.mktemp("spark")
    spark = session.build(
        "adstrata-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(home / "warehouse"),
        spark__checkpoint__dir=str(home / "shared"),
        spark__driver__memory="4g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples of the given columns."""

    def collect(df, *columns):
        names = columns or df.columns
        found = [tuple(row[name] for name in names) for row in df.select(*names).collect()]
        return sorted(found, key=lambda row: tuple((value is None, str(value)) for value in row))

    return collect
