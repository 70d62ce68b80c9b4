import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidegate.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    settings = {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    }
    built = session("tests", "local[8]", **settings)
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()


@pytest.fixture
def rows(spark):
    """Build a frame from tuples and a schema string."""
    return lambda data, schema: spark.createDataFrame(data, schema)


def values(df, *columns):
    """Sorted tuples of the given (or all) columns."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def one(df):
    """The single row as a dict."""
    (row,) = df.collect()
    return row.asDict()
