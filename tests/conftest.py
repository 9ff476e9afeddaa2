import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from longitab.session import builder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = builder("tests", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}).master("local[8]").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples, so that order does not matter."""
    def get(df, *cols):
        got = [tuple(r) for r in (df.select(*[f"`{c}`" for c in cols]) if cols else df).collect()]
        return sorted(got, key=lambda r: tuple((v is None, str(v)) for v in r))
    return get
