import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from kestrel.session import get_session
    scratch = tempfile.mkdtemp(prefix="kestrel-test-")
    s = get_session("local[*]", shuffle_partitions=8,
                    extra={"spark.sql.warehouse.dir": f"{scratch}/warehouse",
                           "spark.checkpoint.dir": f"{scratch}/shared"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all when none)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((x is None, x) for x in t))
