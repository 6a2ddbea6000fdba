import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMOKE = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from spindex.session import local_session
    s = local_session(4, shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)


def collection(spark, bodies):
    """A collection (doc_id, name, body) from a list of texts, ids 0.."""
    rows = [(i, f"{i}.html", b) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "doc_id long, name string, body string")
