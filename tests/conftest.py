import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.01"
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from reviewguard.session import get_session
    s = get_session("local[8]", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def built(spark):
    """Registered queries on the small tables, built once for all tests."""
    import __spark_entry__ as E
    made, queries = {}, E.queries()

    def get(name):
        if name not in made:
            made[name] = queries[name](spark, SF_SMALL)
        return made[name]
    return get
