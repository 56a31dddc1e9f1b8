import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from linfold.session import get_spark
    session = get_spark("local[*]", "linfold-tests", {"spark.sql.shuffle.partitions": "8"})
    yield session
    session.stop()
