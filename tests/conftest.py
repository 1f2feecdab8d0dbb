import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from retentio.session import get_session
    s = get_session("local[2]", app="retentio-tests", shuffle_partitions=8)
    yield s


class FakeModel:
    """Logical views given directly as DataFrames (hand-made trap rows)."""

    def __init__(self, spark, **views):
        self._v = views
        self.t = {}
        self._spark = spark

    @property
    def spark(self):
        return self._spark

    def __getattr__(self, name):
        v = self.__dict__.get("_v", {})
        if name in v:
            return lambda: v[name]
        raise AttributeError(name)
