import os
import shutil
import tempfile

import pytest

from retentio import session
from retentio.plans.registry import model_for
from retentio.sources.adapter import StoredModel

SF = "/root/testdata/sf0.001"


@pytest.fixture
def folder():
    out = tempfile.mkdtemp(prefix="/tmp/retentio-input-")
    for f in os.listdir(SF):
        shutil.copy(f"{SF}/{f}", out)
        os.chmod(f"{out}/{f}", 0o644)
    return out


def test_a_changed_input_gives_a_new_model(spark, folder):
    m = model_for(spark, folder)
    n = m.orders().count()
    assert model_for(spark, folder) is m  # the same state of the input: nothing is built again
    half = spark.read.parquet(f"{SF}/orders.parquet").where("o_orderkey % 2 = 0").toPandas()
    os.remove(f"{folder}/orders.parquet")
    half.to_parquet(f"{folder}/orders.parquet", coerce_timestamps="us")
    again = model_for(spark, folder)
    assert again.base != m.base and 0 < again.orders().count() < n


def test_a_half_written_view_is_built_again(spark, folder):
    m = model_for(spark, folder)
    n = m.users().count()
    os.remove(f"{m.base}/users/_SUCCESS")
    part = next(f for f in os.listdir(f"{m.base}/users") if f.endswith(".parquet"))
    os.remove(f"{m.base}/users/{part}")
    fresh = StoredModel(m.t, m.base)
    assert fresh.users().count() == n
    assert not [f for f in os.listdir(m.base) if f.startswith(".staged")]


def test_no_local_scratch_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())
