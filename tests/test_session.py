"""Settings given at submit time win; shared storage is required off the local master."""

import os
import subprocess
import sys

import pytest

from racelake import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
from racelake.session import get_session
s = get_session('local[1]', 3)
print('GOT', s.conf.get('spark.sql.files.maxPartitionBytes'), s.conf.get('spark.sql.session.timeZone'),
      s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.sql.adaptive.coalescePartitions.minPartitionSize'))
"""


def test_submitted_settings_win():
    env = os.environ | {"PYTHONPATH": ROOT, "PYSPARK_SUBMIT_ARGS":
                        "--conf spark.sql.files.maxPartitionBytes=64m --conf spark.sql.session.timeZone=Europe/Berlin "
                        "pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", CODE], env=env, capture_output=True, text=True, timeout=120).stdout
    assert "GOT 64m Europe/Berlin 3 256k" in out


class _Fake:
    def __init__(self, **conf):
        self.values = conf
        self.conf = self

    def get(self, key, default=None):
        return self.values.get(key, default)

    class sparkContext:  # noqa: N801
        @staticmethod
        def getCheckpointDir():
            return None

        @staticmethod
        def getConf():
            return {}


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_cluster_without_shared_folder_raises(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(_Fake(**{"spark.master": master}))


def test_configured_folder_is_used():
    fake = _Fake(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs://x/y/"})
    assert session.checkpoint_dir(fake) == "hdfs://x/y"
