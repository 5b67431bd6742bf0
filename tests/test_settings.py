import os

import pytest

from rowloom.session import clear_lineage, cut_lineage, shared_dir
from rowloom.settings import Settings


def test_from_env():
    s = Settings.from_env({"ROWLOOM_MIN_TEXT": "7", "ROWLOOM_PROVIDER": "x"})
    assert (s.min_text, s.provider, s.model) == (7, "x", "demo") and Settings.from_env({}) == Settings()


class _Session:
    """A session that only knows its master and settings."""

    def __init__(self, master, conf=None, own=None):
        self.sparkContext = self
        self.master, self.getCheckpointDir = master, lambda: own
        self.getConf = lambda: {"spark.checkpoint.dir": conf} if conf else {}


def test_shared_folder():
    assert shared_dir(_Session("spark://host:7077", "hdfs:///x")) == "hdfs:///x"
    assert shared_dir(_Session("yarn", None, "hdfs:///y")) == "hdfs:///y"
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1000]", "k8s://x"):
        with pytest.raises(RuntimeError):
            shared_dir(_Session(master))
    assert shared_dir(_Session("local[4]")) == shared_dir(_Session("local"))


def test_lineage_is_cleared(spark):
    cut = cut_lineage(spark.range(3))
    files = [f.removeprefix("file://") for f in cut.inputFiles()]
    assert cut.count() == 3 and files and clear_lineage(spark) >= 1
    assert not any(map(os.path.exists, files))
