"""The shared folder."""
from types import SimpleNamespace

import pytest

from llm.common import shared_folder


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder, self.set = master, folder, None

    def getConf(self):
        return {"spark.checkpoint.dir": self.folder} if self.folder else {}

    def getCheckpointDir(self):
        return self.set

    def setCheckpointDir(self, folder):
        self.set = folder


def test_a_cluster_must_name_the_folder():
    for master in ("spark://host:7077", "yarn", "k8s://host", "local-cluster[3,2,3000]"):
        with pytest.raises(RuntimeError):
            shared_folder(SimpleNamespace(sparkContext=Context(master)))
        assert shared_folder(SimpleNamespace(sparkContext=Context(master, "hdfs://shared"))) == "hdfs://shared"
    for master in ("local", "local[8]", "local[*]", "local[2,4]"):
        assert shared_folder(SimpleNamespace(sparkContext=Context(master))).startswith("/")
