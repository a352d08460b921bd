import pytest

from mesada.llm.common import _one_machine, shared_dir


class Conf(dict):
    pass


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder


class Session:
    def __init__(self, master, conf=(), folder=None):
        self.conf, self.sparkContext = Conf(conf), Context(master, folder)


def test_a_local_folder_is_refused_on_a_cluster():
    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[3,2,900]"):
        assert not _one_machine(master)
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(Session(master))
        assert shared_dir(Session(master, {"spark.checkpoint.dir": "hdfs://x/y"})) == "hdfs://x/y"
        assert shared_dir(Session(master, folder="hdfs://x/z")) == "hdfs://x/z"
    assert "checkpoint-" in shared_dir(Session("local[4]"))
