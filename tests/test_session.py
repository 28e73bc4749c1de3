import pytest

from tessera.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _SC:
    def __init__(self, master, current=None, conf=None):
        self.master, self.current, self._conf, self.set_to = master, current, _Conf(conf or {}), None

    def getCheckpointDir(self):
        return self.current

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self.set_to = d


class _Spark:
    def __init__(self, sc, conf=None):
        self.sparkContext, self.conf = sc, _Conf(conf or {})


def test_cluster_without_checkpoint_dir_is_refused():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Spark(_SC("spark://head:7077")))


def test_configured_shared_folder_is_used():
    sc = _SC("spark://head:7077")
    assert ensure_checkpoint_dir(_Spark(sc, {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})) == "hdfs:///shared/ckpt"
    assert sc.set_to == "hdfs:///shared/ckpt"


def test_existing_checkpoint_dir_is_kept():
    sc = _SC("yarn", current="hdfs:///already")
    assert ensure_checkpoint_dir(_Spark(sc)) == "hdfs:///already" and sc.set_to is None
