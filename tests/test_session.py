"""Checkpoint-folder policy: read from the session; never a local folder on a cluster."""

import os

import pytest

from subpanel.session import checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        if key in self.values:
            return self.values[key]
        if default is None and not isinstance(self, _SessionConf):
            return default
        raise KeyError(key)


class _SessionConf(_Conf):
    def get(self, key, default=None):
        if key in self.values:
            return self.values[key]
        raise KeyError(key)


class _SC:
    def __init__(self, master, conf):
        self.master = master
        self._conf = conf
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def getConf(self):
        return _Conf(self._conf)

    def setCheckpointDir(self, d):
        self.dir = d


class _Spark:
    def __init__(self, master, conf):
        self.sparkContext = _SC(master, conf)
        self.conf = _SessionConf({})


def test_cluster_without_setting_refuses_local_folder():
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Spark("yarn", {}))


def test_setting_is_read_from_the_session():
    s = _Spark("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert checkpoint_dir(s) == "hdfs:///shared/ckpt"


def test_local_mode_gets_a_scratch_folder():
    assert checkpoint_dir(_Spark("local[2]", {})).startswith(os.environ.get("TMPDIR", "/tmp"))
