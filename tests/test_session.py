"""The shared work folder: spark.checkpoint.dir first, quarry.work.dir next,
a local temporary folder only for local sessions, an error on a cluster."""

import pytest

from quarry.session import work_dir


class _Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class _Context:
    def __init__(self, master, conf=None, checkpoint=None):
        self.master, self._conf, self._ckpt = master, _Conf(conf or {}), checkpoint

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, path):
        self._ckpt = path


class _Session:
    def __init__(self, master, conf=None, session_conf=None, checkpoint=None):
        self.sparkContext = _Context(master, conf, checkpoint)
        self.conf = _Conf(session_conf or {})


def test_cluster_checkpoint_dir_wins():
    s = _Session("spark://cluster:7077", conf={"spark.checkpoint.dir": "hdfs://nn/shared/ckpt/"},
                 session_conf={"quarry.work.dir": "hdfs://nn/other"})
    assert work_dir(s) == "hdfs://nn/shared/ckpt"
    assert s.sparkContext.getCheckpointDir() == "hdfs://nn/shared/ckpt/checkpoints"


def test_work_dir_setting_when_no_checkpoint_dir():
    s = _Session("yarn", session_conf={"quarry.work.dir": "s3a://bucket/work"})
    assert work_dir(s) == "s3a://bucket/work"


def test_cluster_without_a_shared_folder_fails():
    with pytest.raises(RuntimeError):
        work_dir(_Session("yarn"))


def test_local_session_falls_back_to_tmp():
    s = _Session("local[2]")
    assert work_dir(s).startswith("/tmp/quarry-work-")
