"""The shared-folder rule: read spark.checkpoint.dir from the session; only
when neither it nor the context's checkpoint dir is set, make a local one."""

from __future__ import annotations

import pytest

from staylens.session import ensure_checkpoint_dir, shared_path


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        assert key == "spark.checkpoint.dir"
        return self.value if self.value is not None else default


class _Context:
    master = "local[2]"

    def __init__(self, ckpt=None):
        self.ckpt = ckpt

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, d):
        self.ckpt = d


class _Session:
    def __init__(self, conf_value=None, ckpt=None):
        self.conf = _Conf(conf_value)
        self.sparkContext = _Context(ckpt)


def test_uses_the_cluster_setting():
    s = _Session(conf_value="hdfs://shared/ckpt")
    assert ensure_checkpoint_dir(s) == "hdfs://shared/ckpt"
    assert s.sparkContext.ckpt == "hdfs://shared/ckpt"
    assert shared_path(s, "fact").startswith("hdfs://shared/ckpt/staylens/fact-")


def test_falls_back_to_the_context_checkpoint_dir():
    s = _Session(ckpt="hdfs://namenode/ckpt/123")
    assert ensure_checkpoint_dir(s) == "hdfs://namenode/ckpt/123"


def test_local_folder_only_when_unset():
    s = _Session()
    base = ensure_checkpoint_dir(s)
    assert base and s.sparkContext.ckpt == base


def test_no_local_folder_on_a_cluster():
    s = _Session()
    s.sparkContext.master = "spark://host:7077"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(s)
