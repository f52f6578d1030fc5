"""Shared checkpoint folder and cluster settings (no cluster here: stub sessions)."""

from __future__ import annotations

import pytest

from dimflow.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf):
        self.master, self._conf, self.dir = master, conf, None

    def getCheckpointDir(self):
        return self.dir

    def getConf(self):
        return _Conf(self._conf)

    def setCheckpointDir(self, path):
        self.dir = path


class _Session:
    def __init__(self, master, conf=None):
        self.sparkContext = _Context(master, conf or {})
        self.conf = _Conf({})


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session("yarn"))


def test_cluster_uses_the_configured_shared_folder():
    session = _Session("spark://head:7077", {"spark.checkpoint.dir": "hdfs://nn/shared/ckpt"})
    assert ensure_checkpoint_dir(session) == "hdfs://nn/shared/ckpt"


def test_local_session_gets_a_local_folder_only_when_unset():
    assert ensure_checkpoint_dir(_Session("local[8]")).startswith("/")
    assert ensure_checkpoint_dir(_Session("local[8]", {"spark.checkpoint.dir": "/shared/x"})) == "/shared/x"


def test_cluster_conf_sizes_partitions_to_the_input():
    from dimflow.session import cluster_conf

    small, large = cluster_conf(1 << 30), cluster_conf(100 << 40)          # 1 GiB, 100 TiB
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert large["spark.sql.shuffle.partitions"] == "409600"               # 256 MiB each, however large the input
    assert large["spark.sql.adaptive.enabled"] == "true" and large["spark.sql.adaptive.skewJoin.enabled"] == "true"
