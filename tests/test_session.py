"""Where scratch data goes."""

from __future__ import annotations

import os

import pytest

from tierline.session import scratch_path, shared_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self):
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path


class _Session:
    def __init__(self, values):
        self.conf = _Conf(values)
        self.sparkContext = _Context()


def test_configured_folder_is_used_as_is():
    fake = _Session({"spark.checkpoint.dir": "hdfs://shared/ckpt/"})
    assert shared_dir(fake) == "hdfs://shared/ckpt"
    assert scratch_path(fake, "x").startswith("hdfs://shared/ckpt/tierline-scratch/x-")
    assert fake.sparkContext.dir is None  # nothing created on the cluster folder


def test_unset_folder_falls_back_once_and_is_reused():
    fake = _Session({})
    first = shared_dir(fake)
    assert os.path.isdir(first)
    assert shared_dir(fake) == first  # registered with the context, reused


def test_real_session_reads_its_setting(spark):
    assert shared_dir(spark)


@pytest.mark.parametrize("master", ["yarn", "spark://head:7077", "local-cluster[2,1,1024]", "k8s://https://host"])
def test_unset_folder_is_an_error_on_a_cluster(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(_Session({"spark.master": master}))


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_unset_folder_is_made_in_local_mode(master):
    assert os.path.isdir(shared_dir(_Session({"spark.master": master})))
