"""Scratch data goes to the folder that the session names."""

from types import SimpleNamespace

import pytest

from measure_rollup.sources import new_folder, settle, shared


def test_folder_of_the_session_is_used(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    one, two = new_folder(spark, "x"), new_folder(spark, "x")
    assert one.startswith(root) and one != two


def test_settled_data_is_read_back_not_recomputed(spark):
    frame = spark.range(10).selectExpr("id", "rand() as r")
    settled = settle(frame)
    assert sorted(settled.collect()) == sorted(settled.collect())
    assert "ExistingRDD" in settled._jdf.queryExecution().executedPlan().toString()


class _Context:
    def __init__(self, master, setting=None):
        self.master, self._setting, self.folder = master, setting, None

    def getConf(self):
        return SimpleNamespace(get=lambda key: self._setting)

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def _session(context):
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: default))


def test_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared._root(_session(_Context("yarn")))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared._root(_session(_Context("local-cluster[2,1,1024]")))


def test_cluster_setting_wins():
    assert shared._root(_session(_Context("yarn", "hdfs:///shared/"))) == "hdfs:///shared"


def test_local_session_gets_a_folder_of_its_own():
    context = _Context("local[2]")
    root = shared._root(_session(context))
    assert context.folder == root and shared._root(_session(context)) == root
