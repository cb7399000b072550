from types import SimpleNamespace

import pytest

from harvestry.session import CHECKPOINT_DIR, cut_lineage, scratch_path, shared_root, store


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(master, setting=None, folder=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: setting if key == CHECKPOINT_DIR else default),
        sparkContext=Context(master, folder))


def test_the_setting_names_the_folder():
    cluster = session("yarn", "hdfs:///shared")
    assert shared_root(cluster) == "hdfs:///shared"
    assert cluster.sparkContext.folder == "hdfs:///shared"
    assert scratch_path(cluster, "x").startswith("hdfs:///shared/harvestry/x-")


def test_a_cluster_without_the_setting_is_refused():
    with pytest.raises(RuntimeError, match=CHECKPOINT_DIR):
        shared_root(session("spark://host:7077", folder="/tmp/x"))


def test_a_local_master_finds_a_folder():
    assert shared_root(session("local[2]", folder="file:/tmp/y")) == "file:/tmp/y"
    fresh = session("local[2]")
    assert shared_root(fresh) == fresh.sparkContext.folder == shared_root(fresh)


def test_cut_and_stored_frames_keep_rows_and_schema(spark):
    frame = spark.range(100).selectExpr("id", "array(id) AS a")
    for kept in (cut_lineage(frame), store(frame, "t")):
        assert kept.schema.simpleString() == frame.schema.simpleString()
        assert sorted(kept.collect()) == sorted(frame.collect())


def test_tables_after_the_first_run_no_statement(spark, monkeypatch):
    store(spark.range(1), "t")
    monkeypatch.setattr(type(spark), "sql", lambda *a, **b: pytest.fail("a statement ran"))
    assert store(spark.range(5), "t").count() == 5
