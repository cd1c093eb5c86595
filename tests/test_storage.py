import os

import pytest

from siltmill import storage


class Unset:
    """A session of a machine that names no shared folder."""

    def __init__(self, spark):
        self.sparkContext, self.conf = spark.sparkContext, self

    def get(self, key, default=None):
        return default


def test_tables_go_to_the_shared_folder(spark):
    df = spark.range(100).repartition(4)
    assert storage.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    out = storage.written(df, "t", narrow=True)
    assert out.count() == 100 and out.inputFiles()[0].startswith("file:") and storage.shared_dir(spark) in out.inputFiles()[0]


def test_a_session_without_a_folder_gets_one(spark):
    assert storage.shared_dir(Unset(spark)) == storage.shared_dir(Unset(spark)) != storage.shared_dir(spark)


def test_executors_elsewhere_need_a_shared_folder(spark):
    far = Unset(spark)
    for master in ("spark://host:7077", "yarn", "k8s://host", "local-cluster[2,1,1024]"):
        far.sparkContext = type("Context", (), {"master": master, "applicationId": "far"})
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            storage.shared_dir(far)


def test_scratch_removes_what_it_wrote(spark):
    before = storage.written(spark.range(3), "before")
    with storage.scratch():
        inside = storage.written(spark.range(3), "inside")
        files = inside.inputFiles()
    assert before.count() == 3 and not any(os.path.exists(f.removeprefix("file://")) for f in files)


def test_removed_tables_do_not_stop_the_driver(spark):
    storage._remove(spark, storage.new_path(spark, "never-written"))
    storage._remove(None, "gone")
