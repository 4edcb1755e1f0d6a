import os

import pytest

from postpulse.session import dropping_staged, scratch_path, shared_dir, stage


def test_shared_folder_is_the_session_setting(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(shared_dir(spark))


class Bare:
    """A session whose cluster names no folder."""

    def __init__(self, master):
        self.conf, self.sparkContext, self.dir, self.master = self, self, None, master

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path


def test_shared_folder_without_a_setting():
    bare = Bare("local[2]")
    made = shared_dir(bare)
    assert os.path.isdir(made) and shared_dir(bare) == made
    assert scratch_path(bare, "x").startswith(made)
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(ValueError):
            shared_dir(Bare(master))


def test_staged_tables_go_with_their_block(spark):
    with dropping_staged(spark):
        outer = stage(spark.range(3), "outer")
        with dropping_staged(spark):
            inner = stage(spark.range(4), "inner")
            assert inner.count() == 4
        assert outer.count() == 3
        folders = [rows.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0] for rows in (outer, inner)]
        assert [os.path.exists(folder) for folder in folders] == [True, False]
    assert not os.path.exists(folders[0])


def test_staged_rows_have_a_known_size(spark):
    rows = stage(spark.range(10), "rows")
    assert rows.count() == 10
    assert rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 10_000
