from __future__ import annotations

import os
from types import SimpleNamespace

import pytest

from netdays import session


class FakeContext:
    def __init__(self, folder=None, master="local[8]"):
        self.folder = folder
        self.master = master

    def getCheckpointDir(self):  # noqa: N802 - the name Spark gives it
        return self.folder

    def setCheckpointDir(self, folder):  # noqa: N802
        self.folder = folder


def fake(named=None, in_use=None, master="local[8]"):
    conf = SimpleNamespace(get=lambda key, default: named if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=FakeContext(in_use, master))


def test_the_named_folder_is_used():
    spark = fake(named="hdfs://shared/scratch")
    assert session.scratch_folder(spark) == "hdfs://shared/scratch"
    assert spark.sparkContext.folder == "hdfs://shared/scratch"
    assert session.new_scratch_path(spark, "x").startswith("hdfs://shared/scratch/x-")


def test_a_folder_in_use_is_kept():
    spark = fake(named="hdfs://shared/scratch", in_use="hdfs://shared/scratch/own")
    session.scratch_folder(spark)
    assert spark.sparkContext.folder == "hdfs://shared/scratch/own"


def test_only_without_a_name_a_folder_is_made():
    spark = fake()
    folder = session.scratch_folder(spark)
    assert os.path.isdir(folder)
    assert session.scratch_folder(spark) == folder


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_executors_elsewhere_need_a_named_folder(master):
    with pytest.raises(ValueError):
        session.scratch_folder(fake(master=master))


def test_written_rows_have_a_known_size(spark):
    rows = session.written(spark.range(1000).selectExpr("id", "id * 2 AS twice"), "rows")
    assert rows.count() == 1000
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    assert size < 100_000


def test_only_small_tables_are_broadcast(spark):
    """Files of two million bytes, whose keys take many times as much when they are hashed."""
    session.configure(spark)
    nothing = [f"cast(null AS string) AS empty{n}" for n in range(6)]
    many = session.written(spark.range(400_000).selectExpr("id", *nothing), "many")
    few = session.written(spark.range(25).selectExpr("id", "id * 2 AS twice"), "few")
    rows = session.written(spark.range(3_000_000).selectExpr("id", "id * 3 AS amount"), "amounts")
    plan = lambda df: df._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan(rows.join(many, "id"))
    assert "BroadcastHashJoin" in plan(rows.join(few, "id"))


@pytest.mark.parametrize(("given", "kept"), [("-1", "-1"), ("64k", "64k"), ("10m", str(256 << 10))])
def test_smaller_broadcasts_stay_as_they_are_set(spark, given, kept):
    before = spark.conf.get(session.BROADCAST)
    try:
        spark.conf.set(session.BROADCAST, given)
        session.configure(spark)
        assert spark.conf.get(session.BROADCAST) == kept
    finally:
        spark.conf.set(session.BROADCAST, before)
