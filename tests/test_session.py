from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from docloom import session
from docloom.session import broadcast_if_small, cut_lineage, spread


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_only_measured_small_sides_are_broadcast(spark):
    small = spark.range(100).withColumnRenamed("id", "k")
    big = spark.range(1000)
    joined = big.join(broadcast_if_small(small), F.col("id") == F.col("k"))
    assert "strategy=broadcast" in plan(joined)
    joined = big.join(broadcast_if_small(small, max_bytes=1000), F.col("id") == F.col("k"))
    assert "strategy=broadcast" not in plan(joined)


def test_cut_lineage_is_read_from_files(spark):
    df = cut_lineage(spark.range(10).withColumn("r", F.rand()))
    assert "LogicalRDD" in plan(df)
    assert df.collect() == df.collect()


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master, conf=None):
        self.sparkContext, self.values = Context(master), conf or {}
        self.conf = self

    def get(self, name, default):
        return self.values.get(name, default)


def test_checkpoint_folder(tmp_path):
    shared = Session("spark://host", {"spark.checkpoint.dir": "hdfs://shared/cp"})
    session._ensure_checkpoint_dir(shared)
    assert shared.sparkContext.folder == "hdfs://shared/cp"
    local = Session("local[2]")
    session._ensure_checkpoint_dir(local)
    assert local.sparkContext.folder
    with pytest.raises(RuntimeError):
        session._ensure_checkpoint_dir(Session("spark://host"))


def test_spread_leaves_wide_inputs_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(10, numPartitions=1)).rdd.getNumPartitions() == cores
    wide = spark.range(100, numPartitions=cores + 3)
    assert spread(wide) is wide
