"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# A side is hinted for broadcast only after its encoded size was measured
# to be at most this many bytes.
BROADCAST_BYTES = 32 * 1024 * 1024


def build_session(app: str = "docloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are designed for.

    On a cluster leave ``master`` unset: it and the sizing come from
    spark-submit, and only the planning switches below are added.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # A skewed join is split even when that costs one more exchange.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Checkpoint files go when nothing refers to them any more.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for name, value in {**defaults, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="docloom-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that all executors see, below the checkpoint folder."""
    _ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialize ``df`` in the shared checkpoint folder.

    Later jobs read the files, so a lost executor does not replay the steps
    before, and loops keep a constant plan size.
    """
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint ``df`` for broadcast if its measured size allows, else leave it.

    Without the hint Spark plans a shuffle join, whose skew AQE splits. Call
    it on materialized data: it runs one aggregation over ``df``.
    """
    row = df.agg(
        F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("long")), F.lit(0)).alias("b"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    return F.broadcast(df) if row["b"] + 64 * row["n"] <= max_bytes else df


def spread(df: DataFrame) -> DataFrame:
    """Redistribute a table scan that has fewer partitions than there are cores.

    For CPU-bound steps (tokenizing, Python decoding) over a few small files;
    a scan with enough partitions is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
