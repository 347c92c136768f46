"""Tables in the shared folder, and small helpers of the text operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: The white space of all operators here: blank and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"


def shared_root(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a local one only on a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="docloom-shared-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


class Scratch:
    """Intermediate tables of one operator call, in a fresh shared folder.

    A written table cuts the lineage: a lost executor only repeats the step
    that reads it. The result of an operator may read its last tables, so they
    stay until ``drop`` or until the folder is cleared.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.path = f"{shared_root(spark)}/docloom-{name}-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text, in order."""
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def spread_input(df: DataFrame) -> DataFrame:
    """Deal rows of a small scan over the cores before CPU-bound Python."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
