"""Exact duplicates by distributed most-significant-first radix partitioning.

Documents start in one group. Each round splits every group by the next bytes
of the normalized text, so the group key is (group, bytes) and no digest decides
equality. A document alone in its part is unique; a part whose text has ended
is a group of equal documents; the others go on. The stretch of bytes grows
sixteenfold per round, so the rounds are logarithmic in the longest text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from docloom.llm.common import SPACE, Scratch, text_or_empty

FIRST_BYTES = 64
GROWTH = 16


def _normal(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE + "+", "")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` per row of ``docs``.

    Texts are equal when identical without white space; a null text equals the
    empty one. The row with the most code points, then the smallest doc_id
    (null last) stays. Of rows that repeat the id that stays, one stays.
    ``text_sha256`` is that of the normalized text. With ``carry`` each row of
    ``docs`` comes along as the struct ``row``. An empty table gives an empty result.

    Groups are counted with map-side combining, and the join that hands the
    new group to its rows reads written tables, so a hot group is split by
    adaptive skew handling. Texts move once in the first round and then only
    those still in a group.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact")
    active = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.length(text_or_empty(text)).alias("_chars"),
        F.lit(0).cast("long").alias("_group"),
        F.struct(*[docs[c] for c in docs.columns]).alias("row") if carry else F.col(text).alias("_text"),
    )
    extra = ["row"] if carry else []
    body = F.col(f"row.{text}") if carry else F.col("_text")
    done, offset, width, number = [], 0, FIRST_BYTES, 0
    while True:
        normal = _normal(body)
        cut = active.withColumn("_part", F.substring(normal.cast("binary"), offset + 1, width))
        groups = (
            cut.groupBy("_group", "_part")
            .agg(
                F.count(F.lit(1)).alias("group_size"),
                F.min(F.struct((-F.col("_chars")).alias("c"), F.col("doc_id").isNull().alias("n"), "doc_id")).alias("_best"),
            )
            .where(F.col("group_size") > 1)
            .select(
                "_group", "_part", "group_size", F.col("_best.doc_id").alias("keep_id"),
                F.monotonically_increasing_id().alias("_next"),
                (F.octet_length("_part") < width).alias("_ended"),
            )
        )
        groups = scratch.table(groups, f"groups{number}")
        split = cut.withColumn("_sha", F.sha2(normal, 256)).join(groups.hint("merge"), ["_group", "_part"], "left").select(
            "doc_id", "_chars", F.col("_next").alias("_group"), "_sha", "group_size", "keep_id",
            F.coalesce("_ended", F.lit(True)).alias("_ended"),
            *extra,
            *([] if carry else [F.when(~F.coalesce("_ended", F.lit(True)), F.col("_text")).alias("_text")]),
        )
        split = scratch.table(split, f"round{number}")
        single = F.col("group_size").isNull()
        done.append(
            split.where("_ended").select(
                "doc_id",
                F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                F.lit(number).alias("_round"), "_group", F.col("_sha").alias("text_sha256"), *extra,
            )
        )
        if groups.where(~F.col("_ended")).isEmpty():
            break
        active = split.where(~F.col("_ended")).select("doc_id", "_chars", "_group", *(extra or ["_text"]))
        offset, width, number = offset + width, width * GROWTH, number + 1
    rows = reduce(DataFrame.unionByName, done)
    alone = F.col("group_size") == 1
    winner = F.col("keep_id").eqNullSafe(F.col("doc_id"))
    first = F.row_number().over(Window.partitionBy("_round", "_group").orderBy("text_sha256")) == 1
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256", *extra]
    # One candidate per group, unless rows repeat its id: this shuffles few rows.
    candidates = rows.where(~alone & winner).withColumn("kept", first)
    others = rows.where(alone | ~winner).withColumn("kept", alone)
    return others.select(*columns).unionByName(candidates.select(*columns))


def drop_exact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each distinct text, with all its columns."""
    return exact_groups(docs, doc_id, text, carry=True).where("kept").select("row.*")
