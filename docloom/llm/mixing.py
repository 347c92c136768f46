"""Mixing sources to target weights.

Each source is cut into permuted blocks. A source's quota is a number of whole
passes over its blocks and one partial pass. A splitting tree divides the block
quotas of all sources among the output shards by multivariate hypergeometric
draws; the shards then take disjoint runs of each source's permuted blocks.

Everything is built-in DataFrame functions, and all randomness is a hash of the
seed and the row, so reruns agree. Only ``(id, size, source)`` is aggregated;
hot sources are combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from docloom.llm.common import WORD, Scratch, text_or_empty

#: Blocks of a source, cells of a block: documents per cell stay bounded to
#: source documents / 65,536, and few documents get few blocks.
BLOCKS = 256
DOCS_PER_PART = 64
MAX_REPEATS = 3
SHARDS = 16
#: Words of one written partition: some 25 MB of text.
PART_WORDS = 4_000_000
CYCLE = (5.0, 2.0, 1.0)


def cyclic_weights(sizes: DataFrame, cycle: tuple[float, ...] = CYCLE) -> DataFrame:
    """``sizes`` with ``weight``: the cycle repeated over sources by code point, null last."""
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    return sizes.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, cycle)), (F.row_number().over(order) - 1) % len(cycle) + 1)
    )


def water_fill(weighted: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``weighted`` with ``target``: weight shares of all words, capped, the excess reshared.

    Sources ordered by cap over weight hit their cap in that order; the first
    one that stays under fixes the level of all after it. One row per source.
    """
    order = Window.orderBy(F.expr("_cap / weight"), F.col("source").isNull(), "source")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    levels = weighted.withColumn("_cap", (max_repeats * F.col("source_size")).cast("double")).select(
        "*",
        (
            (F.sum(F.col("source_size").cast("double")).over(Window.partitionBy()) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
            / F.sum("weight").over(after)
        ).alias("_level"),
    )
    level = F.max(F.when(F.col("_level") * F.col("weight") <= F.col("_cap"), F.col("_level"))).over(Window.partitionBy())
    return (
        levels.withColumn("_level", level)
        .withColumn("target", F.least("_cap", F.coalesce(F.col("_level") * F.col("weight"), F.col("_cap"))))
        .drop("_cap", "_level")
    )


def _hash(seed: int, *columns: Column | str) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def shard_quotas(quotas: DataFrame, shards: int = SHARDS, seed: int = 7) -> DataFrame:
    """``(source_no, shard, n)`` from ``(source_no, n)``: exact quotas by the splitting tree.

    A node holds the block counts of all sources and splits them in two halves:
    every block in turn goes left with probability (free places on the left) /
    (blocks still to place), which draws from the multivariate hypergeometric
    distribution. ``shards`` must be a power of two. A node is one row: its
    size is the number of sources, which the caller's weights list.
    """
    levels = shards.bit_length() - 1
    if 1 << levels != shards:
        raise ValueError("shards must be a power of two")
    node = quotas.groupBy().agg(F.array_sort(F.collect_list(F.struct("source_no", "n"))).alias("_q")).select(
        F.lit(0).alias("shard"), F.expr("transform(_q, x -> x.source_no)").alias("_no"), F.expr("transform(_q, x -> x.n)").alias("_n")
    )
    for level in range(levels):
        left = F.expr(
            f"""aggregate(
              transform(_n, (n, s) -> named_struct('n', n, 's', s)),
              named_struct('m', aggregate(_n, 0L, (a, n) -> a + n),
                           'c', (aggregate(_n, 0L, (a, n) -> a + n) + 1) div 2,
                           'out', cast(array() AS array<bigint>)),
              (acc, x) -> aggregate(
                if(x.n > 0, sequence(1L, x.n), cast(array() AS array<bigint>)),
                named_struct('m', acc.m, 'c', acc.c, 'k', 0L, 'out', acc.out),
                (b, i) -> if(
                  pmod(xxhash64({seed}, {level}, shard, x.s, i), 1048576L) * b.m < b.c * 1048576L,
                  named_struct('m', b.m - 1, 'c', b.c - 1, 'k', b.k + 1, 'out', b.out),
                  named_struct('m', b.m - 1, 'c', b.c, 'k', b.k, 'out', b.out)),
                b -> named_struct('m', b.m, 'c', b.c, 'out', array_append(b.out, b.k))),
              acc -> acc.out)"""
        )
        split = node.withColumn("_left", left)
        halves = F.array(
            F.struct((2 * F.col("shard")).alias("shard"), F.col("_left").alias("n")),
            F.struct((2 * F.col("shard") + 1).alias("shard"), F.expr("zip_with(_n, _left, (a, b) -> a - b)").alias("n")),
        )
        node = split.select("_no", F.explode(halves).alias("_h")).select(
            F.col("_h.shard").cast("int").alias("shard"), "_no", F.col("_h.n").alias("_n")
        )
    return node.select("shard", F.explode(F.arrays_zip("_no", "_n")).alias("_x")).select(
        F.col("_x._no").alias("source_no"), "shard", F.col("_x._n").alias("n")
    )


def _partial_parts(parts: DataFrame, by: list[str], part: str) -> DataFrame:
    """Parts in order with the words before them: whole up to ``room``, then one at the edge."""
    order = Window.partitionBy(*by).orderBy("_order", part)
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        parts.withColumn("_before", before)
        .withColumn("_whole", (F.col("_room") > 0) & (F.col("_before") + F.col("size") <= F.col("_room")))
        .withColumn("_edge", ~F.col("_whole") & (F.col("_before") < F.col("_room")))
    )


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    max_repeats: int = MAX_REPEATS,
    shards: int = SHARDS,
    seed: int = 7,
    carry: bool = False,
) -> DataFrame:
    """Where each row of ``docs`` goes in the mix.

    ``weights`` is ``(source, weight)`` with positive weights, one row per
    source; by default the weights 5, 2, 1 repeat over the sources. Returns
    ``(doc_id, source, size, source_size, target, taken, shards)``: ``shards``
    lists the output shard of each repeat, ``taken`` is size times repeats.
    With ``carry`` the row of ``docs`` comes along as the struct ``row``.

    Whole passes, whole blocks and whole cells are taken in permuted order; in
    the cell at the edge the longest documents that still fit are taken, and
    one more if that comes nearer to the target. Rows that agree in id and size
    there are taken together.

    Null texts have size 0, a null source is a source of its own, repeated
    rows are separate documents, and an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    size = F.regexp_count(text_or_empty(text), F.lit(WORD + "+")).cast("long")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.alias("size"))
    rows = scratch.table(rows.withColumn("_h", _hash(seed, "doc_id", "size")), "rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_docs"))
    if weights is None:
        weighted = cyclic_weights(sizes)
    else:
        given = weights.select(F.col("source").alias("_s"), F.col("weight").cast("double").alias("weight"))
        weighted = sizes.join(given, sizes["source"].eqNullSafe(given["_s"])).drop("_s")
    n_blocks = F.greatest(F.lit(1), F.least(F.lit(BLOCKS), F.ceil(F.col("_docs") / DOCS_PER_PART)))
    n_cells = F.greatest(F.lit(1), F.least(F.lit(BLOCKS), F.ceil(F.col("_docs") / (DOCS_PER_PART * F.col("_blocks")))))
    plan = (
        water_fill(weighted, max_repeats)
        .withColumn("_no", F.row_number().over(Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))))
        .withColumn("_blocks", n_blocks.cast("long"))
        .withColumn("_cells", n_cells.cast("long"))
        .withColumn("_full", F.when(F.col("source_size") > 0, F.floor(F.expr("target / source_size"))).otherwise(0).cast("int"))
        .withColumn("_room", F.col("target") - F.col("_full") * F.col("source_size"))
        .select(F.col("source").alias("_source"), "source_size", "target", "_no", "_blocks", "_cells", "_full", "_room")
    )
    plan = scratch.table(plan, "plan")

    def located(frame: DataFrame) -> DataFrame:
        # One row per source: Spark broadcasts the plan while its files are small.
        return frame.join(plan, F.col("source").eqNullSafe(F.col("_source"))).withColumns({
            "_block": F.pmod("_h", "_blocks"), "_cell": F.pmod(F.xxhash64("_h"), "_cells"),
        })

    narrow = located(rows)
    sums = narrow.groupBy("_no", "_full", "_room", "_block").agg(F.sum("size").alias("size"))
    sums = sums.withColumn("_order", _hash(seed + 1, "_no", "_block"))
    blocks = scratch.table(_partial_parts(sums, ["_no"], "_block"), "blocks")
    edge = blocks.where("_edge").select("_no", "_block", (F.col("_room") - F.col("_before")).alias("_left"))
    in_edge = narrow.join(edge, ["_no", "_block"]).select("_no", "_block", "_cell", "_h", "doc_id", "size", F.col("_left").alias("_room"))
    in_edge = scratch.table(in_edge, "in_edge")
    cell_sums = in_edge.groupBy("_no", "_room", "_cell").agg(F.sum("size").alias("size"))
    cell_sums = cell_sums.withColumn("_order", _hash(seed + 2, "_no", "_cell"))
    cells = scratch.table(_partial_parts(cell_sums, ["_no"], "_cell"), "cells")
    edge_cells = cells.where("_edge").select("_no", "_cell", (F.col("_room") - F.col("_before")).alias("_left"))
    last = scratch.table(_fill_last_cell(in_edge.join(edge_cells, ["_no", "_cell"])), "last")
    places = scratch.table(_places(blocks, shards, seed), "places")

    if carry:
        rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.alias("size"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
        rows = rows.withColumn("_h", _hash(seed, "doc_id", "size"))
    marked = (
        located(rows)
        .join(places, ["_no", "_block"], "left")
        .join(cells.select("_no", "_cell", F.col("_whole").alias("_cell_whole")), ["_no", "_cell"], "left")
        .join(last.select("_no", F.col("_h"), F.lit(True).alias("_picked")), ["_no", "_h"], "left")
    )
    partial = F.coalesce("_block_whole", F.lit(False)) | (
        F.coalesce("_block_edge", F.lit(False)) & (F.coalesce("_cell_whole", F.lit(False)) | F.coalesce("_picked", F.lit(False)))
    )
    repeats = F.col("_full") + partial.cast("int")
    out = marked.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("size") * repeats).cast("long").alias("taken"),
        F.slice(F.coalesce("_shards", F.array().cast("array<int>")), F.lit(1), repeats).alias("shards"),
        *(["row"] if carry else []),
    )
    return out


def _fill_last_cell(rows: DataFrame) -> DataFrame:
    """``(_no, _h)`` of the documents that fill the room in each source's last cell.

    A cell is a 65,536th of a large source, so its rows fit one array.
    """
    units = rows.groupBy("_no", "_left", "_h").agg(F.sum("size").alias("size"))
    packed = units.groupBy("_no", "_left").agg(F.sort_array(F.collect_list(F.struct("size", "_h")), asc=False).alias("_d"))
    filled = packed.withColumn(
        "_fit",
        F.expr(
            "aggregate(_d, named_struct('room', _left, 'in', cast(array() AS array<boolean>)), "
            "(a, x) -> named_struct('room', if(x.size <= a.room, a.room - x.size, a.room), 'in', array_append(a.in, x.size <= a.room)))"
        ),
    ).withColumn(
        "_more",
        F.expr(
            "array_max(filter(transform(_d, (x, i) -> named_struct('s', -x.size, 'i', i)), "
            "y -> NOT get(_fit.in, y.i) AND -y.s < 2 * _fit.room)).i"
        ),
    )
    return (
        filled.select("_no", F.expr("filter(transform(_d, (x, i) -> if(get(_fit.in, i) OR i <=> _more, x._h, NULL)), h -> h IS NOT NULL)").alias("_hs"))
        .select("_no", F.explode("_hs").alias("_h"))
    )


def _places(blocks: DataFrame, shards: int, seed: int) -> DataFrame:
    """``(_no, _block, _block_whole, _block_edge, _shards)``: the shard of each pass, the partial one last."""
    partial = (F.col("_whole") | F.col("_edge")).cast("int")
    units = blocks.select(
        "_no", "_block", "_whole", "_edge", F.explode(F.expr("sequence(0, _full)")).alias("_pass"), "_full", partial.alias("_p")
    ).where("_pass < _full OR _p = 1")
    order = Window.partitionBy("_no").orderBy(_hash(seed + 3, "_no", "_block", "_pass"), "_block", "_pass")
    numbered = units.withColumn("_unit", F.row_number().over(order))
    quotas = numbered.groupBy(F.col("_no").alias("source_no")).agg(F.count(F.lit(1)).alias("n"))
    ends = shard_quotas(quotas, shards, seed).withColumn("_end", F.sum("n").over(Window.partitionBy("source_no").orderBy("shard")))
    runs = ends.select(F.col("source_no").alias("_no"), "shard", (F.col("_end") - F.col("n")).alias("_from"), "_end").where("_end > _from")
    dealt = numbered.join(runs, "_no").where("_unit > _from AND _unit <= _end")
    return dealt.groupBy("_no", "_block", F.col("_whole").alias("_block_whole"), F.col("_edge").alias("_block_edge")).agg(
        F.expr("transform(array_sort(collect_list(struct(_pass, shard))), x -> x.shard)").alias("_shards")
    )


def mixed_rows(docs: DataFrame, seed: int = 7, text: str = "text", shards: int = SHARDS, part_words: int = PART_WORDS, **options) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are taken, each in its output shard, shuffled there.

    Every partition holds rows of one shard, and a written file too. A shard of
    more than ``part_words`` words is dealt over several partitions, the same
    number for all shards, by a hash of the row and of its repeat. Columns are
    those of ``docs``, then ``mix_shard``, which replaces one of that name.
    """
    words = docs.agg(F.sum(F.regexp_count(text_or_empty(text), F.lit(WORD + "+")).cast("long"))).first()[0] or 0
    # All targets together are at most the words of all sources, and shards get equal shares.
    parts = max(1, -(-words // (shards * part_words)))
    placed = mix(docs, seed=seed, carry=True, text=text, shards=shards, **options)
    rows = placed.select("row", "doc_id", "size", F.posexplode("shards").alias("_nth", "mix_shard"))
    rows = rows.withColumn("_order", _hash(seed + 4, "doc_id", "size", "_nth"))
    part = F.col("mix_shard") * parts + F.pmod(F.xxhash64("_order"), F.lit(parts)).cast("int")
    dealt = rows.repartitionById(shards * parts, part.cast("int"))
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c != "mix_shard"]
    return dealt.sortWithinPartitions("mix_shard", "_order").select(*kept, "mix_shard")
