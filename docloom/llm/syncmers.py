"""Document fingerprints from closed syncmers, with Spark's own expressions only.

A run of ``K`` words is an anchor if the smallest hash among its inner runs of
``S`` words stands at its first or last place. That depends on these words
alone, so equal passages have equal anchors wherever they stand, and of any
``K - S + 1`` runs in a row at least one is an anchor.

An anchor is a long: its place (words before it) in the upper, the hash of its
run in the lower 32 bits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from docloom.llm.common import Scratch, let, text_or_empty, words_of

#: Words of a run and of its inner runs, and how many of these it has.
K, S = 5, 2
W = K - S + 1
#: A longer word, as of scripts without blanks, counts as pieces of ``PIECE`` code points.
LONGEST, PIECE = 24, 4
LOW = 0xFFFFFFFF


def _word_hashes(text: Column) -> Column:
    """A hash for each word, in order."""

    def pieces(words: Column) -> Column:
        cut = F.transform(
            words, lambda w: F.when(F.length(w) > LONGEST, F.regexp_extract_all(w, F.lit(f"(?s)(.{{1,{PIECE}}})"), F.lit(1))).otherwise(F.array(w))
        )
        return F.when(F.exists(words, lambda w: F.length(w) > LONGEST), F.flatten(cut)).otherwise(words)

    return F.transform(let(words_of(text), pieces), lambda w: F.xxhash64(w))


def anchors(text: Column) -> Column:
    """``array<long>``: the anchors of a text in the order of their places; none if it has under ``K`` words."""

    def chosen(words: Column, inner: Column) -> Column:
        def edge(i: Column) -> Column:
            values = [F.get(inner, i + k) for k in range(W)]
            return F.least(values[0], values[-1]) <= F.least(*values[1:-1])

        places = F.filter(F.sequence(F.lit(0), F.size(words) - K), edge)
        return F.transform(
            places,
            lambda i: F.shiftleft(i.cast("long"), 32).bitwiseOR(F.xxhash64(*[F.get(words, i + k) for k in range(K)]).bitwiseAND(F.lit(LOW))),
        )

    def inner_of(words: Column) -> Column:
        rest = F.size(words) - (S - 1)
        parts = [F.slice(words, F.lit(k + 1), rest) for k in range(S)]
        return F.zip_with(*parts, lambda a, b: F.xxhash64(a, b))

    none = F.array().cast("array<long>")
    return let(
        _word_hashes(text), lambda words: F.when(F.size(words) >= K, let(inner_of(words), lambda inner: chosen(words, inner))).otherwise(none)
    )


def place(anchor: Column) -> Column:
    return F.shiftright(anchor, 32)


def or_whole(found: Column, text: Column) -> Column:
    """``found``, or the hash of the whole text at place 0 if a text that is not empty has no anchor."""
    whole = F.array(F.xxhash64(text).bitwiseAND(F.lit(LOW)))
    return F.when((F.size(found) > 0) | (F.length(text) == 0), found).otherwise(whole)


def fingerprint(found: Column) -> Column:
    """Anchors as text: for each the distance from the one before and its hash, as a hexadecimal number of the two, dots between."""
    before = F.concat(F.array(F.lit(0).cast("long")), F.transform(found, place))
    steps = F.zip_with(found, F.slice(before, F.lit(1), F.size(found)), lambda a, p: a - F.shiftleft(p, 32))
    return F.lower(F.array_join(F.transform(steps, lambda s: F.hex(s)), "."))


def hashes(found: Column) -> Column:
    """The distinct window hashes of anchors."""
    return F.array_distinct(F.transform(found, lambda a: a.bitwiseAND(F.lit(LOW))))


def likeness(a: Column, b: Column) -> Column:
    """Share of common values among those of two arrays of distinct values: 1 for two empty ones."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / both)


def _ordered(doc_id: Column, text: Column) -> tuple[Column, Column]:
    """Sort keys, both never null: documents by falling id, those without one last; equal ids by the text's hash."""
    number = doc_id.cast("long")
    return F.struct(number.isNull().alias("unnamed"), (-F.coalesce(number, F.lit(0))).cast("decimal(20,0)").alias("falling")), F.xxhash64(text)


def _bucket_of(key: Column, bounds: list[float]) -> Column:
    """Number of ``bounds`` (ascending) below ``key``: a sequence of binary steps, so the cost is the logarithm of their number."""
    values = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<double>")

    def advanced(found: Column, step: int) -> Column:
        return let(found, lambda f: F.when(F.get(values, f + (step - 1)) < key, f + step).otherwise(f))

    found = F.lit(0)
    for power in reversed(range(len(bounds).bit_length())):
        found = advanced(found, 1 << power)
    return found


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of all texts and of their edited texts, one row per row of ``docs``.

    The edited text is the text with its last ``floor(n / 2)`` code points
    replaced by the first as many, or all, of the next document: the one with
    the next smaller doc_id, after the last the first. Documents without an id
    come last; documents with one id, in the order of their texts' hashes. The
    next one of a row that repeats, in id and text, is its copy, but for the
    last copy. A null text counts as empty. A single row is its own next one;
    an empty table gives an empty result.

    Columns: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next`` (share of common
    anchor hashes), ``placed_edited``, ``placed_next`` (share of anchors that
    agree in place and hash). A text without any anchor (those below ``K`` words)
    has one for itself as a whole, an empty text has none and an empty
    fingerprint. Other columns of ``docs`` are left out.

    Texts move once: to buckets of neighbouring ids, cut at quantiles of the
    sort key, so that an id of many rows is divided as well. The first row of
    each bucket goes to the bucket before.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "syncmers")
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    group, tie = _ordered(F.col("doc_id"), F.col("text"))
    keys = scratch.table(rows.select(group.alias("g"), tie.alias("tie")), "keys")
    copies = keys.groupBy("g", "tie").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    copies = scratch.table(copies, "copies")
    rows = rows.select("doc_id", "text", group.alias("g"), tie.alias("tie"))
    if copies.isEmpty():
        rows = rows.withColumn("copies", F.lit(1).cast("long"))
    else:
        # Copies are folded map-side before any of them moves.
        several = rows.join(copies.hint("merge"), ["g", "tie"], "left_semi").groupBy("g", "tie").agg(
            F.first("doc_id").alias("doc_id"), F.first("text").alias("text")
        )
        several = several.join(copies.hint("merge"), ["g", "tie"]).select("doc_id", "text", "g", "tie", "copies")
        rows = rows.join(copies.hint("merge"), ["g", "tie"], "left_anti").withColumn("copies", F.lit(1).cast("long")).unionByName(several)

    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # One number in the order of (g, tie): the whole part from the id, the fraction from the hash. Doubles round it,
    # but never turn the order around, and rows of one key share a bucket.
    number = F.when(F.col("g.unnamed"), F.lit(1e19)).otherwise(F.col("g.falling").cast("double")) + (F.col("tie").cast("double") / 2.0**64 + 0.5)
    cuts = keys.select(number.alias("x")).agg(F.percentile_approx("x", [i / parts for i in range(1, parts)] or [0.5], 10 * parts)).first()[0]
    bounds = sorted(set(cuts or []))[: parts - 1]
    bucket = _bucket_of(number, bounds)
    firsts = keys.groupBy(bucket.alias("bucket")).agg(F.min(F.struct("g", "tie")).alias("first"))
    ring = Window.orderBy("bucket")  # a row for each bucket
    following = F.coalesce(F.lead("first").over(ring), F.first("first").over(ring))
    firsts = scratch.table(firsts.select("bucket", following.alias("first")), "firsts")
    firsts = firsts.select(F.col("bucket").alias("to"), "first.g", "first.tie")

    entering = rows.join(firsts, ["g", "tie"]).select("to", F.col("text").alias("first_text"))
    entering = scratch.table(entering.withColumn("first_anchors", anchors(F.col("first_text"))), "entering")
    placed = rows.withColumn("bucket", bucket).withColumn("own", anchors(F.col("text")))
    order = Window.partitionBy("bucket").orderBy("g", "tie")
    placed = placed.withColumns({"next_text": F.lead("text").over(order), "next_own": F.lead("own").over(order)})
    inside = F.col("next_text").isNotNull()
    placed = placed.join(entering.hint("merge"), (F.col("bucket") == F.col("to")) & ~inside, "left")  # the last row of each bucket
    placed = placed.select(
        "doc_id", "text", "own", "copies",
        F.when(inside, F.col("next_text")).otherwise(F.col("first_text")).alias("next_text"),
        F.when(inside, F.col("next_own")).otherwise(F.col("first_anchors")).alias("next_own"),
    )
    # The last copy is followed by the next document, the others by themselves.
    itself = F.struct(F.col("text").alias("next_text"), F.col("own").alias("next_own"))
    after = F.struct("next_text", "next_own")
    followers = F.when(F.col("copies") > 1, F.concat(F.array(after), F.array_repeat(itself, (F.col("copies") - 1).cast("int")))).otherwise(F.array(after))
    if not copies.isEmpty():
        placed = placed.select("doc_id", "text", "own", F.explode(followers).alias("f")).select("doc_id", "text", "own", "f.*")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
    made = placed.select("doc_id", F.length("text").cast("long").alias("n_chars"), "text", "own", "next_text", "next_own", edited.alias("edited_text"))
    made = made.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), or_whole(F.col("own"), F.col("text")).alias("own"),
        or_whole(F.col("next_own"), F.col("next_text")).alias("next"),
        let(anchors(F.col("edited_text")), lambda found: or_whole(found, F.col("edited_text"))).alias("edited"),
    )
    made = made.withColumns({"own_hashes": hashes(F.col("own")), "edited_hashes": hashes(F.col("edited")), "next_hashes": hashes(F.col("next"))})
    return made.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"), fingerprint(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own_hashes"), F.col("edited_hashes")).alias("near_edited"), likeness(F.col("own_hashes"), F.col("next_hashes")).alias("near_next"),
        likeness(F.col("own"), F.col("edited")).alias("placed_edited"), likeness(F.col("own"), F.col("next")).alias("placed_next"),
    )
