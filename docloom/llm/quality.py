"""Quality rules: per-document counts and lines that recur across documents.

All steps are built-in DataFrame functions. Texts are walked row by row
with array functions; only line hashes and counts are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docloom.llm.common import SPACE, Scratch, WORD, let, text_or_empty, words_of

MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"

#: A line is frequent in a host, and removed, if more distinct texts of the host
#: hold it than LINE_FLOOR and than this share of the host's texts with a word.
LINE_PERCENT = 5
LINE_FLOOR = 5
#: A document is depleted with fewer words left than MIN_WORDS or than this share.
MIN_LEFT_PERCENT = 20


def document_features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """``(doc_id, text_hash, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)`` per row.

    A null text has no words. ``word_chars`` counts code points in words,
    ``n_dup_lines`` lines with a word that equal an earlier line, and
    ``n_repeat_words`` words in 8-word windows found twice or more.

    Most texts have only distinct windows and stop there. For the others the
    (hash, position) pairs are sorted; equal neighbours give the positions of
    the repeated windows, and their overlaps the words covered.
    """
    body = _body(docs, doc_id, text, host)
    hashed = body.select(
        "doc_id",
        "host",
        F.xxhash64("_text").alias("text_hash"),
        F.length(F.regexp_replace("_text", SPACE + "+", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.regexp_replace("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("_text", "\n"), lambda line: line.rlike(WORD)).alias("_lines"),
        F.transform(words_of(F.col("_text")), lambda w: F.xxhash64(w)).alias("_words"),
    )
    counted = hashed.select(
        "doc_id",
        "text_hash",
        "host",
        F.size("_words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            f"if(size(_words) < {WINDOW}, cast(array() AS array<bigint>), "
            f"transform(sequence(0, size(_words) - {WINDOW}), i -> xxhash64("
            + ", ".join(f"get(_words, i + {k})" for k in range(WINDOW))
            + ")))"
        ).alias("_windows"),
    )
    repeats = counted.withColumn(
        "_sorted",
        F.expr(
            "if(size(array_distinct(_windows)) = size(_windows), NULL, "
            "array_sort(transform(_windows, (h, i) -> struct(h AS h, i AS i))))"
        ),
    ).withColumn(
        "_at",
        F.expr(
            "array_sort(transform(filter(_sorted, (x, k) -> "
            "(k > 0 AND get(_sorted, k - 1).h = x.h) OR (get(_sorted, k + 1).h <=> x.h)), x -> x.i))"
        ),
    )
    covered = F.expr(
        f"if(_at IS NULL, 0L, aggregate(_at, named_struct('n', 0L, 'end', 0), (a, i) -> named_struct("
        f"'n', a.n + {WINDOW} - greatest(0, a.end - i), 'end', i + {WINDOW}), a -> a.n))"
    )
    return repeats.select(
        "doc_id", "text_hash", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        covered.cast("long").alias("n_repeat_words"),
    )


def _body(docs: DataFrame, doc_id: str, text: str, host: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), text_or_empty(text).alias("_text"))


def lines_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """``(doc_id, text_hash, host, pos, line, n_words)``: one row per line with a word.

    ``line`` hashes the line lower-cased, without outer white space and with
    inner white space as one blank.
    """
    split = _body(docs, doc_id, text, host).select(
        "doc_id", F.xxhash64("_text").alias("text_hash"), "host", F.posexplode(F.split("_text", "\n")).alias("pos", "_l")
    )
    words = split.where(F.col("_l").rlike(WORD)).withColumn("_w", words_of(F.lower("_l")))
    return words.select(
        "doc_id", "text_hash", "host", "pos",
        F.xxhash64(F.array_join("_w", " ")).alias("line"),
        F.size("_w").cast("long").alias("n_words"),
    )


def host_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """``(host, n_texts)``: the distinct texts with a word of each host."""
    body = _body(docs, doc_id, text, host).where(F.col("_text").rlike(WORD))
    return (
        body.select("host", F.xxhash64("_text").alias("text_hash"))
        .distinct()
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("n_texts"))
    )


def frequent_lines(lines: DataFrame, hosts: DataFrame, limit: int = LINE_FLOOR, percent: int = LINE_PERCENT) -> DataFrame:
    """``(host, line)`` found in more than ``limit`` distinct documents and more than ``percent`` of the host's texts.

    ``hosts`` is ``host_texts``. Copies of one text count once, else a page
    that was fetched often would lose its own lines. All aggregations combine
    before the shuffle.
    """
    counted = (
        lines.select("host", "line", "text_hash")
        .distinct()
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > limit)
        .alias("c")
    )
    hosts = hosts.alias("h")
    return (
        counted.join(hosts, F.col("c.host").eqNullSafe(F.col("h.host")))
        .where(100 * F.col("_n") > percent * F.col("n_texts"))
        .select("c.host", "line")
    )


TWIN = ["_id", "_hash", "_host"]


def _same(docs_id: Column, docs_hash: Column, docs_host: Column) -> Column:
    return docs_id.eqNullSafe(F.col("_id")) & (docs_hash == F.col("_hash")) & docs_host.eqNullSafe(F.col("_host"))


def frequent_places(lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """``(_id, _hash, _host, n_line_words, at)``: the frequent lines of each document and their positions.

    Repeated rows fold into one.
    """
    lines, frequent = lines.alias("l"), frequent.alias("f")
    return (
        lines.join(frequent, (F.col("l.line") == F.col("f.line")) & F.col("l.host").eqNullSafe(F.col("f.host")))
        .select(
            F.col("l.doc_id").alias("_id"), F.col("l.text_hash").alias("_hash"), F.col("l.host").alias("_host"),
            "l.pos", "l.n_words",
        )
        .groupBy(*TWIN, "pos")
        .agg(F.max("n_words").alias("n_words"))
        .groupBy(*TWIN)
        .agg(F.sum("n_words").alias("n_line_words"), F.collect_list("pos").alias("at"))
    )


def without_lines(text: Column, at: Column) -> Column:
    """``text`` without its lines at the positions ``at``; the other lines stay as they are."""

    def left(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), at)
        return F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")

    return let(F.split(text, "\n"), left)


def quality(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    limit: int = LINE_FLOOR,
    min_left_percent: int = MIN_LEFT_PERCENT,
    line_percent: int = LINE_PERCENT,
) -> DataFrame:
    """Features, ``n_line_words`` (words in frequent lines), ``base_failed`` and ``kept`` per row of ``docs``.

    ``base_failed``: under 20 words, or over 30 % of them in repeated windows.
    Otherwise a document is dropped if removing the frequent lines of its host
    leaves it under 20 words or under ``min_left_percent`` of its words.
    ``limit`` and ``line_percent`` say which lines are frequent (``frequent_lines``).

    Null texts count as empty and fail; a null host is a host of its own; a
    repeated row is judged like its twin. Other columns of ``docs`` are not
    read. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    return _judged(docs, scratch, doc_id, text, host, limit, min_left_percent, line_percent).drop("at")


def _judged(
    docs: DataFrame, scratch: Scratch, doc_id: str, text: str, host: str, limit: int, min_left_percent: int, line_percent: int
) -> DataFrame:
    """``quality`` with the positions ``at`` of the frequent lines."""
    lines = lines_of(docs, doc_id, text, host)
    # One row per host: Spark broadcasts the table while its files are small.
    hosts = scratch.table(host_texts(docs, doc_id, text, host), "hosts")
    frequent = scratch.table(frequent_lines(lines, hosts, limit, line_percent), "frequent")
    places = scratch.table(frequent_places(lines, frequent), "places")
    # Written before anything reads them: a filter on what is returned would else be pushed
    # into the features' own expressions and compute these again for each element.
    features = scratch.table(document_features(docs, doc_id, text, host), "features")
    joined = features.join(
        places,
        _same(F.col("doc_id"), F.col("text_hash"), F.col("host")),
        "left",
    ).withColumn("n_line_words", F.coalesce("n_line_words", F.lit(0)).cast("long"))
    left = F.col("n_words") - F.col("n_line_words")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    depleted = (left < MIN_WORDS) | (100 * left < min_left_percent * F.col("n_words"))
    return joined.select(
        "doc_id", "text_hash", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_line_words",
        failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), "at",
    )


def keep_good(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    limit: int = LINE_FLOOR,
    line_percent: int = LINE_PERCENT,
) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with all their columns and ``text`` without its host's frequent lines.

    A text that holds no frequent line stays as it is.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    judged = _judged(docs, scratch, doc_id, text, host, limit, MIN_LEFT_PERCENT, line_percent)
    judged = judged.where(~F.col("kept") | F.col("at").isNotNull())
    marks = judged.select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("host").alias("_host"),
        F.struct("kept", "at").alias("_mark"),
    )
    marks = scratch.table(marks.dropDuplicates(TWIN), "marks").hint("merge")
    body = F.coalesce(docs[text], F.lit(""))
    mark = marks["_mark"]
    kept = docs.join(marks, _same(docs[doc_id], F.xxhash64(body), docs[host]), "left").where(mark.isNull() | mark["kept"])
    cleaned = F.when(mark["at"].isNotNull(), without_lines(docs[text], mark["at"])).otherwise(docs[text])
    return kept.select(*[cleaned.alias(c) if c == text else docs[c] for c in docs.columns])
