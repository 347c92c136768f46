"""Text analysis of document columns: tokens, stop words, synonyms, shingles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docloom.operators.phrases import ARC, FILLER, PAIR, Phrases, phrases_if_small
from docloom.session import BROADCAST_BYTES, cut_lineage

# The search service's built-in English stop words.
ENGLISH_STOP_WORDS = (
    "a an and are as at be but by for if in into is it no not of on or such that the their then "
    "there these they this to was will with"
).split()

# Text of a partition whose tokens are grouped: its distinct tokens take some 70 times as much memory.
PART_BYTES = 4 * 1024 * 1024


@dataclass(frozen=True)
class Analyzer:
    """Steps of one analyzer, applied in the order of the fields."""

    tokenizer: str
    spaced_chars: bool = False
    lowercase: bool = False
    stop_words: Sequence[str] = ()
    synonyms: bool = False
    shingles: bool = False
    graph: bool = False


# The declared analyzers. The query-time variants use the graph
# form of the synonym filter: the same tokens, but shingles that follow paths.
_DEFAULT = Analyzer("letter", True, True, tuple(ENGLISH_STOP_WORDS), True)
_SHINGLE = Analyzer("letter", True, True, tuple(ENGLISH_STOP_WORDS), True, True)
_SHINGLE_GRAPH = Analyzer("letter", True, True, tuple(ENGLISH_STOP_WORDS), True, True, True)
ANALYZERS = {
    "default": _DEFAULT,
    "default_search": _DEFAULT,
    "synonym": Analyzer("whitespace", synonyms=True),
    "keyword_analyzer": Analyzer("keyword", lowercase=True),
    "comma_split_pattern_analyzer": Analyzer("comma", lowercase=True),
    "whitespace_analyzer": Analyzer("whitespace", lowercase=True),
    "shingle_search": _SHINGLE_GRAPH,
    "shingle_analyzer": _SHINGLE,
}


def special_chars_to_space(col: Column | str) -> Column:
    """Char filter: apostrophes and underscores become spaces."""
    return F.translate(col, "'_", "  ")


def remove_spaces(col: Column | str) -> Column:
    """Char filter: spaces are dropped."""
    return F.replace(col, F.lit(" "), F.lit(""))


def lowercase_normal(col: Column | str) -> Column:
    """Normalizer of exact values."""
    return F.lower(col)


def tokens_of(text: Column | str, analyzer: Analyzer) -> Column:
    """Array of the tokens of ``text``; removed stop words leave a NULL in place."""
    column = F.col(text) if isinstance(text, str) else text
    if analyzer.spaced_chars:
        column = special_chars_to_space(column)
    if analyzer.tokenizer == "letter":
        # Maximal runs of letters.
        tokens = F.regexp_extract_all(column, F.lit(r"(\p{L}+)"), F.lit(1))
    elif analyzer.tokenizer == "whitespace":
        tokens = F.regexp_extract_all(column, F.lit(r"(?U)(\S+)"), F.lit(1))
    elif analyzer.tokenizer == "comma":
        tokens = F.regexp_extract_all(column, F.lit(r"([^,]+)"), F.lit(1))
    elif analyzer.tokenizer == "keyword":
        tokens = F.array(column)
    else:
        raise ValueError(f"unknown tokenizer {analyzer.tokenizer!r}")
    if not (analyzer.lowercase or analyzer.stop_words):
        return tokens

    def finish(token: Column) -> Column:
        token = F.lower(token) if analyzer.lowercase else token
        return F.when(~token.isin(list(analyzer.stop_words)), token) if analyzer.stop_words else token

    return F.transform(tokens, finish)


def _windows(df: DataFrame, ids: Sequence[str], width: int) -> DataFrame:
    """One row per position: ``(ids, n, pos, before, w)``, ``w`` the tokens from
    there on, ``width`` of them, and ``before`` the token in front.

    Neighbours come from shifted copies of the row's own array, so no
    shuffle is needed and a row's cost is linear in its text.
    """
    size = F.size("tokens")
    names = ["before"] + [f"t{i}" for i in range(width)]
    shifted = [F.concat(F.array(F.lit(None).cast("string")), F.slice("tokens", F.lit(1), F.greatest(size - 1, F.lit(0))))]
    shifted += [F.col("tokens")] + [
        F.slice("tokens", F.lit(i + 1), F.greatest(size - i, F.lit(0))) for i in range(1, width)
    ]
    # n and z are made below the generator, which would otherwise repeat the
    # whole array on every row.
    ready = df.select(*ids, size.alias("n"), F.arrays_zip(*shifted).alias("z"))
    entry = f"array<struct<{', '.join(f'{name}: string' for name in names)}>>"
    rows = _numbered(ready.withColumn("z", F.col("z").cast(entry)), [*ids, "n"], "z", "t")
    # The copy with the token in front has one element even for no tokens.
    # coalesce keeps Spark from testing n, hence the tokens, at the scan.
    rows = rows.filter("pos < coalesce(n, 0)")
    return rows.select(*ids, "n", "pos", "t.before", F.array(*[f"t.{i}" for i in names[1:]]).alias("w"))


def _numbered(df: DataFrame, keep: Sequence[str], array: str, out: str) -> DataFrame:
    """``(keep, pos, out)`` of the array's non-NULL elements.

    The outer form, filtered: for the inner form Spark adds a size filter on
    the array and computes the token expression once more for it.
    """
    rows = df.select(*keep, F.posexplode_outer(array).alias("pos", out))
    return rows.filter(F.col(out).isNotNull())


def text_parts(df: DataFrame, text_col: str) -> int:
    """Partitions of about ``PART_BYTES`` of text each, but one for each core at least. The texts' bytes are counted."""
    total = df.agg(F.sum(F.octet_length(text_col).cast("long")).alias("b")).first()["b"] or 0
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-total // PART_BYTES))


def tokenize(df: DataFrame, ids: Sequence[str], text_col: str, analyzer: Analyzer | str) -> DataFrame:
    """``(ids, tokens)``: the token array of every row."""
    kind = ANALYZERS[analyzer] if isinstance(analyzer, str) else analyzer
    return df.select(*ids, tokens_of(text_col, kind).alias("tokens"))


def explode_tokens(tokenized: DataFrame, ids: Sequence[str]) -> DataFrame:
    """``(ids, pos, token)`` of token arrays; positions of removed words stay free."""
    return _numbered(tokenized, ids, "tokens", "token")


def shingle(tokenized: DataFrame, ids: Sequence[str], unigrams: bool = True) -> DataFrame:
    """``(ids, pos, token)``: pairs of neighbouring tokens, plus the tokens themselves.

    A removed word shows as ``_`` in the pairs around it.
    """
    word, after = F.col("w")[0], F.col("w")[1]
    pair = F.when(
        (F.col("pos") < F.col("n") - 1) & (word.isNotNull() | after.isNotNull()),
        F.concat_ws(" ", F.coalesce(word, F.lit(FILLER)), F.coalesce(after, F.lit(FILLER))),
    )
    grams = F.array(word, pair) if unigrams else F.array(pair)
    rows = _windows(tokenized, ids, 2).select(*ids, "pos", F.explode(grams).alias("token"))
    return rows.filter("token IS NOT NULL")


def _terms(groups: DataFrame) -> DataFrame:
    return groups.select("group_id", F.split("term", r"\s+").alias("parts"))


def phrases(groups: DataFrame) -> Phrases | None:
    """The automaton of ``groups(group_id, term)``; None if it is too large to go to every task."""
    return phrases_if_small(_terms(groups), BROADCAST_BYTES)


def _found(tokenized: DataFrame, ids: Sequence[str], entries: Column) -> DataFrame:
    """``(ids, ...)``: the struct entries of a per-row array, a row each."""
    rows = tokenized.select(*ids, entries.alias("entries"))
    return rows.select(*ids, F.explode_outer("entries").alias("e")).filter("e IS NOT NULL").select(*ids, "e.*")


def _joined_matches(tokenized: DataFrame, ids: Sequence[str], groups: DataFrame) -> DataFrame:
    """``(ids, n, pos, w, read, write)``: matches by a join, for groups too large for an automaton.

    ``read`` stands at ``pos``, ``write`` is a term of the same group.
    """
    terms = cut_lineage(_terms(groups).withColumn("first", F.get("parts", F.lit(0))))
    width = terms.agg(F.max(F.size("parts"))).first()[0] or 1
    read = terms.select("group_id", "first", F.col("parts").alias("read"))
    write = terms.select(F.col("group_id").alias("g"), F.col("parts").alias("write"))
    # One token more than the longest term: the neighbour after its last word.
    windows = _windows(tokenized, ids, width + 1)
    matched = windows.join(read, windows["w"][0] == read["first"], "inner")
    matched = matched.filter(F.slice("w", F.lit(1), F.size("read")) == F.col("read"))
    return matched.join(write, matched["group_id"] == write["g"], "inner")


def _joined_added(tokenized: DataFrame, ids: Sequence[str], groups: DataFrame) -> DataFrame:
    """``(ids, n, pos, token, before, after)``: added words by a join.

    ``before`` and ``after`` are the text's own neighbours of the position:
    a token, ``_`` for a removed word, NULL beyond the text.
    """
    at = F.col("pos") + F.col("i")

    def neighbour(token: Column, where: Column) -> Column:
        return F.when((where >= 0) & (where < F.col("n")), F.coalesce(token, F.lit(FILLER)))

    front = F.when(F.col("i") == 0, F.col("before")).otherwise(F.get("w", F.col("i") - 1))
    return (
        _joined_matches(tokenized, ids, groups)
        .select(*ids, "n", "pos", "before", "w", F.posexplode("write").alias("i", "token"))
        # Words already at their position are not written again.
        .filter(~F.col("token").eqNullSafe(F.get("w", F.col("i"))))
        .select(
            *ids, "n", at.alias("pos"), "token", neighbour(front, at - 1).alias("before"),
            neighbour(F.get("w", F.col("i") + 1), at + 1).alias("after"),
        )
        .distinct()
    )


def _own_and_added(
    tokenized: DataFrame, ids: Sequence[str], own: Column, added: Column, kind: str, parts: int | None
) -> DataFrame:
    """``(ids, ...)``: the entries ``own``, made from a row's tokens, and ``added``, made by a lookup, a row each.

    With ``parts`` the rows are dealt by ``ids`` between the lookup and the entries: tokens and
    additions travel, and no entry does. Spark takes the partitions through no Python step.
    """
    rows = tokenized.select(*ids, "tokens", added.alias("added"))
    rows = rows.repartition(parts, *ids) if parts else rows
    return _found(rows, ids, F.concat(own, F.coalesce("added", F.array().cast(kind))))


def expand_synonyms(
    tokenized: DataFrame, ids: Sequence[str], groups: DataFrame, parts: int | None = None
) -> DataFrame:
    """``(ids, pos, token)`` of token arrays with the terms of matching synonym groups.

    ``groups`` holds ``(group_id, term)``. A term of several words matches a run
    of tokens and is written word by word from the position where the match
    starts. Every match counts, a longer one beside the shorter ones in it. A
    position holds each token once. Nothing is shuffled, and a text without a
    match costs one lookup of its words; only groups too large to go to every
    task are joined. ``ids`` must identify a row. For ``parts`` see :func:`analyze`.
    """
    found = phrases(groups)
    if found is None:
        added = _joined_added(tokenized, ids, groups)
        return explode_tokens(tokenized, ids).unionByName(added.select(*ids, "pos", "token"))
    own = F.transform("tokens", lambda t, i: F.struct(i.alias("pos"), t.alias("token")))
    own = F.filter(own, lambda e: e["token"].isNotNull())
    return _own_and_added(tokenized, ids, own, found.added("tokens"), PAIR, parts)


def shingle_synonyms(tokenized: DataFrame, ids: Sequence[str], groups: DataFrame) -> DataFrame:
    """:func:`shingle` of token arrays with synonym groups.

    A position holds its token, or ``_`` for a removed word, and the words that
    groups add; every item is paired with every item of the next position.
    """
    found = phrases(groups)
    if found is not None:
        return shingle(tokenized, ids).unionByName(_found(tokenized, ids, found.added_grams("tokens")))
    # Read three times below.
    added = cut_lineage(_joined_added(tokenized, ids, groups))
    word = F.col("token")
    pos = F.col("pos")

    def gram(at: Column, text: Column) -> Column:
        return F.struct(at.alias("at"), text.alias("gram"))

    grams = F.array(
        gram(pos, word),
        gram(pos - 1, F.when(F.col("before").isNotNull(), F.concat_ws(" ", "before", word))),
        gram(pos, F.when(F.col("after").isNotNull(), F.concat_ws(" ", word, "after"))),
    )
    mixed = added.select(*ids, F.inline(grams)).filter("gram IS NOT NULL").select(
        *ids, F.col("at").alias("pos"), F.col("gram").alias("token")
    )
    right = added.select(*ids, (F.col("pos") - 1).alias("pos"), word.alias("next"))
    both = added.join(right, [*ids, "pos"]).select(*ids, "pos", F.concat_ws(" ", word, "next").alias("token"))
    return shingle(tokenized, ids).unionByName(mixed).unionByName(both)


def _graph_phrases(groups: DataFrame) -> Phrases:
    found = phrases(groups)
    if found is None:
        raise ValueError(f"the graph form takes synonym groups of at most {BROADCAST_BYTES} bytes")
    return found


def synonym_graph(
    tokenized: DataFrame, ids: Sequence[str], groups: DataFrame, parts: int | None = None
) -> DataFrame:
    """``(ids, pos, length, path, step, steps, token)``: token arrays as graphs of readings.

    The text's own tokens lead from each position to the next (``length`` 1,
    ``path`` NULL). Where a term stands, each other term of its group is a path
    of its own around it: it leaves at ``pos`` and comes back after the
    ``length`` tokens that the term takes, by ``steps`` words, ``step`` counting them from 0. So a
    word that stands for two is two positions long, and the words between a path's
    ends belong to this reading alone. A path that several terms give
    occurs once. For ``parts`` see :func:`analyze`.
    """
    found = _graph_phrases(groups)

    def arc(token: Column, pos: Column) -> Column:
        return F.struct(
            pos.alias("pos"), F.lit(1).alias("length"), F.lit(None).cast("string").alias("path"),
            F.lit(0).alias("step"), F.lit(1).alias("steps"), token.alias("token"),
        )

    own = F.filter(F.transform("tokens", arc), lambda e: e["token"].isNotNull())
    return _own_and_added(tokenized, ids, own, found.arcs("tokens"), ARC, parts)


def shingle_graph(
    tokenized: DataFrame, ids: Sequence[str], groups: DataFrame, parts: int | None = None
) -> DataFrame:
    """:func:`shingle` along the paths of :func:`synonym_graph`.

    A pair is two tokens of which one ends where the other starts, so none mixes words of
    two readings. ``pos`` is the position where the first word's path leaves the text.
    For ``parts`` see :func:`analyze`.
    """
    found = _graph_phrases(groups)

    def grams(word: Column, pos: Column) -> Column:
        after = F.get("tokens", pos + 1)
        pair = F.when(
            (pos < F.size("tokens") - 1) & (word.isNotNull() | after.isNotNull()),
            F.concat_ws(" ", F.coalesce(word, F.lit(FILLER)), F.coalesce(after, F.lit(FILLER))),
        )
        return F.array(*[F.struct(pos.alias("pos"), token.alias("token")) for token in (word, pair)])

    own = F.filter(F.flatten(F.transform("tokens", grams)), lambda e: e["token"].isNotNull())
    return _own_and_added(tokenized, ids, own, found.path_grams("tokens"), PAIR, parts)


def analyze(
    df: DataFrame,
    ids: Sequence[str],
    text_col: str,
    analyzer: Analyzer | str = "default",
    groups: DataFrame | None = None,
    parts: int | None = None,
) -> DataFrame:
    """``(ids, pos, token)`` of ``text_col`` under one of :data:`ANALYZERS` or an own one.

    With ``parts``, see :func:`text_parts`, the texts are dealt by ``ids`` over as many partitions before
    their tokens become rows, which are many times larger: grouping these by ``ids``
    and more shuffles none of them. Shingles of ``shingle_synonyms`` are left as they are.
    """
    kind = ANALYZERS[analyzer] if isinstance(analyzer, str) else analyzer
    if kind.synonyms and groups is not None:
        tokenized = tokenize(df, ids, text_col, kind)
        if kind.shingles and not kind.graph:
            return shingle_synonyms(tokenized, ids, groups)
        return (shingle_graph if kind.shingles else expand_synonyms)(tokenized, ids, groups, parts)
    tokenized = tokenize(df.repartition(parts, *ids) if parts else df, ids, text_col, kind)
    return shingle(tokenized, ids) if kind.shingles else explode_tokens(tokenized, ids)


def copy_to(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """``target`` holding its own text, if it exists, and that of ``cols``."""
    own = [target] if target in df.columns else []
    return df.withColumn(target, F.concat_ws(" ", *own, *[F.col(c).cast("string") for c in cols]))


def _properties(mapping: Mapping) -> Mapping:
    if "properties" in mapping:
        return mapping["properties"]
    # The older form wraps the mapping in its document type.
    (inner,) = mapping.values()
    return inner["properties"]


def _whole_number(col: Column) -> Column:
    number = col.try_cast("double")
    return F.when(number.between(-(2**31), 2**31 - 1), number.cast("int"))


def _mapped(col: Column, kind: T.DataType, rule: Mapping) -> Column:
    if rule.get("type") == "integer":
        return _whole_number(col)
    if rule.get("type") == "nested":
        inner = rule["properties"]
        if isinstance(kind, T.StringType):
            fields = ", ".join(f"`{name}`: string" for name in inner)
            col = F.from_json(col, f"array<struct<{fields}>>")
            kind = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in inner]))
        item = kind.elementType

        def entry(e: Column) -> Column:
            made = []
            for name, sub in inner.items():
                if isinstance(item, T.MapType):
                    found, found_kind = F.try_element_at(e, F.lit(name)), item.valueType
                elif name in item.names:
                    found, found_kind = e[name], item[name].dataType
                else:
                    found, found_kind = F.lit(None).cast("string"), T.StringType()
                made.append(_mapped(found, found_kind, sub).alias(name))
            return F.struct(*made)

        return F.transform(col, entry)
    return col.cast("string")


def apply_mapping(df: DataFrame, mapping: Mapping, keep: Sequence[str] = ()) -> DataFrame:
    """The searchable columns of ``df``: mapped fields only, with the mapped type.

    Integers are whole 32-bit numbers (others NULL), nested fields arrays of
    structs (decoded from JSON text if need be); ``copy_to`` targets are
    filled. Names match exactly, and mapped fields ``df`` lacks are left out.
    """
    rules = _properties(mapping)
    fed: dict[str, list[str]] = {}
    for name, rule in rules.items():
        targets = rule.get("copy_to", [])
        for target in [targets] if isinstance(targets, str) else targets:
            fed.setdefault(target, []).append(name)
    for target, cols in fed.items():
        present = [c for c in cols if c in df.columns]
        if present:
            df = copy_to(df, present, target)
    columns = [
        _mapped(F.col(f"`{name}`"), df.schema[name].dataType, rule).alias(name)
        for name, rule in rules.items()
        if name in df.columns
    ]
    return df.select(*[c for c in keep if c not in rules], *columns)


def mapping_errors(df: DataFrame, mapping: Mapping) -> Column:
    """Name of the first integer field whose value is no whole 32-bit number, or NULL."""
    checks = [
        F.when(F.col(f"`{name}`").isNotNull() & _whole_number(F.col(f"`{name}`")).isNull(), F.lit(name))
        for name, rule in _properties(mapping).items()
        if rule.get("type") == "integer" and name in df.columns
    ]
    return reduce(lambda a, b: F.coalesce(a, b), checks, F.lit(None).cast("string"))


def field_tokens(
    mapped: DataFrame, ids: Sequence[str], mapping: Mapping, groups: DataFrame | None = None
) -> DataFrame:
    """``(ids, field, item, pos, token)``: the tokens of every mapped text field.

    Each field goes through its declared ``analyzer`` (``default`` if none is
    named). Entries of nested fields are numbered by ``item`` and analyzed one
    by one, ``field`` being ``<nested>.<name>``.
    """
    found = []

    def add(df: DataFrame, keys: list[str], field: str, column: str, rule: Mapping) -> None:
        tokens = analyze(df, keys, column, rule.get("analyzer", "default"), groups)
        item = F.col("item") if "item" in keys else F.lit(0)
        found.append(tokens.select(*ids, F.lit(field).alias("field"), item.alias("item"), "pos", "token"))

    for name, rule in _properties(mapping).items():
        if name not in mapped.columns:
            continue
        if rule.get("type") == "text":
            add(mapped, list(ids), name, name, rule)
        elif rule.get("type") == "nested":
            entries = mapped.select(*ids, F.posexplode(name).alias("item", "entry"))
            for inner, sub in rule["properties"].items():
                if sub.get("type") == "text":
                    entry = entries.select(*ids, "item", F.col(f"entry.`{inner}`").alias("text"))
                    add(entry, [*ids, "item"], f"{name}.{inner}", "text", sub)
    return reduce(lambda a, b: a.unionByName(b), found)
