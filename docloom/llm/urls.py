"""URL rules: a trie over reversed host labels and path segments.

A rule is ``(host, path, verdict)``. It fits a URL whose host is the rule's or
one of its subdomains and whose path starts with the rule's path. Of the rules
that fit, the one with the most host labels wins, then the one with the longest
path, then ``block``. A rule with an empty host fits every host.

Up to ``BROADCAST_RULES`` rules the trie is built on the driver and sent to
the tasks. A longer list stays a table and is joined, with the same results.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

#: A rule takes under 1 KB in the trie (longer ones are joined), so this bounds the broadcast.
BROADCAST_RULES = 50_000
BROADCAST_RULE_CHARS = 300

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _labels(host: str) -> list[str]:
    return host.split(".")[::-1] if host else []


class Trie:
    """Host labels from the right, below each host its path segments."""

    def __init__(self, rules: list[tuple[str, str, str]]) -> None:
        self.root: dict = {"next": {}, "paths": None}
        for host, path, verdict in rules:
            node = self.root
            for label in _labels(host):
                node = node["next"].setdefault(label, {"next": {}, "paths": None})
            if node["paths"] is None:
                node["paths"] = {"next": {}, "ends": {}}
            *segments, rest = path.split("/")
            at = node["paths"]
            for segment in segments:
                at = at["next"].setdefault(segment, {"next": {}, "ends": {}})
            if at["ends"].get(rest, (None, "allow"))[1] != "block":
                at["ends"][rest] = (host + path, verdict)

    def _path(self, at: dict, path: str) -> tuple[str, str] | None:
        best, start = None, 0
        while True:
            rest = path[start:]
            fits = [e for e in at["ends"] if rest.startswith(e)]
            if fits:
                best = at["ends"][max(fits, key=len)]
            end = path.find("/", start)
            at = at["next"].get(path[start:end]) if end >= 0 else None
            if at is None:
                return best
            start = end + 1

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """The winning ``(rule, verdict)``."""
        node, best = self.root, None
        labels = _labels(host)
        for depth in range(len(labels) + 1):
            if node["paths"] is not None:
                best = self._path(node["paths"], path) or best
            node = node["next"].get(labels[depth]) if depth < len(labels) else None
            if node is None:
                break
        return best


def filter_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]] | DataFrame,
    url: str = "url",
    default: str = "allow",
    broadcast_rules: int = BROADCAST_RULES,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` is a list or a DataFrame ``(host, path, verdict)``; a URL that no
    rule fits gets a null rule and ``default``. A null URL or one without
    ``://`` has an empty host and path. Columns of ``pages`` named like the
    four new ones are replaced; all others and every row stay.
    """
    spark = pages.sparkSession
    if isinstance(rules, list):
        rules = spark.createDataFrame(rules, "host string, path string, verdict string")
    rules = rules.select("host", "path", "verdict").na.fill("")
    rules = rules.withColumn("host", F.translate("host", UPPER, LOWER)).dropDuplicates()
    # The caller's columns travel in one struct, so none can clash with those made here.
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("_row")
    split = pages.select(row, host_of(F.col(url)).alias("_host"), path_of(F.col(url)).alias("_path"))
    kept = [F.col(f"_row.`{c}`") for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    size = rules.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.max(F.length("host") + F.length("path")), F.lit(0)).alias("longest"),
    ).first()
    if size["n"] <= broadcast_rules and size["longest"] <= BROADCAST_RULE_CHARS:
        found = _by_trie(split, [tuple(r) for r in rules.collect()])
    else:
        found = _by_join(split, rules)
    return found.select(
        *kept,
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_found.rule").alias("rule"),
        F.coalesce("_found.verdict", F.lit(default)).alias("verdict"),
    )


def _by_trie(split: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    sent = split.sparkSession.sparkContext.broadcast(Trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def find(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        trie = sent.value
        for hosts, paths in parts:
            found = [trie.find(h, p) or (None, None) for h, p in zip(hosts, paths)]
            yield pd.DataFrame(found, columns=["rule", "verdict"], dtype=object)

    return split.withColumn("_found", find("_host", "_path"))


def _by_join(split: DataFrame, rules: DataFrame) -> DataFrame:
    """Every host suffix and path prefix of a URL looks up the rule table.

    Distinct ``(host, path)`` pairs are looked up once, so repeated URLs do
    not heat a key; the commonest suffixes are left to adaptive skew splitting.
    """
    keyed = rules.select(
        F.col("host").alias("_rh"),
        F.expr("left(path, length(path) - length(substring_index(path, '/', -1)))").alias("_rp"),
        F.substring_index("path", "/", -1).alias("_rest"),
        F.struct(
            F.when(F.col("host") == "", 0).otherwise(F.size(F.split("host", r"\."))).alias("depth"),
            F.length("path").alias("length"),
            (F.col("verdict") == "block").alias("blocks"),
            F.concat("host", "path").alias("rule"),
            "verdict",
        ).alias("_found"),
    )
    urls = split.select("_host", "_path").distinct()
    suffixes = F.expr(
        "array_distinct(array_append(transform(sequence(1, size(split(_host, '\\\\.'))), "
        "i -> array_join(slice(split(_host, '\\\\.'), -i, i), '.')), ''))"
    )
    prefixes = F.expr(
        "transform(sequence(0, size(split(_path, '/')) - 1), "
        "i -> if(i = 0, '', concat(array_join(slice(split(_path, '/'), 1, i), '/'), '/')))"
    )
    asked = urls.withColumn("_rh", F.explode(suffixes)).withColumn("_rp", F.explode(prefixes))
    best = (
        asked.join(keyed, ["_rh", "_rp"])
        .where(F.expr("startswith(substring(_path, length(_rp) + 1), _rest)"))
        .groupBy("_host", "_path")
        .agg(F.max("_found").alias("_found"))
    )
    return split.join(best, ["_host", "_path"], "left")
