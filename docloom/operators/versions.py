"""Version names, alias actions and stale versions, as data."""

from __future__ import annotations

from datetime import datetime, timezone
from zoneinfo import ZoneInfo, ZoneInfoNotFoundError

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from docloom.functions.shaping import compact_time


def _zone(name: str | None) -> ZoneInfo | None:
    try:
        return ZoneInfo(name) if name else None
    except (ZoneInfoNotFoundError, ValueError):
        return None


def version_column(prefix: Column, ts: Column | str, time_zone: str | None = None) -> Column:
    """``<prefix>_<yyyyMMddHHmmss>`` of a UTC timestamp column; an unknown ``time_zone`` falls back to local time."""
    if time_zone and _zone(time_zone) is None:
        time_zone = SparkSession.active().conf.get("spark.sql.session.timeZone")
    return F.concat(prefix, F.lit("_"), compact_time(ts, time_zone))


def version_name(prefix: str, moment: datetime | None = None, time_zone: str | None = None) -> str:
    """Name of a new version; an unknown ``time_zone`` falls back to local time."""
    moment = moment or datetime.now(timezone.utc)
    return f"{prefix}_{moment.astimezone(_zone(time_zone)):%Y%m%d%H%M%S}"


def hidden(name: Column | str) -> Column:
    """True for names starting with a dot, which no operator touches."""
    return F.startswith(name, F.lit("."))


def alias_actions(registry: DataFrame, targets: DataFrame) -> DataFrame:
    """``(action, version, alias)`` that point each alias of ``targets`` at its version.

    ``registry`` and ``targets`` hold ``(version, alias)``, ``targets`` one row
    per alias. Every other version now behind the alias is removed, dot-names
    excepted; an alias without versions is only added.
    """
    wanted = targets.select("alias", F.col("version").alias("target"))
    removed = (
        registry.filter(~hidden("version"))
        .join(wanted, "alias", "inner")
        .filter(F.col("version") != F.col("target"))
        .select(F.lit("remove").alias("action"), "version", "alias")
    )
    added = targets.select(F.lit("add").alias("action"), "version", "alias")
    return removed.unionByName(added)


def alias_state(log: DataFrame) -> DataFrame:
    """``(version, alias)`` after all actions of ``log(commit, seq, action, version, alias)``.

    The last action of a pair decides, by commit and then by ``seq``.
    """
    last = log.groupBy("version", "alias").agg(F.max_by("action", F.struct("commit", "seq")).alias("action"))
    return last.where("action = 'add'").select("version", "alias")


def alias_intervals(log: DataFrame) -> DataFrame:
    """``(version, alias, since, until)``: the commits between which a version is behind an alias.

    The state after commit n is the rows with ``since <= n`` and ``until > n`` or
    NULL, so one replay holds every state of the log. An add of what is there and
    a remove of what is not change nothing; of a commit only its last action counts.
    """
    last = log.groupBy("version", "alias", "commit").agg(F.max_by("action", "seq").alias("action"))
    pair = Window.partitionBy("version", "alias").orderBy("commit")
    before = F.lag("action", 1, "remove").over(pair)
    changes = last.withColumn("before", before).where("action <> before")
    ends = changes.withColumn("until", F.lead("commit").over(pair)).where("action = 'add'")
    return ends.select("version", "alias", F.col("commit").alias("since"), "until")


def stale_versions(versions: DataFrame, aliases: DataFrame, prefix: str = "") -> DataFrame:
    """``(version)`` that no alias points at, dot-names excepted.

    With ``prefix`` only names of a site's own versions: the prefix, then the
    14 digits of the time and nothing else.
    """
    name = F.col("version")
    named = F.startswith(name, F.lit(prefix)) & F.substr(name, F.lit(len(prefix) + 1)).rlike(r"\A[0-9]{14}\z")
    candidates = versions.select("version").filter(~hidden("version") & (named if prefix else F.lit(True)))
    return candidates.join(aliases.select("version"), "version", "left_anti")
