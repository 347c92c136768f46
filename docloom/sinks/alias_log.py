"""An append-only log of alias actions: several aliases move in one step.

Each commit is one file of JSON lines, named by its number. It is written under a
hidden name and renamed without overwriting, so of two publishers that saw the
same state one is refused and readers never see half a commit. This needs a
file system whose rename is atomic (HDFS, a local disk); object stores need a
connector that offers it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from docloom.operators.loads import MIN_SUCCESS
from docloom.operators.versions import alias_actions, alias_state
from docloom.sinks import publish, tables

ENTRY = "seq int, action string, version string, alias string"


class PublishConflict(RuntimeError):
    """Another publisher has committed since the state was read; nothing was changed."""


class AliasLog:
    """The log in the folder ``path``; commits are numbered 1, 2, 3, ..."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._fs = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._folder = self._fs.Path(self.path)
        self._system = self._folder.getFileSystem(self._conf)
        self._system.mkdirs(self._folder)

    def latest(self) -> int:
        """The number of the last commit, 0 for an empty log."""
        names = [status.getPath().getName() for status in self._system.listStatus(self._folder)]
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit()), default=0)

    def commit(self, actions: Sequence[tuple[str, str, str]], seen: int) -> int:
        """Append ``(action, version, alias)`` rows as the commit after ``seen``; gives its number.

        Raises :class:`PublishConflict` if that commit exists by now. Later
        actions of a commit win over earlier ones.
        """
        if wrong := {a for a, _, _ in actions} - {"add", "remove"}:
            raise ValueError(f"unknown actions {sorted(wrong)}")
        lines = [json.dumps({"seq": k, "action": a, "version": v, "alias": n}) for k, (a, v, n) in enumerate(actions)]
        hidden = self._fs.Path(self._folder, f".{uuid.uuid4().hex}")
        out = self._system.create(hidden, False)
        try:
            out.write(bytearray("".join(line + "\n" for line in lines).encode()))
        finally:
            out.close()
        number = seen + 1
        rename = getattr(self._fs, "Options$Rename")
        context = self._fs.FileContext.getFileContext(self._system.getUri(), self._conf)
        try:
            context.rename(
                self._system.makeQualified(hidden),
                self._system.makeQualified(self._fs.Path(self._folder, f"{number:020d}.json")),
                self.spark.sparkContext._gateway.new_array(rename, 0),
            )
        except Py4JJavaError as error:
            self._system.delete(hidden, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                raise PublishConflict(f"commit {number} of {self.path} was made by another publisher") from None
            raise
        return number

    def history(self) -> DataFrame:
        """``(commit, seq, action, version, alias)`` of all commits."""
        number = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)", 1).cast("long")
        rows = self.spark.read.schema(ENTRY).option("pathGlobFilter", "[0-9]*.json").json(self.path)
        return rows.select(number.alias("commit"), "seq", "action", "version", "alias")

    def state(self, at: int | None = None) -> DataFrame:
        """``(version, alias)`` after the commit ``at``, by default the last one."""
        return alias_state(self.history().where(F.col("commit") <= (self.latest() if at is None else at)))


def follow(spark: SparkSession, database: str, log: AliasLog) -> None:
    """Point the views of all aliases of ``log`` where its last commit says.

    Repeating it changes nothing, so it also mends a publisher that stopped
    between its commit and the views.
    """
    wanted: dict[str, str | None] = {row["alias"]: None for row in log.history().select("alias").distinct().collect()}
    for row in log.state().collect():
        if wanted[row["alias"]]:
            raise ValueError(f"alias {row['alias']!r} has several versions")
        wanted[row["alias"]] = row["version"]
    for alias, version in sorted(wanted.items()):
        if version is None:
            spark.sql(f"DROP VIEW IF EXISTS {tables.quoted(database, alias)}")
        elif tables.target_of(spark, database, alias) != version:
            publish.swap_alias(spark, database, alias, version)


def publish_together(
    spark: SparkSession,
    database: str,
    log: AliasLog,
    targets: Mapping[str, str],
    success: Mapping[str, int],
    min_success: int = MIN_SUCCESS,
    seen: int | None = None,
) -> int:
    """Move each alias of ``targets`` to its version in one commit; gives its number.

    All must pass the gate with their percentage of ``success``, or none moves.
    ``seen`` is the commit the decision was based on, by default the last one.
    """
    for alias, version in targets.items():
        publish.require_success(alias, success.get(alias, 0), min_success)
        if not spark.catalog.tableExists(tables.quoted(database, version)):
            raise ValueError(f"no version {version!r} in {database!r}")
    seen = log.latest() if seen is None else seen
    wanted = spark.createDataFrame([(v, a) for a, v in targets.items()], "version string, alias string")
    actions = [tuple(r) for r in alias_actions(log.state(seen), wanted).collect()]  # a few rows an alias
    number = log.commit(actions, seen)
    follow(spark, database, log)
    return number
