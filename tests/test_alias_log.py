from __future__ import annotations

import pytest

from docloom.operators.versions import alias_intervals, alias_state
from docloom.sinks import alias_log, publish, tables
from docloom.sinks.alias_log import AliasLog, PublishConflict, follow, publish_together
from tests.conftest import rows

LOG = "commit long, seq int, action string, version string, alias string"


def test_empty_log(spark, tmp_path):
    log = AliasLog(spark, str(tmp_path / "log"))
    assert log.latest() == 0
    assert rows(log.state()) == []
    assert rows(log.history()) == []
    assert rows(alias_intervals(spark.createDataFrame([], LOG))) == []


def test_commits_and_states(spark, tmp_path):
    log = AliasLog(spark, str(tmp_path))
    assert log.commit([("add", "v1", "a"), ("add", "v1", "b")], 0) == 1
    assert log.commit([("remove", "v1", "a"), ("add", "v2", "a")], 1) == 2
    assert log.commit([], 2) == 3
    assert log.latest() == 3
    assert rows(log.state(0)) == []
    assert rows(log.state(1)) == [("v1", "a"), ("v1", "b")]
    assert rows(log.state()) == [("v1", "b"), ("v2", "a")]
    with pytest.raises(ValueError):
        log.commit([("move", "v1", "a")], 3)


def test_a_second_publisher_is_refused(spark, tmp_path):
    first, second = AliasLog(spark, str(tmp_path)), AliasLog(spark, str(tmp_path))
    seen = second.latest()
    first.commit([("add", "v1", "a")], first.latest())
    with pytest.raises(PublishConflict):
        second.commit([("add", "v2", "a")], seen)
    assert rows(second.state()) == [("v1", "a")]
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == [f"{1:020d}.json"]
    assert second.commit([("remove", "v1", "a"), ("add", "v2", "a")], second.latest()) == 2
    assert rows(first.state()) == [("v2", "a")]


def test_intervals_hold_every_state(spark):
    entries = [
        (1, 0, "add", "v", "a"), (2, 0, "add", "v", "a"), (2, 1, "add", "w", "b"), (3, 0, "remove", "w", "a"),
        (4, 0, "remove", "v", "a"), (5, 0, "remove", "v", "a"), (5, 1, "add", "v", "a"), (6, 0, "add", "x", "a"), (6, 1, "remove", "x", "a"),
        (7, 0, "add", None, "a"),
    ]
    log = spark.createDataFrame(entries, LOG)
    spans = alias_intervals(log).collect()
    assert rows(alias_intervals(log)) == [(None, "a", 7, None), ("v", "a", 1, 4), ("v", "a", 5, None), ("w", "b", 2, None)]
    for n in range(9):
        state = {(r.version, r.alias) for r in spans if r.since <= n and (r.until is None or r.until > n)}
        assert state == {tuple(r) for r in alias_state(log.where(f"commit <= {n}")).collect()}


@pytest.fixture
def database(spark):
    name = "alias_log_test"
    tables.create_database(spark, name)
    for version, body in (("a_1", "one"), ("a_2", "two"), ("b_1", "uno")):
        documents = spark.createDataFrame([("1", body, 201, None, None)], "doc_id string, body string, status int, error_type string, error_reason string")
        publish.write_documents(documents, name, version)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def body(spark, database, alias):
    return spark.table(f"{database}.{alias}").first()["body"]


def test_aliases_move_together(spark, database, tmp_path, monkeypatch):
    log = AliasLog(spark, str(tmp_path))
    assert publish_together(spark, database, log, {"a": "a_1", "b": "b_1"}, {"a": 100, "b": 90}) == 1
    assert (body(spark, database, "a"), body(spark, database, "b")) == ("one", "uno")
    # One below the gate, a missing version, an outdated state: nothing moves.
    with pytest.raises(publish.PublishRefused):
        publish_together(spark, database, log, {"a": "a_2", "b": "b_1"}, {"a": 100, "b": 79})
    with pytest.raises(ValueError):
        publish_together(spark, database, log, {"a": "a_9"}, {"a": 100})
    with pytest.raises(PublishConflict):
        publish_together(spark, database, log, {"a": "a_2"}, {"a": 100}, seen=0)
    assert (log.latest(), body(spark, database, "a")) == (1, "one")
    # A publisher that stops after its commit is mended by the next one.
    with monkeypatch.context() as stopped:
        stopped.setattr(alias_log, "follow", lambda *_: None)
        publish_together(spark, database, log, {"a": "a_2"}, {"a": 100})
    assert body(spark, database, "a") == "one"
    follow(spark, database, log)
    assert body(spark, database, "a") == "two"
    assert rows(log.state()) == [("a_2", "a"), ("b_1", "b")]
    log.commit([("remove", "b_1", "b")], log.latest())
    follow(spark, database, log)
    assert not spark.catalog.tableExists(f"{database}.b")
