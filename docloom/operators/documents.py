"""Documents: append, keep-last, bulk lines and batches."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from docloom.functions.shaping import doc_type_name

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BATCH_DOCS = 200
BATCH_BYTES = 5_000_000


def append_documents(dfs: Sequence[DataFrame], rank: str = "statement") -> DataFrame:
    """All rows of all statements, columns matched by name.

    Columns a statement lacks are NULL. ``rank`` is the statement's position,
    the tie-break when an id occurs in several statements.
    """
    ranked = [df.withColumn(rank, F.lit(i)) for i, df in enumerate(dfs)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)


def keep_last(df: DataFrame, id_key: str, order: Sequence[str]) -> DataFrame:
    """The last row per ``id_key`` in the order of ``order``, then of all other columns.

    A partial maximum runs before the shuffle, so repeated ids cost at most
    one row per map task. Columns must be orderable (no map or variant).
    """
    rest = [c for c in df.columns if c != id_key and c not in order]
    best = df.groupBy(id_key).agg(F.max(F.struct(*order, *rest)).alias("best"))
    return best.select(*[c if c == id_key else F.col(f"best.`{c}`") for c in df.columns])


def bulk_line(doc_type: Column | str) -> Column:
    """Action line and body line of one document, from ``doc_id`` and ``body``."""
    kind = doc_type if isinstance(doc_type, Column) else F.lit(doc_type)
    action = F.to_json(
        F.struct(
            F.struct(F.col("doc_id").alias("_id"), doc_type_name(kind).alias("_type")).alias("index")
        ),
        {"ignoreNullFields": "false"},
    )
    return F.concat(action, F.lit("\n"), F.col("body"), F.lit("\n"))


def to_bulk_lines(documents: DataFrame, doc_type: Column | str = "_doc") -> DataFrame:
    """``(doc_id, value)``: each ``(doc_id, body)`` document as bulk request text."""
    return documents.select("doc_id", bulk_line(doc_type).alias("value"))


def _batches(
    frames: Iterator[pd.DataFrame], max_docs: int, max_bytes: int, shard: str | None
) -> Iterator[pd.DataFrame]:
    ids: list[str] = []
    lines: list[str] = []
    size = 0
    current = None
    number = 0

    def flush() -> pd.DataFrame:
        return pd.DataFrame(
            {
                "shard": [current],
                "batch": [number],
                "n_docs": [len(ids)],
                "n_bytes": [size],
                "doc_ids": [list(ids)],
                "payload": ["".join(lines)],
            }
        )

    for frame in frames:
        shards = frame[shard] if shard else [None] * len(frame)
        for where, doc_id, line in zip(shards, frame["doc_id"], frame["value"]):
            where = None if where is None or where != where else int(where)
            if where != current:
                if ids:
                    yield flush()
                ids, lines, size, number = [], [], 0, 0
                current = where
            ids.append(doc_id)
            lines.append(line)
            size += len(line.encode("utf-8"))
            if len(ids) == max_docs or size >= max_bytes:
                yield flush()
                ids, lines, size = [], [], 0
                number += 1
    if ids:
        yield flush()


def bulk_batches(
    lines: DataFrame,
    max_docs: int = BATCH_DOCS,
    max_bytes: int = BATCH_BYTES,
    shard: str | None = None,
    order: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """``(shard, batch, n_docs, n_bytes, doc_ids, payload)``: request bodies of bulk lines.

    A batch ends at ``max_docs`` documents or once it holds ``max_bytes``. By
    default the partitions are batched as they are, without a shuffle, and
    ``shard`` is NULL. With ``shard`` (a long column) the lines are
    partitioned by it and batched in ``order`` within it, which makes batch
    numbers reproducible; choose shards of bounded size, such as key ranges.
    Lines of the shard NULL are spread over tasks, each numbering its own batches.
    State is one open batch per task.
    """
    rows = lines
    if shard:
        # A shard of its own hash for each line without one.
        dealt = F.coalesce(F.col(shard), F.xxhash64("doc_id", "value"))
        rows = rows.repartition(partitions, dealt) if partitions else rows.repartition(dealt)
        rows = rows.sortWithinPartitions(shard, *order).select(shard, "doc_id", "value")
    else:
        rows = rows.select("doc_id", "value")
    return rows.mapInPandas(
        lambda frames: _batches(frames, max_docs, max_bytes, shard),
        "shard long, batch long, n_docs long, n_bytes long, doc_ids array<string>, payload string",
    )


def deliver(
    batches: DataFrame, send: Callable[[str], Sequence[tuple[int, str | None, str | None]]]
) -> DataFrame:
    """``(doc_id, status, error_type, error_reason)``: hand each payload to ``send``.

    ``send`` gets one request body and returns one ``(status, type, reason)``
    per document. If it raises, every document of the batch counts as failed.
    A retried task sends its batches again: the ``index`` action is idempotent.
    """

    def call(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for ids, payload in zip(frame["doc_ids"], frame["payload"]):
                try:
                    answers = list(send(payload))
                    if len(answers) != len(ids):
                        raise ValueError(f"{len(answers)} answers for {len(ids)} documents")
                except Exception as error:
                    answers = [(500, type(error).__name__, str(error))] * len(ids)
                statuses, kinds, reasons = zip(*answers)
                yield pd.DataFrame(
                    {
                        "doc_id": list(ids),
                        "status": list(statuses),
                        "error_type": list(kinds),
                        "error_reason": list(reasons),
                    }
                )

    return batches.select("doc_ids", "payload").mapInPandas(
        call, "doc_id string, status int, error_type string, error_reason string"
    )
