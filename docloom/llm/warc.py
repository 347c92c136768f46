"""WARC archives with revisit records for repeated payloads.

Archives are text files written by Spark's own writer with the record end
``CR LF CR LF`` as the line separator, gzip-compressed as a whole: each record
is a header block, an empty line and the payload.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MIN_REVISIT_BYTES = 100
#: Records per archive file: a reader holds one compressed file.
RECORDS_PER_FILE = 1_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"

RECORD_SCHEMA = (
    "page_id string, url string, record_type string, payload_digest string, payload_bytes long, "
    "refers_to string, payload binary"
)


def page_headers(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """``pages`` with ``_payload``, ``_bytes`` and ``_digest`` (SHA-256 of the UTF-8 payload)."""
    payload = F.coalesce(F.col(html), F.lit(""))
    return pages.withColumns({"_payload": payload, "_bytes": F.octet_length(payload).cast("long"), "_digest": F.sha2(payload, 256)})


def resolve_revisits(headers: DataFrame, min_bytes: int = MIN_REVISIT_BYTES, order: str = "page_id") -> DataFrame:
    """``(_digest, _first)``: the smallest id of each payload found more than once.

    Only digests and ids are shuffled, combined in the map tasks first.
    """
    return (
        headers.where(F.col("_bytes") >= min_bytes)
        .groupBy("_digest")
        .agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_first"))
        .where("_n > 1")
        .select("_digest", "_first")
    )


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(name + ": "), value, F.lit("\r\n"))


def _uri(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.url_encode(page_id.cast("string")), F.lit("")), F.lit(">"))


def write_archives(
    pages: DataFrame,
    originals: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    date: str = DATE,
) -> None:
    """Write one record per page to archives under ``path``.

    A page whose payload has an original with another id becomes a revisit
    that names it and carries no payload; headers are written afresh, with
    digest and length of the full payload. Line ends in a URL are encoded;
    a null URL has no target header. Twins of the original's row are responses.
    """
    # Only what records hold, so no other column of the pages can clash.
    joined = page_headers(pages.select(page_id, url, html), page_id, html).join(originals, "_digest", "left")
    revisit = F.coalesce(~F.col(page_id).eqNullSafe(F.col("_first")), F.lit(False)) & F.col("_first").isNotNull()
    target = F.regexp_replace(F.regexp_replace(F.col(url), "\r", "%0D"), "\n", "%0A")
    kind = F.when(revisit, "revisit").otherwise("response")
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", _uri(F.col(page_id))),
        _line("WARC-Date", F.lit(date)),
        F.coalesce(_line("WARC-Target-URI", target), F.lit("")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("_digest"))),
        _line("X-Payload-Length", F.col("_bytes").cast("string")),
        F.when(
            revisit, F.concat(_line("WARC-Profile", F.lit(PROFILE)), _line("WARC-Refers-To", _uri(F.col("_first"))))
        ).otherwise(_line("Content-Type", F.lit("text/html; charset=utf-8"))),
        _line("Content-Length", F.when(revisit, "0").otherwise(F.col("_bytes").cast("string"))),
        F.lit("\r\n"),
        F.when(revisit, "").otherwise(F.col("_payload")),
    )
    (
        joined.select(record.alias("value"))
        .write.option("lineSep", _END.decode())
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(path)
    )


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and payload of each record."""
    at = 0
    while at < len(data):
        end = data.index(_END, at)
        version, *lines = data[at:end].decode("utf-8").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {k.lower(): v.strip() for k, v in (x.split(":", 1) for x in lines)}
        start = end + len(_END)
        stop = start + int(fields["content-length"])
        if data[stop : stop + len(_END)] != _END:
            raise ValueError(f"record at byte {at} has no end")
        yield fields, data[start:stop]
        at = stop + len(_END)


def _page_of(uri: str | None) -> str | None:
    found = re.fullmatch(r"<urn:page:(.*)>", uri or "")
    return unquote(found[1].replace("+", " ")) if found and found[1] else None


def _row(fields: dict[str, str], payload: bytes) -> dict:
    kind = fields["warc-type"]
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    return {
        "page_id": _page_of(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "record_type": kind,
        "payload_digest": digest,
        "payload_bytes": int(fields["x-payload-length"]) if kind == "revisit" else len(payload),
        "refers_to": _page_of(fields.get("warc-refers-to")),
        "payload": payload if kind == "response" else None,
    }


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives under ``path``; ids as text.

    Responses are checked against their digest. Without ``payloads`` that
    column is null.
    """
    schema = pa.schema([
        ("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()), ("refers_to", pa.string()), ("payload", pa.binary()),
    ])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for fields, payload in parse_records(gzip.decompress(content.as_py())):
                    rows.append(_row(fields, payload))
                    if not payloads:
                        rows[-1]["payload"] = None
                    if len(rows) == 200:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(parse, RECORD_SCHEMA)


def with_payloads(records: DataFrame) -> DataFrame:
    """``records`` with the payload of each revisit taken from the response it refers to."""
    originals = records.where("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), F.col("payload").alias("_original")
    )
    return records.join(originals, "refers_to", "left").withColumn("payload", F.coalesce("payload", "_original")).drop("_original")


def dedup_archives(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_bytes: int = MIN_REVISIT_BYTES,
) -> DataFrame:
    """Write ``pages`` as deduplicated archives under ``path`` and read them back.

    Null html is an empty payload; payloads under ``min_bytes`` are always
    responses. Null ids are written without an id and never are an original
    unless all their payload's ids are null, when all stay responses. Repeated
    rows give repeated records. An empty table gives empty archives.
    """
    from docloom.llm.common import Scratch

    spark = pages.sparkSession
    headers = page_headers(pages, page_id, html).select(page_id, "_bytes", "_digest")
    originals = Scratch(spark, "warc").table(resolve_revisits(headers, min_bytes, page_id), "originals")
    write_archives(pages, originals, path, page_id, url, html)
    return read_archives(spark, path)
