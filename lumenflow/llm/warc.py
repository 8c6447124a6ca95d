"""WARC archives: writing, reading, and resolving revisits by payload digest.

Archives are files of records: a header block, an empty line, the block, two
line ends. Spark's text writer makes them (gzip), with one record per row, so
they land in any store that Spark reaches; reading goes by each record's
Content-Length, so a payload may hold anything, record marks too. Reading
decompresses as a stream and holds one record at a time.

To resolve revisits only headers travel: digest, length, id. Each group of
equal digests elects its response with a combining aggregate (one row per task
and digest is shuffled, however hot the digest), and the elected rows of the
groups with more than one record join back. That join is left outer on the header
side, which Spark splits when one digest holds many rows. Payloads then
meet their record's decision by record id, which is unique, and the
deduplicated archives are written with fresh headers: a revisit has no
payload, and names its original record, digest and length.

Defined results: a null or empty payload is a response of 0 bytes, and equal to
other empty ones; a null url leaves out the target header; a null id sorts before
all others; of records with the same id and payload the one with the larger record
id is the response; an empty table makes no records; other columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RECORDS_PER_ARCHIVE = 5_000
BATCH_BYTES = 4 << 20

_END = "\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
RECORD_SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, source_id string, payload_bytes long, "
    "payload_digest string, refers_to_id string, refers_to_uri string, refers_to_source string, payload binary"
)
_FIELDS = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "source_id": "x-source-id",
    "refers_to_id": "warc-refers-to",
    "refers_to_uri": "warc-refers-to-target-uri",
    "refers_to_source": "x-refers-to-source-id",
}


def _header(name: str, value: Column) -> Column:
    """A header line, or null (left out by concat_ws) if the value is null."""
    return F.concat(F.lit(f"{name}: "), F.regexp_replace(value, "[\r\n]", " "))


def record_text(kind: Column, digest: Column, payload: Column, payload_bytes: Column, fields: dict[str, Column]) -> Column:
    """One record without the two line ends after it, which the writer adds."""
    http = F.concat(F.lit(_HTTP), F.lit("Content-Length: "), payload_bytes.cast("string"), F.lit(_END + _END))
    block = F.when(kind == "revisit", http).otherwise(F.concat(http, payload))
    return F.concat(
        F.concat_ws(
            _END,
            F.lit("WARC/1.0"),
            _header("WARC-Type", kind),
            *[_header(name, value) for name, value in fields.items()],
            _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
            _header("X-Payload-Length", payload_bytes.cast("string")),
            F.when(kind == "revisit", F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")),
            F.lit("Content-Type: application/http; msgtype=response"),
            F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
        ),
        F.lit(_END + _END),
        block,
    )


def _write(records: DataFrame, path: str, per_archive: int) -> None:
    (
        records.write.option("lineSep", _END + _END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", per_archive)
        .mode("errorifexists")
        .text(path)
    )


def _base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_archives(
    df: DataFrame, path: str, id_col: str, payload_col: str, uri_col: str | None = None, per_archive: int = RECORDS_PER_ARCHIVE
) -> None:
    """A response record per row of ``df`` in archives under ``path``; payloads are the strings in UTF-8."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = df.select(
        F.col(id_col).cast("string").alias("source_id"),
        (F.col(uri_col) if uri_col else F.lit(None)).cast("string").alias("uri"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("n"),
        F.expr("uuid()").alias("uuid"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
    )
    fields = {
        "WARC-Record-ID": F.concat(F.lit("<urn:uuid:"), F.col("uuid"), F.lit(">")),
        "WARC-Date": F.col("date"),
        "WARC-Target-URI": F.col("uri"),
        "X-Source-Id": F.col("source_id"),
    }
    # The digest header of a first record is left to the reader, which computes it from the payload.
    record = record_text(F.lit("response"), F.lit(None).cast("string"), F.col("payload"), F.col("n"), fields)
    _write(rows.select(record.alias("value")), path, per_archive)


def _records(stream: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record in a stream of bytes."""
    data, more = b"", True

    def fill(n: int) -> bool:
        nonlocal data, more
        parts, have = [data], len(data)
        while have < n and more:
            part = next(stream, None)
            if part is None:
                more = False
            else:
                parts.append(part)
                have += len(part)
        data = b"".join(parts)
        return have >= n

    while True:
        while (cut := data.find(b"\r\n\r\n")) < 0 and more:
            fill(len(data) + 1)
        if cut < 0:
            if data.strip():
                raise ValueError("an archive ends inside a record's header")
            return
        first, *lines = data[:cut].decode().split(_END)
        if not first.startswith("WARC/"):
            raise ValueError(f"no record begins here: {first[:40]!r}")
        head = {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in lines)}
        size = int(head["content-length"])
        if not fill(cut + 4 + size):
            raise ValueError("an archive ends inside a record's block")
        yield head, data[cut + 4 : cut + 4 + size]
        fill(cut + 4 + size + 4)
        data = data[cut + 4 + size + 4 :]


def _gunzip(content: bytes) -> Iterator[bytes]:
    """The data of all gzip members, a MB at a time; plain content as it is."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    while content:
        unpacker = zlib.decompressobj(31)
        while not unpacker.eof:
            part = unpacker.decompress(content, 1 << 20)
            if not part and not unpacker.unconsumed_tail and not unpacker.eof:
                raise ValueError("a gzip member is cut off")
            content = unpacker.unconsumed_tail
            if part:
                yield part
        content = unpacker.unused_data


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives under ``path``.

    payload_bytes and payload_digest are those of the full payload: computed for
    a response, taken from the headers of a revisit. ``payloads``: else null.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
    types = pa.schema([(n, pa.binary() if n == "payload" else pa.int64() if n == "payload_bytes" else pa.string()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        held = 0
        for batch in batches:
            for content in batch.column(0):
                for head, block in _records(_gunzip(content.as_py())):
                    row = {n: head.get(h) for n, h in _FIELDS.items()}
                    if head["warc-type"] == "revisit":
                        row["payload_bytes"] = int(head["x-payload-length"])
                        row["payload_digest"] = head["warc-payload-digest"].removeprefix("sha1:")
                    else:
                        payload = block[block.index(b"\r\n\r\n") + 4 :]
                        row["payload_bytes"], row["payload_digest"] = len(payload), _base32_sha1(payload)
                        if head.get("warc-payload-digest", "sha1:" + row["payload_digest"]) != "sha1:" + row["payload_digest"]:
                            raise ValueError(f"payload of {row['record_id']} doesn't match its digest")
                        if payloads:
                            row["payload"] = payload
                            held += len(payload)
                    rows.append(row)
                    if held >= BATCH_BYTES or len(rows) >= 10_000:
                        yield pa.RecordBatch.from_pylist(rows, types)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, types)

    return files.mapInArrow(run, RECORD_SCHEMA)


def resolve(headers: DataFrame, id_type: str = "long", min_bytes: int = 0) -> DataFrame:
    """record_id, kind, and the original's (o_id, o_uri, o_source, o_date) of each header.

    Of the records of at least ``min_bytes`` with equal digest and length, that with the
    largest source id is the response.
    """
    long_enough = F.col("payload_bytes") >= min_bytes
    order = F.struct(F.col("source_id").cast(id_type).alias("i"), "record_id", "target_uri", "source_id", "date")
    original = (
        headers.where(long_enough)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max(order).alias("o"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    return (
        headers.select("record_id", "payload_digest", "payload_bytes")
        .join(original, ["payload_digest", "payload_bytes"], "left")
        .select(
            "record_id",
            F.when(long_enough & (F.col("o.record_id") != F.col("record_id")), "revisit").otherwise("response").alias("kind"),
            F.col("o.record_id").alias("o_id"),
            F.col("o.target_uri").alias("o_uri"),
            F.col("o.source_id").alias("o_source"),
            F.col("o.date").alias("o_date"),
        )
    )


def write_deduplicated(
    spark: SparkSession, source: str, target: str, id_type: str = "long", min_bytes: int = 0, per_archive: int = RECORDS_PER_ARCHIVE
) -> None:
    """Writes the records of ``source`` to ``target``, repeated payloads as revisits."""
    decisions = resolve(read_archives(spark, source, payloads=False), id_type, min_bytes)
    rows = read_archives(spark, source).drop("refers_to_id", "refers_to_uri", "refers_to_source").join(decisions, "record_id")
    revisit = F.col("kind") == "revisit"
    fields = {
        "WARC-Record-ID": F.col("record_id"),
        "WARC-Date": F.col("date"),
        "WARC-Target-URI": F.col("target_uri"),
        "X-Source-Id": F.col("source_id"),
        "WARC-Refers-To": F.when(revisit, F.col("o_id")),
        "WARC-Refers-To-Target-URI": F.when(revisit, F.col("o_uri")),
        "WARC-Refers-To-Date": F.when(revisit, F.col("o_date")),
        "X-Refers-To-Source-Id": F.when(revisit, F.col("o_source")),
    }
    record = record_text(F.col("kind"), F.col("payload_digest"), F.col("payload").cast("string"), F.col("payload_bytes"), fields)
    _write(rows.select(record.alias("value")), target, per_archive)
