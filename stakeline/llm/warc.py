"""WARC archives written and read as a table of chunks.

A payload is a run of rows (record, chunk number) of bounded size, each carrying the length and
SHA-1 of the payload up to its end, so no step holds more than a chunk of a record beside the
digest's state. In the archive a chunk is a record of its own, by the format's segmentation: the
first one says response, those after it continuation. Archives are gzip files of one task each,
read from start to end by one task, so chunks of a record follow each other.

Records begin with the version line. Chunks also end inside any mention of the version in a
payload, so that line occurs nowhere else and Spark's text source finds the records.

Among records of equal payloads of ``REVISIT_BYTES`` or more, those of the largest id are
responses and the others revisit it, with an empty block. Null payloads are empty; null ids are
never the largest, and a null url is left out. Rows that share the largest id are all responses.
Long payloads are chunked whole. An empty table gives archives without records. Columns other
than id, url and payload are not written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeline.llm.common import as_bytes, sized
from stakeline.session import shared_dir
from stakeline.sources.sinks import stage_table

# Least payload that is stored once only, and most bytes of a chunk.
REVISIT_BYTES = 1000
CHUNK_BYTES = 1 << 18
BATCH_BYTES = 1 << 20

# Parts of the format.
VERSION = "WARC/1.1"
LINE = "\r\n"
REVISIT_PROFILE = "http://netpreservation.org/warc/1.1/revisit/identical-payload-digest"
RECORD_URN = "urn:page:"
_CUT = VERSION.encode().index(b"/")

RESPONSE, REVISIT, CONTINUATION = "response", "revisit", "continuation"


# --- which record holds a payload -------------------------------------------------------------


def with_revisits(pages: DataFrame, page_id: str, url: str, payload: str) -> DataFrame:
    """Columns id, url, payload, payload_bytes, payload_digest, refers_to (null: a response).

    Only payloads that occur more than once are joined back; their list is broadcast if a count
    shows it is short, else Spark splits the rows of a frequent payload.
    """
    text = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(
        F.col(page_id).cast("bigint").alias("id"),
        F.col(url).alias("url"),
        text.alias("payload"),
        F.octet_length(text).cast("bigint").alias("payload_bytes"),
        F.sha1(text).alias("payload_digest"),
    )
    repeated = (
        rows.where(F.col("payload_bytes") >= REVISIT_BYTES)
        .groupBy(F.col("payload_digest").alias("digest"))
        .agg(F.max("id").alias("holder"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND holder IS NOT NULL")
        .drop("n")
    )
    # Stored, so that the join can be split where a payload is very frequent.
    repeated = stage_table(repeated, "repeated_payloads")
    revisits = ~F.col("id").eqNullSafe(F.col("holder")) & F.col("holder").isNotNull()
    return rows.join(sized(repeated), F.col("payload_digest") == F.col("digest"), "left").select(
        "id",
        "url",
        # A revisit has no block of its own.
        F.when(~revisits, F.col("payload")).otherwise("").alias("payload"),
        "payload_bytes",
        "payload_digest",
        F.when(revisits, F.col("holder")).alias("refers_to"),
    )


# --- chunks -----------------------------------------------------------------------------------


def cuts(payload: bytes, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Begin and end of each chunk: at most ``most`` bytes, whole characters, no version text.

    An empty payload is one empty chunk.
    """
    version, at = VERSION.encode(), 0
    mention = payload.find(version)
    while True:
        end = min(at + most, len(payload))
        if -1 < mention < end:
            end = min(end, mention + _CUT)
            mention = payload.find(version, mention + 1)
        while end < len(payload) and payload[end] & 0xC0 == 0x80:
            end -= 1
        yield at, end
        at = end
        if at >= len(payload):
            return


CHUNKS = pa.schema(
    [
        ("id", pa.int64()),
        ("url", pa.string()),
        ("refers_to", pa.int64()),
        ("total_bytes", pa.int64()),
        ("total_digest", pa.string()),
        ("chunk", pa.int32()),
        ("last", pa.bool_()),
        ("data", pa.string()),
        ("bytes_so_far", pa.int64()),
        ("digest_so_far", pa.string()),
    ]
)
CHUNKS_DDL = (
    "id bigint, url string, refers_to bigint, total_bytes bigint, total_digest string,"
    " chunk int, last boolean, data string, bytes_so_far bigint, digest_so_far string"
)


def _emit(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    arrays = [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _chunk_batches(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    out, size = [], 0
    for rows in batches:
        ids, urls, refers, totals, digests = (rows[i].to_pylist() for i in (0, 1, 5, 3, 4))
        for i, payload in enumerate(as_bytes(rows[2])):
            running = hashlib.sha1()
            view = memoryview(payload)
            for chunk, (a, b) in enumerate(cuts(payload, most), start=1):
                running.update(view[a:b])
                head = (ids[i], urls[i], refers[i], totals[i], digests[i])
                data = str(view[a:b], "utf-8")
                out.append((*head, chunk, b == len(payload), data, b, running.hexdigest()))
                size += b - a
                if size > BATCH_BYTES:
                    yield _emit(out, CHUNKS)
                    out, size = [], 0
    if out:
        yield _emit(out, CHUNKS)


def chunk_table(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """The table of chunks of all payloads, revisits as one empty chunk."""
    return with_revisits(pages, page_id, url, payload).mapInArrow(
        lambda batches: _chunk_batches(batches, chunk_bytes), CHUNKS_DDL
    )


# --- archives ---------------------------------------------------------------------------------


def _urn(number: Column) -> Column:
    return F.concat(
        F.lit(f"<{RECORD_URN}"), F.coalesce(number.cast("string"), F.lit("null")), F.lit(">")
    )


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(LINE)), F.lit(""))


def _record(date: str) -> Column:
    """A chunk's record without the line end that the writer adds."""
    first, whole = F.col("chunk") == 1, (F.col("chunk") == 1) & F.col("last")
    revisit = F.col("refers_to").isNotNull()
    kind = F.when(~first, CONTINUATION).when(revisit, REVISIT).otherwise(RESPONSE)
    # Line breaks, blanks and the version's slash would break the header or the records.
    blank = F.regexp_replace("url", r"[\x00-\x20]", "%20")
    target = F.replace(blank, F.lit(VERSION), F.lit("WARC%2F1.1"))
    segment = F.when(first, _urn(F.col("id"))).otherwise(
        F.concat(
            F.lit(f"<{RECORD_URN}"),
            F.coalesce(F.col("id").cast("string"), F.lit("null")),
            F.lit(":"),
            F.col("chunk").cast("string"),
            F.lit(">"),
        )
    )
    return F.concat(
        F.lit(VERSION + LINE),
        _field("WARC-Type", kind),
        _field("WARC-Record-ID", segment),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", F.when(first, target)),
        _field("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), "total_digest"))),
        _field("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        _field("WARC-Refers-To", F.when(revisit, _urn(F.col("refers_to")))),
        _field("X-Payload-Length", F.when(revisit, F.col("total_bytes").cast("string"))),
        _field("WARC-Segment-Number", F.when(~whole, F.col("chunk").cast("string"))),
        _field("WARC-Segment-Origin-ID", F.when(~first, _urn(F.col("id")))),
        _field(
            "WARC-Segment-Total-Length",
            F.when(~first & F.col("last"), F.col("bytes_so_far").cast("string")),
        ),
        _field("Content-Type", F.when(first & ~revisit, F.lit("text/html"))),
        _field("Content-Length", F.octet_length("data").cast("string")),
        F.lit(LINE),
        F.col("data"),
        F.lit(LINE),
    )


def write_archives(chunks: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Writes a table of chunks as gzip archives, one per task.

    The rows of a task go out in their order; nothing is shuffled.
    """
    (
        chunks.select(_record(date).alias("value"))
        .write.option("lineSep", LINE)
        .option("compression", "gzip")
        .text(path)
    )


READ = pa.schema(
    [
        ("id", pa.int64()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("chunk", pa.int32()),
        ("last", pa.bool_()),
        ("data", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
    ]
)
READ_DDL = (
    "id bigint, record_type string, refers_to bigint, chunk int, last boolean, data string,"
    " payload_bytes bigint, payload_digest string"
)


def _number(urn: str | None) -> int | None:
    name = urn[1:-1].removeprefix(RECORD_URN).split(":")[0] if urn else "null"
    return None if name == "null" else int(name)


def _read_batches(batches: Iterator[pa.RecordBatch], keep: bool) -> Iterator[pa.RecordBatch]:
    running, first, length = hashlib.sha1(), {}, 0
    for rows in batches:
        out = []
        for value in as_bytes(rows[0]):
            if not value:
                continue  # what stands before the first record
            head, _, rest = value.partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split(LINE))
            block = memoryview(rest)[: int(fields["Content-Length"])]
            if fields["WARC-Type"] != CONTINUATION:
                running, first, length = hashlib.sha1(), fields, 0
            running.update(block)
            length += len(block)
            wanted = first["WARC-Payload-Digest"].removeprefix("sha1:")
            kind, digest, total = first["WARC-Type"], running.hexdigest(), length
            chunk = int(fields.get("WARC-Segment-Number", 1))
            last = "WARC-Segment-Number" not in fields or "WARC-Segment-Total-Length" in fields
            if kind == REVISIT:
                digest, total = wanted, int(first["X-Payload-Length"])
            elif last and digest != wanted:
                raise ValueError(f"payload of {first['WARC-Record-ID']} differs from its digest")
            own = (_number(first["WARC-Record-ID"]), kind, _number(first.get("WARC-Refers-To")))
            data = str(block, "utf-8") if keep else None
            out.append((*own, chunk, last, data, total, digest))
        yield _emit(out, READ)


def read_chunks(spark: SparkSession, path: str, data: bool = True) -> DataFrame:
    """The chunks of archives: record, chunk number, data, and length and digest so far.

    A payload whose digest is not the one its record names fails the job.
    """
    records = spark.read.option("lineSep", VERSION + LINE).text(path)
    return records.mapInArrow(lambda batches: _read_batches(batches, data), READ_DDL)


def read_records(spark: SparkSession, path: str, page_id: str = "page_id") -> DataFrame:
    """One row per record: id, payload_bytes, payload_digest, record_type, refers_to."""
    return (
        read_chunks(spark, path, data=False)
        .where("last")
        .select(
            F.col("id").alias(page_id),
            "payload_bytes",
            "payload_digest",
            "record_type",
            "refers_to",
        )
    )


def fresh_path(spark: SparkSession) -> str:
    """A new folder for archives, outside the folder of staged tables."""
    return f"{shared_dir(spark)}/results/{uuid4().hex}/warc"
