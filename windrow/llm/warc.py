"""WARC archives and the resolution of revisits (operator 2).

Archives are written and read by Spark's text source, so they can lie in any store it reaches:
a record is header lines, an empty line and the payload's bytes, and the line separator of the
writer is the blank pair that ends a record. On reading, a file's pieces are put together
again in order and cut by ``Content-Length``, so a payload may hold any bytes.

Resolution shuffles headers only: the largest id of each payload digest is aggregated, then
joined back; the join may split a digest with very many records. Payloads move once, when each
record is written again with fresh headers, revisits without their payload.

- null payload: an empty one; empty payloads are equal to each other;
- payloads smaller than ``min_bytes``: always responses;
- several rows with one id and payload: the id's rows are all responses, or all revisits;
- null id: written and read back as null; such a record is never the response others refer to,
  unless all records of its payload have a null id: then all are responses;
- line ends within a url are written as percent escapes; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm.common import in_batches, load
from windrow.llm.registry import query
from windrow.session import scratch_dir

#: Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NUMBERS = ("WARC-Page-ID", "WARC-Payload-Length", "WARC-Refers-To-Page")
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORD = "id long, url string, type string, digest string, payload_bytes long, refers_to long, payload binary"


def payload_digest(payload: Column) -> Column:
    """SHA-1 in base32: eight groups of twenty bits, four letters each."""
    hexes = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexes, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def write_archive(records: DataFrame, folder: str, date: str) -> None:
    """One record per row of ``id, url, type, digest, payload_bytes, refers_to, payload``.

    A revisit is written without its payload and names the record it repeats.
    """
    payload = F.when(F.col("type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    number = F.coalesce(F.col("id").cast("string"), F.lit("none"))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    header = F.concat(
        F.lit(f"{VERSION}\r\n"),
        _header("WARC-Type", F.col("type")),
        _header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), number, F.lit(f":{date}>"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", url),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _header("WARC-Page-ID", F.col("id")),
        _header("WARC-Payload-Length", F.col("payload_bytes")),
        _header("WARC-Refers-To-Page", F.col("refers_to")),
        _header("WARC-Profile", F.when(F.col("type") == "revisit", F.lit(SAME_PAYLOAD))),
        F.lit("Content-Type: application/octet-stream\r\n"),
        _header("Content-Length", F.octet_length(payload)),
        F.lit("\r\n"),
    )
    # Spark strings are bytes: the cast keeps a payload as it is, whether valid UTF-8 or not.
    lines = records.select(F.concat(header.cast("binary"), payload).cast("string").alias("record"))
    lines.write.option("compression", "gzip").option("lineSep", END).text(folder)


def _fields(head: bytes) -> dict[str, str]:
    """Header lines of a record by name."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"no record where one should start: {lines[0][:80]!r}")
    return dict(line.split(": ", 1) for line in lines[1:])


class Bytes:
    """The bytes of archives whose pieces, cut at every blank pair, come in order.

    Every piece is taken to have been followed by a blank pair. That is one too many after the
    last piece of a file, so stray line ends before a record are skipped.
    """

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held = pieces, b""

    def fill(self, size: int) -> None:
        """Hold at least ``size`` bytes, or all that are left."""
        parts, have = [self.held], len(self.held)
        while have < size and (piece := next(self.pieces, None)) is not None:
            parts += [piece, END.encode()]
            have += len(piece) + len(END)
        self.held = b"".join(parts)

    def take(self, size: int) -> bytes:
        self.fill(size)
        if len(self.held) < size:
            raise ValueError("an archive ends within a record")
        taken, self.held = self.held[:size], self.held[size:]
        return taken

    def head(self) -> bytes | None:
        """The header lines of the next record; None at the end."""
        self.held = self.held.lstrip(b"\r\n")
        while not self.held:
            self.fill(1)
            if not self.held:
                return None
            self.held = self.held.lstrip(b"\r\n")
        while END.encode() not in self.held:
            have = len(self.held)
            self.fill(have + 1)
            if len(self.held) == have:
                raise ValueError("an archive ends within a header")
        head, _, self.held = self.held.partition(END.encode())
        return head


def records_of(pieces: Iterator[bytes], payloads: bool) -> Iterator[tuple]:
    """Records of archives that were cut at every blank pair, the pieces in order."""
    stream = Bytes(pieces)
    while (head := stream.head()) is not None:
        fields = _fields(head)
        payload = stream.take(int(fields["Content-Length"]))
        number = {name: int(fields[name]) for name in NUMBERS if name in fields}
        yield (
            number.get("WARC-Page-ID"),
            fields.get("WARC-Target-URI"),
            fields["WARC-Type"],
            fields["WARC-Payload-Digest"].removeprefix("sha1:"),
            number.get("WARC-Payload-Length"),
            number.get("WARC-Refers-To-Page"),
            payload if payloads else None,
        )


def read_archive(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of an archive folder, as ``write_archive`` takes them."""
    text = spark.read.option("lineSep", END).schema("value string").text(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = (piece for batch in batches for piece in batch.column(0).to_pylist())
        rows, size = [], 0
        for row in records_of(pieces, payloads):
            rows.append(row)
            size += 200 + len(row[-1] or b"")
            if size > 4 << 20:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)

    # A compressed file can't be split, so each partition holds whole files, rows in order.
    return in_batches(text.select(F.col("value").cast("binary").alias("value")), run, RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    names = [field.split()[0] for field in RECORD.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def response_records(pages: DataFrame, page_id: str, url: str, payload: str) -> DataFrame:
    """Pages as response records with their digests."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    return pages.select(
        F.col(page_id).cast("long").alias("id"),
        F.col(url).alias("url"),
        F.lit("response").alias("type"),
        payload_digest(body).alias("digest"),
        F.octet_length(body).cast("long").alias("payload_bytes"),
        F.lit(None).cast("long").alias("refers_to"),
        body.alias("payload"),
    )


def resolve_revisits(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """The id that each revisit repeats: ``id, digest, refers_to``, revisits only."""
    large = headers.where(F.col("payload_bytes") >= min_bytes).select("id", "digest")
    # Grouped by a struct, the few rows found are dealt anew for the join, whose both sides are
    # then plain shuffles: adaptive execution can split a digest with very many records.
    newest = large.groupBy(F.struct("digest").alias("key")).agg(F.max("id").alias("refers_to"), F.count("*").alias("copies"))
    newest = newest.where("copies > 1 and refers_to is not null").select("key.digest", "refers_to")
    return (
        large.join(newest, "digest")
        .where(~F.col("id").eqNullSafe(F.col("refers_to")))
        .select("id", "digest", "refers_to")
        .distinct()
    )


def dedup_archive(spark: SparkSession, source: str, target: str, date: str, min_bytes: int = 0) -> None:
    """Write the records of ``source`` to ``target``, repeated payloads as revisits."""
    revisits = resolve_revisits(read_archive(spark, source, payloads=False), min_bytes)
    revisits = revisits.withColumnsRenamed({"id": "again", "digest": "same", "refers_to": "response"})
    records = read_archive(spark, source)
    joined = records.join(revisits, F.col("id").eqNullSafe(F.col("again")) & (F.col("digest") == F.col("same")), "left")
    fresh = joined.select(
        "id",
        "url",
        F.when(F.col("same").isNotNull(), F.lit("revisit")).otherwise(F.col("type")).alias("type"),
        "digest",
        "payload_bytes",
        F.coalesce("response", "refers_to").alias("refers_to"),
        "payload",
    )
    write_archive(fresh, target, date)


def warc_roundtrip(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0
) -> DataFrame:
    """Write pages as an archive, dedup it, read the result's records.

    Returns ``page_id, url, record_type, payload_digest, payload_bytes, refers_to`` per page,
    size and digest those of the full payload.
    """
    spark = pages.sparkSession
    folder = scratch_dir(spark, "warc")
    write_archive(response_records(pages, page_id, url, payload), f"{folder}/all", "2024-01-01T00:00:00Z")
    dedup_archive(spark, f"{folder}/all", f"{folder}/deduplicated", "2024-01-02T00:00:00Z", min_bytes)
    return read_archive(spark, f"{folder}/deduplicated", payloads=False).select(
        F.col("id").alias("page_id"),
        "url",
        F.col("type").alias("record_type"),
        F.col("digest").alias("payload_digest"),
        "payload_bytes",
        "refers_to",
    )


OP2_SQL = """
WITH digests AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex
  FROM pages),
named AS (
  SELECT page_id, payload_bytes, translate(
    list_aggregate(list_transform(range(0, 8), lambda i:
      lpad(to_base(('0x' || substr(hex, (1 + 5 * i)::INT, 5))::BIGINT, 32), 4, '0')), 'string_agg', ''),
    '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest
  FROM digests),
newest AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS response FROM named)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> response THEN response END AS refers_to
FROM newest
"""


@query("op2_warc_revisits", OP2_SQL)
def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through archives, as their records after resolution say."""
    records = warc_roundtrip(load(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
