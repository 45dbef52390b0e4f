"""WARC archives, and their deduplication by revisit resolution.

Archives are written by Spark's text writer: a row is a record, and the line
separator is the two line ends that close a record, so any store that
Spark writes to will do. Files are compressed as a whole by the writer. Archives are
read as whole files and parsed by content length, so payloads may hold anything.
Bytes of a file are bounded: records are written by classes of size, each in a
directory of its own, with as many records a file as ``FILE_BYTES`` hold; a
record larger than that has a file of its own.

Resolution shuffles record headers, not payloads: the headers meet by payload
digest, where the record with the largest page id stays a response; the
deduplicated archive gets fresh headers, and only responses carry a payload.
Reading it joins revisit records to the responses they refer to.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwatch.llm.common import ship_code, stored
from tickwatch.session import scratch_path

#: Uncompressed bytes of an archive file, about, at most: bounds what one task holds.
FILE_BYTES = 1 << 27
#: Bytes of the smallest class's records at most; each further class takes four times as many.
SMALL_RECORD = 1 << 16
#: Bytes of a record's headers without its address, at most.
HEADER_BYTES = 1 << 11
#: Fixed values of the format.
VERSION = "WARC/1.1"
END = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BASE32 = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def sha1_base32(payload: Column) -> Column:
    """SHA-1 in base32: ten hexadecimal digits are eight base32 digits."""
    digest = F.sha1(payload.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), *_BASE32)


def record_id(name: Column) -> Column:
    """A record id made of a name's md5."""
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(
        F.md5(name.cast("binary")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value; line ends inside a value would end the header and become spaces."""
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), F.regexp_replace(value, r"[\x00-\x1F]+", " "), F.lit(END)))


def size_class(payload_bytes: Column, *addresses: Column) -> Column:
    """Class of a record's size: 0 up to ``SMALL_RECORD`` bytes, k up to 4^k times as many."""
    size = sum((F.coalesce(n, F.lit(0)) for n in (payload_bytes, *map(F.octet_length, addresses))), F.lit(HEADER_BYTES))
    return F.greatest(F.ceil(F.log2(size / SMALL_RECORD) / 2), F.lit(0)).cast("int")


def present_classes(classes: DataFrame) -> list[int]:
    """The distinct values of a column of classes (some twenty at most; 0 for no rows)."""
    return sorted(r[0] for r in classes.distinct().collect()) or [0]


def write_archive(records: DataFrame, path: str, kind: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Add to the archive one WARC record per row of ``type, record_id, page_id, uri, digest,
    refers_to, refers_to_uri, payload``, all at most of size class ``kind``. A null payload
    (of a revisit) leaves the record without one."""
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}{END}"),
                    F.coalesce("payload", F.lit("")))
    revisit = F.col("type") == "revisit"
    head = F.concat_ws(
        "", F.lit(VERSION + END), _line("WARC-Type", F.col("type")), _line("WARC-Record-ID", F.col("record_id")),
        _line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", F.col("uri")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        _line("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        _line("WARC-Refers-To", F.col("refers_to")), _line("WARC-Refers-To-Target-URI", F.col("refers_to_uri")),
        _line("X-Page-ID", F.col("page_id").cast("string")),
        F.lit(f"Content-Type: application/http;msgtype=response{END}"))
    blocks = records.select(head.alias("head"), http.alias("block"))
    value = F.concat("head", F.lit("Content-Length: "), F.octet_length("block").cast("string"), F.lit(END + END), "block")
    blocks.select(value.alias("value")).write.mode("append").option("lineSep", END + END).option("compression", "gzip").option(
        "maxRecordsPerFile", max(1, FILE_BYTES // (SMALL_RECORD << 2 * kind))).text(f"{path}/size_class={kind}")


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record of an uncompressed archive."""
    at = 0
    while at < len(data):
        body = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:body].split(b"\r\n")
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {}
        for line in lines:
            name, _, value = line.partition(b":")
            headers[name.strip().lower().decode("ascii")] = value.strip().decode("utf-8")
        end = body + 4 + int(headers["content-length"])
        if data[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end at its length")
        yield headers, data[body + 4:end]
        at = end + 4


RECORD = "type string, record_id string, page_id {0}, uri string, digest string, refers_to string, payload_bytes bigint, payload binary, size_class int"


def read_archive(spark: SparkSession, path: str, payloads: bool = False, id_type: str = "bigint", kind: int | None = None) -> DataFrame:
    """The records of all archive files below ``path``, or of those of one size class.

    ``digest`` and ``payload_bytes`` of a record with a payload are those of the
    bytes read; a revisit's digest is its header's, its size null. ``payload`` is null without ``payloads``.
    """
    ship_code()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["type", "record_id", "page_id", "uri", "digest", "refers_to", "payload_bytes", "payload", "size_class"]
        kinds = [pa.string()] * 6 + [pa.int64(), pa.binary(), pa.int32()]

        def batch_of(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for content, size_class in zip(batch.column(0), batch.column(1).to_pylist()):
                rows, size = [], 0
                for h, block in parse_records(gzip.decompress(content.as_py())):
                    digest, payload = h.get("warc-payload-digest", "").removeprefix("sha1:"), None
                    if h["warc-type"] == "response":
                        payload = block[block.index(b"\r\n\r\n") + 4:]
                        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")
                    rows.append((h["warc-type"], h["warc-record-id"], h.get("x-page-id"), h.get("warc-target-uri"), digest,
                                 h.get("warc-refers-to"), None if payload is None else len(payload), payload if payloads else None, size_class))
                    size += len(block)
                    if size > 1 << 23:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option(
        "basePath", path).load(path if kind is None else f"{path}/size_class={kind}").select("content", F.col("size_class").cast("int"))
    read = files.mapInArrow(run, RECORD.format("string"))
    return read.withColumn("page_id", F.col("page_id").cast(id_type))


def capture(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write one response record per page (null html: an empty payload)."""
    payload = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    size = size_class(F.octet_length(payload), F.col(f"`{url_col}`"))
    name = F.concat_ws(":", F.lit("capture"), size, F.monotonically_increasing_id(), F.col(f"`{id_col}`"))
    records = lambda rows: rows.select(
        F.lit("response").alias("type"), record_id(name).alias("record_id"), F.col(f"`{id_col}`").alias("page_id"),
        F.col(f"`{url_col}`").alias("uri"), sha1_base32(payload).alias("digest"), F.lit(None).cast("string").alias("refers_to"),
        F.lit(None).cast("string").alias("refers_to_uri"), payload.alias("payload"))
    for kind in present_classes(pages.select(size)):
        write_archive(records(pages.where(size == kind)), path, kind)


def deduplicate(spark: SparkSession, source: str, target: str, least_bytes: int = 0, id_type: str = "bigint") -> None:
    """Rewrite the archives below ``source`` to ``target`` with equal payloads stored once.

    Of the responses with equal payloads (digest and size) of ``least_bytes``
    or more, that with the largest page id (ties: the largest record id) stays,
    the others become revisits of it; smaller ones all stay.
    """
    headers = stored(read_archive(spark, source, id_type=id_type).where("type = 'response'").select(
        "record_id", "page_id", "uri", "digest", "payload_bytes", "size_class"), "warc-headers")
    large = headers.where(F.col("payload_bytes") >= least_bytes)
    originals = large.groupBy("digest", "payload_bytes").agg(F.max(F.struct("page_id", "record_id", "uri")).alias("o"))
    roles = stored(
        headers.join(originals, ["digest", "payload_bytes"], "left").withColumn(
            "original", F.col("o.record_id").isNull() | (F.col("o.record_id") == F.col("record_id"))), "warc-roles")
    fresh = lambda c: record_id(F.concat(F.lit("deduplicated:"), c))
    nothing = F.lit(None).cast("string")
    plain = size_class(F.lit(0), F.col("uri"), F.col("o.uri"))
    revisits = roles.where("NOT original").select(
        F.lit("revisit").alias("type"), fresh(F.col("record_id")).alias("record_id"), "page_id", "uri", "digest",
        fresh(F.col("o.record_id")).alias("refers_to"), F.col("o.uri").alias("refers_to_uri"), nothing.alias("payload"),
        plain.alias("size_class"))

    def responses(kind: int) -> DataFrame:
        bodies = read_archive(spark, source, True, id_type, kind).select("record_id", F.col("payload").cast("string").alias("payload"))
        return bodies.join(roles.where(F.col("original") & (F.col("size_class") == kind)), "record_id").select(
            F.lit("response").alias("type"), fresh(F.col("record_id")).alias("record_id"), "page_id", "uri", "digest",
            nothing.alias("refers_to"), nothing.alias("refers_to_uri"), "payload")

    sizes = [{r[0] for r in part.distinct().collect()} for part in (roles.where("original").select("size_class"), revisits.select("size_class"))]
    for kind in sorted(sizes[0] | sizes[1]) or [0]:
        without_payload = revisits.where(F.col("size_class") == kind).drop("size_class")
        write_archive(responses(kind).unionByName(without_payload) if kind in sizes[0] or not sizes[1] else without_payload, target, kind)


def resolved(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """Every record of a deduplicated archive as if it had its payload: ``page_id,
    payload_bytes, payload_digest, record_type, refers_to`` (the page id of the response a revisit refers to)."""
    records = stored(read_archive(spark, path, id_type=id_type).drop("payload"), "warc-records")
    responses = records.where("type = 'response'").select(
        F.col("record_id").alias("refers_to"), F.col("page_id").alias("original"), F.col("payload_bytes").alias("size"))
    joined = records.where("type = 'revisit'").join(responses, "refers_to", "left").select(
        "page_id", F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
        F.col("original").alias("refers_to"))
    own = records.where("type = 'response'").select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
        F.lit(None).cast(id_type).alias("refers_to"))
    return own.unionByName(joined)


def archived_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   least_bytes: int = 0) -> DataFrame:
    """Write all pages to archives, deduplicate these, and read the result back: one row per page.

    The archives stay below the shared checkpoint folder. Null html is an empty
    payload, null urls and ids give no header; repeated rows are records of
    their own; an empty table gives empty archives and no rows.
    """
    spark, id_type = pages.sparkSession, pages.schema[id_col].dataType.simpleString()
    first, second = scratch_path(spark, "warc"), scratch_path(spark, "warc-deduplicated")
    capture(pages, first, id_col, url_col, html_col)
    deduplicate(spark, first, second, least_bytes, id_type)
    return resolved(spark, second, id_type).withColumnRenamed("page_id", id_col)
