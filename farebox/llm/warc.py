"""Web captures as WARC archives: written by Spark, read back, and assembled into captures.

A capture is three records: the response (or a revisit of an equal payload),
the request, and metadata; the latter two name the first in
``WARC-Concurrent-To``. Archives are gzip streams of whole records, cut by a
number of bytes, so that one archive fits a task.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from farebox.llm.frames import mapped, no_shuffle_files_left

ARCHIVE_BYTES = 8 << 20
LEAST_REVISIT = 1000
ROWS_BYTES = 4 << 20
DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"

RECORD_SCHEMA = (
    "record_id string, record_type string, concurrent_to array<string>, refers_to string, target_uri string, "
    "payload_digest string, payload_bytes bigint, content_length bigint, fields map<string,string>, payload binary"
)


def _record_id(kind: str, *parts: Column) -> Column:
    """A name-based UUID: the same row gives the same id on every run."""
    h = F.md5(F.concat_ws("\x1f", F.lit(kind), *(F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts)))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _clean(value: Column) -> Column:
    """A header value on one line."""
    return F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), r"[\r\n]+", " ")


def _record(kind: str, record_id: Column, body: Column, headers: dict[str, Column], content_type: str) -> Column:
    lines = [F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: "), record_id]
    lines += [x for name, value in headers.items() for x in (F.lit(f"\r\n{name}: "), value)]
    lines += [
        F.lit(f"\r\nWARC-Date: {DATE}\r\nContent-Type: {content_type}\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit(END), body,
    ]
    return F.concat(*lines)


def captures(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", parts: int | None = None
) -> DataFrame:
    """Each page with its digest and, for a revisit, the page and record it refers to.

    Of equal payloads of at least 1000 bytes the one with the largest key is
    the response and the others revisit it; a null key is below all others. The
    payloads are shuffled once, by record, into ``parts`` parts.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    base = pages.select(
        F.col(key).alias("page_id"), F.col(url).alias("url"), payload.alias("payload"),
        F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).cast("bigint").alias("n_bytes"),
    ).withColumn("record", _record_id("response", F.col("page_id"), F.col("url"), F.col("digest")))
    # one row per payload: counted before the shuffle, so a common payload is small here
    original = (
        base.filter(F.col("n_bytes") >= LEAST_REVISIT).groupBy("digest")
        .agg(F.max(F.struct("page_id", "record", "url")).alias("o"), F.count("*").alias("copies"))
        .filter("copies > 1").select("digest", "o")
    )
    keys = base.select("record", "page_id", "digest", "n_bytes").filter(F.col("n_bytes") >= LEAST_REVISIT)
    again = ~F.col("page_id").eqNullSafe(F.col("o.page_id"))
    revisits = keys.join(original, "digest").filter(again).select("record", "o").distinct()
    if parts is None:
        return base.join(revisits, "record", "left")
    return base.repartition(parts, "record").join(revisits.repartition(parts, "record"), "record", "left")


def records(found: DataFrame) -> DataFrame:
    """The three WARC records of each capture as one string each, in an array."""
    revisit = F.col("o").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("n_bytes").cast("string"), F.lit(END),
    )
    uri, digest = _clean(F.col("url")), F.concat(F.lit("sha1:"), F.col("digest"))
    shared = {"WARC-Target-URI": uri, "WARC-Payload-Digest": digest}
    main = F.when(
        revisit,
        _record(
            "revisit", F.col("record"), http,
            shared | {
                "WARC-Refers-To": F.col("o.record"),
                "WARC-Refers-To-Target-URI": _clean(F.col("o.url")),
                "WARC-Profile": F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            },
            "application/http; msgtype=response",
        ),
    ).otherwise(
        _record("response", F.col("record"), F.concat(http, F.col("payload")), shared, "application/http; msgtype=response")
    )
    joined = {"WARC-Target-URI": uri, "WARC-Concurrent-To": F.col("record")}
    request = _record(
        "request", _record_id("request", F.col("record")), F.concat(F.lit("GET "), uri, F.lit(f" HTTP/1.1{END}")),
        joined, "application/http; msgtype=request",
    )
    metadata = _record(
        "metadata", _record_id("metadata", F.col("record")),
        F.concat(F.lit("pageId: "), F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.lit("\r\n")),
        joined, "application/warc-fields",
    )
    return found.select(F.array(main, request, metadata).alias("records"), "n_bytes")


def write_archives(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html",
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """The captures of ``pages`` as gzip archives of about ``archive_bytes`` before compression.

    The number of archives follows the payload bytes; captures are dealt to them
    at random by record, so a hot page does not swell one of them.
    """
    total = pages.agg(F.sum(F.coalesce(F.octet_length(html), F.lit(0)).cast("bigint") + 1500)).first()[0] or 0
    found = captures(pages, key, url, html, parts=max(1, -(-int(total) // archive_bytes)))
    rows = records(found).select(F.explode("records").alias("value"))
    with no_shuffle_files_left(pages.sparkSession):
        rows.write.option("lineSep", END).option("compression", "gzip").text(path)


def parse(data: bytes) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """Headers, in lower case and in order, and content of each record; lengths, not separators, tell where a record ends.

    Line ends between records do not matter, nor do spaces around a header's
    colon; a header that is not UTF-8 is read as far as it goes. A record without a length,
    or cut short, raises: what follows could not be told apart.
    """
    at = 0
    while (at := _next(data, at)) < len(data):
        stop = data.find(b"\r\n\r\n", at)
        head = data[at : max(stop, at)].decode("utf-8", "replace").split("\r\n")
        fields = [(name.strip().lower(), value.strip()) for name, _, value in (line.partition(":") for line in head[1:])]
        length = dict(fields).get("content-length", "")
        if not length.isdecimal() or stop + 4 + int(length) > len(data):
            raise ValueError(f"byte {at}: no whole record")
        at = stop + 4 + int(length)
        yield fields, data[stop + 4 : at]


def _next(data: bytes, at: int) -> int:
    while data[at : at + 1] in (b"\r", b"\n"):
        at += 1
    return at


def _unzipped(data: bytes) -> bytes:
    out = []
    while data:  # an archive may be several gzip members
        member = zlib.decompressobj(wbits=31)
        out.append(member.decompress(data))
        data = member.unused_data
    return b"".join(out)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of all archives under ``path``, with its payload in bytes.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload: of a
    response they are taken from its content, of a revisit from its headers.
    ``fields`` has the headers in lower case; one that is given several times
    has its values joined by commas, ``concurrent_to`` every id on its own.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    names = [c.split(" ")[0] for c in RECORD_SCHEMA.replace("map<string,string>", "map").split(", ")]
    types = [pa.string(), pa.string(), pa.list_(pa.string()), *[pa.string()] * 3, pa.int64(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows: list[tuple] = []
                held = 0
                for fields, body in parse(_unzipped(content.as_py())):
                    rows.append(_row(fields, body))
                    held += len(body)
                    if held > ROWS_BYTES:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return mapped(files, run, RECORD_SCHEMA)


def _row(fields: list[tuple[str, str]], content: bytes) -> tuple:
    named: dict[str, str] = {}
    for name, value in fields:
        named[name] = f"{named[name]}, {value}" if name in named else value
    kind = named.get("warc-type", "")
    digest = named.get("warc-payload-digest", "").removeprefix("sha1:")
    size, payload = None, content
    if kind in ("response", "revisit"):
        http, _, payload = content.partition(b"\r\n\r\n")
        if kind == "response":
            size, digest = len(payload), hashlib.sha1(payload).hexdigest()
        else:
            lengths = [x.partition(b":")[2].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length")]
            size = int(lengths[0]) if lengths and lengths[0].isdigit() else None
    return (
        named.get("warc-record-id"), kind, [v for n, v in fields if n == "warc-concurrent-to"], named.get("warc-refers-to"),
        named.get("warc-target-uri"), digest or None, size, len(content), [*named.items()], payload,
    )


def assemble(found: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id``, ``response``, ``request``, ``metadata``, ``copies``.

    A response or revisit and the records concurrent to it meet under its id, in
    one shuffle. A record concurrent to several captures belongs to each; one
    whose capture is not there is left out. Identical captures written several times are one
    row with their number in ``copies``.
    """
    main = F.col("record_type").isin("response", "revisit")
    dealt = found.select(
        F.explode(F.when(main, F.array("record_id")).otherwise(F.array_distinct("concurrent_to"))).alias("capture_id"),
        main.alias("main"), "record_type", F.struct(*found.columns).alias("record"),
    )

    def one(kind: Column, name: str) -> Column:
        return F.first(F.when(kind, F.col("record")), ignorenulls=True).alias(name)

    return dealt.groupBy("capture_id").agg(
        one(F.col("main"), "response"), one(F.col("record_type") == "request", "request"),
        one(F.col("record_type") == "metadata", "metadata"), F.count_if("main").alias("copies"),
    ).filter("copies > 0")


def page_of(metadata: Column) -> Column:
    """The page id in a metadata record."""
    found = F.regexp_extract(metadata["payload"].cast("string"), r"pageId: (-?[0-9]+)", 1)
    return F.when(found != "", found.cast("bigint"))


def page_table(nested: DataFrame) -> DataFrame:
    """A row per capture as written, revisits resolved to the page they refer to."""
    flat = nested.select(
        "capture_id", "copies", page_of(F.col("metadata")).alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"), F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.record_type").alias("record_type"), F.col("response.refers_to").alias("target"),
    )
    # a common payload is the target of many: the originals it refers to are one row each
    originals = flat.filter("record_type = 'response'").select(
        F.col("capture_id").alias("target"), F.col("page_id").alias("refers_to")
    )
    each = flat.withColumn("n", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    # a response refers to nothing; its own id spreads such rows instead of a null that gathers them
    spread = each.withColumn("own", F.coalesce("target", "capture_id")).join(
        originals.withColumnRenamed("target", "own"), "own", "left"
    )
    return spread.select(
        "page_id", "payload_bytes", "payload_digest", "record_type",
        F.when(F.col("target").isNotNull(), F.col("refers_to")).alias("refers_to"),
    )
