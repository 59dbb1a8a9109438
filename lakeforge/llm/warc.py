"""WARC archives: write captures, read records back, assemble transactions.

A capture is a request, a response (or a revisit of an equal payload) and a metadata
record. Request and metadata name the response in WARC-Concurrent-To; through that
identifier records read from archives are joined into one nested row per capture.

Archives are written by Spark's text writer: a WARC file of UTF-8 payloads is text whose
records end in two empty lines, so the files land on any file system that Spark writes.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, written

#: Uncompressed bytes that one archive file holds, about.
FILE_BYTES = 64 << 20
#: Bytes of payload that a batch of records read from an archive holds, about.
BATCH_BYTES = 8 << 20
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
NEVER = "2026-01-01T00:00:00Z"
RECORD = ("file string, position long, type string, record_id string, concurrent_to string, "
          "refers_to string, target_uri string, date string, payload_digest string, "
          "http_length long, payload binary, payload_bytes long, computed_digest string")


def base32_sha1(text: str) -> Column:
    """Upper-case base32 of the SHA-1 of string column ``text``: each letter 5 bits of its hex form."""
    # the hash is bound to h, once for its 32 letters
    five_digits = "cast(conv(substring(h, (i div 4) * 5 + 1, 5), 16, 10) as int)"
    letter = f"substring('{BASE32}', (shiftright({five_digits}, cast(15 - 5 * (i % 4) as int)) & 31) + 1, 1)"
    return F.expr(f"transform(array(sha1({text})), h -> array_join(transform(sequence(0, 31), i -> {letter}), ''))[0]")


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), F.regexp_replace(value, r"[\r\n]+", " "), F.lit("\r\n"))


def _record(kind: Column, record_id: Column, headers: list[Column], content_type: str, block: Column) -> Column:
    return F.concat(
        F.lit("WARC/1.1\r\n"), _header("WARC-Type", kind), _header("WARC-Record-ID", record_id), *headers,
        F.lit(f"WARC-Date: {NEVER}\r\nContent-Type: {content_type}\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block)


def write_archives(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", min_bytes: int = 0) -> None:
    """Write a request, a response or revisit, and a metadata record per row of ``df``.

    Of payloads equal in all bytes and of at least ``min_bytes``, the rows with the smallest
    id are responses and the others revisit them; smaller payloads are all responses. A
    null payload is empty; a null id is a revisit wherever its payload has another id. Null
    urls are written empty. Repeated rows get captures of their own: the row's place makes
    record ids distinct. An empty table writes an archive without records.
    """
    pages = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
                      F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    # SHA-1 names the payload in the archive; the 256-bit digest decides about equality
    equal = F.unhex(F.sha2("payload", 256))
    size = F.octet_length("payload")
    groups = written(pages.where(size >= min_bytes).groupBy(equal.alias("same"))
                     .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
                     .where("n > 1").select("same", "first"), "payload-groups")
    mean = pages.agg(F.avg(size)).first()[0] or 0
    rows = (pages.withColumn("same_payload", F.when(size >= min_bytes, equal))
            .join(groups, F.col("same_payload") == F.col("same"), "left")
            .withColumn("revisit", F.col("same").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")))
            .withColumn("digest", base32_sha1("payload"))
            .withColumn("place", F.monotonically_increasing_id().cast("string")))

    def urn(of: str, kind: str, place: bool = True) -> Column:
        tail = [F.lit("#"), F.col("place")] if place else []
        return F.concat(F.lit("<urn:capture:"), F.coalesce(F.col(of).cast("string"), F.lit("null")), F.lit(":"),
                        F.col("digest"), F.lit(f":{kind}"), *tail, F.lit(">"))

    response = urn("id", "response")
    uri = _header("WARC-Target-URI", F.col("url"))
    together = _header("WARC-Concurrent-To", response)
    asked = F.concat(F.lit("GET "), F.regexp_replace("url", r"\s+", "%20"), F.lit(" HTTP/1.1\r\n\r\n"))
    answered = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                        size.cast("string"), F.lit("\r\n\r\n"),
                        F.when(F.col("revisit"), F.lit("")).otherwise(F.col("payload")))
    about = [uri, _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))]
    revisits = F.when(F.col("revisit"), F.concat(
        _header("WARC-Refers-To", urn("first", "response", place=False)),
        F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"))
    ).otherwise(F.lit(""))
    noted = F.concat(F.lit("page: "), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit("\r\n"))
    value = F.concat_ws(
        "\r\n\r\n",
        _record(F.lit("request"), urn("id", "request"), [uri, together], "application/http; msgtype=request", asked),
        _record(F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response")), response,
                [*about, revisits], "application/http; msgtype=response", answered),
        _record(F.lit("metadata"), urn("id", "metadata"), [uri, together], "application/warc-fields", noted))
    (rows.select(value.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", max(1, int(FILE_BYTES // (mean + 1500)))).text(path))


def _inflated(content: bytes) -> Iterator[bytes]:
    """The bytes of a gzip archive of any number of members, or of a plain one, bit by bit."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    rest = memoryview(content)
    while len(rest):
        member = zlib.decompressobj(wbits=31)
        at = 0
        while not member.eof and at < len(rest):
            yield member.decompress(rest[at:at + (1 << 20)])
            at += 1 << 20
        if not member.eof:
            raise ValueError("an archive member ends early")
        rest = rest[min(at, len(rest)) - len(member.unused_data):]


def parse_records(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(position, headers by lower-case name, block) of each record, by its Content-Length."""
    held, base, more = bytearray(), 0, _inflated(content)

    def fill(need: int) -> bool:
        while len(held) < need:
            part = next(more, None)
            if part is None:
                return False
            held.extend(part)
        return True

    while True:
        while fill(1) and held[:1] in (b"\r", b"\n"):
            del held[:1]
            base += 1
        if not held:
            return
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not fill(len(held) + 1):
                raise ValueError(f"no end of the record header at {base}")
        version, *lines = bytes(held[:end]).decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at {base}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        length = int(headers["content-length"])
        if not fill(end + 4 + length):
            raise ValueError(f"the record at {base} ends early")
        yield base, headers, bytes(held[end + 4:end + 4 + length])
        del held[:end + 4 + length]
        base += end + 4 + length


def _records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [x.split()[0] for x in RECORD.split(", ")]
    for batch in batches:
        for file, content in zip(batch["path"], batch["content"], strict=True):
            rows, held = [], 0
            for position, h, block in parse_records(content):
                kind, payload, http_length = h.get("warc-type"), block, None
                if kind in ("response", "revisit") and h.get("content-type", "").startswith("application/http"):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    found = [v for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])
                             if k.strip().lower() == b"content-length"]
                    http_length = int(found[0]) if found else None
                rows.append((file, position, kind, h.get("warc-record-id"), h.get("warc-concurrent-to"),
                             h.get("warc-refers-to"), h.get("warc-target-uri"), h.get("warc-date"),
                             h.get("warc-payload-digest", "").removeprefix("sha1:") or None, http_length, payload,
                             len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()))
                held += len(payload)
                if held > BATCH_BYTES:
                    yield pd.DataFrame(rows, columns=columns).astype({"http_length": "Int64"})
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=columns).astype({"http_length": "Int64"})


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives in ``path``; a file is read by one task.

    ``payload`` is the HTTP body of responses, else the whole block; ``payload_bytes`` and
    ``computed_digest`` are of what the record holds, ``http_length`` and
    ``payload_digest`` as its headers state them.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(_records, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: capture_id, request, response and metadata as nested records.

    Records join by the identifier of their response: its own WARC-Record-ID, the
    WARC-Concurrent-To of the others. What is missing is null, so a metadata record whose
    response is in no archive still makes a row. Of records of one kind with one
    identifier the first by file and position counts. Records without an identifier are
    left out, as nothing tells their capture.
    """
    parts = [c for c in records.columns if c != "concurrent_to"]
    main = F.col("type").isin("response", "revisit")
    keyed = (records.withColumn("capture_id", F.when(main, F.col("record_id")).otherwise(F.col("concurrent_to")))
             .where(F.col("capture_id").isNotNull()))

    def one(kind: Column, name: str) -> Column:
        return F.min(F.when(kind, F.struct(*parts))).alias(name)

    return keyed.groupBy("capture_id").agg(
        one(F.col("type") == "request", "request"), one(main, "response"),
        one(F.col("type") == "metadata", "metadata"))


def round_trip(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               min_bytes: int = 0) -> DataFrame:
    """Captures of ``df`` written to archives in the shared folder and read back from them."""
    spark = df.sparkSession
    path = scratch(spark, "archives")
    write_archives(df, path, id_col, url_col, payload_col, min_bytes)
    return assemble(read_records(spark, path))
