"""WARC archives without repeated payloads, and reading them back.

Headers (id, digest of the payload) are shuffled by digest; of equal payloads the
record with the largest id keeps its payload as a ``response`` and the others
become ``revisit`` records that refer to it. Archives are written by Spark's text
writer, so any store that Spark can write to will do: a record is the text up
to the last line feed of the blank lines that end it, and the writer adds that one.
Reading goes by Content-Length, so a payload may hold anything.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm.common import staged

# Records of one archive, so that no archive grows with the corpus.
ARCHIVE_RECORDS = 5_000
# What a record's own headers name; written by one crawl at one time.
DATE = "2024-01-01T00:00:00Z"
_ID = "urn:page:"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(text: Column) -> Column:
    """SHA-1 of the UTF-8 bytes in upper-case base32: five bytes are eight digits."""
    hexed = F.sha1(text)
    eight = [
        F.lpad(F.conv(F.substring(hexed, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)
    ]
    return F.translate(
        F.concat(*eight),
        "0123456789ABCDEFGHIJKLMNOPQRSTUV",  # digits of base 32
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",  # letters of RFC 4648
    )


def resolve(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages(page_id, url, html)`` with ``payload_bytes, payload_digest,
    record_type, copy, refers_to, refers_copy``.

    ``copy`` numbers the rows of one page_id and payload from 0, by url. Of equal
    payloads of ``min_bytes`` bytes or more, the largest page_id's copy 0 is the
    response; smaller payloads are all responses. A null page_id is less than
    any other; a null html is an empty payload.
    """
    rows = (
        pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"))
        .withColumn("payload_bytes", F.octet_length("html").cast("long"))
        .withColumn("payload_digest", payload_digest(F.col("html")))
    )
    rows = rows.withColumn("page", F.coalesce(F.col("page_id").cast("string"), F.lit("none")))
    headers = staged(
        rows.select("page", "page_id", "payload_bytes", "payload_digest").distinct(), "headers"
    )
    firsts = staged(
        headers.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("refers_to"), F.lit(True).alias("found")),
        "originals",
    )
    decided = headers.join(firsts, "payload_digest", "left").select(
        "page", "payload_digest", "refers_to", "found"
    )
    # The payloads are shuffled once: the numbers need the rows where the join has them.
    return (
        rows.join(decided, ["page", "payload_digest"])
        .withColumn(
            "copy",
            F.expr("row_number() over (partition by page, payload_digest order by url) - 1"),
        )
        .withColumn(
            "record_type",
            F.expr(
                "case when found and not (page_id <=> refers_to and copy = 0)"
                " then 'revisit' else 'response' end"
            ),
        )
        .withColumn("refers_to", F.expr("case when record_type = 'revisit' then refers_to end"))
        .drop("found", "page")
    )


def _name(page_id: str, copy: str) -> Column:
    return F.concat(
        F.lit(f"<{_ID}"), F.coalesce(F.col(page_id).cast("string"), F.lit("none")), F.lit(":"),
        F.col(copy).cast("string"), F.lit(":"), F.col("payload_digest"), F.lit(">"),
    )


def write_archives(resolved: DataFrame, path: str) -> None:
    """One record per row of ``resolve``, with fresh headers, in gzipped archives
    of at most ``ARCHIVE_RECORDS`` records under ``path``."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    revisit = F.col("record_type") == "revisit"
    # Control characters would end a header line.
    url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        line("Content-Length", F.col("payload_bytes").cast("string")),
        F.lit("\r\n"),
    )
    length = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    none = F.lit("")
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", _name("page_id", "copy")),
        line("WARC-Date", F.lit(DATE)),
        F.coalesce(line("WARC-Target-URI", url), none),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(
            revisit,
            F.concat(
                line("WARC-Refers-To", _name("refers_to", "zero")),
                line("WARC-Profile", F.lit(_PROFILE)),
            ),
        ).otherwise(none),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", length.cast("string")),
        F.lit("\r\n"),
        http,
        F.when(revisit, none).otherwise(F.col("html")),
        F.lit("\r\n\r"),
    )
    resolved.withColumn("zero", F.lit(0)).select(record.alias("value")).write.option(
        "maxRecordsPerFile", ARCHIVE_RECORDS
    ).option("compression", "gzip").text(path)


class _Stream:
    """Bytes of a gzipped archive in order, inflated as they are asked for."""

    def __init__(self, data: memoryview):
        self.data, self.at = data, 0
        self.inflate = zlib.decompressobj(31)
        self.held = bytearray()

    def fill(self) -> bool:
        if self.inflate.eof:
            rest = self.inflate.unused_data
            self.at -= len(rest)
            self.inflate = zlib.decompressobj(31)
        if self.at >= len(self.data):
            return False
        part = self.data[self.at : self.at + (1 << 18)]
        self.at += len(part)
        self.held += self.inflate.decompress(part)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with ``mark``, or None at the end."""
        looked = 0
        while (found := self.held.find(mark, looked)) < 0:
            looked = max(0, len(self.held) - len(mark))
            if not self.fill():
                return None
        return self.take(found + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self.fill():
                raise ValueError("the archive ends within a record")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out


def parse(data: bytes | memoryview) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """Headers, HTTP headers and payload of every record of a gzipped archive."""
    stream = _Stream(memoryview(data))
    while (head := stream.until(b"\r\n\r\n")) is not None:
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]}")
        fields = dict(x.split(": ", 1) for x in lines[1:] if x)
        block = stream.take(int(fields["Content-Length"]))
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError("a record does not end with two blank lines")
        http, _, payload = block.partition(b"\r\n\r\n")
        yield fields, http, payload


_FIELDS = "record_id string, page_id long, url string, record_type string, declared_digest string, declared_bytes long, refers_id string, refers_to long"


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records of all archives under ``path``: what their headers declare and,
    for responses, ``payload_bytes`` and ``payload_digest`` of the payload as
    read, with ``payloads`` also the ``payload`` itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page = lambda name: int(m[1]) if name and (m := re.match(rf"<{_ID}(-?\d+):", name)) else None
        names = [f.split()[0] for f in _FIELDS.split(", ")] + ["payload_bytes", "payload_digest"]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        if payloads:
            names, kinds = [*names, "payload"], [*kinds, pa.binary()]
        send = lambda rows: pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names
        )
        for batch in batches:
            for content in batch.column("content"):
                rows: list[tuple] = []
                size = 0
                for fields, http, payload in parse(content.as_buffer()):
                    whole = fields["WARC-Type"] != "revisit"
                    refers = fields.get("WARC-Refers-To")
                    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    row = (
                        fields["WARC-Record-ID"],
                        page(fields["WARC-Record-ID"]),
                        fields.get("WARC-Target-URI"),
                        fields["WARC-Type"],
                        fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                        int(re.search(rb"Content-Length: (\d+)", http)[1]),
                        refers,
                        page(refers),
                        len(payload) if whole else None,
                        digest if whole else None,
                    )
                    rows.append((*row, payload) if payloads else row)
                    size += len(payload) if payloads else 100
                    if size > 1 << 23:
                        yield send(rows)
                        rows, size = [], 0
                if rows:
                    yield send(rows)

    schema = f"{_FIELDS}, payload_bytes long, payload_digest string"
    schema += ", payload binary" if payloads else ""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.gz")
        .load(path)
        .select("content")
        .mapInArrow(run, schema)
    )


def revisits_resolved(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every
    record: a revisit has them from the response that it refers to."""
    records = staged(records, "records")
    out = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    originals = records.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_id"), "payload_bytes", "payload_digest"
    )
    revisits = records.where("record_type = 'revisit'").select(
        "refers_id", "page_id", "record_type", "refers_to"
    )
    return (
        records.where("record_type = 'response'")
        .select(*out)
        .unionByName(revisits.join(originals, "refers_id", "left").select(*out))
    )


def rewrite(
    pages: DataFrame, path: str, min_bytes: int = 0, id_col: str = "page_id", **columns: str
) -> DataFrame:
    """Write ``pages`` as archives under ``path`` and return what they hold, as
    ``revisits_resolved`` does. Columns other than id, url and html are not read;
    an empty table writes no record and gives an empty result."""
    rows = pages.select(
        F.col(f"`{id_col}`").alias("page_id"),
        F.col(f"`{columns.get('url_col', 'url')}`").alias("url"),
        F.col(f"`{columns.get('html_col', 'html')}`").alias("html"),
    )
    write_archives(resolve(rows, min_bytes), path)
    return revisits_resolved(read_archives(pages.sparkSession, path))
