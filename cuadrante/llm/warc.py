"""WARC archives whose equal payloads are stored once.

Records are rendered by Spark expressions and written with Spark's text sink, whose
line separator is the blank lines that end a record.  They are read back as binary
files and taken apart by their content lengths.
"""

from __future__ import annotations

import datetime
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cuadrante.llm.common import bounded
from cuadrante.session import pin

# Fixed values of the WARC format.
EOL = "\r\n"
RECORD_END = EOL + EOL
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK" + EOL + "Content-Type: text/html; charset=utf-8" + EOL + "Content-Length: "
HTTP_TYPE = "application/http; msgtype=response"

MIN_PAYLOAD = 1000
RECORDS_PER_FILE = 4000
CHUNK = 1 << 20

READ_SCHEMA = "page_id long, record_type string, record_id string, url string, refers_to_id string, block_digest string, payload_digest string, payload_bytes long, declared_digest string"


def resolve_revisits(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """``pages`` (page_id, url, payload, digest, payload_bytes) with ``refers_to`` and
    ``refers_url`` on the rows that repeat another row's payload.

    Only headers meet in the shuffle by digest: each task sends one row per digest.
    What joins back are digests held by more than one page, broadcast when few.
    Of equal payloads the largest page_id is the original; rows that repeat that very
    page_id are originals too, and null page_ids never are.
    """
    big = pages.filter(F.col("payload_bytes") >= min_payload)
    heads = big.groupBy("digest", "payload_bytes").agg(F.max(F.struct("page_id", "url")).alias("_first"), F.count(F.lit(1)).alias("_n"))
    heads = pin(heads.filter("_n > 1 and _first.page_id is not null").select("digest", "payload_bytes", F.col("_first.page_id").alias("_orig"), F.col("_first.url").alias("_orig_url")))
    out = pages.join(bounded(heads, 200_000), ["digest", "payload_bytes"], "left")
    revisit = F.col("_orig").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_orig"))
    return out.withColumns({"refers_to": F.when(revisit, F.col("_orig")), "refers_url": F.when(revisit, F.col("_orig_url"))}).drop("_orig", "_orig_url")


def _record_id(page_id: Column, digest: Column) -> Column:
    m = F.md5(F.concat_ws("/", F.coalesce(page_id.cast("string"), F.lit("none")), digest))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(m, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def _uri(url: Column) -> Column:
    """The address on one header line: blanks and controls are escaped away."""
    return F.regexp_replace(url, "[\\x00-\\x20\\x7F]", "%20")


def _line(name: str, value: Column) -> Column:
    """A header line, nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(name + ": "), value, F.lit(EOL)), F.lit(""))


def records(resolved: DataFrame, date: str) -> DataFrame:
    """The text of each record, without the blank lines that end it."""
    revisit = F.col("refers_to").isNotNull()
    head = F.concat(F.lit(HTTP_HEAD), F.col("payload_bytes").cast("string"), F.lit(RECORD_END))
    block = F.when(revisit, head).otherwise(F.concat(head, F.col("payload")))
    full = F.concat(
        F.lit("WARC/1.1" + EOL),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", _uri(F.col("url"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.sha1(F.col("_block")))),
        _line("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("refers_to"), F.col("digest")))),
        _line("WARC-Refers-To-Target-URI", _uri(F.col("refers_url"))),
        _line("WARC-Refers-To-Date", F.when(revisit, F.lit(date))),
        _line("X-Page-Id", F.col("page_id").cast("string")),
        _line("Content-Type", F.lit(HTTP_TYPE)),
        _line("Content-Length", F.octet_length("_block").cast("string")),
        F.lit(EOL),
        F.col("_block"),
    )
    return resolved.withColumn("_block", block).select(full.alias("value"))


def write_archive(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", min_payload: int = MIN_PAYLOAD, date: str | None = None) -> None:
    """Write one record per row of ``pages`` to gzipped archives below ``path``.

    Null html is an empty payload; a null url or page_id has no header line.
    """
    date = date or datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html), F.lit("")).alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")})
    out = records(resolve_revisits(rows, min_payload), date)
    out.write.option("lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


class _Bytes:
    """Reads an archive's bytes in order, unpacking gzip members as needed."""

    def __init__(self, content):
        self.raw, self.at, self.buffer = memoryview(content), 0, bytearray()
        self.packed = bytes(self.raw[:2]) == b"\x1f\x8b"
        self.unzip = zlib.decompressobj(31) if self.packed else None

    def _more(self) -> bool:
        if self.at >= len(self.raw):
            return False
        piece = self.raw[self.at : self.at + CHUNK]
        self.at += len(piece)
        while len(piece):
            if not self.packed:
                self.buffer += piece
                break
            self.buffer += self.unzip.decompress(piece)
            piece = self.unzip.unused_data
            if self.unzip.eof:
                self.unzip = zlib.decompressobj(31)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Up to and without ``mark``; nothing at the end of the file."""
        seen = 0
        while (i := self.buffer.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.buffer)
            if not self._more():
                return None
        out = bytes(self.buffer[:i])
        del self.buffer[: i + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self._more():
            pass
        if len(self.buffer) < n:
            raise ValueError("the archive ends within a record")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def parse_records(content) -> Iterator[dict]:
    """The records of one archive file, in order."""
    data = _Bytes(content)
    while (head := data.until(b"\r\n\r\n")) is not None:
        lines = head.decode("utf-8").split(EOL)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record starts with {lines[0][:40]!r}")
        named = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        block = data.take(int(named["content-length"]))
        if data.take(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield named | {"block": block}


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch(rows):
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema(
        [("page_id", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("url", pa.string()), ("refers_to_id", pa.string()), ("block_digest", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("declared_digest", pa.string())]
    )
    for b in batches:
        for content in b.column(0):
            rows = []
            for r in parse_records(content.as_buffer()):
                kind, payload = r["warc-type"], r["block"].partition(b"\r\n\r\n")[2]
                whole = kind == "response"
                rows.append(
                    {
                        "page_id": int(r["x-page-id"]) if "x-page-id" in r else None,
                        "record_type": kind,
                        "record_id": r["warc-record-id"],
                        "url": r.get("warc-target-uri"),
                        "refers_to_id": r.get("warc-refers-to"),
                        "block_digest": hashlib.sha1(r["block"]).hexdigest(),
                        "payload_digest": hashlib.sha1(payload).hexdigest() if whole else None,
                        "payload_bytes": len(payload) if whole else None,
                        "declared_digest": r["warc-payload-digest"].removeprefix("sha1:"),
                    }
                )
                if len(rows) == 1000:
                    yield batch(rows)
                    rows = []
            yield batch(rows)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: its headers and, for responses, digest and length of the
    payload as read."""
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_read, READ_SCHEMA)


def join_originals(read: DataFrame) -> DataFrame:
    """Records with the payload figures of the response that revisits point to.  A
    revisit whose original is missing keeps null figures."""
    read = pin(read)
    revisits = read.filter("record_type = 'revisit'")
    originals = read.filter("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("_bytes"), F.col("payload_digest").alias("_digest"))
    # Responses that were repeated have one record id; only ids that are pointed to matter.
    wanted = revisits.select("refers_to_id").distinct()
    originals = originals.join(wanted, "refers_to_id", "left_semi").groupBy("refers_to_id").agg(F.max("refers_to").alias("refers_to"), F.max("_bytes").alias("_bytes"), F.max("_digest").alias("_digest"))
    joined = revisits.join(originals, "refers_to_id", "left").select("page_id", F.col("_bytes").alias("payload_bytes"), F.col("_digest").alias("payload_digest"), "record_type", "refers_to", "url")
    whole = read.filter("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"), "url")
    return joined.unionByName(whole)
