"""WARC archives in which a repeated payload is stored once.

Only headers travel to decide: the digests of all payloads are shuffled, the
smallest page of each is the response, and the others become ``revisit``
records that name it. An archive is a folder of gzipped WARC 1.1 files, a
record per row of Spark's text writer, whose line separator is the record end
of the format; so any store that Spark reaches can hold it. Files are read as
wholes and parsed by their ``Content-Length``, as payloads may hold anything.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftlake.llm.salted import lookup, salt_of, salts_for
from shiftlake.llm.staging import fresh_path, staged

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_END = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
EMPTY_DIGEST = base64.b32encode(hashlib.sha1(b"").digest()).decode()

#: Payloads of fewer bytes are stored anew each time.
LEAST_BYTES = 0
#: Pages carry no time of their capture; archives of the same pages are to be equal.
CAPTURED = "1970-01-01T00:00:00Z"
#: Of a decompressed file at once in memory, beside the record being read.
CHUNK = 1 << 20

RECORD = "page_id long, url string, record_id string, record_type string, payload_digest string, payload_bytes long, refers_to_record string, payload string"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a text's bytes."""
    digest = F.sha1(F.encode(payload, "UTF-8"))
    chars = []
    for k in range(8):
        bits = F.conv(F.substring(digest, 5 * k + 1, 5), 16, 10).cast("int")
        chars += [F.substring(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*chars)


def page_headers(pages: DataFrame) -> DataFrame:
    """page_id, url, payload and its payload_bytes, payload_digest, strong (SHA-256), record_id of every row."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html"), F.lit("")).alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"),
                       F.sha2(F.encode("payload", "UTF-8"), 256).alias("strong"))
    return rows.withColumn("record_id", record_id(F.col("page_id"), F.col("url"), F.col("strong")))


def record_id(page_id: Column, url: Column, strong: Column) -> Column:
    """A name that a second run gives again; rows equal in page, url and payload share it."""
    digest = F.md5(F.encode(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("-")), F.length(F.coalesce(url, F.lit(""))).cast("string"),
                                        F.coalesce(url, F.lit("")), strong), "UTF-8"))
    cut = [F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *cut))


def originals(headers: DataFrame, salts: int) -> DataFrame:
    """strong, original (page_id, url, record_id of the smallest page) of payloads that several rows have.

    Reduced per salt before the rows of a digest meet.
    """
    rows = headers.select("strong", "page_id", "url", "record_id", salt_of(F.col("page_id"), F.col("url"), salts=salts).alias("salt"))
    first = F.min_by(F.struct("page_id", "url", "record_id"), F.struct(F.col("page_id").isNull(), "page_id", "url"))
    part = rows.groupBy("strong", "salt").agg(first.alias("o"), F.count("*").alias("n"))
    whole = part.groupBy("strong").agg(
        F.min_by("o", F.struct(F.col("o.page_id").isNull(), F.col("o.page_id"), F.col("o.url"))).alias("original"), F.sum("n").alias("n"))
    return whole.where("n > 1").select("strong", "original")


def _header(name: str, value: Column) -> Column:
    """A header line, left out for a null value; line ends and other control characters in it are escaped."""
    safe = F.regexp_replace(F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), r"[\x00-\x1F\x7F]", "%20")
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def _record(kind: Column, is_revisit: Column) -> Column:
    """The text of a record up to its end."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(http, F.when(is_revisit, F.lit("")).otherwise(F.col("payload")))
    of_original = lambda c: F.when(is_revisit, c)
    return F.concat(
        F.lit(f"{VERSION}\r\n"), _header("WARC-Type", kind), _header("WARC-Record-ID", F.concat(F.lit("<"), F.col("record_id"), F.lit(">"))),
        _header("WARC-Date", F.lit(CAPTURED)), _header("WARC-Target-URI", F.col("url")), _header("WARC-Page-ID", F.col("page_id").cast("string")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _header("WARC-Profile", of_original(F.lit(REVISIT_PROFILE))),
        _header("WARC-Refers-To", of_original(F.concat(F.lit("<"), F.col("original.record_id"), F.lit(">")))),
        _header("WARC-Refers-To-Target-URI", of_original(F.col("original.url"))),
        _header("WARC-Refers-To-Date", of_original(F.lit(CAPTURED))),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"),
        F.lit("\r\n\r\n"), block)


def write_archives(pages: DataFrame, path: str | None = None, least_bytes: int = LEAST_BYTES) -> str:
    """Write a record per page and return the folder (a new one in the shared folder, if none is given).

    Of pages with equal payloads of ``least_bytes`` or more, the one with the
    smallest page_id is the response (a null page_id is larger than any), the
    others revisit it; rows that repeat its page_id are responses too. Payloads
    are equal if their SHA-256 is, so two payloads with one SHA-1 both stay.
    A null html is an empty payload. Extra columns are not read.
    """
    spark = pages.sparkSession
    path = path or fresh_path(spark, "warc")
    salts = salts_for(pages.count())
    rows = page_headers(pages).withColumn("salt", salt_of(F.col("page_id"), F.col("url"), salts=salts))
    repeated = staged(originals(rows.where(F.col("payload_bytes") >= least_bytes), salts), "warc-originals")
    rows = lookup(rows, repeated, "strong", "salt")
    original = F.col("original.page_id")
    is_revisit = F.coalesce((F.col("payload_bytes") >= least_bytes) & ~F.col("page_id").eqNullSafe(original) & F.col("original").isNotNull(), F.lit(False))
    kind = F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response"))
    rows.select(_record(kind, is_revisit).alias("value")).write.option("lineSep", RECORD_END).option("compression", "gzip").text(path)
    return path


class RecordReader:
    """Records of one gzipped file, decompressed piece by piece."""

    def __init__(self, content: bytes):
        self._content, self._at, self._held = content, 0, bytearray()
        self._inflate = zlib.decompressobj(31)

    def _more(self) -> bool:
        while True:
            if self._inflate.eof:
                rest = self._inflate.unused_data
                if not rest and self._at >= len(self._content):
                    return False
                self._inflate = zlib.decompressobj(31)
                piece = rest
            else:
                piece = self._inflate.unconsumed_tail or self._content[self._at:self._at + CHUNK]
                if not self._inflate.unconsumed_tail:
                    self._at += len(piece)
            if not piece:
                if self._at >= len(self._content):
                    return False
                continue
            found = self._inflate.decompress(piece, CHUNK)
            if found:
                self._held += found
                return True

    def _take(self, n: int) -> bytes:
        while len(self._held) < n:
            if not self._more():
                raise ValueError(f"the file ends inside a record, {n - len(self._held)} bytes short")
        out = bytes(self._held[:n])
        del self._held[:n]
        return out

    def _head(self) -> dict[str, str] | None:
        start = 0
        while (end := self._held.find(b"\r\n\r\n", start)) < 0:
            start = max(0, len(self._held) - 3)
            if not self._more():
                if self._held:
                    raise ValueError("the file ends inside a header")
                return None
        version, *lines = self._take(end + 4)[:-4].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record starts with {version[:20]!r}")
        return {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        """(headers by lower-case name, block) of each record."""
        while (head := self._head()) is not None:
            block = self._take(int(head["content-length"]))
            if self._take(4) != b"\r\n\r\n":
                raise ValueError(f"record {head.get('warc-record-id')} is longer than it says")
            yield head, block


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record of an archive as it lies there; a revisit has no payload and no length of its own.

    Digests of responses are computed again, and a difference raises.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in RECORD.split(", ")]
        schema = pa.schema([pa.field(n, pa.int64() if n in ("page_id", "payload_bytes") else pa.string()) for n in names])
        rows, size = [], 0
        for batch in batches:
            for content in batch.column(0):
                for head, block in RecordReader(content.as_py()):
                    payload = block.partition(b"\r\n\r\n")[2]
                    kind, digest = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:")
                    response = kind == "response"
                    if response and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"record {head['warc-record-id']} does not have the payload of its digest")
                    page_id = head.get("warc-page-id")
                    rows.append((None if page_id is None else int(page_id), head.get("warc-target-uri"), head["warc-record-id"].strip("<>"), kind, digest,
                                 len(payload) if response else None, (head.get("warc-refers-to") or "").strip("<>") or None,
                                 payload.decode() if payloads and response else None))
                    size += len(block) if payloads else 200
                    if size >= 8 * CHUNK:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)
                        rows, size = [], 0
        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)

    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")
    return files.mapInArrow(run, RECORD)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to (page_id) and payload of every record.

    A revisit gets length, page and payload of the response with its digest that
    it names; one whose response is missing has nulls there.
    """
    records = staged(read_records(spark, path, payloads), "warc-records")
    salts = salts_for(records.count())
    responses = records.where("record_type = 'response'")
    plain = responses.select("page_id", "url", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"), "payload")
    named = F.struct("payload_digest", F.col("record_id").alias("record"))
    # Rows equal in page, url and payload share a record id; any of them serves.
    known = responses.select(named.alias("target"), F.struct("page_id", "payload_bytes", "payload").alias("of")).groupBy("target").agg(F.first("of").alias("of"))
    visits = records.where("record_type <> 'response'").select(
        "page_id", "url", "payload_digest", "record_type", F.struct("payload_digest", F.col("refers_to_record").alias("record")).alias("target"),
        salt_of(F.col("record_id"), salts=salts).alias("salt"))
    met = lookup(visits, known, "target", "salt")
    return plain.unionByName(met.select("page_id", "url", F.col("of.payload_bytes").alias("payload_bytes"), "payload_digest", "record_type",
                                        F.col("of.page_id").alias("refers_to"), F.col("of.payload").alias("payload")))
