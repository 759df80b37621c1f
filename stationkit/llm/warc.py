"""Web archives: writing WARC files, reading them back, and assembling transactions.

A capture is three records: the request, the response (or a revisit that points
to an equal payload captured elsewhere) and a metadata record. They are separate
records of an archive, in any order and any file, and know each other only
through ``WARC-Concurrent-To``. Assembly joins them on that identifier and gives
one nested row per capture.

Archives are written by Spark's own text writer, whose line separator is the
four bytes that end a WARC record, so files reach any store Spark can write to.
They are read as binary files and cut by ``Content-Length``, never by content.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationkit.plans.keyed import attach
from stationkit.plans.stored import fresh_path, store

# Records in one file at most; three make a capture.
FILE_RECORDS = 60_000
# Bytes of blocks that leave a reading task in one Arrow batch.
BATCH_BYTES = 4 << 20
_READ = 1 << 20

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_MAIN = ("response", "revisit")


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of a text or binary column in upper-case base32, as archives state it."""
    digest = F.sha1(payload)
    # 160 bits are four groups of 40, each ten hexadecimal or eight base32 digits.
    groups = [
        F.lpad(F.conv(F.substring(digest, begin, 10), 16, 32), 8, "0") for begin in (1, 11, 21, 31)
    ]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", _BASE32)


def _record(kind: str, fields: list[tuple[str, Column | str]], block: Column) -> Column:
    """A whole record but for the separator that ends it; fields with a null value are left out."""
    size = F.octet_length(block).cast("string")
    named = [
        F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value))
        for name, value in [("WARC-Type", kind), *fields, ("Content-Length", size)]
    ]
    return F.concat(F.concat_ws("\r\n", F.lit(VERSION), *named), F.lit(END), block)


def _urn(identity: Column, part: str) -> Column:
    """A record identifier from the identity of a capture and the name of the record in it."""
    h = F.md5(F.concat_ws("/", identity, F.lit(part)))
    cuts = [F.substring(h, begin, n) for begin, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def write_archive(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least: int = 0,
) -> None:
    """Write a request, a response or revisit, and a metadata record for every row.

    Of the rows with equal payloads of at least ``least`` bytes, those with the
    largest key are responses, the others revisit it and hold no payload. A null
    key counts as the smallest; if all keys of a payload are null, all rows are
    responses. A null payload is an empty one. URLs with spaces or control
    characters are percent-encoded as a whole; a null URL leaves its fields out.
    Only the three named columns are read.

    Rows do not move: payloads that occur more than once are found by digest in
    an aggregate of digests, and joined back by ``keyed.attach``, which checks
    their size and splits a payload that makes up much of the table.
    """
    now = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    body = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit(""))
    given = F.col(f"`{url}`").cast("string")
    rows = pages.select(
        F.col(f"`{key}`").cast("bigint").alias("key"),
        F.when(given.rlike(r"[\x00-\x20\x7f]"), F.url_encode(given)).otherwise(given).alias("url"),
        body.alias("body"),
        base32_sha1(body).alias("digest"),
        F.octet_length(body).alias("size"),
    )
    equal = (
        rows.where(F.col("size") >= least)
        .groupBy("digest", "size")
        .agg(
            F.max_by(F.struct("key", "url"), F.coalesce("key", F.lit(-(1 << 63)))).alias("head"),
            F.count(F.lit(1)).alias("rows"),
        )
        .where("rows > 1")
        .select("digest", "size", F.col("head.key").alias("head_key"),
                F.col("head.url").alias("head_url"), "rows")
    )
    joined = attach(rows, equal, ["digest", "size"], weight="rows")

    # Unique within the archive, and the same when a task is run again on the same rows.
    name = F.concat_ws("/", F.lit(uuid.uuid4().hex), F.monotonically_increasing_id().cast("string"))
    captured = joined.withColumn("capture", name).withColumn(
        "again", F.col("rows").isNotNull() & ~F.col("key").eqNullSafe(F.col("head_key"))
    )
    capture, target, again = F.col("capture"), F.col("url"), F.col("again")
    host = F.coalesce(F.try_parse_url(target, F.lit("HOST")), F.lit(""))
    way = F.concat(
        F.coalesce(F.try_parse_url(target, F.lit("PATH")), F.lit("")),
        F.coalesce(F.concat(F.lit("?"), F.try_parse_url(target, F.lit("QUERY"))), F.lit("")),
    )
    way = F.when(way.startswith("/"), way).otherwise(F.concat(F.lit("/"), way))
    asked = F.concat(F.lit("GET "), way, F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(END))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"),
        F.lit(END),
    )
    common = [("WARC-Target-URI", target), ("WARC-Date", now)]
    beside = ("WARC-Concurrent-To", _urn(capture, "response"))
    main_id = ("WARC-Record-ID", _urn(capture, "response"))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    http = "application/http; msgtype="
    request = _record(
        "request",
        [("WARC-Record-ID", _urn(capture, "request")), beside, *common,
         ("Content-Type", http + "request")],
        asked,
    )
    response = _record(
        "response",
        [main_id, *common, digest, ("Content-Type", http + "response")],
        F.concat(head, F.col("body")),
    )
    revisit = _record(
        "revisit",
        [main_id, *common, digest, ("WARC-Profile", PROFILE),
         ("WARC-Refers-To-Target-URI", F.col("head_url")),
         ("WARC-Refers-To-Date", now), ("Content-Type", http + "response")],
        head,
    )
    noted = F.coalesce(F.concat(F.lit("page-id: "), F.col("key").cast("string"), F.lit("\r\n")), F.lit(""))
    metadata = _record(
        "metadata",
        [("WARC-Record-ID", _urn(capture, "metadata")), beside, *common,
         ("Content-Type", "application/warc-fields")],
        noted,
    )
    main = F.when(again, revisit).otherwise(response)
    captured.select(F.explode(F.array(request, main, metadata)).alias("record")).write.options(
        lineSep=END, compression="gzip", maxRecordsPerFile=FILE_RECORDS
    ).text(path)


class _Stream:
    """Bytes of a plain or gzipped file (one member or many), unpacked as they are asked for."""

    def __init__(self, data: bytes):
        self.rest, self.at = memoryview(data), 0
        self.packed = data[:2] == b"\x1f\x8b"
        self.member = None
        self.held = bytearray()
        self.begin = 0

    def _more(self) -> bool:
        if self.at >= len(self.rest):
            return False
        part = self.rest[self.at : self.at + _READ]
        self.at += len(part)
        if not self.packed:
            self.held += part
            return True
        self.member = self.member or zlib.decompressobj(31)
        self.held += self.member.decompress(part)
        if self.member.eof:
            self.at -= len(self.member.unused_data)
            self.member = None
            # Zero bytes may pad the end of a member.
            while self.at < len(self.rest) and self.rest[self.at] == 0:
                self.at += 1
        return True

    def until(self, mark: bytes) -> bytes | None:
        """What comes before ``mark``, which is skipped; None if there is no further mark."""
        search = self.begin
        while (found := self.held.find(mark, search)) < 0:
            search = max(self.begin, len(self.held) - len(mark) + 1)
            if not self._more():
                return None
        out = bytes(self.held[self.begin : found])
        self.begin = found + len(mark)
        return out

    def take(self, n: int) -> bytes:
        """The next ``n`` bytes, or fewer at the end of the file."""
        while len(self.held) - self.begin < n and self._more():
            pass
        out = bytes(self.held[self.begin : self.begin + n])
        self.begin += len(out)
        if self.begin > _READ:
            del self.held[: self.begin]
            self.begin = 0
        return out

    def blank(self) -> None:
        """Skip line ends between records."""
        while True:
            if self.begin >= len(self.held) and not self._more():
                return
            if self.begin < len(self.held):
                if self.held[self.begin] not in b"\r\n":
                    return
                self.begin += 1


def _fields(head: str) -> dict[str, str]:
    """Named fields of a head; names are lower-cased, folded lines joined, the first of a name holds."""
    out: dict[str, str] = {}
    last = ""
    for line in head.split("\r\n"):
        if line[:1] in " \t" and last:
            out[last] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        if colon:
            last = name.strip().lower()
            out.setdefault(last, value.strip())
    return out


def parse_records(data: bytes, name: str = "") -> Iterator[dict]:
    """The records of one archive file, in order.

    A record cut short by the end of the file has ``complete`` false. Anything
    but a record where one should begin raises a ``ValueError`` with the place.
    """
    stream, number = _Stream(data), 0
    while True:
        stream.blank()
        head = stream.until(b"\r\n\r\n")
        if head is None:
            if stream.begin < len(stream.held):
                yield {"type": None, "complete": False, "number": number}
            return
        if not head.startswith(b"WARC/"):
            raise ValueError(f"no record begins at record {number} of {name or 'the archive'}")
        fields = _fields(head.decode("utf-8", "replace").partition("\r\n")[2])
        size = int(fields.get("content-length", "0"))
        block = stream.take(size)
        kind = fields.get("warc-type", "").lower()
        out = {
            "number": number,
            "type": kind,
            "record_id": fields.get("warc-record-id"),
            "concurrent_to": fields.get("warc-concurrent-to"),
            "target_uri": fields.get("warc-target-uri"),
            "date": fields.get("warc-date"),
            "complete": len(block) == size,
            "block": block,
        }
        http = fields.get("content-type", "").startswith("application/http")
        if http:
            http_head, _, payload = block.partition(b"\r\n\r\n")
            out["http_head"] = http_head.decode("utf-8", "replace")
            if kind == "response":
                out["payload"] = payload
                out["payload_bytes"] = len(payload)
                out["payload_digest"] = b32encode(hashlib.sha1(payload).digest()).decode()
            elif kind == "revisit":
                stated = _fields(out["http_head"].partition("\r\n")[2]).get("content-length")
                out["payload_bytes"] = int(stated) if stated and stated.isdigit() else None
        if kind == "revisit":
            out["payload_digest"] = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        yield out
        number += 1


_KIND = pa.schema(
    [
        ("file", pa.string()), ("number", pa.int64()), ("type", pa.string()),
        ("record_id", pa.string()), ("concurrent_to", pa.string()), ("target_uri", pa.string()),
        ("date", pa.string()), ("complete", pa.bool_()), ("http_head", pa.string()),
        ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("block", pa.binary()),
    ]
)
_DDL = (
    "file string, number bigint, type string, record_id string, concurrent_to string, "
    "target_uri string, date string, complete boolean, http_head string, payload binary, "
    "payload_bytes bigint, payload_digest string, block binary"
)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archive files in a folder, plain or gzipped.

    Length and digest of a response's payload are measured on the bytes read;
    those of a revisit are what the record states. ``block`` is null for a
    response, whose payload has a column of its own. A file is held packed and
    unpacked bit by bit, so a task's memory is bounded by the largest file on
    disk and the largest record. An empty folder gives an empty table.
    """

    def run(batches):
        for batch in batches:
            for name, data in zip(
                batch.column("path").to_pylist(), batch.column("content"), strict=True
            ):
                rows, held = [], 0
                for record in parse_records(data.as_py(), name):
                    if "payload" in record:
                        record["block"] = None
                    rows.append({"file": name, **record})
                    held += len(record.get("block") or b"") + len(record.get("payload") or b"") + 512
                    if held > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, _KIND)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _KIND)

    files = spark.read.format("binaryFile").load(path).where("length > 0")
    return files.select("path", "content").mapInArrow(run, _DDL)


def _owners(parts: DataFrame, mains: DataFrame) -> DataFrame:
    """``record_id, capture`` for every other record tied to a response or revisit.

    Most name it directly. The rest is reached step by step, in either direction
    of the identifiers, until a round finds no more; a round moves identifiers
    only.
    """
    ids = mains.select(F.col("record_id").alias("capture")).where("capture IS NOT NULL").distinct()
    direct = parts.join(ids, parts["concurrent_to"] == ids["capture"], "left")
    placed = store(direct.select("record_id", "concurrent_to", "capture"), "warc-links")
    found = placed.df.where("capture IS NOT NULL").select("record_id", "capture")
    open_rows = store(placed.df.where("capture IS NULL").drop("capture"), "warc-open")
    if not open_rows.rows:
        return found
    # A response may itself name the request or metadata it belongs to.
    named = mains.where("concurrent_to IS NOT NULL").select(
        F.col("concurrent_to").alias("record_id"), F.col("record_id").alias("capture")
    )
    known = store(found.unionByName(named), "warc-known")
    while True:
        left = open_rows.df.join(known.df.select("record_id"), "record_id", "left_anti")
        by = known.df.groupBy(F.col("record_id").alias("concurrent_to")).agg(
            F.min("capture").alias("capture")
        )
        forth = left.join(by, "concurrent_to").select("record_id", "capture")
        to = open_rows.df.join(known.df, "record_id").where("concurrent_to IS NOT NULL")
        back = (
            to.select(F.col("concurrent_to").alias("record_id"), "capture")
            .join(left.select("record_id"), "record_id", "left_semi")
        )
        new = forth.unionByName(back).groupBy("record_id").agg(F.min("capture").alias("capture"))
        step = store(new, "warc-step")
        if not step.rows:
            return known.df.groupBy("record_id").agg(F.min("capture").alias("capture"))
        known = store(known.df.unionByName(step.df), "warc-known")


def captures(records: DataFrame) -> DataFrame:
    """One nested row per response or revisit: ``capture, target_uri, date, response, request, metadata``.

    Requests and metadata are joined through the concurrent-to identifiers, also
    where the response names them or one names the other. ``requests`` and
    ``metadata_records`` count them; the nested record is the one with the
    smallest identifier, so that a capture with very many of them is not
    gathered in one place. ``request`` and ``metadata`` are null where there is
    none. Records cut short and those of other kinds are left out; requests and
    metadata without a response are in ``orphans``.
    """
    whole = records.where("complete")
    mains = whole.where(F.col("type").isin(*_MAIN))
    parts = whole.where(F.col("type").isin("request", "metadata"))
    owners = _owners(parts.select("record_id", "concurrent_to"), mains.select("record_id", "concurrent_to"))
    nested = F.struct("record_id", "date", F.col("block").cast("string").alias("block"))
    own = parts.where("record_id IS NOT NULL").join(owners.distinct(), "record_id")
    is_request = F.col("type") == "request"
    beside = own.groupBy("capture").agg(
        F.min(F.when(is_request, nested)).alias("request"),
        F.min(F.when(~is_request, nested)).alias("metadata"),
        F.count_if(is_request).alias("requests"),
        F.count_if(~is_request).alias("metadata_records"),
    )
    response = F.struct(
        "type", "http_head", "payload", "payload_bytes", "payload_digest"
    ).alias("response")
    main = mains.select(F.col("record_id").alias("capture"), "target_uri", "date", response)
    joined = main.join(beside, "capture", "left")
    counts = {c: F.coalesce(c, F.lit(0)) for c in ("requests", "metadata_records")}
    return joined.withColumns(counts)


def orphans(records: DataFrame) -> DataFrame:
    """Requests and metadata records that belong to no response or revisit."""
    whole = records.where("complete")
    mains = whole.where(F.col("type").isin(*_MAIN)).select("record_id", "concurrent_to")
    parts = whole.where(F.col("type").isin("request", "metadata"))
    owners = _owners(parts.select("record_id", "concurrent_to"), mains)
    return parts.join(owners.select("record_id").distinct(), "record_id", "left_anti")


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write ``pages`` as archives, read them back, and tell what each page has become.

    Returns one row for each row of ``pages``: ``page_id, payload_bytes,
    payload_digest, record_type`` and ``refers_to``, the page_id of the response
    that a revisit stands for (null for responses). See ``write_archive`` for
    nulls, ties and repeated rows. All columns come from the archives: the
    page_id from the metadata record, the payload's from the response, and a
    revisit finds its response by payload digest, as its profile says.
    """
    spark = pages.sparkSession
    path = fresh_path(spark, "archive")
    write_archive(pages, path, least=least)
    page = F.regexp_extract(F.col("metadata.block"), r"page-id: (-?\d+)", 1)
    read = store(
        captures(read_records(spark, path)).select(
            F.when(page != "", page.cast("bigint")).alias("page_id"),
            "response.payload_bytes",
            "response.payload_digest",
            F.col("response.type").alias("record_type"),
        ),
        "captures",
    ).df
    digest = ["payload_digest", "payload_bytes"]
    wanted = read.where("record_type = 'revisit'").groupBy(*digest).agg(F.count(F.lit(1)).alias("rows"))
    heads = (
        read.where("record_type = 'response'").groupBy(*digest)
        .agg(F.max("page_id").alias("refers_to")).join(wanted, digest)
    )
    joined = attach(read, heads, digest, weight="rows")
    refers = F.when(F.col("record_type") == "revisit", F.col("refers_to"))
    return joined.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", refers.alias("refers_to")
    )


_A = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
SQL = f"""
WITH read AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(coalesce(html, '')) AS hex
  FROM pages),
named AS (
  SELECT page_id, payload_bytes, max(page_id) OVER (PARTITION BY hex) AS head,
         list_aggregate(list_transform(range(32), lambda k: substr('{_A}', CAST(1 + ((CAST('0x' ||
           substr(hex, 1 + 10 * (k // 8), 10) AS BIGINT) >> (35 - 5 * (k % 8))) & 31) AS INTEGER), 1)),
           'string_agg', '') AS payload_digest
  FROM read)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM head THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM head THEN head END AS refers_to
FROM named"""
