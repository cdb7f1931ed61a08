"""WARC archives: a writer, and a reader that salvages damaged files.

Records are written by Spark's text writer, a row per record with the blank lines between records as the line
separator, so files are committed task by task on any file system. Files hold at most ``RECORDS_PER_FILE``
records. The reader takes plain files and files of gzip members. Each record is checked (version line, headers, length,
closing blank lines, payload digest); after a failed check it looks for the next version line or gzip member whose
record passes, goes on from there, and reports the bytes in between as a quarantined gap.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm.staging import staged

RECORDS_PER_FILE = 2_000
REVISIT_FROM = 1_000
BROADCAST_GROUPS = 500_000
_SALT = 64
_CHUNK = 1 << 16
#: Not bound to the start of a line: what stands before a record may be the torn end of another.
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_GZIP = b"\x1f\x8b\x08"
_FIELDS = ["file", "offset", "length", "kind", "reason", "record_type", "record_id", "target_uri", "refers_to", "payload_bytes",
           "payload_digest", "payload"]
_DDL = ("file string, offset long, length long, kind string, reason string, record_type string, record_id string, target_uri string, "
        "refers_to string, payload_bytes long, payload_digest string, payload binary")
_SCHEMA = pa.schema([(f, pa.binary() if f == "payload" else pa.int64() if f in ("offset", "length", "payload_bytes") else pa.string())
                     for f in _FIELDS])


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def with_revisits(pages: DataFrame, revisit_from: int = REVISIT_FROM, broadcast_groups: int = BROADCAST_GROUPS) -> DataFrame:
    """``page_id, url, html, n_bytes, sha1, response_id``: the page that an equal, long enough payload refers to.

    ``response_id`` is the largest ``page_id`` of the equal payloads, or null where a row is a response itself.
    A page_id is only null among equals if all are; rows that repeat the largest one are responses too.
    Groups are reduced per (digest, salt) before they meet. Payloads that occur more than once are told to every task
    up to ``BROADCAST_GROUPS`` of them (about 60 bytes each), so pages are not shuffled; beyond, answers return per
    (digest, salt). Either way a large group of copies is never in one task.
    """
    text = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), text.alias("html"), F.octet_length(text).alias("n_bytes"),
                        F.sha1(text).alias("sha1"), F.pmod(F.xxhash64("page_id", "url"), F.lit(_SALT)).alias("salt"))
    part = rows.where(F.col("n_bytes") >= revisit_from).groupBy("sha1", "n_bytes", "salt").agg(
        F.max("page_id").alias("top"), F.count("*").alias("copies"))
    whole = part.groupBy("sha1", "n_bytes").agg(F.max("top").alias("response_id"), F.sum("copies").alias("copies"))
    whole = staged(whole.where("copies > 1").drop("copies"), "payloads")
    if whole.count() <= broadcast_groups:
        out = rows.join(F.broadcast(whole), ["sha1", "n_bytes"], "left")
    else:
        answers = part.select("sha1", "n_bytes", "salt").join(whole, ["sha1", "n_bytes"])
        out = rows.join(answers, ["sha1", "n_bytes", "salt"], "left")
    first = F.col("page_id").eqNullSafe(F.col("response_id")) | F.col("response_id").isNull()
    return out.select("page_id", "url", "html", "n_bytes", "sha1", F.when(~first, F.col("response_id")).alias("response_id"))


def _record() -> Column:
    revisit = F.col("response_id").isNotNull()

    def line(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value), F.lit("\r\n"))

    url = F.regexp_replace(F.coalesce("url", F.lit("")), "[\r\n]+", " ")
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", _urn(F.col("page_id"))), line("WARC-Date", "1970-01-01T00:00:00Z"), line("WARC-Target-URI", url),
        F.when(revisit, F.concat(line("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                                 line("WARC-Refers-To", _urn(F.col("response_id"))))).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))), line("WARC-Payload-Length", F.col("n_bytes").cast("string")),
        line("Content-Type", "text/html; charset=utf-8"),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("n_bytes").cast("string"))), F.lit("\r\n"),
        F.when(revisit, F.lit("")).otherwise(F.col("html")))


def write_archives(pages: DataFrame, path: str, revisit_from: int = REVISIT_FROM, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write a record per row of ``pages`` (``page_id, url, html``; null html is an empty payload) below ``path``."""
    records = with_revisits(pages, revisit_from).select(_record().alias("value"))
    records.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", records_per_file).text(path)


class BadRecord(ValueError):
    """Why the bytes at a place are no valid record."""


def _headers(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise BadRecord("header line without a colon")
        out[name.strip().lower()] = value.strip()
    return out


def parse_record(data: bytes, at: int) -> tuple[dict, int]:
    """The record at ``at`` and the place after it; raises :class:`BadRecord`."""
    if not _VERSION.match(data, at):
        raise BadRecord("no version line")
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise BadRecord("headers not ended")
    head = _headers(data[at:end])
    try:
        size = int(head["content-length"])
    except (KeyError, ValueError):
        raise BadRecord("no content length") from None
    body, after = end + 4, end + 4 + size
    if size < 0 or data[after:after + 4] != b"\r\n\r\n":
        raise BadRecord("length does not fit")
    payload = data[body:after]
    kind, digest = head.get("warc-type", ""), head.get("warc-payload-digest", "").partition(":")[2]
    if kind != "revisit" and digest and hashlib.sha1(payload).hexdigest() != digest.lower():
        raise BadRecord("payload digest differs")
    full = int(head["warc-payload-length"]) if kind == "revisit" and head.get("warc-payload-length", "").isdigit() else size
    return {"record_type": kind, "record_id": head.get("warc-record-id"), "target_uri": head.get("warc-target-uri"),
            "refers_to": head.get("warc-refers-to"), "payload_bytes": full, "payload_digest": digest.lower() or hashlib.sha1(payload).hexdigest(),
            "payload": payload}, after + 4


def _member(data: bytes, at: int) -> tuple[dict, int]:
    """The record in the gzip member at ``at`` and the place after the member."""
    unzip, parts = zlib.decompressobj(31), []
    while not unzip.eof:
        if at >= len(data):
            raise BadRecord("gzip member cut off")
        try:
            parts.append(unzip.decompress(data[at:at + _CHUNK]))
        except zlib.error as e:
            raise BadRecord(f"gzip: {e}") from None
        at += min(_CHUNK, len(data) - at)
    plain = b"".join(parts)
    record, end = parse_record(plain, 0)
    if end != len(plain):
        raise BadRecord("more than one record in a member")
    return record, at - len(unzip.unused_data)


def salvage(data: bytes) -> Iterator[dict]:
    """Records and gaps of one archive file, in order, covering every byte."""
    at, bad_from, why = 0, -1, ""
    while at < len(data):
        try:
            record, end = _member(data, at) if data.startswith(_GZIP, at) else parse_record(data, at)
        except BadRecord as e:
            if bad_from < 0:
                bad_from, why = at, str(e)
            plain, zipped = _VERSION.search(data, at + 1), data.find(_GZIP, at + 1)
            at = min(plain.start() if plain else len(data), zipped if zipped >= 0 else len(data))
            continue
        if bad_from >= 0:
            yield {"offset": bad_from, "length": at - bad_from, "kind": "gap", "reason": why}
            bad_from = -1
        yield {"offset": at, "length": end - at, "kind": "record"} | record
        at = end
    if bad_from >= 0:
        yield {"offset": bad_from, "length": len(data) - bad_from, "kind": "gap", "reason": why}


def _read(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                name, rows, size = b.column("path")[i].as_py(), [], 0
                for x in salvage(b.column("content")[i].as_py()):
                    size += len(x.get("payload") or b"") if payloads else 0
                    rows.append({f: x.get(f) for f in _FIELDS if payloads or f != "payload"} | {"file": name})
                    if len(rows) >= 5_000 or size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)

    return run


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records and quarantined gaps (``kind``) of the archive files below ``path``, with file and byte range."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_read(payloads), _DDL)


def page_records(archive: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of the records."""
    def page(c: str) -> Column:
        return F.regexp_extract(c, "<urn:page:(-?[0-9]+)>", 1).try_cast("long")

    return archive.where("kind = 'record'").select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                                                   page("refers_to").alias("refers_to"))


ORACLE_WARC = """
with p as (select page_id, encode(coalesce(html, '')) as body from pages),
q as (select page_id, octet_length(body) as n, sha1(body) as digest, max(page_id) over (partition by body) as top from p)
select page_id, n as payload_bytes, digest as payload_digest,
       case when n >= 1000 and page_id <> top then 'revisit' else 'response' end as record_type,
       case when n >= 1000 and page_id <> top then top end as refers_to
from q
"""
