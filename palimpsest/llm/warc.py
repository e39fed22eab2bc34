"""Operator 1, WARC transaction assembly.

Writing: every page becomes three WARC/1.1 records: the request, the response
(or a ``revisit`` of an equal payload) and a ``metadata`` record; request and
metadata name the response in ``WARC-Concurrent-To``.  Records are built with
SQL functions and written by Spark's text writer, one archive a partition; a
WARC record ends with two CRLFs, which is the writer's separator.  Archives
are gzip streams in the shared folder.

Payloads of at least ``LEAST`` bytes that are equal (same SHA-1 and length)
are stored once, under the largest page id; the others become revisits with
``WARC-Refers-To`` its record.

Reading: archives are read whole by Spark's ``binaryFile`` source, decompressed
as a stream and framed by ``Content-Length``, so payloads may hold anything
(separators and whole WARC records too).  ``assemble`` joins the records to
transactions through their concurrent-to identifiers, in either direction and
over one intermediate record, and emits one nested row a capture.

Defined cases: null html is an empty payload; a null url leaves out the
target URI; control characters in a url are percent-encoded; a null page_id
is written as an empty field and read back null; rows that repeat a page_id
are captures of their own (among equal payloads every row with the largest id
is a response; revisits name that id; null ids are smallest); records without
a partner come out with the missing parts null; several requests or metadata
records of one capture keep the one with the smallest record id first and all
ids in a list; an empty table gives one empty archive and no captures; other
columns aren't archived.
"""

from __future__ import annotations

import io
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_schema, query, shared_path, stage, table, text_or_empty

LEAST = 1000
CRLF = "\r\n"
DATE = "1970-01-01T00:00:00Z"  # pages carry no capture time
PER_ARCHIVE = 30_000  # records of an archive at most

RECORD = ("record_id string, type string, concurrent_to array<string>, refers_to string, target_uri string, "
          "payload_bytes long, payload_digest string, fields map<string,string>, payload binary")


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"), F.substring(h, 13, 4),
                    F.lit("-"), F.substring(h, 17, 4), F.lit("-"), F.substring(h, 21, 12), F.lit(">"))


def _record(kind: str | Column, record_id: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """A record's text without its closing CRLFs; null headers are left out."""
    line = lambda k, v: F.when(v.isNotNull(), F.concat(F.lit(k + ": "), v, F.lit(CRLF))).otherwise("")
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.concat(F.lit("WARC/1.1" + CRLF), line("WARC-Type", kind), line("WARC-Record-ID", record_id), line("WARC-Date", F.lit(DATE)),
                    *(line(k, v) for k, v in headers),
                    line("Content-Length", F.octet_length(block).cast("string")), F.lit(CRLF), block)


def archive_records(pages: DataFrame) -> DataFrame:
    """One row per WARC record (column ``value``), three for each page."""
    url = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A"), "\u0000", "%00")
    payload = text_or_empty("html").cast("string")
    digest = F.sha1(payload.cast("binary"))
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), payload.alias("payload"),
                       digest.alias("digest"), F.octet_length(payload).cast("long").alias("n"))
    # narrow rows decide who is the response; map-side combined, so a payload of a third of all pages is one row a task
    first = (pages.select(F.col("page_id").cast("long").alias("page_id"), digest.alias("digest"), F.octet_length(payload).cast("long").alias("n"))
             .where(F.col("n") >= LEAST).groupBy("digest", "n")
             .agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("equal")).where("equal > 1").select("digest", "n", "kept"))
    src = src.join(first, ["digest", "n"], "left")
    revisit = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    # a row's own draw keeps repeated rows apart; the record that others refer to is named by its id
    own = F.uuid()
    src = src.select("*", revisit.alias("revisit"), own.alias("salt")).select(
        "*", F.when(F.col("kept").isNotNull() & ~F.col("revisit"), F.concat_ws("|", F.lit("kept"), F.col("kept").cast("string"), "digest"))
        .otherwise(F.col("salt")).alias("name"))
    rid = _uuid(F.lit("response"), F.col("name"))
    http = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + "Content-Length: "),
                    F.col("n").cast("string"), F.lit(CRLF + CRLF))
    path = F.coalesce(F.regexp_extract("url", r"^[^:]*://[^/]*(/.*)$", 1), F.lit("/"))
    host = F.coalesce(F.regexp_extract("url", r"^[^:]*://([^/?#]*)", 1), F.lit(""))
    request = F.concat(F.lit("GET "), path, F.lit(" HTTP/1.1" + CRLF + "Host: "), host, F.lit(CRLF + CRLF))
    note = F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(CRLF),
                    F.lit("capture: "), F.col("salt"), F.lit(CRLF))
    uri = ("WARC-Target-URI", F.col("url"))
    to = ("WARC-Concurrent-To", rid)
    sha = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    return src.select(F.explode(F.array(
        _record("request", _uuid(F.lit("request"), F.col("salt")), [uri, to, ("Content-Type", F.lit("application/http;msgtype=request"))], request),
        _record(F.when(F.col("revisit"), "revisit").otherwise("response"), rid, [
            uri, sha, ("WARC-Refers-To", F.when(F.col("revisit"), _uuid(F.lit("response"), F.concat_ws("|", F.lit("kept"), F.col("kept").cast("string"), "digest")))),
            ("WARC-Profile", F.when(F.col("revisit"), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
            ("Content-Type", F.lit("application/http;msgtype=response"))],
            F.when(F.col("revisit"), http).otherwise(F.concat(http, F.col("payload")))),
        _record("metadata", _uuid(F.lit("metadata"), F.col("salt")), [uri, to, ("Content-Type", F.lit("application/warc-fields"))], note),
    )).alias("value"))


def write_archives(pages: DataFrame, path: str) -> None:
    (archive_records(pages).write.option("lineSep", CRLF * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", PER_ARCHIVE).text(path))


def frames(stream):
    """(headers, block) of every record of a WARC stream, by Content-Length."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:60]!r}")
        headers: list[tuple[str, str]] = []
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            k, _, v = line.decode("utf-8", "replace").partition(":")
            headers.append((k.strip().lower(), v.strip()))
        n = int(dict(headers)["content-length"])
        block = stream.read(n)
        if len(block) != n:
            raise ValueError("a WARC record is cut short")
        yield headers, block


def _member_stream(raw: bytes):
    """Decompressed bytes of an archive (plain, one or many gzip members)."""
    if raw[:2] != b"\x1f\x8b":
        return io.BytesIO(raw)

    class Stream(io.RawIOBase):
        def __init__(self):
            self.at, self.rest, self.z = 0, b"", zlib.decompressobj(31)

        def readable(self):
            return True

        def readinto(self, b):
            while True:
                if not self.rest:
                    self.rest = raw[self.at:self.at + (1 << 16)]
                    self.at += len(self.rest)
                got = self.z.decompress(self.rest, len(b))
                ended = not self.rest
                self.rest = self.z.unconsumed_tail
                if self.z.eof:
                    self.rest, self.z = self.z.unused_data, zlib.decompressobj(31)
                if got or ended:
                    b[:len(got)] = got
                    return len(got)

    return io.BufferedReader(Stream(), 1 << 16)


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives below ``path`` (see ``RECORD``).  Payload:
    an HTTP message's body, else the block; length and digest are taken from
    the full payload in either case (a revisit holds none)."""
    src = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")

    schema = arrow_schema(RECORD)

    def run(batches):
        import hashlib

        import pyarrow as pa

        def flush(rows):
            return pa.RecordBatch.from_pylist(rows, schema=schema)

        for rb in batches:
            for raw in rb.column(0):
                rows, size = [], 0
                for headers, block in frames(_member_stream(raw.as_py())):
                    h = dict(headers)
                    kind, fields, body = h.get("warc-type"), {}, block
                    if h.get("content-type", "").startswith("application/http"):
                        body = block.partition(b"\r\n\r\n")[2]
                    elif h.get("content-type") == "application/warc-fields":
                        for line in block.decode("utf-8", "replace").splitlines():
                            k, _, v = line.partition(":")
                            fields[k.strip().lower()] = v.strip()
                    revisit = kind == "revisit"
                    said = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    rows.append({
                        "record_id": h.get("warc-record-id"), "type": kind, "refers_to": h.get("warc-refers-to"),
                        "concurrent_to": [v for k, v in headers if k == "warc-concurrent-to"], "target_uri": h.get("warc-target-uri"),
                        "payload_bytes": None if revisit else len(body),
                        "payload_digest": said if revisit else hashlib.sha1(body).hexdigest(),
                        "fields": list(fields.items()), "payload": body if with_payload and not revisit else None})
                    size += len(body) if with_payload else 200
                    if size > 4_000_000:
                        yield flush(rows)
                        rows, size = [], 0
                if rows:
                    yield flush(rows)

    return src.mapInArrow(run, RECORD)


def assemble(records: DataFrame, with_payload: bool = True) -> DataFrame:
    """One nested row per capture (response or revisit): ``capture``,
    ``request``, ``metadata`` structs, and all ids of each kind."""
    records = stage(records, "warc-records")  # read for captures, parts and links
    body = ["payload_bytes", "payload_digest", *(["payload"] if with_payload else [])]
    anchor = F.col("type").isin("response", "revisit")
    part = F.struct("record_id", "type", "refers_to", "target_uri", *body)
    captures = records.where(anchor).select(
        F.col("record_id").alias("key"), part.alias("capture"), F.col("concurrent_to").alias("says"))
    others = records.where(F.col("type").isin("request", "metadata")).select(
        "record_id", "type", F.struct("record_id", "target_uri", *body, "fields").alias("part"), F.explode_outer("concurrent_to").alias("to"))
    # links in either direction, and over one other record of the same capture
    ids = captures.select("key")
    direct = others.join(ids.withColumnRenamed("key", "to"), "to", "left_semi").select("record_id", F.col("to").alias("key"))
    reverse = (captures.where(F.size("says") > 0).select("key", F.explode("says").alias("record_id"))
               .join(others.select("record_id").distinct(), "record_id", "left_semi").select("record_id", "key"))
    near = direct.union(reverse).distinct()
    loose = others.join(near.select("record_id"), "record_id", "left_anti").where(F.col("to").isNotNull()).select("record_id", "to")
    far = loose.join(near.select(F.col("record_id").alias("to"), "key"), "to").select("record_id", "key")
    parts = (near.union(far).distinct().join(others.drop("to").dropDuplicates(["record_id"]), "record_id")
             .groupBy("key").agg(*(x for kind in ("request", "metadata") for x in (
                 F.min_by(F.when(F.col("type") == kind, F.col("part")), F.when(F.col("type") == kind, F.col("record_id"))).alias(kind),
                 F.sort_array(F.collect_set(F.when(F.col("type") == kind, F.col("record_id")))).alias(f"{kind}_ids")))))
    return captures.join(parts, "key", "left").select("capture", "request", "metadata", "request_ids", "metadata_ids")


SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS n, sha1(b) AS digest FROM p),
m AS (SELECT digest, n, max(page_id) AS kept FROM d WHERE n >= {LEAST} GROUP BY ALL)
SELECT d.page_id, d.n AS payload_bytes, d.digest AS payload_digest,
  CASE WHEN m.kept IS NOT NULL AND m.kept IS DISTINCT FROM d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN m.kept IS NOT NULL AND m.kept IS DISTINCT FROM d.page_id THEN m.kept END AS refers_to
FROM d LEFT JOIN m USING (digest, n)
"""


@query("op1_warc_assembly", SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    got = assemble(read_records(spark, path, with_payload=False), with_payload=False)
    c = got.select(F.col("metadata.fields")["page-id"].alias("page"), "capture.*")
    c = c.select(F.expr("try_cast(nullif(page, '') AS bigint)").alias("page_id"), "record_id", "type", "refers_to", "payload_bytes", "payload_digest")
    response = (c.where(F.col("type") == "response").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("to_page"), F.col("payload_bytes").alias("to_bytes"))
                .groupBy("refers_to").agg(F.max("to_page").alias("to_page"), F.max("to_bytes").alias("to_bytes")))
    return c.join(response, "refers_to", "left").select(
        "page_id", F.coalesce("payload_bytes", "to_bytes").alias("payload_bytes"), "payload_digest",
        F.col("type").alias("record_type"), F.col("to_page").alias("refers_to"))
