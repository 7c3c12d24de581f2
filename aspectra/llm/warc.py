"""WARC archives: writing captures, reading them back and assembling transactions.

``write_captures`` writes each page as a request, a response (or a revisit of an equal payload)
and a metadata record; Spark's text writer puts them into gzip files whose records end with the
two line ends that WARC asks for. ``read_records`` parses archives by Content-Length, a file at
a time and a record at a time. ``assemble`` joins the records of a capture through their
WARC-Concurrent-To ids into one nested row.
"""
from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aspectra.plans.materialize import materialize

LINE = "\r\n"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
#: Shorter payloads are always written out.
SHARED_BYTES = 1000
RECORDS_PER_FILE = 30_000

RECORD_SCHEMA = (
    "record_type string, record_id string, concurrent_to string, target_uri string, refers_to string, "
    "payload_bytes long, payload_digest string, intact boolean, fields map<string,string>, payload binary"
)


def _line(text: Column) -> Column:
    """A header value on one line; a null is empty."""
    return F.replace(F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _record_id(kind: str, *parts: Column) -> Column:
    h = F.md5(F.to_json(F.struct(F.lit(kind).alias("k"), *[p.alias(f"p{i}") for i, p in enumerate(parts)])))
    cuts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _record(kind: str, record_id: Column, block: Column, headers: list[tuple[str, Column | str]]) -> Column:
    lines: list[Column] = [F.lit(f"{VERSION}{LINE}WARC-Type: {kind}{LINE}WARC-Date: {DATE}{LINE}WARC-Record-ID: "), record_id, F.lit(LINE)]
    for name, value in headers:
        lines += [F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit(LINE)]
    return F.concat(*lines, F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(LINE + LINE), block)


def write_captures(pages: DataFrame, path: str, shared_bytes: int = SHARED_BYTES) -> None:
    """Writes ``pages`` (page_id, url, html) as gzip WARC files below ``path``.

    The payload is the html in UTF-8 (null: empty). Of captures with equal payloads of at least
    ``shared_bytes`` bytes the one with the largest page_id is the response, the others revisit
    it; a null page_id revisits a known one, and is a response where none is known. Equal rows
    (page_id, url and html) are a capture each, told apart by a number among them; all but the first
    revisit where the payload is long enough.
    """
    base = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    digest = F.sha1(F.col("html").cast("binary"))
    narrow = materialize(base.select("page_id", digest.alias("digest"), F.octet_length("html").alias("bytes"), _record_id("response", F.col("page_id"), F.col("url"), digest).alias("rid")), "warc-digests")
    groups = narrow.where(F.col("bytes") >= shared_bytes).groupBy("digest", "bytes").agg(
        F.count(F.lit(1)).alias("n"), F.max_by("rid", F.struct("page_id", "rid")).alias("leader"),
    ).where("n > 1").select("digest", "leader")
    revisits = narrow.join(groups, "digest").where("rid <> leader").select("rid", "leader").distinct()
    copies = narrow.groupBy("rid").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    facts = revisits.join(copies, "rid", "full")
    rows = base.withColumn("digest", digest).withColumn("rid", _record_id("response", F.col("page_id"), F.col("url"), F.col("digest"))).join(facts, "rid", "left")
    # equal rows become one row that is written as often as it stood: only those are exchanged
    again = rows.where("copies > 1").dropDuplicates(["rid"]).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies").cast("int") - 1)))
    rows = rows.where("copies IS NULL").withColumn("copy", F.lit(0)).unionByName(again)
    later = F.col("copy") > 0
    rows = rows.withColumn("leader", F.when(later & (F.octet_length("html") >= shared_bytes), F.coalesce("leader", "rid")).otherwise(F.col("leader")))
    rows = rows.withColumn("rid", F.when(later, _record_id("response", F.col("page_id"), F.col("url"), F.col("digest"), F.col("copy"))).otherwise(F.col("rid")))
    uri, whole = _line(F.col("url")), F.concat(F.lit("sha1:"), F.col("digest"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "), F.octet_length("html").cast("string"), F.lit(LINE + LINE))
    get = F.concat(F.lit("GET "), F.coalesce(F.regexp_extract(uri, r"^\w+://[^/?#]*([^#]*)", 1), F.lit("/")), F.lit(f" HTTP/1.1{LINE}Host: "), F.regexp_extract(uri, r"^\w+://([^/?#]*)", 1), F.lit(LINE + LINE))
    about = F.concat(F.lit("page-id: "), _line(F.col("page_id")), F.lit(f"{LINE}payload-bytes: "), F.octet_length("html").cast("string"), F.lit(LINE))
    target: list[tuple[str, Column | str]] = [("WARC-Target-URI", uri)]
    answer = F.when(
        F.col("leader").isNull(),
        _record("response", F.col("rid"), F.concat(http, "html"), [*target, ("WARC-Payload-Digest", whole), ("Content-Type", "application/http;msgtype=response")]),
    ).otherwise(
        _record("revisit", F.col("rid"), http, [*target, ("WARC-Payload-Digest", whole), ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", F.col("leader")), ("Content-Type", "application/http;msgtype=response")])
    )
    own = (F.col("page_id"), F.col("url"), F.col("digest"), F.col("copy"))
    together: list[tuple[str, Column | str]] = [*target, ("WARC-Concurrent-To", F.col("rid"))]
    request = _record("request", _record_id("request", *own), get, [*together, ("Content-Type", "application/http;msgtype=request")])
    metadata = _record("metadata", _record_id("metadata", *own), about, [*together, ("Content-Type", "application/warc-fields")])
    rows.select(F.explode(F.array(request, answer, metadata)).alias("value")).write.option("lineSep", LINE + LINE).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _headers(stream: io.BufferedReader) -> dict[str, str]:
    out = {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def parse_archive(content: bytes, with_payload: bool) -> Iterator[dict]:
    """The records of one archive (gzip or plain), in order; a cut or foreign record ends the file with an error."""
    raw = io.BytesIO(content)
    stream = io.BufferedReader(gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw, 1 << 16)
    while line := stream.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record: " + repr(line[:40]))
        head = _headers(stream)
        size = int(head["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("the archive ends inside a record")
        kind, fields, n, digest, intact, payload = head.get("warc-type"), {}, None, None, None, None
        claimed = (head.get("warc-payload-digest") or "").removeprefix("sha1:").lower() or None
        if kind == "response":
            payload = block[block.find(b"\r\n\r\n") + 4 :]
            n, digest = len(payload), hashlib.sha1(payload).hexdigest()
            intact = claimed in (None, digest)
        elif kind == "revisit":
            inner = _headers(io.BufferedReader(io.BytesIO(block.partition(b"\r\n")[2])))
            n, digest, intact = int(inner["content-length"]), claimed, True
        elif kind == "metadata":
            fields = _headers(io.BufferedReader(io.BytesIO(block)))
        yield {
            "record_type": kind, "record_id": head.get("warc-record-id"), "concurrent_to": head.get("warc-concurrent-to"), "target_uri": head.get("warc-target-uri"),
            "refers_to": head.get("warc-refers-to"), "payload_bytes": n, "payload_digest": digest, "intact": intact, "fields": list(fields.items()),
            "payload": payload if with_payload else None,
        }


def read_records(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per WARC record below ``path``; digests and lengths are taken from the payloads read."""
    names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
    types = dict(zip(names, [pa.string()] * 5 + [pa.int64(), pa.string(), pa.bool_(), pa.map_(pa.string(), pa.string()), pa.binary()]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], types[n]) for n in names], names)

        for files in batches:
            for content in files.column(0):
                rows, held = [], 0
                for r in parse_archive(content.as_py(), with_payload):
                    rows.append(r)
                    held += len(r["payload"] or b"") + 500
                    if held > 8 << 20:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD_SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: record_id, response, request, metadata, refers_to_page.

    ``response`` is the response or revisit record; ``request`` and ``metadata`` are the records
    whose WARC-Concurrent-To names it (null where there is none). Records that repeat an id are
    one record. Records without an id, and requests or metadata of no capture, give no row.
    """
    known = records.where("record_id IS NOT NULL")
    part = lambda *kinds: known.where(F.col("record_type").isin(*kinds)).dropDuplicates(["record_id"])
    cols = [c for c in records.columns if c != "concurrent_to"]
    nested = lambda name: F.struct(*cols).alias(name)
    main = part("response", "revisit").select("record_id", nested("response"))
    request = part("request").select(F.col("concurrent_to").alias("record_id"), nested("request")).dropDuplicates(["record_id"])
    metadata = part("metadata").select(F.col("concurrent_to").alias("record_id"), nested("metadata")).dropDuplicates(["record_id"])
    captures = main.join(request, "record_id", "left").join(metadata, "record_id", "left")
    # written, so that the join sees two plain tables and can split a response that many revisit
    pages = materialize(metadata.select(F.col("record_id").alias("to"), _page_id(F.col("metadata")).alias("refers_to_page")), "warc-pages")
    return captures.join(pages, F.col("response.refers_to") == F.col("to"), "left").drop("to")


def _page_id(metadata: Column) -> Column:
    return metadata["fields"]["page-id"].try_cast("long")


def captures_of(spark: SparkSession, pages: DataFrame, path: str) -> DataFrame:
    """Writes ``pages`` below ``path``, reads the archives back and returns one row per capture:

    page_id, payload_bytes, payload_digest (bare lower-case hex), record_type, refers_to (page_id
    of the response that a revisit names, else null) and intact. An empty table gives no rows.
    """
    write_captures(pages, path)
    records = materialize(read_records(spark, path).drop("payload"), "warc-records")
    r = F.col("response")
    return assemble(records).select(
        _page_id(F.col("metadata")).alias("page_id"), r["payload_bytes"].alias("payload_bytes"), r["payload_digest"].alias("payload_digest"),
        r["record_type"].alias("record_type"), F.col("refers_to_page").alias("refers_to"), r["intact"].alias("intact"),
    )
