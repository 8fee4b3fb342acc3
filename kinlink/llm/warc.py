"""WARC archives: write captures, read records, assemble transactions.

A capture is written as a request, a response (or revisit) and a metadata
record; the request and the metadata name the response in WARC-Concurrent-To.
Record identifiers are derived from the capture's id, URL and payload, so a
rerun writes the same archive.  Of captures with equal payloads of at least
``least`` bytes the one with the largest id (then URL) is a response and the
others revisit it; rows equal in id, URL and payload too are all responses.
Null payloads are empty; null ids and URLs come back as null and "".  An empty
table gives an empty archive.  Payloads of any length are one record; repeated
rows are records of their own, which share an identifier.  Columns beside id,
URL and payload are left out, whatever their names.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"
SALTS = 32
RECORDS = "record_id string, type string, concurrent_to string, refers_to string, uri string, date string, digest string, payload_bytes long, payload binary, fields map<string,string>"


def _uuid(kind: str, page: Column, url: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), F.coalesce(page.cast("string"), F.lit("-")), url, digest))
    return F.concat(F.lit("<urn:uuid:"), *[x for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)) for x in ([F.lit("-")] if a > 1 else []) + [h.substr(a, n)]], F.lit(">"))


def _record(head: list[tuple[str, Column]], content: Column) -> Column:
    lines = [F.lit("WARC/1.0\r\n")]
    for name, value in [*head, ("Content-Length", F.octet_length(content).cast("string"))]:
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")))
    return F.concat(*lines, F.lit("\r\n"), content)


def captures(pages: DataFrame, page: str = "page_id", url: str = "url", payload: str = "html", least: int = 1000) -> DataFrame:
    """``_page, _url, _payload, _digest, _bytes, _first`` (a struct page, url: the response of a revisit, else null)."""
    rows = pages.select(pages[page].alias("_page"), F.regexp_replace(F.coalesce(pages[url], F.lit("")), r"[\r\n]", " ").alias("_url"), F.coalesce(pages[payload], F.lit("")).alias("_payload"))
    rows = rows.withColumn("_digest", F.sha1("_payload")).withColumn("_bytes", F.octet_length("_payload").cast("long"))
    me = F.struct(F.col("_page").alias("page"), F.col("_url").alias("url"))
    groups = rows.where(F.col("_bytes") >= least).groupBy("_digest").agg(F.max(me).alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    # The rows of one payload may be a third of all: they spread over salts, and their group's row goes to each.
    groups = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("_page", "_url"), F.lit(SALTS)).cast("int"))
    first = F.when((F.col("_bytes") >= least) & ~F.col("_first").eqNullSafe(me), F.col("_first"))
    return rows.join(groups, ["_digest", "_salt"], "left").withColumn("_first", first).drop("_salt")


def write_warc(pages: DataFrame, path: str, page: str = "page_id", url: str = "url", payload: str = "html", least: int = 1000, records_per_file: int = 3000) -> None:
    """Write the archive to ``path`` (any file system Spark writes to), gzipped, ``records_per_file`` records a file at most.

    The text sink writes each record followed by its two line ends; payloads are
    UTF-8 text.  Every column but the three named is left out.
    """
    c = captures(pages, page, url, payload, least)
    mine, http = _uuid("response", F.col("_page"), F.col("_url"), F.col("_digest")), "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
    of = _uuid("response", F.col("_first.page"), F.col("_first.url"), F.col("_digest"))
    revisit, stamp = F.col("_first").isNotNull(), ("WARC-Date", F.lit(DATE))
    uri = ("WARC-Target-URI", F.col("_url"))
    response = _record(
        [
            ("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))), ("WARC-Record-ID", F.col("_id")), stamp, uri,
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_digest"))), ("WARC-Refers-To", F.when(revisit, of)),
            ("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"))), ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.concat(F.lit(http), F.col("_bytes").cast("string"), F.lit(END), F.when(revisit, F.lit("")).otherwise(F.col("_payload"))),
    )
    request = _record(
        [("WARC-Type", F.lit("request")), ("WARC-Record-ID", _uuid("request", F.col("_page"), F.col("_url"), F.col("_digest"))), stamp, uri, ("WARC-Concurrent-To", F.col("_id")), ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), F.col("_url"), F.lit(" HTTP/1.1" + END)),
    )
    metadata = _record(
        [("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _uuid("metadata", F.col("_page"), F.col("_url"), F.col("_digest"))), stamp, uri, ("WARC-Concurrent-To", F.col("_id")), ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(
            F.coalesce(F.concat(F.lit("page-id: "), F.col("_page").cast("string"), F.lit("\r\n")), F.lit("")),
            F.coalesce(F.concat(F.lit("refers-to-page-id: "), F.col("_first.page").cast("string"), F.lit("\r\n")), F.lit("")),
        ),
    )
    out = c.withColumn("_id", mine).select(F.explode(F.array(request, response, metadata)).alias("value"))
    out.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def _lines(block: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in block.decode("utf-8", "replace").split("\r\n") if ":" in line)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def parse(data: bytes) -> Iterator[dict]:
    """The records of one archive file, plain or gzipped (whole or record by record), by Content-Length."""
    stream = io.BytesIO(data)
    if data[:2] == b"\x1f\x8b":
        stream = gzip.GzipFile(fileobj=stream)
    while version := stream.readline():
        if not version.strip():
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        head = b""
        while (line := stream.readline()) and line.strip():
            head += line
        h = _lines(head)
        length = int(h.get("content-length", 0))
        content = stream.read(length)
        if len(content) < length:
            raise ValueError(f"record {h.get('warc-record-id')} is cut off")
        kind, payload, size, fields = h.get("warc-type"), None, None, None
        if h.get("content-type", "").startswith("application/http"):
            status, _, payload = content.partition(b"\r\n\r\n")
            size = int(_lines(status).get("content-length", len(payload))) if kind == "revisit" else len(payload)
        elif h.get("content-type", "").startswith("application/warc-fields"):
            fields = _lines(content)
        digest = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
        if kind == "response":
            found = hashlib.sha1(payload or b"").hexdigest()
            if digest and digest != found:
                raise ValueError(f"record {h.get('warc-record-id')} has another digest")
            digest = found
        yield {
            "record_id": h.get("warc-record-id"), "type": kind, "concurrent_to": h.get("warc-concurrent-to"), "refers_to": h.get("warc-refers-to"), "uri": h.get("warc-target-uri"), "date": h.get("warc-date"),
            "digest": digest, "payload_bytes": size, "payload": payload if kind == "response" else None, "fields": fields,
        }


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row (``RECORDS``) a record of the archives under ``path``; one task holds one file at a time."""

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                rows, held = [], 0
                for r in parse(bytes(data)):
                    if not payloads:
                        r["payload"] = None
                    rows.append(r)
                    held += len(r["payload"] or b"")
                    if len(rows) >= 5000 or held > 8_000_000:
                        yield pd.DataFrame(rows, columns=names)
                        rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    names = [x.split()[0] for x in RECORDS.replace("map<string,string>", "map").split(", ")]
    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(records, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One row a capture: ``capture_id, uri, request, response, metadata`` (structs).

    Requests and metadata join the response or revisit they name; where several
    with one identifier name it, one stays.  A capture without them has null
    structs; requests and metadata that name no response are left out.
    """

    def side(kind: str) -> DataFrame:
        rows = records.where(F.col("type") == kind).where(F.col("concurrent_to").isNotNull())
        whole = F.struct("record_id", "uri", "date", "fields").alias(kind)
        return rows.select(F.col("concurrent_to").alias("capture_id"), whole).dropDuplicates(["capture_id"])

    main = records.where(F.col("type").isin("response", "revisit")).select(
        F.col("record_id").alias("capture_id"), "uri", F.struct("record_id", "type", "refers_to", "date", "digest", "payload_bytes", "payload").alias("response")
    )
    return main.join(side("request"), "capture_id", "left").join(side("metadata"), "capture_id", "left").select("capture_id", "uri", "request", "response", "metadata")
