"""WARC: archives written from pages, and read back into one nested row per capture.

Writing: each page becomes three records (request, response or revisit, metadata), tied by
``WARC-Concurrent-To``. Of pages with equal payloads of at least ``min_bytes`` bytes the one with the
largest id is the response, the others are revisits of it. Records are text (UTF-8), so Spark's text
writer puts them into gzip files of at most ``records_per_file`` records, on any file system.

Reading: records are cut by their Content-Length; request and metadata records join their capture by
the concurrent-to identifiers, in either direction, and a revisit joins the response it refers to.

A null payload is empty. A null url leaves the target out, a null page id leaves the field out of the
metadata. Repeated rows are captures of their own: record ids come from a row number of the scan, so
the pages have to come from a table that does not change while it is written. Line ends inside a url
are escaped. Other columns are ignored; an empty table gives empty archives and no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.llm.common import slices, table
from voltide.operators.ordering import scratch_path

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = "record_id string, type string, concurrent_to string, refers_to string, target string, page_id bigint, payload_bytes bigint, payload_digest string, payload string"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, rid: str, date: str, content: str, block: str, *, target: str | None, **more: str | None) -> str:
    """One record without the two line ends that close it."""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{rid}>", f"WARC-Date: {date}"]
    if target:
        head.append("WARC-Target-URI: " + target)
    head += [f"WARC-{k.replace('_', '-')}: {v}" for k, v in more.items() if v]
    head += [f"Content-Type: {content}", f"Content-Length: {len(block.encode())}"]
    return CRLF.join(head) + CRLF + CRLF + block


def transaction(row: dict, date: str) -> list[str]:
    """The records of one capture."""
    payload, rid = row["html"] or "", row["rid"]
    url = re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), row["url"] or "")
    digest, revisit = "sha1:" + sha1_base32(payload.encode()), row["of"] is not None and row["of"] != rid
    http = CRLF.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload.encode())}"]) + CRLF + CRLF
    more = {"Profile": PROFILE, "Refers_To": f"<urn:uuid:{row['of']}>"} if revisit else {}
    main = record("revisit" if revisit else "response", rid, date, "application/http; msgtype=response", http + ("" if revisit else payload), target=url, Payload_Digest=digest, **more)
    try:
        parts = urlsplit(url)
        path, host = (parts.path or "/") + (f"?{parts.query}" if parts.query else ""), parts.netloc
    except ValueError:
        path, host = "/", ""
    asked = f"GET {path} HTTP/1.1{CRLF}Host: {host}{CRLF}{CRLF}"
    tied = f"<urn:uuid:{rid}>"
    fields = "" if row["page_id"] is None else f"pageId: {row['page_id']}{CRLF}"
    return [
        record("request", _uuid(rid + "q"), date, "application/http; msgtype=request", asked, target=url, Concurrent_To=tied),
        main,
        record("metadata", _uuid(rid + "m"), date, "application/warc-fields", fields, target=url, Concurrent_To=tied),
    ]


def _uuid(seed: str) -> str:
    h = hashlib.md5(seed.encode()).hexdigest()
    return f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}"


def write_archives(pages: DataFrame, path: str, *, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", records_per_file: int = 9000) -> None:
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    same = F.sha2(html.cast("binary"), 256)
    seed = F.md5(F.concat_ws("|", F.monotonically_increasing_id(), F.col("page_id"), same))
    dashed = F.regexp_replace(seed, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"), same.alias("same"), dashed.alias("rid"))
    # one row per payload, combined on the map side; a page without an id comes last
    first = rows.where(F.octet_length("html") >= min_bytes).groupBy("same").agg(F.max(F.struct(F.col("page_id"), F.col("rid"))).alias("top"), F.count("*").alias("n"))
    first = first.where("n > 1").select("same", F.col("top.rid").alias("of"))
    placed = rows.join(first, "same", "left").select("page_id", "url", "html", "rid", "of")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            out = [r for row in part.to_pylist() for r in transaction(row, date)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])

    placed.mapInArrow(run, "value string").write.option("lineSep", CRLF + CRLF).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def parse(data: bytes, payloads: bool) -> Iterator[tuple]:
    """The records of one archive in the order of ``RECORDS``."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = {}
        for line in data[at:end].split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            head[name.strip().lower().decode()] = value.strip().decode()
        block = data[end + 4 : end + 4 + int(head["content-length"])]
        at = end + 4 + len(block) + 4
        kind, page, size, digest, payload = head["warc-type"], None, None, head.get("warc-payload-digest", "")[5:] or None, None
        if kind == "response":
            body = block[block.index(b"\r\n\r\n") + 4 :]
            size, digest, payload = len(body), sha1_base32(body), body.decode() if payloads else None
        elif kind == "metadata" and (m := re.search(rb"(?m)^pageId: (-?\d+)", block)):
            page = int(m[1])
        ref = lambda k: head[k][10:-1] if k in head else None
        yield ref("warc-record-id"), kind, ref("warc-concurrent-to"), ref("warc-refers-to"), head.get("warc-target-uri"), page, size, digest, payload


def read_records(spark: SparkSession, path: str, *, payloads: bool = True) -> DataFrame:
    """One row per record of the archives below ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = list(parse(gzip.decompress(content.as_py()), payloads))
                for k in range(0, len(rows), 2000):
                    kinds = [pa.string()] * 5 + [pa.int64(), pa.int64(), pa.string(), pa.string()]
                    cols = [pa.array([r[i] for r in rows[k : k + 2000]], t) for i, t in enumerate(kinds)]
                    yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in RECORDS.split(", ")])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(run, RECORDS)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: the response or revisit with its request, metadata and referred response."""
    main = records.where(F.col("type").isin("response", "revisit"))
    # the links of either direction, as (capture, other record)
    beside = records.where(F.col("type").isin("request", "metadata"))
    other = F.struct("record_id", "type", "target", "page_id")
    forth = beside.where(F.col("concurrent_to").isNotNull()).select(F.col("concurrent_to").alias("record_id"), other.alias("o"))
    back = main.where(F.col("concurrent_to").isNotNull()).select("record_id", F.col("concurrent_to").alias("_other"))
    back = back.join(beside.select(F.col("record_id").alias("_other"), other.alias("o")), "_other").select("record_id", "o")
    tied = forth.unionByName(back).groupBy("record_id").agg(
        F.min(F.when(F.col("o.type") == "request", F.col("o"))).alias("request"),
        F.sort_array(F.collect_set(F.when(F.col("o.type") == "metadata", F.col("o")))).alias("metadata"),
    )
    full = main.join(tied, "record_id", "left").withColumn("page_id", F.array_min(F.transform("metadata", lambda m: m["page_id"])))
    whole = full.where(F.col("type") == "response").select(
        F.col("record_id").alias("refers_to"), F.struct("record_id", "page_id", "payload_bytes", "payload_digest", "payload").alias("referred")
    )
    nested = full.join(whole, "refers_to", "left")
    response = F.struct("record_id", "type", "target", "payload_bytes", "payload_digest", "payload")
    return nested.select("record_id", "page_id", F.col("type").alias("record_type"), response.alias("response"), "request", "metadata", "referred")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path, min_bytes=0)
    rows = captures(read_records(spark, path, payloads=False))
    return rows.select(
        "page_id",
        F.coalesce("response.payload_bytes", "referred.payload_bytes").alias("payload_bytes"),
        F.coalesce("response.payload_digest", "referred.payload_digest").alias("payload_digest"),
        "record_type",
        F.col("referred.page_id").alias("refers_to"),
    )


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS last FROM p),
b AS (SELECT *, from_hex(x)::BIT::VARCHAR AS bits FROM d)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 160, 5), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + 16 * substr(bits, i + 1, 1)::INT + 8 * substr(bits, i + 2, 1)::INT + 4 * substr(bits, i + 3, 1)::INT + 2 * substr(bits, i + 4, 1)::INT + substr(bits, i + 5, 1)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM b
"""
