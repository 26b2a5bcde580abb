"""WARC archives: one gzip member per record, equal payloads stored once.

``write_archives`` turns pages into response records; of equal payloads only the one
with the smallest id is stored, the others become revisit records that refer to it.
Each part of the input becomes one archive, written and read through Spark's own file
access, so that archives may lie in any store Spark reaches. (Spark's text sink ends
each row with a line separator; the separator set here is the zero byte in which a
gzip member ends anyway.)

``read_archives`` reads archives from front to back: members are decompressed step by
step, blocks are framed by their content length, and block and payload digests are
verified. Damaged compression or framing raises ``ValueError``; a wrong digest is
reported in ``digest_ok``.

A null html is an empty payload. Rows that repeat the stored page are responses as
well. A page without id is stored under the id ``null``, and only if no page with an
id has its payload is it the one referred to. A null url leaves the target out.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from marlspike.llm.scratch import stored

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Capture date written to records; tables of pages have none.
DATE = "1970-01-01T00:00:00Z"
STEP = 1 << 16
_EMPTY_MEMBER = zlib.compress(b"", wbits=31)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _line(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) <= 0x20 or c == "\x7f" else c for c in value)


def member(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as one gzip member (followed by an empty member if it doesn't end in a zero byte)."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: {digest(payload)}", f"WARC-Block-Digest: {digest(block)}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = b"".join([pack.compress("\r\n".join(head).encode()), pack.compress(b"\r\n\r\n"), pack.compress(block), pack.compress(b"\r\n\r\n"), pack.flush()])
    return data if data[-1] == 0 else data + _EMPTY_MEMBER


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Archives of ``pages`` (page_id, url, html) in folder ``path``; payloads under ``least_bytes`` are never shared."""
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].alias("url"), F.coalesce(pages["html"], F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1("html"))
    shared = rows.filter(F.octet_length("html") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("stored"), F.count("*").alias("n"))
    shared = stored(shared.filter("n > 1").select("digest", "stored"), "shared")
    rows = rows.join(shared, "digest", "left")
    refers = F.when(F.col("page_id").eqNullSafe(F.col("stored")), F.lit(None)).otherwise(F.col("stored"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                part = batch.slice(first, 64).to_pylist()
                made = [member(r["page_id"], r["url"], r["html"].encode(), r["refers_to"])[:-1] for r in part]
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["member"])

    members = rows.select("page_id", "url", "html", refers.cast("long").alias("refers_to")).mapInArrow(run, "member binary")
    members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\x00").text(path)


def _inflated(data: bytes) -> Iterator[tuple[bytes, bool]]:
    """Decompressed steps of an archive; True with the last step of a member."""
    view, at, rest = memoryview(data), 0, b""
    while at < len(view) or rest:
        pack = zlib.decompressobj(31)
        while not pack.eof:
            if not rest:
                if at >= len(view):
                    raise ValueError("archive ends inside a member")
                rest = bytes(view[at:at + STEP])
                at += STEP
            try:
                out = pack.decompress(rest, STEP)
            except zlib.error as e:
                raise ValueError(f"damaged member: {e}") from e
            rest = pack.unused_data if pack.eof else pack.unconsumed_tail
            yield out, pack.eof


def records(data: bytes) -> Iterator[dict]:
    """The records of one archive, in order."""
    buffer = bytearray()
    for out, ended in _inflated(data):
        buffer += out
        if not ended or not buffer:
            continue
        head, mark, body = bytes(buffer).partition(b"\r\n\r\n")
        buffer.clear()
        lines = head.decode().split("\r\n")
        if not mark or not lines[0].startswith("WARC/1."):
            raise ValueError("no record header")
        fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
        size = int(fields["content-length"])
        if body[size:] != b"\r\n\r\n":
            raise ValueError("record length and content length differ")
        block = body[:size]
        http, _, payload = block.partition(b"\r\n\r\n")
        length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        kind = fields["warc-type"]
        ok = digest(block) == fields["warc-block-digest"]
        if kind == "response":
            ok = ok and len(payload) == length and digest(payload) == fields["warc-payload-digest"]
        page = fields["warc-record-id"][len("<urn:page:"):-1]
        yield {
            "page_id": None if page == "null" else int(page), "url": fields.get("warc-target-uri"), "record_type": kind,
            "payload_bytes": length, "payload_digest": fields["warc-payload-digest"].split(":")[1],
            "refers_to": int(fields["warc-refers-to"][len("<urn:page:"):-1]) if "warc-refers-to" in fields else None,
            "payload": payload if kind == "response" else None, "digest_ok": ok,
        }
    if buffer:
        raise ValueError("archive ends inside a record")


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of all archives in ``path``; payloads are left out on request."""
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", *["payload"] * payload, "digest_ok"]
    kinds = dict(page_id=pa.int64(), url=pa.string(), record_type=pa.string(), payload_bytes=pa.int64(), payload_digest=pa.string(),
                 refers_to=pa.int64(), payload=pa.binary(), digest_ok=pa.bool_())
    spark_kinds = dict(page_id="long", url="string", record_type="string", payload_bytes="long", payload_digest="string",
                       refers_to="long", payload="binary", digest_ok="boolean")

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds[n]) for n in names], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0):
                rows = []
                for r in records(archive.as_py()):
                    rows.append(r)
                    if len(rows) == 256:
                        yield batch_of(rows)
                        rows = []
                yield batch_of(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, ", ".join(f"{n} {spark_kinds[n]}" for n in names))
