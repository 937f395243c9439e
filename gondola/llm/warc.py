"""Web archives without repeated payloads: revisit records, written and resolved.

Headers only are shuffled to find the first record of each payload. Pages then
meet their decision, become WARC/1.1 records with fresh headers, and are written
by the text writer with the record separator CRLF CRLF as line end: plain archive
files on any file system Spark can write, under its commit protocol. A task begins a new
file (folder ``roll=...``) after ``FILE_BYTES``, so no file grows with the input; the reader
unpacks a file piece by piece and holds one record at a time besides the packed bytes.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.frames import pieces

FILE_BYTES = 64 << 20  # bytes of records, before compression, after which a file ends
_PIECE = 1 << 20  # bytes unpacked at a time
_END = b"\r\n\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"
# fixed values of the WARC/1.1 format
_VERSION = b"WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def plan(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(_page, _sha1, _bytes, record_type, refers_to) for (_page, _html) rows.

    Equal payloads are equal SHA-1 and length. An aggregate finds the smallest page
    of each; the join back splits a hot payload at run time.
    """
    heads = pages.select("_page", "_sha1", "_bytes").distinct()
    firsts = (heads.filter(F.col("_bytes") >= min_bytes)
              .groupBy(F.col("_sha1").alias("_d"), F.col("_bytes").alias("_n"))
              .agg(F.min("_page").alias("_first")))
    revisit = F.col("_first").isNotNull() & ~F.col("_first").eqNullSafe(F.col("_page"))
    return (heads.join(firsts, (F.col("_sha1") == F.col("_d")) & (F.col("_bytes") == F.col("_n")),
                       "left")
            .select("_page", "_sha1",
                    F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                    F.when(revisit, F.col("_first")).alias("refers_to")))


def _header(fields: dict[str, str | None], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in fields.items() if v is not None]
    head = _VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n"
    return head + b"Content-Length: %d" % len(block) + _END + block


def _uri(page) -> str:
    return f"<urn:x-page:{'' if page is None else page}>"


def record(page, url: str | None, payload: bytes, kind: str, refers_to, date: str) -> bytes:
    """One record without its closing CRLF CRLF. Line ends in a URL are escaped."""
    url = url and url.replace("\r", "%0D").replace("\n", "%0A")
    fields = {"WARC-Type": kind, "WARC-Record-ID": _uri(page), "WARC-Date": date,
              "WARC-Target-URI": url, "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}",
              "Content-Type": "application/http; msgtype=response"}
    if kind == "revisit":
        fields |= {"WARC-Profile": _PROFILE, "WARC-Refers-To": _uri(refers_to)}
        return _header(fields, _HTTP + _END)
    return _header(fields, _HTTP + _END + payload)


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url",
                   html: str = "html", min_bytes: int = 0,
                   date: str = "2024-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> None:
    """Write one record per row: the smallest page of a payload in full, others as revisits.

    A null html is an empty payload. Payloads under ``min_bytes`` are never revisits.
    A row without id can be a revisit, but is no target unless it is the only one.
    Repeated rows of a page give the same record again. Other columns are ignored.
    """
    rows = pages.select(
        F.col(page_id).cast("bigint").alias("_page"), F.col(url).cast("string").alias("_url"),
        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("_html"))
    rows = rows.withColumns({"_sha1": F.sha1("_html"), "_bytes": F.length("_html")})
    decided = plan(rows, min_bytes).withColumnsRenamed({"_page": "_p", "_sha1": "_s"})
    ready = (rows.join(decided, F.col("_page").eqNullSafe(F.col("_p"))
                       & (F.col("_sha1") == F.col("_s")))
             .select("_page", "_url", "record_type", "refers_to", "_html"))

    info = _header({"WARC-Type": "warcinfo", "WARC-Record-ID": "<urn:x-page:info>",
                    "WARC-Date": date, "Content-Type": "application/warc-fields"},
                   b"format: WARC File Format 1.1\r\n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, size, place = -1, file_bytes, 0
        for batch in pieces(batches):
            rows: list[tuple[bytes, int, int]] = []
            for p, u, k, r, h in zip(*[c.to_pylist() for c in batch.columns[:4]],
                                     batch.column(4)):
                if size >= file_bytes:
                    roll, size = roll + 1, 0
                    rows.append((info, roll, -1))
                made = record(p, u, h.as_py(), k, r, date)
                rows.append((made, roll, place))
                size, place = size + len(made), place + 1
            columns = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.binary(), pa.int32(), pa.int64()))],
                ["record", "roll", "place"])

    (ready.mapInArrow(run, "record binary, roll int, place bigint")
     .sortWithinPartitions("roll", "place")
     .select(F.col("record").cast("string").alias("value"), "roll")
     .write.partitionBy("roll").option("lineSep", _END.decode()).option("compression", "gzip")
     .text(path))


def unpacked_pieces(data: bytes) -> Iterator[bytes]:
    """The content of a gzip file of any number of members, ``_PIECE`` bytes at a time."""
    while data:
        member = zlib.decompressobj(31)
        while not member.eof:
            out = member.decompress(data, _PIECE)
            data = member.unconsumed_tail
            if not out and not data and not member.eof:
                raise ValueError("the archive file is cut off")
            yield out
        data = member.unused_data


def parse_archive(parts: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record, by the lengths the headers give."""
    held, source, at = bytearray(), iter(parts), 0

    def more() -> bool:
        part = next(source, None)
        held.extend(part or b"")
        return part is not None

    while held or more():
        seen = 0
        while (end := held.find(_END, seen)) < 0:
            seen = max(0, len(held) - len(_END))
            if not more():
                if held:
                    raise ValueError(f"no record at byte {at}")
                return
        first, *lines = held[:end].decode().split("\r\n")
        if first.encode() != _VERSION:
            raise ValueError(f"no record at byte {at}")
        fields = dict(x.split(": ", 1) for x in lines)
        start = end + len(_END)
        stop = start + int(fields["Content-Length"])
        while len(held) < stop + len(_END) and more():
            pass
        if held[stop:stop + len(_END)] != _END:
            raise ValueError(f"record at byte {at} does not end where it says")
        yield fields, bytes(held[start:stop])
        del held[:stop + len(_END)]
        at += stop + len(_END)


def read_archives(spark, path: str) -> DataFrame:
    """(page_id, url, record_type, payload_digest, refers_to, payload) of every record.

    A payload that does not have its digest stops the job. Revisits have no payload.
    """
    names = ["page_id", "url", "record_type", "payload_digest", "refers_to", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for head, block in parse_archive(unpacked_pieces(content.as_py())):
                    found = _fields(head, block)
                    if found:
                        rows.append(found)
                        size += len(block)
                    if size > 4 * _PIECE:
                        yield batch_of(rows)
                        rows, size = [], 0
                yield batch_of(rows)

    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.gz").load(path).select("content"))
    return files.mapInArrow(run, "page_id bigint, url string, record_type string, "
                                 "payload_digest string, refers_to bigint, payload binary")


def _fields(head: dict[str, str], block: bytes) -> tuple | None:
    kind = head["WARC-Type"]
    if kind == "warcinfo":
        return None
    number = lambda uri: int(uri[12:-1]) if uri and uri[12:-1] else None
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = None
    if kind == "response":
        payload = block[block.index(_END) + len(_END):]
        if base32_sha1(payload) != digest:
            raise ValueError(f"payload of {head['WARC-Record-ID']} is damaged")
    return (number(head["WARC-Record-ID"]), head.get("WARC-Target-URI"), kind, digest,
            number(head.get("WARC-Refers-To")), payload)


def resolve(records: DataFrame) -> DataFrame:
    """Digest rows of all records; a revisit takes its length from the original it names."""
    heads = records.select("page_id", F.length("payload").cast("bigint").alias("_own"),
                           "payload_digest", "record_type", "refers_to")
    originals = (heads.filter("record_type = 'response'")
                 .select(F.col("page_id").alias("_o"), F.col("payload_digest").alias("_d"),
                         F.col("_own").alias("_n")).distinct())
    return (heads.join(originals, (F.col("refers_to") == F.col("_o"))
                       & (F.col("payload_digest") == F.col("_d")), "left")
            .select("page_id", F.coalesce("_own", "_n").alias("payload_bytes"),
                    "payload_digest", "record_type", "refers_to"))
