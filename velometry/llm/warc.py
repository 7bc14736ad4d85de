"""WARC archives in Zstandard: a dictionary in front, one frame for each record.

An archive is a binary value, so that Spark itself writes and reads it wherever
its tables are; ``read_archives`` also takes what the ``binaryFile`` source yields
for ``*.warc.zst`` files.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velometry.llm.common import null_safe_join, text_or_empty

# Fixed values of the formats.
DICT_FRAME = 0x184D2A5D
ZSTD_FRAME = 0xFD2FB528
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

ARCHIVES = "archive string, content binary"
RECORDS = (
    "archive string, page_id bigint, url string, record_type string, payload_bytes bigint, "
    "payload_digest string, refers_to bigint, payload binary, problem string"
)
_ID = "urn:page:"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def mark_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, digest, refers_to``: what each record will be.

    Of equal payloads of at least ``least_bytes`` the largest page_id is the response
    (all rows that have it, if it is repeated), and the others refer to it.  A null
    page_id is smaller than any; if all are null, all are responses.
    """
    payload = F.encode(text_or_empty("html"), "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("digest"),
    )
    counted = rows.filter(F.octet_length("payload") >= least_bytes)
    last = (
        counted.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("last"))
        .filter("n > 1")
        .select("digest", "last")
    )
    # The payload goes to its archive with the rest, so this join is its only shuffle.
    marked = null_safe_join(rows, last, ["digest"])
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    return marked.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def _record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + payload if refers_to is None else http
    sha = base64.b32encode(bytes.fromhex(digest)).decode()
    head = [
        VERSION,
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_ID}{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{sha}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.insert(3, "WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~-._"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{_ID}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _dictionary(records: list[bytes], size: int) -> zstandard.ZstdCompressionDict:
    """A dictionary from the records' beginnings, where pages are alike."""
    samples = [r[: 4 * 1024] for r in records[:400]]
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8)
    except zstandard.ZstdError:  # too few or too short records to train on
        raw = b"".join(samples)[:size]
        return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def build_archive(records: list[bytes], dictionary_bytes: int = 32 * 1024) -> bytes:
    """Records as frames behind a skippable frame with their (compressed) dictionary."""
    dictionary = _dictionary(records, dictionary_bytes)
    stored = zstandard.ZstdCompressor().compress(dictionary.as_bytes())
    packer = zstandard.ZstdCompressor(dict_data=dictionary, write_checksum=True)
    frames = [struct.pack("<II", DICT_FRAME, len(stored)), stored]
    return b"".join(frames + [packer.compress(r) for r in records])


def write_archives(
    marked: DataFrame,
    archive_bytes: int = 4 << 20,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """``archive, content``: each task packs its rows into archives.

    An archive is closed when its records reach ``archive_bytes``, so a task holds one
    archive at a time; a longer record gets one of its own.  Its name is its digest.
    """

    def pack(records: list[bytes]) -> pa.RecordBatch:
        content = build_archive(records)
        name = hashlib.sha1(content).hexdigest() + ".warc.zst"
        arrays = [pa.array([name], pa.string()), pa.array([content], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, ["archive", "content"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, size = [], 0
        for batch in batches:
            for row in range(batch.num_rows):
                values = [batch.column(i)[row].as_py() for i in range(5)]
                records.append(_record(*values, date))
                size += len(records[-1])
                if size >= archive_bytes:
                    yield pack(records)
                    records, size = [], 0
        if records:
            yield pack(records)

    return marked.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(
        write, ARCHIVES
    )


def store_archives(archives: DataFrame, path: str) -> DataFrame:
    """Write archives as a table, in small row groups that a reader can hold, and reopen it."""
    (
        archives.write.mode("errorifexists")
        .option("compression", "uncompressed")
        .option("parquet.enable.dictionary", "false")
        .option("parquet.block.size", str(16 << 20))
        .option("parquet.block.size.row.check.min", "1")
        .option("parquet.block.size.row.check.max", "4")
        .parquet(path)
    )
    return archives.sparkSession.read.schema(ARCHIVES).parquet(path)


class WarcError(ValueError):
    pass


def frames(content: bytes) -> Iterator[bytes]:
    """The records of an archive; raises on a damaged or truncated one."""
    dictionary, view = None, memoryview(content)
    at = 0
    if len(view) >= 8 and struct.unpack_from("<I", view)[0] == DICT_FRAME:
        size = struct.unpack_from("<I", view, 4)[0]
        raw = bytes(view[8 : 8 + size])
        if len(raw) < size:
            raise WarcError("truncated dictionary")
        if raw[:4] == struct.pack("<I", ZSTD_FRAME):
            raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
        dictionary = zstandard.ZstdCompressionDict(raw)
        at = 8 + size
    unpacker = zstandard.ZstdDecompressor(dict_data=dictionary)
    while at < len(view):
        frame, parts, step = unpacker.decompressobj(), [], 1 << 14
        while not frame.eof:
            if at >= len(view):
                raise WarcError("truncated frame")
            chunk = view[at : at + step]
            try:
                parts.append(frame.decompress(chunk))
            except zstandard.ZstdError as error:
                raise WarcError(f"damaged frame: {error}") from None
            at += len(chunk) - len(frame.unused_data)
            step = min(step * 2, 1 << 20)
        yield b"".join(parts)


def parse_record(record: bytes) -> dict:
    """Headers, payload and the digest; raises ``WarcError`` on what does not fit."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not gap or lines[0] != VERSION:
        raise WarcError("no WARC header")
    fields = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
    absent = [x for x in REQUIRED if x not in fields]
    if absent or len(fields) != len(lines) - 1:
        raise WarcError(f"missing or malformed headers: {', '.join(absent)}")
    if not fields["Content-Length"].isdigit():
        raise WarcError("unreadable Content-Length")
    length = int(fields["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise WarcError("Content-Length does not fit the record")
    http, gap, payload = rest[:length].partition(b"\r\n\r\n")
    http_fields = dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:] if b": " in x)
    size = http_fields.get(b"Content-Length", b"")
    if not gap or not size.isdigit():
        raise WarcError("no HTTP header with a length")
    kind = fields["WARC-Type"]
    if kind not in ("response", "revisit"):
        raise WarcError(f"unknown type {kind}")
    digest = fields.get("WARC-Payload-Digest", "").removeprefix("sha1:")
    if kind == "response" and (len(payload) != int(size) or payload_digest(payload) != digest):
        raise WarcError("payload does not fit its length and digest")
    if kind == "revisit" and (payload or "WARC-Refers-To" not in fields):
        raise WarcError("a revisit has a payload or refers to nothing")

    def number(field: str) -> int | None:
        value = fields.get(field, "").removeprefix(f"<{_ID}").removesuffix(">")
        return int(value) if value.lstrip("-").isdigit() else None

    return {
        "page_id": number("WARC-Record-ID"),
        "url": fields.get("WARC-Target-URI"),
        "record_type": kind,
        "payload_bytes": int(size),
        "payload_digest": digest,
        "refers_to": number("WARC-Refers-To"),
        "payload": payload if kind == "response" else None,
        "problem": None,
    }


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record of ``archive, content`` rows.

    Headers, lengths and digests are validated.  A record that fails gives a row with
    ``problem`` and nulls; a damaged frame gives one such row and ends its archive.
    A null archive gives one as well.  ``payloads=False`` leaves the payload out.
    """
    names = [f.split()[0] for f in RECORDS.split(", ")]
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in RECORDS.split(", ")])

    def rows(name: str, content: bytes | None) -> Iterator[dict]:
        try:
            if content is None:
                raise WarcError("no content")
            for record in frames(content):
                try:
                    row = parse_record(record)
                except WarcError as error:
                    row = {"problem": str(error)}
                if not payloads:
                    row["payload"] = None
                yield row | {"archive": name}
        except WarcError as error:
            yield {"archive": name, "problem": str(error)}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found, size = [], 0
                for row in rows(batch.column(0)[i].as_py(), batch.column(1)[i].as_py()):
                    found.append({n: row.get(n) for n in names})
                    size += len(row.get("payload") or b"")
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(found, schema)
                        found, size = [], 0
                yield pa.RecordBatch.from_pylist(found, schema)

    return archives.select("archive", "content").mapInArrow(read, RECORDS)
