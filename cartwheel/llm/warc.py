"""WARC archives compressed with Zstandard: one frame per record, dictionary in the leading skippable frame.

Writing.  Every Spark partition becomes one ``.warc.zst`` file.  The task trains a dictionary on the first
``sample_bytes`` of its payloads, puts it into a skippable frame (magic 0x184D2A5D) and compresses every
record as a frame of its own.  Spark's text sink writes the frames, with an *empty skippable frame* as line
separator, so archives go to any file system Spark knows and a lost or repeated task leaves no half file.

Reading.  Spark's ``binaryFile`` source brings the archives; a task walks the frames of a file by their block
headers, loads the dictionary from the leading frame, decodes one frame at a time and validates it: version
line, mandatory headers, ``Content-Length`` against the block, closing CRLF CRLF, block digest, and for
responses the payload's digest and the HTTP length.  What is wrong stands in ``error`` (null: sound).

Defined results: a null payload counts as empty; a null page id is kept and written with an empty id (it never
counts as the smallest unless its group has no other); rows that repeat the smallest page id of a payload are all responses; a
null URL is left out; an empty table gives no archive and no rows; further input columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the format.
FRAME_MAGIC = 0xFD2FB528
SKIP_LOW, SKIP_HIGH = 0x184D2A50, 0x184D2A5F
DICT_MAGIC = 0x184D2A5D
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"  # skippable frame 0x184D2A50 of length 0
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANDATORY = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
ID_PREFIX = "urn:cartwheel:page:"


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---------------------------------------------------------------- records

def _headers(pairs: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in pairs) + "\r\n").encode()


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One uncompressed record; ``refers_to`` makes it a revisit, whose block is the HTTP head alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    pairs = [("WARC-Type", "response" if refers_to is None else "revisit"),
             ("WARC-Record-ID", f"<{ID_PREFIX}{'' if page_id is None else page_id}>"),
             ("WARC-Date", date)]
    if url is not None:
        pairs.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%~-._")))
    if refers_to is not None:
        pairs += [("WARC-Refers-To", f"<{ID_PREFIX}{refers_to}>"), ("WARC-Profile", PROFILE)]
    pairs += [("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", "sha1:" + digest32(payload)),
              ("WARC-Block-Digest", "sha1:" + digest32(block)), ("Content-Length", str(len(block)))]
    return _headers(pairs) + block + b"\r\n\r\n"


def _page(value: str | None) -> int | None:
    value = (value or "").strip("<>")
    return int(value[len(ID_PREFIX):]) if value.startswith(ID_PREFIX) and value[len(ID_PREFIX):] else None


def parse_record(data: bytes) -> dict:
    """Fields of one record; ``error`` names the first fault found."""
    out = dict.fromkeys(("page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload", "error"))
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not gap or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        return out | {"error": "version line"}
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            return out | {"error": "header line"}
        fields[name.strip().lower()] = value.strip()
    out["record_type"] = fields.get("warc-type")
    for name in MANDATORY:
        if name.lower() not in fields:
            return out | {"error": f"no {name}"}
    out["page_id"], out["refers_to"] = _page(fields["warc-record-id"]), _page(fields.get("warc-refers-to"))
    out["url"] = fields.get("warc-target-uri")
    if not fields["content-length"].isdigit():
        return out | {"error": "Content-Length"}
    length = int(fields["content-length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != b"\r\n\r\n":
        return out | {"error": "block length"}
    if fields.get("warc-block-digest", "sha1:" + digest32(block)) != "sha1:" + digest32(block):
        return out | {"error": "block digest"}
    http, gap, payload = block.partition(b"\r\n\r\n")
    said = [x.split(b":", 1)[1].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    if not gap or not said or not said[0].isdigit():
        return out | {"error": "HTTP head"}
    out["payload_bytes"] = int(said[0])
    out["payload_digest"] = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if out["record_type"] == "response":
        if len(payload) != out["payload_bytes"]:
            return out | {"error": "payload length"}
        if digest32(payload) != out["payload_digest"]:
            return out | {"error": "payload digest"}
        out["payload"] = payload
    elif out["record_type"] != "revisit" or (out["refers_to"] is None):
        return out | {"error": "record type"}
    return out


# ---------------------------------------------------------------- frames

def frames(data: memoryview) -> Iterator[tuple[int, int, int]]:
    """(magic, start of content, end) of every frame; a skippable frame's content excludes its 8 bytes of head."""
    import zstandard

    at = 0
    while at < len(data):
        if len(data) - at < 8:
            raise ValueError("truncated frame")
        magic, size = struct.unpack_from("<II", data, at)
        if SKIP_LOW <= magic <= SKIP_HIGH:
            end = at + 8 + size
            if end > len(data):
                raise ValueError("truncated skippable frame")
            yield magic, at + 8, end
        elif magic == FRAME_MAGIC:
            info = zstandard.get_frame_parameters(bytes(data[at:at + 18]))
            end = at + zstandard.frame_header_size(bytes(data[at:at + 18]))
            last = False
            while not last:
                if end + 3 > len(data):
                    raise ValueError("truncated block")
                word = int.from_bytes(data[end:end + 3], "little")
                last, kind, size = bool(word & 1), (word >> 1) & 3, word >> 3
                end += 3 + (1 if kind == 1 else size)
            end += 4 * info.has_checksum
            if end > len(data):
                raise ValueError("truncated frame")
            yield magic, at, end
        else:
            raise ValueError("unknown frame")
        at = end


def read_archive(data: memoryview) -> Iterator[dict]:
    """The records of one archive.  A broken frame structure ends it with one row that has only ``error``."""
    import zstandard

    reader = zstandard.ZstdDecompressor()
    try:
        for k, (magic, start, end) in enumerate(frames(data)):
            if magic == DICT_MAGIC and k == 0:
                body = bytes(data[start:end])
                if body[:4] == struct.pack("<I", FRAME_MAGIC):  # the dictionary may itself be compressed
                    body = zstandard.ZstdDecompressor().decompress(body)
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
            elif magic == FRAME_MAGIC:
                yield parse_record(reader.decompressobj().decompress(data[start:end]))
    except (ValueError, zstandard.ZstdError) as e:
        yield dict.fromkeys(("page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload")) | {"error": f"archive: {e}"}


# ---------------------------------------------------------------- Spark

def mark_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to): of equal payloads the smallest page id stays a response.

    Payloads are compared by SHA-1 and length.  Only groups of two or more take part in the join; they are
    counted with partial aggregation, so a payload that a third of the pages share costs a row per task.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"))
    key: list[Column] = [F.sha1("payload").alias("_sha1"), F.octet_length("payload").alias("_bytes")]
    groups = (rows.select("page_id", *key).where(F.col("_bytes") >= min_bytes)
              .groupBy("_sha1", "_bytes").agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
              .where("_n > 1").drop("_n"))
    linked = rows.select("*", *key).join(groups, ["_sha1", "_bytes"], "left")
    refers = F.when(F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))
    return linked.select("page_id", "url", "payload", refers.alias("refers_to"))


def write_archives(records: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", level: int = 3,
                   sample_bytes: int = 1 << 19, dict_bytes: int = 1 << 14) -> None:
    """Write (page_id, url, payload, refers_to) as archives below ``path``, one per partition."""

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        packer, waiting, waiting_bytes = None, [], 0

        def start() -> list[bytes]:
            nonlocal packer
            head = []
            try:
                trained = zstandard.train_dictionary(dict_bytes, [r[:8192] for r in waiting])
                body = trained.as_bytes()
                head = [struct.pack("<II", DICT_MAGIC, len(body)) + body]
                packer = zstandard.ZstdCompressor(level=level, dict_data=trained, write_checksum=True)
            except (zstandard.ZstdError, ValueError):  # too few samples: an archive without dictionary
                packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
            return head + [packer.compress(r) for r in waiting]

        def out(values: list[bytes]) -> pa.RecordBatch:
            return pa.record_batch([pa.array(values, pa.binary())], ["value"])

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                records = [build_record(*row, date) for row in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to")), strict=True)]
                if packer is None:
                    waiting += records
                    waiting_bytes += sum(map(len, records))
                    if waiting_bytes < sample_bytes:
                        continue
                    yield out(start())
                    waiting = []
                elif records:
                    yield out([packer.compress(r) for r in records])
        if packer is None and waiting:
            yield out(start())

    packed = records.select("page_id", "url", "payload", "refers_to").mapInArrow(compress, "value binary")
    (packed.select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", EMPTY_FRAME).option("compression", "none").mode("overwrite").text(path))


RECORD = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, error string"


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Records of all archives below ``path`` (see RECORD; ``payload`` on demand)."""
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "error"] + ["payload"] * with_payload
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}
    schema = RECORD + ", payload binary" * with_payload

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[dict]) -> pa.RecordBatch:
            return pa.record_batch([pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names)

        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for record in read_archive(memoryview(content.as_buffer())):
                    rows.append(record)
                    size += len(record["payload"] or b"")
                    if len(rows) >= 2048 or size > 8 << 20:
                        yield out(rows)
                        rows, size = [], 0
                if rows:
                    yield out(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(decode, schema)
