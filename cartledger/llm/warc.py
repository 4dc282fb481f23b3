"""WARC archives in Zstandard with a dictionary, and a reader that checks what it reads.

An archive starts with a skippable frame (magic 0x184D2A5D) whose content is the dictionary, followed
by one frame for each record, as the public WARC-Zstandard convention has it. A revisit record has
the headers of its payload but no body; its response holds the bytes. Writers put archives into the
shared folder through its own file system; a manifest table, written after the archives, says which
of them count, so a repeated task leaves at most an unlisted file.

Reading takes archives of other writers too: WARC/1.0 and 1.1, records of every type, header lines that
are folded or repeated, ids of any form, dictionaries plain or compressed or none at all, skippable
frames between records. The four headers that the format demands must be there and well formed, the
length must be that of the block, and each digest of an algorithm known here must fit; a digest that
is not given is not asked for. What does not fit raises BadArchive.

Nulls: a null payload is empty, a null URL leaves its header out, a null page_id is written as such
and sorts after all others. Repeated rows make a record each; of equal payloads those rows that have
the smallest page_id are responses. A payload of any length is one record, held whole by its task.
Empty tables make no archive. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import struct
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartledger.session import cut_lineage, work_dir

#: Fixed values of the format.
DICTIONARY_MAGIC, FRAME_MAGIC, SKIPPABLE = 0x184D2A5D, 0xFD2FB528, range(0x184D2A50, 0x184D2A60)
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
RECORD_TYPES = ("response", "revisit")
DIGESTS = ("md5", "sha1", "sha256", "sha512")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payloads from this size on are stored once.
MIN_REVISIT_BYTES = 0
#: An archive is closed at the first record that ends beyond this.
ARCHIVE_BYTES = 8 << 20
#: A dictionary of so many bytes is trained on an archive's first records, up to so many bytes of them.
DICTIONARY_BYTES, SAMPLE_BYTES = 16 << 10, 1 << 20
LEVEL = 3

#: What :func:`read_archives` tells of a record; page ids are null for records of other writers.
RECORD = (
    "record_id string, page_id long, record_type string, date string, url string, content_type string,"
    " body_bytes long, payload_digest string, refers_to_id string, refers_to long"
)


class BadArchive(ValueError):
    """An archive that does not hold what its headers say."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(name: str | None) -> int | None:
    """The page that a record id of this writer names; null for any other id."""
    m = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(m[1]) if m else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool, date: str | None = None) -> bytes:
    """One record: headers, body, and the two line ends that close it; ``date`` is the time of writing unless given."""
    body = b"" if is_revisit else payload
    lines = [
        ("WARC-Type", RECORD_TYPES[is_revisit]),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("Content-Type", "text/html"),
        ("Content-Length", str(len(body))),
    ]
    if url is not None:
        lines.append(("WARC-Target-URI", re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if is_revisit:
        lines += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    head = "".join(f"{name}: {value}\r\n" for name, value in lines).encode()
    return VERSIONS[1] + b"\r\n" + head + b"\r\n" + body + b"\r\n\r\n"


class Headers(dict[str, list[str]]):
    """All values by lower-case name, in their order; ``first`` gives one."""

    def first(self, name: str) -> str | None:
        return self[name][0] if name in self else None


def _headers(lines: bytes) -> Headers:
    headers, last = Headers(), None
    for line in lines.split(b"\r\n"):
        if line[:1] in (b" ", b"\t") and last:  # a folded line goes on with the value before it
            last[-1] = f"{last[-1]} {line.strip().decode('utf-8', 'replace')}".strip()
            continue
        name, colon, value = line.partition(b":")
        if not colon or not re.fullmatch(rb"[!#$%&'*+\-.^_`|~0-9A-Za-z]+", name):
            raise BadArchive(f"header line {line[:80]!r}")
        last = headers.setdefault(name.lower().decode(), [])
        last.append(value.strip().decode("utf-8", "replace"))
    return headers


def _fits(labelled: str, *contents: bytes) -> bool:
    """Whether a digest, in base32 or hexadecimal, is that of one of ``contents``; one of an unknown algorithm fits."""
    name, _, value = labelled.partition(":")
    name = name.lower().replace("-", "")
    if name not in DIGESTS:
        return True
    for content in contents:
        found = hashlib.new(name, content, usedforsecurity=False)
        if value.lower() == found.hexdigest() or value.upper().rstrip("=") == base64.b32encode(found.digest()).decode().rstrip("="):
            return True
    return False


def _payloads(headers: Headers, block: bytes) -> list[bytes]:
    """The block's payload, and what else writers take for it: an HTTP message's body as sent and without its chunks."""
    if not (headers.first("content-type") or "").lower().startswith("application/http"):
        return [block]
    head, _, body = block.partition(b"\r\n\r\n")
    found = [body]
    if re.search(rb"(?im)^transfer-encoding:[^\r\n]*chunked", head):
        parts, at = [], 0
        while m := re.compile(rb"([0-9A-Fa-f]+)[^\r\n]*\r\n").match(body, at):
            size = int(m[1], 16)
            parts.append(body[m.end() : m.end() + size])
            at = m.end() + size + 2
            if not size:
                break
        found.append(b"".join(parts))
    return found


def parse(raw: bytes) -> tuple[Headers, bytes]:
    """Headers and block of one record; BadArchive if anything does not fit."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not found or version not in VERSIONS:
        raise BadArchive(f"record begins with {raw[:20]!r}")
    headers = _headers(lines)
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if len(headers.get(name, ())) != 1:
            raise BadArchive(f"not one {name}")
    length, kind = headers.first("content-length"), headers.first("warc-type")
    if not re.fullmatch("[0-9]+", length):
        raise BadArchive(f"length {length!r}")
    if not re.fullmatch("[a-z]+", kind):
        raise BadArchive(f"type {kind!r}")
    if not re.fullmatch(r"<?[A-Za-z][A-Za-z0-9+.\-]*:[^\s<>]*>?", headers.first("warc-record-id")):
        raise BadArchive(f"record id {headers.first('warc-record-id')!r}")
    if not re.fullmatch(r"\d{4}(-\d\d(-\d\d(T\d\d:\d\d(:\d\d(\.\d{1,9})?)?Z)?)?)?", headers.first("warc-date")):
        raise BadArchive(f"date {headers.first('warc-date')!r}")
    size = int(length)
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise BadArchive(f"length {size}, but {len(rest) - 4} bytes follow")
    block = rest[:size]
    if not all(_fits(d, block) for d in headers.get("warc-block-digest", ())):
        raise BadArchive("the block does not have the digest of its header")
    # a revisit's payload is elsewhere, and a segment holds a part of one only
    if kind == "revisit":
        if "warc-profile" not in headers:
            raise BadArchive("a revisit names no profile")
    elif "warc-segment-number" not in headers and (told := headers.get("warc-payload-digest")):
        payloads = _payloads(headers, block)
        if not all(_fits(d, *payloads) for d in told):
            raise BadArchive("the payload does not have the digest of its header")
    return headers, block


def _exactly(file: BinaryIO, n: int) -> bytes:
    out = file.read(n)
    if len(out) != n:
        raise BadArchive("the archive ends inside a frame")
    return out


def read_archive(file: BinaryIO, chunk: int = 1 << 16) -> Iterator[tuple[Headers, bytes]]:
    """Records of one archive, streamed: memory holds one record."""
    decode, rest, at_start = zstandard.ZstdDecompressor(), b"", True
    while rest or (rest := file.read(chunk)):
        while len(rest) < 8 and (more := file.read(chunk)):
            rest += more
        magic = struct.unpack("<I", rest[:4])[0] if len(rest) >= 4 else None
        if magic in SKIPPABLE and len(rest) >= 8:
            size = struct.unpack("<I", rest[4:8])[0]
            content = rest[8 : 8 + size] + _exactly(file, max(0, size - len(rest) + 8))
            rest = rest[8 + size :]
            if at_start and magic == DICTIONARY_MAGIC:
                if content[:4] == struct.pack("<I", FRAME_MAGIC):  # the dictionary may be compressed itself
                    content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
                decode = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
            at_start = False
            continue
        if magic != FRAME_MAGIC:
            raise BadArchive("no Zstandard frame where a record should begin")
        at_start, frame, parts = False, decode.decompressobj(), []
        while True:
            try:
                parts.append(frame.decompress(rest))
            except zstandard.ZstdError as e:
                raise BadArchive(f"a frame cannot be decoded: {e}") from e
            if frame.eof:
                rest = frame.unused_data
                break
            if not (rest := file.read(chunk)):
                raise BadArchive("the archive ends inside a record")
        yield parse(b"".join(parts))


def trained(records: list[bytes]) -> bytes:
    """A dictionary from an archive's first records: trained where they are enough for it, else their own beginning."""
    samples = [r[: 8 * DICTIONARY_BYTES] for r in dict.fromkeys(records)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=512, d=8).as_bytes()
    except zstandard.ZstdError:  # too few or too small
        return b"".join(samples)[:DICTIONARY_BYTES]


class Archive:
    """Writes one archive behind its dictionary."""

    def __init__(self, sink: BinaryIO, dictionary: bytes):
        # 8 bytes at least, the least content that a raw dictionary may have
        words = dictionary if len(dictionary) >= 8 else (VERSIONS[1] + b"\r\nWARC-Type: response\r\n")
        self.sink, self.size, self.records = sink, 0, 0
        self._put(struct.pack("<II", DICTIONARY_MAGIC, len(words)) + words)
        made = zstandard.ZstdCompressionDict(words)
        self.encode = zstandard.ZstdCompressor(level=LEVEL, dict_data=made, write_checksum=True)

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.size += len(data)

    def add(self, raw: bytes) -> None:
        self._put(self.encode.compress(raw))
        self.records += 1


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Archives of ``pages`` (page_id, url, payload, refers_to, is_revisit) in ``folder``.

    Returns (archive, records) of the archives that count, written as a table first.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, path = _opened(folder)
        at.create_dir(path, recursive=True)
        archive, name, done, first, held = None, "", [], [], 0

        def begin() -> Archive:
            made = Archive(at.open_output_stream(f"{path}/{name}"), trained(first))
            for raw in first:
                made.add(raw)
            return made

        for batch in batches:
            for row in batch.to_pylist():
                raw = record(row["page_id"], row["url"], row["payload"], row["refers_to"], row["is_revisit"])
                if archive is None:  # the first records wait for their dictionary
                    first.append(raw)
                    held += len(raw)
                    if held < SAMPLE_BYTES:
                        continue
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    archive, first, held = begin(), [], 0
                else:
                    archive.add(raw)
                if archive.size > ARCHIVE_BYTES:
                    archive.sink.close()
                    done.append((name, archive.records))
                    archive = None
        if first:
            name = f"{uuid.uuid4().hex}.warc.zst"
            archive = begin()
        if archive is not None:
            archive.sink.close()
            done.append((name, archive.records))
        yield pa.RecordBatch.from_pylist(
            [{"archive": n, "records": r} for n, r in done],
            pa.schema([("archive", pa.string()), ("records", pa.int64())]),
        )

    columns = pages.select("page_id", "url", "payload", "refers_to", "is_revisit")
    return cut_lineage(columns.mapInArrow(write, "archive string, records long"))


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """One row for each record of the listed archives (archive, records; null records: not counted).

    What does not fit raises BadArchive.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, path = _opened(folder)
        schema = pa.schema([(n, pa.int64() if t == "long" else pa.string()) for n, t in (c.split() for c in RECORD.split(","))])
        for batch in batches:
            for listed in batch.to_pylist():
                rows = []
                with at.open_input_stream(f"{path}/{listed['archive']}") as file:
                    for head, body in read_archive(file):
                        told, refers = head.first("warc-payload-digest"), head.first("warc-refers-to")
                        rows.append({
                            "record_id": head.first("warc-record-id"), "page_id": page_of(head.first("warc-record-id")),
                            "record_type": head.first("warc-type"), "date": head.first("warc-date"), "url": head.first("warc-target-uri"),
                            "content_type": head.first("content-type"), "body_bytes": len(body),
                            "payload_digest": told.removeprefix("sha1:") if told else None,
                            "refers_to_id": refers, "refers_to": page_of(refers),
                        })
                if listed["records"] is not None and len(rows) != listed["records"]:
                    raise BadArchive(f"{listed['archive']} has {len(rows)} records of {listed['records']}")
                yield pa.RecordBatch.from_pylist(rows, schema)

    spark = manifest.sparkSession
    tasks = spark.sparkContext.defaultParallelism
    return manifest.repartition(max(tasks, 12), "archive").mapInArrow(read, RECORD)


def with_roles(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, and whether and what the page revisits."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("sha1"))
    firsts = rows.where(F.octet_length("payload") >= min_bytes).groupBy("sha1")
    firsts = cut_lineage(firsts.agg(F.min("page_id").alias("first")).withColumnRenamed("sha1", "same"))
    is_revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(firsts, F.col("sha1") == F.col("same"), "left").select(
        "page_id", "url", "payload", F.when(is_revisit, F.col("first")).alias("refers_to"), is_revisit.alias("is_revisit")
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes a record for each page, reads all archives back, and says what was found for each.

    A revisit's size is that of the response it refers to, which must have its digest.
    """
    folder = os.path.join(work_dir(pages.sparkSession), f"warc-{uuid.uuid4().hex}")
    found = read_archives(write_archives(with_roles(pages), folder), folder)
    found = cut_lineage(found)
    sizes = cut_lineage(
        found.where("record_type = 'response'").groupBy(F.col("payload_digest").alias("of"))
        .agg(F.first("body_bytes").alias("full_bytes"), F.min("page_id").alias("stored_as"))
    )
    fits = F.col("record_type").eqNullSafe("response") | F.col("refers_to").eqNullSafe(F.col("stored_as"))
    size = F.when(fits, F.coalesce("full_bytes", "body_bytes")).otherwise(
        F.raise_error("a revisit refers to no response with its digest").cast("long")
    )
    return found.join(sizes, F.col("payload_digest") == F.col("of"), "left").select(
        "page_id", size.alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )
