"""Zstandard web archives: written record by record with a shared dictionary, and read back frame by frame."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from uuid import uuid4

import pandas as pd
import zstandard
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressgrid.sources.staging import shared_folder

#: Fixed values of the archive format.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

DICTIONARY_BYTES = 32 << 10
#: Payload bytes of the first records that an archive's dictionary is made from.
SAMPLE_BYTES = 2 << 20
LEVEL = 3
CHUNK = 1 << 20

RECORD = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long,"
    " payload binary, problem string"
)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def plan_revisits(pages: DataFrame, threshold: int = 0) -> DataFrame:
    """``page_id``, ``digest``, ``refers_to``: pages that repeat the payload of the page with the largest id.

    One row per (page_id, digest). Payloads are compared by SHA-256 and length and never moved; a hot payload is
    reduced to one row a task before the shuffle.
    """
    keys = pages.select("page_id", F.sha2("payload", 256).alias("digest"), F.length("payload").alias("size")).distinct()
    lead = keys.filter(F.col("size") >= threshold).groupBy("digest").agg(F.max("page_id").alias("lead_id"))
    return keys.join(lead, "digest", "left").select(
        "page_id", "digest", F.when(F.col("lead_id").eqNullSafe(F.col("page_id")), None).otherwise(F.col("lead_id"))
        .alias("refers_to"),
    )


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record with its headers. A revisit carries the headers of its payload and no payload."""
    block = HTTP if refers_to is not None else HTTP + payload
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Target-URI", (url or "").replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Date", "2024-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        headers += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    lines = b"".join(f"{name}: {value}\r\n".encode("utf-8", "surrogatepass") for name, value in headers)
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def _open_folder(folder: str):
    return arrow_fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _dictionary(samples: list[bytes]) -> bytes:
    """A dictionary trained from the first payloads; their beginning where they are too few to train from."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:DICTIONARY_BYTES] or b"\r\n"


def _write(batches: Iterator[pd.DataFrame], folder: str) -> Iterator[pd.DataFrame]:
    """One archive per task, named by its attempt: only finished ones reach the manifest."""
    files, root = _open_folder(folder)
    context = TaskContext.get()
    path = f"{root}/{context.partitionId():06d}-{context.taskAttemptId()}.warc.zst"
    sink, compressor, held, held_bytes, records = None, None, [], 0, 0

    def start():
        nonlocal sink, compressor
        # evenly spread parts, so that short archives have enough samples to train from
        samples = [x[at : at + 4096] for x in held for at in range(0, len(x), 4096)]
        content = _dictionary(samples)
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_AUTO)
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True)
        sink = files.open_output_stream(path)
        sink.write(struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content)
        for record in held:
            sink.write(compressor.compress(record))
        held.clear()

    for batch in batches:
        for page_id, url, payload, refers_to in zip(
            batch["page_id"].array, batch["url"], batch["payload"], batch["refers_to"].array
        ):
            record = record_bytes(
                None if pd.isna(page_id) else int(page_id), url, bytes(payload),
                None if pd.isna(refers_to) else int(refers_to),
            )
            records += 1
            if sink:
                sink.write(compressor.compress(record))
                continue
            held.append(record)
            held_bytes += len(record)
            if held_bytes >= SAMPLE_BYTES:
                start()
    if records:
        if not sink:
            start()
        sink.close()
        yield pd.DataFrame({"path": [path.rpartition("/")[2]], "records": [records]})


def write_archives(pages: DataFrame, folder: str | None = None, threshold: int = 0) -> tuple[str, DataFrame]:
    """Write ``pages`` (``page_id``, ``url``, ``html``) as archives; gives the folder and its manifest (path, records).

    Each row becomes one record in one frame, its payload the html in UTF-8 (null: empty). Of records with equal
    payloads of at least ``threshold`` bytes the one with the largest page id is a response and the others revisit it;
    repeated rows of that id are all responses, null ids revisit any other id. Each archive starts with its dictionary
    in a skippable frame. Line ends in a url are percent-encoded. The folder must be one that all executors reach; by default it lies below the shared one.
    """
    folder = folder or f"{shared_folder(pages.sparkSession)}/archives-{uuid4().hex}"
    files, root = _open_folder(folder)
    files.create_dir(root, recursive=True)
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"),
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    plan = plan_revisits(rows, threshold).withColumnsRenamed({"page_id": "plan_id", "digest": "plan_digest"})
    whole = rows.join(
        plan, F.col("page_id").eqNullSafe(F.col("plan_id")) & (F.col("digest") == F.col("plan_digest")), "left"
    ).select("page_id", "url", "payload", "refers_to")
    manifest = f"{folder}/manifest"
    whole.mapInPandas(lambda batches: _write(batches, folder), "path string, records long").write.parquet(manifest)
    return folder, pages.sparkSession.read.schema("path string, records long").parquet(manifest)


def frames(source) -> Iterator[bytes]:
    """The records of an open archive, one for each frame; the dictionary comes from the leading skippable frame."""
    head = source.read(8)
    if not head:
        return
    magic, size = struct.unpack("<II", head) if len(head) == 8 else (0, 0)
    if magic == DICTIONARY_MAGIC:
        content, rest = source.read(size), b""
        if len(content) < size:
            raise ValueError("the dictionary frame is cut off")
        if content[:4] == struct.pack("<I", FRAME_MAGIC):  # the dictionary may itself be compressed
            content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
    else:
        reader, rest = zstandard.ZstdDecompressor(), head
    while True:
        rest = rest or source.read(CHUNK)
        if not rest:
            return
        frame, parts = reader.decompressobj(), []
        while True:
            parts.append(frame.decompress(rest))
            if frame.eof:
                rest = frame.unused_data
                break
            rest = source.read(CHUNK)
            if not rest:
                raise ValueError("a frame is cut off")
        yield b"".join(parts)


def parse_record(record: bytes) -> tuple:
    """The fields of ``RECORD``. ``problem`` names what is wrong with headers, lengths or digests; null if nothing is."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return (None,) * 7 + ("a header line without a colon",)
        fields[name.strip().lower().decode("latin-1")] = value.strip(b" \t").decode("utf-8", "replace")
    kind = fields.get("warc-type")

    def urn(name: str) -> int | None:
        digits = fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits.lstrip("-").isdigit() else None

    length = fields.get("content-length", "")
    size = int(length) if length.isdigit() else -1
    block, tail = rest[: max(size, 0)], rest[max(size, 0) :]
    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    declared = fields.get("x-payload-length", "")
    problem = None
    if lines[0] != VERSION or not gap:
        problem = "no version line or end of headers"
    elif missing := [x for x in ("warc-type", "warc-record-id", "warc-date", "content-length") if x not in fields]:
        problem = f"missing header {missing[0]}"
    elif size < 0 or len(block) != size or tail != b"\r\n\r\n":
        problem = "the content length does not fit the record"
    elif fields.get("warc-block-digest", f"sha1:{sha1_base32(block)}") != f"sha1:{sha1_base32(block)}":
        problem = "the block does not fit its digest"
    elif payload is not None and (sha1_base32(payload) != digest or declared not in ("", str(len(payload)))):
        problem = "the payload does not fit its digest or length"
    return (
        urn("warc-record-id"), fields.get("warc-target-uri") or None, kind,
        int(declared) if declared.isdigit() else None, digest or None, urn("warc-refers-to"), payload, problem,
    )


def _read(batches: Iterator[pd.DataFrame], folder: str, keep_payload: bool) -> Iterator[pd.DataFrame]:
    files, root = _open_folder(folder)
    names = [part.split()[0] for part in RECORD.split(", ")]

    def frame(rows: list) -> pd.DataFrame:
        table = pd.DataFrame(rows, columns=names, dtype=object)
        for name in ("page_id", "payload_bytes", "refers_to"):
            table[name] = table[name].astype("Int64")
        return table if keep_payload else table.drop(columns="payload")

    for batch in batches:
        for path, records in zip(batch["path"], batch["records"]):
            rows, held, seen = [], 0, 0
            with files.open_input_stream(f"{root}/{path}") as source:
                for record in frames(source):
                    seen += 1
                    rows.append(parse_record(record))
                    held += len(record) if keep_payload else 1024
                    if held > 16 << 20:
                        yield frame(rows)
                        rows, held = [], 0
            if seen != records:
                raise ValueError(f"{path} holds {seen} records, its manifest says {records}")
            if rows:
                yield frame(rows)


def read_archives(folder: str, manifest: DataFrame, keep_payload: bool = True) -> DataFrame:
    """The records of the archives that ``manifest`` lists, with headers, lengths and digests validated.

    Columns as in ``RECORD``. Records that fail a check are returned with their ``problem``; a cut-off frame or a
    record count other than the manifest's raises. Archives are streamed: memory holds one record and one batch.
    """
    schema = RECORD if keep_payload else RECORD.replace(" payload binary,", "")
    spread = manifest.repartition(max(manifest.count(), 1))  # a task for each archive: few rows stand for many bytes
    return spread.mapInPandas(lambda batches: _read(batches, folder, keep_payload), schema)
