"""WARC archives compressed with an embedded Zstandard dictionary, one frame per record.

``write_archives`` turns pages into WARC/1.1 records: a ``response`` record for the first page of each payload, ``revisit``
records that refer to it for the others (above a least payload size).  Which page is first is a grouped aggregate by
payload digest, joined back by page; payloads themselves move once.  Each task then writes its records into archives of about
``ARCHIVE_BYTES``: it trains a Zstandard dictionary on records of the archive, stores it in a leading skippable frame (magic
0x184D2A5D), and compresses every record as a frame of its own, so records can be read alone by offset.

Archives have names unique to their attempt and are committed by the manifest, a table of the paths that finished tasks
returned: what a lost or repeated attempt left behind is never read.  ``read_archives`` reads a manifest's archives.

Defined results: a null html is an empty payload; repeated page_ids are written as often as they occur; with equal payloads
and equal page_ids all are responses; an empty table gives an empty manifest; null page_ids are written without an id.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stage
from tidemark.session import scratch_path

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 32 << 10
#: Bytes and number of an archive's records that its dictionary is trained on, spread evenly over the archive.
TRAINING_BYTES = 1 << 20
TRAINING_RECORDS = 2_000
LEVEL = 3


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def encode_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One uncompressed WARC record.  A revisit holds the HTTP head alone, whose Content-Length is that of the payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def decode_record(record: bytes) -> dict:
    """Headers and payload of a record: page_id, url, type, refers_to, digest, payload_bytes, payload (None for a revisit)."""
    top, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in top.decode().split("\r\n")[1:] if ": " in line)
    block = rest[: int(fields["Content-Length"])]
    head, _, payload = block.partition(b"\r\n\r\n")
    http = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    number = lambda text: int(text[len("<urn:page:") : -1]) if text and text != record_id(None) else None
    revisit = fields["WARC-Type"] == "revisit"
    return {
        "page_id": number(fields["WARC-Record-ID"]),
        "url": fields.get("WARC-Target-URI", ""),
        "type": fields["WARC-Type"],
        "refers_to": number(fields.get("WARC-Refers-To")),
        "digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload_bytes": int(http["Content-Length"]),
        "payload": None if revisit else payload,
    }


def train(records: list[bytes]) -> bytes:
    """A dictionary for the records; their bytes themselves if there are too few to train on, empty for none."""
    import zstandard

    step = max(1, len(records) // TRAINING_RECORDS, sum(map(len, records)) // TRAINING_BYTES)
    chosen = [r[: 16 << 10] for r in records[::step]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, chosen, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(chosen)[-DICTIONARY_BYTES:]


def encode_archive(records: list[bytes]) -> bytes:
    """A whole archive: the dictionary's skippable frame, then a frame per record."""
    import zstandard

    trained = train(records)
    held = zstandard.ZstdCompressionDict(trained)
    held.precompute_compress(level=LEVEL)
    press = zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=True)
    return struct.pack("<II", DICTIONARY_MAGIC, len(trained)) + trained + b"".join(map(press.compress, records))


def decode_archive(data: bytes) -> Iterator[bytes]:
    """The records of an archive, one after another."""
    import zstandard

    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame at the start of the archive")
    opener = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
    rest = data[8 + size :]
    while rest:
        frame = opener.decompressobj()
        yield frame.decompress(rest)
        rest = frame.unused_data


def pages_with_owner(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, refers_to, revisit``: the first page of each payload is no revisit."""
    html = F.coalesce("html", F.lit(""))
    hashed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha2(html, 256).alias("sha"), F.octet_length(html).alias("n"))
    first = hashed.filter(F.col("n") >= least_bytes).groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    repeated = first.filter("n > 1").select("sha", "first")
    body = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    marked = body.withColumn("sha", F.sha2("html", 256)).join(repeated, "sha", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return marked.select("page_id", "url", "html", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write archives below ``folder`` and return the committed manifest: ``path, records, bytes``."""
    shared = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        where, base = fs.FileSystem.from_uri(shared.replace("file:///", "file:/").replace("file:/", "file:///"))
        held: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            path = f"part-{uuid.uuid4().hex}.warc.zst"
            data = encode_archive(held)
            where.create_dir(base, recursive=True)
            with where.open_output_stream(f"{base}/{path}", compression=None) as out:
                out.write(data)
            return pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([len(held)], pa.int64()), pa.array([len(data)], pa.int64())], ["path", "records", "bytes"]
            )

        for batch in batches:
            columns = (batch.column(n) for n in ("page_id", "url", "html", "refers_to", "revisit"))
            for page_id, url, html, refers_to, revisit in zip(*columns, strict=True):
                record = encode_record(page_id.as_py(), url.as_py(), html.as_py().encode(), refers_to.as_py(), revisit.as_py())
                held.append(record)
                size += len(record)
                if size >= archive_bytes:
                    yield close()
                    held, size = [], 0
        if held:
            yield close()

    rows = pages_with_owner(pages, least_bytes)
    return stage(rows.mapInArrow(write, "path string, records long, bytes long"), "warc-manifest")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """``page_id, url, payload_bytes, payload_digest, record_type, refers_to, intact`` of every record of a manifest's archives.

    ``intact`` tells whether a response's payload has the length and digest that its headers state.
    """
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, intact boolean"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                found = []
                for record in decode_archive(data.as_py()):
                    r = decode_record(record)
                    whole = r["payload"]
                    intact = whole is None or (len(whole) == r["payload_bytes"] and base32_sha1(whole) == r["digest"])
                    found.append((r["page_id"], r["url"], r["payload_bytes"], r["digest"], r["type"], r["refers_to"], intact))
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_()]
                names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"]
                if found:
                    columns = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    spark = manifest.sparkSession
    if not manifest.limit(1).count():
        return manifest.limit(0).select(*[F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in schema.split(", ")])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("path"), "content")
    # the manifest's rows are (path, two counts): the join moves paths unless Spark broadcasts them
    return named.join(manifest.select("path"), "path", "left_semi").mapInArrow(read, schema)


def archive_and_read(spark: SparkSession, pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write pages as archives in the shared folder and read them back."""
    folder = scratch_path(spark, "warc")
    return read_archives(write_archives(pages, folder, least_bytes), folder)
