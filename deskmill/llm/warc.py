"""Web archives: one Zstandard frame per record, a shared dictionary in front.

An archive begins with a skippable frame that holds the dictionary. Each record is a frame of its own, compressed with
the dictionary, so that one record can be read without the others.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskmill.llm.common import total_bytes
from deskmill.session import shared_dir

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
ZSTD_FRAME = 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# An empty skippable frame. Spark's text writer puts it behind every row; readers of Zstandard pass over it.
FILLER = struct.pack("<II", SKIPPABLE[0], 0).decode("latin-1")

LEAST_BYTES = 100
ARCHIVE_BYTES = 32 << 20
SAMPLE_PAGES = 256
SAMPLE_CHARS = 16384
DICTIONARY_BYTES = 64 << 10
NO_ID = (1 << 128) - 1


def train_dictionary(pages: DataFrame, key: str, html: str) -> bytes:
    """A dictionary from a bounded sample: the first 16384 characters of at most 256 pages, chosen by the hash of their key."""
    # The keys are drawn first, so that only the texts of those drawn are moved.
    drawn = pages.filter(F.length(html) > 0).select(F.col(key).alias("drawn")).filter("drawn IS NOT NULL").orderBy(F.xxhash64("drawn"), "drawn").limit(SAMPLE_PAGES)
    sample = pages.join(F.broadcast(drawn), F.col(key) == F.col("drawn")).select("drawn", F.substring(html, 1, SAMPLE_CHARS).alias("start")).distinct().orderBy(F.xxhash64("drawn"), "drawn", "start")
    texts = [row["start"].encode() for row in sample.limit(SAMPLE_PAGES).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few pages to train on: their bytes themselves
        return b"".join(texts)[-DICTIONARY_BYTES:] or b"WARC/1.1\r\nWARC-Type: response\r\n"


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.UUID(int=NO_ID if page_id is None else page_id % (1 << 64))}>"


def page_of(record: str | None) -> int | None:
    """The page whose number a record id holds."""
    if not record:
        return None
    number = uuid.UUID(record.strip("<>").removeprefix("urn:uuid:")).int
    return None if number == NO_ID else number - (1 << 64 if number >> 63 else 0)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record. A revisit has the HTTP header of the whole answer, with its length, but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    uri = re.sub(r"[\r\n]+", " ", url or "").strip() or "about:blank"
    header = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Target-URI: {uri}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        header += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(header).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> str:
    """Write a record per row of ``pages`` into archives below ``path``, and return ``path``.

    The payload is the text in UTF-8, null as empty. Of rows with equal payloads of at least 100 bytes those with the smallest
    key are responses, the others revisit it; shorter payloads are responses. Rows without a key are records without a
    number and are never referred to; repeated rows are records of their own; a null address becomes ``about:blank``. An empty
    table gives an archive without records. About ``archive_bytes`` of payload go to one file, which is what a reading task holds.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"))
    # The page as text, with an empty one for null, so that pages meet on plain equality of two columns.
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256)).withColumn("page", F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    long_enough = rows.filter(F.octet_length("html") >= LEAST_BYTES).select("page", "page_id", "digest")
    first = long_enough.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1 AND refers_to IS NOT NULL")
    # Only ids and digests meet on the digest, whose groups may be large; the payloads move once, by page.
    again = long_enough.join(first, "digest").filter("page_id IS NULL OR page_id <> refers_to").select("page", "digest", "refers_to").distinct()
    files = max(1, -(-total_bytes(rows, "html") // archive_bytes))
    joined = rows.repartition(files, "page", "digest").join(again, ["page", "digest"], "left")
    dictionary = train_dictionary(rows, "page_id", "html")
    frames = joined.mapInArrow(lambda batches: _frames(batches, dictionary), "frame binary")
    frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", FILLER).text(path)
    return path


def _frames(batches: Iterator[pa.RecordBatch], dictionary: bytes) -> Iterator[pa.RecordBatch]:
    compressor = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True, write_content_size=True)
    frames = [struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary]
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to")]
        for page_id, url, html, digest, refers_to in zip(*columns, strict=True):
            frames.append(compressor.compress(record(page_id, url, html.encode(), digest, refers_to)))
        yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["frame"])
        frames = []
    if frames:
        yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["frame"])


def split_frames(data: bytes) -> Iterator[tuple[int, int, int]]:
    """Magic number, begin and end of each frame, found from the headers of its blocks."""
    at = 0
    while at < len(data):
        if at + 8 > len(data):
            raise ValueError(f"a frame is cut off at byte {at}")
        magic, size = struct.unpack_from("<II", data, at)
        if magic in SKIPPABLE:
            end = at + 8 + size
        elif magic == ZSTD_FRAME:
            head = data[at : at + 18]
            end, last = at + zstandard.frame_header_size(head), False
            while not last:
                if end + 3 > len(data):
                    raise ValueError(f"a block is cut off at byte {end}")
                block = int.from_bytes(data[end : end + 3], "little")
                last = bool(block & 1)
                end += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
            end += 4 * zstandard.get_frame_parameters(head).has_checksum
        else:
            raise ValueError(f"no frame begins at byte {at}")
        if end > len(data):
            raise ValueError(f"a frame is cut off at byte {at}")
        yield magic, at, end
        at = end


def parse_record(data: bytes) -> dict:
    """The fields of one record, checked: version, needed headers, lengths, and the digest of a payload that is there."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or not lines[0].startswith("WARC/1."):
        raise ValueError("no record header")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    if missing := [x for x in ("warc-type", "warc-record-id", "warc-date", "content-length") if x not in fields]:
        raise ValueError(f"headers are missing: {', '.join(missing)}")
    size = int(fields["content-length"])
    block, end = rest[:size], rest[size:]
    if len(block) != size or end != b"\r\n\r\n":
        raise ValueError("the block is not as long as its header says")
    http, gap, payload = block.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("no HTTP header in the block")
    length = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    digest = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    if fields["warc-type"] == "response":
        if length and int(length[1]) != len(payload):
            raise ValueError("the payload is not as long as its header says")
        if digest and hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("the payload does not have the digest in its header")
    return {
        "page_id": page_of(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "record_type": fields["warc-type"],
        "refers_to": page_of(fields.get("warc-refers-to")),
        "payload_bytes": int(length[1]) if length else len(payload),
        "payload_digest": digest,
        "payload": payload if fields["warc-type"] == "response" else None,
    }


def read_frames(data: bytes) -> Iterator[dict]:
    """The records of one archive. A record that is not valid is a row with ``error`` and nothing else."""
    decompressor = zstandard.ZstdDecompressor()
    try:
        for magic, begin, end in split_frames(data):
            if magic == DICTIONARY_FRAME and begin == 0:
                body = data[8:end]
                if body[:4] == ZSTD_FRAME.to_bytes(4, "little"):
                    body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
                decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
            elif magic == ZSTD_FRAME:
                try:
                    yield parse_record(decompressor.decompressobj().decompress(data[begin:end]))
                except (ValueError, zstandard.ZstdError) as wrong:
                    yield {"error": f"byte {begin}: {wrong}"}
    except ValueError as wrong:  # no further frame can be found in this file
        yield {"error": str(wrong)}


RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, error string"
BATCH_ROWS = 512


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of the archives below ``path``; see ``RECORDS`` for the columns.

    A revisit has no ``payload``, but the length and the digest of the one it refers to. Broken records and files give rows
    with ``error``, at least one each, so that nothing goes unnoticed.
    """
    names = [c.split()[0] for c in RECORDS.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in RECORDS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for batch in batches:
            for data in batch.column("content"):
                for row in read_frames(data.as_buffer().to_pybytes()):
                    rows.append({c: row.get(c) for c in names})
                    if len(rows) == BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
        yield pa.RecordBatch.from_pylist(rows, schema)

    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content").mapInArrow(run, RECORDS)


def archive_dir(spark: SparkSession) -> str:
    """A new folder for archives below the folder that all executors share."""
    return f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
