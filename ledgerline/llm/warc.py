"""WARC archives in Zstandard frames with a dictionary of their own, written and read by Spark.

Writing: equal payloads share one response record; the others are revisit records without
payload. Only digests, sizes and ids are grouped. The digests that more than one page in
``HOT_SHARE`` has are at most ``HOT_SHARE`` many, so they are broadcast, and their pages take
no part in the shuffled join. Each task trains a dictionary on its first records
(``SAMPLE_BYTES`` at most; it affects sizes only) and begins every archive with a skippable
frame that holds it, as the format for compressed WARC files has it. Each record is a frame
of its own, so one can be read without the others, and an archive is full at
``ARCHIVE_BYTES``. Spark's text writer commits the files, so a lost executor leaves no half
archive; the separator that it puts after every frame is an empty skippable frame, which
readers pass over. Too few or too uniform records give no dictionary: then the archive
begins with its first record.

Reading: an archive's dictionary is taken from its first frame, records are read as a stream,
and the digest of every response payload is computed anew and must equal the one in its header.

Defined cases: a null payload is empty; a null page_id has no Page-ID field and comes back
null; it is never the first of equal payloads unless all their ids are null, and then all are
responses, like repeated rows of the smallest id. A null url has no target; one with
characters that a header can't hold is percent-encoded. Long payloads are one record, held
once by a worker. An empty table gives no archive and an empty result. Columns other than
page_id, url and html are not read.
"""

from __future__ import annotations

import hashlib
import io
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise, python_batches
from ledgerline.session import scratch_path

#: smaller payloads are never revisits
LEAST_BYTES = 100
HOT_SHARE = 1000
#: compressed bytes of records after which a task begins another archive
ARCHIVE_BYTES = 64 << 20
#: records that the dictionary is trained on, and its greatest size
SAMPLE_BYTES, DICTIONARY_BYTES = 4 << 20, 64 << 10
LEVEL = 6
#: pages in a batch: each may be long
PAGES = 100
#: the clock isn't read, so reruns write the same archives
DATE = "1970-01-01T00:00:00Z"

#: fixed values of the formats
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
EMPTY_FRAME = "\x50\x2a\x4d\x18\x00\x00\x00\x00"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
RECORD_IDS = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

RECORD = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(RECORD_IDS, f'{page_id}:{digest}')}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, date: str = DATE) -> bytes:
    """One record; a revisit of page ``first`` if that is given. It keeps the HTTP head, which tells the payload's length."""
    head = HTTP_HEAD.format(len(payload)).encode()
    fields = {
        "WARC-Type": "response" if first is None else "revisit",
        "WARC-Record-ID": record_id(page_id, digest),
        "WARC-Date": date,
        "WARC-Target-URI": None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~"),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Profile": None if first is None else REVISIT_PROFILE,
        "WARC-Refers-To": None if first is None else record_id(first, digest),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(head) + (len(payload) if first is None else 0),
        "Page-ID": page_id,
        "Refers-To-Page-ID": first,
    }
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields.items() if v is not None)]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + head + (payload if first is None else b"") + b"\r\n\r\n"


def trained(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, records)) // 8), records)
    except (zstandard.ZstdError, ValueError):  # too few records, or nothing in common
        return None


def frames(records: Iterable[bytes], archive_bytes: int = ARCHIVE_BYTES) -> Iterator[tuple[int, bytes]]:
    """(archive, frame): a dictionary before the records of each archive."""
    records, sample, held = iter(records), [], 0
    for record in records:
        sample.append(record)
        held += len(record)
        if held >= SAMPLE_BYTES:
            break
    dictionary = trained([r for r in sample if len(r) < SAMPLE_BYTES])
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
    head = b"" if dictionary is None else dictionary.as_bytes()
    archive, size = -1, archive_bytes
    for part in (sample, records):
        for record in part:
            if size >= archive_bytes:
                archive, size = archive + 1, 0
                if head:
                    yield archive, DICTIONARY_MAGIC + len(head).to_bytes(4, "little") + head
            frame = compressor.compress(record)
            size += len(frame)
            yield archive, frame


def records_of(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record of an archive."""
    dictionary = None
    if archive[:4] == DICTIONARY_MAGIC:
        size = int.from_bytes(archive[4:8], "little")
        dictionary = zstandard.ZstdCompressionDict(archive[8:8 + size])
        archive = memoryview(archive)[8 + size:]
    stream = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(archive, read_across_frames=True), 1 << 20)
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) != b"\r\n":
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            fields[name] = value
        block = stream.read(int(fields["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {fields.get('WARC-Record-ID')} doesn't end where its length says")
        yield fields, block


def parsed(fields: dict[str, str], block: bytes) -> tuple:
    """A row of ``RECORD``; the payload of a response must have the digest that its header gives."""
    head, _, payload = block.partition(b"\r\n\r\n")
    length = int(head.rpartition(b"Content-Length: ")[2])
    digest, revisit = fields["WARC-Payload-Digest"].removeprefix("sha256:"), fields["WARC-Type"] == "revisit"
    if not revisit:
        own = hashlib.sha256(payload).hexdigest()
        if own != digest or len(payload) != length:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    number = lambda name: int(fields[name]) if name in fields else None
    return (number("Page-ID"), fields.get("WARC-Target-URI"), length, digest, fields["WARC-Type"],
            number("Refers-To-Page-ID"), None if revisit else payload)


def with_first(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, and ``first``: the smallest page of an equal payload, where that is another one."""
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    own = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                       html.alias("html")).withColumn("digest", F.sha2("html", 256))
    counts = materialise(
        own.filter(F.octet_length("html") >= LEAST_BYTES).groupBy("digest").agg(
            F.min("page_id").alias("first"), F.count("*").alias("copies")).filter("copies > 1"), "warc_payloads")
    total = counts.agg(F.sum("copies")).first()[0] or 0
    hot = F.col("copies") > total // HOT_SHARE
    often = counts.filter(hot).select(F.col("digest").alias("hot_digest"), F.col("first").alias("hot_first"))
    seldom = counts.filter(~hot).select(F.col("digest").alias("own_digest"), F.col("first").alias("own_first"))
    large = F.octet_length("html") >= LEAST_BYTES
    marked = own.join(F.broadcast(often), (F.col("digest") == F.col("hot_digest")) & large, "left")
    # what has no partner here gets a key that spreads it and meets nothing
    key: Column = F.when(large & F.col("hot_digest").isNull(), F.col("digest")).otherwise(
        F.concat(F.lit("-"), F.xxhash64("page_id", "digest").cast("string")))
    joined = marked.withColumn("key", key).join(seldom, F.col("key") == F.col("own_digest"), "left")
    first = F.coalesce("hot_first", "own_first")
    return joined.select("page_id", "url", "html", "digest",
                         F.when(~F.col("page_id").eqNullSafe(first), first).alias("first"))


def write_archives(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES, date: str = DATE) -> None:
    """Archives of all pages below ``path``, one folder per number of an archive within its task."""
    python_batches(pages.sparkSession, PAGES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                    yield record_bytes(*row, date)

        for number, (archive, frame) in enumerate(frames(records(), archive_bytes)):
            yield pa.RecordBatch.from_arrays([pa.array([archive], pa.int32()), pa.array([number], pa.int64()),
                                              pa.array([frame], pa.binary())], names=["archive", "number", "frame"])

    written = with_first(pages).mapInArrow(run, "archive int, number bigint, frame binary")
    (written.sortWithinPartitions("archive", "number").select("archive", F.col("frame").cast("string").alias("value"))
     .write.partitionBy("archive").option("lineSep", EMPTY_FRAME).text(path))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below ``path``: page, url, payload size and digest, type, what it refers to, and a response's payload."""
    python_batches(spark, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RECORD.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for archive in batch.column("content"):
                rows, held = [], 0
                for fields, block in records_of(archive.as_py()):
                    rows.append(parsed(fields, block))
                    held += len(block)
                    if held >= SAMPLE_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInArrow(run, RECORD)


def archived(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """All pages written to archives in the shared folder and read back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, archive_bytes)
    return read_archives(spark, path)
