"""Web archives with a Zstandard dictionary per file.

A file is a leading skippable frame with a dictionary built from records of that file, then
one frame per record. A task begins a new file after ``ARCHIVE_BYTES`` of frames, so that files
can be read whole, whatever a task's share is. Records are written by Spark's text sink, whose
commit protocol makes retried tasks safe on any file system; what it puts after each record is
an empty skippable frame, so a file is a plain sequence of frames.

Defined results
    null payloads are empty payloads; a null url leaves out the target header.
    the response of equal payloads is the record with the largest id, null ids last; of repeated
    rows with that id and payload one is it, and the others revisit it. Record ids are unique:
    they hold the page id and the row's number in the input, which has to be the same each time
    it is read (a table is; write other inputs to one first).
    an empty table makes no records; other columns are left alone.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorekiln.functions.batches import small_batches
from lorekiln.sources.shared import Workspace

#: Fixed values of the format: magic numbers of the dictionary's frame and of empty frames.
DICTIONARY_MAGIC = 0x184D2A5D
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DICTIONARY_BYTES = 64 << 10
#: A file's dictionary is built from its first records up to this many bytes. They are no special
#: ones: a task's records come in the order of their digests, or of the input.
SAMPLE_BYTES = 1 << 20
#: Bytes of frames after which a new file begins, with a dictionary of its own.
ARCHIVE_BYTES = 64 << 20
LEVEL = 6
DATE = "2000-01-01T00:00:00Z"

RECORDS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def plan_records(pages: DataFrame, work: Workspace, id_col: str, url_col: str, body_col: str, least: int) -> DataFrame:
    """id, row, url, digest, length, the response's id and row, and the payload, which is null
    for revisits.

    Equal payloads share SHA-1, length and a second hash. The response of a group is found
    on narrow rows; pages then move once, to meet it.
    """
    payload = F.coalesce(F.col(body_col).cast("binary"), F.lit(b""))
    key = F.struct(F.sha1(payload).alias("sha1"), F.octet_length(payload).alias("length"), F.xxhash64(payload).alias("x"))
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), F.col(url_col).alias("url"), payload.alias("payload"), key.alias("key")
    )
    rows = rows.select("id", "row", "url", "payload", "key.*")
    same = ["sha1", "length", "x"]
    first = rows.groupBy(*same).agg(F.max(F.struct("id", "row")).alias("r")).select(*same, F.col("r.id").alias("response"), F.col("r.row").alias("response_row"))
    first = work.keep(first, "responses")
    revisit = (F.col("length") >= least) & (F.col("row") != F.col("response_row"))
    return rows.join(first, same).select(
        "id", "row", "url", "sha1", F.col("length").cast("long").alias("length"), F.when(revisit, F.col("response")).alias("refers_to"),
        F.when(revisit, F.col("response_row")).alias("refers_row"), F.when(~revisit, F.col("payload")).alias("payload"),
    )


def _name(page_id: int | None, row: int) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}:{row}>"


def _record(page_id, row, url, sha1, length, refers_to, refers_row, payload) -> bytes:
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    revisit = refers_row is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id, row)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(refers_to, refers_row)}"]
    block = http + (payload or b"")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def build_dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on the samples; they are its raw content where there are too few to train."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=512, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[-DICTIONARY_BYTES:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def _frames(archive_bytes: int, sample_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(archive, place, frame): a partition's records as the frames of one file or several, in
        order. Holds the sample and a batch at most."""
        waiting: list[bytes] = []
        size, written, compressor, archive, place = 0, 0, None, 0, 0

        def begin() -> list[bytes]:
            nonlocal compressor
            trained = build_dictionary(waiting)
            compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained)
            data = trained.as_bytes()
            return [struct.pack("<II", DICTIONARY_MAGIC, len(data)) + data, *map(compressor.compress, waiting)]

        def out(frames: list[bytes]) -> pa.RecordBatch:
            nonlocal place
            places = range(place, place + len(frames))
            place += len(frames)
            columns = [pa.array([archive] * len(frames), pa.int32()), pa.array(places, pa.int64()), pa.array(frames, pa.binary())]
            return pa.record_batch(columns, ["archive", "place", "frame"])

        for batch in batches:
            frames = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                record = _record(*row)
                if compressor is None:
                    waiting.append(record)
                    size += len(record)
                    if size >= sample_bytes:
                        frames += begin()
                        waiting, size, written = [], 0, sum(map(len, frames))
                else:
                    frames.append(compressor.compress(record))
                    written += len(frames[-1])
                if written >= archive_bytes:
                    yield out(frames)
                    frames, written, compressor, archive = [], 0, None, archive + 1
            if frames:
                yield out(frames)
        if compressor is None and waiting:
            yield out(begin())

    return run


def write_archives(records: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES, sample_bytes: int = SAMPLE_BYTES) -> None:
    """``records``, as :func:`plan_records` returns them, in folders by the number that an
    archive has in its task."""
    small_batches(records.sparkSession)
    columns = ["id", "row", "url", "sha1", "length", "refers_to", "refers_row", "payload"]
    frames = records.select(*columns).mapInArrow(_frames(archive_bytes, sample_bytes), "archive int, place bigint, frame binary")
    # The sink wants rows of a folder together; with this order it doesn't sort them once more.
    frames = frames.sortWithinPartitions("archive", "place").select("archive", F.col("frame").cast("string").alias("value"))
    frames.write.partitionBy("archive").text(path, lineSep=EMPTY_FRAME)


def records_of(content: bytes | memoryview) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a file."""
    magic, size = struct.unpack_from("<II", content)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("an archive begins with its dictionary")
    trained = zstandard.ZstdCompressionDict(bytes(content[8 : 8 + size]))
    stream = zstandard.ZstdDecompressor(dict_data=trained).stream_reader(memoryview(content)[8 + size :], read_across_frames=True)
    lines = io.BufferedReader(stream, 1 << 16)
    while line := lines.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"no record begins with {line[:40]!r}")
        head = {}
        while (line := lines.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            head[name] = value.strip()
        yield head, lines.read(int(head["Content-Length"]))
        if lines.read(4) != b"\r\n\r\n":
            raise ValueError("a record is cut off")


def _id(name: str | None) -> int | None:
    value = name and name.removeprefix("<urn:page:").partition(":")[0]
    return int(value) if value and value != "none" else None


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            rows = []
            for head, block in records_of(memoryview(content.as_buffer())):
                http, _, payload = block.partition(b"\r\n\r\n")
                length = int(http.rpartition(b"Content-Length: ")[2])
                digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                if head["WARC-Type"] == "response" and (len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                    raise ValueError(f"the payload of {head['WARC-Record-ID']} is not what was written")
                rows.append((_id(head["WARC-Record-ID"]), length, digest, head["WARC-Type"], _id(head.get("WARC-Refers-To"))))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per record: page_id, payload_bytes, payload_digest, record_type, refers_to.
    Payloads are checked against their digests."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", True).load(path)
    return files.filter("length > 0").select("content").mapInArrow(_read, RECORDS)


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", least: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> str:
    """Writes ``pages`` to archives and returns their folder. Equal payloads of at least
    ``least`` bytes are written once."""
    work = Workspace(pages.sparkSession, "warc")
    write_archives(plan_records(pages, work, id_col, url_col, body_col, least), work.path("archives"), archive_bytes, min(SAMPLE_BYTES, archive_bytes))
    return work.path("archives")
