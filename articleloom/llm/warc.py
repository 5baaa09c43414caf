"""WARC archives of zstandard frames: written from a table of pages, read back and validated.

An archive starts with a skippable frame that holds the dictionary its records are compressed with; a frame for each record
follows. The dictionary is trained on the archive's first records, so it depends on nothing outside the task that
writes the archive, and an archive can be read by itself.

The reader loads the dictionary, walks the frames by their block headers and decodes one record from each. Lengths,
mandatory headers and digests are checked. A record that is damaged is a row with a ``problem``; the next frame is read as
usual.

Archives become part of a set by the manifest, which is written when all tasks are done: what a lost or repeated task
leaves in the folder is in no manifest and is not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from articleloom.sources.scratch import stored

LEAST_BYTES = 1000  # payloads of at least so many bytes are stored once
ARCHIVE_BYTES = 64 << 20  # an archive is closed when it has grown to this size
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 2 << 20  # records that an archive's dictionary is trained on; they are stored like the others
LEVEL = 3
DATE = "2000-01-01T00:00:00Z"  # of all records unless the caller names another: a rerun writes the same bytes

SMALL_BYTES = 64 << 20  # tables up to this size are sent to all tasks
REFERENCE_BYTES = 256  # of one row of such a table

# Names and numbers of the two formats.
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
VERSIONS = (b"WARC/1.1", b"WARC/1.0")
MANDATORY = (b"warc-record-id", b"content-length", b"warc-date", b"warc-type")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"

RECORD = (
    "archive string, record int, record_id string, record_type string, target_uri string, page_id bigint, "
    "payload_bytes bigint, payload_digest string, refers_to_record string, payload binary, problem string")


def _record_id(page_id: int | None, digest: bytes) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest.hex()}')}>"


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record: version, headers, an empty line, the block and two empty lines."""
    lines = [VERSIONS[0].decode(), *(f"{name}: {value}" for name, value in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block + END


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """The response record of a page, or its revisit record: the HTTP headers of the response without the payload.

    Ids come from page id and digest, so a revisit can name its response wherever that is written.
    """
    digest = hashlib.sha1(payload, usedforsecurity=False).digest()
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _record_id(page_id, digest)),
        ("WARC-Date", date), ("WARC-Payload-Digest", "sha1:" + base64.b32encode(digest).decode())]
    if url is not None:
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda found: f"%{ord(found[0]):02X}", url)))
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to, digest))]
    headers.append(("Content-Type", "application/http; msgtype=response"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode() + END
    return warc_record(headers, http + payload if refers_to is None else http)


class ArchiveWriter:
    """One archive: the first records wait until there are enough of them to train the dictionary on."""

    def __init__(self, files: FileSystem, folder: str, date: str):
        self.name = f"pages-{uuid.uuid4().hex}.warc.zst"
        self.output = files.open_output_stream(f"{folder}/{self.name}", compression=None)  # by default the name decides
        self.waiting: list[bytes] | None = []
        self.waiting_bytes = self.bytes = self.records = 0
        self.add(warc_record(
            [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, self.name)}>"),
             ("WARC-Date", date), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))

    def add(self, record: bytes) -> None:
        self.records += 1
        if self.waiting is None:
            return self._write(self.compressor.compress(record))
        self.waiting.append(record)
        self.waiting_bytes += len(record)
        if self.waiting_bytes >= SAMPLE_BYTES:
            self._start()

    def _write(self, frame: bytes) -> None:
        self.output.write(frame)
        self.bytes += len(frame)

    def _start(self) -> None:
        waiting, self.waiting = self.waiting, None
        try:
            dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, [r[:SAMPLE_BYTES] for r in waiting], k=512, d=8)
        except zstandard.ZstdError:  # too few records to learn from: frames without a dictionary
            dictionary = None
        if dictionary:
            content = dictionary.as_bytes()
            self._write(DICTIONARY_MAGIC + len(content).to_bytes(4, "little") + content)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
        for record in waiting:
            self._write(self.compressor.compress(record))

    def close(self) -> tuple[str, int, int]:
        if self.waiting is not None:
            self._start()
        self.output.close()
        return self.name, self.records, self.bytes


def _send(df: DataFrame, rows: int) -> DataFrame:
    """The same rows, sent to all tasks if they are few; else Spark plans the join."""
    return F.broadcast(df) if rows * REFERENCE_BYTES <= SMALL_BYTES else df


def stored_once(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """``page_id, url, payload, refers_to``: which page holds the payload that a page repeats; null for those that hold their own.

    Of equal payloads of at least ``least`` bytes the page with the largest id holds it. Null ids are below all others.
    Rows that repeat the largest id hold the payload as well.
    """
    url = F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")
    payloads = pages.select(
        F.col("page_id").cast("long").alias("page_id"), url.alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    # Small ones have a key of their own each, so that no join brings them together.
    key = F.when(F.length("payload") >= least, F.sha2("payload", 256)).otherwise(F.concat_ws("/", F.lit("small"), "page_id"))
    keyed = payloads.withColumn("key", key)
    groups = stored(
        keyed.filter(F.length("payload") >= least).groupBy("key")
        .agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("times"))
        .filter("times > 1 AND largest IS NOT NULL").select("key", "largest"), "repeated_payloads")
    holder = F.when(F.col("page_id").eqNullSafe(F.col("largest")), None).otherwise(F.col("largest"))
    return keyed.join(_send(groups, groups.count()), "key", "left").select("page_id", "url", "payload", holder.alias("refers_to"))


def write_archives(pages: DataFrame, path: str, least: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES, date: str = DATE) -> None:
    """Write a WARC record for each row of ``pages(page_id, url, html)`` to archives below ``path``, which all executors must share.

    A null page is an empty payload; a null id or address leaves its header out. Each row is a record, also if rows repeat; other
    columns are not read, ``url`` may be missing. No rows give no archives. The folder is one that pyarrow can write to.
    """
    folder = f"{path.rstrip('/')}/archives"
    files, local = FileSystem.from_uri(folder)
    files.create_dir(local, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, below = FileSystem.from_uri(folder)
        done, archive = [], None
        for batch in batches:
            for page_id, url, payload, refers_to in zip(*batch.columns, strict=True):
                if archive is None:
                    archive = ArchiveWriter(target, below, date)
                archive.add(page_record(page_id.as_py(), url.as_py(), payload.as_py(), refers_to.as_py(), date))
                if archive.bytes >= archive_bytes:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        names, records, sizes = zip(*done, strict=True) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(records, pa.int64()), pa.array(sizes, pa.int64())], ["archive", "records", "bytes"])

    written = stored_once(pages, least).mapInArrow(write, "archive string, records bigint, bytes bigint")
    written.write.parquet(f"{path.rstrip('/')}/manifest")


def frame_end(data: memoryview, start: int) -> int:
    """Where the frame that begins at ``start`` ends, by the sizes in its block headers; beyond the data if it is cut off."""
    if data[start + 1:start + 4] == DICTIONARY_MAGIC[1:] and data[start] >> 4 == 5:  # skippable
        return start + 8 + int.from_bytes(data[start + 4:start + 8], "little")
    if data[start:start + 4] != FRAME_MAGIC:
        raise ValueError("no frame")
    head = bytes(data[start:start + 18])
    place = start + zstandard.frame_header_size(head)
    checksum = 4 if zstandard.get_frame_parameters(head).has_checksum else 0
    while place + 3 <= len(data):
        block = int.from_bytes(data[place:place + 3], "little")
        place += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
        if block & 1:
            return place + checksum
    return len(data) + 1


def archive_dictionary(data: memoryview) -> zstandard.ZstdCompressionDict | None:
    """The dictionary in the leading skippable frame, which may be compressed itself; None if there is none."""
    if data[:4] != DICTIONARY_MAGIC:
        return None
    content = bytes(data[8:frame_end(data, 0)])
    if content[:4] == FRAME_MAGIC:
        content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
    return zstandard.ZstdCompressionDict(content)


def _headers(head: bytes) -> dict[bytes, bytes]:
    found = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("header without a colon")
        found[name.strip().lower()] = value.strip()
    return found


def _whole_number(value: bytes | None, what: str) -> int:
    if value is None or not value.isdigit():
        raise ValueError(f"{what} is no number")
    return int(value)


def sha1_hex(labelled: bytes) -> str:
    """A labelled SHA-1 digest, in base 32 or 16, as lower-case hex."""
    label, _, digest = labelled.decode("ascii", "replace").partition(":")
    if label.lower() != "sha1":
        raise ValueError("digest is no SHA-1")
    return digest.lower() if len(digest) == 40 else base64.b32decode(digest.upper()).hex()


def parsed_record(content: bytes) -> dict:
    """The fields of one decoded record; a ValueError says what is wrong with it."""
    head, empty_line, rest = content.partition(END)
    if not empty_line or head.split(b"\r\n", 1)[0] not in VERSIONS:
        raise ValueError("no WARC header")
    headers = _headers(head)
    for name in MANDATORY:
        if not headers.get(name):
            raise ValueError(f"{name.decode()} is missing")
    length = _whole_number(headers[b"content-length"], "content-length")
    if len(rest) != length + len(END) or not rest.endswith(END):
        raise ValueError(f"block of {len(rest) - len(END)} bytes in place of {length}")
    block = rest[:length]
    text = {name: value.decode("utf-8", "replace") for name, value in headers.items()}
    record = {
        "record_id": text[b"warc-record-id"], "record_type": text[b"warc-type"], "target_uri": text.get(b"warc-target-uri"),
        "page_id": _whole_number(headers[b"x-page-id"].removeprefix(b"-"), "x-page-id") * (-1 if headers[b"x-page-id"][:1] == b"-" else 1)
        if b"x-page-id" in headers else None,
        "refers_to_record": text.get(b"warc-refers-to"), "payload": None, "payload_bytes": None, "payload_digest": None}
    if not headers.get(b"content-type", b"").startswith(b"application/http"):
        return record
    http, empty_line, payload = block.partition(END)
    if not empty_line or not http.startswith(b"HTTP/"):
        raise ValueError("no HTTP header")
    record["payload_bytes"] = _whole_number(_headers(http).get(b"content-length"), "the payload's length")
    if b"warc-payload-digest" in headers:
        record["payload_digest"] = sha1_hex(headers[b"warc-payload-digest"])
    if record["record_type"] == "revisit":
        if payload or not record["refers_to_record"]:
            raise ValueError("revisit with a payload or without a record to refer to")
        return record
    record["payload"] = payload
    if len(payload) != record["payload_bytes"]:
        raise ValueError(f"payload of {len(payload)} bytes in place of {record['payload_bytes']}")
    if record["payload_digest"] not in (None, hashlib.sha1(payload, usedforsecurity=False).hexdigest()):
        raise ValueError("payload has another digest")
    return record


def archive_records(data: bytes) -> Iterator[dict]:
    """The records of one archive in order; of a damaged one only its ``problem``.

    Without a readable frame header there is no way to the next frame: the rest is one problem.
    """
    view, start = memoryview(data), 0
    decompressor = zstandard.ZstdDecompressor(dict_data=archive_dictionary(view))
    while start < len(view):
        try:
            end = frame_end(view, start)
        except (ValueError, zstandard.ZstdError) as error:
            yield {"problem": f"at byte {start}: {error}"}
            return
        if end > len(view):
            yield {"problem": f"at byte {start}: frame is cut off"}
            return
        if view[start:start + 4] == FRAME_MAGIC:
            try:
                yield parsed_record(decompressor.decompressobj().decompress(view[start:end])) | {"problem": None}
            except (ValueError, zstandard.ZstdError) as error:
                yield {"problem": f"at byte {start}: {error}"}
        start = end


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives that the manifest below ``path`` names, validated, one row each.

    Without ``payloads`` that column is null; payloads are checked in either case. What is wrong is in ``problem``, with the
    record's other columns null; an archive with another number of records than the manifest says has a row of its own. A
    manifest of no archives gives no rows.
    """
    manifest = spark.read.parquet(f"{path.rstrip('/')}/manifest").select("archive", "records")
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(f"{path.rstrip('/')}/archives")
        .select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content"))
    schema = pa.schema([
        ("archive", pa.string()), ("record", pa.int32()), ("record_id", pa.string()), ("record_type", pa.string()),
        ("target_uri", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("refers_to_record", pa.string()), ("payload", pa.binary()), ("problem", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, records, content in zip(*batch.columns, strict=True):
                name, rows, held, number = archive.as_py(), [], 0, -1
                for number, record in enumerate(archive_records(content.as_py())):
                    held += len(record.get("payload") or b"") if payloads else 0
                    if not payloads:
                        record.pop("payload", None)
                    rows.append({"archive": name, "record": number, **record})
                    if len(rows) >= 4096 or held >= 16 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if number + 1 != records.as_py():
                    rows.append({"archive": name, "problem": f"{number + 1} records in place of {records}"})
                yield pa.RecordBatch.from_pylist(rows, schema)

    # The names are sent to the archives, or both joined by name; archives that are gone are told by their names alone.
    found = files.join(_send(manifest, manifest.count()), "archive").select("archive", "records", "content").mapInArrow(read, RECORD)
    gone = manifest.join(files.select("archive"), "archive", "left_anti").select("archive", F.lit("archive is missing").alias("problem"))
    return found.unionByName(gone, allowMissingColumns=True)


def _or_error(wrong: Column, message: Column, value: str) -> Column:
    return F.when(wrong, F.raise_error(message)).otherwise(F.col(value))


def page_records(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of each response and revisit that was read.

    The response that a revisit names is looked up by its record id, and must have the same length and digest. A problem
    found by the reader is an error here, as is a revisit without its response.
    """
    narrow = stored(records.drop("payload").withColumn(
        "record_type", _or_error(F.col("problem").isNotNull(), F.concat_ws(": ", "archive", "problem"), "record_type")), "records")
    fields = ["page_id", "payload_bytes", "payload_digest"]
    responses = narrow.filter("record_type = 'response'")
    revisits = narrow.filter("record_type = 'revisit'")
    named = stored(revisits.select(F.col("refers_to_record").alias("record_id")).distinct(), "named")
    few = named.count()
    # Rows that repeat page and payload have one id.
    answers = responses.join(_send(named, few), "record_id", "left_semi").dropDuplicates(["record_id"]).select(
        F.col("record_id").alias("refers_to_record"), *(F.col(name).alias(f"{name}_named") for name in fields))
    found = revisits.join(_send(answers, few), "refers_to_record", "left")
    same = (F.col("payload_bytes") == F.col("payload_bytes_named")) & (F.col("payload_digest") == F.col("payload_digest_named"))
    refers_to = _or_error(
        ~F.coalesce(same, F.lit(False)), F.concat(F.lit("no such response: "), "refers_to_record"), "page_id_named")
    none = F.lit(None).cast("long")
    return responses.select(*fields, "record_type", none.alias("refers_to")).unionByName(
        found.select(*fields, "record_type", refers_to.alias("refers_to")))
