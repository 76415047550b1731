"""WARC archives whose records are compressed one by one with a shared Zstandard dictionary.

The dictionary is trained on a bounded sample of records and stands in a skippable frame at the start of every file;
each record is a frame of its own behind it. A file can so be read from its start by itself, and any record from its
offset with the dictionary.

Tasks write files to the shared folder under names of their own and return what they wrote; only files that a
successful task returned belong to the archive, so a repeated or lost attempt leaves nothing behind that is read.
"""

from __future__ import annotations

import base64
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_sample, query, table
from tidemark.session import cut_lineage, scratch_path

#: First four bytes of the frame that holds the dictionary.
DICTIONARY_FRAME = 0x184D2A5D
#: Bytes of the dictionary, and bound on the records and bytes of a record that it is trained on.
DICTIONARY_BYTES, SAMPLE_RECORDS, SAMPLE_BYTES = 64 << 10, 400, 16 << 10
#: Payloads from this size on are written once; later copies are revisits.
LEAST_REVISIT = 1000
#: Compressed bytes after which a task begins a new file.
FILE_BYTES = 256 << 20
#: So many repeated payloads are looked up by broadcast (some 60 bytes each), more by a shuffle.
BROADCAST_ROWS = 500_000
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}')}>"


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; ``digest`` is the payload's SHA-1 in hexadecimal. A revisit holds the answer's head alone."""
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page)}", f"WARC-Date: {_DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c for c in url if c not in "\r\n"))
    lines.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}")
    if revisit:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page: {refers_to}"]
    if page is not None:
        lines.append(f"X-Page: {page}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def file_start(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary


def filesystem(path: str):
    """The file system of a folder that all executors share, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path)


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of the samples; where they are too few for training, the samples themselves. Empty without any."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


_FILES = "path string, records long, bytes long"


def _write(folder: str, dictionary: bytes, level: int, file_bytes: int):
    def run(batches):
        import zstandard

        system, base = filesystem(folder)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=level, dict_data=shared)
        out, name, records, size = None, "", 0, 0
        for batch in batches:
            for page, url, payload, digest, refers, revisit in zip(*(batch.column(c) for c in range(6)), strict=True):
                if out is None:
                    name = f"{base}/{uuid.uuid4().hex}.warc.zst"
                    out, records, size = system.open_output_stream(name, compression=None), 0, 0
                    size += out.write(file_start(dictionary))
                frame = packer.compress(record(page.as_py(), url.as_py(), payload.as_py(), digest.as_py(), refers.as_py(), revisit.as_py()))
                size += out.write(frame)
                records += 1
                if size >= file_bytes:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"path": [name], "records": [records], "bytes": [size]})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [name], "records": [records], "bytes": [size]})

    return run


def read_records(stream):
    """(headers, block) of every record of one open file."""
    import io

    import zstandard

    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("the file does not start with a dictionary")
    dictionary = stream.read(size)
    plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    with io.BufferedReader(plain.stream_reader(stream, read_across_frames=True), 1 << 20) as lines:
        while version := lines.readline():
            if version != b"WARC/1.1\r\n":
                raise ValueError(f"no record begins with {version[:20]!r}")
            headers = {}
            while (line := lines.readline()) != b"\r\n":
                name, _, value = line.decode("utf-8", "surrogatepass").rstrip("\r\n").partition(": ")
                headers[name] = value
            block = lines.read(int(headers["Content-Length"]))
            if len(block) != int(headers["Content-Length"]) or lines.read(4) != b"\r\n\r\n":
                raise ValueError("a record is cut off")
            yield headers, block


def _read(batches):
    import hashlib

    for batch in batches:
        for path in batch.column("path").to_pylist():
            system, base = filesystem(path)
            rows: list = []
            with system.open_input_stream(base, compression=None) as stream:
                for headers, block in read_records(stream):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    revisit = headers["WARC-Type"] == "revisit"
                    told = base64.b32decode(headers["WARC-Payload-Digest"][5:]).hex()
                    size = int(head.rpartition(b"Content-Length: ")[2])
                    if not revisit and (hashlib.sha1(payload).hexdigest(), len(payload)) != (told, size):
                        raise ValueError("a payload does not match its digest")
                    page, refers = headers.get("X-Page"), headers.get("X-Refers-To-Page")
                    rows.append((int(page) if page else None, size, told, headers["WARC-Type"], int(refers) if refers else None))
                    if len(rows) >= 10_000:
                        yield _batch(rows)
                        rows = []
            yield _batch(rows)


def _batch(rows):
    cols = list(zip(*rows, strict=True)) or [()] * 5
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                      ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def archive(pages: DataFrame, folder: str, text: str = "html", key: str = "page_id", url: str = "url", level: int = 3,
            file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one record per row of ``pages`` below ``folder``; path, records and bytes of every file.

    A null or empty page is a record with an empty payload. Of equal payloads of ``LEAST_REVISIT`` bytes or more the row
    with the largest key is the response, rows that tie with it as well; rows without a key are responses. A null url is
    left out. Other columns are not looked at.
    """
    import zstandard  # noqa: F401  # fails here and not in a task where it is missing

    rows = pages.select(F.col(key).cast("long").alias("page"), F.col(url).cast("string").alias("url"),
                        F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "UTF-8").alias("payload")).withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= LEAST_REVISIT
    copies = cut_lineage(rows.where(large & F.col("page").isNotNull()).groupBy("digest").agg(
        F.max("page").alias("last"), F.min("page").alias("first")).where("first < last").select(F.col("digest").alias("of"), "last"))
    few = copies.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    # Rows that can be no revisit have a key of their own, so that a shuffle spreads them, equal payloads as well.
    wanted = F.when(large & F.col("page").isNotNull(), F.col("digest")).otherwise(F.concat(F.lit("-"), F.xxhash64("page", "url").cast("string")))
    joined = rows.withColumn("wanted", wanted).join(F.broadcast(copies) if few else copies, F.col("wanted") == F.col("of"), "left")
    revisit = F.coalesce(F.col("last") != F.col("page"), F.lit(False))
    ready = joined.select("page", "url", "payload", "digest", F.when(revisit, F.col("last")).alias("refers"), revisit.alias("revisit"))
    ids = bounded_sample(rows.select(F.col("page").alias("sample_id")).dropna().distinct(), "sample_id", SAMPLE_RECORDS)
    sample = rows.join(F.broadcast(ids), F.col("page") == F.col("sample_id")).select("page", "url", F.substring("payload", 1, SAMPLE_BYTES).alias("payload"), "digest")
    samples = [record(r["page"], r["url"], bytes(r["payload"]), r["digest"], None, False) for r in sorted(sample.collect(), key=lambda r: (r["page"], r["digest"]))]
    system, base = filesystem(folder)
    system.create_dir(base, recursive=True)
    return cut_lineage(ready.mapInArrow(_write(folder, train_dictionary(samples), level, file_bytes), _FILES))


def read_archive(files: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record in the files (column ``path``).

    Payloads are checked against their digests; a file that is cut off or altered raises.
    """
    return files.select("path").mapInArrow(
        _read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


OP7_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS n, sha1(body) AS h FROM p),
r AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY h) ELSE page_id END AS last FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
  CASE WHEN last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN last <> page_id THEN last END AS refers_to FROM r
"""


def written(spark: SparkSession, pages: DataFrame) -> DataFrame:
    return archive(pages, scratch_path(spark, "warc"))


@query("op7_warc", OP7_SQL)
def op7_warc(spark, sf_dir):
    return read_archive(written(spark, table(spark, sf_dir, "pages")))
