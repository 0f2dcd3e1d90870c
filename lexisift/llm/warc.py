"""WARC archives compressed record by record with a Zstandard dictionary of their own.

Each task writes files ``*.warc.zst``: a skippable frame (magic 0x184D2A5D) that holds a dictionary trained on
the file's own records, and then one Zstandard frame for each record, so that records can be read alone. Of
pages with equal payloads one is archived as a response and the others as revisits that refer to it; which
one is settled over digests and page_ids alone before anything is written: only rows of one page_id and digest
bring their payloads together, so a page that a third of all rows hold is no group.
"""

from __future__ import annotations

import re
import struct

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexisift.llm.common import fresh_path, materialise, table
from lexisift.llm.token_counts import open_store

DICTIONARY_MAGIC = 0x184D2A5D
DICTIONARY_BYTES = 64 << 10
#: A file's dictionary is trained on its first records up to this many bytes; a bound of the sample, not of the file.
TRAINING_BYTES = 4 << 20
FILE_BYTES = 64 << 20
LEAST_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIELDS = "page_id long, record_type string, target_uri string, refers_to long, payload_digest string, payload_bytes long, payload binary"


def _clean(value: str) -> str:
    return re.sub(r"[\r\n\x00]", lambda m: f"%{ord(m[0]):02X}", value)


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    block = http + payload
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
        block = http
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train(records: list[bytes], size: int = DICTIONARY_BYTES):
    """A dictionary for the records, or None where there are too few to train one."""
    import zstandard

    try:
        return zstandard.train_dictionary(min(size, max(256, sum(map(len, records)) // 8)), records, k=256, d=8)
    except zstandard.ZstdError:
        return None


class ArchiveWriter:
    """One file: records wait until the dictionary's sample is full, then all go out frame by frame."""

    def __init__(self, stream, level: int = 3):
        self.stream, self.level, self.waiting, self.held, self.written, self.compressor = stream, level, [], 0, 0, None

    def add(self, record: bytes) -> None:
        if self.compressor:
            self._put(record)
            return
        self.waiting.append(record)
        self.held += len(record)
        if self.held >= TRAINING_BYTES:
            self._start()

    def _start(self) -> None:
        import zstandard

        trained = train(self.waiting)
        if trained is not None:
            raw = trained.as_bytes()
            self.stream.write(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
        self.compressor = zstandard.ZstdCompressor(level=self.level, dict_data=trained)
        for record in self.waiting:
            self._put(record)
        self.waiting = []

    def _put(self, record: bytes) -> None:
        frame = self.compressor.compress(record)
        self.written += len(frame)
        self.stream.write(frame)

    def close(self) -> None:
        if self.waiting:
            self._start()
        self.stream.close()


def read_records(stream):
    """(headers, block) of each record of an archive opened for reading; the dictionary is found at its start."""
    import zstandard

    head = stream.read(8)
    trained = None
    if len(head) == 8 and struct.unpack("<II", head)[0] == DICTIONARY_MAGIC:
        raw = stream.read(struct.unpack("<II", head)[1])
        if raw[:4] == b"\x28\xb5\x2f\xfd":
            raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
        trained = zstandard.ZstdCompressionDict(raw)
    else:
        stream.seek(0)
    reader = zstandard.ZstdDecompressor(dict_data=trained).stream_reader(stream, read_across_frames=True)
    data = bytearray()

    def more() -> bool:
        part = reader.read(1 << 20)
        data.extend(part)
        return bool(part)

    at = 0
    while True:
        while (end := data.find(b"\r\n\r\n", at)) < 0:
            if not more():
                if data[at:].strip():
                    raise ValueError("an archive ends inside a record")
                return
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        size = int(headers["Content-Length"])
        while len(data) < end + 8 + size:
            if not more():
                raise ValueError("an archive ends inside a record")
        yield headers, bytes(data[end + 4 : end + 4 + size])
        at = end + 8 + size
        if at > 4 << 20:
            del data[:at]
            at = 0


def with_revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """pages with payload (binary), digest and refers_to (null for responses).

    Of records with equal payloads of at least ``least`` bytes the smallest page_id is the response; rows that share
    that smallest page_id are all responses. A null page_id is never the smallest; if all are null all are responses.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload")).withColumn("digest", F.sha2("payload", 256))
    slim = rows.where(F.octet_length("payload") >= least).select("page_id", "digest").distinct()
    first = slim.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL").drop("n")
    revisits = slim.join(first, "digest").where(~F.col("first").eqNullSafe(F.col("page_id"))).select(F.col("page_id").alias("id"), F.col("digest").alias("own"), "first")
    # written first, so that its size is known: few revisits are broadcast, and payloads are then not shuffled
    revisits = materialise(revisits, "revisits")
    joined = rows.join(revisits, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("own")), "left")
    return joined.select("page_id", "url", "payload", "digest", F.col("first").alias("refers_to"))


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write records (see with_revisits) as archives in a shared folder; return their names and record counts.

    Files are named after task attempts and listed in ``folder/files`` by the attempts that counted, so what a
    failed or doubled attempt left is never read.
    """
    spark = records.sparkSession

    def run(batches):
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        context, number, writer, count, name = TaskContext.get(), 0, None, 0, ""
        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*[batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to")]):
                if writer is None:
                    name = f"pages-{context.partitionId():06d}-{context.taskAttemptId()}-{number:04d}.warc.zst"
                    writer, count, number = ArchiveWriter(store.open_output_stream(f"{root}/{name}", compression=None)), 0, number + 1
                writer.add(make_record(page_id.as_py(), url.as_py(), payload.as_py(), digest.as_py(), refers_to.as_py()))
                count += 1
                if writer.written >= FILE_BYTES:
                    writer.close()
                    writer = None
                    yield pa.RecordBatch.from_pydict({"file": [name], "n_records": pa.array([count], pa.int64())})
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "n_records": pa.array([count], pa.int64())})

    records.mapInArrow(run, "file string, n_records long").write.parquet(f"{folder}/files")
    return spark.read.parquet(f"{folder}/files")


def read_archives(files: DataFrame, folder: str) -> DataFrame:
    """One row for each record of the archives named in column ``file``; a revisit has no payload of its own.

    payload_bytes is the length of the full payload: a response's own, a revisit's by its archived HTTP header.
    """

    def page(urn: str | None) -> int | None:
        number = urn[len("<urn:page:") : -1] if urn else ""
        return int(number) if number else None

    def rows(names):
        store, root = open_store(folder)
        for name in names:
            with store.open_input_file(f"{root}/{name}") as f:
                for headers, block in read_records(f):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    kind = headers["WARC-Type"]
                    size = int(re.search(rb"(?i)\r\nContent-Length: *(\d+)", http)[1])
                    yield (
                        page(headers["WARC-Record-ID"]), kind, headers.get("WARC-Target-URI"), page(headers.get("WARC-Refers-To")),
                        headers["WARC-Payload-Digest"].removeprefix("sha256:"), size, payload if kind == "response" else None,
                    )

    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in FIELDS.split(", ")]

    def batch_of(some):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in some], k) for i, k in enumerate(kinds)], names=names)

    def run(batches):
        for batch in batches:
            some, size = [], 0
            for row in rows(batch.column("file").to_pylist()):
                some.append(row)
                size += len(row[-1] or b"") + 200
                if size >= 4 << 20:
                    yield batch_of(some)
                    some, size = [], 0
            if some:
                yield batch_of(some)

    numbered = files.select("file", (F.row_number().over(Window.orderBy("file")) - 1).alias("number"))  # a row for each archive
    return numbered.repartitionById(max(files.count(), 1), "number").select("file").mapInArrow(run, FIELDS)  # and a task


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived and read back; digests of responses are taken from the payload as read."""
    folder = fresh_path(spark, "archives")
    files = write_archives(with_revisits(table(spark, sf_dir, "pages")), folder)
    back = read_archives(files, folder)
    digest = F.when(F.col("record_type") == "response", F.sha2("payload", 256)).otherwise(F.col("payload_digest"))
    size = F.when(F.col("record_type") == "response", F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes"))
    return back.select("page_id", size.alias("payload_bytes"), digest.alias("payload_digest"), "record_type", "refers_to")


OP2_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
g AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT d.page_id, CAST(d.payload_bytes AS BIGINT) AS payload_bytes, d.payload_digest,
       CASE WHEN g.first_id IS NULL OR g.first_id = d.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN g.first_id <> d.page_id THEN g.first_id END AS refers_to
FROM d LEFT JOIN g ON d.payload_digest = g.payload_digest AND d.payload_bytes >= 100
"""
