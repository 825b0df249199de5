"""WARC archives with an index: write records, then read chosen ones by range."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelflow.llm.common import by_bytes, text_batches
from labelflow.llm.token_files import open_store
from labelflow.storage import materialise

#: Bytes of payloads in hand at once while writing.
WRITE_BYTES = 4 << 20
#: Neighbouring records are read together across gaps of at most GAP bytes, in
#: reads of at most READ bytes (or one record).
GAP, READ = 64 << 10, 4 << 20
#: Archives are read by tasks in stretches of this many bytes.
STRETCH = 64 << 20
#: The profile that WARC 1.1 names for revisits of an equal payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
INDEX = (
    "file string, offset long, length long, page_id long, url string, "
    "payload_digest string, payload_bytes long, record_type string"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(row))}>"


def _header_value(text: str) -> str:
    """Control characters and white space would end or split a header line."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def _record(row, date: str) -> tuple[bytes, str]:
    """One gzip member, and the payload's digest."""
    payload = row["payload"]
    digest = payload_digest(payload)
    revisit = row["first_row"] is not None
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(row["row"])),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if row["url"] is not None:
        headers.append(("WARC-Target-URI", _header_value(row["url"])))
    if row["page_id"] is not None:
        headers.append(("X-Page-ID", str(row["page_id"])))
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(row["first_row"]))]
        if row["first_page"] is not None:
            headers.append(("X-Refers-To-Page-ID", str(row["first_page"])))
    block = HTTP if revisit else HTTP + payload
    headers += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    packer = zlib.compressobj(6, wbits=31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush(), digest


def _parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one gzip member."""
    raw = zlib.decompress(member, wbits=31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    if not block.startswith(HTTP) or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return headers, block[len(HTTP) :]


def write_archives(
    pages: DataFrame, page_id: str, url: str, payload: str, folder: str,
    least_bytes: int = 0, date: str = "2000-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record per row into ``folder``; return the index of records.

    Of rows with equal payloads of at least ``least_bytes`` bytes the one with
    the largest page_id (null last; of equal ids, the last in storage) is a
    response, and the others are revisits of it; smaller payloads are all
    responses. Payloads are compared by SHA-1, counted with a partial aggregate;
    only digests that occur twice are joined back, both sides stored, so a very
    frequent payload is split. A task writes one archive under a name of its
    own and then renames it. Every record is a gzip member of its own.

    A null payload is empty. A null URL gives a record without target. An empty
    table gives an empty index. Other columns are not read.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    stored = materialise(
        text_batches(pages).select(
            F.col(page_id).cast("long").alias("page_id"),
            F.col(url).cast("string").alias("url"),
            body.alias("payload"),
            F.sha1(body).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    repeated = materialise(
        stored.where(F.octet_length("payload") >= least_bytes)
        .groupBy("digest")
        .agg(F.max(F.struct("page_id", "row")).alias("last"), F.count("*").alias("n"))
        .where("n > 1")
        .select(
            F.col("digest").alias("_digest"),
            F.col("last.page_id").alias("first_page"),
            F.col("last.row").alias("first_row"),
        )
    )
    of = F.col("first_row") != F.col("row")
    to_write = stored.join(repeated, F.col("digest") == F.col("_digest"), "left").select(
        "page_id", "url", "payload", "row",
        F.when(of, F.col("first_page")).alias("first_page"),
        F.when(of, F.col("first_row")).alias("first_row"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        name, offset, out = f"records-{task:05d}.warc.gz", 0, None
        found: list[tuple] = []
        for batch in by_bytes(batches, "payload", WRITE_BYTES):
            if out is None:
                store, path = open_store(folder)
                store.create_dir(path, recursive=True)
                out = store.open_output_stream(f"{path}/_{attempt}-{name}", compression=None)
            for row in batch.to_pylist():
                member, digest = _record(row, date)
                out.write(member)
                kind = "response" if row["first_row"] is None else "revisit"
                found.append(
                    (name, offset, len(member), row["page_id"], row["url"], digest, len(row["payload"]), kind)
                )
                offset += len(member)
        if out is None:
            return
        out.close()
        store.move(f"{path}/_{attempt}-{name}", f"{path}/{name}")
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        fields = ["file", "offset", "length", "page_id", "url", "payload_digest", "payload_bytes", "record_type"]
        for at in range(0, len(found), 10_000):
            columns = zip(*found[at : at + 10_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=fields
            )

    to_write.mapInArrow(run, INDEX).write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def read_records(index: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records that rows of ``index`` (file, offset, length, payload_digest)
    name, from the archives: page_id, url, payload_bytes, payload_digest,
    record_type, refers_to and, if asked for, payload (null for revisits).

    The rows are sorted by place and neighbours are read in one range. A
    response's digest and length are computed from what was read; a record that
    differs from its header or from the index fails the task. A row of
    ``index`` that repeats gives its record again.
    """
    schema = (
        "page_id long, url string, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long" + ", payload binary" * with_payload
    )
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    if with_payload:
        names, types = [*names, "payload"], [*types, pa.binary()]

    def row(member: bytes, expected: str) -> tuple:
        headers, payload = _parse(member)
        kind = headers["WARC-Type"]
        size, digest = int(headers["X-Payload-Length"]), headers["WARC-Payload-Digest"][5:]
        right = (size, digest)
        if kind == "response":
            size, digest = len(payload), payload_digest(payload)
        if (size, digest) != right or digest != expected:
            raise ValueError("a record's payload is not the indexed one")
        page, refers = headers.get("X-Page-ID"), headers.get("X-Refers-To-Page-ID")
        values = (
            None if page is None else int(page),
            headers.get("WARC-Target-URI"),
            size,
            digest,
            kind,
            None if refers is None else int(refers),
        )
        return (*values, payload if kind == "response" else None) if with_payload else values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(folder)
        name = file = None
        for batch in batches:
            files, offsets, lengths, digests = (
                batch.column(c).to_pylist() for c in ("file", "offset", "length", "payload_digest")
            )
            at = 0
            while at < len(files):
                end, last = at + 1, offsets[at] + lengths[at]
                while (
                    end < len(files)
                    and files[end] == files[at]
                    and offsets[end] - last <= GAP
                    and offsets[end] + lengths[end] - offsets[at] <= READ
                ):
                    last = max(last, offsets[end] + lengths[end])
                    end += 1
                if files[at] != name:
                    name = files[at]
                    file = store.open_input_file(f"{path}/{name}")
                begin = offsets[at]
                raw = file.read_at(last - begin, begin)
                rows = [
                    row(raw[o - begin : o - begin + n], d)
                    for o, n, d in zip(offsets[at:end], lengths[at:end], digests[at:end])
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names
                )
                at = end

    stretch = F.floor(F.col("offset") / STRETCH)
    return (
        index.select("file", "offset", "length", "payload_digest")
        .repartition("file", stretch)
        .sortWithinPartitions("file", "offset")
        .mapInArrow(run, schema)
    )
