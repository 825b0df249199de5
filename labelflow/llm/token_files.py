"""Binary files of token ids with keyed access in constant time.

A folder holds, for each shard, ``ids-NNNNN.bin`` (the ids of its documents one
after the other, little-endian, unsigned 16 or 32 bit) and ``ids-NNNNN.idx``
(a minimal perfect hash of its keys and the place of each document), and one
Parquet table ``manifest`` with a row per shard.

Index file: eight bytes with the length of a JSON header, the header, then the
arrays it names, in its order. The hash function has levels of bit arrays (as
in BBHash): a key that is alone at its place of a level is settled there, the
others go to the next level; a key's slot is the number of set bits before its
place. Each slot stores a fingerprint of its key, so that an unknown key is
told apart (but for one in 2**32), and the key's first record and number of
records.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelflow.llm.common import by_bytes, text_batches, text_or_empty
from labelflow.llm.tokens import WordEncoder, with_end

#: Bytes of text encoded at once, and of ids read at once.
TEXT_BYTES = 4 << 20
READ_BYTES = 8 << 20
#: Levels of a hash function; the few keys that are left then are listed.
LEVELS = 24
MANIFEST = (
    "shard int, records long, ids long, nulls long, least long, most long, start long"
)


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder named as Spark names it, and its path there."""
    if "://" in uri or uri.startswith("file:"):
        if uri.startswith("file:/") and not uri.startswith("file://"):
            uri = "file://" + uri[len("file:") :]
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """Well-mixed 64-bit hashes (the splitmix64 finalizer)."""
    x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """A minimal perfect hash function of distinct 64-bit keys."""

    def __init__(self, bits: list[np.ndarray], rest: np.ndarray):
        self.bits = bits
        self.rest = rest
        #: Set bits before each level's bytes, over all levels.
        self.before: list[np.ndarray] = []
        total = 0
        for level in bits:
            counts = np.cumsum(np.bitwise_count(level).astype(np.int64))
            self.before.append(np.concatenate([[0], counts])[:-1] + total)
            total += int(counts[-1]) if len(counts) else 0
        self.settled = total

    @staticmethod
    def build(keys: np.ndarray) -> PerfectHash:
        bits, left = [], keys.astype(np.int64)
        for level in range(LEVELS):
            if not len(left):
                break
            places = 8 * -(-len(left) * 2 // 8)
            at = (_mix(left, level) % np.uint64(places)).astype(np.int64)
            alone = np.bincount(at, minlength=places) == 1
            bits.append(np.packbits(alone, bitorder="little"))
            left = left[~alone[at]]
        return PerfectHash(bits, np.sort(left))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for some keys that were not given."""
        slot = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, bits in enumerate(self.bits):
            at = (_mix(keys[open_], level) % np.uint64(8 * len(bits))).astype(np.int64)
            byte, bit = bits[at >> 3], (at & 7).astype(np.uint8)
            hit = (byte >> bit) & 1 == 1
            lower = byte & ((np.uint16(1) << bit) - 1).astype(np.uint8)
            rank = self.before[level][at >> 3] + np.bitwise_count(lower)
            slot[open_[hit]] = rank[hit]
            open_ = open_[~hit]
        if len(self.rest) and len(open_):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            found = self.rest[at] == keys[open_]
            slot[open_[found]] = self.settled + at[found]
        return slot


def _fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 1000) >> np.uint64(32)).astype(np.uint32)


def index_bytes(keys: np.ndarray, nulls: int, bounds: np.ndarray, width: int) -> bytes:
    """The index file of one shard. ``keys``: of the records after the first
    ``nulls``, ascending; ``bounds``: where each record's ids begin, and the end."""
    distinct, first, count = np.unique(keys, return_index=True, return_counts=True)
    hashed = PerfectHash.build(distinct)
    slot = hashed.slots(distinct)
    by_slot = np.argsort(slot)
    arrays = {f"level{i}": bits for i, bits in enumerate(hashed.bits)} | {
        "rest": hashed.rest,
        "fingerprint": _fingerprints(distinct)[by_slot],
        "first": (first + nulls).astype(np.int64)[by_slot],
        "count": count.astype(np.int64)[by_slot],
        "bounds": bounds.astype(np.int64),
    }
    header = json.dumps(
        {
            "width": width,
            "nulls": nulls,
            "arrays": [[n, a.dtype.newbyteorder("<").str, len(a)] for n, a in arrays.items()],
        }
    ).encode()
    parts = [len(header).to_bytes(8, "little"), header]
    return b"".join(parts + [a.astype(a.dtype.newbyteorder("<")).tobytes() for a in arrays.values()])


class ShardReader:
    """Keyed access to one shard."""

    def __init__(self, folder: str, shard: int):
        store, path = open_store(folder)
        self.file = store.open_input_file(f"{path}/ids-{shard:05d}.bin")
        with store.open_input_stream(f"{path}/ids-{shard:05d}.idx") as f:
            raw = f.read()
        size = int.from_bytes(raw[:8], "little")
        header = json.loads(raw[8 : 8 + size])
        at, arrays = 8 + size, {}
        for name, dtype, length in header["arrays"]:
            arrays[name] = np.frombuffer(raw, dtype, length, at)
            at += arrays[name].nbytes
        levels = sum(name.startswith("level") for name in arrays)
        self.hashed = PerfectHash([arrays[f"level{i}"] for i in range(levels)], arrays["rest"])
        self.arrays, self.width, self.nulls = arrays, header["width"], header["nulls"]
        self.bounds = arrays["bounds"]

    def records(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First record and number of records (0: unknown) of each key."""
        slot = self.hashed.slots(keys)
        if not len(self.arrays["fingerprint"]):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        known = (slot >= 0) & (self.arrays["fingerprint"][slot] == _fingerprints(keys))
        return (
            np.where(known, self.arrays["first"][slot], 0),
            np.where(known, self.arrays["count"][slot], 0),
        )

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids of the records from ``first`` up to ``last``, excluded."""
        begin, end = int(self.bounds[first]), int(self.bounds[last])
        raw = self.file.read_at((end - begin) * self.width, begin * self.width)
        return np.frombuffer(raw, f"<u{self.width}").astype(np.uint32)


def write_token_files(
    df: DataFrame, key: str, text: str, tokenizer: str, end_id: int, folder: str,
    shards: int | None = None,
) -> DataFrame:
    """Encode all texts, and ``end_id`` after each, into ``folder``; its manifest.

    Records stand in ascending order of ``key`` (long; nulls first) over all
    shards; rows of one key are ordered by their texts' hash, so that a shard
    border may fall inside a very frequent key. ``start`` of a shard is the
    number of ids before it. One sample and one shuffle, by key range; every
    task writes its shard under a name of its own and then renames it, so a
    repeated task does no harm. The driver sees one row per shard.

    A null text is empty: its record is the end id alone. Empty tables have a
    manifest without rows. Other columns are not read.
    """
    spark = df.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        attempt = TaskContext.get().taskAttemptId()
        store = out = None
        keys, lengths, nulls = [], [], 0
        for batch in by_bytes(batches, "text", TEXT_BYTES):
            if out is None:
                store, path = open_store(folder)
                store.create_dir(path, recursive=True)
                name = f"{path}/ids-{shard:05d}"
                own = f"{path}/_{attempt}-{shard:05d}"
                encoder = WordEncoder(tokenizer)
                width = 2 if max(encoder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
                out = store.open_output_stream(f"{own}.bin")
            ids, bounds = with_end(*encoder.encode(batch.column("text")), end_id)
            out.write(ids.astype(f"<u{width}").tobytes())
            lengths.append(np.diff(bounds))
            column = batch.column("key")
            nulls += column.null_count
            keys.append(column.drop_null().to_numpy(zero_copy_only=False).astype(np.int64))
        if out is None:
            return
        out.close()
        every = np.concatenate(keys)
        bounds = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
        with store.open_output_stream(f"{own}.idx") as f:
            f.write(index_bytes(every, nulls, bounds, width))
        for end in ("bin", "idx"):
            store.move(f"{own}.{end}", f"{name}.{end}")
        least, most = (int(every[0]), int(every[-1])) if len(every) else (None, None)
        row = [shard, len(bounds) - 1, int(bounds[-1]), nulls, least, most, 0]
        types = [pa.int32(), *[pa.int64()] * 6]
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(row, types)],
            names=["shard", "records", "ids", "nulls", "least", "most", "start"],
        )

    rows = (
        text_batches(df)
        .select(F.col(key).cast("long").alias("key"), text_or_empty(text).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(shards, "key", "tie")
        .sortWithinPartitions("key", "tie")
        .select("key", "text")
        .mapInArrow(run, MANIFEST)
        .collect()
    )
    rows = sorted(rows, key=lambda r: r["shard"])
    starts = accumulate((r["ids"] for r in rows), initial=0)
    rows = [Row(**(r.asDict() | {"start": start})) for r, start in zip(rows, starts)]
    manifest = spark.createDataFrame(rows, MANIFEST).coalesce(1)
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_token_files(
    spark: SparkSession, folder: str, keys: DataFrame, key: str, with_ids: bool = False
) -> DataFrame:
    """The records of all given keys: key, start (ids before it in all files),
    n_tokens, ids_crc32 and, if asked for, ids.

    ``keys`` may repeat and may be null (the records without a key); each
    distinct key is looked up once, in the shards whose range holds it, by the
    shard's perfect hash. Unknown keys give no row. Records found next to each
    other are read in one piece of at most READ_BYTES (or one record).
    """
    found = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").collect()
    found = sorted(found, key=lambda r: r["shard"])  # one row per shard
    numbers = [r["shard"] for r in found]
    starts = {r["shard"]: r["start"] for r in found}
    with_nulls = [r["shard"] for r in found if r["nulls"]]
    keyed = [r for r in found if r["least"] is not None]
    least = np.array([r["least"] for r in keyed], np.int64)
    most = np.array([r["most"] for r in keyed], np.int64)
    shard_of = np.array([r["shard"] for r in keyed], np.int32)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            values = column.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
            low = np.searchsorted(most, values, "left")
            high = np.searchsorted(least, values, "right")
            times = np.maximum(high - low, 0)
            at = np.repeat(low - (np.cumsum(times) - times), times) + np.arange(times.sum())
            nulls = with_nulls if column.null_count else []
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays(
                        [pa.array(np.repeat(values, times)), pa.nulls(len(nulls), pa.int64())]
                    ),
                    pa.array(np.concatenate([shard_of[at], np.array(nulls, np.int32)])),
                ],
                names=["key", "shard"],
            )

    schema = T.StructType(
        [
            T.StructField("key", T.LongType()),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []),
        ]
    )

    def lookup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, current = None, None
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            edges = np.flatnonzero(np.diff(shards)) + 1
            for low, high in zip([0, *edges], [*edges, len(shards)]):
                if low == high:
                    continue
                if current != shards[low]:
                    current = int(shards[low])
                    reader = ShardReader(folder, current)
                yield from _read(reader, starts[current], batch.slice(low, high - low).column("key"))

    def _read(reader: ShardReader, start: int, keys: pa.Array) -> Iterator[pa.RecordBatch]:
        values = keys.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
        first, count = reader.records(values)
        record = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
        owner = np.repeat(values, count)
        order = np.argsort(record)
        record, owner = record[order], pa.array(owner[order])
        if keys.null_count:
            record = np.concatenate([np.arange(reader.nulls), record])
            owner = pa.concat_arrays([pa.nulls(reader.nulls, pa.int64()), owner])
        at = 0
        while at < len(record):
            end = at + 1
            while (
                end < len(record)
                and record[end] == record[end - 1] + 1
                and (reader.bounds[record[end] + 1] - reader.bounds[record[at]]) * reader.width
                <= READ_BYTES
            ):
                end += 1
            some = record[at:end]
            ids = reader.ids(some[0], some[-1] + 1)
            begin = reader.bounds[some[0] : some[-1] + 2]
            inner = begin - begin[0]
            raw = ids.astype("<u4", copy=False).tobytes()
            crcs = [zlib.crc32(raw[4 * b : 4 * e]) for b, e in zip(inner, inner[1:])]
            arrays = [
                owner.slice(at, end - at),
                pa.array(start + begin[:-1]),
                pa.array(np.diff(begin)),
                pa.array(crcs, pa.int64()),
            ]
            if with_ids:
                arrays.append(
                    pa.ListArray.from_arrays(inner.astype(np.int32), ids.astype(np.int32))
                )
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
            at = end

    wanted = keys.select(F.col(key).cast("long").alias("key")).distinct()
    return (
        wanted.mapInArrow(route, "key long, shard int")
        .repartition(max(1, len(numbers)), "shard")
        .sortWithinPartitions("shard", "key")
        .mapInArrow(lookup, schema)
    )
