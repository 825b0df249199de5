"""Best-fit packing of token pieces into sequences of a fixed length."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelflow.llm.common import by_bytes, text_batches, text_or_empty
from labelflow.llm.tokens import WordEncoder, with_end
from labelflow.storage import materialise

#: Bytes of text encoded at once.
TEXT_BYTES = 4 << 20
#: Items that one task fits together (their sizes and places, some 100 MB).
ITEMS = 500_000
#: Bytes of rows, ids included, that one task holds to fit them together.
HELD_BYTES = 64 << 20
#: A sequence is nearly full, and final, with at most this share of it free.
NEARLY_FULL = 1 / 256
#: Rounds of tasks side by side go on while one closes at least this share of the
#: open sequences; then one task takes those that may still fit.
LEAST_GAIN = 0.02


def token_pieces(
    df: DataFrame, key: str, text: str, tokenizer: str, end_id: int, capacity: int,
    with_ids: bool = False,
) -> DataFrame:
    """Ids of each whole text and ``end_id``, cut into pieces of ``capacity``.

    Returns key, piece (from 0), start (the document's ids before it), length,
    ids_crc32 (of the ids as little-endian unsigned 32-bit integers) and, if
    asked for, ids. Only longer documents are cut; their last piece may be
    shorter. A null text is empty: one piece with the end id alone.
    """
    schema = T.StructType(
        [
            T.StructField("key", df.schema[key].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in by_bytes(batches, "text", TEXT_BYTES):
            encoder = encoder or WordEncoder(tokenizer)
            ids, bounds = with_end(*encoder.encode(batch.column("text")), end_id)
            lengths = np.diff(bounds)
            cuts = -(-lengths // capacity)
            row = np.repeat(np.arange(len(cuts)), cuts)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
            start = piece * capacity
            length = np.minimum(capacity, lengths[row] - start)
            raw = ids.astype("<u4", copy=False).tobytes()
            begin = bounds[row] + start
            crcs = [zlib.crc32(raw[4 * b : 4 * e]) for b, e in zip(begin, begin + length)]
            arrays = [
                batch.column("key").take(pa.array(row)),
                pa.array(piece.astype(np.int32)),
                pa.array(start.astype(np.int64)),
                pa.array(length.astype(np.int64)),
                pa.array(crcs, pa.int64()),
            ]
            if with_ids:
                places = np.concatenate([begin, bounds[-1:]]).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(places, ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return text_batches(df).select(
        F.col(key).alias("key"), text_or_empty(text).alias("text")
    ).mapInArrow(run, schema)


def fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit, largest first: each item's bin and offset, each bin's free space.

    A bit of one integer for each possible free space tells the tightest open
    bin in constant time.
    """
    order = np.argsort(-sizes, kind="stable")
    bin_of = np.empty(len(sizes), np.int64)
    offset = np.zeros(len(sizes), np.int64)
    free: list[int] = []
    with_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces = 0
    for item, size in zip(order.tolist(), sizes[order].tolist()):
        fitting = spaces >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            at = with_space[space].pop()
            if not with_space[space]:
                spaces ^= 1 << space
        else:
            at, space = len(free), capacity
            free.append(capacity)
        bin_of[item] = at
        offset[item] = capacity - space
        left = space - size
        free[at] = left
        if left:
            with_space[left].append(at)
            spaces |= 1 << left
    return bin_of, offset, np.array(free, np.int64)


def _fit_partition(capacity: int, level: int, size: str):
    """A function for mapInArrow: best fit within the partition, in groups of
    ITEMS rows or HELD_BYTES. Adds the bin, the place in it, and the bin's free space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []
        first = level << 56 | task << 32

        def fitted() -> Iterator[pa.RecordBatch]:
            nonlocal first
            rows = pa.Table.from_batches(held)
            sizes = rows.column(size).to_numpy()
            bin_of, offset, free = fit(sizes, capacity)
            rows = rows.append_column("_bin", pa.array(bin_of + first))
            rows = rows.append_column("_at", pa.array(offset))
            rows = rows.append_column("_free", pa.array(free[bin_of]))
            first += len(free)
            held.clear()
            yield from rows.combine_chunks().to_batches(max_chunksize=50_000)

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= ITEMS or sum(b.nbytes for b in held) >= HELD_BYTES:
                yield from fitted()
        if held:
            yield from fitted()

    return run


def _with_bins(schema: T.StructType) -> T.StructType:
    added = [T.StructField(n, T.LongType()) for n in ("_bin", "_at", "_free")]
    return T.StructType([*schema.fields, *added])


def _open_bins(placed: DataFrame, capacity: int) -> DataFrame:
    """Underfull bins, once each."""
    return (
        placed.where(F.col("_free") > math.floor(capacity * NEARLY_FULL))
        .groupBy(F.col("_bin").alias("_item"))
        .agg((F.lit(capacity) - F.max("_free")).alias("_size"))
    )


def _shortest(left: DataFrame, capacity: int) -> DataFrame | None:
    """The ITEMS shortest of the open sequences, or None if no two fit into one.

    Only the number of sequences of each size reaches the driver.
    """
    counts = sorted(tuple(r) for r in left.groupBy("_size").count().collect())
    two = [size for size, n in counts[:2] for _ in range(min(n, 2))][:2]
    if len(two) < 2 or sum(two) > capacity:
        return None
    room = max(2, ITEMS)
    for size, n in counts:
        if n > room:
            break
        room -= n
    else:
        return left
    some = left.where(F.col("_size") == size).limit(room)
    return left.where(F.col("_size") < size).union(some)


def pack(pieces: DataFrame, size: str, capacity: int) -> DataFrame:
    """Put each row, as an item of ``size``, into a sequence of ``capacity``.

    Adds sequence_id (any number, the same for the items of a sequence) and
    offset (without gaps from 0). Hierarchical residual packing: every
    partition is packed best fit, largest first; nearly full sequences are
    final, and the underfull ones, as items, are packed again by fewer tasks,
    round by round, until one task has seen all that is open. When rounds of
    several tasks close little more, one task takes the ITEMS shortest open
    sequences, again and again until the two shortest do not fit into one, and
    so no two. Only (bin, size) pairs of underfull sequences move between rounds.

    Sizes are from 1 to ``capacity``. Rows of equal size keep their order;
    repeated rows are items of their own. An empty table gives an empty table.
    ``pieces`` must not have columns _bin, _at, _free, sequence_id or offset.
    """
    spark = pieces.sparkSession
    stored = materialise(pieces)
    placed = materialise(
        stored.mapInArrow(_fit_partition(capacity, 0, size), _with_bins(stored.schema))
    )
    item = T.StructType([T.StructField(n, T.LongType()) for n in ("_item", "_size")])
    moves: list[DataFrame] = []
    left = materialise(_open_bins(placed, capacity))
    count = left.count()
    tasks = math.ceil(count / ITEMS) if count > 1 else 0

    def merge(dealt: DataFrame) -> DataFrame:
        merged = materialise(
            dealt.sortWithinPartitions("_item").mapInArrow(
                _fit_partition(capacity, len(moves) + 1, "_size"), _with_bins(item)
            )
        )
        moves.append(merged)
        return _open_bins(merged, capacity)

    while tasks:
        left = materialise(merge(left.repartition(tasks, F.xxhash64("_item", F.lit(len(moves))))))
        before, count = count, left.count()
        if tasks == 1 or count > before * (1 - LEAST_GAIN):
            break
        tasks = math.ceil(count / ITEMS)
    while tasks > 1:
        shortest = _shortest(left, capacity)
        if shortest is None:
            break
        shortest = materialise(shortest)
        others = left.join(shortest.select("_item"), "_item", "left_anti")
        left = materialise(others.unionByName(merge(shortest.repartition(1))))
    result = placed.withColumnsRenamed({"_bin": "_first", "_at": "_offset"}).drop("_free")
    if not moves:
        return result.withColumnsRenamed({"_first": "sequence_id", "_offset": "offset"})
    # Where each open bin of the first round went in the end.
    root = moves[0].select(F.col("_item").alias("_first"), F.col("_bin"), F.col("_at"))
    for later in moves[1:]:
        step = later.select(
            F.col("_item").alias("_bin"), F.col("_bin").alias("_to"), F.col("_at").alias("_by")
        )
        root = root.join(step, "_bin", "left").select(
            "_first",
            F.coalesce("_to", "_bin").alias("_bin"),
            (F.col("_at") + F.coalesce("_by", F.lit(0))).alias("_at"),
        )
    root = materialise(root) if len(moves) > 1 else root
    return result.join(root, "_first", "left").select(
        *stored.columns,
        F.coalesce("_bin", "_first").alias("sequence_id"),
        (F.col("_offset") + F.coalesce("_at", F.lit(0))).alias("offset"),
    )


def pack_documents(
    df: DataFrame, key: str, text: str, tokenizer: str, end_id: int, capacity: int,
    with_ids: bool = False,
) -> DataFrame:
    """``token_pieces`` of all documents, packed: one row per piece.

    Null keys, repeated rows and rows with equal keys are documents of their
    own. Other columns of ``df``, whatever their names, are not read.
    """
    pieces = token_pieces(df, key, text, tokenizer, end_id, capacity, with_ids)
    return pack(pieces, "length", capacity)
