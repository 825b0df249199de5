"""Best-fit decreasing packing of documents into windows with little padding."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelflow.llm.common import by_bytes, text_batches, text_or_empty
from labelflow.llm.pieces import Encoder, blocks, split
from labelflow.storage import materialise

#: Bytes of text encoded at once.
TEXT_BYTES = 4 << 20
#: A window keeps up to this share of it free; only larger gaps are filled by cutting.
SLACK = 1 / 128


class OpenWindows:
    """Open windows by remaining capacity, under a segment tree.

    A leaf for each capacity tells how many windows have it, an inner node the
    sum of its two children: the tightest window with room for a size is found
    in time logarithmic in the capacity. Windows of one leaf are kept as runs of
    consecutive numbers that were filled alike.
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def add(self, space: int, first: int, count: int) -> None:
        if count:
            self.runs[space].append((first, count))
            self._change(space, count)

    def take(self, space: int) -> tuple[int, int]:
        first, count = self.runs[space].pop()
        self._change(space, -count)
        return first, count

    def _change(self, space: int, by: int) -> None:
        node = self.leaves + space
        while node:
            self.tree[node] += by
            node >>= 1

    def tightest(self, size: int) -> int | None:
        """The least remaining capacity of at least ``size`` that a window has."""
        node = self.leaves + size
        if self.tree[node]:
            return size
        while node > 1:
            if node % 2 == 0 and self.tree[node + 1]:
                node += 1
                break
            node //= 2
        else:
            return None
        while node < self.leaves:
            node *= 2
            if not self.tree[node]:
                node += 1
        return node - self.leaves


class Plan(NamedTuple):
    """Where the items of each size go. All arrays are short: they depend on the
    capacity, not on the number of items.

    ``moves``: size, first rank, rank behind the last, first window, items a
    window, offset in it. Sorted by size and rank.
    ``donors``: first window, count, fill, place in the stream; windows that are
    dissolved, their content strung together. Sorted by window.
    ``gaps``: place in the stream, gap, count, first window, offset in it. Sorted
    by place.
    """

    moves: np.ndarray
    donors: np.ndarray
    gaps: np.ndarray


def best_fit(counts: list[tuple[int, int]], capacity: int) -> tuple[list, OpenWindows, int]:
    """Best-fit decreasing of ``counts`` (size, number) items, all at once.

    The same as item by item: the tightest window stays the tightest while
    further items of the size fit into it, and windows filled alike are taken
    together. A run of windows halves its space each time it is taken, so the
    number of moves has a bound that depends on the capacity alone.
    """
    windows, moves, used = OpenWindows(capacity), [], 0
    for size, number in sorted(counts, reverse=True):
        rank = 0
        while rank < number:
            space = windows.tightest(size)
            each = (capacity if space is None else space) // size
            if space is None:
                space, first, count = capacity, used, -(-(number - rank) // each)
                used += count
            else:
                first, count = windows.take(space)
            whole, rest = divmod(number - rank, each)
            whole = min(whole, count)
            rest = rest if whole < count else 0
            placed = whole * each + rest
            moves.append((size, rank, rank + placed, first, each, capacity - space))
            windows.add(space - each * size, first, whole)
            if rest:
                windows.add(space - rest * size, first + whole, 1)
            behind = whole + (rest > 0)
            windows.add(space, first + behind, count - behind)
            rank += placed
    return moves, windows, used


def plan(counts: list[tuple[int, int]], capacity: int) -> Plan:
    """Best fit, then as few windows as possible are dissolved to fill the gaps.

    Windows with at most SLACK free, or filled to a power of two (which need no
    padding), stay as they are. Of the others, the emptiest are dissolved, just
    enough to fill the gaps of the rest; what is left over fills windows of its
    own, the very last of them cut into powers of two.
    """
    moves, windows, used = best_fit(counts, capacity)
    unfilled = []
    for space, runs in enumerate(windows.runs):
        fill = capacity - space
        if space > capacity * SLACK and fill & (fill - 1):
            unfilled += [(space, first, count) for first, count in runs]
    unfilled.sort()
    holes = sum(space * count for space, _, count in unfilled)
    donors, stream = [], 0
    while unfilled and stream < holes:
        space, first, count = unfilled.pop()
        fill = capacity - space
        # So many windows that their content fills what is then left of the gaps.
        some = min(count, -(-(holes - stream) // capacity))
        donors.append((first, some, fill, stream))
        stream += some * fill
        holes -= some * space
        if some < count:
            unfilled.append((space, first + some, count - some))
    gaps, place = [], 0
    for space, first, count in unfilled:
        gaps.append((place, space, count, first, capacity - space))
        place += space * count
    full, rest = divmod(stream - place, capacity)
    tail = [(1 << bit, 1) for bit in range(capacity.bit_length(), -1, -1) if rest >> bit & 1]
    for size, count in [(capacity, full), *tail]:
        if count:
            gaps.append((place, size, count, used, 0))
            used += count
            place += size * count

    def table(rows: list[tuple], columns: int) -> np.ndarray:
        return np.array(sorted(rows), np.int64).reshape(len(rows), columns).T

    return Plan(table(moves, 6), table(donors, 4), table(gaps, 5))


def place(
    chosen: Plan, sizes: np.ndarray, ranks: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of items given by size and rank within the size.

    Returns, for each piece: the item, the piece's start in it, length, window
    and offset in the window.
    """
    size, low, _, window, each, offset = chosen.moves
    # Ranks are below 2 ** 45, so size and rank make one sortable number.
    at = np.searchsorted((size << 45) | low, (sizes << 45) | ranks, "right") - 1
    step = ranks - low[at]
    windows = window[at] + step // each[at]
    offsets = offset[at] + step % each[at] * sizes
    items = np.arange(len(sizes))
    if not chosen.donors.shape[1]:
        return items, np.zeros(len(sizes), np.int64), sizes, windows, offsets
    first, count, fill, base = chosen.donors
    run = np.searchsorted(first, windows, "right") - 1
    given = (run >= 0) & (windows - first[run] < count[run])
    keep = ~given
    done = [(items[keep], np.zeros(keep.sum(), np.int64), sizes[keep], windows[keep], offsets[keep])]
    run = run[given]
    stream = base[run] + (windows[given] - first[run]) * fill[run] + offsets[given]
    item, left, begin = items[given], sizes[given], np.zeros(given.sum(), np.int64)
    where, gap, _, into, offset = chosen.gaps
    while len(item):
        run = np.searchsorted(where, stream, "right") - 1
        number, inside = np.divmod(stream - where[run], gap[run])
        length = np.minimum(left, gap[run] - inside)
        done.append((item, begin, length, into[run] + number, offset[run] + inside))
        more = left > length
        item, left, begin, stream = (
            item[more], (left - length)[more], (begin + length)[more], (stream + length)[more]
        )
    return tuple(np.concatenate(x) for x in zip(*done))


def encoded_pieces(
    df: DataFrame, key: str, text: str, tokenizer: str, end_id: int, capacity: int
) -> DataFrame:
    """Ids of each whole text and ``end_id``, cut into full windows and a rest.

    Returns key, start, doc_tokens, ids (as little-endian bytes, two or four
    each), part and nth: the task that made the piece, and how many pieces of the
    same length the task made before.
    """
    schema = T.StructType(
        [
            T.StructField("key", df.schema[key].dataType),
            T.StructField("start", T.LongType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("length", T.LongType()),
            T.StructField("part", T.LongType()),
            T.StructField("nth", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in by_bytes(batches, "text", TEXT_BYTES):
            encoder = encoder or Encoder(tokenizer)
            texts = batch.column("text")
            some, owner = blocks(texts, TEXT_BYTES)
            cut = len(some) > len(texts)
            held = [
                encoder.encode(*split(one, encoder.safe))
                for one in ([some.slice(i, 1) for i in range(len(some))] if cut else [some])
            ]
            ids = np.concatenate([found for found, _ in held])
            of_block = np.concatenate([np.diff(bounds) for _, bounds in held])
            counts = np.bincount(owner, of_block, len(texts)).astype(np.int64)
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, np.uint32(end_id))
            lengths = counts + 1
            bounds = np.concatenate([[0], np.cumsum(lengths)])
            cuts = -(-lengths // capacity)
            row = np.repeat(np.arange(len(cuts)), cuts)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * capacity
            length = np.minimum(capacity, lengths[row] - start)
            order = np.argsort(length, kind="stable")
            nth = np.empty(len(row), np.int64)
            new = np.bincount(length, minlength=capacity + 1)
            nth[order] = np.arange(len(row)) - np.repeat(np.cumsum(new) - new, new)
            nth += seen[length]
            seen += new
            raw = memoryview(ids.astype("<u2" if ids.max() < 1 << 16 else "<u4")).cast("B")
            wide = len(raw) // len(ids)
            places = np.concatenate([bounds[row] + start, bounds[-1:]]) * wide
            found = pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(pa.array(row)),
                    pa.array(start),
                    pa.array(lengths[row]),
                    pa.Array.from_buffers(
                        pa.large_binary(), len(row), [None, pa.py_buffer(places), pa.py_buffer(raw)]
                    ).cast(pa.binary()),
                    pa.array(length),
                    pa.array(np.full(len(row), part)),
                    pa.array(nth),
                ],
                names=schema.names,
            )
            # A few megabytes of ids at a time go back to Spark.
            yield from pa.Table.from_batches([found]).to_batches(max_chunksize=1000)

    return text_batches(df).select(
        F.col(key).alias("key"), text_or_empty(text).alias("text")
    ).mapInArrow(run, schema)


def _placed(capacity: int, chosen: Plan, with_ids: bool):
    """A function for mapInArrow: pieces with their numbers become pieces in windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("length").to_numpy()
            ranks = batch.column("rank").to_numpy()
            item, begin, length, window, offset = place(chosen, sizes, ranks)
            held = batch.column("ids").to_pylist()
            ids = np.concatenate(
                [np.frombuffer(h, f"<u{len(h) // n}").astype("<u4") for h, n in zip(held, sizes)]
            )
            low = (np.cumsum(sizes) - sizes)[item] + begin
            raw = ids.tobytes()
            crcs = [zlib.crc32(raw[4 * b : 4 * e]) for b, e in zip(low, low + length)]
            columns = {
                "key": batch.column("key").take(pa.array(item)),
                "start": pa.array(batch.column("start").to_numpy()[item] + begin),
                "length": pa.array(length),
                "ids_crc32": pa.array(crcs, pa.int64()),
                "doc_tokens": batch.column("doc_tokens").take(pa.array(item)),
                "sequence_id": pa.array(window),
                "offset": pa.array(offset),
            }
            if with_ids:
                values = [ids[b:e] for b, e in zip(low, low + length)]
                columns["ids"] = pa.array(values, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    return run


def pack_windows(
    df: DataFrame, key: str, text: str, tokenizer: str, end_id: int, capacity: int,
    with_ids: bool = False,
) -> DataFrame:
    """Documents packed into windows of ``capacity`` tokens, one row per piece.

    Returns key, start (the document's ids before the piece), length, ids_crc32
    (of the piece's ids as little-endian unsigned 32-bit integers), doc_tokens
    (with the end id), sequence_id, offset (there, without gaps from 0) and, if
    asked for, ids.

    Documents longer than a window are first cut into full windows. The rests
    are packed by best-fit decreasing over the whole table: only the number of
    rests of each length, at most ``capacity`` rows, reaches the driver; a
    segment tree over remaining capacities finds the tightest open window; and
    each rest finds its window by its rank among those of its length (its number
    within the task that encoded it, and the tasks before). No row of a hot
    length meets the others in one task. Then the emptiest windows are dissolved
    and cut to fill gaps of more than SLACK in others.

    A null or empty text has the end id alone. Null keys, repeated rows and rows
    with equal keys are documents of their own; an empty table gives an empty
    table; texts of any length are encoded in blocks that end where no token can
    reach across (a text without such places stays whole). Other columns of
    ``df``, whatever their names, are not read.
    """
    stored = materialise(encoded_pieces(df, key, text, tokenizer, end_id, capacity))
    made = materialise(stored.groupBy("length", "part").count())
    counts = [
        (r["length"], r["n"])
        for r in made.groupBy("length").agg(F.sum("count").alias("n")).collect()
    ]
    chosen = plan(counts, capacity)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = materialise(
        made.select(
            "length", "part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("base")
        )
    )
    ranked = stored.join(bases, ["length", "part"]).select(
        "key", "start", "length", "doc_tokens", "ids", (F.col("base") + F.col("nth")).alias("rank")
    )
    schema = T.StructType(
        [
            stored.schema["key"],
            *[
                T.StructField(n, T.LongType())
                for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
            ],
            *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []),
        ]
    )
    return ranked.mapInArrow(_placed(capacity, chosen, with_ids), schema)
