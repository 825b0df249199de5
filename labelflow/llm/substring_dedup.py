"""Passages that repeat, within or across documents, by content-defined chunks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelflow.llm.common import by_bytes, free_name, text_batches, text_or_empty
from labelflow.llm.textbytes import BASE, TextBytes, mix
from labelflow.storage import materialise

#: Bytes that the rolling hash sees: a boundary depends on these bytes before it.
WINDOW = 8
#: A word may begin a chunk if its hash is among this many of 16 values, and
#: those of the two words before it are not: about seven words a chunk, three
#: at least (but for a text's first and last).
CUTS = 5
#: Words of repeated chunks in a row that make a passage. Of a repeated passage of
#: 51 random words 41 are removed on average; of 2,000 such one lost nothing.
LEAST_WORDS = 20
#: Where the rolling hash sees no boundary for so many words before and behind a
#: word, it begins a chunk if its hash is the least of them. So the same word or
#: line over and over is cut as well, in any document at the same word of it.
REACH = 8
TEXT_BYTES = 1 << 20
#: The gear table: a random number for each byte.
GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


class Chunks(TextBytes):
    """The chunks of some texts: first and last word, text, and digest of each.

    White space counts as one space, however long it is; the words keep their
    numbers.
    """

    def __init__(self, texts: list[bytes]):
        super().__init__([b" ".join(t.split()) for t in texts])
        # gear hash of the WINDOW bytes before each place, by doubling
        rolled, width = GEAR[self.data], 1
        while width < WINDOW:
            rolled[width:] = rolled[width:] + (rolled[:-width] << np.uint32(width))
            width *= 2
        before = rolled[np.maximum(self.starts - 1, 0)]
        inside = self.starts - self.begin[self.owner] >= WINDOW
        chosen = inside & ((before >> np.uint32(28)) < CUTS)
        opens = chosen.copy()
        for k in (1, 2):  # only words of the same text count
            opens[k:] &= ~(chosen[:-k] & (self.owner[k:] == self.owner[:-k]))
        opens |= np.diff(self.owner, prepend=-1) != 0
        opens[self._least(before, inside, opens)] = True
        self.first = np.flatnonzero(opens)
        self.last = np.append(self.first[1:], len(self.starts)) - 1 if len(self.first) else self.first
        self.of_text = self.owner[self.first]
        self.size = self.last - self.first + 1
        self.digest = self.hashes(self.starts[self.first], self.ends[self.last])
        #: Where each text's chunks begin, and the end.
        self.bounds = np.searchsorted(self.of_text, np.arange(self.n + 1))

    def _least(self, before: np.ndarray, inside: np.ndarray, opens: np.ndarray) -> list[int]:
        """Words, REACH or more from any of ``opens`` and three or more from each
        other, with the least hash within REACH words of their text. Equal ones
        all count: one in each period of a line, or every third or fourth word
        if that is shorter."""
        n = len(opens)
        total = np.concatenate([[0], np.cumsum(opens)])
        place = np.arange(n)
        behind_text = np.searchsorted(self.owner, self.owner, "right")
        low, high = np.maximum(place - REACH, 0), np.minimum(place + REACH + 1, behind_text)
        some = np.flatnonzero(inside & (total[high] == total[low]))
        hashes = np.where(inside, before, np.uint32(0xFFFFFFFF))
        least = np.ones(len(some), bool)
        for k in range(1, REACH + 1):  # a text's first word opens, so none is as near to one before
            least &= hashes[some] <= hashes[some - k]
            behind = np.minimum(some + k, n - 1)
            least &= (hashes[some] <= hashes[behind]) | (self.owner[behind] != self.owner[some])
        found: list[int] = []
        for at in some[least].tolist():
            if not found or at - found[-1] > 2:
                found.append(at)
        return found


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """row, i, digest and again (the row has the digest before) of every two
    neighbouring chunks, numbers i and i + 1 of the row."""
    for batch in by_bytes(batches, "text", TEXT_BYTES):
        chunks = Chunks(batch.column("text").cast(pa.binary()).to_pylist())
        at = np.flatnonzero(np.diff(chunks.of_text) == 0)
        of_text = chunks.of_text[at]
        digest = mix(chunks.digest[at] * np.uint64(BASE) + chunks.digest[at + 1])
        rows = batch.column("row").take(pa.array(of_text))
        number = at - chunks.bounds[of_text]
        order = np.lexsort((digest, of_text))  # stable: equal ones stay in order
        same = (np.diff(digest[order]) == 0) & (np.diff(of_text[order]) == 0)
        again = np.zeros(len(order), bool)
        again[order[1:][same]] = True
        for low in range(0, len(number), 50_000):
            some = slice(low, low + 50_000)
            yield pa.RecordBatch.from_arrays(
                [
                    rows[some],
                    pa.array(number[some]),
                    pa.array(digest.view(np.int64)[some]),
                    pa.array(again[some]),
                ],
                names=["row", "i", "digest", "again"],
            )


def _marks(stored: DataFrame, row: str, text: str) -> DataFrame:
    """row and the numbers of its chunks that occurred, together with the next
    chunk, earlier in the table.

    Earlier is by the stored row number and then by the place in the row, so
    that it does not matter how the two scans are split into tasks. One partial
    aggregate finds each digest's first row; only digests that occur twice are
    stored and joined with all pairs. Both sides of that join are plain, so a
    very frequent pair is split.
    """
    pairs = stored.select(F.col(row).alias("row"), text_or_empty(text).alias("text")).mapInArrow(
        _pairs, "row long, i long, digest long, again boolean"
    )
    repeated = materialise(
        pairs.groupBy("digest")
        .agg(F.min("row").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("digest").alias("_digest"), "first")
    )
    later = pairs.join(repeated, F.col("digest") == F.col("_digest")).where("row > first or again")
    return later.groupBy(F.col("row").alias("_marked")).agg(F.collect_list("i").alias("_marks"))


def _passages(chunks: Chunks, text: int, marks: np.ndarray) -> list[tuple[int, int]]:
    """Passages of one text as (first word, word behind), of all texts' words:
    runs of marked pairs of chunks that hold LEAST_WORDS words. Runs may touch:
    where one ends and the next begins, the two chunks were not together before."""
    low, high = chunks.bounds[text], chunks.bounds[text + 1]
    marked = np.zeros(high - low, bool)
    marked[marks] = True
    edge = np.diff(marked.view(np.int8), prepend=0, append=0)
    runs = zip(np.flatnonzero(edge == 1) + low, np.flatnonzero(edge == -1) + low)
    found = [(int(chunks.first[a]), int(chunks.last[b]) + 1) for a, b in runs]
    return [(a, b) for a, b in found if b - a >= LEAST_WORDS]


def _cut(texts: list[bytes], marks: list) -> Iterator[tuple[str, int, list[tuple[int, int]]]]:
    """What is left of each text, the words removed, and the removed spans in
    characters of the text. White space behind a passage goes with it."""
    some = [i for i, m in enumerate(marks) if m is not None]
    chunks, whole = Chunks([texts[i] for i in some]), TextBytes([texts[i] for i in some])
    passages = {i: (k, _passages(chunks, k, np.asarray(marks[i]))) for k, i in enumerate(some)}
    for i, text in enumerate(texts):
        left, at, chars, words, removed = [], 0, 0, 0, []
        k, found = passages.get(i, (0, ()))
        for first, behind in found:
            a = int(whole.starts[first] - whole.begin[k])
            more = behind < len(whole.starts) and whole.owner[behind] == k
            b = int((whole.starts[behind] if more else whole.end[k]) - whole.begin[k])
            kept = text[at:a].decode()
            left.append(kept)
            begin = chars + len(kept)
            chars = begin + len(text[a:b].decode())
            removed.append((begin, chars))
            words += behind - first
            at = b
        left.append(text[at:].decode())
        yield "".join(left), words, removed


def repeats(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row per row: ``keys``, text (what is left), removed_words and removed
    (spans of the whole text, in characters, end excluded).

    A passage is a run of chunks, LEAST_WORDS words or more, of which every two
    neighbours occur together earlier in the table, in the same or another row;
    it is removed, and the first occurrence of every chunk stays. A text put
    together from single chunks of others is left alone. Chunks are cut where a gear
    rolling hash of the WINDOW bytes before a word says so, so an insertion
    moves no boundary but its own, and whole texts are read. Digests have 64
    bits; a passage needs several in a row.

    A null or empty text gives an empty text and no spans. Null keys and
    repeated rows are rows of their own (of two equal texts the later loses all
    it can). An empty table stays empty. Other columns are not read.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    stored = materialise(
        text_batches(df).select(
            *[F.col(k).alias(n) for n, k in zip(names, keys)],
            text_or_empty(text).alias("_text"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    span = T.StructType([T.StructField(n, T.IntegerType()) for n in ("start", "end")])
    schema = T.StructType(
        [
            *[T.StructField(n, df.schema[k].dataType) for n, k in zip(names, keys)],
            T.StructField("text", T.StringType()),
            T.StructField("removed_words", T.LongType()),
            T.StructField("removed", T.ArrayType(span)),
        ]
    )
    arrow_span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "_text", TEXT_BYTES):
            texts = batch.column("_text").cast(pa.binary()).to_pylist()
            cut = list(_cut(texts, batch.column("_marks").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(n) for n in names],
                    pa.array([t for t, _, _ in cut], pa.string()),
                    pa.array([w for _, w, _ in cut], pa.int64()),
                    pa.array(
                        [[{"start": a, "end": b} for a, b in r] for _, _, r in cut], arrow_span
                    ),
                ],
                names=schema.names,
            )

    marked = stored.join(_marks(stored, "_row", "_text"), F.col("_row") == F.col("_marked"), "left")
    cut = marked.select(*names, "_text", "_marks").mapInArrow(run, schema)
    return cut.withColumnsRenamed(dict(zip(names, keys)))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without their repeated passages, see ``repeats``.

    All columns stay; ``n_chars``, if there is one, is that of the new text. A
    row that is nothing but repeated passages is dropped; one that was null or
    empty before stays as it is.
    """
    row = free_name(docs, "_row")
    marks = free_name(docs, "_marks")
    stored = materialise(text_batches(docs).withColumn(row, F.monotonically_increasing_id()))
    columns = docs.columns
    text_at = columns.index("text")
    chars_at = columns.index("n_chars") if "n_chars" in columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", TEXT_BYTES):
            found = batch.column(len(columns)).to_pylist()
            hit = [i for i, m in enumerate(found) if m is not None]
            old = batch.column(text_at)
            texts = old.take(pa.array(hit, pa.int64())).cast(pa.binary()).to_pylist()
            new, keep = old.to_pylist(), np.ones(batch.num_rows, bool)
            for i, (text, words, _) in zip(hit, _cut(texts, [found[i] for i in hit])):
                if words:
                    new[i] = text
                    keep[i] = bool(text.strip())
            arrays = batch.columns[: len(columns)]
            arrays[text_at] = pa.array(new, old.type)
            if chars_at is not None:
                length = pa.compute.utf8_length(arrays[text_at]).cast(arrays[chars_at].type)
                changed = pa.array(np.isin(np.arange(batch.num_rows), hit))
                arrays[chars_at] = pa.compute.if_else(changed, length, arrays[chars_at])
            yield pa.RecordBatch.from_arrays(arrays, names=columns).filter(pa.array(keep))

    found = _marks(stored, row, "text").withColumnRenamed("_marks", marks)
    marked = stored.join(found, F.col(row) == F.col("_marked"), "left")
    return marked.select(*[F.col(f"`{c}`") for c in columns], marks).mapInArrow(run, docs.schema)
