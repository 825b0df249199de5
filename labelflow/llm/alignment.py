"""Two tokenizers over the same texts: groups, links and how common each link is."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelflow.llm.common import by_bytes, text_batches
from labelflow.llm.pieces import Encoder, blocks, split
from labelflow.storage import materialise

#: Bytes of text aligned at once.
TEXT_BYTES = 2 << 20
#: Pairs whose counts are broadcast (some 60 bytes each); more are joined by shuffle.
BROADCAST_PAIRS = 500_000
#: Bits of a pair that hold the second tokenizer's id.
B_BITS = 32

MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


class Aligner:
    """Tokens of both files for blocks of texts, with a space in front of each text.

    Each text is cut at spaces behind other characters, where neither tokenizer
    joins anything; a block that does not start its text starts with such a space.
    """

    def __init__(self, path_a: str, path_b: str):
        self.a = Encoder(path_a, plain=True)
        self.b = Encoder(path_b, drop=1)
        self.safe = self.a.safe and self.b.safe
        self.bytes_a = pa.array(self.a.bytes, pa.large_binary())
        self.bytes_b = pa.array(self.b.bytes, pa.large_binary())
        n = len(self.a.bytes)
        names = [f"{i}{end}" for i in range(n) for end in ",|"]
        names += [f"{i}{end}" for i in range(len(self.b.bytes)) for end in ",;"]
        self.names = pa.array(names, pa.large_string())
        self.first_b = 2 * n

    def tokens(self, texts: pa.Array):
        """Ids and bounds of both, and which blocks both give back byte by byte."""
        pieces, coded, firsts = split(texts, self.safe, patterned=False)
        ids_a, bounds_a = self.a.encode(pieces, coded, firsts)
        ids_b, bounds_b = self.b.encode(pieces, coded, firsts)
        right = np.ones(len(texts), bool)
        sizes = np.asarray(pc.binary_length(texts)).astype(np.int64)
        ends = np.cumsum(sizes)
        whole = np.frombuffer(b"".join(texts.cast(pa.binary()).to_pylist()), np.uint8)
        for encoder, table, ids, bounds in (
            (self.a, self.bytes_a, ids_a, bounds_a), (self.b, self.bytes_b, ids_b, bounds_b)
        ):
            sums = np.concatenate([[0], np.cumsum(encoder.widths[ids])])
            got = sums[bounds[1:]] - sums[bounds[:-1]]
            found = table.take(pa.array(ids.astype(np.int64)))
            data = np.frombuffer(found.buffers()[2] or b"", np.uint8, sums[-1])
            if (got == sizes).all() and np.array_equal(data, whole):
                continue
            for i in range(len(texts)):
                mine = data[sums[bounds[i]] : sums[bounds[i + 1]]]
                right[i] &= np.array_equal(mine, whole[ends[i] - sizes[i] : ends[i]])
        return ids_a, bounds_a, ids_b, bounds_b, right

    def align(self, texts: pa.Array):
        """For each block: numbers of A and B tokens, groups and links, the text of
        its groups (each with ``;`` behind it), and its links as pairs of ids."""
        ids_a, bounds_a, ids_b, bounds_b, right = self.tokens(texts)
        n_a, n_b = np.diff(bounds_a), np.diff(bounds_b)
        ids_a, ids_b = ids_a[np.repeat(right, n_a)], ids_b[np.repeat(right, n_b)]
        n_a, n_b = np.where(right, n_a, 0), np.where(right, n_b, 0)
        ends_a, ends_b = np.cumsum(self.a.widths[ids_a]), np.cumsum(self.b.widths[ids_b])
        size = int(ends_a[-1]) + 1 if len(ends_a) else 1
        at_a, at_b = np.zeros(size, bool), np.zeros(size, bool)
        at_a[ends_a] = at_b[ends_b] = True
        last_a, last_b = at_b[ends_a], at_a[ends_b]  # the last tokens of groups
        # A link for each stretch of bytes between two ends of any kind.
        stops = np.flatnonzero(at_a | at_b)
        link_a = np.searchsorted(ends_a, stops)
        link_b = np.searchsorted(ends_b, stops)
        pairs = ids_a[link_a].astype(np.int64) << B_BITS | ids_b[link_b].astype(np.int64)
        upto_a, upto_b = np.cumsum(n_a), np.cumsum(n_b)
        marks = np.concatenate([[0], np.cumsum(last_a)])
        n_groups = np.diff(marks[np.concatenate([[0], upto_a])])
        links = np.searchsorted(link_a, np.concatenate([[0], upto_a]))
        # A group's A tokens stand behind the B tokens of all groups before.
        group_a = np.cumsum(last_a) - last_a
        group_b = np.cumsum(last_b) - last_b
        a_before = np.concatenate([[0], np.flatnonzero(last_a) + 1])
        b_before = np.concatenate([[0], np.flatnonzero(last_b) + 1])
        order = np.empty(len(ids_a) + len(ids_b), np.int64)
        order[np.arange(len(ids_a)) + b_before[group_a]] = 2 * ids_a.astype(np.int64) + last_a
        order[np.arange(len(ids_b)) + a_before[group_b + 1]] = (
            self.first_b + 2 * ids_b.astype(np.int64) + last_b
        )
        names = self.names.take(pa.array(order))
        text = memoryview(names.buffers()[2] or b"")
        offsets = np.frombuffer(names.buffers()[1], np.int64)[: len(order) + 1]
        borders = offsets[np.concatenate([[0], upto_a + upto_b])]
        groups = [text[b:e] for b, e in zip(borders, borders[1:])]
        return n_a, n_b, n_groups, np.diff(links), groups, pairs, right


def _counted(owner: np.ndarray, pairs: np.ndarray, n: int):
    """Distinct pairs of each of n texts, how often each has them, and bounds."""
    coded = pa.array(pairs).dictionary_encode()
    values, codes = coded.dictionary.to_numpy(), np.asarray(coded.indices).astype(np.int64)
    keys, times = np.unique(owner * max(1, len(values)) + codes, return_counts=True)
    mine, code = np.divmod(keys, max(1, len(values)))
    return values[code], times, np.searchsorted(mine, np.arange(n + 1))


def aligned_texts(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Distinct ``text``s (not empty) and their ``copies``, aligned.

    Returns digest (SHA-256 of the text), copies, n_a, n_b, n_groups, n_links,
    groups_sha256, and the distinct pairs of ids that are linked, with the times
    each is. Texts that either tokenizer does not give back are left out.
    """
    schema = T.StructType.fromDDL(
        "digest binary, copies long, n_a long, n_b long, n_groups long, n_links long, "
        "groups_sha256 string, pairs array<long>, times array<long>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for batch in by_bytes(batches, "text", TEXT_BYTES):
            aligner = aligner or Aligner(path_a, path_b)
            texts = pc.binary_join_element_wise(pa.scalar(" "), batch.column("text"), "")
            n = len(texts)
            if aligner.safe:
                some, owner = blocks(texts, TEXT_BYTES, patterned=False)
            else:
                some, owner = texts, np.arange(n)
            sums = np.zeros((4, n), np.int64)
            hashers: list = [None] * n
            good = np.ones(n, bool)
            pairs, owners = [], []
            step = 1 if len(some) > n else n
            for at in range(0, len(some), step):
                one, of = some.slice(at, step), owner[at : at + step]
                *counts, groups, linked, right = aligner.align(one)
                good[of] &= right
                for row, count in zip(sums, counts):
                    np.add.at(row, of, count)
                for i, group in zip(of.tolist(), groups):
                    if hashers[i] is None:
                        hashers[i] = hashlib.sha256()
                    else:
                        hashers[i].update(b";")
                    hashers[i].update(group[:-1])
                pairs.append(linked)
                owners.append(np.repeat(of, counts[3]))
            values, times, bounds = _counted(np.concatenate(owners), np.concatenate(pairs), n)
            places = pa.array(bounds.astype(np.int32))
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([hashlib.sha256(t.as_buffer()).digest() for t in batch.column("text")]),
                    batch.column("copies"),
                    *[pa.array(row) for row in sums],
                    pa.array([h.hexdigest() for h in hashers]),
                    pa.ListArray.from_arrays(places, pa.array(values)),
                    pa.ListArray.from_arrays(places, pa.array(times)),
                ],
                names=schema.names,
            )
            yield out.filter(pa.array(good))

    return text_batches(texts).select("text", "copies").mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, count (links that hold it over all rows) and best (no other pair with
    the same B id has more)."""
    counts = (
        aligned.select("copies", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
        .groupBy(F.col("x.pairs").alias("pair"))
        .agg(F.sum(F.col("x.times") * F.col("copies")).alias("count"))
    )
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1)))
    return counts.withColumn("best", F.col("count") == F.max("count").over(of_b))


def align(df: DataFrame, key: str, text: str, path_a: str, path_b: str) -> DataFrame:
    """One row per row of ``df``: key, n_a, n_b, n_groups, n_links, n_best,
    count_sum and groups_sha256.

    ``path_a`` encodes a space and the text, ``path_b`` the text, in front of
    which it puts a space; special strings are ordinary text. Places where a
    token of both ends cut the tokens into groups; a link is a pair of tokens
    whose bytes overlap. A pair of ids counts as often as links hold it in the
    whole table; n_best are a text's links whose count no other pair with their
    B id exceeds, count_sum adds the counts of its links.

    Equal texts are found by a shuffle of whole texts, aligned once, and weigh
    as often as they occur; their rows get the measures back by the SHA-256 of
    the text. A text's links are stored as distinct pairs, so a hot pair is one
    row per text at most, summed up in each task before the shuffle. The counts
    are broadcast up to BROADCAST_PAIRS rows, else joined by shuffle, with equal
    results.

    Null and empty texts, and those that the tokenizers do not give back byte by
    byte, have zeros and an empty groups_sha256, and do not count. Null keys and
    repeated rows keep a row each; an empty table gives an empty table. Texts of
    any length are aligned in blocks that end where no token reaches across.
    Other columns of ``df``, whatever their names, are not read.
    """
    docs = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    texts = docs.where(F.col("text") != "").groupBy("text").agg(F.count("*").alias("copies"))
    aligned = materialise(aligned_texts(texts, path_a, path_b))
    counts = materialise(pair_counts(aligned))
    if counts.count() <= BROADCAST_PAIRS:
        counts = F.broadcast(counts)
    links = aligned.select("digest", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    sums = (
        links.select("digest", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
        .join(counts, "pair")
        .groupBy("digest")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("count")).alias("count_sum"),
        )
    )
    measures = materialise(
        aligned.drop("pairs", "times", "copies").join(sums, "digest", "left")
    )
    digests = docs.select("key", F.unhex(F.sha2("text", 256)).alias("digest"))
    return digests.join(measures, "digest", "left").select(
        "key",
        *[F.coalesce(m, F.lit(0).cast("long")).alias(m) for m in MEASURES],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
