"""Near duplicates by SimHash fingerprints and covering hash tables."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelflow.llm.common import by_bytes, free_name, store_rows, text_batches, text_or_empty
from labelflow.llm.components import connected
from labelflow.storage import materialise

#: Capital letters become small and all white space a space.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256)
)
SEED = 42
#: Shingles whose bits are counted at once, and bytes of text in one batch.
STEP = 1 << 15
TEXT_BYTES = 4 << 20
#: Fingerprints of a bucket that one task compares with each other; fuller
#: buckets are dealt into blocks, and all pairs of blocks are compared.
BLOCK = 2_048
#: Row numbers of dropped documents (8 bytes each) that are broadcast.
BROADCAST_ROWS = 1_000_000


def fingerprint(text: bytes, *shingles: int) -> list[int]:
    """64 bits for each size of shingle; bit i is set if over half the shingles'
    hashes have it set.

    Shingles are of so many words, with repeats; a shorter text is one shingle,
    and a text without words has fingerprint 0.
    """
    from xxhash import xxh64_intdigest

    found = [w for w in text.translate(FOLD).split(b" ") if w]
    if not found:
        return [0] * len(shingles)
    line = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends + 1 - lengths
    out = []
    for shingle in shingles:
        n = max(1, len(found) - shingle + 1)
        first, last = starts[:n].tolist(), ends[len(found) - n :].tolist()
        counts = np.zeros(64, np.int64)
        for at in range(0, n, STEP):
            hashes = np.array(
                [
                    xxh64_intdigest(line[s:e], SEED)
                    for s, e in zip(first[at : at + STEP], last[at : at + STEP])
                ],
                "<u8",
            )
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.uint16)  # STEP is less than 2 ** 16
        out.append(int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0]))
    return out


def fingerprints(df: DataFrame, keys: list[str], text: str, shingles: dict[str, int]) -> DataFrame:
    """``keys`` and a long column for each of ``shingles`` (name to words), for
    every row; a null text has no words."""
    names = [f"_k{i}" for i in range(len(keys))]
    schema = T.StructType(
        [
            *[T.StructField(n, df.schema[k].dataType) for n, k in zip(names, keys)],
            *[T.StructField(n, T.LongType()) for n in shingles],
        ]
    )
    sizes = list(shingles.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "_text", TEXT_BYTES):
            texts = batch.column("_text").cast(pa.binary()).to_pylist()
            values = zip(*[fingerprint(t, *sizes) for t in texts])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], *[pa.array(v, pa.int64()) for v in values]],
                names=schema.names,
            )

    hashed = text_batches(df).select(
        *[F.col(k).alias(n) for n, k in zip(names, keys)], text_or_empty(text).alias("_text")
    ).mapInArrow(run, schema)
    return hashed.withColumnsRenamed(dict(zip(names, keys)))


def _codes() -> list[int]:
    """The columns of a linear code [64, 10, 28] (an extended BCH code): for x in
    GF(64) the bits of x, a one, and the three bits of x ** 9, which is in GF(8)."""
    power = [1]
    for _ in range(62):
        power.append(power[-1] << 1 ^ (0b1000011 if power[-1] & 32 else 0))
    low = {0: 0}
    for bit, element in enumerate((power[0], power[9], power[18])):
        low |= {known ^ element: c | 1 << bit for known, c in low.items()}
    ninth = {x: power[9 * k % 63] for k, x in enumerate(power)} | {0: 0}
    return [low[ninth[x]] << 7 | 64 | x for x in range(64)]


def covering_masks(radius: int) -> list[int]:
    """2 ** (radius + 1) - 1 masks of 64 bits such that any two values that
    differ in at most ``radius`` bits agree on all bits of some mask.

    Each bit place has a code of radius + 1 bits; mask v keeps the places whose
    code has an odd number of bits in common with v. The codes of the differing
    places span at most ``radius`` dimensions, so some v is orthogonal to them
    all, and its mask keeps none of these places (Pagh 2016).

    A mask that keeps few bits has few and crowded buckets. Numbers from 1 are
    good codes while they use all their bits; from radius 6 on, ``_codes`` let
    no mask keep less than 28 bits (32 at radius 6), up to radius 9.
    """
    if not 1 <= radius <= 9:
        raise ValueError("no wide masks are known for this radius")
    n = (1 << (radius + 1)) - 1
    codes = [code & n for code in _codes()] if radius > 5 else [1 + place % n for place in range(64)]
    masks = []
    for v in range(1, n + 1):
        kept = sum(1 << i for i, code in enumerate(codes) if (code & v).bit_count() & 1)
        masks.append(kept - (1 << 64) if kept >> 63 else kept)
    return masks


def _stars(
    values: np.ndarray, also: np.ndarray, radius: int, also_radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """Links, as places, that connect what is within both radii: each place but
    the first of its component, with that first one."""
    n = len(values)
    label = np.arange(n)
    while True:
        new = label.copy()
        for at in range(0, n, 256):
            some = slice(at, at + 256)
            near = np.bitwise_count(values[some, None] ^ values[None, :]) <= radius
            if also_radius < 64:
                near &= np.bitwise_count(also[some, None] ^ also[None, :]) <= also_radius
            new[some] = np.where(near, label[None, :], n).min(axis=1)
        new = np.minimum(new, new[new])
        if (new == label).all():
            break
        label = new
    linked = np.flatnonzero(label != np.arange(n))
    return linked, label[linked]


def near_links(
    nodes: DataFrame, radius: int, also_radius: int = 64, tree: Callable = _stars,
    once: bool = False,
) -> DataFrame:
    """Links (a, b) between nodes (node, fp, also) that connect all whose fp are
    within ``radius`` bits and whose also are within ``also_radius``, directly
    or through others. ``node`` is distinct.

    One row per node and mask goes into a partial aggregate; most buckets have
    one member and end there, those of two are compared as pairs. Only members
    of fuller buckets move again. A bucket of n members is dealt into n / BLOCK
    blocks and every pair of blocks is compared by some task, so no task holds
    more than two blocks and no link is lost. A task returns a ``tree`` of links
    for each component it sees, never all pairs. A bucket's key is a hash of
    mask and bits, behind the mask's number: buckets that share one are compared as
    one.

    ``once`` is for a ``tree`` whose links are near ones and connect any two near
    members by links no farther in ``also``. A link whose ends agree on an earlier
    mask as well is then left out: the earlier bucket holds both ends and its
    tree connects them, so near copies that meet in most tables are not linked
    anew in each.
    """
    masks = covering_masks(radius)
    # 10 bits for the mask's number, 54 for the hash.
    keys = F.array(
        *[
            F.shiftrightunsigned(F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(m)), 10).bitwiseOR(
                F.lit(t << 54 if t < 512 else (t - 1024) << 54)
            )
            for t, m in enumerate(masks)
        ]
    )
    keyed = nodes.select("node", F.explode(keys).alias("key"))
    buckets = materialise(
        keyed.groupBy("key")
        .agg(F.count("*").alias("n"), F.min("node").alias("a"), F.max("node").alias("b"))
        .where("n > 1")
    )

    def end(name: str) -> DataFrame:
        return nodes.select(
            F.col("node").alias(name), F.col("fp").alias(f"{name}_fp"), F.col("also").alias(f"{name}_also")
        )

    def apart(what: str):
        return F.bit_count(F.col(f"a_{what}").bitwiseXOR(F.col(f"b_{what}")))

    pairs = (
        buckets.where("n = 2")
        .select("a", "b")
        .distinct()
        .join(end("a"), "a")
        .join(end("b"), "b")
        .where((apart("fp") <= radius) & (apart("also") <= also_radius))
        .select("a", "b")
    )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.array(masks, np.int64)

        def linked(key: int, parts: list[np.ndarray]) -> pa.RecordBatch:
            node, fp, also = np.concatenate(parts, axis=1)
            _, at = np.unique(node, return_index=True)
            node, fp, also = node[at], fp[at], also[at]
            a, b = tree(fp, also, radius, also_radius)
            if once:
                differ, new = fp[a] ^ fp[b], np.ones(len(a), bool)
                for mask in kept[: (int(key) >> 54) & 1023]:
                    new &= (differ & mask) != 0
                a, b = a[new], b[new]
            return pa.RecordBatch.from_arrays(
                [pa.array(node[a]), pa.array(node[b])], names=["a", "b"]
            )

        current, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = [batch.column(c).to_numpy() for c in ("key", "low", "high")]
            changed = np.any([np.diff(p) != 0 for p in parts], axis=0)
            edges = [0, *(np.flatnonzero(changed) + 1), batch.num_rows]
            values = np.stack([batch.column(c).to_numpy() for c in ("node", "fp", "also")])
            for low, high in zip(edges, edges[1:]):
                cell = tuple(p[low] for p in parts)
                if cell != current and held:
                    yield linked(current[0], held)
                    held = []
                current = cell
                held.append(values[:, low:high])
        if held:
            yield linked(current[0], held)

    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    crowded = buckets.where("n > 2").select("key", "n")
    members = (
        keyed.join(crowded, "key")
        .withColumn("blocks", blocks)
        .withColumn("own", own)
        .join(nodes, "node")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
            "node", "fp", "also",
        )
    )
    many = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = (
        members.repartition(many, "key", "low", "high")
        .sortWithinPartitions("key", "low", "high")
        .mapInArrow(link, "a long, b long")
    )
    return pairs.union(found)


def node_groups(distinct: DataFrame, links: DataFrame, rows: int) -> DataFrame:
    """_node, group (a node of the component) and component_id (the least of
    ``least`` in it) of all ``distinct`` nodes (node, least)."""
    nodes = store_rows(connected(links), rows)
    least = distinct.join(nodes, "node").groupBy("root").agg(F.min("least").alias("component"))
    linked = store_rows(nodes.join(least, "root").select("node", "root", "component"), rows)
    return store_rows(
        distinct.select("node", "least").join(linked, "node", "left").select(
            F.col("node").alias("_node"),
            F.coalesce("root", "node").alias("group"),
            F.when(F.col("root").isNull(), F.col("least"))
            .otherwise(F.col("component"))
            .alias("component_id"),
        ),
        rows,
    )


def _grouped(df: DataFrame, keys: list[str], text: str, shingle: int, radius: int) -> DataFrame:
    """``keys``, fp, group (a fingerprint of the component) and component_id."""
    hashed = materialise(fingerprints(df, keys, text, {"fp": shingle}))
    rows = hashed.count()
    distinct = store_rows(
        hashed.groupBy("fp").agg(F.min(keys[0]).alias("least")).withColumns(
            {"node": F.col("fp"), "also": F.lit(0).cast("long")}
        ),
        rows,
    )
    links = near_links(distinct.select("node", "fp", "also"), radius)
    of_node = node_groups(distinct, links, rows)
    return hashed.join(of_node, F.col("fp") == F.col("_node")).select(
        *keys, "fp", "group", "component_id"
    )


def near_duplicates(
    df: DataFrame, key: str, text: str, shingle: int = 3, radius: int = 2
) -> DataFrame:
    """key, fingerprint (16 hex digits) and component_id of every row.

    Rows link if their fingerprints differ in at most ``radius`` bits;
    component_id is the least key that can be reached, the row's own included.
    Equal fingerprints are one node, whatever their number, so copies are never
    paired; rows without words have fingerprint 0 and link like others. Null
    keys take part but are never a component_id (null only if all keys of
    a component are). Repeated rows each get a row. Other columns are not read.
    """
    return _grouped(df, [key], text, shingle, radius).select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def with_row(docs: DataFrame) -> tuple[DataFrame, str, DataFrame]:
    """``docs`` stored with a row number, that column's name, and _id, _row, _text."""
    row = free_name(docs, "_row")
    stored = materialise(docs.withColumn(row, F.monotonically_increasing_id()))
    keys = stored.select(
        F.col("doc_id").alias("_id"), F.col(row).alias("_row"), F.col("text").alias("_text")
    )
    return stored, row, keys


def first_of_group(stored: DataFrame, row: str, found: DataFrame) -> DataFrame:
    """``stored`` without ``row`` and with one row of each group of ``found``
    (_id, _row, group): that of the least id. Null ids come last; among rows of
    one id the first in storage stays."""
    order = F.struct(F.col("_id").isNull().alias("none"), "_id", "_row")
    rows = found.count()
    first = store_rows(
        found.groupBy("group")
        .agg(F.min(order)["_row"].alias("_keep"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("group").alias("_group"), "_keep"),
        rows,
    )
    # The rows to drop are far fewer than those that stay.
    drop = store_rows(
        found.join(first, F.col("group") == F.col("_group"))
        .where("_row <> _keep")
        .select(F.col("_row").alias("_drop")),
        rows,
    )
    if drop.count() <= BROADCAST_ROWS:  # else both sides move
        drop = F.broadcast(drop)
    return stored.join(drop, F.col(row) == F.col("_drop"), "left_anti").drop(row)
