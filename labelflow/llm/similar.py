"""Near-duplicate texts: candidates by SimHash, links by the shingles themselves."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelflow.llm.common import by_bytes, store_rows, text_batches, text_or_empty
from labelflow.llm.components import connected
from labelflow.llm.simhash import (
    FOLD, SEED, TEXT_BYTES, fingerprint, first_of_group, near_links, node_groups, with_row,
)
from labelflow.storage import materialise

#: Nodes and shingles of a block of a component; a task compares two blocks.
BLOCK, BLOCK_SHINGLES = 2_048, 1 << 20
#: A smaller component is dealt into blocks of so many nodes, up to so many
#: blocks, so that more tasks share its pairs.
FEW, PARTS = 64, 32


def words_of(text: bytes) -> list[bytes]:
    return [w for w in text.translate(FOLD).split(b" ") if w]


def shingles_of(text: bytes, size: int) -> np.ndarray:
    """The distinct XXH64 hashes of all ``size``-word shingles, sorted. A shorter
    text is one shingle; one without words has none."""
    from xxhash import xxh64_intdigest

    found = words_of(text)
    if not found:
        return np.zeros(0, np.uint64)
    line = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    n = max(1, len(found) - size + 1)
    starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    hashes = (xxh64_intdigest(line[s:e], SEED) for s, e in zip(starts, ends[-n:].tolist()))
    return np.unique(np.fromiter(hashes, np.uint64, n))


def similar(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Whether two sorted sets have at least this share of their union in common."""
    if min(len(a), len(b)) < threshold * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common >= threshold * (len(a) + len(b) - common) and common > 0


def nearest_tree(
    values: np.ndarray, also: np.ndarray, radius: int, also_radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """Links, as places, that connect what is within both radii, by a spanning
    tree of the least distances in ``also`` (Prim's, one row of distances at a time).

    Such a tree connects whatever links at or below any distance connect, so
    links may be dropped afterwards for being too far without parting others.
    """
    n, far = len(values), 255
    least, parent = np.full(n, far, np.uint8), np.zeros(n, np.int64)
    open_ = np.ones(n, bool)
    a, b = [], []
    for _ in range(n):
        at = int(np.where(open_, least, far).argmin())
        if least[at] < far and open_[at]:
            a.append(at)
            b.append(int(parent[at]))
        else:
            at = int(open_.argmax())  # the first of another component
        open_[at] = False
        apart = np.bitwise_count(also ^ also[at])
        near = (np.bitwise_count(values ^ values[at]) <= radius) & (apart <= also_radius)
        closer = near & open_ & (apart < least)
        least[closer] = apart[closer]
        parent[closer] = at
    return np.array(a, np.int64), np.array(b, np.int64)


def _prints(texts: DataFrame, size: int) -> DataFrame:
    """_id, _row, node (a hash of the words), fp (of the distinct words) and also
    (of the shingles) of every row."""
    schema = T.StructType(
        [
            texts.schema["_id"],
            texts.schema["_row"],
            *[T.StructField(n, T.LongType()) for n in ("node", "fp", "also")],
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in by_bytes(batches, "_text", TEXT_BYTES):
            node, fp, also = [], [], []
            for text in batch.column("_text").cast(pa.binary()).to_pylist():
                found = words_of(text)
                line = b" ".join(found)
                node.append(xxh64_intdigest(line, SEED))
                fp += fingerprint(b" ".join(set(found)), 1)
                also += fingerprint(line, size)
            arrays = [np.array(node, np.uint64).view(np.int64), fp, also]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(x, pa.int64()) for x in arrays]],
                names=schema.names,
            )

    return text_batches(texts).select(
        "_id", "_row", text_or_empty("_text").alias("_text")
    ).mapInArrow(run, schema)


def _verified(pairs: DataFrame, size: int, threshold: float) -> DataFrame:
    """The (a, b) of pairs (a, b, a_text, b_text) that are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[str, tuple[int, np.ndarray]] = {}

        def shingles(side: str, node: int, text: bytes) -> np.ndarray:
            # Rows of one node often follow each other.
            if side not in last or last[side][0] != node:
                last[side] = node, shingles_of(text, size)
            return last[side][1]

        for batch in batches:
            columns = [batch.column(c) for c in ("a", "b", "a_text", "b_text")]
            kept = []
            for i in range(batch.num_rows):
                a, b, x, y = (c[i].as_py() for c in columns)
                one, two = shingles("a", a, x.encode()), shingles("b", b, y.encode())
                if similar(one, two, threshold):
                    kept.append((a, b))
            ends = np.array(kept, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"]
            )

    return text_batches(pairs).mapInArrow(run, "a long, b long")


def _texts(asked: DataFrame, distinct: DataFrame, keys: DataFrame) -> DataFrame:
    """node and text of the nodes in the only column of ``asked``, stored."""
    of_row = materialise(
        distinct.join(asked.toDF("_asked"), F.col("node") == F.col("_asked")).select(
            "node", F.col("least").alias("_least")
        )
    )
    return materialise(
        keys.join(of_row, F.col("_row") == F.col("_least")).select(
            "node", text_or_empty("_text").alias("text")
        )
    )


def _confirmed(
    links: DataFrame, distinct: DataFrame, keys: DataFrame, size: int, threshold: float
) -> DataFrame:
    """The links (a, b) whose whole texts are similar, stored."""
    candidates = materialise(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    asked = candidates.select("a").union(candidates.select("b")).distinct()
    texts = _texts(asked, distinct, keys)
    pairs = candidates.join(texts.toDF("a", "a_text"), "a").join(texts.toDF("b", "b_text"), "b")
    return materialise(_verified(pairs.select("a", "b", "a_text", "b_text"), size, threshold))


def links_between(
    fp: np.ndarray, also: np.ndarray, group: np.ndarray, own: np.ndarray, sets: list[np.ndarray],
    radius: int, also_radius: int, threshold: float,
) -> list[tuple[int, int]]:
    """Links, as places, that connect all groups of which two members, in two
    blocks (``own``) if there are two, are within both radii and have similar
    ``sets`` (sorted, none empty): a tree, never all pairs.

    Every such pair is tried, unless links found before connect its groups. One
    set is compared with all behind it at once.
    """
    if not sets:
        return []
    fp, also = fp.view(np.uint64), also.view(np.uint64)  # bits of negative numbers count as they are
    label = np.unique(group, return_inverse=True)[1]
    two = own.min() != own.max()
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    held = np.zeros(ids.max() + 1, np.uint8)
    found = []
    for at in range(len(sets) - 1):
        rest = slice(at + 1, None)
        near = np.bitwise_count(fp[rest] ^ fp[at]) <= radius
        near &= np.bitwise_count(also[rest] ^ also[at]) <= also_radius
        near &= label[rest] != label[at]
        if two:
            near &= own[rest] != own[at]
        if not near.any():
            continue
        behind = starts[at + 1]
        mine = ids[starts[at] : behind]
        held[mine] = 1
        common = np.add.reduceat(held[ids[behind:]], starts[rest] - behind, dtype=np.int64)
        held[mine] = 0
        near &= (common > 0) & (common >= threshold * (sizes[rest] + sizes[at] - common))
        for to in np.flatnonzero(near) + at + 1:
            if label[to] != label[at]:
                found.append((at, int(to)))
                label[label == label[to]] = label[at]
    return found


def _with_shingles(members: DataFrame, size: int) -> DataFrame:
    """``members`` with the hashes of its shingles in place of the last column,
    text, and their number n; texts without words are left out."""
    kept = members.columns[:-1]
    schema = T.StructType(
        [
            *[members.schema[c] for c in kept],
            T.StructField("shingles", T.BinaryType()), T.StructField("n", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", TEXT_BYTES):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            sets = [shingles_of(text, size) for text in texts]
            out = pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in kept],
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                ],
                names=schema.names,
            )
            yield out.filter(pa.compute.greater(out.column("n"), 0))

    return text_batches(members).mapInArrow(run, schema)


def _between(
    links: DataFrame, groups: DataFrame, distinct: DataFrame, keys: DataFrame, size: int,
    threshold: float, radius: int, also_radius: int,
) -> DataFrame:
    """Links (a, b), stored, of similar texts within both radii, that connect all
    ``groups`` with such a pair.

    Whatever is within the radii is connected by ``links``, so a pair of two
    groups is in one component of the links between groups. Only nodes of such
    components move, with the hashes of their shingles. A component is dealt
    into blocks, and every pair of blocks is compared in some task, which
    returns a tree of links: no pair that is only tried becomes a row.
    """
    group = groups.select("_node", "group")
    ends = links.join(group.toDF("a", "a_group"), "a").join(group.toDF("b", "b_group"), "b")
    open_ = connected(ends.select(F.col("a_group").alias("a"), F.col("b_group").alias("b")))
    asked = materialise(
        group.join(open_.toDF("group", "root"), "group").select(
            F.col("_node").alias("node"), "group", "root"
        )
    )
    texts = _texts(asked.select("node"), distinct, keys)
    members = asked.join(distinct.select("node", "fp", "also"), "node").join(texts, "node")
    stored = materialise(_with_shingles(members.select(
        "node", "group", "root", "fp", "also", "text"
    ), size))
    blocks = F.greatest(
        F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES),
        F.least(F.ceil(F.count("*") / FEW), F.lit(PARTS)),
    ).cast("int")
    parts = stored.groupBy("root").agg(blocks.alias("blocks"))
    cells = (
        stored.drop("n").join(parts, "root")
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
        .select("root", "low", "high", "node", "fp", "also", "group", "own", "shingles")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            node, *known = (table.column(c).to_numpy() for c in ("node", "fp", "also", "group", "own"))
            sets = [np.frombuffer(s.as_py(), np.uint64) for s in table.column("shingles")]
            found = links_between(*known, sets, radius, also_radius, threshold)
            ends = node[np.array(found, np.int64).reshape(-1, 2)]
            return pa.RecordBatch.from_arrays(
                [pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"]
            )

        current, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = [batch.column(c).to_numpy() for c in ("root", "low", "high")]
            changed = np.any([np.diff(p) != 0 for p in parts], axis=0)
            edges = [0, *(np.flatnonzero(changed) + 1), batch.num_rows]
            for start, end in zip(edges, edges[1:]):
                cell = tuple(p[start] for p in parts)
                if cell != current and held:
                    yield linked(held)
                    held = []
                current = cell
                held.append(batch.slice(start, end - start))
        if held:
            yield linked(held)

    many = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialise(
        text_batches(cells).repartition(many, "root", "low", "high")
        .sortWithinPartitions("root", "low", "high")
        .mapInArrow(run, "a long, b long")
    )


def keep_dissimilar(
    docs: DataFrame, size: int, threshold: float, radius: int, also_radius: int
) -> DataFrame:
    """``docs`` with one row, that of the least doc_id, of each group of similar
    texts.

    Two texts link if the sets of their ``size``-word shingles (capitals A-Z
    folded, white space as one space) have a similarity (Jaccard) of
    ``threshold`` or more. Candidates share a covering table over the SimHash
    fingerprints of their distinct words, within ``radius`` bits, which a few
    changed words hardly move, and are within ``also_radius`` bits in the
    fingerprint of their shingles. In a bucket they are linked by the tree of
    least distances of the latter; every such link is then
    confirmed on the shingles of the two whole texts, so none is below the threshold.
    What these links do not connect is tried pair by pair (``_between``), so that
    no candidate is left out.

    Texts with the same words are one node, whatever their number; texts without
    words are copies of each other. Only texts of candidate links move. Null ids
    come last, and among rows of one doc_id the first in storage stays. An empty
    table stays empty. The columns of ``docs`` are returned as they are.
    """
    stored, row, keys = with_row(docs)
    hashed = materialise(_prints(keys, size))
    rows = hashed.count()
    distinct = store_rows(
        hashed.groupBy("node").agg(
            F.min("_row").alias("least"), F.min("fp").alias("fp"), F.min("also").alias("also")
        ),
        rows,
    )
    links = materialise(
        near_links(
            distinct.select("node", "fp", "also"), radius, also_radius, nearest_tree, once=True
        )
    )
    confirmed = _confirmed(links, distinct, keys, size, threshold)
    # A tree's link may fail where one that it left out holds: those are tried as well.
    groups = node_groups(distinct, confirmed, rows)
    confirmed = confirmed.union(
        _between(links, groups, distinct, keys, size, threshold, radius, also_radius)
    )
    of_node = node_groups(distinct, confirmed, rows)
    found = materialise(
        hashed.join(of_node, F.col("node") == F.col("_node")).select("_id", "_row", "group")
    )
    return first_of_group(stored, row, found)
