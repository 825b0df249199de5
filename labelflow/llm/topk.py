"""Exact top-k by inner product over integer vectors, by MaxScore."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelflow.storage import materialise

#: Vectors of a shard, and queries of a block. A task holds one of each.
SHARD, QUERIES = 4_096, 256
#: Vectors that are scored in full first, for a threshold to prune the others.
FIRST = 256
#: Terms probed between two looks at who is still competitive.
PROBE = 8
PACKED = "row binary, id binary, value binary, dims int"


def scaled(embedding: str, scale: int) -> Column:
    """floor(scale * x) of every component; null if any is null or not finite."""
    usable = F.forall(
        embedding, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(math.inf), F.lit(False))
    )
    whole = F.transform(embedding, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return F.when(usable, whole)


def _pack(limit: int):
    """Rows (row, id, v) to blocks of up to ``limit``: numbers as bytes, the
    values dimension by dimension; shorter vectors end in zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(rows: pa.Table) -> pa.RecordBatch:
            lists = rows.column("v").combine_chunks()
            ends = np.asarray(lists.offsets) - lists.offsets[0].as_py()
            flat, lengths = lists.flatten().to_numpy(), np.diff(ends)
            dims = int(lengths.max(initial=0))
            values = np.zeros((len(lengths), dims), np.int64)
            values[np.arange(dims)[None, :] < lengths[:, None]] = flat
            columns = [
                rows.column("row").to_numpy().astype("<i8").tobytes(),
                rows.column("id").to_numpy().astype("<i8").tobytes(),
                np.ascontiguousarray(values.T).astype("<i8").tobytes(),
            ]
            return pa.RecordBatch.from_arrays(
                [*[pa.array([c], pa.binary()) for c in columns], pa.array([dims], pa.int32())],
                names=["row", "id", "value", "dims"],
            )

        held: list[pa.RecordBatch] = []
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                room = limit - sum(b.num_rows for b in held)
                held.append(batch.slice(at, room))
                at += room
                if sum(b.num_rows for b in held) >= limit:
                    yield packed(pa.Table.from_batches(held))
                    held = []
        if sum(b.num_rows for b in held):
            yield packed(pa.Table.from_batches(held))

    return run


def _exact_type(query: np.ndarray, value: np.ndarray):
    """A number type in which no sum of products is rounded."""
    most = max(
        int(np.abs(query).max(initial=0)) * int(np.abs(value).max(initial=0)) * len(value), 1
    )
    return np.float64 if most < 1 << 53 else np.int64 if most < 1 << 63 else object


def max_score(
    query: np.ndarray, value: np.ndarray, ids: np.ndarray, own: int, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Positions and scores of the ``k`` best columns of ``value`` (dims x n).

    A term is a dimension, its posting list the values of all vectors there,
    its bound the largest product any of them reaches. Terms whose bounds sum
    to less than the k-th best score are not essential: all others are added up
    first, then these are probed, a few at a time and in falling order of their
    bounds, for the vectors that can still reach the threshold. ``own`` is a
    position that takes no part, or -1.
    """
    n = value.shape[1]
    bound = np.maximum(query * value.max(axis=1), query * value.min(axis=1))
    order = np.argsort(-bound, kind="stable")
    query, value = query[order], value[order]
    rest = np.append(np.cumsum(bound[order][::-1])[::-1], 0)  # from each term on
    best_at, best = np.zeros(0, np.int64), np.zeros(0, value.dtype)

    def merge(at: np.ndarray, score: np.ndarray) -> None:
        nonlocal best_at, best
        at, score = np.concatenate([best_at, at]), np.concatenate([best, score])
        order = np.lexsort((at, ids[at]))
        top = order[np.argsort(-score[order], kind="stable")[:k]]
        best_at, best = at[top], score[top]

    for low, high in ((0, min(FIRST, n)), (min(FIRST, n), n)):
        at = np.arange(low, high)
        at = at[at != own]
        if not len(at):
            continue
        full = len(best) == k
        essential = int(np.argmax(rest < best[-1])) if full and (rest < best[-1]).any() else len(query)
        score = query[:essential] @ value[:essential, low:high]
        score = score[at - low]
        term = essential
        while term < len(query):
            alive = score + rest[term] >= best[-1]
            at, score = at[alive], score[alive]
            if not len(at):
                break
            upto = min(term + PROBE, len(query))
            score = score + query[term:upto] @ value[term:upto][:, at]
            term = upto
        merge(at, score)
    return best_at, best


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.to_pylist():
                ids, rows = (np.frombuffer(pair[c], "<i8") for c in ("id", "row"))
                q_ids, q_rows = (np.frombuffer(pair[f"q_{c}"], "<i8") for c in ("id", "row"))
                dims = max(pair["dims"], pair["q_dims"])
                value = np.zeros((dims, len(ids)), np.int64)
                query = np.zeros((dims, len(q_ids)), np.int64)
                for to, name, size in ((value, "value", pair["dims"]), (query, "q_value", pair["q_dims"])):
                    to[:size] = np.frombuffer(pair[name], "<i8").reshape(size, -1)
                kind = _exact_type(query, value)
                value, query = value.astype(kind), query.astype(kind)
                place = {r: i for i, r in enumerate(rows.tolist())}
                out = []
                for j in range(len(q_ids)):
                    at, score = max_score(
                        query[:, j], value, ids, place.get(int(q_rows[j]), -1), k
                    )
                    out.append((np.full(len(at), q_rows[j]), np.full(len(at), q_ids[j]), rows[at], ids[at], score.astype(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(*out)],
                    names=["q_row", "query_id", "row", "vec_id", "score"],
                )

    return run


def top_k(
    df: DataFrame, key: str, embedding: str, is_query: Column, k: int, scale: int = 1024
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's ``k`` best rows.

    Components become floor(scale * x); the score is their inner product, ties
    go to the smaller key. Queries are the rows where ``is_query`` holds,
    candidates all rows but the query's own; each gets all others if there are
    fewer than ``k``. Vectors are packed into shards and queries into blocks of
    fixed numbers; each pair of a shard and a block is searched by MaxScore in
    one task, which returns at most ``k`` rows a query, and a ranking window,
    cut to ``k`` rows before its shuffle, merges the shards.

    Vectors that are null, or hold nulls or numbers that are not finite, take
    no part, nor do null keys; shorter vectors end in zeros. Rows with equal
    keys are rows of their own. An empty table, or one without queries, gives
    no rows. Other columns are not read.
    """
    stored = materialise(
        df.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(key).cast("long").alias("id"),
            scaled(embedding, scale).alias("v"),
            F.coalesce(is_query, F.lit(False)).alias("is_query"),
        ).where("v is not null and id is not null")
    )
    queries = stored.where("is_query").select("row", "id", "v")
    blocks = math.ceil(queries.count() / QUERIES)
    packed = queries.repartition(max(1, blocks)).mapInArrow(_pack(QUERIES), PACKED)
    packed = materialise(packed.withColumnsRenamed({c: f"q_{c}" for c in ("row", "id", "value", "dims")}))
    shards = materialise(stored.select("row", "id", "v").mapInArrow(_pack(SHARD), PACKED))
    # A join of blocks, each of fixed size: the stated queries against all rows.
    found = shards.crossJoin(packed).mapInArrow(
        _search(k), "q_row long, query_id long, row long, vec_id long, score long"
    )
    return (
        found.selectExpr(
            "query_id", "vec_id", "score",
            "row_number() over (partition by q_row order by score desc, vec_id, row) as rank",
        )
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
