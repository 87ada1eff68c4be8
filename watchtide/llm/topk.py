"""Exact top-k by inner product: tiles of queries and vectors, selection in each tile, lists merged as a tree.

Vectors are quantised to integers, so scores are exact. Both sides are packed into blocks where they lie, dealt to a
grid of tiles, and every tile multiplies its blocks as matrices and keeps the best of each query. Tiles share no
state; a lost one is computed again. Blocks meet in a merge join: copies of the query blocks are as many as there are
blocks of vectors, which no driver could hold for a broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import mul

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from watchtide.llm.words import bounded_batches
from watchtide.storage import stored

_BLOCK = "dim int, place bigint, ids binary, data binary"
_EXACT = 2.0**53
#: Blocks of queries that lie in one line of the grid, so that a block of vectors is sent once for all of them.
_ABREAST = 8
_KINDS = {np.dtype(kind).itemsize: np.dtype(kind) for kind in (np.int16, np.int32, np.float64)}


@dataclass(frozen=True)
class TopK:
    """Neighbours per query, the scale of the quantised components, and the rows of a block of either side."""

    k: int = 10
    scale: int = 1024
    query_rows: int = 1024
    vector_rows: int = 4096
    fan_in: int = 16


def _packed(data: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as hold all of them."""
    top = float(np.abs(data).max()) if data.size else 0.0
    return data.astype(_KINDS[2 if top < 2**15 else 4 if top < 2**31 else 8]).tobytes()


def _unpacked(data: bytes, rows: int, dim: int) -> np.ndarray:
    """Doubles of ``_packed`` numbers, a row for each vector; the length of the data tells their kind."""
    kind = _KINDS[len(data) // (rows * dim)] if data else np.dtype(np.float64)
    return np.frombuffer(data, kind).astype(np.float64).reshape(rows, dim)


def _blocks(rows: DataFrame, most: int) -> DataFrame:
    """Rows ``(id, parts)`` packed into blocks of at most ``most`` rows of one dimension, in their own partitions."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["parts"].map(len)
            for dim, group in batch.groupby(sizes):
                for i in range(0, len(group), most):
                    part = group.iloc[i : i + most].sort_values("id", kind="stable")
                    ids = part["id"].to_numpy(np.int64)
                    data = np.stack(part["parts"].to_numpy()).astype(np.float64) if dim else np.empty((len(part), 0))
                    yield pd.DataFrame({"dim": [dim], "place": [0], "ids": [ids.tobytes()], "data": [_packed(data)]})

    packed = rows.mapInPandas(of, _BLOCK)
    return packed.withColumn("place", F.xxhash64("dim", "ids", "data"))


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer products of whole numbers held as doubles; exact in doubles while sums stay below 2**53."""
    top = [float(np.abs(x).max()) if x.size else 0.0 for x in (queries, vectors)]
    if top[0] * top[1] * max(1, queries.shape[1]) < _EXACT:
        return (queries @ vectors.T).astype(np.int64)
    a, b = ([[int(v) for v in row] for row in x] for x in (queries, vectors))
    bounded = [[max(-(2**63), min(2**63 - 1, sum(map(mul, x, y)))) for y in b] for x in a]
    return np.array(bounded, np.int64).reshape(len(a), len(b))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k greatest scores, ties to smaller ids; ``ids`` ascend."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above, equal = np.flatnonzero(scores > least), np.flatnonzero(scores == least)
        at = np.concatenate([above, equal[: k - len(above)]])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))]


def _tiles(rule: TopK):
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, node, query_ids, query_data, ids, data in batch.itertuples(index=False):
                own, other = np.frombuffer(query_ids, np.int64), np.frombuffer(ids, np.int64)
                scores = _scores(_unpacked(query_data, len(own), dim), _unpacked(data, len(other), dim))
                best = []
                for query, row in zip(own, scores):
                    others = np.flatnonzero(other != query)
                    best.append(others[_best(row[others], other[others], rule.k)])
                counts = [len(at) for at in best]
                rows, at = np.repeat(np.arange(len(own)), counts), np.concatenate([*best, np.empty(0, np.int64)]).astype(np.int64)
                yield pd.DataFrame({"query_id": own[rows], "node": node, "vec_id": other[at], "score": scores[rows, at]})

    return of


def _merged(lists: DataFrame, rule: TopK, nodes: int) -> DataFrame:
    """The lists of all nodes merged ``fan_in`` at a time, level by level, into one per query."""
    while True:
        nodes = math.ceil(nodes / rule.fan_in)
        lists = lists.withColumn("node", F.pmod("node", F.lit(nodes)))
        best = Window.partitionBy("query_id", "node").orderBy(F.desc("score"), "vec_id")
        lists = lists.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= rule.k)
        if nodes <= 1:
            return lists.select("query_id", "rank", "vec_id", "score")
        lists = lists.drop("rank")


def top_k(vectors: DataFrame, is_query: Column, rule: TopK = TopK(), id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``rule.k`` other rows of greatest inner product for every query row.

    Components become ``floor(scale * x)``, and scores are sums of their integer products. ``is_query`` is a condition
    on the columns of ``vectors``. Fewer candidates give fewer rows; ties go to the smaller id. Rows without an id or a vector, or with a null
    or non-finite component, take no part. Only vectors of equal length meet. Rows that bear the id of a query are no
    candidates for it; rows that repeat an id are candidates each, and the query of an id is its least vector. Scores
    beyond 64 bits stop at the bounds. Empty tables give no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    sound = F.forall(vectors[vector], lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    parts = F.transform(vectors[vector], lambda x: F.floor(x.cast("double") * rule.scale))
    rows = vectors.filter(vectors[id].isNotNull() & sound).select(vectors[id].cast("bigint").alias("id"), parts.alias("parts"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    queries = rows.filter("is_query").groupBy("id").agg(F.min("parts").alias("parts"))
    counts = rows.agg(F.count("*"), F.count_if("is_query")).first()
    grid = [math.ceil(max(1, n) / size) for n, size in zip(counts, (rule.vector_rows, rule.query_rows * _ABREAST))]
    own = stored(_blocks(queries, rule.query_rows), "queries").select("dim", F.pmod("place", F.lit(grid[1])).alias("across"), F.col("ids").alias("query_ids"), F.col("data").alias("query_data"))
    other = _blocks(rows.select("id", "parts"), rule.vector_rows).select("dim", F.pmod("place", F.lit(grid[0])).alias("node"), "ids", "data")
    # Every block meets every block of the other side once: each side names its own line of the grid and all crossing ones.
    own = own.withColumn("node", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(grid[0] - 1).cast("bigint"))))
    other = other.withColumn("across", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(grid[1] - 1).cast("bigint"))))
    tiles = other.join(own.hint("merge"), ["dim", "node", "across"]).select("dim", "node", "query_ids", "query_data", "ids", "data")
    lists = tiles.mapInPandas(_tiles(rule), "query_id bigint, node bigint, vec_id bigint, score bigint")
    return _merged(lists, rule, grid[0])
