"""Exact top-k search by inner product, with KD-trees per shard.

Candidates are dealt into shards of bounded size. A shard's tree is split at
medians of its widest dimension, and each node has the tight box of its vectors.
The greatest inner product a box allows bounds every vector in it: the leaves of a
shard are visited best bound first, until the bound falls below the k-th score
found so far. That score is propagated: a query first searches its home shard and
takes its k-th score along to all others, where leaves whose bound is lower are
passed over. Shards are dealt by hash, so that they are of equal size whatever the
data; each holds vectors from the whole space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.texts import only
from tallyloom.sources.tables import stage

FOUND = "_query long, query_id long, vec_id long, _row long, score long"
#: Sums below the first are exact in doubles, below the second in longs.
EXACT, WHOLE = 2.0 ** 53, 2.0 ** 63


class Tree:
    """The leaves of a KD-tree over whole-numbered vectors: rows in leaf order, and a tight box for each leaf and the root."""

    def __init__(self, vectors: np.ndarray, leaf_rows: int):
        self.order, ends = self._split(vectors, leaf_rows)
        self.vectors = vectors[self.order]
        self.ends = np.array(ends)
        self.begins = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self.low = np.minimum.reduceat(self.vectors, self.begins, axis=0)
        self.high = np.maximum.reduceat(self.vectors, self.begins, axis=0)

    @staticmethod
    def _split(vectors: np.ndarray, leaf_rows: int) -> tuple[np.ndarray, list[int]]:
        order, ends, todo = np.arange(len(vectors)), [], [(0, len(vectors))]
        while todo:
            begin, end = todo.pop()
            rows = order[begin:end]
            if end - begin <= leaf_rows:
                ends.append(end)
                continue
            inside = vectors[rows]
            widest = int((inside.max(axis=0) - inside.min(axis=0)).argmax())
            middle = (end - begin) // 2
            order[begin:end] = rows[np.argpartition(inside[:, widest], middle, kind="introselect")]
            # The left half is split next, so that leaves end in order.
            todo += [(begin + middle, end), (begin, begin + middle)]
        return order, ends

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The greatest inner product each leaf's box allows, per query and leaf."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T


def _products(queries: np.ndarray, vectors: np.ndarray, largest: float) -> np.ndarray:
    """Inner products of whole numbers, exact as longs; one beyond a long is given as the nearest long."""
    if largest < EXACT:
        return (queries @ vectors.T).astype(np.int64)
    if largest < WHOLE:
        return queries.astype(np.int64) @ vectors.astype(np.int64).T
    whole = [[int(x) for x in row] for row in vectors]
    most = (1 << 63) - 1
    return np.array([[max(-most, min(most, sum(a * b for a, b in zip(q, x)))) for x in whole] for q in [[int(x) for x in row] for row in queries]], dtype=np.int64)


def _best(query: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Which entries are among the ``k`` best of their query; ties go to the smaller id, then the earlier row."""
    order = np.lexsort((rows, ids, -score, query))
    sorted_query = query[order]
    first = np.searchsorted(sorted_query, sorted_query, side="left")
    return order[np.arange(len(order)) - first < k]


def search(queries: np.ndarray, query_rows: np.ndarray, kth: np.ndarray, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, leaf_rows: int) -> tuple[np.ndarray, ...]:
    """``(query index, id, row, score)`` of every candidate that can be among a query's ``k`` best.

    ``kth``: a score that ``k`` other candidates of the query are known to reach (minus infinity if there are none).
    A candidate in the query's own row takes no part.
    """
    tree = Tree(vectors, leaf_rows)
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * vectors.shape[1]
    # Bounds and thresholds are doubles: where scores are not, they give way by more than they can be off.
    slack = 0.0 if largest < EXACT else 1e-12 * largest
    ids, rows = ids[tree.order], rows[tree.order]
    bounds = tree.bounds(queries)
    visit = np.argsort(-bounds, axis=1, kind="stable")
    kth = kth.astype(float).copy()
    empty = np.empty(0, dtype=np.int64)
    held = (empty, empty, empty, empty)
    active = np.arange(len(queries))
    for turn in range(visit.shape[1]):
        leaf = visit[active, turn]
        # Best first: once a query's next bound is below its k-th score, no later leaf can help.
        going = bounds[active, leaf] >= kth[active] - slack
        active, leaf = active[going], leaf[going]
        if not len(active):
            break
        by_leaf = np.argsort(leaf, kind="stable")
        cuts = np.flatnonzero(np.diff(leaf[by_leaf])) + 1
        new = [held]
        for group in np.split(by_leaf, cuts):
            at, who = int(leaf[group[0]]), active[group]
            inside = slice(tree.begins[at], tree.ends[at])
            scores = _products(queries[who], tree.vectors[inside], largest)
            good = (scores >= kth[who, None] - slack) & (query_rows[who, None] != rows[None, inside])
            q, c = np.nonzero(good)
            new.append((who[q], ids[inside][c], rows[inside][c], scores[q, c]))
        if len(new) > 1:
            merged = tuple(np.concatenate(column) for column in zip(*new))
            keep = _best(merged[0], merged[3], merged[1], merged[2], k)
            held = tuple(column[keep] for column in merged)
            # Sorted by query, best first: the k-th entry, where there is one, raises the threshold.
            first = np.flatnonzero(np.concatenate([[True], np.diff(held[0]) > 0]))
            sizes = np.diff(np.concatenate([first, [len(held[0])]]))
            full = first[sizes == k]
            kth[held[0][full]] = np.maximum(kth[held[0][full]], held[3][full + k - 1])
    return held


def _packed(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, dim, vec)``: components as ``floor(scale * x)`` in 64-bit floats; rows that take no part are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            ids, packed, dims = [], [], []
            for vec_id, vector in zip(part.column("vec_id").to_pylist(), part.column("vec")):
                if vec_id is None or not vector.is_valid or vector.values.null_count:
                    continue
                values = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(values).all():
                    ids.append(vec_id)
                    dims.append(len(values))
                    packed.append(np.floor(scale * values).astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(packed, pa.binary())], names=["vec_id", "dim", "vec"]
            )

    return only(vectors, vec_id=id_col, vec=vector_col).mapInArrow(run, "vec_id long, dim int, vec binary")


def _searcher(k: int, leaf_rows: int):
    """Cogrouped search of one block of queries in one shard."""

    def run(key, queries: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        names = ["_query", "query_id", "vec_id", "_row", "score"]
        if queries.empty or shard.empty:
            return pd.DataFrame({n: pd.Series(dtype="int64") for n in names})
        dim = int(key[0])
        q, x = (np.frombuffer(b"".join(df["vec"]), dtype="<f8").reshape(len(df), dim) for df in (queries, shard))
        who, ids, rows, scores = search(
            q, queries["_row"].to_numpy(), queries["kth"].to_numpy(), x, shard["vec_id"].to_numpy(), shard["_row"].to_numpy(), k, leaf_rows
        )
        found = queries.iloc[who]
        values = (found["_row"].to_numpy(), found["vec_id"].to_numpy(), ids, rows, scores.astype(np.int64))
        return pd.DataFrame(dict(zip(names, values)))

    return run


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, shard_rows: int = 16_384, block_rows: int = 8_192,
    leaf_rows: int = 128, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best of all other rows for each query, ties to the smaller id.

    ``is_query``: a condition on ``vec_id``. Scores are inner products of ``floor(scale * x)``, exact. Vectors that
    are null or hold null or non-finite components, and rows without an id, take no part; a query is compared with
    vectors of its own length. Repeated rows are rows like any other: each is found, and each searches. Fewer than
    ``k`` candidates give fewer rows, none give none; empty vectors score 0. A sum beyond a long is given as the
    nearest long.

    Queries go against all rows in blocks: a task holds one shard and one block of queries, both of bounded size.
    """
    packed = _packed(vectors, scale, id_col, vector_col).withColumn("_row", F.monotonically_increasing_id())
    stored = stage(packed, "vectors")
    counts = stored.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    shards, blocks = max(1, -(-counts["n"] // shard_rows)), max(1, -(-counts["q"] // block_rows))
    deal = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "_row"), F.lit(n)).cast("int")
    rows = stored.withColumn("shard", deal(shards, 1))
    asked = rows.filter(is_query).withColumn("block", deal(blocks, 2))
    run = _searcher(k, leaf_rows)

    def searched(queries: DataFrame, candidates: DataFrame) -> DataFrame:
        keys = ["dim", "shard", "block"]
        # Both sides come from one table; renaming gives the queries columns of their own.
        queries = queries.select(*(F.col(c).alias(c) for c in queries.columns))
        return queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(run, FOUND)

    best = Window.partitionBy("_query").orderBy(F.desc("score"), "vec_id", "_row")
    home = stage(
        searched(
            asked.withColumn("block", F.lit(0)).withColumn("kth", F.lit(float("-inf"))), rows.withColumn("block", F.lit(0))
        ),
        "home_hits",
    )
    # Home results hold at most k rows a query, so the least of a full set is its k-th score.
    kth = home.groupBy("_query").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    known = F.when(F.col("n") >= k, F.col("least").cast("double")).otherwise(F.lit(float("-inf")))
    carried = asked.join(kth.withColumnRenamed("_query", "_row"), "_row", "left").withColumn("kth", F.coalesce(known, F.lit(float("-inf"))))
    others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != F.col("shard"))
    away = searched(
        carried.select("vec_id", "_row", "dim", "vec", "kth", "block", F.explode(others).alias("shard")),
        rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))),
    )
    ranked = home.unionAll(away).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
