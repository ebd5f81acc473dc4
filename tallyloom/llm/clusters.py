"""Exact k-means on whole numbers, with a heap of bounds per cluster.

A vector's gap is the distance to its second nearest centroid less that to its own. When centroids move, the gap
shrinks by at most the drift of its own plus the greatest drift among the others, which is one number per cluster
and round; accumulated, it is the cluster's slack. A gap entered as ``gap + slack at that time`` expires when the
slack reaches it. So each cluster keeps a heap of these sums, and a round pops what has expired, measures only
those vectors against all centroids, and pushes them again. The rest is not looked at.

Vectors lie in blocks, and every block has its own heaps, so a round is one pass in which tasks know nothing of
each other. Blocks and heaps are stored apart, in buckets by block: a round reads both without a shuffle, and
writes only the heaps. Centroids move by what changed hands: each block tells the sums of the vectors that came
and went, Spark adds them up, and the driver sees one number per cluster and component.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.texts import FREE_SHUFFLES, only, settle
from tallyloom.sources.tables import remove_folder, work_folder

#: Vectors of a block: what a task holds at once.
BLOCK = 4096

#: A component beyond this cannot be squared and added up in a 64-bit distance; such vectors take no part.
LARGEST = 1 << 27

#: Distances are whole numbers, their roots are not: a gap counts as smaller by this share of the distances.
MARGIN = 1e-9

HEAPS = "cluster binary, keys binary, rows binary, sizes binary"


def distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs, exact, as int64."""
    largest = max(int(np.abs(points).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    # Products below 2^53 are exact in doubles, whose matrix product is the fast one.
    kind = np.float64 if largest * largest * points.shape[1] < 1 << 50 else np.int64
    p, c = points.astype(kind), centroids.astype(kind)
    return ((p * p).sum(1)[:, None] - 2 * (p @ c.T) + (c * c).sum(1)).astype(np.int64)


class Heaps:
    """The state of a block: each vector's cluster, and the heap of expiry marks of each cluster."""

    def __init__(self, n: int, k: int):
        self.cluster = np.full(n, -1, dtype=np.int32)
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(k)]

    @classmethod
    def load(cls, row: dict, k: int) -> "Heaps":
        cluster, keys, rows, sizes = (np.frombuffer(row[c], t) for c, t in zip(("cluster", "keys", "rows", "sizes"), ("i4", "f8", "i4", "i4")))
        state = cls(len(cluster), k)
        state.cluster[:] = cluster
        entries, at = list(zip(keys.tolist(), rows.tolist())), 0
        for j, size in enumerate(sizes.tolist()):
            # Stored in the order of the heap, so it is one again.
            state.heaps[j] = entries[at:at + size]
            at += size
        return state

    def store(self) -> dict[str, bytes]:
        entries = [e for heap in self.heaps for e in heap]
        return {
            "cluster": self.cluster.tobytes(),
            "keys": np.array([key for key, _ in entries], "f8").tobytes(),
            "rows": np.array([i for _, i in entries], "i4").tobytes(),
            "sizes": np.array([len(heap) for heap in self.heaps], "i4").tobytes(),
        }

    def expired(self, slack: np.ndarray) -> list[int]:
        """The vectors whose gap the slack has reached, taken off their heaps; all of them in the first round."""
        if len(self.cluster) and self.cluster[0] < 0:
            return list(range(len(self.cluster)))
        popped = []
        for heap, reached in zip(self.heaps, slack.tolist()):
            while heap and heap[0][0] <= reached:
                popped.append(heappop(heap)[1])
        return popped

    def assign(self, points: np.ndarray, centroids: np.ndarray, slack: np.ndarray) -> tuple[np.ndarray, int]:
        """Move every vector to its nearest centroid (the smaller number of equals).

        Returns what the clusters gained, as ``(k, 1 + components)`` counts and sums, and how many vectors were measured.
        """
        k = len(centroids)
        gained = np.zeros((k, 1 + points.shape[1]), dtype=np.int64)
        popped = self.expired(slack)
        if not popped:
            return gained, 0
        at = np.array(popped)
        found = distances(points[at], centroids)
        nearest = found.argmin(1)
        first = found[np.arange(len(at)), nearest].astype(np.float64)
        if k > 1:
            found[np.arange(len(at)), nearest] = np.iinfo(np.int64).max
            u, l = np.sqrt(first), np.sqrt(found.min(1).astype(np.float64))
            marks = l - u - MARGIN * (1 + l + u) + slack[nearest]
        else:
            marks = np.full(len(at), np.inf)
        before = self.cluster[at]
        moved = before != nearest
        counted = np.concatenate([np.ones((int(moved.sum()), 1), np.int64), points[at[moved]].astype(np.int64)], axis=1)
        np.add.at(gained, nearest[moved], counted)
        left = before[moved] >= 0
        np.subtract.at(gained, before[moved][left], counted[left])
        self.cluster[at] = nearest
        fresh = (before < 0).all()
        for i, j, mark in zip(popped, nearest.tolist(), marks.tolist()):
            if fresh:
                self.heaps[j].append((mark, i))
            else:
                heappush(self.heaps[j], (mark, i))
        if fresh:
            for heap in self.heaps:
                heapify(heap)
        return gained, len(at)


def usable(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """Rows ``(id, v)`` with ``dims`` components, none null, not finite or too large."""
    rows = vectors.select("id", F.col("v").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float(LARGEST) / scale)))
    return rows.filter((F.size("v") == dims) & fine)


def _blocks(rows: DataFrame, dims: int, scale: int) -> DataFrame:
    """Vectors as whole numbers, ``BLOCK`` to a row: ``(block, ids, points)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        waiting = 0

        def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(parts).combine_chunks()
            flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            points = np.floor(scale * flat).astype("<i4").tobytes()
            ids = table.column("id").combine_chunks()
            lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), lists, pa.array([points], pa.binary())], names=["block", "ids", "points"])

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, BLOCK - waiting)
                batch = batch.slice(part.num_rows)
                held.append(part)
                waiting += part.num_rows
                if waiting == BLOCK:
                    yield block(held)
                    held, waiting = [], 0
                    number += 1
        if held:
            yield block(held)

    return rows.mapInArrow(run, f"block long, ids array<{rows.schema['id'].dataType.simpleString()}>, points binary")


class _Buckets:
    """Tables stored in the same buckets by ``block``, so that they meet without a shuffle."""

    def __init__(self, spark: SparkSession):
        self.spark, self.run = spark, uuid.uuid4().hex
        self.n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.paths: dict[str, str] = {}

    def store(self, df: DataFrame, name: str) -> DataFrame:
        table, path = f"tallyloom_{name}_{self.run}", work_folder(self.spark, name)
        before = self.spark.conf.get(FREE_SHUFFLES, "false")
        self.spark.conf.set(FREE_SHUFFLES, "true")
        try:
            df.write.bucketBy(self.n, "block").option("path", path).saveAsTable(table)
        finally:
            self.spark.conf.set(FREE_SHUFFLES, before)
        self.paths[table] = path
        return self.spark.table(table)

    def drop(self, name: str) -> None:
        table = f"tallyloom_{name}_{self.run}"
        if table in self.paths:
            self.spark.sql(f"DROP TABLE {table}")
            remove_folder(self.spark, self.paths.pop(table))


def _round(blocks: DataFrame, state: DataFrame | None, centroids: np.ndarray, slack: np.ndarray) -> DataFrame:
    """One pass: ``(block, <heaps>, gained, measured)``."""
    k, first = len(centroids), state is None
    # The buckets fit, so this join is within them.
    rows = blocks.select("block", "points") if first else blocks.select("block", "points").join(state.drop("gained", "measured").hint("merge"), "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                points = np.frombuffer(row["points"], "<i4").reshape(-1, centroids.shape[1])
                heaps = Heaps(len(points), k) if first else Heaps.load(row, k)
                gained, measured = heaps.assign(points, centroids, slack)
                out.append({"block": row["block"], **heaps.store(), "gained": gained.ravel().tolist(), "measured": measured})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema({
                "block": pa.int64(), **{c: pa.binary() for c in ("cluster", "keys", "rows", "sizes")},
                "gained": pa.list_(pa.int64()), "measured": pa.int64(),
            })) if out else batch.slice(0, 0)

    return rows.mapInArrow(run, f"block long, {HEAPS}, gained array<long>, measured long")


def _gains(state: DataFrame, shape: tuple[int, int]) -> list[list[int]]:
    """The gains of all blocks added up: added within tasks first, then one row per cluster and component."""
    width = shape[0] * shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, dtype=np.int64)
        for batch in batches:
            total += batch.column(0).flatten().to_numpy().reshape(-1, width).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], names=["at", "gained"])

    sums = state.select("gained").mapInArrow(run, "at long, gained long").groupBy("at").agg(
        F.sum(F.col("gained").cast("decimal(20,0)")).alias("gained")
    )
    out = [[0] * shape[1] for _ in range(shape[0])]
    for at, gained in sums.collect():
        out[at // shape[1]][at % shape[1]] = int(gained)
    return out


def _final(blocks: DataFrame, state: DataFrame, centroids: np.ndarray, slack: np.ndarray, kind: str) -> DataFrame:
    """The last assignment, one row per vector: ``(id, cluster, distance)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            for i, row in enumerate(batch.drop_columns(["ids"]).to_pylist()):
                points = np.frombuffer(row["points"], "<i4").reshape(-1, centroids.shape[1]).astype(np.int64)
                heaps = Heaps.load(row, len(centroids))
                heaps.assign(points, centroids, slack)
                away = points - centroids[heaps.cluster]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, 1).flatten(), pa.array(heaps.cluster), pa.array((away * away).sum(1))], names=["id", "cluster", "distance"]
                )

    return blocks.join(state.drop("gained", "measured").hint("merge"), "block").mapInArrow(run, f"id {kind}, cluster int, distance long")


def cluster(
    vectors: DataFrame, k: int = 40, rounds: int = 5, scale: int = 256, dims: int = 64, salt: str = "2",
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` per vector, by exact Lloyd rounds.

    Components are ``floor(scale * x)``. Centroids start as the ``k`` vectors with the least SHA-256 of
    ``<salt>:<id>`` (a null id comes last, equal ids by their components; all vectors, if there are fewer). A round
    assigns every vector to the nearest centroid, ties to the smaller number, and moves each centroid that has
    vectors to the floor of their mean; after ``rounds`` of them vectors are assigned once more.

    Vectors that are null, have not ``dims`` components or hold a null, non-finite or too large component
    (``LARGEST``) take no part. Repeated rows count each; an empty table gives an empty result; columns other than
    the two are not read. A sum of distances beyond 64 bits is given as the greatest long.
    """
    spark = vectors.sparkSession
    source = only(vectors, id=id_col, v=vector_col)
    kind = source.schema["id"].dataType.simpleString()
    rows = usable(source, dims, scale)
    hashed = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    seeds = rows.orderBy(F.asc_nulls_last(hashed), "v").limit(k).select("v").collect()
    if not seeds:
        return spark.createDataFrame([], f"{id_col} {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = np.floor(scale * np.array([r.v for r in seeds])).astype(np.int64)
    k = len(centroids)
    buckets = _Buckets(spark)
    # Block numbers follow from the task that cut the block, so blocks are stored before anything looks for them.
    cut = settle(_blocks(rows, dims, scale), "vector_blocks")
    blocks = buckets.store(cut.repartition(buckets.n, "block"), "blocks")
    held = [[0] * (1 + dims) for _ in range(k)]
    slack, state = np.zeros(k), None
    for r in range(rounds):
        fresh = buckets.store(_round(blocks, state, centroids, slack), f"heaps_{r}")
        buckets.drop(f"heaps_{r - 1}")
        state = fresh
        held = [[a + b for a, b in zip(*pair)] for pair in zip(held, _gains(state, (k, 1 + dims)))]
        # Whole numbers of any size: Python's division floors.
        moved = np.array([[x // n for x in sums] if n else before.tolist() for (n, *sums), before in zip(held, centroids)], dtype=np.int64)
        drift = np.sqrt(((moved - centroids) ** 2).sum(1).astype(np.float64)) * (1 + MARGIN)
        others = np.array([max(np.delete(drift, j), default=0.0) for j in range(k)])
        slack, centroids = slack + drift + others, moved
    found = settle(_final(blocks, state, centroids, slack, kind) if state is not None else _unmoved(blocks, centroids, kind), "assigned")
    buckets.drop(f"heaps_{rounds - 1}")
    buckets.drop("blocks")
    return _with_inertia(found, centroids).withColumnRenamed("id", id_col)


def _unmoved(blocks: DataFrame, centroids: np.ndarray, kind: str) -> DataFrame:
    """Without a round there are no heaps yet: those of a first assignment are made on the way."""
    slack = np.zeros(len(centroids))
    return _final(blocks, _round(blocks, None, centroids, slack), centroids, slack, kind)


def _with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Add the sums of distances and the digest of the centroid: one row per cluster meets the vectors."""
    most = (1 << 63) - 1
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(28,0)")).alias("s")).collect()}
    everything = min(sum(sums.values()), most)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    table = [(j, min(sums.get(j, 0), most), everything, name) for j, name in enumerate(names)]
    told = found.sparkSession.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # As many rows as there are clusters.
    return found.join(F.broadcast(told), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
