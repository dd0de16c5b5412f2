"""Approximate nearest neighbours by balanced posting lists.

* Centroids come from balanced bisection of a bounded sample: a part is cut at the median along
  its two-means direction until it is small, so lists get similar sizes even where vectors crowd.
* A graph over the centroids, held in memory, finds the centroids near a vector by beam search.
* Every vector joins the list of its nearest centroid and of up to ``COPIES`` in all whose distance
  is within ``BOUNDARY`` of the nearest: vectors at a border are found from either side.
* A query reads the lists of its nearest centroids, as many as the bounded sample needs to find the
  share ``RECALL`` of its own nearest rows; lists beyond ``PRUNE`` times the nearest centroid's
  distance (or the usual distance of a row from its centroid, if that is larger) are left out, but
  never so many that fewer than ``k`` candidates would be read.
* A list is split over tasks by a hash in parts of about ``PART`` rows, each searched with exact
  distances; the parts' best are merged.  No list, however long, meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratalake.llm.common import bounded_sample, ship
from stratalake.storage import written_copy

ship(__name__)
SAMPLE, LIST_ROWS, MOST_LISTS = 40_000, 200, 4_000  # rows fitted on; rows a list aims at; lists
COPIES, BOUNDARY = 4, 1.15
RECALL, TRIED, PRUNE = 0.97, 200, 1.6  # share of neighbours aimed at; sample rows it is measured on
DEGREE, BEAM = 24, 96
PART, NEAREST = 4_000, 10


def bisected(x: np.ndarray, leaves: int, seed: int = 3) -> np.ndarray:
    """Centroids of ``leaves`` parts of nearly equal size."""
    rng = np.random.default_rng(seed)
    done, parts = [], [(np.arange(len(x)), leaves)]
    while parts:
        rows, want = parts.pop()
        if want <= 1 or len(rows) < 2:
            done.append(x[rows].mean(0))
            continue
        part = x[rows]
        a, b = part[rng.choice(len(part), 2, replace=False)]
        for _ in range(4):
            side = part @ (b - a)
            cut = np.partition(side, len(side) // 2)[len(side) // 2]
            low, high = part[side < cut], part[side >= cut]
            if not len(low) or not len(high):
                break
            a, b = low.mean(0), high.mean(0)
        order = np.argsort(part @ (b - a), kind="stable")
        left = want // 2
        cut = max(1, min(len(rows) - 1, len(rows) * left // want))
        parts += [(rows[order[:cut]], left), (rows[order[cut:]], want - left)]
    return np.stack(done).astype(np.float64)


@dataclass
class Graph:
    """Centroids, each with links to near ones and to some far ones."""

    centroids: np.ndarray
    links: np.ndarray

    @classmethod
    def over(cls, centroids: np.ndarray, seed: int = 4) -> Graph:
        n = len(centroids)
        near = min(DEGREE, n)
        links = np.zeros((n, near + min(8, n)), np.int64)
        norm = (centroids**2).sum(1)
        for a in range(0, n, 512):
            d = norm - 2 * centroids[a : a + 512] @ centroids.T
            links[a : a + 512, :near] = np.argpartition(d, near - 1, axis=1)[:, :near]
        links[:, near:] = np.random.default_rng(seed).integers(0, n, (n, links.shape[1] - near))
        return cls(centroids, links)

    def search(self, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Centroids and squared distances of the ``k`` nearest found per row, nearest first."""
        n, c = len(x), self.centroids
        k = min(k, len(c))
        beam = min(max(BEAM, k), len(c))
        entry = np.unique(np.linspace(0, len(c) - 1, min(len(c), 48)).astype(int))
        norm, own = (c**2).sum(1), (x**2).sum(1)

        def far(ids: np.ndarray) -> np.ndarray:
            return np.maximum(norm[ids] - 2 * np.einsum("nd,nmd->nm", x, c[ids]) + own[:, None], 0)

        ids = np.broadcast_to(entry, (n, len(entry))).copy()
        dist = far(ids)
        opened = np.zeros(ids.shape, bool)
        while True:
            waiting = np.where(opened, np.inf, dist)
            next_at = np.argsort(waiting, axis=1)[:, :4]
            if not np.isfinite(np.take_along_axis(waiting, next_at, 1)).any():
                break
            fresh = np.isfinite(np.take_along_axis(waiting, next_at, 1))
            np.put_along_axis(opened, next_at, True, 1)
            new = self.links[np.take_along_axis(ids, next_at, 1)]
            new[~fresh] = ids[:, :1, None].repeat(new.shape[1], 1)[~fresh]
            new = new.reshape(n, -1)
            ids = np.concatenate([ids, new], 1)
            dist = np.concatenate([dist, far(new)], 1)
            opened = np.concatenate([opened, np.zeros(new.shape, bool)], 1)
            # Of equal ids the opened one stays; then the nearest form the new beam.
            order = np.lexsort((~opened, ids), axis=1)
            ids, dist, opened = (np.take_along_axis(z, order, 1) for z in (ids, dist, opened))
            again = np.zeros(ids.shape, bool)
            again[:, 1:] = ids[:, 1:] == ids[:, :-1]
            dist[again] = np.inf
            order = np.argsort(dist, axis=1, kind="stable")[:, :beam]
            ids, dist, opened = (np.take_along_axis(z, order, 1) for z in (ids, dist, opened))
            opened |= ~np.isfinite(dist)
        order = np.argsort(dist, axis=1, kind="stable")[:, :k]
        return np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64) if len(column) else np.zeros((0, 1))


def _close(dist: np.ndarray, ratio: float, floor: float = 0.0) -> np.ndarray:
    """Which of the squared distances (nearest first) are within ``ratio`` of the nearest."""
    return dist <= ratio**2 * np.maximum(dist[:, :1], floor) + 1e-12


def usual_distance(x: np.ndarray, graph: Graph) -> float:
    """Median squared distance of a sample row from its centroid."""
    return float(np.median(graph.search(x[:2000], 1)[1]))


def probes_for(x: np.ndarray, graph: Graph, k: int, floor: float) -> int:
    """Lists a query must read to find the share ``RECALL`` of its ``k`` nearest sample rows.

    The sample is thinner than the table, so its neighbours are farther away: the number is rather
    too large than too small.
    """
    lists = len(graph.centroids)
    if lists <= 4 or len(x) <= k + 1:
        return lists
    asked = np.linspace(0, len(x) - 1, min(TRIED, len(x))).astype(int)
    q = x[asked]
    far = (x**2).sum(1) - 2 * q @ x.T + (q**2).sum(1)[:, None]
    far[np.arange(len(asked)), asked] = np.inf
    near = np.argpartition(far, k, axis=1)[:, :k]
    ids, dist = graph.search(x[near.reshape(-1)], COPIES)
    held = np.where(_close(dist, BOUNDARY), ids, -1).reshape(len(asked), k, -1)
    most = 8
    while True:
        read, dist = graph.search(q, most)
        read = np.where(_close(dist, PRUNE, floor), read, -2)
        found = (held[:, :, :, None] == read[:, None, None, :]).any((2, 3)).mean()
        if found >= RECALL or most >= lists:
            return min(most, lists)
        most = min(lists, most * 3 // 2)


def _placed(graph: Graph, most: int, ratio: float, floor: float = 0.0, rows: np.ndarray | None = None, least: int = 0):
    """Arrow function: vec_id, vector -> one row per list it belongs to (or reads).  Lists are read
    until they hold ``least`` of the rows counted in ``rows``, close or not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for a in range(0, big.num_rows, 512):
                batch = big.slice(a, 512)
                ids, dist = graph.search(_matrix(batch.column("vector")), most)
                close = _close(dist, ratio, floor)
                if rows is not None:
                    held = np.cumsum(rows[ids], 1) - rows[ids]  # in the lists before
                    close |= held < least
                row, at = np.nonzero(close)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(row)),
                        pa.array(ids[row, at]),
                        batch.column("vector").take(pa.array(row)),
                    ],
                    ["vec_id", "list", "vector"],
                )

    return run


def _searched(k: int):
    """Cogroup: queries and rows of one part of a list -> the best ``k`` of every query."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if left.num_rows and right.num_rows:
            ids = right.column("vec_id").to_numpy()
            order = np.argsort(ids, kind="stable")
            ids, rows = ids[order], _matrix(right.column("vector"))[order]
            # Places of one vec_id; its nearest vector stands for it.
            begin = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
            alone = ids[begin]
            for a in range(0, left.num_rows, 256):
                part = left.slice(a, 256)
                own, q = part.column("vec_id").to_numpy(), _matrix(part.column("vector"))
                rough = (rows**2).sum(1) - 2 * q @ rows.T + (q**2).sum(1)[:, None]
                rough[own[:, None] == ids] = np.inf
                # The rough distance decides with a margin; the exact one ranks.
                n = min(k, len(alone))
                nearest_of = np.minimum.reduceat(rough, begin, axis=1)
                edge = np.partition(nearest_of, n - 1, axis=1)[:, n - 1]
                row, at = np.nonzero((rough <= (edge + 1e-6 * (1 + np.abs(edge)))[:, None]) & np.isfinite(rough))
                exact = np.sqrt(((q[row] - rows[at]) ** 2).sum(1))
                rank = np.lexsort((exact, ids[at], row))
                row, at, exact = row[rank], at[rank], exact[rank]
                fresh = np.append(True, (row[1:] != row[:-1]) | (ids[at[1:]] != ids[at[:-1]]))[: len(row)]
                row, at, exact = row[fresh], at[fresh], exact[fresh]
                rank = np.lexsort((ids[at], exact, row))
                row, at, exact = row[rank], at[rank], exact[rank]
                place = np.arange(len(row)) - np.searchsorted(row, np.arange(len(q)))[row]
                keep = place < k
                for store, value in zip(out, (own[row[keep]], ids[at[keep]], exact[keep]), strict=True):
                    store.append(value)
        made = [np.concatenate(x) if x else np.zeros(0) for x in out]
        return pa.table(
            {
                "query_id": pa.array(made[0].astype(np.int64)),
                "vec_id": pa.array(made[1].astype(np.int64)),
                "score": pa.array(made[2].astype(np.float64)),
            }
        )

    return run


def nearest(vectors: DataFrame, is_query, k: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest rows of every query row.

    ``vectors(vec_id, embedding)``; ``is_query`` is a condition on its rows.  Null or zero vectors,
    vectors with null or non-finite components and rows without vec_id take no part; neither do
    vectors of another length than most.  Rows with one vec_id are one candidate if equal;
    otherwise the nearer counts.  Ties go to the smaller vec_id; a query is never its own
    candidate.  Fewer candidates than ``k`` give fewer rows, an empty table gives none.
    """
    component = F.col("embedding")
    good = (
        F.col("vec_id").isNotNull()
        & component.isNotNull()
        & F.forall(component, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists(component, lambda v: v != 0)
    )
    rows = written_copy(
        vectors.where(F.coalesce(good, F.lit(False)))
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            component.cast("array<double>").alias("vector"),
            F.coalesce(is_query, F.lit(False)).alias("is_query"),
        ).distinct(),
        "vectors",
    )
    length = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if length is None:
        return vectors.sparkSession.createDataFrame(
            [], "query_id long, rank int, vec_id long, score double"
        )
    rows = rows.where(F.size("vector") == length["d"])
    total = length["count"]
    sample = bounded_sample(rows.groupBy("vec_id").agg(F.min("vector").alias("vector")), "vec_id", SAMPLE)
    x = _matrix(written_copy(sample.select("vec_id", "vector"), "vector_sample").orderBy("vec_id").toArrow().column("vector"))
    x = x[np.random.default_rng(5).permutation(len(x))]
    lists = int(min(MOST_LISTS, max(1, total // LIST_ROWS), len(x)))
    graph = Graph.over(bisected(x, lists))
    schema = "vec_id long, list long, vector array<double>"
    plain = rows.select("vec_id", "vector")
    posted = written_copy(plain.mapInArrow(_placed(graph, COPIES, BOUNDARY), schema), "posted")
    counted = posted.groupBy("list").agg(F.count("*").alias("n"))
    parts = counted.select("list", F.ceil(F.col("n") / PART).cast("long").alias("parts"))
    in_list = np.zeros(len(graph.centroids), np.int64)  # one number per list
    for list_, n in counted.collect():
        in_list[list_] = n
    floor = usual_distance(x, graph)
    # A row is in COPIES lists at most, so that many rows hold k others.
    least = COPIES * (k + 1)
    smallest = np.sort(in_list).cumsum()
    most = max(probes_for(x, graph, k, floor), int(np.searchsorted(smallest, least)) + 1)
    asked = (
        rows.where("is_query")
        .select("vec_id", "vector")
        .mapInArrow(_placed(graph, min(most, len(in_list)), PRUNE, floor, in_list, least), schema)
        .join(parts, "list")
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .select("vec_id", "vector", "list", "part")
    )
    held = posted.join(parts, "list").select(
        "vec_id", "vector", "list", F.pmod(F.xxhash64("vec_id", F.lit(5)), F.col("parts")).alias("part")
    )
    found = (
        asked.groupBy("list", "part")
        .cogroup(held.groupBy("list", "part"))
        .applyInArrow(_searched(k), "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.groupBy("query_id", "vec_id")
        .agg(F.min("score").alias("score"))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
