"""Approximate nearest neighbours: one hierarchical navigable small-world graph a shard, results merged.

Equal vectors are one point, whose ``k`` + 1 smallest ids stand for all its rows: no more of them can be among the
nearest k of any query, so nothing is lost. Points are dealt to shards of bounded size by hash; a shard's graph is built
in a task and stored as flat neighbour arrays, one row a shard, with the ids of its points. Queries, packed in blocks, go
to every shard by broadcasts of bounded size, so that neither they nor the graphs are written once more for each other. A
task keeps the nearest k of each query over its shards, and the tasks' answers are ranked by exact distances in double
precision.

Rules: vectors that are null, empty, zero, or hold null or non-finite components take no part, neither do rows without
an id. Only vectors with the same number of components are compared. Rows that repeat an id and vector are one
candidate; an id with several vectors is one candidate each. A query's own id is never its neighbour. Ties go to the
smaller id. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.scratch import written

NEIGHBOURS, BUILD_WIDTH, SEARCH_WIDTH = 12, 64, 128
#: Points of a shard, and queries of a block.
SHARD, BLOCK = 4096, 1024
#: Bytes of queries that are broadcast at once, on average, and search tasks a core.
SENT, TASKS = 1 << 25, 8


class Graph:
    """Layers of neighbour lists over the rows of ``points`` (float32)."""

    def __init__(self, points: np.ndarray, links: list[np.ndarray], entry: int) -> None:
        self.points, self.links, self.entry = points, links, entry
        self.norms = np.einsum("ij,ij->i", points, points)

    def _near(self, query: np.ndarray, layer: np.ndarray, starts: list[tuple[float, int]], width: int,
              seen: np.ndarray, mark: int) -> list[tuple[float, int]]:
        """The ``width`` nearest found from the starts, nearest first. ``seen`` is stamped with ``mark``."""
        for _, i in starts:
            seen[i] = mark
        todo = list(starts)
        heapq.heapify(todo)
        best = [(-d, i) for d, i in starts]
        heapq.heapify(best)
        points, norms = self.points, self.norms
        while todo:
            d, i = heapq.heappop(todo)
            if len(best) >= width and d > -best[0][0]:
                break
            around = layer[i]
            around = around[around >= 0]
            around = around[seen[around] != mark]
            if not len(around):
                continue
            seen[around] = mark
            far = norms[around] - 2 * (points[around] @ query)
            for e, j in zip(far.tolist(), around.tolist()):
                if len(best) < width:
                    heapq.heappush(best, (-e, j))
                    heapq.heappush(todo, (e, j))
                elif e < -best[0][0]:
                    heapq.heapreplace(best, (-e, j))
                    heapq.heappush(todo, (e, j))
        return sorted((-d, i) for d, i in best)

    def search(self, query: np.ndarray, width: int, seen: np.ndarray, mark: int) -> list[int]:
        """Rows near ``query``, nearest first; ``mark`` must be a multiple of 64 that was not used before."""
        query = query.astype(np.float32)
        found = [(float(self.norms[self.entry] - 2 * (self.points[self.entry] @ query)), self.entry)]
        for level in range(len(self.links) - 1, -1, -1):
            found = self._near(query, self.links[level], found[:1] if level else found, width if level == 0 else 1,
                               seen, mark + level)
        return [i for _, i in found]


def build(points: np.ndarray, neighbours: int = NEIGHBOURS, width: int = BUILD_WIDTH, seed: int = 1) -> Graph:
    """Insert the points one after another, each linked to diverse near ones on every layer it is drawn for."""
    n = len(points)
    rng = np.random.default_rng(seed)
    levels = np.minimum((-np.log(1 - rng.random(n)) / np.log(neighbours)).astype(int), 8)
    levels[0] = levels.max(initial=0)  # the first point enters every layer
    links = [np.full((n, neighbours * (2 if level == 0 else 1)), -1, np.int32) for level in range(levels[0] + 1)]
    graph = Graph(points, links, 0)
    norms = graph.norms
    seen = np.zeros(n, np.int64)
    lowest = np.zeros((len(links), n), np.int32)  # how many neighbours a point has

    def diverse(i: int, near: list[tuple[float, int]], most: int) -> list[int]:
        """Near points that are nearer to ``i`` than to those already chosen; then the nearest of the rest."""
        ids = np.array([j for _, j in near])
        own = np.array([d for d, _ in near]) + norms[i]
        part = points[ids]
        between = norms[ids][:, None] + norms[ids][None, :] - 2 * (part @ part.T)
        least = np.full(len(ids), np.inf, np.float32)
        chosen = []
        for x in range(len(ids)):
            if own[x] < least[x]:
                chosen.append(x)
                least = np.minimum(least, between[x])
                if len(chosen) == most:
                    break
        if len(chosen) < most:
            picked = set(chosen)
            chosen += [x for x in range(len(ids)) if x not in picked][: most - len(chosen)]
        return ids[chosen].tolist()

    for i in range(1, n):
        query = points[i]
        found = [(float(norms[0] - 2 * (points[0] @ query)), 0)]
        for level in range(len(links) - 1, -1, -1):
            layer, mine = links[level], level <= levels[i]
            found = graph._near(query, layer, found if mine else found[:1], width if mine else 1, seen, i * 16 + level + 1)
            if not mine:
                continue
            most = layer.shape[1]
            for j in diverse(i, found, neighbours):
                layer[i, lowest[level, i]] = j
                lowest[level, i] += 1
                if lowest[level, j] < most:
                    layer[j, lowest[level, j]] = i
                    lowest[level, j] += 1
                else:
                    around = np.append(layer[j], i)
                    far = norms[around] - 2 * (points[around] @ points[j])
                    order = np.argsort(far, kind="stable")
                    keep = diverse(j, [(float(far[x]), int(around[x])) for x in order], most)
                    layer[j] = -1
                    layer[j, : len(keep)] = keep
                    lowest[level, j] = len(keep)
    return graph


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    x = F.col(vector_column).cast("array<double>")
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (vectors.select(F.col(id_column).cast("long").alias("id"), x.alias("v"))
            .where(F.col("id").isNotNull() & F.col("v").isNotNull())
            .where(~F.coalesce(bad, F.lit(True)) & F.exists("v", lambda c: c != 0)))


def graphs(points: DataFrame, shard: int, neighbours: int, width: int) -> DataFrame:
    """One row a shard: its points' vectors, how many ids each has, the ids, and the layers' neighbour arrays, all flat."""
    def make(key, rows):
        points_ = np.array(rows.column("v").to_pylist(), np.float64)
        graph = build(points_.astype(np.float32), neighbours, width)
        ids = rows.column("ids").to_pylist()
        return pa.table({
            "size": pa.array([key[0].as_py()], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int64()),
            "vectors": pa.array([points_.tobytes()], pa.binary()),
            "counts": pa.array([np.array([len(x) for x in ids], np.int64).tobytes()], pa.binary()),
            "ids": pa.array([np.concatenate(ids).astype(np.int64).tobytes()], pa.binary()),
            "links": pa.array([[x.tobytes() for x in graph.links]], pa.list_(pa.binary()))})

    return points.groupBy("size", "shard").applyInArrow(
        make, "size int, shard long, vectors binary, counts binary, ids binary, links array<binary>")


def first(row: np.ndarray, far: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` nearest answers of each row, ties by id."""
    order = np.lexsort((ids, far, row))
    row, far, ids = row[order], far[order], ids[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[keep], far[keep], ids[keep]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id_column: str = "vec_id",
            vector_column: str = "embedding", shard: int = SHARD, neighbours: int = NEIGHBOURS,
            build_width: int = BUILD_WIDTH, search_width: int = SEARCH_WIDTH) -> DataFrame:
    """``query_id``, ``rank``, ``id`` and ``score`` (Euclidean distance) of the nearest ``k`` found for each query."""
    width = max(search_width, 2 * (k + 1))
    rows = usable(vectors, id_column, vector_column).distinct().withColumn("point", F.xxhash64("v"))
    copies = rows.withColumn("place", F.row_number().over(Window.partitionBy("point", "v").orderBy("id"))).where(
        F.col("place") <= k + 1)  # Spark applies such a limit before it shuffles
    points = written(copies.groupBy("point", "v").agg(F.collect_list("id").alias("ids")), "points")
    shards = max(1, -(-points.count() // shard))
    # a task a shard: its work is far more than its bytes, by which Spark would merge tasks
    dealt = (points.select("v", "ids", F.size("v").alias("size"), F.pmod(F.xxhash64("point", F.lit(1)), F.lit(shards)).alias("shard"))
             .repartition(shards, "size", "shard"))
    stored = written(graphs(dealt, shard, neighbours, build_width), "graphs")

    def pack(key, rows):
        return pa.table({"size": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[2].as_py()], pa.int64()),
                         "names": pa.array([rows.column("id").to_numpy().astype(np.int64).tobytes()], pa.binary()),
                         "queries": pa.array([np.array(rows.column("v").to_pylist(), np.float64).tobytes()], pa.binary())})

    asked = written(usable(queries, id_column, vector_column).distinct().withColumn("size", F.size("v")), "queries")
    count, numbers = asked.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    many, parts = max(1, -(-count // BLOCK)), max(1, -(-8 * numbers // SENT))
    blocks = written(asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(many))).withColumn("part", F.col("block") % parts)
                     .groupBy("size", "block", "part").applyInArrow(pack, "size int, part long, names binary, queries binary"),
                     "blocks")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[bytes, bytes], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}  # of every block, over all shards
        for batch in batches:
            for at in range(batch.num_rows):
                size, names, asked_, vector, counts, ids, links = (c[at].as_py() for c in batch.columns)
                block = names, asked_
                names, asked_ = np.frombuffer(names, np.int64), np.frombuffer(asked_, np.float64).reshape(-1, size)
                counts, ids = np.frombuffer(counts, np.int64), np.frombuffer(ids, np.int64)
                starts = np.cumsum(counts) - counts
                exact = np.frombuffer(vector, np.float64).reshape(len(counts), size)
                graph = Graph(exact.astype(np.float32), [np.frombuffer(x, np.int32).reshape(len(counts), -1) for x in links], 0)
                seen = np.zeros(len(counts), np.int64)
                answers = [best[block]] if block in best else []
                for q, (name, query) in enumerate(zip(names.tolist(), asked_)):
                    near = np.array(graph.search(query, width, seen, 64 * (q + 1)))
                    d = np.sqrt(((exact[near] - query) ** 2).sum(1))
                    order = np.argsort(d, kind="stable")
                    # all that are as near as the last wanted one: ties are settled by ids
                    order = order[: max(k + 1, int(np.searchsorted(d[order], d[order[min(k, len(order) - 1)]], "right")))]
                    near, d = near[order], d[order]
                    found = np.concatenate([ids[starts[i]: starts[i] + counts[i]] for i in near.tolist()])
                    far = np.repeat(d, counts[near])[found != name]
                    answers.append((np.full(len(far), q), far, found[found != name]))
                best[block] = first(*map(np.concatenate, zip(*answers)), k)
        for (names, _), (row, far, ids) in best.items():
            yield pa.record_batch([pa.array(np.frombuffer(names, np.int64)[row]), pa.array(ids), pa.array(far)],
                                  ["query_id", "id", "score"])

    tasks = min(shards, TASKS * vectors.sparkSession.sparkContext.defaultParallelism)

    def ranked(part: int) -> DataFrame:
        """The answers to a part of the queries; the rows of a query id are in one part."""
        sent = blocks.where(F.col("part") == part).select(F.col("size").alias("asked_size"), "names", "queries")
        pairs = (stored.repartitionById(tasks, F.pmod("shard", F.lit(tasks)).cast("int"))
                 .join(F.broadcast(sent), F.col("size") == F.col("asked_size")))
        answers = pairs.select("size", "names", "queries", "vectors", "counts", "ids", "links").mapInArrow(
            search, "query_id long, id long, score double")
        places = answers.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id")))
        return written(places.where(F.col("rank") <= k).select("query_id", "rank", "id", "score"), "nearest")

    return reduce(DataFrame.unionByName, map(ranked, range(parts)))
