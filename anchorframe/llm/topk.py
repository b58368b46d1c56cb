"""Exact top-k search by inner product with M-trees.

Vectors are dealt into shards, queries into blocks; every task holds one shard and one block, both of bounded size.  It
builds an M-tree over its shard: pages of routing vectors with covering radii and distances to the parent's routing
vector, leaves of vectors with their distances to the leaf's.  An added coordinate that gives all vectors the same length
turns the largest inner product into the smallest distance.  Every query walks the tree best-first; stored distances and
the triangle inequality rule out children and leaf entries before their distance is computed.  Tasks return their best
k, and the best k of those are kept.  All bounds carry a slack for rounding, so nothing that could tie is passed over.

Defined cases: vectors that are null or hold null or non-finite components take no part; a shorter vector counts as if
filled up with zeros; rows with a null vec_id take no part; a query's own rows are all rows with its vec_id; a row that
repeats another (same vec_id and vector) counts once; ties go to the smaller vec_id; further columns are ignored; no
vectors give no rows.  Vectors whose products a double cannot hold exactly stay out of the trees and are multiplied as
integers of any size; a score beyond a 64-bit integer counts as the largest or smallest of them.
"""

from __future__ import annotations

import heapq
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anchorframe.llm.common import floored

PAGE = 1024
FANOUT = 16
SHARD_ROWS = 32_768
BLOCK_ROWS = 16_384
_EXACT = 2.0**52


def quantised(vectors: DataFrame, scale: float = 64.0) -> DataFrame:
    """(vec_id, v): floor(scale * component) of every usable vector, once per distinct row."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = F.transform("embedding", lambda x: floored(x, scale))
    return vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(usable, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).distinct()


class MTree:
    """An M-tree over the rows of `points`, for the largest inner products."""

    def __init__(self, points: np.ndarray):
        self.raw = points
        norms = np.einsum("ij,ij->i", points, points)
        self.top = float(norms.max(initial=0.0))
        self.points = np.c_[points, np.sqrt(np.maximum(self.top - norms, 0.0))]
        self.root = self._node(np.arange(len(points)), np.random.default_rng(7))

    def _route(self, rows: np.ndarray) -> tuple[int, np.ndarray, float]:
        """The member nearest to the centre, all members' distances to it, and the covering radius."""
        own = self.points[rows]
        route = int(rows[np.square(own - own.mean(axis=0)).sum(axis=1).argmin()])
        away = np.sqrt(np.square(own - self.points[route]).sum(axis=1))
        return route, away, float(away.max(initial=0.0))

    def _node(self, rows: np.ndarray, rng: np.random.Generator) -> dict:
        route, away, radius = self._route(rows) if len(rows) else (0, np.empty(0), 0.0)
        if len(rows) <= PAGE:
            return {"route": route, "radius": radius, "rows": rows, "away": away, "page": np.ascontiguousarray(self.raw[rows])}
        seeds = [int(rng.choice(rows))]
        near = np.square(self.points[rows] - self.points[seeds[0]]).sum(axis=1)
        part = np.zeros(len(rows), np.int64)
        while len(seeds) < min(FANOUT, ceil(len(rows) / PAGE) + 1) and near.max() > 0:  # farthest first
            seeds.append(int(rows[near.argmax()]))
            d = np.square(self.points[rows] - self.points[seeds[-1]]).sum(axis=1)
            part[d < near] = len(seeds) - 1
            near = np.minimum(near, d)
        if len(seeds) == 1:  # all the same vector: cut anywhere
            part = np.arange(len(rows)) // PAGE
        children = [self._node(rows[part == i], rng) for i in np.unique(part)]
        routes = np.array([c["route"] for c in children])
        to_parent = np.sqrt(np.square(self.points[routes] - self.points[route]).sum(axis=1))
        return {"route": route, "radius": radius, "children": children, "routes": routes, "to_parent": to_parent, "radii": np.array([c["radius"] for c in children])}

    def search(self, query: np.ndarray, k: int, ids: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and inner products of the best k rows whose id is not `own`; ties to the smaller id."""
        length = float(query @ query)
        slack = 1e-9 * (length + self.top) + 1e-9
        q = np.r_[query, 0.0]
        rows, scores = np.empty(0, np.int64), np.empty(0)
        reach = np.inf  # no better row lies further away

        def distance(to: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(length + self.top - 2 * (self.points[to] @ q), 0.0))

        first = float(distance(np.array([self.root["route"]]))[0]) if len(ids) else 0.0
        queue, tie = [(max(0.0, first - self.root["radius"]), 0, first, self.root)], 0
        while queue and queue[0][0] <= reach:
            bound, _, to_route, node = heapq.heappop(queue)
            if "children" in node:
                left = np.flatnonzero(np.abs(to_route - node["to_parent"]) - node["radii"] <= reach)
                if len(left):
                    away = distance(node["routes"][left])
                    for i, d in zip(left.tolist(), away.tolist()):
                        low = max(bound, d - node["radii"][i])
                        if low <= reach:
                            tie += 1
                            heapq.heappush(queue, (low, tie, d, node["children"][i]))
                continue
            left = np.flatnonzero(np.abs(to_route - node["away"]) <= reach)
            if 2 * len(left) > len(node["rows"]):  # a whole page is multiplied faster than most of it is picked out
                left, found = node["rows"], node["page"] @ query
            else:
                left, found = node["rows"][left], node["page"][left] @ query
            if len(scores) == k:
                better = np.flatnonzero(found >= scores[-1])
                left, found = left[better], found[better]
            better = ids[left] != own
            if better.any():
                rows, scores = np.r_[rows, left[better]], np.r_[scores, found[better]]
                order = np.lexsort((ids[rows], -scores))[:k]
                rows, scores = rows[order], scores[order]
                if len(scores) == k:
                    reach = float(np.sqrt(max(length + self.top - 2 * scores[-1], 0.0) + slack)) + 1e-9
        return rows, scores


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    values, lengths = lists.flatten().to_numpy(zero_copy_only=False), np.asarray(lists.value_lengths().to_pylist(), np.int64)
    out = np.zeros((len(lengths), width))
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def _whole_products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers of any size, held to 64 bits."""
    whole = [int(c) for c in q]
    return np.array([min(max(sum(int(a) * b for a, b in zip(row, whole)), -(2**63)), 2**63 - 1) for row in x.tolist()], np.int64)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score) for every query; vectors and queries: (vec_id, v) as `quantised` gives them."""
    spark = vectors.sparkSession
    n, m = vectors.count(), queries.count()
    shards = max(1, ceil(n / SHARD_ROWS), min(spark.sparkContext.defaultParallelism, ceil(n / 1024)))
    blocks = max(1, ceil(m / BLOCK_ROWS))

    def part(of: int):
        return F.pmod(F.xxhash64("vec_id"), F.lit(of)).cast("int")

    def each(of: int):
        return F.explode(F.sequence(F.lit(0), F.lit(of - 1)))

    held = vectors.select(F.lit(False).alias("asks"), "vec_id", "v", part(shards).alias("shard")).select("*", each(blocks).alias("block"))
    asked = queries.select(F.lit(True).alias("asks"), "vec_id", "v", part(blocks).alias("block")).select("asks", "vec_id", "v", each(shards).alias("shard"), "block")

    def run(group: pa.Table) -> pa.Table:
        asks = group["asks"].to_numpy(zero_copy_only=False).astype(bool)
        width = max(group["v"].combine_chunks().value_lengths().to_pylist() or [0])
        x, ids = _matrix(group["v"], width), group["vec_id"].to_numpy()
        data, data_ids, wanted, wanted_ids = x[~asks], ids[~asks], x[asks], ids[asks]
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if len(data) and len(wanted):
            large, asks_large = (np.abs(m).max(axis=1, initial=0.0) >= np.sqrt(_EXACT / max(width, 1)) for m in (data, wanted))

            def add(own: int, rows: np.ndarray, scores: np.ndarray) -> None:
                out["query_id"].extend([own] * len(rows))
                out["vec_id"].extend(rows.tolist())
                out["score"].extend(scores.tolist())

            tree, tree_ids = MTree(data[~large]), data_ids[~large]
            for q, own in zip(wanted[~asks_large], wanted_ids[~asks_large].tolist()):
                rows, scores = tree.search(q, k, tree_ids, own)
                add(own, tree_ids[rows], scores.astype(np.int64))
            # large vectors against all, all against large ones: each pair that the tree has not seen, once
            for q, own, of in [*((q, i, slice(None)) for q, i in zip(wanted[asks_large], wanted_ids[asks_large].tolist())),
                               *((q, i, large) for q, i in zip(wanted[~asks_large], wanted_ids[~asks_large].tolist()) if large.any())]:
                rows, scores = data_ids[of], _whole_products(data[of], q)
                rows, scores = rows[rows != own], scores[rows != own]
                best = np.lexsort((rows, ~scores))[:k]  # ~ turns the order of integers of any sign
                add(own, rows[best], scores[best])
        return pa.table(out, schema=pa.schema([(c, pa.int64()) for c in out]))

    found = held.unionByName(asked).groupBy("shard", "block").applyInArrow(run, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # a vec_id with several vectors can be found, and asked for, more than once; its best score counts
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""
