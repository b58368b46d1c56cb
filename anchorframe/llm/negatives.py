"""Hard negatives with an inverted multi-index.

Vectors are cut into halves, and a small codebook for each half gives every vector a pair of codes: its cell.  Cells are
stored as blocks of bounded size in the shared folder.  For an anchor, an inner product with a member of a cell is at
most the anchor's products with the two centres plus its halves' lengths times the two radii; likewise at least.  A heap
walks the cells by the sum of the half bounds, in falling order, from the two sorted lists of half bounds alone (the
multi-sequence order); cells that hold nothing are passed over.

An anchor asks only cells that can still matter: those whose bound reaches what it needs, its fifth positive so far, or
for each window of scores its last negative so far, the window's lower end while there are too few.  It is done when the
next bound lies under all of these.  Cells are asked in growing rounds; anchors of a task that ask for the same cell
travel together, cells travel once a round, and all state between rounds is written.  The result is exact.

The codebooks come from k-means over a sample (`SAMPLE_ROWS` rows of the smallest hashes, a documented bound); radii and
cells come from all rows.

Defined cases: rows with a null vec_id, label or vector, or a null or non-finite component, take no part; shorter
vectors count as filled up with zeros; of rows that share a vec_id the smallest label and then vector counts; scores
beyond a 64-bit integer count as the largest or smallest of them; anchors without positives, and windows without
negatives, give no rows; further columns are ignored; no vectors give no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anchorframe.llm.common import floored, small_batches, written

SAMPLE_ROWS = 8_192
BLOCK_ROWS = 4_096
PACK_ANCHORS = 512
CELL_ROWS = 1_024
MOST_CODES = 256
FIRST_CELLS = 8
_EXACT = 2.0**52
_LONG = 2**63 - 1
PACK = "block int, ids binary, labels binary, vectors binary"


def usable(vectors: DataFrame, label: Column, scale: float = 256.0) -> DataFrame:
    """(vec_id, label, v): floor(scale * component) of every usable vector, one row a vec_id."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = F.transform("embedding", lambda x: floored(x, scale))
    kept = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(fine, F.lit(False)))
    rows = kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.struct(label.cast("long").alias("label"), v.alias("v")).alias("row"))
    return rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.v")


# --------------------------------------------------------------------------
# codebooks and cells


@dataclass
class Index:
    """Two codebooks; for each cell that holds rows, its halves' radii and its blocks."""

    centres: tuple[np.ndarray, np.ndarray]
    cells: dict[tuple[int, int], tuple[float, float, list[int]]]
    half: int

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.half], x[:, self.half :]


def k_means(points: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Centres of a sample: seeds drawn by squared distance from those before, then some rounds of Lloyd's."""
    rng = np.random.default_rng(11)
    points = np.unique(np.clip(points, -1e60, 1e60), axis=0)
    if len(points) <= k:
        return points
    seeds = [int(rng.integers(len(points)))]
    near = np.square(points - points[seeds[0]]).sum(axis=1)
    while len(seeds) < k:
        seeds.append(int(rng.choice(len(points), p=near / near.sum())) if near.sum() > 0 else int(rng.integers(len(points))))
        near = np.minimum(near, np.square(points - points[seeds[-1]]).sum(axis=1))
    centres = points[seeds]
    for _ in range(rounds):
        code = nearest(points, centres)[0]
        size = np.bincount(code, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, code, points)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point, and the distance to it."""
    with np.errstate(over="ignore", invalid="ignore"):
        away = np.square(centres).sum(axis=1) - 2 * points @ centres.T
    code = np.nan_to_num(away, nan=np.inf).argmin(axis=1)
    with np.errstate(over="ignore"):
        return code, np.sqrt(np.square(points - centres[code]).sum(axis=1))


def matrix(column, width: int) -> np.ndarray:
    """Lists as rows of `width` numbers, filled up with zeros."""
    out = np.zeros((len(column), width))
    for i, row in enumerate(column):
        values = np.asarray(row.values.to_numpy(zero_copy_only=False))
        out[i, : len(values)] = values
    return out


def pack(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x, "<f8").tobytes()


def indexed(rows: DataFrame, codes: int | None = None) -> tuple[Index, DataFrame, int]:
    """The index over rows (vec_id, label, v), its blocks of packed rows as a written table, and the vectors' width."""
    spark = rows.sparkSession
    count, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    width = max(width, 2)
    codes = codes or int(min(MOST_CODES, max(2, ceil(sqrt(count / CELL_ROWS)))))
    # twice the sample by hash first, so that tasks do not each offer a whole one
    share = int(min(1.0, 2 * SAMPLE_ROWS / max(count, 1)) * 1_000_000)
    some = rows.filter(F.pmod(F.xxhash64(F.lit("sample"), "vec_id"), F.lit(1_000_000)) < share)
    sample = some.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("v").toArrow()
    points = matrix(sample["v"], width) if sample.num_rows else np.zeros((1, width))
    half = width // 2
    centres = (k_means(points[:, :half], codes), k_means(points[:, half:], codes))
    shared = spark.sparkContext.broadcast((centres, half, width))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (left, right), half, width = shared.value
        for batch in batches:
            x = matrix(batch.column(2), width)
            (a, ra), (b, rb) = nearest(x[:, :half], left), nearest(x[:, half:], right)
            made = [pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(ra), pa.array(rb)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], ["vec_id", "label", "v", "a", "b", "ra", "rb"])

    coded = written(small_batches(rows.select("vec_id", "label", "v")).mapInArrow(code, "vec_id long, label long, v array<double>, a int, b int, ra double, rb double"), "coded")
    # a row a cell, of which the codebooks bound the number
    sizes = sorted(coded.groupBy("a", "b").agg(F.count("*").alias("n"), F.max("ra").alias("ra"), F.max("rb").alias("rb")).collect())
    cells, first = {}, 0
    for a, b, n, ra, rb in sizes:
        parts = ceil(n / BLOCK_ROWS)
        cells[a, b] = (ra, rb, list(range(first, first + parts)))
        first += parts
    placed = spark.createDataFrame([(a, b, blocks[0], len(blocks)) for (a, b), (_, _, blocks) in cells.items()], "a int, b int, first int, parts int")
    block = (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")).alias("block")

    def packed(group: pa.Table) -> pa.Table:
        group = group.sort_by("vec_id")  # ties then come in order
        x = matrix(group["v"], shared.value[2])
        row = [group["block"][0].as_py(), group["vec_id"].to_numpy().astype("<i8").tobytes(), group["label"].to_numpy().astype("<i8").tobytes(), pack(x)]
        return pa.Table.from_pylist([dict(zip(("block", "ids", "labels", "vectors"), row))], schema=pa.schema([("block", pa.int32()), *((c, pa.binary()) for c in ("ids", "labels", "vectors"))]))

    held = coded.join(F.broadcast(placed), ["a", "b"]).select(block, "vec_id", "label", "v").groupBy("block").applyInArrow(packed, PACK)
    return Index(centres, cells, half), written(held, "cells"), width


# --------------------------------------------------------------------------
# the order of cells


class Bounds:
    """The cells for one anchor, by falling upper bound of the inner product with any of their rows."""

    def __init__(self, index: Index, radii: tuple[np.ndarray, np.ndarray], anchor: np.ndarray):
        halves = anchor[: index.half], anchor[index.half :]
        self.index = index
        self.length = [float(np.sqrt(h @ h)) for h in halves]
        with np.errstate(over="ignore", invalid="ignore"):  # where doubles end, a bound is infinite
            self.product = [c @ h for c, h in zip(index.centres, halves)]
            upper = [np.nan_to_num(p + n * r, nan=np.inf, posinf=np.inf, neginf=-np.inf) for p, n, r in zip(self.product, self.length, radii)]
        self.order = [np.argsort(-u, kind="stable") for u in upper]
        self.upper = [u[o] for u, o in zip(upper, self.order)]
        # what rounding may have taken from a bound
        self.slack = 1e-9 * (1 + sum(n * (r.max(initial=0.0) + np.sqrt(np.square(c).sum(axis=1)).max(initial=0.0)) for n, r, c in zip(self.length, radii, index.centres)))

    def __iter__(self) -> Iterator[tuple[float, float, list[int]]]:
        """(upper bound, lower bound, blocks): the upper bounds by which the heap walks fall, those of the cells are tighter."""
        u, v = self.upper
        heap, seen = [(-(u[0] + v[0]), 0, 0)], {(0, 0)}  # a codebook has one centre at least
        while heap:
            at, i, j = heapq.heappop(heap)
            for step in ((i + 1, j), (i, j + 1)):
                if step[0] < len(u) and step[1] < len(v) and step not in seen:
                    seen.add(step)
                    heapq.heappush(heap, (-(u[step[0]] + v[step[1]]), *step))
            a, b = int(self.order[0][i]), int(self.order[1][j])
            cell = self.index.cells.get((a, b))
            if cell is not None:
                middle, reach = self.product[0][a] + self.product[1][b], self.length[0] * cell[0] + self.length[1] * cell[1]
                yield -at + self.slack, min(-at, middle + reach) + self.slack, middle - reach - self.slack, cell[2]


# --------------------------------------------------------------------------
# rounds


def exact_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exactly, held to 64 bits."""
    top = x.shape[1] * np.abs(x).max(initial=0.0) * np.abs(y).max(initial=0.0)
    if top < _EXACT:
        return (x @ y.T).astype(np.int64)
    whole = lambda m: np.array([[int(c) for c in row] for row in m.tolist()], object).reshape(m.shape)
    return np.clip(whole(x) @ whole(y).T, -_LONG - 1, _LONG).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest allowed scores, ties to the smaller id; ids ascend."""
    held = np.flatnonzero(allowed)
    if len(held) > k:
        last = np.partition(scores[held], len(held) - k)[len(held) - k]
        held = held[scores[held] >= last]
    return held[np.argsort(-scores[held], kind="stable")[:k]]


def asked(anchors: DataFrame, index, width: int, skip: int, take: int) -> DataFrame:
    """Anchors' next cells, those after the skip-th that they walk to the take-th after it: (block, anchors) with packed anchors.

    anchors: (anchor_id, label, v, need, lows, highs).  A cell is asked for if its upper bound reaches `need` and its
    lower bound does not lie above the highest window.  A row with block -1 tells that some anchor has more cells to walk.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Index(*index.value)
        radii = tuple(np.zeros(len(c)) for c in own.centres)
        for (a, b), (ra, rb, _) in own.cells.items():
            radii[0][a], radii[1][b] = max(radii[0][a], ra), max(radii[1][b], rb)
        more = False
        for batch in batches:
            x = matrix(batch.column(2), width)
            needs, highs = batch.column(3).to_pylist(), batch.column(5).to_pylist()
            wanted: dict[int, list[int]] = {}
            for i in range(batch.num_rows):
                need = -np.inf if needs[i] is None else float(needs[i])
                highest, walked = max(highs[i], default=_LONG), 0
                for walk, upper, lower, blocks in Bounds(own, radii, x[i]):
                    if max(walk, -_LONG - 1.0) < need:  # scores are held to 64 bits, so bounds are
                        break
                    if walked >= skip + take:
                        more = True
                        break
                    walked += 1
                    if walked > skip and not (max(upper, -_LONG - 1.0) < need or (lower > highest and highest < _LONG)):
                        for block in blocks:
                            wanted.setdefault(block, []).append(i)
            for block, who in wanted.items():
                for at in range(0, len(who), PACK_ANCHORS):
                    yield row(block, batch.take(pa.array(who[at : at + PACK_ANCHORS])))
        if more:
            yield row(-1, None)

    def row(block: int, part: pa.RecordBatch | None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([part and serialised(part)], pa.binary())], ["block", "anchors"])

    return small_batches(anchors.select("anchor_id", "label", "v", "need", "lows", "highs")).mapInArrow(run, "block int, anchors binary")


def serialised(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


FOUND = "anchor_id long, slot int, vec_id long, score long"


def met(asks: DataFrame, cells: DataFrame, width: int, k: int, same_label: bool) -> DataFrame:
    """FOUND: for every asking anchor and window the k best rows of each cell it asked for.

    With same_label the anchor's own label counts and its window is everything; else other labels and its windows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"anchor_id": [], "slot": [], "vec_id": [], "score": []}
            for row in batch.to_pylist():
                ids, labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
                y = np.frombuffer(row["vectors"], "<f8").reshape(len(ids), width)
                for part in pa.ipc.open_stream(row["anchors"]):
                    scores = exact_products(matrix(part.column(2), width), y)
                    for i, r in enumerate(part.drop_columns(["v"]).to_pylist()):
                        own, kind = scores[i], labels == r["label"]
                        windows = [(None, None)] if same_label else list(zip(r["lows"], r["highs"]))
                        for slot, (low, high) in enumerate(windows):
                            allowed = kind & (ids != r["anchor_id"]) if same_label else ~kind & (own >= low) & (own <= high)
                            if same_label and r["need"] is not None:
                                allowed &= own >= r["need"]
                            for p in best(own, ids, allowed, k).tolist():
                                for c, value in zip(out, (r["anchor_id"], slot, ids[p], own[p])):
                                    out[c].append(int(value))
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("anchor_id", pa.int64()), ("slot", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())]))

    # a joined row holds a cell's block: batches are bounded in bytes
    return small_batches(asks.join(cells, "block").select("anchors", "ids", "labels", "vectors")).mapInArrow(run, FOUND)


def top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(anchors: DataFrame, index: Index, cells: DataFrame, width: int, k: int, same_label: bool) -> DataFrame:
    """FOUND and rank, written: the k best rows of every anchor and window.  anchors: (anchor_id, label, v, lows, highs)."""
    spark = anchors.sparkSession
    shared = spark.sparkContext.broadcast((index.centres, index.cells, index.half))
    found = written(spark.createDataFrame([], FOUND + ", rank int"), "found")
    slots = anchors.select("anchor_id", F.posexplode_outer("lows").alias("slot", "low")).withColumn("slot", F.coalesce("slot", F.lit(0)))
    skip, take = 0, FIRST_CELLS
    while True:
        # what the anchor still needs: the least, over its windows, of the k-th score or, with fewer, the lower end
        last = found.groupBy("anchor_id", "slot").agg(F.max("rank").alias("n"), F.min("score").alias("least")).filter(F.col("n") == k)
        need = slots.join(last, ["anchor_id", "slot"], "left").groupBy("anchor_id").agg(F.min(F.coalesce("least", "low")).alias("need"))
        asks = written(asked(anchors.join(need, "anchor_id"), shared, width, skip, take), "asks")
        found = written(top(found.drop("rank").unionByName(met(asks.filter("block >= 0"), cells, width, k, same_label)), k), "found")
        if asks.filter("block < 0").isEmpty():
            return found
        skip, take = skip + take, 4 * take


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, codes: int | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    rows: (vec_id, label, v) as `usable` gives them; anchor: the condition on rows that makes an anchor.  The anchor's
    positives are its best other rows of its label; each positive's negatives are the best rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score.
    """
    rows = written(rows, "vectors")
    index, cells, width = indexed(rows, codes)
    nothing = F.array().cast("array<long>")
    anchors = written(rows.filter(anchor).select(F.col("vec_id").alias("anchor_id"), "label", "v"), "anchors")
    asking = anchors.withColumns({"lows": nothing, "highs": nothing})
    own = search(asking, index, cells, width, positives, same_label=True).select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    # windows in whole numbers: the smallest and largest score inside, by exact decimal arithmetic
    p = F.col("positive_score").cast("decimal(20,0)")
    held = lambda end: F.greatest(F.least(end.cast("decimal(38,0)"), F.lit(_LONG).cast("decimal(38,0)")), F.lit(-_LONG).cast("decimal(38,0)")).cast("long")
    ends = own.select("anchor_id", "positive_score", held(F.ceil(p * low / 100)).alias("lo"), held(F.floor(p * high / 100)).alias("hi")).distinct().filter("lo <= hi")
    windows = ends.groupBy("anchor_id").agg(F.sort_array(F.collect_set(F.struct("lo", "hi"))).alias("w"))
    asking = anchors.join(windows, "anchor_id").select("anchor_id", "label", "v", F.col("w.lo").alias("lows"), F.col("w.hi").alias("highs"), "w")
    found = search(asking.drop("w"), index, cells, width, negatives, same_label=False)
    slots = windows.select("anchor_id", F.posexplode("w").alias("slot", "w")).select("anchor_id", "slot", "w.lo", "w.hi")
    each = own.join(ends, ["anchor_id", "positive_score"]).join(slots, ["anchor_id", "lo", "hi"]).join(found, ["anchor_id", "slot"])
    return each.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
"""
