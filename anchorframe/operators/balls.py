"""Sums of distances from new rows to the rows of each cluster, without meeting every row.

The clusters' rows lie in the leaves of a space tree.  Every node of the tree knows, for each cluster, how many rows it
holds, their centre, their second moments around it and how far they reach.  Far from a node the distances to its rows
add up to an expansion around the centre,

    n D + (trace S - u' S u) / (2 D),    D the distance to the centre, u its direction, S the second moments,

and the third derivative of a distance, 2 / sqrt(3) / D**2 at most, bounds what that leaves out.  In the plane, and on the
line, points are complex numbers and the expansion goes on to order 16: with z the distance to the centre as such a number,
|z - t| = |z| |1 - t / z|, whose powers of t add up to moments that all rows share.  Where the bound is within `tolerance` of the sum, the node's rows are not read; else its children are asked, and in a leaf the rows
themselves.  Each sum is thus within a factor of 1 +- tolerance of the exact one; with tolerance 0 it is exact.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorframe.operators.neighbours import CHUNK_ROWS, LEAF_ROWS, Tree, _bytes, _read, distances, packs_joined, space_index
from anchorframe.operators.stats import STAY_BYTES, STAY_ROWS, _packs
from anchorframe.session import configure

#: Keeps a silhouette within 1e-6: it changes by three times this factor at most.
TOLERANCE = 3e-7
#: Powers of the expansion in the plane; near the limit of a double its bound is reached from five times a node's reach.
ORDERS = (6, 16)
_J, _K = (np.array(c) for c in zip(*((j, k) for j in range(ORDERS[-1] + 1) for k in range(min(j, ORDERS[-1] - j) + 1))))
#: Of the square root of 1 - z: coefficients of its powers, and binomials to move moments.
_ROOT = np.cumprod([1.0, *((j - 1.5) / j for j in range(1, ORDERS[-1] + 2))])
_BINOMIAL = np.array([[math.comb(j, a) for a in range(ORDERS[-1] + 1)] for j in range(ORDERS[-1] + 1)], float)
PACKED = "leaf int, clusters binary, counts binary, vectors binary"


def _over(x: np.ndarray, scale: float) -> np.ndarray:
    return x / scale if scale > 0 else np.zeros_like(x)


def as_plane(x: np.ndarray) -> np.ndarray:
    """Rows of one or two numbers as complex ones."""
    return x[..., 0] + (1j * x[..., 1] if x.shape[-1] > 1 else 0j)


def _raised(z: np.ndarray, most: int) -> np.ndarray:
    """Powers 0 to most of complex numbers, one below the other."""
    out = np.ones((most + 1, len(z)), complex)
    for i in range(most):
        np.multiply(out[i], z, out=out[i + 1])
    return out


def plane_moments(away: np.ndarray, weight: np.ndarray, reach: float) -> np.ndarray:
    """Sums of t**j * conj(t)**k over differences t to a centre, in units of the reach, for the pairs (_J, _K)."""
    powers = _raised(_over(as_plane(away), reach), ORDERS[-1])
    return ((powers * weight) @ powers.conj().T)[_J, _K]


def _square(moments: np.ndarray) -> np.ndarray:
    out = np.zeros((ORDERS[-1] + 1, ORDERS[-1] + 1), complex)
    out[_J, _K], out[_K, _J] = moments, moments.conj()
    return out


def moved_moments(moments: np.ndarray, reach: float, shift: np.ndarray, wider: float) -> np.ndarray:
    """The same moments around another centre, which lies -shift away, in units of the wider reach."""
    steps = np.arange(ORDERS[-1] + 1)
    by = np.tril(_BINOMIAL * _over(as_plane(shift), wider) ** np.maximum(steps[:, None] - steps, 0)) * _over(np.float64(reach), wider) ** steps
    return (by @ _square(moments) @ by.conj().T)[_J, _K]


@dataclass
class Balls:
    """By cluster and node of the tree: rows, centre, second moments, reach; in the plane also `plane_moments`."""

    clusters: list[int]
    count: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    radius: np.ndarray
    plane: np.ndarray | None = None

    @classmethod
    def of(cls, tree: Tree, leaves: list[tuple]) -> Balls:
        """leaves: (leaf, cluster, n, centre, moments, reach, plane) of every leaf and cluster that has rows."""
        clusters = sorted({r[1] for r in leaves})
        k, nodes, d = len(clusters), len(tree.dim), tree.low.shape[1]
        out = cls(clusters, np.zeros((k, nodes)), np.zeros((k, nodes, d)), np.zeros((k, nodes, d, d)), np.zeros((k, nodes)))
        if d <= 2:
            out.plane = np.zeros((k, nodes, len(_J)), complex)
        node_of = {int(number): i for i, number in enumerate(tree.leaf) if number >= 0}
        place = {c: i for i, c in enumerate(clusters)}
        for leaf, cluster, n, centre, moments, reach, plane in leaves:
            at = place[cluster], node_of[leaf]
            out.count[at], out.centre[at], out.spread[at], out.radius[at] = n, centre, np.array(moments).reshape(d, d), reach
            if d <= 2:
                out.plane[at] = np.frombuffer(plane, complex)
        for i in range(nodes - 1, -1, -1):  # children come after their parents
            if tree.children[i, 0] >= 0:
                both = tree.children[i]
                n = out.count[:, both]
                total = n.sum(axis=1)
                out.count[:, i] = total
                out.centre[:, i] = (n[:, :, None] * out.centre[:, both]).sum(axis=1) / np.maximum(total, 1)[:, None]
                shift = out.centre[:, both] - out.centre[:, i][:, None]
                out.spread[:, i] = out.spread[:, both].sum(axis=1) + np.einsum("kc,kci,kcj->kij", n, shift, shift)
                reach = np.sqrt(np.square(shift).sum(axis=2)) + out.radius[:, both]
                out.radius[:, i] = np.where(n > 0, reach, 0.0).max(axis=1)
                for c, side in zip(*np.nonzero(n)) if d <= 2 else ():
                    out.plane[c, i] += moved_moments(out.plane[c, both[side]], out.radius[c, both[side]], shift[c, side], out.radius[c, i])
        return out

    def _expanded(self, c: int, i: int, away: np.ndarray, d: np.ndarray, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
        """Of rows by their differences to a node's centre: which lie far enough, and those rows' sums."""
        n, reach, spread = self.count[c, i], self.radius[c, i], self.spread[c, i]
        trace, gap = float(np.trace(spread)), d - reach * (1 + 1e-9)
        safe = np.maximum(gap, 1e-100)
        if self.plane is None:
            # sum of |row - centre|**3 is at most radius * trace; 2 / sqrt(3) / 6 < 0.19246
            error = 0.19246 * reach * trace / np.square(safe)
            fine = (gap > 0) & (error <= tolerance * n * safe)
            u = away[fine] / d[fine, None]
            return fine, n * d[fine] + (trace - np.einsum("ri,ij,rj->r", u, spread, u)) / (2 * d[fine])
        fine, sums = np.zeros(len(d), bool), np.zeros(len(d))
        part = np.where(gap > 0, reach / np.maximum(d, 1e-100), 1.0)
        whole = _square(self.plane[c, i]) * (2 - np.eye(ORDERS[-1] + 1)) * np.outer(_ROOT[:-1], _ROOT[:-1])
        for order in ORDERS:
            # coefficients of order m add up to 4 * |_ROOT[m]|, and fall; sum of |row - centre|**2 is the trace
            error = 4 * abs(_ROOT[order + 1]) * part ** (order - 1) / np.maximum(1 - part, 1e-100) * trace / np.maximum(d, 1e-100)
            now = ~fine & (gap > 0) & (error <= tolerance * n * safe)
            if now.any():
                powers = _raised(reach / as_plane(away[now]), order)
                j, k = np.indices((order + 1, order // 2 + 1))
                terms = np.where((j >= k) & (j + k <= order), whole[: order + 1, : order // 2 + 1], 0)
                sums[now] = d[now] * ((terms.T @ powers) * powers[: order // 2 + 1].conj()).sum(axis=0).real
                fine |= now
        return fine, sums[fine]

    def far(self, tree: Tree, c: int, x: np.ndarray, tolerance: float) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
        """Of one cluster: each row's sum over the nodes that lie far enough, and the leaves that it has to meet itself."""
        sums, near = np.zeros(len(x)), []
        stack = [(0, np.arange(len(x)))]
        while stack:
            i, rows = stack.pop()
            n = self.count[c, i]
            if not n or not len(rows):
                continue
            away = x[rows] - self.centre[c, i]
            d = np.sqrt(np.square(away).sum(axis=1))
            fine, far = self._expanded(c, i, away, d, tolerance)
            sums[rows[fine]] += far
            rows = rows[~fine]
            if len(rows):
                if tree.children[i, 0] < 0:
                    near.append((int(tree.leaf[i]), rows))
                else:
                    stack += [(int(child), rows) for child in tree.children[i]]
        return sums, near

    def arrays(self) -> dict:
        return {"clusters": self.clusters, **{c: getattr(self, c) for c in ("count", "centre", "spread", "radius", "plane")}}

    def to_lists(self) -> dict:
        """All but the moments of the plane, which are many."""
        return {"clusters": self.clusters, **{c: getattr(self, c).tolist() for c in ("count", "centre", "spread", "radius")}}

    @classmethod
    def from_lists(cls, lists: dict, plane: np.ndarray | None = None) -> Balls:
        return cls(list(lists["clusters"]), *(np.array(lists[c]) for c in ("count", "centre", "spread", "radius")), plane)


@dataclass
class BallIndex:
    """Cluster rows in leaves, and what the tree's nodes know of them."""

    leaves: DataFrame  # PACKED
    tree: Tree
    balls: Balls
    width: int

    def save(self, path: str) -> None:
        self.leaves.write.mode("overwrite").parquet(f"{path}/leaves")
        settings = json.dumps({"tree": self.tree.to_lists(), "balls": self.balls.to_lists(), "width": self.width})
        plane = None if self.balls.plane is None else bytearray(self.balls.plane.tobytes())
        self.leaves.sparkSession.createDataFrame([(settings, plane)], "settings string, plane binary").write.mode("overwrite").parquet(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BallIndex:
        row = spark.read.parquet(f"{path}/settings").first().asDict()
        s, plane = json.loads(row["settings"]), row.get("plane")
        balls = Balls.from_lists(s["balls"])
        if plane is not None:
            balls.plane = np.frombuffer(plane, complex).reshape(*balls.count.shape, len(_J))
        return cls(spark.read.parquet(f"{path}/leaves"), Tree.from_lists(s["tree"]), balls, s["width"])


def ball_index(points: DataFrame, leaf_rows: int = LEAF_ROWS) -> BallIndex:
    """An index over (vec, cluster) rows; equal rows are one with a count."""
    spark = configure(points.sparkSession)
    space = space_index(points, "vec", leaf_rows)
    tree, width = space.tree, space.width
    sent = spark.sparkContext.broadcast(tree.to_lists())
    rows = points.groupBy(F.transform("vec", lambda x: x.cast("double") + F.lit(0.0)).alias("v"), F.col("cluster").cast("long").alias("cluster")).agg(F.count("*").alias("n")).filter("v is not null")

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Tree.from_lists(sent.value)
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            yield pa.RecordBatch.from_arrays([pa.array(own.leaf_of(x), pa.int32()), *batch.columns], ["leaf", "v", "cluster", "n"])

    def packed(group: pa.Table) -> pa.Table:
        x = group["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        cluster, n = group["cluster"].to_numpy(), group["n"].to_numpy()
        known = []
        for c in np.unique(cluster):
            own, weight = x[cluster == c], n[cluster == c]
            centre = (weight[:, None] * own).sum(axis=0) / weight.sum()
            away = own - centre
            reach = float(np.sqrt(np.square(away).sum(axis=1)).max())
            known.append({"cluster": int(c), "n": int(weight.sum()), "centre": centre.tolist(), "moments": ((weight[:, None] * away).T @ away).ravel().tolist(),
                          "reach": reach, "plane": plane_moments(away, weight, reach).tobytes() if width <= 2 else None})
        row = {"leaf": group["leaf"][0].as_py(), "clusters": _bytes(cluster, "<i8"), "counts": _bytes(n, "<i8"), "vectors": _bytes(x), "known": known}
        entry = pa.struct([("cluster", pa.int64()), ("n", pa.int64()), ("centre", pa.list_(pa.float64())), ("moments", pa.list_(pa.float64())), ("reach", pa.float64()), ("plane", pa.binary())])
        return pa.Table.from_pylist([row], schema=pa.schema([("leaf", pa.int32()), *((c, pa.binary()) for c in ("clusters", "counts", "vectors")), ("known", pa.list_(entry))]))

    known = "array<struct<cluster:long,n:long,centre:array<double>,moments:array<double>,reach:double,plane:binary>>"
    held = rows.mapInArrow(numbered, "leaf int, v array<double>, cluster long, n long").groupBy("leaf").applyInArrow(packed, f"{PACKED}, known {known}").checkpoint()
    # numbers a leaf and cluster, not rows
    summary = [(r["leaf"], *k) for r in held.select("leaf", "known").collect() for k in r["known"]]
    return BallIndex(held.drop("known"), tree, Balls.of(tree, summary), width)


#: Leaves of a cluster that rows meet on average, up to which they are sent there.
MOST_ASKED = 8
#: New rows of a task at least, those that walk the tree together, and what a task holds of which rows meet which leaves.
LEAST_ROWS, WALK_ROWS, WANTED_BITS = 1 << 11, 1 << 12, 1 << 29
#: Instead of a leaf's number: sums over far nodes, and rows that stay in a task.
FAR, STAYS = -1, -2
#: From this tolerance on distances are made by products of matrices.
LEAST_PRODUCT = 1e-9


def near_sums(x: np.ndarray, y: np.ndarray, member: np.ndarray, tolerance: float) -> np.ndarray:
    """Distances of rows x to points y times the points' weights in each cluster.

    Each distance is within a factor of 1 +- tolerance: a product of matrices gives the squares, and differences those
    that would cancel there.
    """
    out = np.empty((len(x), member.shape[1]))
    if tolerance < LEAST_PRODUCT:
        for i in range(0, len(x), CHUNK_ROWS):
            out[i : i + CHUNK_ROWS] = distances(x[i : i + CHUNK_ROWS], y) @ member
        return out
    centre = y.mean(axis=0)
    a, b = x - centre, y - centre
    aa, bb = np.square(a).sum(axis=1), np.square(b).sum(axis=1)
    left, right = np.column_stack([a, aa, np.ones(len(a))]), np.ascontiguousarray(np.column_stack([-2.0 * b, np.ones(len(b)), bb]).T)
    # rounding is off by less than this in a square, whose root is off by half as much in proportion
    least = (4 * x.shape[1] + 16) * 2.0**-53 * (aa + bb.max()) * (1 + 1 / tolerance)
    room = np.empty((CHUNK_ROWS, len(y)))
    for i in range(0, len(x), CHUNK_ROWS):
        part = slice(i, min(i + CHUNK_ROWS, len(x)))
        d = np.matmul(left[part], right, out=room[: part.stop - i])
        low = ~(d.min(axis=1) > least[part])
        if low.any():
            rows = np.flatnonzero(low)
            at, j = np.nonzero(~(d[rows] > least[part][rows, None]))
            d[rows[at], j] = np.square(x[i + rows[at]] - y[j]).sum(axis=1)
        out[part] = np.sqrt(d, out=d) @ member
    return out


def _walked(tree: Tree, balls: Balls, x: np.ndarray, tolerance: float, most: int | None = None) -> tuple[np.ndarray | None, dict[int, np.ndarray]]:
    """Rows' sums over far nodes by cluster, and for each leaf that rows have to meet which rows and clusters do.

    No sums where the rows of a cluster meet more than `most` leaves on average.
    """
    sums, meet = np.zeros((len(x), len(balls.clusters))), {}
    for c in range(len(balls.clusters)):
        sums[:, c], near = balls.far(tree, c, x, tolerance)
        if most is not None and sum(len(rows) for _, rows in near) > most * len(x):
            return None, {}
        for leaf, rows in near:
            meet.setdefault(leaf, np.zeros(sums.shape, bool))[rows, c] = True
    return sums, meet


class _Asking:
    """New rows that stay in a task, with their sums over far nodes and over the leaves that have passed by."""

    def __init__(self, data: bytes, tree: Tree, balls: Balls, tolerance: float):
        table = pa.ipc.open_stream(data).read_all()
        self.ids, self.tolerance, self.clusters = table["id"].combine_chunks(), tolerance, np.array(balls.clusters, np.int64)
        self.x = table["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(table), -1)
        self.sums = np.zeros((len(self.x), len(self.clusters)))
        self.near: dict[int, list[tuple[int, np.ndarray]]] = {}  # by leaf: first row, and clusters if all rows meet the same, else bits of rows and clusters
        for i in range(0, len(self.x), WALK_ROWS):
            self.sums[i : i + WALK_ROWS], meet = _walked(tree, balls, self.x[i : i + WALK_ROWS], tolerance)
            for leaf, wanted in meet.items():
                self.near.setdefault(leaf, []).append((i, wanted[0].copy() if (wanted == wanted[0]).all() else np.packbits(wanted)))

    def meet(self, leaf: int, cluster: np.ndarray, n: np.ndarray, y: np.ndarray) -> None:
        member = (cluster[:, None] == self.clusters) * n[:, None].astype(float)
        for first, told in self.near.pop(leaf, ()):
            x = self.x[first : first + WALK_ROWS]
            shape = len(x), len(self.clusters)
            wanted = np.broadcast_to(told, shape) if told.dtype == bool else np.unpackbits(told, count=shape[0] * shape[1]).reshape(shape).view(bool)
            rows = np.flatnonzero(wanted.any(axis=1))
            self.sums[first + rows] += near_sums(x[rows], y, member, self.tolerance) * wanted[rows]

    def result(self) -> bytes:
        k = len(self.clusters)
        found = pa.table({"id": pa.concat_arrays([self.ids] * k), "cluster": np.repeat(self.clusters, len(self.x)), "dist": self.sums.T.ravel()})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, found.schema) as out:
            out.write_table(found, max_chunksize=10_000)
        return sink.getvalue().to_pybytes()


def ball_sums(new: DataFrame, index: BallIndex, tolerance: float = TOLERANCE) -> DataFrame:
    """(id, cluster, dist, n): summed Euclidean distances of each new row (id, vec) to each cluster's rows.

    Rows that meet few leaves are sent to them.  Those that meet many stay in tasks, in packs, while the leaves are read
    past them, as in `distance_sums`: so what is written grows with the rows, also where most pairs have to meet.
    """
    spark = configure(new.sparkSession)
    sent = spark.sparkContext.broadcast((index.tree.to_lists(), index.balls.arrays()))
    width, clusters = index.width, index.balls.clusters
    sizes = dict(zip(clusters, index.balls.count[:, 0].astype(int).tolist()))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, known = Tree.from_lists(sent.value[0]), sent.value[1]
        balls = Balls.from_lists(known, known["plane"])
        schema = pa.schema([("leaf", pa.int32()), *((c, pa.binary()) for c in ("ids", "asked", "wanted"))])
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            if not len(ids):
                continue
            sums, meet = _walked(tree, balls, x, tolerance, MOST_ASKED)
            if sums is None:
                yield pa.RecordBatch.from_pylist([{"leaf": STAYS, "ids": _bytes(ids, "<i8"), "asked": _bytes(x), "wanted": None}], schema=schema)
                continue
            yield pa.RecordBatch.from_pylist([{"leaf": FAR, "ids": _bytes(ids, "<i8"), "asked": None, "wanted": _bytes(sums)}], schema=schema)
            for leaf, wanted in meet.items():
                rows = np.flatnonzero(wanted.any(axis=1))
                yield pa.RecordBatch.from_pylist([{"leaf": leaf, "ids": _bytes(ids[rows], "<i8"), "asked": _bytes(x[rows]), "wanted": _bytes(wanted[rows], "u1")}], schema=schema)

    def long(ids: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        i, c = np.nonzero(sums)
        return pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(np.array(clusters, np.int64)[c], pa.int64()), pa.array(sums[i, c])], ["id", "cluster", "dist"])

    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield long(_read(row, "ids", "<i8"), _read(row, "wanted", width=len(clusters)))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, x, y = _read(row, "ids", "<i8"), _read(row, "asked", width=width), _read(row, "vectors", width=width)
                wanted, cluster, n = _read(row, "wanted", "u1", len(clusters)), _read(row, "clusters", "<i8"), _read(row, "counts", "<i8")
                member = (cluster[:, None] == np.array(clusters)) * n[:, None].astype(float)
                yield long(ids, near_sums(x, y, member, tolerance) * wanted)

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x = pa.array(_read(row, "asked"))
                vec = pa.ListArray.from_arrays(pa.array(np.arange(0, len(x) + 1, width), pa.int32()), x)
                yield pa.RecordBatch.from_arrays([pa.array(_read(row, "ids", "<i8")), vec], ["id", "vec"])

    def pass_by(pairs: Iterator[tuple]) -> Iterator[tuple[bytes]]:
        tree, known, staying = Tree.from_lists(sent.value[0]), sent.value[1], {}
        balls = Balls.from_lists(known, known["plane"])
        for (name, data), leaf in pairs:
            if name not in staying:
                staying[name] = _Asking(data, tree, balls, tolerance)
            if leaf["leaf"] in staying[name].near:
                staying[name].meet(leaf["leaf"], _read(leaf, "clusters", "<i8"), _read(leaf, "counts", "<i8"), _read(leaf, "vectors", width=width))
        for s in staying.values():
            yield (s.result(),)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                yield from pa.ipc.open_stream(data.as_py())

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Tree.from_lists(sent.value[0])
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.leaf_of(x), pa.int32())], ["id", "vec", "leaf"])

    # rows that lie near each other ask the same leaves: a batch of them then asks few
    rows = new.select(F.col("id").cast("long").alias("id"), F.col("vec").cast("array<double>").alias("vec"))
    placed = rows.mapInArrow(numbered, "id long, vec array<double>, leaf int").checkpoint()
    n, most = placed.count(), max(1, min(STAY_ROWS, WANTED_BITS // max(1, len(clusters) * int((index.tree.leaf >= 0).sum()))))
    parts = max(1, -(-n // most), min(4 * spark.sparkContext.defaultParallelism, -(-n // LEAST_ROWS)))
    asks = placed.repartitionByRange(parts, "leaf", "id").sortWithinPartitions("leaf").select("id", "vec").mapInArrow(ask, "leaf int, ids binary, asked binary, wanted binary").checkpoint()
    schema = "id long, cluster long, dist double"
    met = packs_joined(asks.filter("leaf >= 0"), index.leaves).select("ids", "asked", "wanted", "clusters", "counts", "vectors").mapInArrow(near, schema)
    found = asks.filter(F.col("leaf") == FAR).select("ids", "wanted").mapInArrow(far, schema).unionByName(met)
    stay = asks.filter(F.col("leaf") == STAYS).select("ids", "asked")
    if not stay.isEmpty():
        packs = _packs(stay.mapInArrow(plain, "id long, vec array<double>"), min(STAY_BYTES, most * (8 * width + 16)))
        # one partition of the leaves: they are read one after the other, never held together
        passed = packs.rdd.cartesian(index.leaves.rdd.coalesce(1)).mapPartitions(pass_by)
        found = found.unionByName(spark.createDataFrame(passed, "data binary").mapInArrow(rows_of, schema))
    sums = found.groupBy("id", "cluster").agg(F.sum("dist").alias("dist"))
    # every cluster has a sum for every row, also one of 0
    each = placed.select("id").distinct().select("id", F.explode(F.array(*[F.lit(c).cast("long") for c in clusters])).alias("cluster"))
    size = F.element_at(F.create_map(*[F.lit(v).cast("long") for c in clusters for v in (c, sizes[c])]), F.col("cluster"))
    return each.join(sums, ["id", "cluster"], "left").select("id", "cluster", F.coalesce("dist", F.lit(0.0)).alias("dist"), size.alias("n"))
