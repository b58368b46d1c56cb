"""Exact nearest-neighbour distances, and density components built on them.

Space is cut into leaves by a tree of splits along the widest side, at medians of a sample; every row then falls in a
leaf, and leaves with their true boxes are packed rows of bounded size.  Equal vectors are one point with a count, so a
vector that many rows share fills no leaf.  A query first meets its own leaf, which bounds how far its k-th neighbour
can be, and then only those leaves whose box lies within that distance.  What meets is a pack of queries and a leaf,
joined by the leaf's number; pairs of rows are never rows of a table.

Rows whose k-th neighbour is near are dense.  Dense rows within the same distance of each other are linked: inside a
leaf by walking the distances, across leaves by pairs of the leaves' own components, of which few remain to be connected.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorframe.operators.skew import exact_quantiles
from anchorframe.session import configure, ensure_checkpoint_dir

#: Points of a leaf, about; the sample for the splits has SAMPLE_PER_LEAF of each.  Beyond MOST_LEAVES leaves they grow.
LEAF_ROWS = 1_024
SAMPLE_PER_LEAF = 16
MOST_LEAVES = 1 << 15
#: Rows that meet a leaf at a time: their distances stay in a core's cache.
CHUNK_ROWS = 64

LEAVES = "leaf int, ids binary, counts binary, vectors binary"


def as_array(df: DataFrame, vec: str) -> Column:
    return F.col(vec) if df.schema[vec].dataType.typeName() == "array" else vector_to_array(F.col(vec))


# --------------------------------------------------------------------------
# the tree


@dataclass
class Tree:
    """Splits: points with x[dim] <= cut go to the first child.  Boxes and counts are those of all points."""

    dim: np.ndarray
    cut: np.ndarray
    children: np.ndarray  # (nodes, 2), -1 in leaves
    parent: np.ndarray
    leaf: np.ndarray  # number of the leaf, -1 inside
    low: np.ndarray
    high: np.ndarray
    count: np.ndarray

    @classmethod
    def of(cls, sample: np.ndarray, leaves: int) -> Tree:
        dim, cut, children, parent, leaf = [], [], [], [], []
        number = count()

        def add(rows: np.ndarray, wanted: float, above: int) -> int:
            at = len(dim)
            for column, value in ((dim, 0), (cut, 0.0), (children, [-1, -1]), (parent, above), (leaf, -1)):
                column.append(value)
            spread = rows.max(axis=0) - rows.min(axis=0) if len(rows) else np.zeros(sample.shape[1])
            d = int(spread.argmax())
            if wanted < 2 or len(rows) < 2 or spread[d] == 0:
                leaf[at] = next(number)
                return at
            value = np.sort(rows[:, d])[(len(rows) - 1) // 2]
            if value == rows[:, d].max():  # many equal ones: cut below them
                value = rows[:, d][rows[:, d] < value].max()
            first = rows[:, d] <= value
            dim[at], cut[at] = d, float(value)
            share = wanted / len(rows)
            children[at] = [add(rows[first], share * first.sum(), at), add(rows[~first], share * (~first).sum(), at)]
            return at

        add(sample, max(1, leaves), -1)
        n, d = len(dim), sample.shape[1]
        return cls(np.array(dim), np.array(cut), np.array(children).reshape(n, 2), np.array(parent), np.array(leaf), np.full((n, d), np.inf), np.full((n, d), -np.inf), np.zeros(n, np.int64))

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        while True:
            inner = np.flatnonzero(self.children[at, 0] >= 0)
            if not len(inner):
                return self.leaf[at]
            node = at[inner]
            at[inner] = self.children[node, (x[inner, self.dim[node]] > self.cut[node]).astype(np.int64)]

    def fill(self, boxes: list[tuple]) -> None:
        """Takes (leaf, low, high, count) of all leaves that hold points; children come after their parents."""
        node_of = {int(number): i for i, number in enumerate(self.leaf) if number >= 0}
        for leaf, low, high, held in boxes:
            i = node_of[leaf]
            self.low[i], self.high[i], self.count[i] = low, high, held
        for i in range(len(self.dim) - 1, 0, -1):
            p = self.parent[i]
            self.low[p], self.high[p] = np.minimum(self.low[p], self.low[i]), np.maximum(self.high[p], self.high[i])
            self.count[p] += self.count[i]

    def enough(self, x: np.ndarray, k: int) -> np.ndarray:
        """A distance within which each point has k others at least: the far corner of the least box around it that holds so many."""
        out, node, live = np.full(len(x), np.inf), np.zeros(len(x), np.int64), np.arange(len(x))
        while len(live):
            at = node[live]
            held = self.count[at] > k
            far = np.sqrt(np.square(np.maximum(np.abs(x[live] - self.low[at]), np.abs(x[live] - self.high[at]))).sum(axis=1))
            out[live] = np.where(held, np.minimum(out[live], far), out[live])
            live = live[held & (self.children[at, 0] >= 0)]
            node[live] = self.children[node[live], (x[live, self.dim[node[live]]] > self.cut[node[live]]).astype(np.int64)]
        return out

    def within(self, x: np.ndarray, reach: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, places): the points whose ball of that reach touches the leaf's box."""
        stack = [(0, np.arange(len(x)))]
        while stack:
            i, rows = stack.pop()
            if not self.count[i]:
                continue
            gap = np.maximum(0.0, np.maximum(self.low[i] - x[rows], x[rows] - self.high[i]))
            rows = rows[np.square(gap).sum(axis=1) <= np.square(reach[rows]) * (1 + 1e-12)]
            if len(rows):
                if self.children[i, 0] < 0:
                    yield int(self.leaf[i]), rows
                else:
                    stack += [(int(c), rows) for c in self.children[i]]

    def to_lists(self) -> dict:
        return {c: getattr(self, c).tolist() for c in self.__dataclass_fields__}

    @classmethod
    def from_lists(cls, lists: dict) -> Tree:
        return cls(*(np.array(lists[c]) for c in cls.__dataclass_fields__))


def _bytes(x: np.ndarray, kind: str = "<f8") -> bytes:
    return np.ascontiguousarray(x.astype(kind)).tobytes()


def _read(row: dict, name: str, kind: str = "<f8", width: int = 0) -> np.ndarray:
    x = np.frombuffer(row[name], kind)
    return x.reshape(-1, width) if width else x


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean, from differences: equal vectors are at 0, and nothing cancels."""
    out = np.zeros((len(x), len(y)))
    for j in range(x.shape[1]):
        out += np.square(x[:, j, None] - y[None, :, j])
    return np.sqrt(out)


def kth_smallest(d: np.ndarray, counts: np.ndarray, k: int, own: np.ndarray | None = None) -> np.ndarray:
    """(queries, k): the k smallest distances of each query, a point as often as it counts; inf where there are fewer.

    own: the place of the query's own point, which counts once less.
    """
    out = np.full((len(d), k), np.inf)
    take = min(k + (own is not None), d.shape[1])
    if not take:
        return out
    near = np.argpartition(d, take - 1, axis=1)[:, :take] if take < d.shape[1] else np.tile(np.arange(d.shape[1]), (len(d), 1))
    near = np.take_along_axis(near, np.take_along_axis(d, near, 1).argsort(axis=1, kind="stable"), 1)
    value, weight = np.take_along_axis(d, near, 1), counts[near]
    if own is not None:
        weight = weight - (near == own[:, None])
    upto = np.cumsum(weight, axis=1)
    for j in range(k):
        there = upto > j
        first = there.argmax(axis=1)
        out[:, j] = np.where(there[:, -1], value[np.arange(len(d)), first], np.inf)
    return out


def packs_joined(asked: DataFrame, leaves: DataFrame) -> DataFrame:
    """Packs of asked rows with the leaf they ask.

    Spark guesses a packed row by its columns at a few hundred bytes, and would send whole tables of them through the
    driver to every executor; they meet by a shuffle instead.
    """
    return asked.hint("merge").join(leaves.hint("merge"), "leaf")


# --------------------------------------------------------------------------
# the index


@dataclass
class SpaceIndex:
    points: DataFrame  # id long, v array<double>, n long: distinct vectors
    leaves: DataFrame  # LEAVES
    tree: Tree
    width: int


def space_index(rows: DataFrame, vec: str, leaf_rows: int = LEAF_ROWS) -> SpaceIndex:
    """An index over the rows' vectors; rows with a null vector take no part."""
    spark = configure(rows.sparkSession)
    ensure_checkpoint_dir(spark)
    vectors = rows.select(F.transform(as_array(rows, vec), lambda x: x.cast("double") + F.lit(0.0)).alias("v")).filter("v is not null")
    points = vectors.groupBy("v").agg(F.count("*").alias("n")).select(F.monotonically_increasing_id().alias("id"), "v", "n").checkpoint()
    n, width = points.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    leaves = int(min(MOST_LEAVES, max(1, round(n / leaf_rows))))
    share = int(min(1.0, 2 * leaves * SAMPLE_PER_LEAF / max(n, 1)) * 1_000_000)
    some = points.filter(F.pmod(F.xxhash64(F.lit("sample"), "v"), F.lit(1_000_000)) < share).orderBy(F.xxhash64("v"), "v").limit(leaves * SAMPLE_PER_LEAF)
    sample = some.select("v").toArrow()["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    tree = Tree.of(sample, leaves)
    sent = spark.sparkContext.broadcast(tree.to_lists())

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Tree.from_lists(sent.value)
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.leaf_of(x), pa.int32())], ["id", "v", "n", "leaf"])

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        x = group["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        row = {"leaf": group["leaf"][0].as_py(), "ids": _bytes(group["id"].to_numpy(), "<i8"), "counts": _bytes(group["n"].to_numpy(), "<i8"), "vectors": _bytes(x)}
        x = x.reshape(-1, width)
        row |= {"low": x.min(axis=0).tolist(), "high": x.max(axis=0).tolist(), "count": int(group["n"].to_numpy().sum())}
        kinds = {"leaf": pa.int32(), "low": pa.list_(pa.float64()), "high": pa.list_(pa.float64()), "count": pa.int64()}
        return pa.Table.from_pylist([row], schema=pa.schema([(c, kinds.get(c, pa.binary())) for c in row]))

    held = points.mapInArrow(numbered, "id long, v array<double>, n long, leaf int").groupBy("leaf").applyInArrow(pack, LEAVES + ", low array<double>, high array<double>, count long").checkpoint()
    # a box a leaf, of which MOST_LEAVES bounds the number
    tree.fill([tuple(r) for r in held.select("leaf", "low", "high", "count").collect()])
    return SpaceIndex(points, held.select("leaf", "ids", "counts", "vectors"), tree, width)


# --------------------------------------------------------------------------
# k-th neighbours


def core_distances(index: SpaceIndex, k: int) -> DataFrame:
    """LEAVES and core: for each point the distance to its k-th nearest other row (inf where there are fewer rows)."""
    spark, width = index.leaves.sparkSession, index.width
    sent = spark.sparkContext.broadcast(index.tree.to_lists())

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree.from_lists(sent.value)
        for batch in batches:
            for row in batch.to_pylist():
                x, counts = _read(row, "vectors", width=width), _read(row, "counts", "<i8")
                found = np.concatenate([kth_smallest(distances(x[i : i + CHUNK_ROWS], x), counts, k, np.arange(i, min(i + CHUNK_ROWS, len(x)))) for i in range(0, len(x), CHUNK_ROWS)])
                reach = np.minimum(found[:, -1], tree.enough(x, k) * (1 + 1e-9))
                row |= {"found": _bytes(found), "reach": _bytes(reach)}
                yield pa.RecordBatch.from_pylist([row], schema=pa.schema([("leaf", pa.int32()), *((c, pa.binary()) for c in ("ids", "counts", "vectors", "found", "reach"))]))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree.from_lists(sent.value)
        for batch in batches:
            for row in batch.to_pylist():
                x, reach = _read(row, "vectors", width=width), _read(row, "reach")
                for leaf, places in tree.within(x, reach):
                    if leaf != row["leaf"]:
                        out = {"home": row["leaf"], "leaf": leaf, "places": _bytes(places, "<i4"), "asked": _bytes(x[places]), "reach": _bytes(reach[places])}
                        yield pa.RecordBatch.from_pylist([out], schema=pa.schema([("home", pa.int32()), ("leaf", pa.int32()), *((c, pa.binary()) for c in ("places", "asked", "reach"))]))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x, y, reach, counts = _read(row, "asked", width=width), _read(row, "vectors", width=width), _read(row, "reach"), _read(row, "counts", "<i8")
                found = np.concatenate([kth_smallest(distances(x[i : i + CHUNK_ROWS], y), counts, k) for i in range(0, len(x), CHUNK_ROWS)])
                q, j = np.nonzero((found <= reach[:, None]) & np.isfinite(found))
                if len(q):
                    out = {"leaf": row["home"], "places": _bytes(_read(row, "places", "<i4")[q], "<i4"), "far": _bytes(found[q, j])}
                    yield pa.RecordBatch.from_pylist([out], schema=pa.schema([("leaf", pa.int32()), ("places", pa.binary()), ("far", pa.binary())]))

    def merge(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        own = next(r for r in rows if r["found"] is not None)
        found = _read(own, "found", width=k)
        far = [r for r in rows if r["found"] is None]
        if far:
            place, value = np.concatenate([_read(r, "places", "<i4") for r in far]), np.concatenate([_read(r, "far") for r in far])
            order = np.lexsort((value, place))
            place, value = place[order], value[order]
            rank = np.arange(len(place)) - np.searchsorted(place, place)
            kept = rank < k
            more = np.full_like(found, np.inf)
            more[place[kept], rank[kept]] = value[kept]
            found = np.sort(np.concatenate([found, more], axis=1), axis=1)
        out = {c: own[c] for c in ("leaf", "ids", "counts", "vectors")} | {"core": _bytes(found[:, k - 1])}
        return pa.Table.from_pylist([out], schema=pa.schema([("leaf", pa.int32()), *((c, pa.binary()) for c in ("ids", "counts", "vectors", "core"))]))

    first = index.leaves.mapInArrow(near, LEAVES + ", found binary, reach binary").checkpoint()
    asked = first.select("leaf", "vectors", "reach").mapInArrow(ask, "home int, leaf int, places binary, asked binary, reach binary")
    far = packs_joined(asked, index.leaves.select("leaf", "counts", "vectors")).select("home", "places", "asked", "reach", "counts", "vectors").mapInArrow(meet, "leaf int, places binary, far binary")
    both = first.drop("reach").unionByName(far, allowMissingColumns=True)
    return both.groupBy("leaf").applyInArrow(merge, LEAVES + ", core binary").checkpoint()


def point_values(leaves: DataFrame, names: list[tuple[str, str]]) -> DataFrame:
    """(id, names...): packed numbers as rows.  names: (column, "<f8" or "<i8")."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                columns = [pa.array(_read(row, c, kind)) for c, kind in [("ids", "<i8"), *names]]
                yield pa.RecordBatch.from_arrays(columns, ["id", *[c for c, _ in names]])

    schema = ", ".join(["id long", *[f"{c} {'double' if kind == '<f8' else 'long'}" for c, kind in names]])
    return leaves.select("ids", *[c for c, _ in names]).mapInArrow(run, schema)


# --------------------------------------------------------------------------
# components


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of the edges (a, b) can reach.

    Each round a node takes the smallest root among its neighbours and then that root's own; every round is written.
    """
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().checkpoint()
    roots = both.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node")).checkpoint()
    while True:
        offers = both.join(roots.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("root").alias("offer"))
        lower = roots.join(offers, roots["node"] == offers["a"], "left").select("node", "root", F.least("root", "offer").alias("low"))
        hop = roots.select(F.col("node").alias("low"), F.col("root").alias("next"))
        after = lower.join(hop, "low", "left").select("node", "root", F.least("low", F.coalesce("next", "low")).alias("new")).checkpoint()
        changed = not after.filter("new < root").isEmpty()
        roots = after.select("node", F.col("new").alias("root"))
        if not changed:
            return roots


def _walked(x: np.ndarray, eps: float) -> np.ndarray:
    """Component numbers of points linked within eps, each the place of its first point; distances are made as they are walked."""
    label = np.full(len(x), -1)
    for i in range(len(x)):
        if label[i] < 0:
            label[i] = i
            front = np.array([i])
            while len(front):
                reached = np.zeros(len(x), bool)
                for at in range(0, len(front), CHUNK_ROWS):
                    reached |= (distances(x[front[at : at + CHUNK_ROWS]], x) <= eps).any(axis=0)
                front = np.flatnonzero(reached & (label < 0))
                label[front] = i
    return label


def dense_labels(measured: DataFrame, tree: Tree, width: int, eps: float) -> DataFrame:
    """LEAVES, core and labels: the smallest point id of each dense point's component, -1 for points that are not dense."""
    spark = measured.sparkSession
    sent = spark.sparkContext.broadcast(tree.to_lists())
    columns = ("ids", "counts", "vectors", "core", "labels")

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, x, dense = _read(row, "ids", "<i8"), _read(row, "vectors", width=width), np.flatnonzero(_read(row, "core") <= eps)
                labels = np.full(len(ids), -1, np.int64)
                labels[dense] = ids[dense[_walked(x[dense], eps)]]  # ids ascend
                yield pa.RecordBatch.from_pylist([row | {"labels": _bytes(labels, "<i8")}], schema=pa.schema([("leaf", pa.int32()), *((c, pa.binary()) for c in columns)]))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Tree.from_lists(sent.value)
        for batch in batches:
            for row in batch.to_pylist():
                labels = _read(row, "labels", "<i8")
                dense = np.flatnonzero(labels >= 0)
                x = _read(row, "vectors", width=width)[dense]
                for leaf, places in own.within(x, np.full(len(x), eps)):
                    if leaf > row["leaf"]:  # each pair of leaves once
                        out = {"leaf": leaf, "asked": _bytes(x[places]), "own": _bytes(labels[dense[places]], "<i8")}
                        yield pa.RecordBatch.from_pylist([out], schema=pa.schema([("leaf", pa.int32()), ("asked", pa.binary()), ("own", pa.binary())]))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                labels, asked, own = _read(row, "labels", "<i8"), _read(row, "asked", width=width), _read(row, "own", "<i8")
                dense = np.flatnonzero(labels >= 0)
                y, pairs = _read(row, "vectors", width=width)[dense], []
                for i in range(0, len(asked), CHUNK_ROWS):
                    q, j = np.nonzero(distances(asked[i : i + CHUNK_ROWS], y) <= eps)
                    pairs.append(np.unique(np.stack([own[i + q], labels[dense[j]]], axis=1), axis=0))
                pairs = np.unique(np.concatenate(pairs), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    held = measured.mapInArrow(local, LEAVES + ", core binary, labels binary").checkpoint()
    asked = held.select("leaf", "vectors", "labels").mapInArrow(ask, "leaf int, asked binary, own binary")
    links = packs_joined(asked, held.select("leaf", "vectors", "labels")).select("asked", "own", "vectors", "labels").mapInArrow(meet, "a long, b long").distinct().checkpoint()
    roots = connected(links)

    # the labels that were linked meet their leaves again, so that packed labels are final
    own = point_values(held, [("labels", "<i8")]).filter("labels >= 0").withColumnRenamed("labels", "node")
    changed = own.join(roots.filter("node <> root"), "node").select("id", "root")
    return _relabelled(held, changed, columns)


def _relabelled(held: DataFrame, changed: DataFrame, columns: tuple) -> DataFrame:
    leaf_of = held.select("leaf", "ids")

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                i = _read(row, "ids", "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(np.full(len(i), row["leaf"], np.int32))], ["id", "leaf"])

    placed = changed.join(leaf_of.mapInArrow(ids, "id long, leaf int"), "id")
    both = held.unionByName(placed, allowMissingColumns=True)

    def put(group: pa.Table) -> pa.Table:
        leaf = group.filter(pa.compute.is_valid(group["ids"])).to_pylist()[0]
        new = group.filter(pa.compute.is_valid(group["id"]))
        labels = _read(leaf, "labels", "<i8").copy()
        labels[np.searchsorted(_read(leaf, "ids", "<i8"), new["id"].to_numpy())] = new["root"].to_numpy()
        out = {c: leaf[c] for c in ("leaf", *columns)} | {"labels": _bytes(labels, "<i8")}
        return pa.Table.from_pylist([out], schema=pa.schema([("leaf", pa.int32()), *((c, pa.binary()) for c in columns)]))

    return both.groupBy("leaf").applyInArrow(put, LEAVES + ", core binary, labels binary").checkpoint()


# --------------------------------------------------------------------------
# density


@dataclass
class Density:
    """Points with core distances and components, and what scoring needs of them."""

    leaves: DataFrame  # LEAVES, core, labels
    tree: Tree
    width: int
    neighbours: int
    eps: float
    components: DataFrame  # label long, component (smallest key), size long, scale double

    def settings(self) -> str:
        return json.dumps({"tree": self.tree.to_lists(), "width": self.width, "neighbours": self.neighbours, "eps": self.eps})

    def save(self, path: str) -> None:
        self.leaves.write.mode("overwrite").parquet(f"{path}/leaves")
        self.components.write.mode("overwrite").parquet(f"{path}/components")
        self.leaves.sparkSession.createDataFrame([(self.settings(),)], "settings string").write.mode("overwrite").parquet(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Density:
        s = json.loads(spark.read.parquet(f"{path}/settings").first()["settings"])
        return cls(spark.read.parquet(f"{path}/leaves"), Tree.from_lists(s["tree"]), s["width"], s["neighbours"], s["eps"], spark.read.parquet(f"{path}/components"))


def measure_density(df: DataFrame, vec: str, key: str, neighbours: int = 15, dense_share: float = 0.75, min_rows: int = 50, leaf_rows: int = LEAF_ROWS) -> tuple[Density, DataFrame]:
    """The density of df's rows, and df with density_distance, density_component and density_strength.

    A row's distance is that to its `neighbours`-th nearest other row.  The nearest dense_share of all rows are dense;
    dense rows within the largest of their distances of each other form components, named by their smallest key.  A
    row's strength is its component's median distance over its own, 1 at most.  Rows that are not dense, and those of
    components with fewer than min_rows rows, have no component and strength 0.  A null vector has no density.
    """
    index = space_index(df, vec, leaf_rows)
    measured = core_distances(index, neighbours)
    core = point_values(measured, [("core", "<f8"), ("counts", "<i8")]).filter(F.col("core") < float("inf"))
    eps = _weighted_quantile(core, "core", "counts", dense_share)
    leaves = dense_labels(measured, index.tree, index.width, eps)
    points = index.points.join(point_values(leaves, [("core", "<f8"), ("labels", "<i8")]), "id").select(F.col("v").alias("__v"), F.col("core").alias("density_distance"), F.col("labels").alias("__label"))
    v = F.transform(as_array(df, vec), lambda x: x.cast("double") + F.lit(0.0))
    rows = df.withColumn("__v", v).join(points, "__v", "left").drop("__v").checkpoint()
    inside = rows.filter("__label >= 0")
    sized = inside.groupBy(F.col("__label").alias("label")).agg(F.min(key).alias("component"), F.count("*").alias("size")).filter(F.col("size") >= min_rows)
    scale = exact_quantiles(inside.select(F.col("__label").alias("label"), "density_distance"), ["label"], "density_distance", [0.5], ["scale"])
    components = sized.join(scale, "label").checkpoint()
    named = components.select(F.col("label").alias("__label"), F.col("component").alias("density_component"), F.col("scale").alias("__scale"))
    out = rows.join(named, "__label", "left").withColumn("density_strength", _strength()).drop("__label", "__scale")
    finite = F.when(F.col("density_distance") < float("inf"), F.col("density_distance"))
    return Density(leaves, index.tree, index.width, neighbours, eps, components), out.withColumn("density_distance", finite)


def _strength() -> Column:
    near = F.when(F.col("density_distance") <= F.col("__scale"), F.lit(1.0)).otherwise(F.col("__scale") / F.col("density_distance"))
    return F.coalesce(F.when(F.col("density_component").isNotNull(), near), F.lit(0.0))


def _weighted_quantile(df: DataFrame, value: str, weight: str, share: float) -> float:
    """The smallest value at which `share` of the weight is reached; -1 without rows.  Exact: sketched cuts only narrow where to look."""
    total, high = df.agg(F.sum(weight), F.max(value)).first()
    if not total:
        return -1.0
    low = -1.0
    while True:
        inside = df.filter((F.col(value) > low) & (F.col(value) <= high))
        least, cuts = inside.agg(F.min(value), F.percentile_approx(value, [i / 64 for i in range(1, 64)], 10_000)).first()
        if least == high:
            return float(high)
        cuts = sorted({low, least, *cuts, high})
        sums = df.agg(*[F.coalesce(F.sum(F.when(F.col(value) <= c, F.col(weight))), F.lit(0)).alias(f"s{i}") for i, c in enumerate(cuts)]).first()
        at = next((i for i, s in enumerate(sums) if s >= share * total), len(cuts) - 1)
        low, high = cuts[at - 1], cuts[at]


def density_core(df: DataFrame, min_strength: float) -> DataFrame:
    return df.filter(F.col("density_component").isNotNull() & (F.col("density_strength") >= min_strength))


def score_density(df: DataFrame, vec: str, key: str, density: Density) -> DataFrame:
    """df with density_component and density_strength of new rows against the stored ones.

    A new row belongs to the component of the nearest dense row within eps, if its neighbours-th nearest stored row is
    as near; its strength is as in `measure_density`.  Rows with the same key are asked for once and get the same answer.
    """
    spark = configure(df.sparkSession)
    sent = spark.sparkContext.broadcast(density.tree.to_lists())
    width, eps, k = density.width, density.eps, density.neighbours
    asked = df.select(F.col(key).cast("string").alias("key"), as_array(df, vec).cast("array<double>").alias("v")).filter("v is not null").dropDuplicates(["key"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree.from_lists(sent.value)
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            for leaf, places in tree.within(x, np.full(len(x), max(eps, 0.0))):
                keys = batch.column(0).take(pa.array(places))
                yield pa.RecordBatch.from_arrays([pa.array([leaf], pa.int32()), pa.array([keys.to_pylist()], pa.list_(pa.string())), pa.array([_bytes(x[places])], pa.binary())], ["leaf", "keys", "asked"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x, y, counts, labels = _read(row, "asked", width=width), _read(row, "vectors", width=width), _read(row, "counts", "<i8"), _read(row, "labels", "<i8")
                dense = np.flatnonzero(labels >= 0)
                for i in range(0, len(x), CHUNK_ROWS):
                    d = distances(x[i : i + CHUNK_ROWS], y)
                    found = kth_smallest(d, counts, k)
                    near = [f[f <= eps].tolist() for f in found]
                    to = np.where(d[:, dense] <= eps, d[:, dense], np.inf) if len(dense) else np.full((len(d), 1), np.inf)
                    best = to.argmin(axis=1)
                    away = to[np.arange(len(d)), best]
                    label = [int(labels[dense[b]]) if np.isfinite(a) else None for a, b in zip(away, best)]
                    yield pa.RecordBatch.from_arrays([pa.array(row["keys"][i : i + CHUNK_ROWS]), pa.array(near, pa.list_(pa.float64())), pa.array([a if np.isfinite(a) else None for a in away], pa.float64()), pa.array(label, pa.int64())], ["key", "near", "away", "label"])

    met = packs_joined(asked.mapInArrow(ask, "leaf int, keys array<string>, asked binary"), density.leaves.select("leaf", "counts", "vectors", "labels")).select("keys", "asked", "counts", "vectors", "labels")
    found = met.mapInArrow(meet, "key string, near array<double>, away double, label long").groupBy("key").agg(
        F.array_sort(F.flatten(F.collect_list("near"))).alias("near"),  # k for each leaf within eps
        F.min(F.when(F.col("label").isNotNull(), F.struct("away", "label"))).alias("nearest"))
    distance = F.when(F.size("near") >= k, F.get("near", F.lit(k - 1)))
    named = found.select("key", distance.alias("density_distance"), F.col("nearest.label").alias("label")).join(density.components, "label", "left")
    named = named.select(F.col("key").alias("__key"), F.when(F.col("density_distance").isNotNull(), F.col("component")).alias("density_component"), "density_distance", F.col("scale").alias("__scale"))
    out = df.join(named, F.col(key).cast("string") == F.col("__key"), "left")
    return out.withColumn("density_strength", _strength()).drop("__key", "density_distance", "__scale")
