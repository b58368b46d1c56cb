"""Histogram boosting of several models that grow together.

Columns are binned once to bytes (255 bins between sketched quantiles, one for missing values), and rows are packed in
blocks of bounded size.  The models of all folds and the model of all rows advance side by side: one Spark job per tree
level sums the gradients of every model, node, column and bin over the blocks; the sums, whose size does not
depend on the rows, give the splits (of more than 16 blocks they meet in a task, and only splits reach the driver), and
the next level follows.  Up to APART_ROWS rows each model grows in one task by the same functions: a task that has all
blocks has the whole sums already, so nothing needs to meet between levels.
Gradients are rounded to whole multiples of 2**-20 before they are summed, so sums are exact, and the trees are the same
however the rows are partitioned.

A block's scores under the trees so far are remembered by the Python worker that made them.  Another worker, or one that
replaces a lost executor, makes them again from the trees, which travel with the job; nothing else is kept between jobs.

Trees are complete: 2**depth - 1 inner nodes and 2**depth leaves; a node without a useful split sends all rows to the left.
A missing value goes where the gain is higher.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anchorframe.session import configure, ensure_checkpoint_dir

BINS = 256
MISSING = BINS - 1
#: Rows of a block, some 50 bytes each.
BLOCK_ROWS = 1 << 18
#: Up to so many rows a model grows in one task, which holds some 60 bytes a row (482 MB of a Python worker at 5.4 million).
APART_ROWS = 6 << 20
#: Rows of a block at least, where there are cores for more of those that such models share.
LEAST_ROWS = 1 << 14
#: Rows that go through a step together, so that they stay in a processor's cache.
CHUNK_ROWS = 1 << 16
UNIT = 2.0**20
#: Trees of so many rounds travel with a job; those before are broadcast once.
SHIPPED_ROUNDS = 50
#: Blocks whose scores a Python worker remembers.
REMEMBERED = 8
LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class Boosting:
    """Boosted-tree settings."""

    rounds: int = 500
    depth: int = 4
    rate: float = 0.05
    row_share: float = 0.8
    column_share: float = 0.8
    seed: int = 42
    l2: float = 1.0
    min_child: float = 1.0


@dataclass
class Trees:
    """Trees of several models: arrays of (rounds, models, nodes)."""

    column: np.ndarray  # int16, -1: no split
    cut: np.ndarray  # uint8; bins up to the cut go to the left
    missing_left: np.ndarray  # bool
    leaf: np.ndarray  # float64
    gain: np.ndarray  # float64, of each split

    def parts(self) -> tuple:
        return self.column, self.cut, self.missing_left, self.leaf


# --------------------------------------------------------------------------
# rows as bytes


def bin_cuts(df: DataFrame, features: Sequence[str]) -> list[list[float]]:
    """For each column ascending cut points, the last value of each bin but the last; at most 254."""
    shares = [i / (BINS - 1) for i in range(1, BINS - 1)]
    # numbers a column, not rows
    row = df.agg(*[F.percentile_approx(_number(f), shares, 10_000).alias(f"c{i}") for i, f in enumerate(features)]).first()
    return [sorted(set(c or [])) for c in row]


def _number(name: str) -> Column:
    value = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(value), value)


def binned(values: np.ndarray, cuts: Sequence[float]) -> np.ndarray:
    """Bins of doubles (NaN: missing) as bytes."""
    missing = np.isnan(values)
    found = np.searchsorted(np.asarray(cuts, np.float64), np.where(missing, 0.0, values), side="left")
    return np.where(missing, MISSING, found).astype(np.uint8)


def blocks(df: DataFrame, features: Sequence[str], target: str, key: str, cuts: list[list[float]], block_rows: int | None = None) -> tuple[DataFrame, bool]:
    """(block, data): Arrow blocks of (key, h, y, fold, one byte column a feature); df has a column fold.

    Also whether each model grows apart: up to APART_ROWS rows, or, where a size is named, up to that.
    """
    rows = df.select(F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{key}`")).alias("h"), F.col(f"`{target}`").cast("double").alias("y"),
                     F.col("fold").cast("byte").alias("fold"), *[_number(f).alias(f"x{i}") for i, f in enumerate(features)])
    rows = rows.filter(F.col("y").isNotNull()).checkpoint()
    n, size = rows.count(), block_rows or BLOCK_ROWS
    apart = n <= (block_rows or APART_ROWS)
    parts = max(1, -(-n // size))
    if apart:
        parts = max(parts, min(df.sparkSession.sparkContext.defaultParallelism, n // LEAST_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, seq = [], 0, 0
        for batch in batches:
            columns = [*batch.columns[:4], *(pa.array(binned(c.to_numpy(zero_copy_only=False), cut)) for c, cut in zip(batch.columns[4:], cuts))]
            held.append(pa.RecordBatch.from_arrays(columns, batch.schema.names))
            count += batch.num_rows
            if count >= size:
                yield packed(held, seq)
                held, count, seq = [], 0, seq + 1
        if held:
            yield packed(held, seq)

    def packed(held: list[pa.RecordBatch], seq: int) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        table = pa.Table.from_batches(held).combine_chunks()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        name = f"{TaskContext.get().partitionId()}-{seq}"
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "data"])

    return rows.repartition(parts).mapInArrow(run, "block string, data binary").checkpoint(), apart


def read_block(data: bytes) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(table, hashes, labels, folds, bins by column)."""
    table = pa.ipc.open_stream(data).read_all()
    plain = [table[i].to_numpy() for i in range(1, table.num_columns)]
    return table, plain[0].astype(np.uint64), plain[1], plain[2], np.stack(plain[3:])


# --------------------------------------------------------------------------
# trees on bins


def go_right(bins: np.ndarray, column: int, cut: int, missing_left: bool) -> np.ndarray:
    if column < 0:
        return np.zeros(bins.shape[1], bool)
    right = bins[column] > cut
    return right & (bins[column] != MISSING) if missing_left else right


def places(bins: np.ndarray, column: np.ndarray, cut: np.ndarray, missing_left: np.ndarray, levels: int, turns: list[np.ndarray] | None = None) -> np.ndarray:
    """The node of level `levels` that each row falls in.  Rows of bytes are compared and combined, none is looked up.

    turns: those of the levels above that are known; the others are added to it.
    """
    turns = [] if turns is None else turns
    for level in range(len(turns), levels):
        first = 2**level - 1
        choice = [go_right(bins, int(column[first + i]), int(cut[first + i]), bool(missing_left[first + i])) for i in range(2**level)]
        for turn in turns[:level]:  # half as many remain with each turn taken before
            half = len(choice) // 2
            choice = [choice[i] ^ (turn & (choice[i] ^ choice[half + i])) for i in range(half)]
        turns.append(choice[0])
    at = np.zeros(bins.shape[1], np.uint8 if levels <= 8 else np.uint32)
    for turn in turns[:levels]:
        at = at * 2 + turn
    return at


def advance(scores: np.ndarray, bins: np.ndarray, trees: tuple, depth: int) -> None:
    """Adds the trees' leaves to scores (models, rows)."""
    column, cut, missing_left, leaf = trees
    for r in range(len(column)):
        for m in range(len(scores)):
            scores[m] += leaf[r, m][places(bins, column[r, m], cut[r, m], missing_left[r, m], depth)]


def drawn(hashes: np.ndarray, seed: int, r: int, m: int, share: float) -> np.ndarray:
    """Whether a row takes part in model m's tree of round r: a hash of the row's own hash and the round."""
    if share >= 1:
        return np.ones(len(hashes), bool)
    out = np.empty(len(hashes), bool)
    with np.errstate(over="ignore"):
        for i in range(0, len(hashes), CHUNK_ROWS):
            x = hashes[i : i + CHUNK_ROWS] + np.uint64((seed * 1_000_003 + r * 131 + m + 1) * 0x9E3779B97F4A7C15 % 2**64)
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
            out[i : i + CHUNK_ROWS] = (x >> np.uint64(32)).astype(np.float64) < share * 2.0**32
    return out


def gradients(scores: np.ndarray, y: np.ndarray, binary: bool) -> tuple[np.ndarray, np.ndarray]:
    if binary:
        p = 1 / (1 + np.exp(-scores))
        return p - y, p * (1 - p)
    return scores - y, np.ones_like(scores)


@dataclass
class Splits:
    column: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    gain: np.ndarray
    left: np.ndarray  # (models, nodes, 2): gradient and weight sums of the left side
    right: np.ndarray


def best_splits(sums: np.ndarray, allowed: np.ndarray, l2: float, min_child: float) -> Splits:
    """The best split of each model and node.  sums: (models, nodes, columns, bins, 2); allowed: (models, columns).

    Ties go to the first column, then to missing values on the right, then to the smallest cut.
    """
    models, nodes, columns = sums.shape[:3]
    total = sums[:, :, 0].sum(axis=2)  # every column has all rows
    weight = lambda s: np.square(s[..., 0]) / (s[..., 1] + l2)
    below = np.cumsum(sums[:, :, :, : MISSING - 1], axis=3)
    sides = np.stack([below, below + sums[:, :, :, MISSING:, :]], axis=3)  # missing right, missing left
    rest = total[:, :, None, None, None] - sides
    gain = weight(sides) + weight(rest) - weight(total)[:, :, None, None, None]
    good = (sides[..., 1] >= min_child) & (rest[..., 1] >= min_child) & allowed[:, None, :, None, None] & (gain > LEAST_GAIN)
    flat = np.where(good, gain, -np.inf).reshape(models, nodes, -1)
    at = flat.argmax(axis=2)
    found = np.take_along_axis(flat, at[..., None], 2)[..., 0]
    split = np.isfinite(found)
    column, side, cut = np.unravel_index(at, (columns, 2, MISSING - 1))
    m, n = np.indices(at.shape)
    left = np.where(split[..., None], sides[m, n, column, side, cut], total)
    return Splits(np.where(split, column, -1).astype(np.int16), np.where(split, cut, 0).astype(np.uint8), split & (side == 1),
                  np.where(split, found, 0.0), left, total - left)


# --------------------------------------------------------------------------
# growing


def no_trees(rounds: int, models: int, depth: int) -> Trees:
    inner, leaves = 2**depth - 1, 2**depth
    return Trees(np.full((rounds, models, inner), -1, np.int16), np.zeros((rounds, models, inner), np.uint8), np.zeros((rounds, models, inner), bool),
                 np.zeros((rounds, models, leaves)), np.zeros((rounds, models, inner)))


def allowed_columns(s: Boosting, r: int, models: Sequence[int], width: int) -> np.ndarray:
    """(models, columns): which columns a model's tree of round r may use."""
    out = np.zeros((len(models), width), bool)
    for i, m in enumerate(models):
        out[i, np.random.default_rng([s.seed, r, m]).choice(width, max(1, int(width * s.column_share)), replace=False)] = True
    return out


def new_states(packed: bytes, start: np.ndarray, middle: float, scale: float) -> list[dict]:
    """The rows of a block, CHUNK_ROWS at a time, with the models' scores before the first round."""
    _, hashes, labels, fold, bins = read_block(packed)
    out = []
    for i in range(0, len(labels), CHUNK_ROWS):
        part = slice(i, i + CHUNK_ROWS)
        y = (labels[part] - middle) / scale
        out.append({"bins": bins[:, part].copy(), "y": y, "fold": fold[part].copy(), "hash": hashes[part].copy(), "scores": np.repeat(start[:, None], len(y), axis=1), "drawn": -1})
    return out


def block_sums(states: Sequence[dict], s: Boosting, r: int, models: Sequence[int], width: int, level: int, growing: tuple, allowed: np.ndarray, binary: bool) -> np.ndarray:
    """(models, nodes, columns, bins, 2): sums of the rows' gradients and weights in whole units, for the level that comes next."""
    nodes = 2**level
    out = np.zeros((len(models), width, 2, nodes * BINS))
    for state in states:
        bins = state["bins"]
        if state["drawn"] != r:
            state["in"] = [np.flatnonzero((state["fold"] != m) & drawn(state["hash"], s.seed, r, m, s.row_share)) for m in models]
            each = [gradients(state["scores"][i][rows], state["y"][rows], binary) for i, rows in enumerate(state["in"])]
            state["g"] = [np.rint(g * UNIT) for g, _ in each]
            state["h"] = [np.rint(h * UNIT) if binary else None for _, h in each]  # else all are one
            state["seen"] = [[bins[c][rows] if allowed[i, c] else None for c in range(width)] for i, rows in enumerate(state["in"])]
            state["turns"], state["drawn"] = [[] for _ in models], r
        for i, rows in enumerate(state["in"]):
            node = places(bins, *(p[i] for p in growing), level, state["turns"][i])[rows].astype(np.int64) * BINS
            for c in np.flatnonzero(allowed[i]):
                cell = node + state["seen"][i][c]
                out[i, c, 0] += np.bincount(cell, state["g"][i], nodes * BINS)
                out[i, c, 1] += np.bincount(cell, state["h"][i], nodes * BINS) if binary else np.bincount(cell, minlength=nodes * BINS) * UNIT
    return out.reshape(len(models), width, 2, nodes, BINS).transpose(0, 3, 1, 4, 2)


def level_splits(units: np.ndarray, allowed: np.ndarray, s: Boosting) -> Splits:
    """The models' best splits of a level, from the sums in whole units over all rows."""
    sums = units / UNIT
    # of a column that a model may not use nothing was summed; any allowed one has all rows
    first = allowed.argmax(axis=1)
    sums[:, :, 0] = np.where(allowed[:, None, :1, None], sums[:, :, 0], _as_one_bin(sums[np.arange(len(sums)), :, first]))
    return best_splits(sums, allowed, s.l2, s.min_child)


def grow_round(trees: Trees, r: int, s: Boosting, models: Sequence[int], width: int, splits_of: Callable[[int, np.ndarray], Splits]) -> None:
    """The models' trees of round r.  splits_of(level, allowed): the level's splits, from the sums over all rows."""
    allowed = allowed_columns(s, r, models, width)
    for level in range(s.depth):
        found = splits_of(level, allowed)
        nodes = slice(2**level - 1, 2 ** (level + 1) - 1)
        trees.column[r, :, nodes], trees.cut[r, :, nodes], trees.missing_left[r, :, nodes], trees.gain[r, :, nodes] = found.column, found.cut, found.missing_left, found.gain
    both = np.stack([found.left, found.right], axis=2).reshape(len(models), 2**s.depth, 2)
    trees.leaf[r] = -s.rate * both[..., 0] / (both[..., 1] + s.l2)


def _as_one_bin(sums: np.ndarray) -> np.ndarray:
    """All of a column's sums in its first bin: (models, nodes, bins, 2) to the same shape."""
    out = np.zeros_like(sums)
    out[:, :, 0] = sums.sum(axis=2)
    return out


def _grow_apart(held: DataFrame, s: Boosting, models: int, width: int, start: np.ndarray, middle: float, scale: float, binary: bool) -> Trees:
    """Not too many rows: each model grows in a task of its own, which holds all blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, states = None, []
        for batch in batches:
            for model, data in zip(batch.column(0), batch.column(1)):  # a block at a time
                m = model.as_py()
                states += new_states(data.as_py(), start[m : m + 1], middle, scale)
        if m is None:
            return
        trees = no_trees(s.rounds, 1, s.depth)
        for r in range(s.rounds):
            growing = tuple(p[r] for p in trees.parts()[:3])
            grow_round(trees, r, s, [m], width, lambda level, allowed: level_splits(block_sums(states, s, r, [m], width, level, growing, allowed, binary), allowed, s))  # noqa: B023
            for state in states:
                state["scores"][0] += trees.leaf[r, 0][places(state["bins"], *(p[0] for p in growing), s.depth, state["turns"][0])]
        packed = [np.ascontiguousarray(p).tobytes() for p in (*trees.parts(), trees.gain)]
        yield pa.RecordBatch.from_arrays([pa.array([m], pa.int32()), *(pa.array([p], pa.binary()) for p in packed)], ["model", *TREE_COLUMNS])

    each = held.select(F.explode(F.sequence(F.lit(0), F.lit(models - 1))).alias("model"), "data").repartitionById(models, "model")
    trees = no_trees(s.rounds, models, s.depth)
    # a model's trees, whose size the settings bound
    for row in each.mapInArrow(run, "model int, " + ", ".join(f"{c} binary" for c in TREE_COLUMNS)).collect():
        for c in TREE_COLUMNS:
            whole = getattr(trees, c)
            whole[:, row["model"]] = np.frombuffer(row[c], whole.dtype).reshape(s.rounds, -1)
    return trees


SPLIT_PARTS = ["column", "cut", "missing_left", "gain", "left", "right"]
TREE_COLUMNS = ["column", "cut", "missing_left", "leaf", "gain"]


def _grow_together(held: DataFrame, s: Boosting, models: int, width: int, start: np.ndarray, middle: float, scale: float, binary: bool) -> Trees:
    """Many blocks: a Spark job for every level of all models' trees of a round."""
    sc = held.sparkSession.sparkContext
    data = held.rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)
    parts, trees, every = data.getNumPartitions(), no_trees(s.rounds, models, s.depth), list(range(models))
    memory = sc.broadcast({"blocks": {}})
    sent: list = []  # broadcasts of SHIPPED_ROUNDS rounds each

    def job(r: int, level: int, allowed: np.ndarray) -> Splits:
        recent = tuple(p[len(sent) * SHIPPED_ROUNDS : r] for p in trees.parts())
        growing, before = tuple(p[r] for p in trees.parts()[:3]), list(sent)

        def run(rows: Iterator[tuple]) -> Iterator[tuple[int, np.ndarray]]:
            out, known = np.zeros((models, 2**level, width, BINS, 2)), memory.value["blocks"]
            for name, packed in rows:
                at, states = known.pop(name, (0, None))
                if states is None or at > r:
                    at, states = 0, new_states(packed, start, middle, scale)
                for state in states:
                    for i in range(at // SHIPPED_ROUNDS, len(before)):
                        advance(state["scores"], state["bins"], tuple(p[max(0, at - i * SHIPPED_ROUNDS) :] for p in before[i].value), s.depth)
                    advance(state["scores"], state["bins"], tuple(p[max(0, at - len(before) * SHIPPED_ROUNDS) :] for p in recent), s.depth)
                known[name] = r, states  # the latest last
                while len(known) > REMEMBERED:
                    known.pop(next(iter(known)))
                out += block_sums(states, s, r, every, width, level, growing, allowed, binary)
            # of columns that a model may not use there is nothing to send
            yield from ((m, out[m][:, allowed[m]]) for m in every)

        def choose(found: Iterator[tuple[int, np.ndarray]]) -> Iterator[tuple]:
            for m, part in found:
                sums = np.zeros((1, 2**level, width, BINS, 2))
                sums[0][:, allowed[m]] = part
                best = level_splits(sums, allowed[m : m + 1], s)
                yield m, *(getattr(best, c) for c in SPLIT_PARTS)

        each = data.mapPartitions(run)
        if parts <= 16:  # a few sums come to the driver: a second stage would cost each level more time
            totals: dict[int, np.ndarray] = {}
            for m, part in each.collect():
                totals[m] = totals[m] + part if m in totals else part
            chosen = list(choose(iter(sorted(totals.items()))))
        else:  # of many blocks they meet in a task, and a few numbers a node come
            chosen = sorted(each.reduceByKey(np.add, 1).mapPartitions(choose).collect(), key=lambda r: r[0])
        return Splits(*(np.concatenate(c) for c in list(zip(*chosen))[1:]))

    try:
        for r in range(s.rounds):
            grow_round(trees, r, s, every, width, lambda level, allowed: job(r, level, allowed))  # noqa: B023
            if (r + 1) % SHIPPED_ROUNDS == 0:
                done = slice(len(sent) * SHIPPED_ROUNDS, r + 1)
                sent.append(sc.broadcast(tuple(p[done] for p in trees.parts())))
    finally:
        data.unpersist()
        for b in (memory, *sent):
            b.unpersist()
    return trees


@dataclass
class Grown:
    """Models grown together; model f left out fold f, the last one saw all rows."""

    trees: Trees
    features: list[str]
    cuts: list[list[float]]
    start: np.ndarray
    middle: float
    scale: float
    binary: bool
    depth: int
    rows: DataFrame  # the blocks
    key_type: str

    def importances(self) -> list[tuple[str, float]]:
        """Mean gain of the last model's splits on each feature, as shares of their sum; the largest first."""
        column, gain = self.trees.column[:, -1].ravel(), self.trees.gain[:, -1].ravel()
        mean = [float(gain[column == i].mean()) if (column == i).any() else 0.0 for i in range(len(self.features))]
        return sorted(zip(self.features, (x / (sum(mean) or 1.0) for x in mean)), key=lambda r: (-r[1], r[0]))

    def _value(self) -> Callable[[np.ndarray], np.ndarray]:
        binary, middle, scale = self.binary, self.middle, self.scale
        return lambda s: 1 / (1 + np.exp(-s)) if binary else middle + scale * s

    def predictions(self) -> DataFrame:
        """(key, fold, label, cv_prediction, prediction) of every training row; cv_prediction is of the model that left the row's fold out."""
        spark, start, depth, value, folds = self.rows.sparkSession, self.start, self.depth, self._value(), len(self.start) - 1
        sent = spark.sparkContext.broadcast(self.trees.parts())

        def scored(bins: np.ndarray, m: int) -> np.ndarray:
            scores = np.full((1, bins.shape[1]), start[m])
            advance(scores, bins, tuple(p[:, [m]] for p in sent.value), depth)
            return scores[0]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for data in batch.column(1):
                    table, _, y, fold, bins = read_block(data.as_py())
                    # a row needs two models: the one that left out its fold, and the last
                    own, last = np.empty(len(y)), np.empty(len(y))
                    for i in range(0, len(y), CHUNK_ROWS):
                        part = slice(i, i + CHUNK_ROWS)
                        last[part] = scored(bins[:, part], -1)
                        of = np.minimum(fold[part], folds)
                        for m in np.unique(of):
                            rows = np.flatnonzero(of == m)
                            own[i + rows] = scored(bins[:, i + rows], int(m))
                    columns = [table["key"].combine_chunks(), table["fold"].combine_chunks().cast(pa.int32()), pa.array(y), pa.array(value(own)), pa.array(value(last))]
                    columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "fold", "label", "cv_prediction", "prediction"])

        return self.rows.mapInArrow(run, f"key {self.key_type}, fold int, label double, cv_prediction double, prediction double")

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """df with the last model's prediction: a probability, or a value."""
        trees = tuple(p[:, -1:] for p in self.trees.parts())
        spark, cuts, start, depth, value = df.sparkSession, self.cuts, self.start[-1:], self.depth, self._value()
        sent = spark.sparkContext.broadcast(trees)

        @F.pandas_udf("double")
        def scored(*columns):
            import pandas as pd

            bins = np.stack([binned(c.to_numpy(np.float64, na_value=np.nan), cut) for c, cut in zip(columns, cuts)])
            scores = np.repeat(start[:, None], bins.shape[1], axis=1)
            advance(scores, bins, sent.value, depth)
            return pd.Series(value(scores[0]))

        return df.withColumn(name, scored(*[_number(f) for f in self.features]))


def grow(df: DataFrame, features: Sequence[str], target: str, key: str, binary: bool, settings: Boosting, folds: int, block_rows: int | None = None) -> Grown:
    """Grows `folds` models, each without one fold, and one on all rows.  df: has a column fold from 0 to folds - 1.

    Rows without a target take no part; missing and NaN features are missing values; without rows it is an error.
    """
    spark = configure(df.sparkSession)
    ensure_checkpoint_dir(spark)
    s, features = settings, list(features)
    y = F.col(f"`{target}`").cast("double")
    per_fold = {r["fold"]: r for r in df.filter(y.isNotNull()).groupBy("fold").agg(F.count("*").alias("n"), F.sum(y).alias("sum"), F.min(y).alias("lo"), F.max(y).alias("hi")).collect()}
    if not per_fold:
        raise ValueError(f"no row has a {target}")
    if binary and any(r[c] not in (0.0, 1.0) for r in per_fold.values() for c in ("lo", "hi")):
        raise ValueError(f"{target} is not 0 or 1")
    mean = lambda left_out: (sum(r["sum"] for f, r in per_fold.items() if f != left_out), sum(r["n"] for f, r in per_fold.items() if f != left_out))
    means = [t / n if n else 0.0 for t, n in (mean(f) for f in [*range(folds), None])]
    if binary:
        middle, scale = 0.0, 1.0
        start = np.array([math.log(p / (1 - p)) if 0 < p < 1 else 40.0 * (2 * p - 1) for p in means])
    else:  # unit range, so that gradients can be whole multiples of one unit
        middle = means[-1]
        scale = max(abs(r[c] - middle) for r in per_fold.values() for c in ("lo", "hi")) or 1.0
        start = np.array([(m - middle) / scale for m in means])

    cuts = bin_cuts(df.filter(y.isNotNull()), features)
    held, apart = blocks(df, features, target, key, cuts, block_rows)
    models, width = folds + 1, len(features)
    trees = (_grow_apart if apart else _grow_together)(held, s, models, width, start, middle, scale, binary)
    return Grown(trees, features, cuts, start, middle, scale, binary, s.depth, held, df.schema[key].dataType.simpleString())
