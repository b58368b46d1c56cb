"""Quality classifier: a generalised additive model with pairwise interactions, learned by cyclic boosting.

Every feature is cut into bins.  Boosting visits the features in turn and fits a shallow tree of one feature (then of
one pair) to the gradient, a small step each time; what the trees add up to is one table of values per feature and one
per pair.  A document's score is the sum of its bins' values, put through the logistic function.

Defined cases: a null text is empty; an empty text has a score like any other (its features are zero); every row gives a
row; a doc_id that is null is never held out; without labels of both kinds the model is the constant share of ones
(0.5 without any label); further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anchorframe.llm.common import small_batches
from anchorframe.llm.sampling import in_fold, labelled_sample

#: Labelled rows that the model is fitted on, at most.
TRAIN_ROWS = 12_000
FEATURES = ("log_bytes", "log_words", "word_length", "upper", "digit", "symbol", "bar", "mark", "non_ascii", "space", "lines",
            "distinct_words", "top_word", "symbol_ends", "repeated_lines", "capitals", "long_words", "quotes")


def _set(chars: str) -> np.ndarray:
    held = np.zeros(256)
    held[list(chars.encode())] = 1
    return held


_CLASSES = np.stack([
    _set("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _set("0123456789"), _set("#$%&*+<=>@[\\]^_`{}~/"), _set("|"), _set("!?"),
    np.r_[np.zeros(128), np.ones(128)], _set(" \t\r\x0b\x0c"), _set("\n"), _set("\"'()"),
], axis=1)
_ENDS = frozenset(b"!#$%&*|~^<>=+@{}[]\\/_")


def features(text: str | None) -> list[float]:
    """Shares and counts of one text, in the order of FEATURES; all zero for an empty text."""
    data = (text or "").encode()
    if not data:
        return [0.0] * len(FEATURES)
    n = len(data)
    upper, digit, symbol, bar, mark, high, space, newline, quotes = (np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _CLASSES).tolist()
    words = data.split()
    k = max(len(words), 1)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in data.split(b"\n") if x.strip()]
    return [
        np.log1p(n), np.log1p(len(words)), (n - space - newline) / k, upper / n, digit / n, symbol / n, bar / n, mark / n, high / n, space / n,
        newline / k, len(counts) / k, max(counts.values(), default=0) / k, sum(w[-1] in _ENDS for w in words) / k,
        1 - len(set(lines)) / max(len(lines), 1), sum(65 <= w[0] <= 90 for w in words) / k, sum(len(w) > 14 for w in words) / k, quotes / n,
    ]


def feature_rows(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns of keep and `x`, the features of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array([features(t.as_py()) for t in batch.column("text")], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [x], [*keep, "x"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return small_batches(docs).select(*keep, F.col("text").cast("string").alias("text")).mapInArrow(run, f"{schema}, x array<double>")


@dataclass
class AdditiveModel:
    """Look-up tables: score = logistic(base + tables[f][bin f] + pair_tables[(f, g)][bin f, bin g])."""

    base: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for f, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            out += table[np.searchsorted(cuts, x[:, f], side="right")]
        wide = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(self.coarse)] if self.pairs else []
        for (f, g), table in zip(self.pairs, self.pair_tables):
            out += table[wide[f], wide[g]]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -40, 40)))


def _quantile_cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Step of each bin: a tree of one feature, grown by its best cut until it has so many leaves."""
    spans = [(0, len(g))]
    gs, hs = np.r_[0, np.cumsum(g)], np.r_[0, np.cumsum(h)]
    for _ in range(leaves - 1):
        best = (1e-9, None)
        for a, b in spans:
            at = np.arange(a + 1, b)
            if len(at):
                gain = _gain(gs[at] - gs[a], hs[at] - hs[a]) + _gain(gs[b] - gs[at], hs[b] - hs[at]) - _gain(gs[b] - gs[a], hs[b] - hs[a])
                i = int(gain.argmax())
                if gain[i] > best[0]:
                    best = (gain[i], (a, int(at[i]), b))
        if best[1] is None:
            break
        a, m, b = best[1]
        spans = [s for s in spans if s != (a, b)] + [(a, m), (m, b)]
    step = np.zeros(len(g))
    for a, b in spans:
        step[a:b] = (gs[b] - gs[a]) / (hs[b] - hs[a] + 1.0)
    return step


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Step of each cell of a pair: one cut of the first feature, then one of the second on each side; and its gain."""
    best, step = 0.0, np.zeros_like(g)
    total = _gain(g.sum(), h.sum())
    for m in range(1, len(g)):
        gain, own = -total, np.zeros_like(g)
        for rows in (slice(0, m), slice(m, None)):
            gc, hc = g[rows].sum(axis=0), h[rows].sum(axis=0)
            part = _tree(gc, hc, 2)
            own[rows] = part
            for value in np.unique(part):
                same = part == value
                gain += _gain(gc[same].sum(), hc[same].sum())
        if gain > best:
            best, step = gain, own
    return step, best


def fit(x: np.ndarray, y: np.ndarray, bins: int = 48, coarse: int = 8, rounds: int = 120, rate: float = 0.1, leaves: int = 3, n_pairs: int = 6) -> AdditiveModel:
    """Fit on a bounded sample.  Every fifth row (of a fixed shuffle) decides how many rounds are kept."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = AdditiveModel(float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return model
    d = x.shape[1]
    model.cuts = [_quantile_cuts(x[:, f], bins) for f in range(d)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    fine = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(model.cuts)]
    check = np.random.default_rng(0).permutation(len(y)) % 5 == 0
    use = ~check
    logit = np.full(len(y), model.base)

    def slope():
        p = 1 / (1 + np.exp(-logit[use]))
        return y[use] - p, p * (1 - p)

    def loss():
        return float(np.logaddexp(0, np.where(y[check] > 0, -logit[check], logit[check])).mean())

    best, kept, waited = loss(), [t.copy() for t in model.tables], 0
    for _ in range(rounds):
        for f in range(d):
            g, h = slope()
            size = len(model.tables[f])
            step = rate * _tree(np.bincount(fine[f][use], g, size), np.bincount(fine[f][use], h, size), leaves)
            model.tables[f] += step
            logit += step[fine[f]]
        if (now := loss()) < best - 1e-5:
            best, kept, waited = now, [t.copy() for t in model.tables], 0
        elif (waited := waited + 1) >= 10:
            break
    model.tables = kept
    logit = model.base + sum(t[b] for t, b in zip(model.tables, fine))

    # interactions: the pairs whose best tree explains most of what is left, boosted in the same way
    model.coarse = [_quantile_cuts(x[:, f], coarse) for f in range(d)]
    wide = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(model.coarse)]
    shape = {(f, e): (len(model.coarse[f]) + 1, len(model.coarse[e]) + 1) for f in range(d) for e in range(f + 1, d)}
    cell = lambda p: wide[p[0]] * shape[p][1] + wide[p[1]]

    def sums(p, g, h):
        n = shape[p][0] * shape[p][1]
        return np.bincount(cell(p)[use], g, n).reshape(shape[p]), np.bincount(cell(p)[use], h, n).reshape(shape[p])

    g, h = slope()
    ranked = sorted(shape, key=lambda p: (-_pair_tree(*sums(p, g, h))[1], p))
    model.pairs = ranked[:n_pairs]
    model.pair_tables = [np.zeros(shape[p]) for p in model.pairs]
    best, kept, waited = loss(), [t.copy() for t in model.pair_tables], 0
    for _ in range(rounds // 2):
        for p, table in zip(model.pairs, model.pair_tables):
            step = rate * _pair_tree(*sums(p, *slope()))[0]
            table += step
            logit += step[wide[p[0]], wide[p[1]]]
        if (now := loss()) < best - 1e-5:
            best, kept, waited = now, [t.copy() for t in model.pair_tables], 0
        elif (waited := waited + 1) >= 5:
            break
    model.pair_tables = kept
    return model


def train(docs: DataFrame, labels: DataFrame, parts: int = 5, held_out: int = 0, rows: int = TRAIN_ROWS) -> AdditiveModel:
    """Fit on at most `rows` labelled documents outside the held-out fold; only their features reach the driver."""
    sample = feature_rows(labelled_sample(docs, labels, "quality", parts, held_out, rows), ["doc_id", "y"]).toPandas()
    sample = sample.sort_values("doc_id", kind="stable")
    return fit(np.array(sample["x"].tolist(), float).reshape(len(sample), len(FEATURES)), sample["y"].to_numpy(float))


def score_column(docs: DataFrame, model: AdditiveModel) -> Column:
    """Scores of the text column by vectorised look-ups."""
    shared = small_batches(docs).sparkSession.sparkContext.broadcast(model)  # the tables' size is fixed by the number of bins

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        x = np.array([features(t) for t in texts], float).reshape(len(texts), len(FEATURES))
        return pd.Series(shared.value.scores(x))

    return score(F.col("text").cast("string"))


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, parts: int = 5, held_out: int = 0, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs."""
    model = train(docs, labels, parts, held_out, rows)
    out = docs.select("doc_id", score_column(docs, model).alias("score"))
    return out.select("doc_id", F.coalesce(in_fold("doc_id", parts, held_out), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **settings) -> DataFrame:
    """docs whose quality score reaches the threshold."""
    model = train(docs, labels, **settings)
    return docs.filter(score_column(docs, model) >= threshold)
