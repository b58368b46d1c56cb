"""Toxicity: a lexicon trie met by Levenshtein automata, and context windows that tell quotation from abuse.

The lexicon holds the words that mark toxic documents among a bounded sample of labelled ones (by smoothed log odds).
Every word of a text runs through the intersection of the trie with the Levenshtein automaton: its states are sets of
(trie node, errors), made when first needed, so a word leaves as soon as no lexicon term is within reach.  A hit's
context window decides whether it is quoted (it lies between a pair of quotation marks, one of them within the window, or
a reporting word stands shortly before); what the
hits of a text add up to is weighed by a logistic model fitted on the same sample.

Defined cases: a null text is empty; a text without words has a score like any other; every row gives a row; a null
doc_id is never held out; without labels of both kinds the lexicon is empty and the score is the share of ones (0.5
without any label); further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorframe.llm.common import alnum_words, small_batches, written
from anchorframe.llm.sampling import in_fold, labelled_sample

#: Labelled rows that lexicon and weights are learned from, at most; lexicon terms, at most.
TRAIN_ROWS = 20_000
MAX_TERMS = 2_000
WINDOW = 8
FEATURES = ("abuse", "fuzzy_abuse", "quoted", "fuzzy_quoted", "strongest", "kinds", "rate", "addressed", "length")

# Words that report another's speech, and words that address the reader.
REPORTING = frozenset(w.encode() for w in "said says quote quoted quotes called wrote term word sagte sagt zitat wort nannte dit mot terme appelé cita palabra dijo término".split())
ADDRESS = frozenset(w.encode() for w in "you your youre are u du dich dir bist ihr tu toi vous es êtes tú te usted eres".split())

_LOWER = bytes(ord(chr(c).lower()) if c < 128 and chr(c).isalnum() or c >= 128 else 32 for c in range(128)) + bytes(range(128, 256))
_QUOTES = "\"“”„«»‹›"
_MARK = re.compile(rf"[{_QUOTES}]|\n\s*\n")
_STRAIGHT = str.maketrans(dict.fromkeys(_QUOTES, '"'))
_FAMILY = {c: f for f in ('"', "“”„", "«»", "‹›") for c in f}


def allowed_errors(term: str) -> int:
    """Misspellings that a term of this length may have."""
    return 0 if len(term) < 5 else 1 if len(term) < 10 else 2


class FuzzyTrie:
    """Lexicon terms as a trie, walked by words with errors (substituted, missing or extra characters)."""

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.term: dict[int, str] = {}
        self.room = [0]  # errors that the most generous term below a node allows
        for term in terms:
            node, most = 0, allowed_errors(term)
            self.room[0] = max(self.room[0], most)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.room.append(0)
                node = self.children[node][c]
                self.room[node] = max(self.room[node], most)
            self.term[node] = term
        self.numbers: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.next: list[dict[str, int]] = []
        self.result: list[tuple[str, int] | None] = []
        self.start = self._number({0: 0})

    def _number(self, reach: dict[int, int]) -> int:
        """The automaton's state for these (node, errors), closed under missing characters; -1 for none."""
        todo = list(reach)
        while todo:
            node = todo.pop()
            for child in self.children[node].values():
                errors = reach[node] + 1
                if errors <= self.room[child] and errors < reach.get(child, 99):
                    reach[child] = errors
                    todo.append(child)
        if not reach:
            return -1
        key = frozenset(reach.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(key)
            self.next.append({})
            ends = [(e, self.term[n]) for n, e in key if n in self.term and e <= allowed_errors(self.term[n])]
            self.result.append((min(ends)[1], min(ends)[0]) if ends else None)
        return self.numbers[key]

    def _step(self, state: int, c: str) -> int:
        reach: dict[int, int] = {}
        for node, errors in self.states[state]:
            for label, child in self.children[node].items():
                e = errors + (label != c)
                if e <= self.room[child] and e < reach.get(child, 99):
                    reach[child] = e
            if errors + 1 <= self.room[node] and errors + 1 < reach.get(node, 99):
                reach[node] = errors + 1
        out = self.next[state][c] = self._number(reach)
        return out

    def find(self, word: str) -> tuple[str, int] | None:
        """The lexicon term nearest to the word and its distance, or None; among equals the smallest term."""
        state, following = self.start, self.next
        for c in word:
            found = following[state].get(c)
            state = self._step(state, c) if found is None else found
            if state < 0:
                return None
        return self.result[state]


@dataclass
class ToxicityModel:
    terms: dict[str, float]
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES) + 1))


class Scorer:
    """Features of texts under a lexicon; remembers words it has looked up (up to a fixed number)."""

    REMEMBER = 1 << 20

    def __init__(self, terms: dict[str, float]):
        self.terms, self.trie = terms, FuzzyTrie(sorted(terms))
        self.seen: set[bytes] = set()
        self.hits: dict[bytes, tuple[float, int]] = {}

    def features(self, text: str | None) -> list[float]:
        marked = any(q in (text or "") for q in _QUOTES)
        words = (text or "").translate(_STRAIGHT).encode().translate(_LOWER).split() if marked else (text or "").encode().translate(_LOWER).split()
        distinct = set(words)
        for w in distinct - self.seen:
            found = self.trie.find(w.decode())
            if found:
                self.hits[w] = (self.terms[found[0]], found[1])
        self.seen |= distinct
        if len(self.seen) > self.REMEMBER:
            self.seen, self.hits = set(), {w: h for w, h in self.hits.items() if w in distinct}
            self.seen |= distinct
        own = distinct & self.hits.keys()
        if not own:
            return [0.0] * (len(FEATURES) - 1) + [float(np.log1p(len(words)))]
        quoted = _quoted(text) if marked else frozenset()
        sums, strongest, address = np.zeros(4), 0.0, 0
        for i, w in enumerate(words):
            if w in own:
                weight, errors = self.hits[w]
                before = words[max(0, i - WINDOW) : i]
                is_quoted = i in quoted or not REPORTING.isdisjoint(before[-3:])
                sums[2 * is_quoted + (errors > 0)] += weight
                if not is_quoted:
                    strongest = max(strongest, weight / (1 + errors))
                    address += not ADDRESS.isdisjoint(before) or not ADDRESS.isdisjoint(words[i + 1 : i + 1 + WINDOW])
        kinds = len({self.hits[w][0] for w in own if not self.hits[w][1]})
        return [*np.log1p(sums).tolist(), strongest, float(np.log1p(kinds)), float((sums[0] + sums[1]) / len(words)), float(np.log1p(address)), float(np.log1p(len(words)))]


def _quotations(text: str) -> list[tuple[int, int]]:
    """(start, end) of the marks of each quotation, whatever its length; within a paragraph.

    Directional marks pair by kind (also „x“, »x« and ”x”).  A straight mark opens after white space or a bracket, closes
    before white space or punctuation, and does what is due where both or neither holds.  An opening mark that is not
    closed before the next of its kind, and a closing mark without an opening one, are strays.
    """
    out, opened = [], {}
    for m in _MARK.finditer(text):
        c, i = m.group(), m.start()
        if c not in _FAMILY:
            opened.clear()
            continue
        family = _FAMILY[c]
        before, after = text[i - 1 : i] or " ", text[i + 1 : i + 2] or " "
        left, right = before.isspace() or before in "([{<-–—:", after.isspace() or after in ")]}>.,;:!?-–—"
        begun = opened.get(family)
        if c == '"':
            closes = begun is not None if left == right else right
        elif c == "„":
            closes = False
        elif c == "“":
            closes = begun is not None and text[begun] == "„"
        elif begun is None:
            closes = c in "”»›" and not (left and not right)
        else:
            closes = not (text[begun] == c and c in "«‹")
        if not closes:
            opened[family] = i
        elif begun is not None:
            out.append((begun, i))
            del opened[family]
    return sorted(out)


def _quoted(text: str) -> frozenset[int]:
    """Positions of words between a pair of quotation marks that have one of the two within the window."""
    out: set[int] = set()
    places, at, last = {}, 0, 0
    for m in re.finditer(f"[{_QUOTES}]", text):
        at += len(text[last : m.start()].encode().translate(_LOWER).split())
        places[m.start()], last = at, m.end()
    for a, b in _quotations(text):
        first, end = places[a], places[b]
        out.update(range(first, min(end, first + WINDOW)), range(max(first, end - WINDOW), end))
    return frozenset(out)


def learn_lexicon(sample: DataFrame, min_docs: int = 3, min_odds: float = 2.0, max_terms: int = MAX_TERMS) -> dict[str, float]:
    """Term -> smoothed log odds of toxic against clean documents.  sample: text, y; the result is bounded by max_terms."""
    total = sample.agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("clean")).first()
    if not total["toxic"] or not total["clean"]:
        return {}
    words = sample.select("y", F.explode(F.array_distinct(alnum_words(F.col("text")))).alias("word"))
    counts = words.groupBy("word").agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("clean")).filter((F.col("toxic") >= min_docs) & (F.length("word").between(3, 40)))
    odds = F.log((F.col("toxic") + 0.5) / (total["toxic"] + 1)) - F.log((F.col("clean") + 0.5) / (total["clean"] + 1))
    top = counts.select("word", odds.alias("odds"), "toxic").filter(F.col("odds") >= min_odds).orderBy(F.desc(F.col("odds") * F.log1p("toxic")), "word").limit(max_terms)
    return {r["word"]: float(r["odds"]) for r in top.collect()}


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 40) -> np.ndarray:
    """Weights of the standardised features folded back, with the intercept last (Newton steps)."""
    if len(np.unique(y)) < 2:
        share = (y.sum() + 0.5) / (len(y) + 1)
        return np.r_[np.zeros(x.shape[1]), np.log(share / (1 - share))]
    mean, sd = x.mean(axis=0), x.std(axis=0)
    sd[sd < 1e-9] = 1.0
    z = np.c_[(x - mean) / sd, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    keep = np.diag(np.r_[np.full(x.shape[1], ridge * len(x) ** 0.5), 1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z + keep, z.T @ (y - p) - keep @ w)
        w += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return np.r_[w[:-1] / sd, w[-1] - (w[:-1] * mean / sd).sum()]


def _with_features(docs: DataFrame, terms: dict[str, float], keep: list[str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(terms)  # bounded by max_terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            x = pa.array([scorer.features(t.as_py()) for t in batch.column("text")], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [x], [*keep, "x"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return small_batches(docs).select(*keep, F.col("text").cast("string").alias("text")).mapInArrow(run, f"{schema}, x array<double>")


def train(docs: DataFrame, labels: DataFrame, parts: int = 4, held_out: int = 2, rows: int = TRAIN_ROWS) -> ToxicityModel:
    """Lexicon and weights from at most `rows` labelled documents outside the held-out fold.

    The lexicon is learned on one half of the sample and the weights on the other, so that a term's weight is not judged
    by the documents that put it into the lexicon; then the lexicon is learned anew on all of the sample.
    """
    sample = written(labelled_sample(docs, labels, "toxic", parts, held_out, rows), "toxic-sample")
    half = F.pmod(F.xxhash64(F.lit("half"), F.col("doc_id")), F.lit(2)) == 0
    first = learn_lexicon(sample.filter(half))
    x = _with_features(sample.filter(~half), first, ["doc_id", "y"]).toPandas().sort_values("doc_id", kind="stable")
    y = x["y"].to_numpy(float)
    weights = fit_logistic(np.array(x["x"].tolist(), float).reshape(len(x), len(FEATURES)), y)
    return ToxicityModel(learn_lexicon(sample), weights)


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, parts: int = 4, held_out: int = 2, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs."""
    model = train(docs, labels, parts, held_out, rows)
    out = _with_features(docs, model.terms, ["doc_id"])
    terms = [F.col("x")[i] * float(w) for i, w in enumerate(model.weights[:-1])]
    logit = sum(terms, F.lit(float(model.weights[-1])))
    score = 1 / (1 + F.exp(-logit))
    return out.select("doc_id", score.alias("score")).select(
        "doc_id", F.coalesce(in_fold("doc_id", parts, held_out), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
