import random

import numpy as np
import pytest
from llm_data import docs, labels, sf  # noqa: F401

from anchorframe.llm import quality, toxicity


def auc(y, s):
    rank = np.argsort(np.argsort(s))
    return (rank[y == 1].mean() - (y.sum() - 1) / 2) / max(1, (y == 0).sum())


@pytest.mark.parametrize("module, label, least", [(quality, "quality", 0.9), (toxicity, "toxic", 0.8)])
def test_held_out_accuracy(spark, module, label, least):
    truth = {r.doc_id: r[label] for r in sf(spark, "labels", "0.01").collect()}
    got = module.scored(sf(spark, "documents", "0.01"), sf(spark, "labels", "0.01")).collect()
    held = [(truth[r.doc_id], r.score, r.predicted) for r in got if r.held_out and r.doc_id in truth]
    y, s, p = map(np.array, zip(*held))
    assert len(got) == 1000 and auc(y, s) >= least and (p == y).mean() >= 0.85
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_defined_cases(docs, labels, module):
    import zlib

    rows = [(i, f"plain words number {i} here and there") for i in range(60)] + [(100 + i, f"### {i} idiot |||| !!!! moronic") for i in range(60)]
    known = labels([(i, 1, 0) for i in range(60)] + [(100 + i, 0, 1) for i in range(60)] + [(3, None, None), (None, 1, 1), (4, 0, 1), (4, 1, 0)])
    rows += [(None, "some text"), (500, None), (501, ""), (502, "word " * 50_000), (7, rows[7][1]), (8, "other text")]
    got = module.scored(docs(rows), known).collect()
    parts, fold = (5, 0) if module is quality else (4, 2)
    assert len(got) == len(rows) and got[0].asDict().keys() == {"doc_id", "held_out", "score", "predicted"}
    assert all(0 <= r.score <= 1 and r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % parts == fold) for r in got)
    by = {r.doc_id: r.score for r in got}
    assert (by[30] > by[130]) == (module is quality) and by[500] == by[501]
    none = module.scored(docs(rows), labels([])).collect()
    assert len(none) == len(rows) and {round(r.score, 6) for r in none} == {0.5}
    assert module.scored(docs([]), known).count() == 0


def test_labels_of_the_held_out_fold_are_not_read(docs, labels):
    import zlib

    rows = [(i, f"{'good words' if i % 2 else '$$$ ### |||'} {i}") for i in range(200)]
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    truth = [(i, i % 2, 0) for i in range(200)]
    turned = [(i, 1 - q if held(i) else q, t) for i, q, t in truth]
    a, b = ({r.doc_id: r.score for r in quality.scored(docs(rows), labels(x)).collect()} for x in (truth, turned))
    assert a == b


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, above = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def test_automaton_against_edit_distance():
    rng = random.Random(4)
    terms = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(3, 11))) for _ in range(60)})
    trie = toxicity.FuzzyTrie(terms)
    for _ in range(1500):
        word = list(rng.choice(terms)) if rng.random() < 0.7 else [rng.choice("abc") for _ in range(rng.randint(0, 12))]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(word))
            word[at : at + rng.randint(0, 1)] = rng.choice(("", "a", "d"))
        word = "".join(word)
        near = [(d, t) for t in terms if (d := distance(word, t)) <= toxicity.allowed_errors(t)]
        assert trie.find(word) == ((min(near)[1], min(near)[0]) if near else None)


def test_quotation_is_told_from_abuse():
    scorer = toxicity.Scorer({"idiot": 3.0, "worthless": 3.0})
    f = lambda text: dict(zip(toxicity.FEATURES, scorer.features(text)))
    abuse, quote, reported, typo = f("you are an idiot today"), f('the word "idiot" is old'), f("they called him idiot once"), f("a worthles thing")
    assert abuse["abuse"] > 0 and abuse["addressed"] > 0 and abuse["quoted"] == 0
    assert quote["quoted"] > 0 and quote["abuse"] == 0 and reported["quoted"] > 0 and reported["abuse"] == 0
    assert typo["fuzzy_abuse"] > 0 and typo["abuse"] == 0 and f(None)["length"] == 0


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y)
    assert (0, 1) in model.pairs and ((model.scores(x) > 0.5) == y).mean() > 0.9


def test_long_quotations_and_stray_marks():
    scorer, names = toxicity.Scorer({"idiot": 3.0}), toxicity.FEATURES
    long = "nine or more words stand in this first quotation here"

    def kinds(text):
        x = scorer.features(text)
        return x[names.index("abuse")] > 0, x[names.index("quoted")] > 0

    for a, b in ('""', "“”", "„“", "«»", "»«", "‹›", "””"):
        assert kinds(f"{a}{long}{b} you idiot {a}fine{b}") == (True, False), a + b
        assert kinds(f"{a}{long} idiot{b} fine {a}idiot{b}") == (False, True), a + b
        assert kinds(f"a {a}b{b} c {a}idiot{b}, d") == (False, True), a + b
    assert kinds('a 5" pipe, you idiot "fine"') == (True, False) == kinds('a "stray you idiot "fine"') == kinds('a "stray\n\nyou idiot" b')
    assert kinds('a 5" pipe, "idiot" b') == (False, True) == kinds("il dit « idiot » ici")
