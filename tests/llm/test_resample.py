import hashlib
import random
import zlib
from math import floor, log

import numpy as np
import pytest
from compare import differences, duck
from llm_data import SF_DIR, docs, sf  # noqa: F401
from tests_llm_tools import alnum_words

from anchorframe.llm import resample


def grams(text, n):
    words = [w for w in alnum_words(text) if w]
    return len(words), [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def brute(rows, target, n=1, buckets=10_000, percent=10, min_words=20, seed=2024):
    of = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = np.zeros(buckets), np.zeros(buckets)
    for _, text in rows:
        for g in grams(text, n)[1]:
            s[of(g)] += 1
    for text in target:
        for g in grams(text, n)[1]:
            t[of(g)] += 1
    gain = [floor(1000 * log((b + 1) * (s.sum() + buckets) / ((a + 1) * (t.sum() + buckets)))) for a, b in zip(s, t)]
    out, many = [], []
    for i, text in rows:
        words, found = grams(text, n)
        weight, score = sum(gain[of(g)] for g in found), None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + floor(-1000 * log(-log((h + 0.5) / 4294967296)))
            if words >= min_words:
                many.append((-score, i, words, weight))
        out.append((i, len(found), weight, score, words))
    many.sort()
    rank = {m: k for k, m in enumerate(many[: percent * len(many) // 100], 1)}
    return sorted(((i, k, w, sc, rank.get((-sc, i, n_, w)) if i is not None and n_ >= min_words else None) for i, k, w, sc, n_ in out), key=repr)


def got(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in df.collect()), key=repr)


def some(rng, most):
    return "".join(rng.choice(["word ", "Word", "é ", "x9-", "\x00", "ÿa ", "\n", "the ", "ß", "漢 "]) for _ in range(rng.randint(0, most)))


@pytest.mark.parametrize("n", [1, 2, 3])
def test_against_brute_force(monkeypatch, spark, docs, n):
    monkeypatch.setattr(resample, "BLOCK", 37)
    rng = random.Random(n)
    rows = [(i, some(rng, 90)) for i in range(80)] + [(100, None), (101, ""), (None, "no id " * 30), (102, "same " * 25), (103, "same " * 25), (7, "again " * 30), (7, "again " * 30), (104, "long " * 3_000)]
    target = [some(rng, 40) for _ in range(9)] + [None, ""]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    found = resample.resampled(docs(rows), table, n=n, buckets=500, percent=40, min_words=5)
    want = brute(rows, target, n, 500, 40, 5)
    # of rows that are the same in every column either may come first
    assert [r[:4] for r in got(found)] == [r[:4] for r in want] and sorted(str(r) for r in got(found)) == sorted(str(r) for r in want)


def test_runs_do_not_cross_documents(monkeypatch):
    rng = random.Random(9)
    for block in (1, 5, 40, 1 << 20):
        monkeypatch.setattr(resample, "BLOCK", block)
        for n in (1, 2, 4):
            texts = [some(rng, 12) for _ in range(rng.randint(0, 8))]
            counts, words = np.zeros(len(texts), int), np.zeros(len(texts), int)
            codes = []
            for c, place, own in resample.features([t.encode() for t in texts], n, resample.Buckets(997)):
                counts += np.bincount(place, minlength=len(texts))
                words += np.bincount(own, minlength=len(texts))
                codes += c.tolist()
            want = [grams(t, n) for t in texts]
            assert counts.tolist() == [len(g) for _, g in want] and words.tolist() == [w for w, _ in want]
            assert sorted(codes) == sorted(zlib.crc32(g.encode()) % 997 for _, gs in want for g in gs)


def test_query_is_the_sql_and_the_brute_force(spark):
    import __spark_entry__ as entry_points

    df = entry_points.queries()["op11_resampling"](spark, SF_DIR)
    assert differences(df, duck(SF_DIR), entry_points.oracle_sql()["op11_resampling"]) is None
    rows = [(r.doc_id, r.text) for r in sf(spark, "documents").collect()]
    if SF_DIR.endswith("sf0.001"):
        assert got(df) == brute(rows, [r.text for r in sf(spark, "benchmark").collect()])


def test_empty_tables(spark, docs):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert resample.resampled(docs([]), nothing).count() == 0
    rows = [(i, f"some words for number {i} " * 6) for i in range(20)]
    assert got(resample.resampled(docs(rows), nothing)) == brute(rows, [])


def test_many_ranges_number_as_one(spark):
    rows = [(i, (i * 7919) % 50, 30, i % 3) for i in range(5_000)]
    df = spark.createDataFrame(rows, "doc_id long, score long, n_words long, weight long")
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert {r.doc_id: r["rank"] for r in resample.ranked(df, 13).collect()} == {r[0]: k for k, r in enumerate(order, 1)}
