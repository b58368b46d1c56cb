import random

import numpy as np
from llm_data import docs, sf  # noqa: F401

from anchorframe.llm import suffix


def brute(rows, length=100):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1) if d is not None else ():
            first[b[i : i + length]] = min(first.get(b[i : i + length], (d, i)), (d, i))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1) if d is not None else ():
            if first[b[i : i + length]] < (d, i):
                gone[i : i + length] = b"\1" * length
        out.append((d, len(b), sum(gone), gone.count(b"\1") and sum(g and not p for p, g in zip(b"\0" + gone, gone)), bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


def check(df, rows):
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix.without_repeats(df).collect()), key=repr) == brute(rows)


def mixed(seed=5, n=120):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    text = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    base, rows = [text(rng.randint(1, 150)) for _ in range(40)], []
    for i in range(n):
        t, r = rng.choice(base) if rng.random() < 0.3 else text(rng.randint(1, 120)), rng.random()
        if r < 0.3:
            p = rng.choice(base)
            a = rng.randint(0, len(p))
            t += " " + p[a : a + rng.randint(50, 400)] + " " + text(5)
        elif r < 0.5:
            t += rng.choice(("ab ", "x", "a" * 30 + "b")) * rng.randint(20, 300)
        elif r < 0.55:
            t = (text(9) + " ") * 8
        rows.append((i, t))
    return rows + [(None, base[0] * 2), (5, rows[5][1]), (7, base[1] + base[2]), (500, None), (501, "")]


def test_brute_force(docs):
    rows = mixed()
    check(docs(rows), rows)


def test_spread_over_shards(docs, monkeypatch):
    """A hash with many segments is spread, and the shards' windows are merged."""
    monkeypatch.setattr(suffix, "HOT_SEGMENTS", 4)
    monkeypatch.setattr(suffix, "SHARD_SEGMENTS", 16)
    rng = random.Random(2)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(260))
    rows = mixed(8, 60) + [(1000 + i, f"{rng.random()} {passage[: rng.randint(150, 260)]} {rng.random()}" * rng.randint(1, 2)) for i in range(60)]
    check(docs(rows, 5), rows)


def test_documents(spark):
    df = sf(spark, "documents")
    check(df, [(r.doc_id, r.text) for r in df.collect()])


def test_empty_table(docs):
    check(docs([]), [])


def test_suffix_array_and_common_prefixes():
    rng = random.Random(3)
    for data in (b"banana" * 40, bytes(rng.choice(b"ab") for _ in range(500)), b"a" * 300, b"x"):
        order, group = suffix.suffix_array(data, 64)
        cut = [data[i : i + 64] for i in order]
        assert sorted(order.tolist()) == list(range(len(data))) and cut == sorted(cut)
        shared = suffix.common_prefixes(data, order, group, 64)
        for k in range(1, len(data)):
            a, b = data[order[k - 1] : order[k - 1] + 64], data[order[k] : order[k] + 64]
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert shared[k] == n or n < 64 and shared[k] < 64


def test_common_prefixes_of_suffixes_alike_in_all_that_was_sorted():
    """Suffixes alike in the 128 bytes that were sorted may change places without their first byte."""
    for seed in (355, 366, 367, 369):
        rng, letters = random.Random(seed), b"ab " if seed % 2 else b"abcdef "
        passage, parts = bytes(rng.choice(letters) for _ in range(300)), []
        for _ in range(12):
            a = rng.randrange(0, 200)
            parts.append(passage[a : a + rng.randint(60, 280)])
            parts.append(bytes(rng.choice(letters) for _ in range(rng.randint(0, 4))))
        data = b"".join(parts)
        order, group = suffix.suffix_array(data, 100)
        shared = suffix.common_prefixes(data, order, group, 100)
        whole = [data[i : i + 100] for i in order]
        assert [s >= 100 for s in shared[1:]] == [a == b and len(a) == 100 for a, b in zip(whole, whole[1:])]


def test_rows_that_share_an_id_and_a_place(docs, monkeypatch):
    """Rows with one doc_id and texts that begin alike lose the same bytes there, also where shards are merged."""
    monkeypatch.setattr(suffix, "HOT_SEGMENTS", 3)
    monkeypatch.setattr(suffix, "SHARD_SEGMENTS", 16)
    rng = random.Random(5)
    passages = ["".join(rng.choice("ab ") for _ in range(400)) for _ in range(3)]
    rows = []
    for _ in range(100):
        cuts = [(rng.choice(passages), rng.randrange(0, 300), rng.randint(60, 380)) for _ in range(rng.randint(1, 6))]
        rows.append((rng.randint(1, 40), "".join(p[a : a + n] + rng.choice("ab ") for p, a, n in cuts)))
    for _ in range(30):
        doc_id, text = rng.choice(rows)
        rows.append((doc_id, text[: rng.randint(50, len(text))] + "".join(rng.choice("ab ") for _ in range(50))))
    check(docs(rows, 4), rows)
