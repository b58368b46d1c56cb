import random

import pytest
import xxhash

from anchorframe.llm import simhash
from anchorframe.llm.common import components
from llm_data import docs  # noqa: F401
from tests_llm_tools import groups


def brute_fingerprint(text, k=4):
    ascii_lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in ascii_lower + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    shingles = [words] if 0 < len(words) < k else [words[i : i + k] for i in range(len(words) - k + 1)]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)) if hashes else 0


def check(rows, got):
    prints = [brute_fingerprint(t) for _, t in rows]
    ids = [i for i, _ in rows]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint) for r in got) == sorted((i is None, i or 0, f"{p:016x}") for i, p in zip(ids, prints))
    named = {p for i, p in zip(ids, prints) if i is not None}
    root = groups([(p, q) for p in named for q in named if (p ^ q).bit_count() <= 4])
    least = {}
    for i, p in zip(ids, prints):
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    assert all(r.component_id == (None if r.doc_id is None else least[root[int(r.fingerprint, 16)]]) for r in got)


def test_brute_force(spark, docs):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeÉ") for _ in range(4)) for _ in range(200)]
    rows = []
    for i in range(120):
        text = [rng.choice(words) for _ in range(rng.choice((0, 1, 3, 4, 5, 40, 300)))]
        rows.append((i, " ".join(text)))
        for j in range(rng.randint(0, 3)):  # near copies, some of them chains
            if text:
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((1000 + 10 * i + j, "\t ".join(text).title()))
    rows += [(5000, None), (5001, ""), (5002, " \n"), (None, "a b c d e"), (None, None), (3, rows[3][1]), (4, "other text under the same id")]
    check(rows, simhash.near_duplicates(docs(rows)).collect())


def test_empty_table(docs):
    assert simhash.near_duplicates(docs([])).collect() == []


@pytest.mark.parametrize("max_bits, segments", [(4, 3), (4, 4), (3, 3), (5, 2), (0, 3)])
def test_every_near_pair_shares_a_key(max_bits, segments):
    balls = simhash.segment_balls(max_bits, segments)
    rng = random.Random(1)
    for _ in range(500):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, max_bits)):
            b ^= 1 << bit
        cut = lambda x, s, w: x >> s & ((1 << w) - 1)
        assert any(cut(a, s, w) ^ flip == cut(b, s, w) for s, w, flip in balls)


def test_one_of_each_group(docs):
    text = "one two three four five six seven eight nine ten"
    rows = [(4, text), (2, text), (2, text), (9, "something else entirely, with its own words"), (None, text), (None, text)]
    kept = simhash.one_of_each_group(docs(rows))
    assert kept.columns == docs(rows).columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted([(0, text), (0, text), (2, text), rows[3]])


def test_every_group_keeps_one_document(docs):
    """Different texts under one id: each belongs to its own group, and no group is lost."""
    a, b, c = ("one two three four five six seven", "quite another text with words of its own", "a third one that has nothing to do with these")
    kept = simhash.one_of_each_group(docs([(4, a), (4, b), (9, b), (9, c), (5, c), (4, a), (7, ""), (8, None)]))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(4, a), (4, b), (5, c), (7, "")])


@pytest.mark.parametrize("k", [1, 2, 4])
def test_shingle_lengths_and_pieces(monkeypatch, k):
    rng = random.Random(k)
    for piece in (1, 7, 40, 1 << 20):
        monkeypatch.setattr(simhash, "PIECE", piece)
        for n in (0, 1, 2, 3, 4, 5, 30):
            text = "".join(rng.choice(["a", "bc", "É", "\u2003"]) + rng.choice([" ", "\n\t", "  "]) for _ in range(n))
            assert simhash.fingerprint(text, k) == brute_fingerprint(text, k)


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = groups(links)
    assert got == {n: r for n, r in want.items() if any(n in link and link[0] != link[1] for link in links)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
