import hashlib
import random
from array import array

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import SF_DIR, docs, sf  # noqa: F401

from anchorframe.llm import prefixes as px
from anchorframe.llm.pretokens import PATTERN, word_blocks

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = "՘⭳aZ9 '\"\n\t  \r\x00\x1c\x1f\x85\xa0  　​-_.!é߷あ漢ｱ𝔘🙂Ⅷ²½´’'s're'll<|endoftext|>"
RANKS = px.read_ranks(PATH)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def worker():
    return px.Worker.of({"ranks": RANKS, "never": px.never_made(RANKS), "newer": px.newer_letters()})


def some(rng, most=40):
    return "".join(rng.choice(ODD) for _ in range(rng.randint(0, most)))


def check(library, rows, got):
    want = [(i, len(ids := library.encode_ordinary(t or "")), np.array(ids, "<u4").tobytes(), (t or "").encode()) for i, t in rows]
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(want, key=key) == sorted(((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in got), key=key)


def test_against_library(docs, library):
    rng = random.Random(3)
    rows = [(i, some(rng, 60)) for i in range(300)]
    rows += [(900, None), (901, ""), (902, "<|endoftext|>"), (None, "it's we'll"), (None, None), (7, "same id"), (7, "same id"), (904, "long " * 400_000), (905, "xyz" * 30_000), (906, " " * 5_000 + "a")]
    check(library, rows, px.encode_decode(docs(rows), PATH).collect())


def test_documents(spark, library):
    check(library, [(r.doc_id, r.text) for r in sf(spark, "documents").collect()], px.encode_decode(sf(spark, "documents"), PATH).collect())


def test_query_digests(spark, library):
    import __spark_entry__ as entry_points

    rows = {r.doc_id: r for r in entry_points.queries()["op13_prefix_bpe"](spark, SF_DIR).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        ids = library.encode_ordinary(text or "")
        assert rows[i].n_tokens == len(ids) and rows[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_empty_table(docs):
    assert px.encode_decode(docs([]), PATH).count() == 0 and px.prefix_tables(docs([]), PATH).count() == 0


def test_every_character(worker, library):
    for i in range(0, 0x110000, 30_000):
        text = "".join(f"a{chr(c)}b {chr(c)}1 " for c in range(i, min(i + 30_000, 0x110000)) if not 0xD800 <= c < 0xE000)
        assert [x for w in worker.split(text) for x in worker.coder.encode(w.encode())] == library.encode_ordinary(text)


def test_blocks_cut_as_the_whole(worker):
    rng = random.Random(5)
    for _ in range(2_000):
        text = some(rng)
        assert [w for part in word_blocks(worker.split, text, rng.randint(1, 12)) for w in part] == worker.split(text)
    assert PATTERN == public_tokenizers.PATTERN


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=40))
def test_each_prefix(data):
    """The stored last token is that of the prefix's own encoding, also for vocabularies with tokens that merging never makes."""
    ranks = {bytes([b]): b for b in range(256)}
    ranks |= {t: 256 + i for i, t in enumerate([b"\0\0", b"\0\1", b"\1\0", b"\0\0\0", b"\1\1\0", b"\0\1\0\1", b"\2\1", b"\1\0\0\1", b"\2\2\2"])}
    data = bytes(b % 3 for b in data)
    coder = px.PrefixCoder(ranks)
    last = coder.extend([], data)
    assert len(last) == len(data)
    for n in range(1, len(data) + 1):
        assert coder.tokens_of(last, n) == px.merged(ranks, data[:n])


def test_appends_and_edits(worker, library):
    rng = random.Random(7)
    for _ in range(400):
        table = px.PrefixText.of(worker, some(rng))
        for _ in range(4):
            a = rng.randint(0, len(table.text))
            b, new = min(len(table.text), a + rng.randint(0, 4)), some(rng, 5)
            want = table.text[:a] + new + table.text[b:]
            table.changed(worker, a, b, new)
            assert table.text == want and table.ids(worker) == library.encode_ordinary(want)
            assert (table.starts, table.last) == ((fresh := px.PrefixText.of(worker, want)).starts, fresh.last)


def test_work_stays_near_the_edit(worker, library):
    table = px.PrefixText.of(worker, "abcdefghij" * 20_000 + " and so on " * 20_000)
    assert table.changed(worker, 100_000, 100_003, "zz") < 500  # inside one long word
    assert table.changed(worker, 300_000, 300_001, "y") < 500
    assert table.changed(worker, len(table.text), len(table.text), " more") < 500
    assert table.ids(worker) == library.encode_ordinary(table.text)


def test_stored_tables(spark, docs, library):
    rows = [(1, "It's a text with words"), (2, ""), (3, None), (4, "unchanged"), (None, "no id")]
    tables = px.prefix_tables(docs(rows), PATH)
    edits = spark.createDataFrame([(1, 5, 6, "another"), (2, 0, 0, "new"), (3, None, None, "end"), (9, 0, 0, "nobody")], "doc_id long, start long, stop long, replacement string")
    out = px.edited(tables, edits, PATH)
    got = {r.doc_id: r for r in out.collect()}
    assert {i: r.text for i, r in got.items()} == {1: "It's another text with words", 2: "new", 3: "end", 4: "unchanged", None: "no id"}
    assert got[4].n_redone == 0 and 0 < got[1].n_redone < len(got[1].text)
    for r in px.table_ids(out, PATH).collect():
        assert array("I", r.ids).tolist() == library.encode_ordinary(got[r.doc_id].text)
