import hashlib
import random
import sys

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from anchorframe.llm import bpe
from llm_data import SF_DIR, docs, sf  # noqa: F401

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(library, rows, got):
    def want(text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        return len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)

    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[3])
    assert sorted(((i, *want(t)) for i, t in rows), key=key) == sorted(((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in got), key=key)


def test_against_library(spark, docs, library):
    rng = random.Random(2)
    odd = "\u0558\u2b73aZ9 '\"\n\t  \r\x00\x1c\x1f\x85\xa0  　​-_.!é߷あ漢ｱ𝔘🙂Ⅷ²½´’'s're<|endoftext|>"
    rows = [(i, "".join(rng.choice(odd) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    rows += [(900, None), (901, ""), (902, "<|endoftext|>"), (903, "a<|endoftext|><|endoftext|> b <|endof"), (None, "it's we'll"), (7, "same id"), (904, "long " * 30_000), (905, "x" * 3_000)]
    check(library, rows, bpe.encode_decode(docs(rows), PATH, buckets=5, chunk_chars=2_000).collect())


def test_splits_at_every_character(library):
    """The pattern cuts where the library does, whatever the character."""
    split = bpe.splitter(["<|endoftext|>"], bpe.newer_letters(library.to_str()))
    step = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    for i in range(0, len(step), 20_000):
        text = "".join(f"a{chr(c)}b {chr(c)}1 " for c in step[i : i + 20_000])
        spans = [s for _, s in library.pre_tokenizer.pre_tokenize_str(text)]
        assert [text[a:b] for a, b in spans] == split(text)


def test_documents(spark, library):
    rows = [(r.doc_id, r.text) for r in sf(spark, "documents").collect()]
    check(library, rows, bpe.encode_decode(sf(spark, "documents"), PATH).collect())


def test_query_digests(spark, library):
    import __spark_entry__ as entry_points

    row = entry_points.queries()["op8_bpe"](spark, SF_DIR).filter("doc_id = 3").first()
    text = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter("doc_id = 3").first().text
    ids = library.encode(text, add_special_tokens=False).ids
    assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table_and_other_tokenizers(docs):
    assert bpe.encode_decode(docs([]), PATH).count() == 0
    with pytest.raises(ValueError):
        bpe.encode_decode(docs([]), public_tokenizers.path("word_bpe_49k.json"))


def test_packing():
    codec = bpe.Codec()
    assert codec.unpack(codec.pack(np.array([1, 300, 70_000]))).tolist() == [1, 300, 70_000]
    assert codec.unpack_words(codec.pack_words([b"", b"ab", b"\xc3"])) == [b"", b"ab", b"\xc3"]


def test_changed_input_is_an_error(spark, docs):
    text = open(PATH, encoding="utf-8").read()
    sent = spark.sparkContext.broadcast({"json": text}), spark.sparkContext.broadcast(bpe.pieces(text))
    first, second = (docs([(1, t)], parts=1) for t in ("one text", "another text"))
    ids = bpe.encode_words(bpe.split_chunks(first, [], "", 2, 1_000, texts=False), sent[0])
    chunks = bpe.split_chunks(second, [], "", 2, 1_000, texts=True)
    with pytest.raises(Exception, match="docs changed between two reads"):
        bpe.assemble(chunks.unionByName(ids), sent[1]).collect()
