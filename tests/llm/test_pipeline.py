import hashlib

import numpy as np
import public_tokenizers
from llm_data import SF_DIR, docs, sf  # noqa: F401
from test_decontam import brute as brute_items
from test_simhash import brute_fingerprint
from tests_llm_tools import groups
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from anchorframe.llm import pii, quality


def test_against_brute_force(spark):
    rows = {r.doc_id: r.text for r in sf(spark, "documents").collect()}
    model = quality.train(sf(spark, "documents"), sf(spark, "labels"))
    kept = {i: t for i, t in rows.items() if model.scores(np.array([quality.features(t)]))[0] >= 0.3}
    prints = {i: brute_fingerprint(t) for i, t in kept.items()}
    root = groups([(i, j) for i in kept for j in kept if (prints[i] ^ prints[j]).bit_count() <= 4])
    kept = {i: t for i, t in kept.items() if root[i] == i}
    found = {d for d, *_ in brute_items(kept.items(), [(r.item_id, r.text) for r in sf(spark, "benchmark").collect()])}
    kept = {i: pii.redact(t) for i, t in kept.items() if i not in found}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for i, t in kept.items():
        ids = library.encode(t, add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()}
    assert got == want and 0 < len(got) < len(rows)


def test_stages_keep_the_columns_and_take_an_empty_table(spark):
    table = sf(spark, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table.limit(0), "/root/testdata/sf0.001")
        assert out.columns == table.columns and out.count() == 0, name


def test_registered():
    names = entry_points.queries().keys()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))


def test_stages_on_nulls_repeats_and_long_texts(spark, docs):
    prose = "This is a plain text about a river, a bridge and a town; people walk over the bridge to the market on most days. "
    rows = [(None, None), (None, prose), (None, prose), (1, None), (1, prose), (1, prose * 2), (2, ""), (3, prose), (4, "x"), (5, prose * 3_000), (6, "write to joe@mail.org " + prose)]
    table = docs(rows)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, table, SF_DIR)
        got = [(r.doc_id, r.text if name != "bpe" else None) for r in out.collect()]
        if name != "bpe":
            assert out.columns == table.columns
        if name in ("pii", "bpe"):
            assert sorted(str(i) for i, _ in got) == sorted(str(i) for i, _ in rows)
        elif name == "simhash":
            named = {(i, t): brute_fingerprint(t) for i, t in rows if i is not None}
            root = groups([(p, q) for p in named.values() for q in named.values() if (p ^ q).bit_count() <= 4])
            assert sum(i is None for i, _ in got) == 3 and sorted(root[named[r]] for r in got if r[0] is not None) == sorted(set(root.values()))
        elif name == "decontamination":
            assert len(got) == len(rows)
        if name == "pii":
            assert (1, None) in got and not any(t and "joe@" in t for _, t in got)
