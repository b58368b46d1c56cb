from math import ceil

from llm_data import SF_DIR, docs  # noqa: F401
from tests_llm_tools import alnum_words

from anchorframe.llm import decontam


def shingles(text, k=5):
    words = [w for w in alnum_words(text) if w]
    return {" ".join(words[i : i + k]) for i in range(max(len(words) - k + 1, 1))} if words else set()


def brute(docs, items, threshold=0.8):
    out = {}
    for i, text in items:
        item = shingles(text)
        for d, body in docs:
            if i is None or d is None or not item:
                continue
            shared = len(item & shingles(body))
            if shared >= ceil(threshold * len(item) - 1e-9):
                out[d, i] = max(out.get((d, i), (0, 0)), (shared, len(item)))
    return {(*k, *v) for k, v in out.items()}


def test_cases(spark, docs):
    passage = "the quick brown fox jumps over the lazy dog near the old river bank today"
    long = " ".join(f"word{i}" for i in range(3000))
    rows = [(1, f"{long} {passage} {long}"), (2, passage.upper().replace(" ", ", ")), (3, " ".join(passage.split()[:12])), (4, " ".join(passage.split()[:13]) + " x"),
            (5, None), (6, ""), (7, "two words"), (8, "just two words here"), (None, passage), (9, passage), (9, long), (10, "straße é " * 4), (10, "straße é " * 4)]
    items = [(1, passage), (2, "two words"), (3, None), (4, ""), (None, passage), (5, passage), (6, "Straße É" + " straße é" * 3), (7, long), (5, "short one")]
    bench = spark.createDataFrame([(*r, "clash") for r in items], "item_id long, text string, doc_id string")
    got = [(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in decontam.contained_items(docs(rows), bench).collect()]
    want = brute(rows, items)
    assert len(got) == len(set(got)) and set(got) == want
    clean = decontam.without_items(docs(rows), bench)
    assert clean.columns == docs(rows).columns
    assert sorted(r.doc_id or 0 for r in clean.collect()) == sorted(d or 0 for d, _ in rows if d not in {w[0] for w in want})


def test_empty_tables(spark, docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contained_items(docs([(1, "a b c d e f")]), bench).count() == 0
    assert decontam.contained_items(docs([]), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).count() == 0


def test_main_path_is_native(spark):
    d, b = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = decontam.contained_items(d, b)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
