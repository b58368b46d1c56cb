"""Benchmark decontamination: which documents hold which benchmark items.  DataFrame functions only.

Size-partitioned MinHash containment search.  A text is the set of its five-word shingles, ordered by their 64-bit hash.
Banded MinHash signatures of whole documents cannot find a short item in a long document (30 shingles in 5,000 have a
Jaccard similarity of 0.006), so the signatures are cut by containment instead.  An item with n shingles is contained if
at most n - ceil(t n) of them are missing.  Its MinHash sketch is therefore its n - ceil(t n) + 1 smallest hashes: a
document that contains the item must hold at least one of them, so no pair is missed.  Items are partitioned by size
(powers of two of n); each partition has its own largest sketch hash, and a document is looked up only in partitions of
items that are not too large for it, with those of its hashes that lie under the partition's largest.  What the look-up
finds is verified by exact containment on the shingles' text.

Defined cases: null texts are empty; an item without words matches nothing; a text of one to four words is one shingle;
rows with a null doc_id or item_id cannot be named in a pair and give none; repeated rows give their pair once, and of
rows that share an id with different texts the best containment counts; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anchorframe.llm.common import alnum_words, written

#: Bits of the filter in front of the look-up, in 64-bit words: 512 KB whatever the input.
FILTER_WORDS = 1 << 16
_SLOT = f"pmod(h, {FILTER_WORDS * 64}L)"


def _starts(size: Column, k: int) -> Column:
    """Start of each shingle, from 1; a text shorter than k is one shingle, an empty one none."""
    return F.when(size > 0, F.sequence(F.lit(1), F.greatest(size - (k - 1), F.lit(1)))).otherwise(F.array().cast("array<int>"))


def _shingles(words: Column, k: int) -> Column:
    return F.array_distinct(F.transform(_starts(F.size(words), k), lambda i: F.concat_ws(" ", F.slice(words, i, k))))


def _hash(word_hashes: Column, start: Column, k: int) -> Column:
    return F.xxhash64(F.slice(word_hashes, start, k))


def _class(n: Column) -> Column:
    """Size partition: 0 for one shingle, 1 for two or three, 2 for four to seven, ..."""
    return F.floor(F.log2(n.cast("double"))).cast("int")


def item_sketches(items: DataFrame, k: int, threshold: float) -> DataFrame:
    """(item_id, n, size_class, h): the smallest hashes of every item, enough of them for the threshold."""
    words = items.filter("item_id is not null").select("item_id", alnum_words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    hashed = words.select("item_id", F.transform("words", lambda w: F.xxhash64(w)).alias("wh"))
    hashes = hashed.select("item_id", F.array_sort(F.array_distinct(F.transform(_starts(F.size("wh"), k), lambda i: _hash(F.col("wh"), i, k)))).alias("hs"))
    n = F.size("hs")
    sketch = F.slice("hs", F.lit(1), (n - F.ceil(n * F.lit(threshold) - 1e-9) + 1).cast("int"))
    return hashes.select("item_id", n.alias("n"), _class(n).alias("size_class"), F.explode(sketch).alias("h"))


def _filter_words(sketches: DataFrame) -> DataFrame:
    """One row with one array: the bits of all sketch hashes.  Its size is fixed."""
    bit = F.expr(f"shiftleft(1L, cast({_SLOT} & 63 as int))")
    bits = sketches.select(F.expr(f"shiftright({_SLOT}, 6)").alias("id"), bit.alias("bit")).groupBy("id").agg(F.bit_or("bit").alias("bits"))
    every = sketches.sparkSession.range(0, FILTER_WORDS, 1, 4).join(bits, "id", "left")
    return every.agg(F.transform(F.sort_array(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0)).alias("bits")))), lambda x: x["bits"]).alias("words"))


def contained_items(docs: DataFrame, items: DataFrame, k: int = 5, threshold: float = 0.8) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment) for every item of which docs hold at least the threshold."""
    sketches = written(item_sketches(items, k, threshold), "item-sketches")
    bits = written(_filter_words(sketches), "sketch-bits")
    by_class = sketches.groupBy("size_class").agg(F.max("h").alias("top"))  # at most 32 partitions
    tops = written(by_class.agg(F.collect_list(F.struct("size_class", "top")).alias("tops")), "sketch-tops")

    # look-up: the document's hashes under the largest sketch hash of the partitions it can hold, and in the filter
    texts = docs.filter("doc_id is not null").select("doc_id", alnum_words(F.col("text")).alias("words"))
    hashed = texts.select("doc_id", F.transform("words", lambda w: F.xxhash64(w)).alias("wh"), _class(F.greatest(F.size("words") - (k - 1), F.lit(1))).alias("doc_class"),
                          bits.select("words").scalar().alias("bits"), tops.select("tops").scalar().alias("tops"))
    top = F.array_max(F.transform(F.filter("tops", lambda t: t["size_class"] <= F.col("doc_class") + 1), lambda t: t["top"]))
    at = hashed.withColumn("top", top).select("doc_id", "doc_class", "wh", "bits", "top", F.explode(_starts(F.size("wh"), k)).alias("i"))
    found = at.select("doc_id", "doc_class", "bits", "top", _hash(F.col("wh"), F.col("i"), k).alias("h")).filter(F.col("h") <= F.col("top"))
    bit = F.expr(f"shiftright(element_at(bits, cast(shiftright({_SLOT}, 6) + 1 as int)), cast({_SLOT} & 63 as int)) & 1L")
    passed = found.filter(bit == 1).select("doc_id", "doc_class", "h").distinct()
    candidates = written(passed.join(sketches, "h").filter(F.col("doc_class") >= F.col("size_class") - 1).select("doc_id", "item_id").distinct(), "candidates")

    # verification on the text; words are a column of their own so that no lambda splits the text again
    held = items.filter("item_id is not null").select("item_id", alnum_words(F.col("text")).alias("words")).select("item_id", _shingles(F.col("words"), k).alias("item"))
    pairs = (docs.select("doc_id", "text").join(candidates, "doc_id").select("doc_id", "item_id", alnum_words(F.col("text")).alias("words"))
             .join(held, "item_id").select("doc_id", "item_id", "item", _shingles(F.col("words"), k).alias("doc"))
             .select("doc_id", "item_id", F.size("item").alias("n_item"), F.size(F.array_intersect("item", "doc")).alias("n_shared")))
    # the threshold is tested after the grouping, where the optimiser does not evaluate the intersection once more
    best = pairs.groupBy("doc_id", "item_id").agg(F.max(F.struct((F.col("n_shared") / F.col("n_item")).alias("containment"), "n_shared", "n_item")).alias("x"))
    exact = best.filter(F.col("x.n_shared") >= F.ceil(F.col("x.n_item") * F.lit(threshold) - 1e-9))
    return exact.select("doc_id", "item_id", F.col("x.n_shared").cast("long").alias("n_shared"), F.col("x.n_item").cast("long").alias("n_item"), "x.containment")


def without_items(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """docs without those that hold an item.  Rows with a null doc_id cannot be named, and stay."""
    return docs.join(written(contained_items(docs, items, **settings).select("doc_id").distinct(), "contaminated"), "doc_id", "left_anti").select(docs.columns)


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents WHERE doc_id IS NOT NULL),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark WHERE item_id IS NOT NULL),
ds AS (SELECT DISTINCT doc_id, unnest([array_to_string(ws[i:i+4], ' ') FOR i IN range(1, greatest(len(ws) - 4, 1) + 1)]) AS s FROM d WHERE len(ws) > 0),
bs AS (SELECT DISTINCT item_id, unnest([array_to_string(ws[i:i+4], ' ') FOR i IN range(1, greatest(len(ws) - 4, 1) + 1)]) AS s FROM b WHERE len(ws) > 0),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY 1)
SELECT doc_id, item_id, count(*) AS n_shared, any_value(n_item) AS n_item, count(*) / any_value(n_item) AS containment
FROM ds JOIN bs USING (s) JOIN n USING (item_id) GROUP BY 1, 2 HAVING count(*) >= ceil(any_value(n_item) * 0.8 - 1e-9)
"""
