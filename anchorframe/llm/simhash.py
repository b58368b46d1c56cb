"""SimHash near-duplicates by multi-index hashing.

A document's fingerprint has a bit set where more than half of its shingles' hashes have it.  To find fingerprints
within `max_bits` of each other, they are cut into segments.  If two differ in at most r bits and there are m segments,
one of the first (r mod m) + 1 segments differs in at most r // m bits, or one of the others in at most r // m - 1.
So every fingerprint enters a table once for each segment, every fingerprint also asks for the values in the small
Hamming ball around each of its segments, and each match is verified on all 64 bits.  The bound is exact: no pair is lost.

Defined cases: a null text is empty; without words the fingerprint is zero and links like any other; equal fingerprints
are one node, so copies cost nothing; a null doc_id keeps its fingerprint but links to nothing (component_id null);
rows with the same doc_id each give a row, with the component of their own text; further columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorframe.llm.common import components, small_batches, written

BITS = 64
PIECE = 1 << 20
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def fingerprint(text: str | None, k: int = 4, seed: int = 42) -> int:
    """Unsigned SimHash of the k-word shingles, repeats included.  A very long text is cut between words and read piece by piece."""
    data = (text or "").encode().lower()
    counts, n, digest = np.zeros(BITS, np.int64), 0, xxhash.xxh64_intdigest
    before: list[bytes] = []  # the words that the next piece's first shingles begin with
    at = 0
    while at < len(data):
        end = at + PIECE
        gap = _GAP.search(data, end) if end < len(data) else None
        end = gap.start() if gap else len(data)
        words = before + data[at:end].split()
        at = end
        if len(words) >= k:
            joined = b" ".join(words)
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(lengths + 1) - 1
            starts = ends - lengths
            hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())], np.uint64)
            for i in range(0, len(hashes), 1 << 16):
                block = hashes[i : i + (1 << 16)]
                counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            n += len(hashes)
        before = words[len(words) - min(k - 1, len(words)) :]
    if not n:
        return digest(b" ".join(before), seed) if before else 0  # of a single hash, its own bits
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, k: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp, text_hash): the fingerprint's 64 bits as a signed long, and a hash that tells texts under one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), k, seed) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64()), batch.column(2)], ["doc_id", "fp", "text_hash"])

    columns = F.col("doc_id").cast("long"), F.col("text").cast("string"), text_hash().alias("text_hash")
    return small_batches(docs).select(*columns).mapInArrow(run, "doc_id long, fp long, text_hash long")


def text_hash():
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def segment_balls(max_bits: int, segments: int) -> list[tuple[int, int, int]]:
    """(shift, width, mask to flip) for every value that a fingerprint asks for."""
    width, extra = divmod(BITS, segments)
    out, shift = [], 0
    for s in range(segments):
        w = width + (s >= segments - extra)
        radius = max_bits // segments - (s > max_bits % segments)
        out += [(shift, w, sum(1 << bit for bit in flipped)) for r in range(radius + 1) for flipped in combinations(range(w), r)]
        shift += w
    return out


def linked(nodes: DataFrame, max_bits: int = 4, segments: int = 3) -> DataFrame:
    """(a, b): distinct fingerprints at most max_bits apart.  nodes: fp."""
    balls = segment_balls(max_bits, segments)
    cuts = sorted({(shift, w) for shift, w, _ in balls})

    def key(shift: int, w: int, flip: int = 0):
        part = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << w) - 1)).bitwiseXOR(F.lit(flip))
        return part.bitwiseOR(F.lit(shift << 40).cast("long"))  # the segment's own number above its value

    entries = nodes.select(F.explode(F.array(*[key(s, w) for s, w in cuts])).alias("key"), F.col("fp").alias("b"))
    asked = nodes.select(F.explode(F.array(*[key(*ball) for ball in balls])).alias("key"), F.col("fp").alias("a"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return asked.join(entries, (asked["key"] == entries["key"]) & (F.col("a") < F.col("b")) & near).select("a", "b")


def grouped(docs: DataFrame, k: int, max_bits: int, segments: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Written: (doc_id, fp, text_hash) of every row, and (fp, root, component_id, n_linked) of the named rows' fingerprints."""
    prints = written(fingerprints(docs, k, seed), "fingerprints")
    nodes = written(prints.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("label")), "nodes")
    pairs = written(linked(nodes, max_bits, segments).distinct(), "links")
    links = pairs.select(F.explode(F.array("a", "b")).alias("fp")).groupBy("fp").agg(F.count("*").alias("n_linked"))
    roots = written(components(pairs).withColumnRenamed("node", "fp"), "roots")
    placed = nodes.join(roots, "fp", "left").join(links, "fp", "left")
    placed = written(placed.select("fp", "label", F.coalesce("root", "fp").alias("root"), F.coalesce("n_linked", F.lit(0)).alias("n_linked")), "placed")
    # written before it is joined, so that Spark sees a hot root and can split it
    names = written(placed.groupBy("root").agg(F.min("label").alias("component_id")), "names")
    return prints, written(placed.join(names, "root").select("fp", "root", "component_id", "n_linked"), "named")


def near_duplicates(docs: DataFrame, k: int = 4, max_bits: int = 4, segments: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint, component_id, n_linked) for every row of docs.

    n_linked: with how many other texts' fingerprints this one is linked directly.
    """
    prints, named = grouped(docs, k, max_bits, segments, seed)
    return (prints.join(named, "fp", "left")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
                    F.when(F.col("doc_id").isNotNull(), F.col("n_linked")).alias("n_linked")))


def one_of_each_group(docs: DataFrame, k: int = 4, max_bits: int = 4, segments: int = 3, seed: int = 42) -> DataFrame:
    """docs without near-duplicates: of every group one row stays, that with the smallest doc_id, then fingerprint, then text hash.

    Rows with a null doc_id stay.  Rows with one doc_id and different texts belong to the groups of their texts; each
    group keeps a row.  Of rows that agree in doc_id and text one stays (any, if their other columns differ).
    """
    prints, named = grouped(docs, k, max_bits, segments, seed)
    rows = prints.filter("doc_id is not null").join(named.select("fp", "root"), "fp")
    first = rows.groupBy("root").agg(F.min(F.struct("doc_id", "fp", "text_hash")).alias("r")).select(F.col("r.doc_id").alias("__id"), F.col("r.text_hash").alias("__hash"))
    named_docs = docs.filter("doc_id is not null").withColumn("__own", text_hash())
    kept = named_docs.join(written(first, "kept"), (F.col("doc_id") == F.col("__id")) & (F.col("__own") == F.col("__hash")), "left_semi")
    return kept.dropDuplicates(["doc_id", "__own"]).select(docs.columns).unionByName(docs.filter("doc_id is null"))
