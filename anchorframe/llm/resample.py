"""Importance resampling of documents towards a target distribution of hashed word n-grams.

The texts of an Arrow batch are joined with a byte that no UTF-8 text holds.  One regex pass over the joined bytes finds
all words and separators; searching the separators' places gives every word's document, runs of words that reach over a
separator are masked, and bincount adds up what is left: buckets for the whole corpus, or gains for each document.  A
batch is bounded in bytes, and the pass goes block by block, so a very long text needs no more memory.

The corpus is read twice: once for the bucket counts (each task sends one number a bucket), once for the documents'
weights under the gains (one number a bucket, broadcast).  Seeded Gumbel noise makes the highest scores a draw without
replacement.  Ranks come from range partitions, numbered on their own and moved by the rows before them.

Defined cases: null and empty texts have no features, weight 0 and a score, and are never drawn; a null doc_id has no
noise, so no score and no rank; rows with the same doc_id and score are ordered by their words and weight; further
columns are ignored; no documents give no rows; without target texts all target counts are 0.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anchorframe.llm.common import small_batches, written

SEPARATOR = b"\xff"
#: Words are what stands between ASCII characters that are no letters or digits; bytes of other characters are word bytes.
TOKEN = re.compile(rb"[0-9a-z\x80-\xfe]+|\xff")
BLOCK = 1 << 20
#: Words whose bucket a task remembers.
WORDS = 200_000
RANGE_ROWS = 1_000_000


class Buckets(dict):
    """Bucket of a word, -1 of a separator; a bounded memory."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, word: bytes) -> int:
        bucket = -1 if word == SEPARATOR else zlib.crc32(word) % self.buckets
        if len(self) >= WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = bucket
        return bucket


def blocks(joined: bytes) -> Iterator[bytes]:
    """The joined bytes in pieces that end between words."""
    at = 0
    while at < len(joined):
        end = at + BLOCK
        if end < len(joined):
            gap = re.compile(rb"[^0-9a-z\x80-\xfe]").search(joined, end)
            end = gap.start() if gap else len(joined)
        yield joined[at:end]
        at = end


def features(texts: list[bytes], n: int, memory: Buckets) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each block: the buckets and documents of its runs of 1 to n words, and the documents of its words."""
    carried: list[bytes] = []  # the words before the block that longer runs begin with
    document = 0
    for block in blocks(SEPARATOR.join(texts).lower()):
        tokens = [*carried, *TOKEN.findall(block)]
        code = np.fromiter(map(memory.__getitem__, tokens), np.int64, len(tokens))
        cuts = np.flatnonzero(code < 0)
        place = np.searchsorted(cuts, np.arange(len(tokens)), side="right") + document - int((code[: len(carried)] < 0).sum())
        fresh = np.arange(len(tokens)) >= len(carried)  # what ends among the carried words has been given before
        word = code >= 0
        found = [(code[word & fresh], place[word & fresh])]
        crc = None
        for size in range(2, n + 1):
            if crc is None:
                crc = [zlib.crc32(t) for t in tokens]
            crc = [zlib.crc32(b" " + t, c) for c, t in zip(crc, tokens[size - 1 :])]
            if not crc:
                break
            last = np.arange(size - 1, len(tokens))
            # no separator inside: both ends are words of one document
            whole = word[last] & word[last - size + 1] & (place[last] == place[last - size + 1]) & fresh[last]
            found.append((np.array(crc, np.int64)[whole] % memory.buckets, place[last][whole]))
        yield np.concatenate([c for c, _ in found]), np.concatenate([d for _, d in found]), place[word & fresh]
        if len(tokens):
            document = int(place[-1])
        carried = tokens[len(tokens) - min(n - 1, len(tokens)) :]


def _texts(df: DataFrame, *columns: str) -> DataFrame:
    return small_batches(df).select(F.col("text").cast("string"), *columns)


def _bytes(column: pa.Array) -> list[bytes]:
    return [(t or "").encode() for t in column.to_pylist()]


def bucket_counts(df: DataFrame, n: int, buckets: int) -> DataFrame:
    """(bucket, n): how many features fall in each bucket, over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, counts = Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for codes, _, _ in features(_bytes(batch.column(0)), n, memory):
                counts += np.bincount(codes, minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(counts[held], pa.int64())], ["bucket", "n"])

    return _texts(df).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = 10_000, scale: float = 1000.0) -> DataFrame:
    """(bucket, gain) of every bucket: floor(scale * ln of how much likelier it is in the target), add-one smoothed."""
    both = bucket_counts(docs, n, buckets).withColumn("side", F.lit("s")).unionByName(bucket_counts(target, n, buckets).withColumn("side", F.lit("t")))
    each = docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket").join(both.groupBy("bucket").pivot("side", ["s", "t"]).agg(F.sum("n")), "bucket", "left").fillna(0, ["s", "t"])
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    # bucket counts have a row a bucket, so their totals are cheap
    total = each.agg(F.sum("s").cast("double").alias("all_s"), F.sum("t").cast("double").alias("all_t"))
    ratio = (t + 1) * (F.col("all_s") + buckets) / ((s + 1) * (F.col("all_t") + buckets))
    return each.join(F.broadcast(total)).select("bucket", F.floor(F.lit(scale) * F.log(ratio)).alias("gain"))


def weighed(docs: DataFrame, gain: np.ndarray, n: int = 1) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the sum of the gains over each document's features."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        memory, of = Buckets(len(table)), table.astype(np.float64)
        for batch in batches:
            size = batch.num_rows
            words, count, weight = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
            for codes, place, own in features(_bytes(batch.column(0)), n, memory):
                words += np.bincount(own, minlength=size)
                count += np.bincount(place, minlength=size)
                weight += np.bincount(place, weights=of[codes], minlength=size).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(1), *(pa.array(c, pa.int64()) for c in (words, count, weight))], ["doc_id", "n_words", "n_features", "weight"])

    return _texts(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id, seed: int, scale: float = 1000.0):
    """floor(scale * noise), the noise from the first 32 bits of sha256("seed:doc_id")."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-scale) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def ranked(scored: DataFrame, partitions: int) -> DataFrame:
    """scored (all with a score) with `rank` from 1 by falling score, ties to the smaller doc_id.

    No row number runs over the whole table: rows are dealt by ranges of that order and written with their range's
    number, each range is numbered on its own, and the sizes of the ranges before it (one number a range) are added.
    """
    order = [F.desc("score"), F.asc("doc_id"), F.asc("n_words"), F.asc("weight")]
    dealt = written(scored.repartitionByRange(partitions, *order).withColumn("piece", F.spark_partition_id()), "ranges")
    sizes = {r["piece"]: r["count"] for r in dealt.groupBy("piece").count().collect()}
    before, starts = 0, []
    for piece in sorted(sizes):
        starts.append((piece, before))
        before += sizes[piece]
    offsets = scored.sparkSession.createDataFrame(starts, "piece int, ahead long")
    own = F.row_number().over(Window.partitionBy("piece").orderBy(*order))
    return dealt.join(F.broadcast(offsets), "piece").withColumn("rank", F.col("ahead") + own).drop("piece", "ahead")


def resampled(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = 10_000, percent: int = 10, min_words: int = 20, seed: int = 2024, scale: float = 1000.0) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for every row of docs; rank is null where a document is not drawn.

    Of the N documents with at least min_words words, floor(percent * N / 100) with the highest scores are drawn.
    """
    gain = np.zeros(buckets, np.int64)
    for row in gains(docs, target, n, buckets, scale).collect():  # one number a bucket
        gain[row["bucket"]] = row["gain"]
    scored = written(weighed(docs, gain, n).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed, scale)), "weights")
    long = F.col("score").isNotNull() & (F.col("n_words") >= min_words)
    many = scored.filter(long).count()
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-many // RANGE_ROWS))
    drawn = ranked(scored.filter(long), ranges).withColumn("rank", F.when(F.col("rank") <= percent * many // 100, F.col("rank")))
    rest = scored.filter(~long).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).select("doc_id", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))


#: crc32 byte by byte: a table of 256 remainders, made here from the polynomial.
SQL = r"""
WITH RECURSIVE steps(b, c, i) AS (SELECT range::BIGINT, range::BIGINT, 0 FROM range(256)
  UNION ALL SELECT b, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i + 1 FROM steps WHERE i < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE i = 8),
given AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
texts AS (SELECT 's' AS side, r, text FROM given UNION ALL SELECT 't', 0, text FROM benchmark),
words AS (SELECT side, r, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM texts),
bytes AS (SELECT w, hex(encode(w)) AS x FROM (SELECT DISTINCT w FROM words)),
hashed AS (SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(x) // 2 + 1), lambda i: ('0x' || x[2*i-1:2*i])::BIGINT)),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM bytes, crc),
coded AS (SELECT side, r, bucket FROM words JOIN hashed USING (w)),
counts AS (SELECT bucket, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t FROM coded GROUP BY bucket),
totals AS (SELECT sum(s)::DOUBLE AS all_s, sum(t)::DOUBLE AS all_t FROM counts),
gain AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (all_s + 10000) / ((s + 1)::DOUBLE * (all_t + 10000))))::BIGINT AS g FROM counts, totals),
weights AS (SELECT r, count(*) AS n, sum(g)::BIGINT AS weight FROM coded JOIN gain USING (bucket) WHERE side = 's' GROUP BY r),
docs AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM given LEFT JOIN weights USING (r)),
ordered AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS k, count(*) OVER () AS many FROM docs WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN k <= 10 * many // 100 THEN k END AS rank FROM ordered
UNION ALL SELECT doc_id, n_features, weight, score, NULL FROM docs WHERE n_features < 20
"""
