"""Removal of repeated byte strings, found with suffix arrays.

Every byte goes that a string of `length` bytes covers which also starts earlier (in a smaller doc_id, or earlier in the
same document).  All strings of that length, at every byte, take part:

1. Dealing.  A window (a string of `length` bytes) belongs to the smallest hash among its 24-byte grams, so equal windows
   belong together wherever they stand.  Neighbouring windows with the same smallest hash form a segment, one row of a
   few numbers; no text is shuffled yet.  Equal segments of one task are aggregated before the shuffle.
2. Segments with equal hash and equal text are copies: all but the earliest go whole.  What needs a closer look is where
   different segment texts share a hash (passages that begin or end there), or where a segment may repeat itself.  Only
   the earliest segment of each such text is looked at further.
3. Per-shard suffix arrays.  The texts of those segments meet by hash in shards of bounded size.  Each shard sorts its
   suffixes by Larsson-Sadakane refinement, takes common prefixes after Kasai, and keeps the earliest window of each run
   of suffixes that share `length` bytes.
4. Cross-shard merging.  A hash with more segments than a shard may hold is spread over several; these hand on their
   distinct windows as sorted runs, which are merged by binary search, part by part.

Defined cases: a null text is empty; a document shorter than `length` loses nothing; rows with a null doc_id neither
match nor lose anything; rows that share a doc_id each give a row, and of two windows at the same doc_id and start
neither is earlier, so both go if another is; every row gives a row; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorframe.llm.bpe import ragged
from anchorframe.llm.common import small_batches, written

GRAM = 24
#: Windows of a segment, at most (longer runs, as in periodic text, are cut); segments of a shard, about.
MAX_RUN = 256
SHARD_SEGMENTS = 8_192
#: Segments with one hash that stay together; more are spread over several shards.
HOT_SEGMENTS = 2_048
#: Bytes that a task hashes at once.
BLOCK = 1_500_000

# place: start << 31 | windows << 22 | may repeat itself << 21 | the low 21 bits of the text's crc32
_TAG = (1 << 21) - 1
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _M1
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base squared, ... modulo 2 to the 64."""
    out = np.ones(max(n, 1), np.uint64)
    done = 1
    while done < n:
        k = min(done, n - done)
        out[done : done + k] = out[:k] * np.uint64(pow(base, done, 1 << 64))
        done += k
    return out


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over every `width` neighbours."""
    span = 1
    while 2 * span <= width:
        x = pick(x[:-span], x[span:])
        span *= 2
    return x if span == width else pick(x[: -(width - span)], x[width - span :])


def segments_of(texts: list[bytes], doc_ids: np.ndarray, tags: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(hash, text's hash, doc_id, place) of every segment of these texts."""
    sizes = np.array([len(t) for t in texts], np.int64)
    if sizes.max(initial=0) < length:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    data = b"".join(texts) + bytes(8)
    total, width = len(data) - 8, length - GRAM + 1
    word = np.ndarray((total + 1,), "<u8", data, strides=(1,))
    grams = total - GRAM + 1
    x = _mixed((word[:grams] * _M2 + word[8 : grams + 8]) * _M3 + word[16 : grams + 16])
    least = _sliding(x, width, np.minimum)  # of the window that starts here

    # places where a gram is the least of a window, to tell segments in which it stands more than once
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    least_at = np.flatnonzero(_sliding(padded, width, np.maximum) == x)
    again = np.flatnonzero(x[least_at[1:]] == x[least_at[:-1]])
    first, second = least_at[again], least_at[again + 1]

    # cut where the least hash changes, a document begins, or its last windows have passed
    ends = np.cumsum(sizes)
    begins = ends - sizes
    cut = np.ones(len(least), bool)
    cut[1:] = least[1:] != least[:-1]
    cut[begins[begins < len(least)]] = True
    past = np.maximum(ends - length + 1, begins)
    cut[past[past < len(least)]] = True
    start = np.flatnonzero(cut)
    n = np.diff(np.append(start, len(least)))
    if n.max() > MAX_RUN:
        pieces = -(-n // MAX_RUN)
        inner = ragged(np.zeros(len(n), np.int64), pieces) * MAX_RUN
        start, n = np.repeat(start, pieces) + inner, np.minimum(np.repeat(n, pieces) - inner, MAX_RUN)
    doc = np.searchsorted(ends, start, side="right")
    good = start + length <= ends[doc]
    start, n, doc = start[good], n[good], doc[good]

    stop = start + n + length - 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(np.frombuffer(data, np.uint8, total).astype(np.uint64) * _powers(_BASE, total))])
    text = _mixed((sums[stop] - sums[start]) * _powers(_INVERSE, total)[start] + n.astype(np.uint64) * _M3)
    repeats = np.searchsorted(second, stop - GRAM, side="right") > np.searchsorted(first, start, side="left")
    place = (start - begins[doc]) << 31 | n << 22 | repeats.astype(np.int64) << 21 | tags[doc]
    return least[start].view(np.int64), text.view(np.int64), doc_ids[doc], place


def segments(docs: DataFrame, length: int) -> DataFrame:
    """(a, v, doc_id, place): hash, text's hash and place of every segment.

    A segment whose copy stands earlier in the same batch is known to go; it has no v, and a spread a.
    """
    schema = pa.schema([(c, pa.int64()) for c in ("a", "v", "doc_id", "place")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            parts, texts, first, held = [], [], 0, 0
            for i, text in enumerate(batch.column(1)):
                texts.append((text.as_py() or "").encode())
                held += len(texts[-1])
                if held >= BLOCK or i == len(batch) - 1:
                    tags = np.array([zlib.crc32(t) & _TAG for t in texts], np.int64)
                    parts.append(segments_of(texts, ids[first : i + 1], tags, length))
                    texts, first, held = [], i + 1, 0
            a, v, doc, place = (np.concatenate(c) for c in zip(*parts))
            order = np.lexsort((place, doc, v, a))
            a, v, doc, place = a[order], v[order], doc[order], place[order]
            late = _late(a, v, doc, place)[0]
            a = np.where(late, _mixed(doc.view(np.uint64)).view(np.int64), a)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(v, mask=late), pa.array(doc), pa.array(place)], schema=schema)

    usable = docs.filter("doc_id is not null and octet_length(text) >= " + str(length))
    return small_batches(usable).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "a long, v long, doc_id long, place long")


def _twins(same: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Of sorted rows, those at the doc_id and start of the first of their kind (same) but in another text than the row ahead."""
    out = same.copy()
    out[1:] &= place[1:] & _TAG != place[:-1] & _TAG
    return out


def _late(a: np.ndarray, v: np.ndarray, doc: np.ndarray, place: np.ndarray, before: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted segments: which have an equal text at a smaller (doc_id, start), and which are the first of their text.

    before: the first segment of the text that the row ahead of these belongs to.
    """
    head = np.ones(len(a), bool)
    head[1:] = (a[1:] != a[:-1]) | (v[1:] != v[:-1])
    if before is not None and len(a) and (a[0], v[0]) == before[:2]:
        head[0] = False
    at = np.maximum.accumulate(np.where(head, np.arange(len(a)), -1))
    head_doc, head_start = np.where(at < 0, before[2] if before else 0, doc[at]), np.where(at < 0, before[3] >> 31 if before else 0, place[at] >> 31)
    return ~head & ((doc != head_doc) | (place >> 31 != head_start)), head


def copies_and_heads(segs: DataFrame) -> DataFrame:
    """(a, doc_id, place): segments that go whole (a is null), and those to be looked at further."""
    schema = pa.schema([(c, pa.int64()) for c in ("a", "doc_id", "place")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple | None = None  # a, v, doc_id and place of the first segment of the current text
        texts, waiting = 0, None  # texts seen of the current hash; its first segment, while it is the only one
        for batch in batches:
            known = batch.column(1).is_null().to_numpy(zero_copy_only=False)
            a, v, doc, place = (batch.column(i).fill_null(0).to_numpy() for i in range(4))
            out_a, out_doc, out_place, goes = [], [doc[known]], [place[known]], [np.ones(known.sum(), bool)]
            a, v, doc, place = a[~known], v[~known], doc[~known], place[~known]
            if len(a):
                late, head = _late(a, v, doc, place, before)
                fresh = np.ones(len(a), bool)
                fresh[1:] = a[1:] != a[:-1]
                fresh[0] = before is None or a[0] != before[0]
                run_of = np.cumsum(fresh)  # 0: the hash of the batch before
                seen = np.bincount(run_of[head], minlength=run_of[-1] + 1)
                seen[0] += texts
                if seen[0] > 1 and waiting is not None:
                    out_doc.append(waiting[1:2])
                    out_place.append(waiting[2:3])
                    out_a.append(waiting[0:1])
                    goes.append(np.zeros(1, bool))
                    waiting = None
                self_repeat = place >> 21 & 1 == 1
                # rows that share a doc_id may hold one text at one place: each of them loses what goes there
                look = head & ((seen[run_of] > 1) | self_repeat) | _twins(~head & ~late, place)
                for chosen, flag in ((late, True), (look, False)):
                    out_doc.append(doc[chosen])
                    out_place.append(place[chosen])
                    goes.append(np.full(chosen.sum(), flag))
                    if not flag:
                        out_a.append(a[chosen])
                last = np.flatnonzero(head)
                if run_of[-1] > 0:
                    waiting = None
                texts = int(seen[run_of[-1]])
                if len(last):
                    i = last[-1]
                    before = (a[i], v[i], doc[i], place[i])
                    if texts == 1 and not self_repeat[i]:
                        waiting = np.array([a[i], doc[i], place[i]])
            goes = np.concatenate(goes)
            values = np.zeros(len(goes), np.int64)
            values[~goes] = np.concatenate(out_a) if out_a else 0
            yield pa.RecordBatch.from_arrays([pa.array(values, mask=goes), pa.array(np.concatenate(out_doc)), pa.array(np.concatenate(out_place))], schema=schema)

    return segs.repartition("a").sortWithinPartitions("a", "v", "doc_id", "place").mapInArrow(run, "a long, doc_id long, place long")


# --- suffix arrays ---


def suffix_array(data: bytes, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, group): the order of all suffixes by at least their first `depth` bytes.

    Larsson-Sadakane: groups of suffixes that share their first h bytes are refined by the group of the suffix h bytes on,
    which doubles h; suffixes that stand alone are not touched again.  group: the first slot of each suffix's group
    before the last refinement, so suffixes that differ in it share less than half of the last h.
    """
    n = len(data)
    word = np.ndarray((n,), ">u8", data + bytes(8), strides=(1,)).astype(np.uint64)
    order = np.argsort(word, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = word[order[1:]] != word[order[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    h, group = 8, rank
    while h < depth:
        size = np.bincount(rank, minlength=n)
        slots = np.flatnonzero(size[rank[order]] > 1)
        group = rank.copy()
        if not len(slots):
            break
        open_ = order[slots]
        after = np.where(open_ + h < n, rank[np.minimum(open_ + h, n - 1)] + 1, 0)
        by = np.argsort(rank[open_] * (n + 1) + after, kind="stable")
        open_, after = open_[by], after[by]
        own = rank[open_]
        order[slots] = open_
        fresh = np.ones(len(slots), bool)
        fresh[1:] = (own[1:] != own[:-1]) | (after[1:] != after[:-1])
        rank[open_] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(slots)), 0))]
        h *= 2
    return order, group


def common_prefixes(data: bytes, order: np.ndarray, group: np.ndarray, most: int) -> np.ndarray:
    """For each slot the bytes that its suffix shares with the one before, at most `most` (Kasai).

    Walks the text: dropping its first byte shortens a suffix's common prefix by one at most, if the suffix before also
    stays before it without its first byte.  Suffixes alike in all the bytes that `order` looks at may change places
    there; they are compared from the start.  Suffixes whose group already differs from that of the one before share too
    little to matter, and count as zero.
    """
    n = len(order)
    out = np.zeros(n, np.int64)
    close = np.flatnonzero(group[order[1:]] == group[order[:-1]]) + 1
    before = np.full(n, -1, np.int64)
    before[order[close]] = order[close - 1]
    slot = np.empty(n, np.int64)
    slot[order] = np.arange(n)
    at = np.flatnonzero(before >= 0)
    shared = np.zeros(len(at), np.int64)
    goes_on = np.zeros(len(at), bool)
    goes_on[1:] = (at[1:] == at[:-1] + 1) & (slot[np.minimum(before[at[:-1]] + 1, n - 1)] < slot[at[1:]])
    h, limit = 0, len(data)
    for k, (i, j, on) in enumerate(zip(at.tolist(), before[at].tolist(), goes_on.tolist())):
        h = h - 1 if on and h else 0
        if not h and data[i : i + most] == data[j : j + most]:
            h = min(most, limit - max(i, j))
        else:
            end = min(most, limit - i, limit - j)
            while h < end and data[i + h] == data[j + h]:
                h += 1
        shared[k] = h
    out[slot[at]] = shared
    return out


def _later_windows(group: pa.Table, length: int) -> tuple[dict, dict]:
    """Of one shard's segments: windows that stand earlier in the shard, and the first of each distinct window."""
    texts = group["text"].to_pylist()
    n = np.array([len(t) - length + 1 for t in texts], np.int64)
    sizes = n + length - 1
    begins = np.cumsum(sizes) - sizes
    data = b"".join(texts)
    order, rough = suffix_array(data, length)
    shared = common_prefixes(data, order, rough, length)
    owner = np.repeat(np.arange(len(texts)), sizes)
    offset = np.arange(len(data)) - begins[owner]
    # suffixes that reach over the end of their segment are no windows; runs are closed before they are left out
    run_of = np.cumsum(shared < length)
    window = offset[order] < n[owner[order]]
    at, run_of = order[window], run_of[window]
    doc, place = group["doc_id"].to_numpy()[owner[at]], group["place"].to_numpy()[owner[at]]
    start = (place >> 31) + offset[at]
    by = np.lexsort((place & _TAG, start, doc, run_of))
    at, run_of, doc, place, start = at[by], run_of[by], doc[by], place[by], start[by]
    head = np.ones(len(at), bool)
    head[1:] = run_of[1:] != run_of[:-1]
    first = np.maximum.accumulate(np.where(head, np.arange(len(at)), 0)) if len(at) else np.empty(0, np.int64)
    late = (doc != doc[first]) | (start != start[first])
    split = group["parts"].to_numpy()[owner[at]] > 1
    out = {"doc": doc, "start": start, "tag": place & _TAG}
    hand = (head | _twins(~head & ~late, place)) & split
    total = len(data)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(np.frombuffer(data, np.uint8).astype(np.uint64) * _powers(_BASE, total))])
    value = (sums[at[hand] + length] - sums[at[hand]]) * _powers(_INVERSE, total)[at[hand]]
    word = np.ndarray((total,), "<u8", data + bytes(8), strides=(1,))
    other = np.zeros(int(hand.sum()), np.uint64)
    for i in [*range(0, length - 7, 8), length - 8]:
        other = _mixed(other * _M3 + word[at[hand] + i])
    handed = {c: x[hand] for c, x in out.items()} | {"a": group["a"].to_numpy()[owner[at]][hand], "parts": group["parts"].to_numpy()[owner[at]][hand],
                                                   "f1": _mixed(value).view(np.int64), "f2": _mixed(other).view(np.int64)}
    return {c: x[late] for c, x in out.items()}, handed


def _runs(doc: np.ndarray, start: np.ndarray, tag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(doc_id, place) of runs of neighbouring windows."""
    order = np.lexsort((start, tag, doc))
    doc, start, tag = doc[order], start[order], tag[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (start[1:] > start[:-1] + 1)
    index = np.flatnonzero(fresh)
    n = start[np.append(index[1:], len(doc)) - 1] - start[index] + 1 if len(doc) else np.empty(0, np.int64)
    pieces = -(-n // MAX_RUN)
    inner = ragged(np.zeros(len(n), np.int64), pieces) * MAX_RUN
    at = np.repeat(index, pieces)
    return doc[at], (start[at] + inner) << 31 | np.minimum(np.repeat(n, pieces) - inner, MAX_RUN) << 22 | tag[at]


_SHARD_OUT = ("m", "run", "a", "f1", "f2", "doc_id", "place")


def shard_results(snippets: DataFrame, shards: int, length: int) -> DataFrame:
    """Per shard: runs of windows to remove (run is null), and the sorted distinct windows of hashes that were spread."""
    schema = pa.schema([(c, pa.int64()) for c in _SHARD_OUT])

    def run(group: pa.Table) -> pa.Table:
        late, handed = _later_windows(group, length)
        doc, place = _runs(late["doc"], late["start"], late["tag"])
        shard = int(group["shard"][0].as_py())
        k, order = len(doc), np.lexsort((handed["f2"], handed["f1"], handed["a"]))
        handed = {c: x[order] for c, x in handed.items()}
        zeros = np.zeros(k, np.int64)
        spread = _mixed((handed["a"] + np.mod(handed["f1"], handed["parts"])).view(np.uint64)).view(np.int64)
        table = {
            "m": np.concatenate([np.mod(doc, shards), spread]), "a": np.concatenate([zeros, handed["a"]]),
            "f1": np.concatenate([zeros, handed["f1"]]), "f2": np.concatenate([zeros, handed["f2"]]), "doc_id": np.concatenate([doc, handed["doc"]]),
            "place": np.concatenate([place, handed["start"] << 31 | np.int64(1 << 22) | handed["tag"]]),
        }
        runs = pa.array(np.full(k + len(order), shard), mask=np.arange(k + len(order)) < k)
        return pa.table([runs if c == "run" else pa.array(table[c]) for c in _SHARD_OUT], schema=schema)

    return snippets.groupBy("shard").applyInArrow(run, ", ".join(f"{c} long" for c in _SHARD_OUT))


def merged(results: DataFrame) -> DataFrame:
    """(doc_id, place): all runs of windows to remove, after the sorted runs of different shards have met.

    Each run is looked up in what has been merged so far by binary search; all but the earliest of equal windows go.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("place", pa.int64())])
    key = np.dtype([("a", "<i8"), ("f1", "<i8"), ("f2", "<i8")])

    def run(group: pa.Table) -> pa.Table:
        runs = group["run"]
        done = group.filter(runs.is_null())
        docs, places = [done["doc_id"].to_numpy()], [done["place"].to_numpy()]
        rest = group.filter(runs.is_valid())
        if len(rest):
            keys = np.rec.fromarrays([rest[c].to_numpy() for c in ("a", "f1", "f2")], dtype=key)
            doc, place, of = rest["doc_id"].to_numpy(), rest["place"].to_numpy(), rest["run"].to_numpy()
            have, have_doc, have_place = np.empty(0, key), np.empty(0, np.int64), np.empty(0, np.int64)
            for r in np.unique(of):
                mine = np.flatnonzero(of == r)
                mine = mine[np.argsort(keys[mine], kind="stable")]
                mine = mine[np.append(True, keys[mine[1:]] != keys[mine[:-1]])]
                k, d, p = keys[mine], doc[mine], place[mine]
                at = np.searchsorted(have, k)
                same = np.zeros(len(k), bool)
                inside = at < len(have)
                same[inside] = have[at[inside]] == k[inside]
                i, j = np.flatnonzero(same), at[same]
                won = (d[i] < have_doc[j]) | (d[i] == have_doc[j]) & (p[i] >> 31 < have_place[j] >> 31)
                have_doc[j[won]], have_place[j[won]] = d[i][won], p[i][won]
                new = ~same
                have, have_doc, have_place = np.insert(have, at[new], k[new]), np.insert(have_doc, at[new], d[new]), np.insert(have_place, at[new], p[new])
            first = np.searchsorted(have, keys)
            goes = (doc != have_doc[first]) | (place >> 31 != have_place[first] >> 31)
            docs.append(doc[goes])
            places.append(place[goes])
        return pa.table([pa.array(np.concatenate(docs)), pa.array(np.concatenate(places))], schema=schema)

    return results.groupBy("m").applyInArrow(run, "doc_id long, place long")


def snippets(texts: DataFrame, heads: DataFrame, shards: int, length: int) -> DataFrame:
    """(shard, a, parts, doc_id, place, text) of the segments in heads, cut from texts (doc_id, tag, text)."""
    # few rows: no more than all segments by HOT_SEGMENTS; as a table of known size Spark need not deal heads by their hash
    counts = written(heads.groupBy("a").agg(F.count("*").alias("n")).filter(F.col("n") > HOT_SEGMENTS), "hot")
    parts = F.coalesce(F.ceil(F.col("n") / HOT_SEGMENTS), F.lit(1)).cast("long")
    sub = F.pmod(F.xxhash64("doc_id", "place"), F.col("parts"))
    placed = heads.join(counts, "a", "left").select("a", "doc_id", "place", parts.alias("parts")).withColumn("shard", F.pmod(F.xxhash64("a", sub), F.lit(shards).cast("long")))
    tag = F.col("place").bitwiseAND(F.lit(_TAG).cast("long")).alias("tag")
    by_doc = placed.groupBy("doc_id", tag).agg(F.collect_list(F.struct("shard", "a", "parts", "place")).alias("heads"))
    schema = pa.schema([("shard", pa.int64()), ("a", pa.int64()), ("parts", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int64()), ("text", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                data = text.as_py().encode()
                for h in found:
                    start = h["place"] >> 31
                    out.append(h | {"doc_id": doc_id, "text": data[start : start + (h["place"] >> 22 & 511) + length - 1]})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return texts.join(by_doc, ["doc_id", "tag"]).select("doc_id", "text", "heads").mapInArrow(run, "shard long, a long, parts long, doc_id long, place long, text binary")


def without_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) for every row of docs; kept: the remaining bytes."""
    if length < GRAM + 8 or length > 255:
        raise ValueError(f"length must lie between {GRAM + 8} and 255")
    found = written(copies_and_heads(segments(docs, length)), "segments")
    heads = found.filter("a is not null")
    shards = max(1, ceil(heads.count() / SHARD_SEGMENTS))
    tag = F.crc32(F.col("text").cast("binary")).bitwiseAND(F.lit(_TAG).cast("long"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).select("doc_id", tag.alias("tag"), "text")
    late = merged(shard_results(snippets(texts, heads, shards, length), shards, length))
    goes = found.filter("a is null").select("doc_id", "place").unionByName(late)
    by_doc = goes.groupBy("doc_id", F.col("place").bitwiseAND(F.lit(_TAG).cast("long")).alias("tag")).agg(F.collect_list("place").alias("places"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, places in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                data = text.as_py().encode()
                row = {"doc_id": doc_id, "n_bytes": len(data), "n_removed": 0, "n_spans": 0, "kept": data}
                if places.is_valid:
                    p = places.values.to_numpy()
                    a, b = p >> 31, (p >> 31) + (p >> 22 & 511) + length - 1
                    order = np.argsort(a, kind="stable")
                    a, b = a[order], np.maximum.accumulate(b[order])
                    fresh = np.ones(len(a), bool)
                    fresh[1:] = a[1:] > b[:-1]
                    begin, end = a[fresh], b[np.append(np.flatnonzero(fresh)[1:], len(a)) - 1]
                    kept = b"".join(data[x:y] for x, y in zip([0, *end.tolist()], [*begin.tolist(), len(data)]))
                    row |= {"n_removed": len(data) - len(kept), "n_spans": len(begin), "kept": kept}
                out.append(row)
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return texts.join(by_doc, ["doc_id", "tag"], "left").select("doc_id", "text", "places").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
