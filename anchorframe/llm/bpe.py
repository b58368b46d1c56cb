"""Byte-level BPE encoding and decoding through a table of distinct words.

Words (the tokenizer's own pre-token split) are cut in Spark tasks, chunk by chunk.  A chunk keeps its texts as numbers
of its distinct words and sends each distinct word once, packed by a hash of the word.  The tasks that own the hashes
encode every distinct word of the whole table once and send the ids back, by position, to the chunks that asked; there
they are joined with the word numbers to the ids of every document.  Decoding joins the ids with the vocabulary's
id-to-piece table, whose size the vocabulary bounds, and reads the joined bytes as UTF-8.

Only distinct words travel, so what is shuffled is far smaller than one row per word would be.  A chunk is bounded by
`chunk_chars` (a longer single text is a chunk of its own); the owners' tables shrink as `buckets` grows.  Both branches
split the same table, so docs must be read from a table or be otherwise the same when read twice; chunks carry a check
value and a mismatch is an error.

Defined cases: null and empty texts have no ids; a special token's literal text is that token, as the library has it;
rows with the same or a null doc_id each give a row; further columns are ignored.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorframe.llm.common import small_batches
from anchorframe.llm.pretokens import as_class, once, unknown_letters, word_splitter

CHUNK_CHARS = 3_000_000
#: Decoded characters of a result batch, about; results leave Python in such pieces.
OUT_CHARS = 500_000
ROWS = "chunk string, bucket int, check long, doc_ids binary, counts binary, codes binary, owners binary, words binary"
OUT = "doc_id long, n_tokens long, ids binary, decoded string"


def special_tokens(tokenizer_json: str) -> list[str]:
    """Literal texts that are tokens of their own; refuses tokenizers that this split does not describe."""
    spec = json.loads(tokenizer_json)
    pre = spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        raise ValueError("only a byte-level tokenizer without normalizer and prefix space is supported")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        raise ValueError("added tokens that strip or match single words are not supported")
    return [t["content"] for t in spec["added_tokens"]]


@lru_cache(1)
def newer_letters(tokenizer_json: str) -> str:
    """A character class of what the regex library calls a letter or number and the tokenizer does not.

    Their Unicode tables differ in age only, so characters that Python's own, older table knows need no test.
    """
    from tokenizers import Tokenizer

    cut = Tokenizer.from_str(tokenizer_json).pre_tokenizer.pre_tokenize_str
    return as_class([c for c in unknown_letters() if len(cut(f"a{c}a")) > 1 and len(cut(f"1{c}1")) > 1])  # continues neither letters nor numbers


def splitter(special: list[str], newer: str = "") -> Callable[[str], list[str]]:
    """A function from a text to its words.  newer: characters that count as neither letter, number nor space."""
    words = word_splitter(newer)
    if not special:
        return words
    literal = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) + ")")

    def split(text: str) -> list[str]:
        if not any(s in text for s in special):
            return words(text)
        return [w for i, part in enumerate(literal.split(text)) for w in ([part] if i % 2 else words(part))]

    return split


class Codec:
    """Numbers and words as compressed bytes; one compressor serves all of a task's rows."""

    def __init__(self):
        self.zip, self.unzip = zstandard.ZstdCompressor(level=3).compress, zstandard.ZstdDecompressor().decompress

    def pack(self, values: np.ndarray) -> bytes:
        """Unsigned numbers as byte planes."""
        planes = np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(-1, 4).T
        return self.zip(planes.tobytes())

    def unpack(self, data: bytes) -> np.ndarray:
        planes = np.frombuffer(self.unzip(data), np.uint8).reshape(4, -1)
        return np.ascontiguousarray(planes.T).view("<u4").ravel()

    def pack_words(self, words: list[bytes]) -> bytes:
        lengths = np.fromiter(map(len, words), "<u4", len(words))
        return self.zip(len(words).to_bytes(4, "little") + lengths.tobytes() + b"".join(words))

    def unpack_words(self, data: bytes) -> list[bytes]:
        raw = self.unzip(data)
        n = int.from_bytes(raw[:4], "little")
        ends = (4 + 4 * n + np.cumsum(np.frombuffer(raw, "<u4", n, 4), dtype=np.int64)).tolist()
        return [raw[a:b] for a, b in zip([4 + 4 * n, *ends], ends)]


class Numbers(dict):
    """Words, numbered as they come."""

    def __missing__(self, word) -> int:
        self[word] = n = len(self)
        return n


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[i], starts[i]+1, ... for each i, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)


def split_chunks(docs: DataFrame, special: list[str], newer: str, buckets: int, chunk_chars: int, texts: bool) -> DataFrame:
    """Rows of ROWS: with texts one a chunk (documents as word numbers), else one a chunk and bucket (distinct words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, codec, partition, seq = splitter(special, newer), Codec(), TaskContext.get().partitionId(), 0
        numbers = Numbers()
        codes: list[np.ndarray] = []
        ids: list[int | None] = []
        chars = 0

        def rows() -> pa.RecordBatch:
            words = [w.encode() for w in numbers]
            owner = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
            check = zlib.crc32(b"\0".join(words))
            base = {"chunk": f"{partition}-{seq}", "bucket": -1, "check": check, "doc_ids": None, "counts": None, "codes": None, "owners": None, "words": None}
            if texts:
                known = np.array([i is not None for i in ids], np.uint8)
                values = np.array([i or 0 for i in ids], "<i8")
                counts = np.fromiter(map(len, codes), np.int64, len(codes))
                out = [base | {"doc_ids": known.tobytes() + values.tobytes(), "counts": codec.pack(counts), "owners": codec.pack(owner),
                               "codes": codec.pack(np.concatenate(codes) if codes else np.empty(0))}]
            else:
                order = np.argsort(owner, kind="stable")
                cut = np.searchsorted(owner[order], np.arange(buckets + 1))
                out = [base | {"bucket": b, "words": codec.pack_words([words[i] for i in order[cut[b] : cut[b + 1]]])} for b in range(buckets) if cut[b] < cut[b + 1]]
            return pa.RecordBatch.from_pylist(out, schema=SCHEMA)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                if chars and chars + len(text) > chunk_chars:
                    yield rows()
                    numbers, codes, ids, chars, seq = Numbers(), [], [], 0, seq + 1
                words = split(text)
                codes.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
                ids.append(doc_id)
                chars += len(text)
        if ids:
            yield rows()

    return small_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ROWS)


SCHEMA = pa.schema([("chunk", pa.string()), ("bucket", pa.int32()), ("check", pa.int64()), ("doc_ids", pa.binary()),
                    ("counts", pa.binary()), ("codes", pa.binary()), ("owners", pa.binary()), ("words", pa.binary())])


def _library(shared: dict):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the threads here
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(shared["json"])
    library.no_truncation()
    library.no_padding()
    return library


def encode_words(words: DataFrame, tokenizer) -> DataFrame:
    """Words of every chunk and bucket to ids; each distinct word is encoded once.  tokenizer: a broadcast {"json": text}."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, codec = once(tokenizer.value, _library), Codec()
        known, ids, ends = Numbers(), array("I"), array("Q", [0])  # the ids of word n stand from ends[n] to ends[n + 1]
        for batch in batches:
            for row in batch.to_pylist():
                asked = codec.unpack_words(row["words"])
                before = len(known)
                number = np.fromiter(map(known.__getitem__, asked), np.int64, len(asked))
                new = [w.decode() for w, n in zip(asked, number.tolist()) if n >= before]  # a chunk's words are distinct
                for i in range(0, len(new), 4096):
                    for e in library.encode_batch_fast(new[i : i + 4096], add_special_tokens=False):
                        ids.extend(e.ids)
                        ends.append(len(ids))
                edge = np.frombuffer(ends, np.uint64).astype(np.int64)
                length = edge[number + 1] - edge[number]
                flat = np.frombuffer(ids, np.uint32)[ragged(edge[number], length)] if len(ids) else np.empty(0)
                found = row | {"counts": codec.pack(length), "codes": codec.pack(flat), "words": None}
                del edge  # an array that is looked at cannot grow
                yield pa.RecordBatch.from_pylist([found], schema=SCHEMA)

    return words.mapInArrow(run, ROWS)


def pieces(tokenizer_json: str) -> tuple[bytes, np.ndarray]:
    """The id-to-piece table: all pieces' bytes, and where each id's begin and end."""
    spec = json.loads(tokenizer_json)
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    shown = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    table = {i: piece for piece, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    held = [bytes(shown[c] for c in p) if all(c in shown for c in p) else p.encode() for p in (table.get(i, "") for i in range(max(table) + 1))]
    return b"".join(held), np.concatenate([[0], np.cumsum([len(p) for p in held])]).astype(np.int64)


def assemble(parts: DataFrame, table) -> DataFrame:
    """Ids joined back by position, and decoded.  parts: a chunk's row with texts and its rows with ids; table: broadcast pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, codec = [r for batch in batches for r in batch.to_pylist()], Codec()
        chunk = next((r for r in rows if r["bucket"] < 0), None)
        asked = sorted((r for r in rows if r["bucket"] >= 0), key=lambda r: r["bucket"])
        if chunk is None or any(r["check"] != chunk["check"] for r in asked):
            raise ValueError("docs changed between two reads; write them to a table first")
        n = len(chunk["doc_ids"]) // 9
        known, doc_ids = np.frombuffer(chunk["doc_ids"], bool, n), np.frombuffer(chunk["doc_ids"], "<i8", n, n)
        codes, per_doc = codec.unpack(chunk["codes"]), codec.unpack(chunk["counts"]).astype(np.int64)
        order = np.argsort(codec.unpack(chunk["owners"]), kind="stable")
        length = np.empty(len(order), np.int64)
        length[order] = np.concatenate([codec.unpack(r["counts"]) for r in asked] or [np.empty(0)])
        first = np.empty(len(order), np.int64)
        first[order] = np.cumsum(length[order]) - length[order]
        ids = np.concatenate([codec.unpack(r["codes"]) for r in asked] or [np.empty(0, np.uint32)])
        del rows, asked, chunk
        blob, edges = table.value
        blob = np.frombuffer(blob, np.uint8)
        schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])
        out: dict[str, list] = {c: [] for c in schema.names}
        at, chars = 0, 0
        for i, k in enumerate(per_doc.tolist()):
            words = codes[at : at + k]
            at += k
            own = ids[ragged(first[words], length[words])]
            out["doc_id"].append(int(doc_ids[i]) if known[i] else None)
            out["n_tokens"].append(len(own))
            out["ids"].append(own.astype("<u4").tobytes())
            out["decoded"].append(blob[ragged(edges[own], edges[own + 1] - edges[own])].tobytes().decode("utf-8", "replace"))
            chars += len(out["decoded"][-1])
            if chars >= OUT_CHARS:
                yield pa.RecordBatch.from_pydict(out, schema=schema)
                out, chars = {c: [] for c in schema.names}, 0
        if out["doc_id"]:
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return parts.groupBy("chunk").applyInArrow(run, OUT)


def encode_decode(docs: DataFrame, path: str, buckets: int | None = None, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) for every row of docs; ids are little-endian unsigned 32-bit integers.

    path: the tokenizer's JSON file, read on the driver and broadcast (a vocabulary bounds its size).
    buckets: tasks among which the distinct words are dealt; by default as many as docs has partitions.
    """
    text = Path(path).read_text(encoding="utf-8")
    special, sc = special_tokens(text), docs.sparkSession.sparkContext
    buckets = buckets or max(docs.rdd.getNumPartitions(), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    words = split_chunks(docs, special, newer_letters(text), buckets, chunk_chars, texts=False).repartitionById(buckets, "bucket")
    ids = encode_words(words, sc.broadcast({"json": text}))
    chunks = split_chunks(docs, special, newer_letters(text), buckets, chunk_chars, texts=True)
    return assemble(chunks.unionByName(ids), sc.broadcast(pieces(text)))
