"""Byte-level BPE encoding and decoding by dynamic programming over prefixes.

Every prefix of a word has one encoding, hence one last token.  A token can be the last one of a prefix if it ends there
and, next to the last token of the prefix before it, neither of the two would be merged otherwise: the two together
encode to exactly themselves.  Merges act on neighbours only, so a row of tokens is an encoding when each neighbouring
pair is one, and exactly one candidate passes.  An automaton over the vocabulary names the tokens that end at each byte,
and the last token of each prefix is stored.  From the stored table every prefix can be encoded, an append goes on where
the table ends, and an edit is worked out only until the table repeats itself for as long as the longest token reaches.

Words are the pre-token matches of the vocabulary's pattern, each encoded on its own; a match that is itself a token is
that token.  Each worker reads the vocabulary once and remembers words that it met (a bounded memory, a cache only).
Very long texts are split block by block, and a single word's time is linear in its bytes.

Defined cases: null and empty texts have no ids; special tokens are ordinary text; rows with the same or a null doc_id
each give a row; further columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorframe.llm.common import small_batches
from anchorframe.llm.pretokens import AHEAD, PATTERN, as_class, once, unknown_letters, word_blocks, word_splitter

OUT = "doc_id long, n_tokens long, ids binary, decoded binary"
TABLE = "doc_id long, text string, starts binary, last binary"
#: Words and pairs that a worker remembers (of words, up to twice as many), and the longest of them.
WORDS, PAIRS, WORD_CHARS = 150_000, 400_000, 64
OUT_BYTES = 1 << 20
NEVER = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, Path(path).read_bytes().splitlines())}


def merged(ranks: dict[bytes, int], data: bytes, cut: int = 0) -> list[int]:
    """The plain definition: as long as neighbours make a token, the pair of the smallest rank merges, the first of equals.

    With a cut it ends, with nothing, where a merge joins the bytes before and after it.
    """
    parts = [data[i : i + 1] for i in range(len(data))]
    near = [ranks.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
    while near and (least := min(near)) < NEVER:
        i = near.index(least)
        if cut:
            if i == cut - 1:
                return []
            cut -= i < cut
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del near[i]
        if i < len(near):
            near[i] = ranks.get(parts[i] + parts[i + 1], NEVER)
        if i:
            near[i - 1] = ranks.get(parts[i - 1] + parts[i], NEVER)
    return [ranks[p] for p in parts]


def never_made(ranks: dict[bytes, int]) -> set[int]:
    """Tokens that merging never makes; only a match that is such a token as a whole gives it."""
    return {rank for token, rank in ranks.items() if merged(ranks, token) != [rank]}


class PrefixCoder:
    """Encodes by the last tokens of prefixes.  ranks: every single byte is among them."""

    def __init__(self, ranks: dict[bytes, int], never: set[int] | None = None):
        never = never_made(ranks) if never is None else never
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        self.ranks, self.tokens = ranks, dict(zip(ranks.values(), ranks))
        self.longest = max(map(len, ranks))
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if rank not in never:
                self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}

    def stay(self, left: int, right: int) -> bool:
        """Whether the two tokens, side by side, encode to themselves; remembered in a bounded memory."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        first = self.tokens[left]
        both = first + self.tokens[right]
        known = self.pairs[left << 32 | right] = both not in self.ranks and bool(merged(self.ranks, both, len(first)))
        return known

    def extend(self, last: list[int], data: bytes, stop: int | None = None) -> list[int]:
        """Adds the last token of each prefix of data that `last` lacks (up to `stop` bytes); last[i] belongs to i + 1 bytes."""
        done, known = len(last), self.pairs.get
        begin = max(0, done - self.longest + 1)
        for end, (length, token) in self.automaton.iter(data[begin:stop].decode("latin-1")):
            end += begin
            if end == done:  # ends come in order, and exactly one candidate passes
                before = end - length
                if before >= 0:
                    left = last[before]
                    passes = known(left << 32 | token)
                    if passes is None:
                        passes = self.stay(left, token)
                else:
                    passes = before == -1
                if passes:
                    last.append(token)
                    done += 1
        return last

    def changed(self, last: list[int], old: bytes, start: int, stop: int, new: bytes) -> tuple[bytes, list[int], int]:
        """The word after old[start:stop] became `new`, its table, and how many of its prefixes were worked out anew."""
        data, shift = old[:start] + new + old[stop:], len(new) - (stop - start)
        fresh, edge = last[:start], start + len(new)
        while len(fresh) < len(data):
            self.extend(fresh, data, min(len(data), max(len(fresh), edge) + 2 * self.longest))
            end = len(fresh)
            same = range(max(edge, end - self.longest), end)
            # as many equal prefixes as a token is long, all behind the edit: what follows cannot differ
            if len(same) == self.longest and all(fresh[i] == last[i - shift] for i in same):
                return data, fresh + last[end - shift :], end - start
        return data, fresh, len(data) - start

    def tokens_of(self, last: list[int], size: int | None = None) -> list[int]:
        """The encoding of the word's first `size` bytes: last tokens, followed from the end."""
        at, found = len(last) if size is None else size, []
        while at:
            found.append(last[at - 1])
            at -= len(self.tokens[found[-1]])
        return found[::-1]

    def encode(self, word: bytes) -> list[int]:
        whole = self.ranks.get(word)
        return [whole] if whole is not None else self.tokens_of(self.extend([], word))


class Words(dict):
    """Ids of words, as the machine's unsigned 32-bit integers; a bounded memory over a coder that keeps what is asked for."""

    def __init__(self, coder: PrefixCoder):
        self.coder, self.before = coder, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = array("I", self.coder.encode(word.encode())).tobytes()
        if len(word) <= WORD_CHARS:
            if len(self) >= WORDS:
                self.before = dict(self)
                self.clear()
            self[word] = ids
        return ids


def newer_letters(pattern: str = PATTERN) -> str:
    """A class of what the regex library calls a letter or number and the tokenizer's library does not.

    Without merges only a match that is a token as a whole is one id, which shows where the library cuts.
    """
    import tiktoken

    young = unknown_letters()
    ranks = {bytes([b]): b for b in range(256)} | {f"{p}{c}".encode(): 256 + 2 * i + (p == "1") for i, c in enumerate(young) for p in "a1"}
    cut = tiktoken.Encoding("cuts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return as_class([c for c in young if len(cut(f"a{c}")) > 1 and len(cut(f"1{c}")) > 1])


@dataclass
class Worker:
    coder: PrefixCoder
    words: Words
    split: object

    @classmethod
    def of(cls, shared: dict) -> Worker:
        coder = PrefixCoder(shared["ranks"], shared["never"])
        return cls(coder, Words(coder), word_splitter(shared["newer"]))


def vocabulary(df: DataFrame, path: str):
    """The vocabulary as a broadcast (its file bounds the size); workers build their coder from it once."""
    ranks = read_ranks(path)
    return df.sparkSession.sparkContext.broadcast({"ranks": ranks, "never": never_made(ranks), "newer": newer_letters()})


def decode(worker: Worker, ids: bytes) -> bytes:
    """The tokens' bytes, one after another; in pieces, so that few ids are Python objects at a time."""
    numbers, piece = np.frombuffer(ids, np.uint32), worker.coder.tokens.__getitem__
    return b"".join(b"".join(map(piece, numbers[i : i + OUT_BYTES].tolist())) for i in range(0, len(numbers), OUT_BYTES))


def _columns(docs: DataFrame) -> DataFrame:
    return small_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) for every row of docs; ids are little-endian unsigned 32-bit integers, decoded the bytes."""
    shared = vocabulary(docs, path)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = once(shared.value, Worker.of)
        ids_of = worker.words.__getitem__
        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = b"".join(b"".join(map(ids_of, words)) for words in word_blocks(worker.split, text.as_py() or ""))
                decoded = decode(worker, ids)
                rows.append((doc_id, len(ids) // 4, np.frombuffer(ids, np.uint32).astype("<u4").tobytes(), decoded))
                held += len(decoded) + len(ids)
                if held >= OUT_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return _columns(docs).mapInArrow(run, OUT)


# --------------------------------------------------------------------------
# stored tables, appends and edits


@dataclass
class PrefixText:
    """A text with the start of each word (in bytes) and the last token of each prefix of each word."""

    text: str
    starts: array
    last: array

    @classmethod
    def of(cls, worker: Worker, text: str) -> PrefixText:
        made = cls("", array("I"), array("I"))
        made.changed(worker, 0, 0, text)
        return made

    def words(self) -> Iterator[tuple[int, int]]:
        return zip(self.starts, [*self.starts[1:], len(self.last)])

    def ids(self, worker: Worker) -> list[int]:
        data, out = self.text.encode(), []
        for a, b in self.words():
            whole = worker.coder.ranks.get(data[a:b])
            out += [whole] if whole is not None else worker.coder.tokens_of(self.last[a:b].tolist())
        return out

    def changed(self, worker: Worker, start: int, stop: int, new: str) -> int:
        """Puts `new` in place of characters start to stop; returns how many bytes' prefixes were worked out anew.

        Words are cut again from the last one that the edit cannot reach, until a word starts where one started before.
        Of a word that holds the edit inside, the table before and, once it repeats itself, after the edit stays.
        """
        start, stop = max(0, min(start, len(self.text))), max(0, min(stop, len(self.text)))
        stop = max(start, stop)
        old = self.text.encode()
        a, b = len(self.text[:start].encode()), len(self.text[:stop].encode())
        data = old[:a] + new.encode() + old[b:]
        shift = len(data) - len(old)
        starts = np.frombuffer(self.starts, np.uint32).astype(np.int64)
        # the words that end well before the edit stay: a match depends on at most AHEAD - 1 characters behind it
        reach = len(self.text[: max(0, start - AHEAD)].encode())
        keep = max(0, int(np.searchsorted(starts, reach, side="right")) - 1)
        at = int(starts[keep]) if len(starts) else 0
        fresh_starts, fresh, work, anchor = self.starts[:keep], self.last[:at], 0, a + len(new.encode())
        old_starts = set((starts[starts >= b] + shift).tolist())
        for words in word_blocks(worker.split, data[at:].decode()):
            for word in words:
                if at >= anchor and at in old_starts:  # cut as before from here on
                    same = int(np.searchsorted(starts, at - shift))
                    fresh_starts.extend((starts[same:] + shift).tolist())
                    self.text, self.starts, self.last = data.decode(), fresh_starts, fresh + self.last[at - shift :]
                    return work
                piece = word.encode()
                i = int(np.searchsorted(starts, at, side="right")) - 1
                end = int(starts[i + 1]) if 0 <= i < len(starts) - 1 else len(old)
                if 0 <= i and starts[i] == at <= a and b <= end and at + len(piece) == end + shift:
                    _, table, n = worker.coder.changed(self.last[at:end].tolist(), old[at:end], a - at, b - at, piece[a - at : len(piece) - (end - b)])
                else:
                    table, n = worker.coder.extend([], piece), len(piece)
                fresh_starts.append(at)
                fresh.extend(table)
                work += n
                at += len(piece)
        self.text, self.starts, self.last = data.decode(), fresh_starts, fresh
        return work


def _stored(rows: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("starts", pa.binary()), ("last", pa.binary())])
    return pa.RecordBatch.from_pylist([{"doc_id": i, "text": p.text, "starts": np.array(p.starts, "<u4").tobytes(), "last": np.array(p.last, "<u4").tobytes()} for i, p in rows], schema=schema)


def _read(row: dict) -> PrefixText:
    return PrefixText(row["text"], *(array("I", np.frombuffer(row[c], "<u4").astype(np.uint32).tobytes()) for c in ("starts", "last")))


def prefix_tables(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, text, starts, last): each text with its words' starts and its stored prefix tables, four bytes a byte."""
    shared = vocabulary(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = once(shared.value, Worker.of)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield _stored([(doc_id, PrefixText.of(worker, text.as_py() or ""))])

    return _columns(docs).mapInArrow(run, TABLE)


def table_ids(tables: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) from stored tables."""
    shared = vocabulary(tables, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = once(shared.value, Worker.of)
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.array(_read(row).ids(worker), "<u4").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([row["doc_id"]], pa.int64()), pa.array([ids], pa.binary())], ["doc_id", "ids"])

    return small_batches(tables).select("doc_id", "text", "starts", "last").mapInArrow(run, "doc_id long, ids binary")


def edited(tables: DataFrame, edits: DataFrame, path: str) -> DataFrame:
    """(doc_id, text, starts, last, n_redone): stored tables after edits (doc_id, start, stop, replacement), one a document.

    start and stop count characters and are held to the text (an append starts at its length); a document without an
    edit stays, null places count as the end of the text and a null replacement as empty; n_redone: prefixes worked out anew.
    """
    shared = vocabulary(tables, path)
    asked = edits.groupBy("doc_id").agg(F.min(F.struct("start", "stop", "replacement")).alias("edit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = once(shared.value, Worker.of)
        for batch in batches:
            for row in batch.to_pylist():
                table, edit, n = _read(row), row["edit"], 0
                if edit is not None:
                    places = [len(table.text) if edit[c] is None else edit[c] for c in ("start", "stop")]
                    n = table.changed(worker, *places, edit["replacement"] or "")
                out = _stored([(row["doc_id"], table)])
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array([n], pa.int64())], [*out.schema.names, "n_redone"])

    joined = tables.select("doc_id", "text", "starts", "last").join(asked, "doc_id", "left").select("doc_id", "text", "starts", "last", "edit")
    return small_batches(joined).mapInArrow(run, TABLE + ", n_redone long")
