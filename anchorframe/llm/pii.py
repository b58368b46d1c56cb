"""Personal data in texts, with offsets in the source even where the text disguises it.

Base spans are what the plain patterns match in the source.  Then small transducers rewrite the text step by step, each
keeping for every output character the source characters it came from: homoglyphs become ASCII, runs of spelled digits
become digits, disguised at and dot signs become "@" and ".".  The same detectors run on the rewritten text; spans that
hold a rewritten part are mapped back to the source and added.

Bare words " at " and " dot " are common in prose, so a dot is rewritten only in the domain or the local part of an at sign
(plain, bracketed or bare), and a bare at only with such a dot; words that make "dot" a noun ("at the dot", "dot product")
stop both. Digit words are rewritten only in runs of at least four.  Texts without any disguise (no homoglyph, bracketed or bare at/dot, four digit words) skip the
transducers.

Defined cases: a null text is empty and has no spans; offsets are code points, end exclusive; every row gives a row,
whatever its doc_id; further columns are ignored (and kept by `redacted`); time is linear in the text's length.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorframe.llm.common import small_batches

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"

# --- base detectors ---

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match that fails at the first digit of a run fails at its other digits too, so only the first is tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their "@" backwards so that long words cost no more than their length."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def detect(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind."""
    found = [("email", *span) for span in _emails(text)]
    if _DIGIT.search(text):
        found += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = re.sub("[ -]", "", m.group())
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", *m.span()))
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m.group())) <= 15]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


# --- transducers ---

# Letters of other scripts and the Latin letters they look like.
LOOKALIKES = dict(zip("аеорсухіјѕԁһԛԝАВЕКМНОРСТХІЈЅαεικνορυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcyxijsdhqwABEKMHOPCTXIJSaeiknopuxABEZHIKMNOPTYX"))
INVISIBLE = "­​‌‍⁠﻿"
# Digit words.
DIGIT_WORDS = {w: str(d) for words in (
    "zero one two three four five six seven eight nine", "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf", "cero uno dos tres cuatro cinco seis siete ocho nueve") for d, w in enumerate(words.split())}
MIN_DIGIT_WORDS = 4

_BRACKETED = re.compile(r"[\[({<]\s*(at|dot|punkt|point|punto|arroba)\s*[\])}>]", re.I)
_BARE = re.compile(r"(?<=[A-Za-z0-9])(?:\s++(at|dot)(?=\s++[A-Za-z0-9])|\s*+(@)\s*+(?=[A-Za-z0-9]))", re.I)
_SPACE = re.compile(r"\s*")
_NAMES = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
_LAST_WORD = re.compile(r"[A-Za-z]+\Z")
# Words before a dot that make it a noun, and words (no domain ends in them) and numbers after one in prose.
_BEFORE_NOUN = frozenset("the this that these those each every any some another which what its his her their my your our either neither no".split())
_ENDS_NOTHING = frozenset(
    "on of and or the was were are has had have that which with from for when where while then than into onto over under above below between near "
    "this these those but not if product products matrix notation plot plots pattern patterns operator syntax graph".split()) | DIGIT_WORDS.keys()
_WORD = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_SPELLED = re.compile(rf"(?<![^\W_])(?:plus[ -]+)?(?:{_WORD})(?:(?:[ -]+(?:dot[ -]+)?|[ ]*\.[ ]*)(?:{_WORD}|[0-9]+)(?![^\W_]))+", re.I)
_SPELLED_PART = re.compile(rf"plus|dot|\.|{_WORD}|[0-9]+", re.I)
_NOT_WORD = bytes.maketrans(bytes(range(128)), bytes(ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(128)))
_DIGIT_BYTES = frozenset(w.encode() for w in DIGIT_WORDS)

Aligned = tuple[str, list[int], list[int]]


def rewritten(text: Aligned, edits: list[tuple[int, int, str]]) -> Aligned:
    """The text with edits (start, end, replacement), in order; each new character stands for all that it replaces."""
    source, starts, ends = text
    out, begins, stops, at = [], [], [], 0
    for a, b, new in edits:
        out += (source[at:a], new)
        begins += starts[at:a] + [starts[a]] * len(new)
        stops += ends[at:a] + [ends[b - 1]] * len(new)
        at = b
    return "".join([*out, source[at:]]), begins + starts[at:], stops + ends[at:]


def _plain(c: str) -> str:
    """What a look-alike or compatibility character stands for; any other character itself."""
    if c in INVISIBLE:
        return ""
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    folded = unicodedata.normalize("NFKC", c) if c >= " " else c
    return folded if folded.isascii() and folded else c


def homoglyph_edits(text: str) -> list[tuple[int, int, str]]:
    plain = {c: p for c in set(text) if not c.isascii() and (p := _plain(c)) != c}
    return [(i, i + 1, plain[c]) for i, c in enumerate(text) if c in plain] if plain else []


def spelled_edits(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in _SPELLED.finditer(text):
        parts = [p.lower() for p in _SPELLED_PART.findall(m.group())]
        if sum(p in DIGIT_WORDS for p in parts) >= MIN_DIGIT_WORDS:
            edits.append((m.start(), m.end(), "".join({"plus": "+", "dot": "."}.get(p) or DIGIT_WORDS.get(p, p) for p in parts)))
    return edits


def _links(text: str) -> list[tuple[int, int, str, bool]]:
    """(start, end, sign, sure) of at and dot signs with the space around them; bare words and spaced "@" are not sure."""
    found = []
    for m in _BRACKETED.finditer(text):
        a, b = m.span()
        while a and text[a - 1].isspace():
            a -= 1
        while b < len(text) and text[b].isspace():
            b += 1
        found.append((a, b, "@" if m.group(1).lower() in ("at", "arroba") else ".", True))
    for m in _BARE.finditer(text):
        end = _SPACE.match(text, m.end()).end()
        found.append((m.start(), end, "." if (m.group(1) or "").lower() == "dot" else "@", m.group() == "@"))
    found.sort()
    return [x for i, x in enumerate(found) if not i or x[0] >= found[i - 1][1] or x[2] == found[i - 1][2] == "."]


def _ending(name: str) -> bool:
    last = name.rpartition(".")[2]
    return len(last) > 1 and last.isalpha() and last.lower() not in _ENDS_NOTHING


def sign_edits(text: str) -> list[tuple[int, int, str]]:
    """Bracketed signs, and the bare words of addresses: dots in the domain and the local part of an at sign, and the at.

    A bare at (or spaced "@") belongs to an address if a dot is disguised in its domain, or in its local part before a
    dotted domain.  Signs are settled from the right, since what follows an at may be the local part of the next.
    """
    links = _links(text)
    chosen = {i for i, (a, b, _, sure) in enumerate(links) if sure and text[a:b] != "@"}
    next_address = -1  # start of the local part that is settled next to the right
    for i in range(len(links) - 1, -1, -1):
        start, end, sign, sure = links[i]
        if sign == "." or not (start and text[start - 1] in _LOCAL) or not (m := _NAMES.match(text, end)):
            continue
        names, last = [m.group()], i
        while last + 1 < len(links) and links[last + 1][2] == "." and links[last + 1][0] == m.end() and (n := _NAMES.match(text, links[last + 1][1])):
            m, last = n, last + 1
            names.append(m.group())
        # the chain is the next address's local part, not a domain
        if not sure and end == next_address:
            continue
        while last > i and not links[last][3] and not _ending(names[last - i]):
            last -= 1
        first, at = i, start
        while first and links[first - 1][2] == "." and (run := text[links[first - 1][1] : at]) and _LOCAL.issuperset(run):
            a, _, _, known = links[first - 1]
            word = _LAST_WORD.search(text[max(0, a - 12) : a])
            if not (a and text[a - 1] in _LOCAL) or not known and word and word.group().lower() in _BEFORE_NOUN:
                break
            first, at = first - 1, a
        dotted = last > i or "." in names[0] and (sure or first < i and _ending(names[0]))
        if not dotted or not sure and names[0].lower() in _BEFORE_NOUN | {"a", "an"}:
            continue
        chosen.update(range(first, last + 1))
        next_address = at
        while next_address and text[next_address - 1] in _LOCAL:
            next_address -= 1
    edits = [(a, b, sign) for i, (a, b, sign, _) in enumerate(links) if i in chosen and text[a:b] != sign]
    return [e for i, e in enumerate(edits) if not i or e[0] >= edits[i - 1][1]]


def _disguised(text: str) -> bool:
    words = text.encode().translate(_NOT_WORD).split()
    if b"dot" in words or b"at" in words and any(c in text for c in "[({<") or sum(map(_DIGIT_BYTES.__contains__, words)) >= MIN_DIGIT_WORDS:
        return True
    return not text.isascii() and any(not c.isascii() and _plain(c) != c for c in set(text)) or bool(_BRACKETED.search(text))


def find_spans(text: str | None) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) by start, then kind, base ones first."""
    text = text or ""
    base = detect(text)
    out = [(*s, True) for s in base]
    if _disguised(text):
        aligned: Aligned = (text, list(range(len(text))), list(range(1, len(text) + 1)))
        for edits_of in (homoglyph_edits, spelled_edits, sign_edits):
            if edits := edits_of(aligned[0]):
                aligned = rewritten(aligned, edits)
        norm, starts, ends = aligned
        if norm != text:
            seen = set(base)
            for kind, a, b in detect(norm):
                span = (kind, starts[a], ends[b - 1])
                if text[span[1] : span[2]] != norm[a:b] and span not in seen:
                    seen.add(span)
                    out.append((*span, False))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), not s[3], s[2]))


# --- on tables ---


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) for every row of docs; a span: kind, start, end, base."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end", "base"), s)) for s in find_spans(t.as_py())] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["doc_id", "spans"])

    return small_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, f"doc_id long, spans {SPANS}")


def redact(text: str | None) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    merged: list[list] = []
    for kind, a, b, _ in find_spans(text):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    if not merged:
        return text
    at, out = 0, []
    for kind, a, b in merged:
        out += (text[at:a], f"[{kind.upper()}]")
        at = b
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame) -> DataFrame:
    """docs with personal data replaced in text; n_chars, where there is one, follows the new text."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(redact, na_action="ignore")

    out = small_batches(docs).withColumn("text", clean(F.col("text")))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
