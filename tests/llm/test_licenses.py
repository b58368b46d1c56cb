import random
import re
from math import ceil

from llm_data import docs  # noqa: F401
from tests_llm_tools import alnum_words

from anchorframe.llm import licenses


def brute(text):
    words = [w for w in alnum_words(text) if w]
    places = sorted((i, label) for p, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
    found = {}
    for part in re.split(r"\n(?:[^\S\n]*\n)+", "\n" + (text or "") + "\n"):
        own = []
        for line in part.split("\n"):
            line_words = [w for w in alnum_words(line) if w]
            own += line_words[1:] if line_words[:1] in (["dnl"], ["rem"]) else line_words
        for label, template in licenses.TEMPLATES.items():
            want = {w for w in alnum_words(template) if w}
            length = len([w for w in alnum_words(template) if w])
            width = length + max(2, length // 4)
            most = max((len(want & set(own[i : i + width])) for i in range(max(1, len(own) - width + 1))), default=0)
            if most >= ceil(licenses.THRESHOLD * len(want) - 1e-9):
                found[label] = max(found.get(label, 0), most / len(want))
    base = sorted({label for _, label in places})
    starts = [i for i, _ in places]
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), base, sorted({*base, *found}), 1.0 if base else max(found.values(), default=0.0))


def test_brute_force(docs):
    rng = random.Random(6)
    vocab = [w for t in [*licenses.TEMPLATES.values(), *licenses.PHRASES] for w in t.split()] + ["é", "x", "cc", "by", "-", "4.0"]
    texts = [None, "", "\n\n", "CC-BY cc by CC BY", "general\npublic license", "ALL rights, reserved. all rights reserved", "x " * 5_000 + "Licensed under CC BY-NC 4.0."]
    for _ in range(300):
        line = list(rng.choice(list(licenses.TEMPLATES.values())).split())
        for _ in range(rng.randint(0, 3)):
            line[rng.randrange(len(line)) :] = [rng.choice(vocab) for _ in range(rng.randint(1, 5))] if rng.random() < 0.5 else line[1:]
            line = line or ["x"]
        rng.shuffle(line) if rng.random() < 0.2 else None
        texts.append("\n".join(" ".join(x) for x in ([rng.choice(vocab) for _ in range(rng.randint(0, 9))], line, [rng.choice(vocab)])))
    rows = [(None if i % 50 == 7 else i, t) for i, t in enumerate(texts)] + [(3, texts[3])]
    got = licenses.scan(docs(rows)).collect()
    key = lambda x: (x[0] is None, x[0] or 0, repr(x[1:]))
    fields = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    assert sorted(((r.doc_id, *(r[f] for f in fields)) for r in got), key=key) == sorted(((i, *brute(t)) for i, t in rows), key=key)
    assert any(r.labels != r.base_labels for r in got)
    assert licenses.scan(docs([])).count() == 0


def test_wrapped_notices(docs):
    rows, want = [], []
    for label, template in licenses.TEMPLATES.items():
        words = template.split()
        for mark in ("", "# ", " * ", "// ", "dnl "):
            for width in (1, 4, 9):
                body = [mark + " ".join(words[i : i + width]) for i in range(0, len(words), width)]
                rows.append((len(rows), "\n".join(["intro words", "", "code above", *body, "more code below", "", "end"])))
                want.append(label)
    got = {r.doc_id: r for r in licenses.scan(docs(rows)).collect()}
    for i, label in enumerate(want):
        assert label in got[i].labels and got[i].score == 1.0, rows[i]


def test_words_far_apart_are_no_notice(docs):
    words = licenses.TEMPLATES["mit-grant"].split()
    rows = [(1, ("\n" + "other " * 9 + "\n").join(words)), (2, "\n\n".join(words)), (3, " ".join(words[:9]) + "\n\n" + " ".join(words[9:]))]
    assert all(not r.labels for r in licenses.scan(docs(rows)).collect())


def test_line_breaks_make_no_difference(docs):
    rng = random.Random(8)
    texts = ["Released under the (very open) MIT License", "intro Released under the MIT and open License outro", "Licensed under CC BY-SA 4.0 and Licensed under CC BY-NC 4.0",
             "it is Licensed under CC BY-NC 4.0 or later as BY SA", licenses.TEMPLATES["gpl-notice"].replace("General", "so called General")]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(i, "".join("\n" if c == " " and rng.random() < 0.4 else c for c in t)) for i, t in enumerate(texts) for _ in range(6)]
    seen = {}
    for r in licenses.scan(docs(rows)).collect():
        seen.setdefault(r.doc_id, set()).add((tuple(r.labels), r.score))
    assert all(len(s) == 1 for s in seen.values())
    assert [next(iter(seen[i]))[0] for i in range(4)] == [("mit",), ("mit",), ("cc-by", "cc-by-nc-4.0", "cc-by-sa"), ("cc-by", "cc-by-nc-4.0")]
