import random
import re
import time

from llm_data import docs  # noqa: F401

from anchorframe.llm import pii


def brute(text):
    """The patterns as they are written down."""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in digits(m)][::-1]
        if 12 <= len(d) <= 19 and (sum(d[::2]) + sum(2 * x - 9 * (x > 4) for x in d[1::2])) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m)) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_base_spans_against_patterns():
    rng = random.Random(1)
    parts = ["a@b.cd", "x.y+z@q-w.co.uk", "@", "a@", "@b.c", "a@b", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "0" * 15,
             "+1 (555) 555-0100", "+12345", "++49 30 123456", "+1", " ", ".", "-", "é", "at", "dot", "word", "\n", "9", "+", "(", ")", "%"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert pii.detect(text) == brute(text), text
        assert [s[:3] for s in pii.find_spans(text) if s[3]] == brute(text)


def test_disguises_map_back_to_the_source():
    cases = {
        "write to joe [at] mail (dot) org today": ("email", "joe [at] mail (dot) org"),
        "smith at example dot com": ("email", "smith at example dot com"),
        "ｊｏｅ＠ｍａｉｌ．ｃｏｍ": ("email", "ｊｏｅ＠ｍａｉｌ．ｃｏｍ"),
        "ring plus one six six eight five five five two two eight one now": ("phone", "plus one six six eight five five five two two eight one"),
        "card four one one one one one one one one one one one one one one one.": ("card", "four one one one one one one one one one one one one one one one"),
        "host one nine two dot one six eight dot one dot one": ("ip", "one nine two dot one six eight dot one dot one"),
        "ip 10.0.​0.1 x": ("ip", "10.0.​0.1"),
    }
    for text, (kind, source) in cases.items():
        assert (kind, source) in [(k, text[a:b]) for k, a, b, base in pii.find_spans(text) if not base], text


def test_plain_prose_gains_nothing():
    for text in ("we met at noon. He looked at the dot on it", "look at this.That is one of two or three", "null drei sechs", "meet me at home (at six)", ""):
        assert pii.find_spans(text) == []


def test_long_texts_take_linear_time():
    began = time.time()
    for text in ("a" * 200_000, "1" * 200_000, "(" * 200_000, " " * 200_000, "@" * 200_000, "1." * 100_000, "+1" + " " * 200_000, "one " * 50_000):
        pii.find_spans(text)
    assert time.time() - began < 20


def test_table_and_redaction(docs):
    text = "mail a@b.cd or +1 (555) 555-0100, é x@y [dot] z"
    rows = [(1, text), (1, text), (None, text), (2, None), (3, "")]
    got = pii.personal_data(docs(rows)).collect()
    assert len(got) == 5 and all(len(r.spans) == (len(pii.find_spans(text)) if r.doc_id in (1, None) else 0) for r in got)
    clean = pii.redacted(docs(rows))
    assert clean.columns == docs(rows).columns
    by = {r.doc_id: r for r in clean.collect()}
    assert by[1].text == "mail [EMAIL] or [PHONE], é [EMAIL]" and by[1].n_chars == len(by[1].text) and by[2].text is None and by[3].text == ""
    assert pii.personal_data(docs([])).count() == 0 and pii.redacted(docs([])).count() == 0


def test_bare_dots_next_to_any_at_sign():
    for source in (*(f"jane at example dot {e}" for e in ("dev", "co", "se", "pl", "ai", "app", "museum", "co dot uk")), "joe (at) mail dot org", "joe@mail dot org", "joe at mail [dot] org",
                   "john dot smith at example dot com", "john dot smith@example.com", "j dot r dot smith [at] a dot b dot c dot d dot e dot f dot se", "john dot smith at example.com",
                   "a dot smith at mail.example dot io", "JOE AT MAIL DOT DE", "joe @ mail dot org", "john [dot] smith at mail dot co.uk"):
        for text in (source, f"write me at {source} at noon", f"reach ({source}), thanks", f"{source}\njoe at mail dot org"):
            assert ("email", source, False) in [(k, text[a:b], base) for k, a, b, base in pii.find_spans(text)], text


def test_prose_with_at_and_dot_gains_nothing():
    for text in ("he looked at the dot on it", "stare at this dot in turn", "good at vector dot products", "sold at one dot five", "we stood at home. Dot was there", "look at each dot it draws",
                 "at noon the dot com boom ended", "they laughed at the dot com bubble", "see the docs at example.com", "the dot at example.com is red", "@joe dot com", "dot at dot", "x at y dot 5"):
        assert pii.find_spans(text) == [], text


def test_many_signs_take_linear_time():
    began = time.time()
    for text in ("a dot " * 100_000, "a at " * 100_000, "a@b dot " * 50_000, "a (dot) " * 50_000, "a at b dot " * 50_000, "a dot b at " * 50_000, "a" + " \n" * 100_000 + "dot", "a @ " * 50_000):
        pii.find_spans(text)
    assert time.time() - began < 20
