"""Main text of web pages: boosted trees over DOM nodes, decoded down the tree.

Every block element has features of its subtree (text and link density, tags, punctuation), its attributes' words, its
depth and siblings, and its ancestors.  A gradient-boosted forest of shallow trees, trained here, gives the log odds
that the element is part of the main text.  Decoding picks the best set of elements in which no element is kept whose
ancestor is dropped: a node is worth its own log odds plus, for every child, the better of keeping or dropping it.

There are no labels for pages, so the forest learns from layouts: texts of a bounded sample of the pages are put into
pages of many layouts (semantic tags or plain divs, menus, side columns, notices, adverts, forms, comments), in which
every element's role is known, beside the sampled pages themselves where their semantic tags tell the roles.

Defined cases: null html is empty; a page without text, or without any element worth keeping, has an empty text; broken
markup is read forgivingly; every row gives a row, whatever its page_id; further columns are ignored.
"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorframe.llm.common import small_batches
from anchorframe.llm.dom import BLOCK, Element, parse, text_of

#: Pages that the forest is trained on, at most, and the characters of the longest that can be among them.
TRAIN_PAGES, TRAIN_CHARS = 150, 200_000

# Words of class, id and role attributes, by role.
GOOD_TOKENS = frozenset("article articlebody body content entry main post story text page hentry blog prose chapter".split())
BAD_TOKENS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs toc pagination pager tabs skip",
    "frame": "header footer masthead banner copyright credits legal topbar bottom site",
    "side": "sidebar aside side widget related recommended popular trending rail column",
    "notice": "cookie cookies consent notice alert popup modal gdpr overlay dialog",
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion adsense",
    "form": "form login signup subscribe newsletter search register contact",
    "social": "share sharing social follow like tweet",
    "comment": "comment comments disqus reply replies respond discussion reviews",
}
_BAD = {w: i for i, words in enumerate(BAD_TOKENS.values()) for w in words.split()}
_GROUPS = ("p", "heading", "list", "item", "link", "article", "section", "nav", "header", "footer", "aside", "form", "table", "quote", "other")
_GROUP = {"p": 0, "h1": 1, "h2": 1, "h3": 1, "h4": 1, "h5": 1, "h6": 1, "ul": 2, "ol": 2, "dl": 2, "menu": 2, "li": 3, "dt": 3, "dd": 3, "a": 4, "article": 5, "main": 5,
          "section": 6, "div": 6, "body": 6, "nav": 7, "header": 8, "footer": 9, "aside": 10, "form": 11, "fieldset": 11, "table": 12, "tr": 12, "td": 12, "th": 12,
          "tbody": 12, "blockquote": 13, "pre": 13, "figure": 13, "figcaption": 13}
_DROPPED_TAGS = frozenset((7, 9, 10, 11))  # groups whose role is known without learning, when labels are made

N_FEATURES = 16 + len(BAD_TOKENS) + 8


def node_features(elements: list[Element]) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(element numbers, features, own characters) of the block elements, in page order."""
    n = len(elements)
    own, chars, link, tags, commas, words = [0] * n, [0] * n, [0] * n, [1] * n, [0] * n, [0] * n
    for e in reversed(elements):
        i = e.at
        if e.hidden:
            chars[i] = link[i] = commas[i] = words[i] = 0
        else:
            for part in e.parts:
                if isinstance(part, str):
                    k = len(part.strip())
                    own[i] += k
                    commas[i] += part.count(",") + part.count(".")
                    words[i] += part.count(" ") + (k > 0)
            chars[i] += own[i]
            if e.tag == "a":
                link[i] = chars[i]
        if e.parent is not None:
            p = e.parent.at
            chars[p] += chars[i]
            link[p] += link[i]
            tags[p] += tags[i]
            commas[p] += commas[i]
            words[p] += words[i]
            if e.tag not in BLOCK and not e.hidden:
                own[p] += own[i]
    depth, bad_above, good_above, dropped_above = [0] * n, [0] * n, [0] * n, [0] * n
    out, at, held = [], [], []
    total = max(chars[0], 1)
    alike = [Counter(s.tag for s in e.children) if e.children else None for e in elements]
    for e in elements:
        i, p = e.at, e.parent.at if e.parent is not None else None
        group = _GROUP.get(e.tag, len(_GROUPS) - 1)
        kinds = {_BAD[t] for t in e.tokens if t in _BAD}
        good = bool(e.tokens & GOOD_TOKENS) or group == 5
        if p is not None:
            depth[i] = depth[p] + 1
            bad_above[i] = bad_above[p] + bool(kinds)
            good_above[i] = good_above[p] + good
            dropped_above[i] = dropped_above[p] + (group in _DROPPED_TAGS)
        if e.tag not in BLOCK or e.hidden or e.tag in ("br", "hr") or e.parent is None:
            continue
        siblings = e.parent.children
        row = [0.0] * N_FEATURES
        row[0:16] = [
            group, depth[i], np.log1p(chars[i]), np.log1p(own[i]), link[i] / max(chars[i], 1), chars[i] / tags[i], tags[i], commas[i] / max(words[i], 1),
            chars[i] / total, len(siblings), chars[i] / max(chars[e.parent.at], 1), _GROUP.get(e.parent.tag, len(_GROUPS) - 1), chars[i] / max(words[i], 1),
            alike[p][e.tag] / len(siblings), float(good), float(bool(kinds)),
        ]
        for kind in kinds:
            row[16 + kind] = 1.0
        base = 16 + len(BAD_TOKENS)
        row[base : base + 8] = [bad_above[i], good_above[i], dropped_above[i], float(group in _DROPPED_TAGS), link[e.parent.at] / max(chars[e.parent.at], 1),
                                np.log1p(words[i]), (i + 1) / n, float(not kinds and not good)]
        out.append(row)
        at.append(i)
        held.append(own[i])
    return at, np.array(out, float).reshape(len(out), N_FEATURES), np.array(held, float)


# --- boosted trees ---


@dataclass
class Forest:
    """Boosted trees of fixed depth as arrays: feature and threshold of every inner node, value of every leaf."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(len(value)))):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - len(feature)]
        return out


def fit_forest(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.25, bins: int = 32) -> Forest:
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    share = (weight @ y + 0.5) / (weight.sum() + 1)
    base = float(np.log(share / (1 - share)))
    logit = np.full(len(y), base)
    inner, leaves = 2**depth - 1, 2**depth
    features, thresholds, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-logit))
        g, h = weight * (y - p), weight * p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            best = np.full(width, 1e-9)
            cut = np.full(width, -1)
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                key = (node - first) * (len(c) + 1) + binned[:, f]
                gs = np.bincount(key, g, width * (len(c) + 1)).reshape(width, -1).cumsum(axis=1)
                hs = np.bincount(key, h, width * (len(c) + 1)).reshape(width, -1).cumsum(axis=1)
                gl, hl, gt, ht = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                at = gain.argmax(axis=1)
                won = gain[np.arange(width), at] > best
                best[won], cut[won] = gain[np.arange(width), at][won], at[won]
                feature[first : first + width][won], threshold[first : first + width][won] = f, c[at[won]]
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > threshold[node])
        leaf = node - inner
        value = rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + 1)
        logit += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Forest(base, np.array(features), np.array(thresholds), np.array(values))


# --- training layouts ---


def _semantic_roles(elements: list[Element]) -> list[bool] | None:
    """Whether each element is main text, where article or main and no plainer boilerplate tag tell; else None."""
    if not any(e.tag in ("article", "main") for e in elements):
        return None
    keep = [False] * len(elements)
    for e in elements:
        group = _GROUP.get(e.tag, -1)
        above = keep[e.parent.at] if e.parent is not None else False
        bad = group in _DROPPED_TAGS or any(t in _BAD for t in e.tokens)
        keep[e.at] = (above or e.tag in ("article", "main")) and not bad
    needed = [False] * len(elements)  # what holds main text has to stay open
    for e in reversed(elements):
        needed[e.at] |= keep[e.at]
        if needed[e.at] and e.parent is not None:
            needed[e.parent.at] = True
    return needed


def _layout(texts: list[str], others: list[str], rng: random.Random) -> str:
    """A page with known roles: elements of the main text, and those around it, carry data-role."""
    take = lambda k: [rng.choice(others)[: rng.randint(8, 90)] for _ in range(k)]
    plain = rng.random() < 0.5

    def box(kind: str, inside: str, tag: str) -> str:
        word = rng.choice(BAD_TOKENS[kind].split())
        use = "div" if plain or rng.random() < 0.4 else tag
        named = f' {rng.choice(("class", "id"))}="{word}{rng.choice(("", "-box", "-" + word, " block"))}"' if use == "div" or rng.random() < 0.6 else ""
        return f"<{use}{named} data-role=bad>{inside}</{use}>"

    links = lambda k: "<ul>" + "".join(f"<li><a href=#>{t[:24]}</a></li>" for t in take(k)) + "</ul>"
    paragraphs = lambda k: "".join(f"<p>{t}</p>" for t in take(k))
    around = [
        box("menu", links(rng.randint(3, 9)), "nav"), box("frame", f"<div>{take(1)[0]}</div>", "header"), box("side", f"<h3>{take(1)[0]}</h3>{links(4)}{paragraphs(1)}", "aside"),
        box("notice", paragraphs(1) + "<a href=#>ok</a>", "div"), box("advert", rng.choice(others)[:120], "div"),
        box("form", f"<label>{take(1)[0][:20]}</label><input><p>{take(1)[0][:30]}</p>", "form"), box("social", links(3), "div"),
    ]
    inside = [box(kind, body, "div") for kind, body in (("advert", rng.choice(others)[:120]), ("social", links(2)), ("side", links(3)), ("notice", paragraphs(1))) if rng.random() < 0.3]
    rng.shuffle(around)
    top = around[: rng.randint(1, 5)]
    below = around[len(top) : len(top) + rng.randint(0, 3)]
    if rng.random() < 0.6:
        remarks = "".join(f'<div class="comment"><b>{t[:12]}</b><p>{u}</p></div>' for t, u in zip(take(3), (rng.choice(others)[:300] for _ in range(3))))
        below.insert(0, box("comment", remarks, "section"))
    below.append(box("frame", f"&copy; {take(1)[0]}", "footer"))
    kinds = [rng.choice(("p", "p", "p", "p", "blockquote", "li", "h2", "div", "td", "pre")) for _ in texts]
    wrap = {"li": "<ul data-role=good><li data-role=good>{}</li></ul>", "td": "<table data-role=good><tr data-role=good><td data-role=good>{}</td></tr></table>"}
    blocks = [f"<h1 data-role=good>{texts[0][:80]}</h1>"] + [wrap.get(k, f"<{k} data-role=good>{{}}</{k}>").format(t) for k, t in zip(kinds, texts)]
    for extra in inside:
        blocks.insert(rng.randint(1, len(blocks)), extra)
    name = rng.choice(sorted(GOOD_TOKENS))
    tag = rng.choice(("div", "div", "section")) if plain else rng.choice(("article", "main", "article"))
    named = f' class="{name}"' if plain and rng.random() < 0.85 or rng.random() < 0.3 else ""
    main = f"<{tag}{named} data-role=good>{''.join(blocks)}</{tag}>"
    if rng.random() < 0.4:
        main = f'<div class="{rng.choice(("container", "wrapper", "row", "layout"))}" data-role=good>{main}{below.pop(0) if rng.random() < 0.3 else ""}</div>'
    return f"<html><head><title>x</title></head><body data-role=good>{''.join(top)}{main}{''.join(below)}</body></html>"


def _known_roles(html: str) -> tuple[list[Element], list[bool]]:
    """A layout's elements and their roles; the marks themselves are taken out of the tokens."""
    elements = parse(html.replace(" data-role=good", " data-role=rolegood").replace(" data-role=bad", " data-role=rolebad"))
    keep = []
    for e in elements:
        above = keep[e.parent.at] if e.parent is not None else True
        keep.append(above and "rolebad" not in e.tokens and ("rolegood" in e.tokens or e.tag not in BLOCK or e.parent is None or above))
        e.tokens -= {"rolegood", "rolebad"}
    return elements, keep


def train(pages: DataFrame, rows: int = TRAIN_PAGES, layouts: int = 3) -> Forest:
    """A forest trained on at most `rows` pages of up to TRAIN_CHARS characters (those with the smallest hashes of their ids)."""
    fit = pages.filter(F.length("html") <= TRAIN_CHARS)
    # ids first: only the chosen pages themselves leave the executors
    chosen = fit.select("page_id").filter("page_id is not null").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(rows)
    found = sorted(fit.select("page_id", "html").join(F.broadcast(chosen), "page_id").groupBy("page_id").agg(F.min("html").alias("html")).collect(), key=lambda r: r["page_id"])
    rng, xs, ys, ws = random.Random(11), [], [], []
    texts = []
    for r in found:
        elements = parse(r["html"])
        roles = _semantic_roles(elements)
        if roles is not None:
            at, x, own = node_features(elements)
            xs.append(x)
            ys.append(np.array([roles[i] for i in at], float))
            ws.append(1 + np.log1p(own))
        texts += [t for e in elements if e.tag in ("p", "div", "td", "li") and not e.hidden for part in e.parts if isinstance(part, str) and len(t := " ".join(part.split())) > 3]
    texts = texts or ["one two three four five, six seven.", "eight nine ten"]
    for _ in range(layouts * max(len(found), 20)):
        mine = [rng.choice(texts) if rng.random() < 0.85 else rng.choice(texts)[: rng.randint(2, 20)] for _ in range(rng.randint(1, 14))]
        elements, keep = _known_roles(_layout(mine, texts, rng))
        at, x, own = node_features(elements)
        xs.append(x)
        ys.append(np.array([keep[i] for i in at], float))
        ws.append(1 + np.log1p(own))
    return fit_forest(np.concatenate(xs), np.concatenate(ys), np.concatenate(ws))


# --- decoding ---


def decode(elements: list[Element], at: list[int], logits: np.ndarray, own: np.ndarray) -> list[bool]:
    """The best choice in which nothing is kept below a dropped element.  Inline elements go with their parents."""
    n = len(elements)
    worth, lost = [0.0] * n, [0.0] * n
    for i, logit, k in zip(at, logits.tolist(), own.tolist()):
        worth[i] = logit * (0.25 + float(np.log1p(k)))
    for e in reversed(elements):  # worth: kept, with the best choice below; children come before their parents
        if e.parent is not None:
            worth[e.parent.at] += max(worth[e.at], lost[e.at])
    keep = [True] * n
    for e in elements[1:]:
        keep[e.at] = keep[e.parent.at] and worth[e.at] > lost[e.at] - (e.tag not in BLOCK or e.tag in ("body", "br", "hr")) * 1e9
    return keep


def main_texts(htmls: list[str | None], forest: Forest) -> list[str]:
    parsed = [parse(h or "") for h in htmls]
    nodes = [node_features(elements) for elements in parsed]
    sizes = np.cumsum([0] + [len(at) for at, _, _ in nodes])
    logits = forest.logits(np.concatenate([x for _, x, _ in nodes])) if nodes else np.empty(0)
    return [text_of(e, decode(e, at, logits[a:b], own)) for e, (at, _, own), a, b in zip(parsed, nodes, sizes, sizes[1:])]


def extracted(pages: DataFrame, rows: int = TRAIN_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of pages."""
    shared = pages.sparkSession.sparkContext.broadcast(train(pages, rows))  # some kilobytes, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 64):
                part = batch.slice(a, 64)
                texts = main_texts(part.column(2).to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    found = small_batches(pages).select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, "page_id long, url string, text string")
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
