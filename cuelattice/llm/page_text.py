"""Main text of web pages: a linear-chain conditional random field over blocks.

A page is cut into leaf blocks: text between block-level tags, in page order, each
with its open ancestors. Every block has binary features (ancestor tags, words of
their class and id attributes, text statistics, and the same of its neighbours);
a two-state chain (boilerplate, main) is trained by conditional likelihood and
decoded by Viterbi.

Labelled pages are drawn from the grammar in `layouts.py`, whose blocks carry their
labels, filled with block texts of the given pages, so the model meets the table's own
language but needs no label column. Bound: SAMPLE_BLOCKS blocks of SAMPLE_CHARS
characters at most, chosen by the hash of their text from SAMPLE_PAGES pages.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .layouts import labelled_pages

SAMPLE_PAGES, SAMPLE_BLOCKS, SAMPLE_CHARS = 200, 3_000, 2_000
DIM = 1 << 15
EPOCHS = 6

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)", re.S)
ATTR = re.compile(r"\b(class|id|role|itemprop|aria-label|hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
SPACE = re.compile(r"\s+")
WORD = re.compile(r"[a-z]+")
#: Tags whose content is never text of the page: scripts, styles, the head's title, form fields, frames.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "select"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark",
    "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "button", "input",
    "math", "mi", "mo", "mn", "mrow", "msup", "msub", "mfrac", "mtext", "msqrt", "semantics", "annotation", "svg", "g", "text", "tspan", "path",
    "object", "audio", "video", "canvas", "picture", "ruby", "rt", "rp", "output", "meter", "progress",
}
#: An opening tag closes an open one of these, within the nearest container.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"ul", "ol", "dl", "table", "div", "article", "section", "body", "main", "aside", "nav", "header", "footer", "form", "blockquote", "figure"}
#: Block tags that end an open paragraph.
ENDS_P = SCOPE | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "hr", "address", "fieldset", "details", "figcaption"}


class Block:
    __slots__ = ("path", "marks", "text", "linked")

    def __init__(self, path, marks, text, linked):
        self.path, self.marks, self.text, self.linked = path, marks, text, linked


def blocks(page: str) -> list[Block]:
    """Leaf blocks with text, in page order. Character references are decoded;
    white space inside a block becomes one space and is trimmed."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked = depth_a = 0

    def flush():
        nonlocal parts, linked
        if parts:
            text = SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                block = [x for x in stack if x[0] not in INLINE]
                out.append(Block(tuple(t for t, _ in block), tuple(m for _, ms in block for m in ms), text, min(linked, len(text)) / len(text)))
            parts, linked = [], 0

    def add(raw: str):
        nonlocal linked
        if raw:
            parts.append(raw)
            if depth_a:
                linked += len(raw.strip())

    pos, n = 0, len(page)
    while pos < n:
        lt = page.find("<", pos)
        if lt < 0:
            add(page[pos:])
            break
        add(page[pos:lt])
        m = TOKEN.match(page, lt)
        if not m:
            add("<")
            pos = lt + 1
            continue
        pos = m.end()
        if m[3] is None:
            if m[1]:
                add(html.escape(m[1]))
            continue
        tag, closing = m[3].lower(), bool(m[2])
        if tag in RAW and not closing:
            if tag not in INLINE:
                parts.append(" ")
            if not m[4].rstrip().endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, pos)
                pos = end.end() if end else n
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in INLINE:
            flush()
        if closing:
            at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if at is not None:
                if tag in INLINE and any(t not in INLINE for t, _ in stack[at:]):
                    del stack[at]
                else:
                    del stack[at:]
            depth_a = sum(t == "a" for t, _ in stack)
            continue
        if tag in ENDS_P or tag in CLOSES:
            shut = CLOSES.get(tag, set()) | ({"p"} if tag in ENDS_P else set())
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in shut:
                    del stack[k:]
                    break
                if stack[k][0] in SCOPE:
                    break
            depth_a = sum(t == "a" for t, _ in stack)
        if tag in VOID or m[4].rstrip().endswith("/"):
            continue
        marks: tuple[str, ...] = ()
        if m[4] and tag not in INLINE:
            found: list[str] = []
            for a in ATTR.finditer(m[4]):
                name, value = a[1].lower(), (a[2] or a[3] or a[4] or "").lower()
                if name == "hidden" or (name == "style" and "display:none" in value.replace(" ", "")):
                    found.append("@hidden")
                elif name != "style":
                    found += WORD.findall(value)
            marks = tuple(found)
        stack.append((tag, marks))
        depth_a += tag == "a"
    flush()
    return out


def _slot(name: str) -> int:
    return zlib.crc32(name.encode()) % DIM


_SLOTS: dict[str, int] = {}


def _slots(names: list[str]) -> list[int]:
    for x in names:
        if x not in _SLOTS:
            if len(_SLOTS) > 200_000:
                _SLOTS.clear()
            _SLOTS[x] = _slot(x)
    return [_SLOTS[x] for x in names]


def block_features(found: list[Block]) -> list[list[int]]:
    """Hashed binary features of each block, with those of its neighbours."""
    own, n = [], len(found)
    inside = any("article" in b.path or "main" in b.path for b in found)
    for k, b in enumerate(found):
        words = min(6, (b.text.count(" ") + 1).bit_length())
        leaf, link = b.path[-1] if b.path else "", int(b.linked * 3.99)
        end = b.text[-1] if b.text[-1] in ".!?:;" else "x"
        where = "none" if not inside else "in" if "article" in b.path or "main" in b.path else "out"
        f = [f"t:{t}" for t in set(b.path)] + [f"m:{w}" for w in set(b.marks)]
        f += [f"pair:{'/'.join(b.path[-2:])}", f"at:{4 * k // n}", f"far:{min(k, 3)}/{min(n - 1 - k, 3)}", f"where:{where}", f"where:{where}/{words}/{link}", f"named:{bool(b.marks)}"]
        if "©" in b.text or len(b.text) < 200 and re.search(r"(?i)copyright|all rights|cookie|subscribe|sign in|log in", b.text):
            f.append("notice")
        f += [f"leaf:{leaf}", f"n:{words}", f"link:{link}", f"end:{end}", f"look:{words}/{link}/{end}/{leaf}"]
        own.append(f)
    out = []
    for k, f in enumerate(own):
        around = [f"prev:{x}" for x in own[k - 1][-5:]] if k else ["first"]
        around += [f"next:{x}" for x in own[k + 1][-5:]] if k + 1 < n else ["last"]
        out.append(_slots(["bias", *f, *around]))
    return out


class Chain:
    """Two-state linear chain: emission weights per feature, and transitions."""

    def __init__(self):
        self.w, self.t = np.zeros(DIM), np.zeros((2, 2))

    def emissions(self, feats: list[list[int]]) -> np.ndarray:
        e = np.zeros((len(feats), 2))
        e[:, 1] = [self.w[f].sum() for f in feats]
        return e

    def gradient(self, feats: list[list[int]], y: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Of the log likelihood: per block for state 1, and for transitions, by
        forward and backward sums in log space."""
        e, n = self.emissions(feats), len(y)
        a, b = np.zeros((n, 2)), np.zeros((n, 2))
        a[0] = e[0]
        for k in range(1, n):
            a[k] = e[k] + np.logaddexp(a[k - 1][0] + self.t[0], a[k - 1][1] + self.t[1])
        for k in range(n - 2, -1, -1):
            z = b[k + 1] + e[k + 1]
            b[k] = np.logaddexp(self.t[:, 0] + z[0], self.t[:, 1] + z[1])
        log_z = np.logaddexp(*a[-1])
        node = np.array(y) - np.exp(a[:, 1] + b[:, 1] - log_z)
        edge = np.zeros((2, 2))
        for k in range(1, n):
            edge[y[k - 1], y[k]] += 1
            edge -= np.exp(a[k - 1][:, None] + self.t + (e[k] + b[k])[None] - log_z)
        return node, edge

    def fit(self, pages: list[tuple[list[list[int]], list[int]]]) -> Chain:
        """Stochastic ascent with per-weight steps and a small pull to zero."""
        sum_w, sum_t, rng = np.full(DIM, 1e-2), np.full((2, 2), 1e-2), np.random.default_rng(3)
        for _ in range(EPOCHS):
            for k in rng.permutation(len(pages)):
                feats, y = pages[k]
                node, edge = self.gradient(feats, y)
                g = np.zeros(DIM)
                for f, x in zip(feats, node, strict=True):
                    g[f] += x
                g -= 1e-3 * self.w * (g != 0)
                sum_w += g * g
                sum_t += edge * edge
                self.w += 0.3 * g / np.sqrt(sum_w)
                self.t += 0.3 * edge / np.sqrt(sum_t)
        return self

    def decode(self, feats: list[list[int]]) -> list[int]:
        """Most probable states (Viterbi)."""
        e = self.emissions(feats)[:, 1].tolist()
        (t00, t01), (t10, t11) = self.t.tolist()
        s0, s1, back = 0.0, e[0], []
        for x in e[1:]:
            p0, p1 = (0, s0 + t00) if s0 + t00 >= s1 + t10 else (1, s1 + t10), (0, s0 + t01) if s0 + t01 >= s1 + t11 else (1, s1 + t11)
            back.append((p0[0], p1[0]))
            s0, s1 = p0[1], p1[1] + x
        state = int(s1 > s0)
        path = [state]
        for b in reversed(back):
            state = b[state]
            path.append(state)
        return path[::-1]


def sample_texts(pages: DataFrame) -> list[str]:
    """Texts of blocks for training: see the bound above. Ties and repeated pages count
    once."""
    ids = pages.select("page_id").filter("page_id is not null").orderBy(F.xxhash64("page_id"), "page_id").limit(SAMPLE_PAGES).collect()
    rows = pages.select("html").filter(F.col("html").isNotNull() & F.col("page_id").isin(sorted({r[0] for r in ids})))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"text": [b.text for h in pdf["html"] for b in blocks(h) if len(b.text) <= SAMPLE_CHARS]}, dtype="object")

    found = rows.mapInPandas(run, "text string").distinct().orderBy(F.xxhash64("text"), "text").limit(SAMPLE_BLOCKS)
    return [r[0] for r in found.collect()]


def train(pages: DataFrame) -> Chain:
    """Fit on the labelled layouts, filled with texts of the table (plain words where
    it has none)."""
    return fit(sample_texts(pages))


def labelled(texts: list[str], **how) -> Iterator[tuple[list[Block], list[int]]]:
    """Blocks of the labelled layouts and their labels."""
    for page, labels in labelled_pages(texts, **how):
        found = blocks(page)
        marked = [labels[k] for b in found if (k := b.text.split(" ", 1)[0]) in labels]
        if len(marked) != len(found):
            raise ValueError("a layout has a block without a label")
        for b in found:  # the key word is no part of the text
            b.text = b.text.split(" ", 1)[1] if " " in b.text else b.text
        yield found, marked


def fit(texts: list[str]) -> Chain:
    return Chain().fit([(block_features(found), marked) for found, marked in labelled(texts) if found])


def main_text(page: str | None, model: Chain) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    states = model.decode(block_features(found))
    return "\n".join(b.text for b, s in zip(found, states, strict=True) if s)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of (page_id, url, html).

    Null or empty html, and pages without a main block, give the empty text; rows
    may repeat; an empty table gives an empty result; other columns are ignored."""
    sent = pages.sparkSession.sparkContext.broadcast(train(pages))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            text = [main_text(h, sent.value) for h in pdf["html"]]
            yield pd.DataFrame({"page_id": pdf["page_id"].astype("Int64"), "url": pdf["url"], "text": text, "n_chars": [len(t) for t in text]})

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInPandas(run, "page_id long, url string, text string, n_chars long")
