"""Main text of web pages by a recurrent block labeller.

A page is a sequence of blocks, the text between two block-level tags. A bidirectional
LSTM reads for every block a vector of its tag path (hashed tags with their class and id
words), one of its hashed words and some measures, so that each block is labelled with the
whole page in view. The labeller is trained here, on a bounded sample of pages: their own
blocks, labelled by the sectioning tags that the markup itself declares, and variants of
them in other layouts, with other names and with sidebars, notices, forms and comments.
Pages of any length are sampled; of a long one, windows of blocks spread over its main text
and over its other parts are learnt from, so that the sample stays bounded.

Defined cases
* Null and empty html, and pages without text, give an empty text.
* Unclosed tags, comments, scripts and styles run to the end of the page. Broken character
  references stay as they are. A page of any length is read whole.
* Rows that repeat a page_id are each extracted; null ids and urls are passed through.
* Without a page to learn from, the labeller is trained on variants of made-up words.
* Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import html
import pickle
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstone.llm.common import hash_sample

#: Pages the labeller is trained on, variants made of each, passes over them.
SAMPLE_PAGES, VARIANTS, PASSES = 200, 5, 3
PATH_SLOTS, WORD_SLOTS, WIDTH, HIDDEN, MEASURES = 2048, 4096, 16, 24, 6
#: Pages that are labelled together, and blocks of them at most unless a page has more.
TOGETHER, TOGETHER_BLOCKS = 256, 8192
CACHED_WORDS = 200_000
#: Of a page are learnt: so many blocks in so many windows, characters of their texts, names
#: on their paths. A page with more is extracted like any other.
LEARN_BLOCKS, WINDOWS, LEARN_CHARS, LEARN_NAMES = 1024, 8, 20_000, 20_000
MARK = "\x01"

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript|svg|iframe|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>|</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*>|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I,
)
_TAG = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME_WORD = re.compile(r"[A-Za-z]+")
# The HTML elements that stand inside a line, and those without content.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"},
           "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
           "option": {"option"}}
_ENDS_P = frozenset("div ul ol table section article h1 h2 h3 h4 h5 h6 form nav aside footer header blockquote pre".split())


def blocks_of(page: str | None) -> list[tuple[tuple[str, ...], str, float]]:
    """(tag path, text, share of its characters in links) of every block with text."""
    blocks: list[tuple[tuple[str, ...], str, float]] = []
    path: list[tuple[str, tuple[str, ...]]] = []
    texts: list[str] = []
    linked = links = 0

    def flush() -> None:
        nonlocal texts, linked
        if texts:
            text = " ".join(html.unescape("".join(texts)).split())
            if text:
                names = tuple(n for tag, own in path for n in (tag, *own))
                blocks.append((names, text, min(1.0, linked / max(1, len(text)))))
            texts, linked = [], 0

    page, at = page or "", 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            texts.append(page[at : token.start()])
            linked += (token.start() - at) if links else 0
        at = token.end()
        raw = token.group()
        tag = _TAG.match(raw)
        if tag is None or token.group(1):
            if token.group(1):
                flush()
            continue
        name = tag.group(1).lower()
        closing = raw[1] == "/"
        if name == "a":
            links = 0 if closing else 1
        if name in _INLINE:
            continue
        flush()
        if closing:
            for k in range(len(path) - 1, -1, -1):
                if path[k][0] == name:
                    del path[k:]
                    links = 0
                    break
        elif name not in _VOID:
            implied = _CLOSES.get(name, {"p"} if name in _ENDS_P else ())
            while path and path[-1][0] in implied:
                path.pop()
            own = "".join(" " + (a or b or c) for a, b, c in _NAMES.findall(raw)).lower()
            path.append((name, tuple("." + w for w in _NAME_WORD.findall(own))))
    if at < len(page):
        texts.append(page[at:])
    flush()
    return blocks


class Slots(dict):
    """Hash slots of names or words, kept up to a bound."""

    def __init__(self, slots: int):
        super().__init__()
        self.slots = slots

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = self[word] = zlib.crc32(word.encode("utf-8", "replace")) % self.slots
        return found


class Page:
    """The numbers the labeller sees of a page."""

    def __init__(self, blocks, names: Slots, words: Slots, measures: np.ndarray | None = None):
        self.paths = [[names[n] for n in path] or [0] for path, _, _ in blocks]
        self.words = [[words[w] for w in text.lower().split()] for _, text, _ in blocks]
        self.measures = measures_of(blocks) if measures is None else measures


def measures_of(blocks) -> np.ndarray:
    size = np.array([len(t) for _, t, _ in blocks], dtype=float)
    n = len(blocks)
    point = [sum(t.count(c) for c in ".!?") for _, t, _ in blocks]
    return np.stack([
        np.log1p(size) / 8, np.array([share for _, _, share in blocks]),
        np.arange(n) / max(1, n), np.minimum(np.array(point) / 5, 2.0),
        np.array([t[:1] in "©|•" for _, t, _ in blocks], dtype=float), np.ones(n),
    ], axis=1)


def _sums(table: np.ndarray, bags: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean rows of the table over each bag, with the slots and their weights."""
    count = np.array([len(b) for b in bags])
    flat = np.fromiter((x for b in bags for x in b), dtype=np.int64, count=int(count.sum()))
    row = np.repeat(np.arange(len(bags)), count)
    out = np.empty((len(bags), table.shape[1]), dtype=table.dtype)
    starts = np.concatenate([[0], np.cumsum(count)[:-1]])
    out = np.add.reduceat(table[flat], starts, axis=0) / count[:, None]
    return out.astype(np.float32), flat, row


class Labeller:
    """Embeddings, a forward and a backward LSTM, and a logistic output."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        wide = 2 * WIDTH + MEASURES
        draw = lambda *s, by: (rng.standard_normal(s) * by).astype(np.float32)
        self.p = {"path": draw(PATH_SLOTS, WIDTH, by=0.5), "word": draw(WORD_SLOTS, WIDTH, by=0.1),
                  "out": draw(2 * HIDDEN, by=0.2), "bias": np.zeros(1, np.float32)}
        for way in "fb":
            self.p["w" + way] = draw(wide + HIDDEN, 4 * HIDDEN, by=(wide + HIDDEN) ** -0.5)
            self.p["c" + way] = np.zeros(4 * HIDDEN, np.float32)
            self.p["c" + way][HIDDEN : 2 * HIDDEN] = 1  # remember at first

    def _inputs(self, pages: list[Page]):
        size = np.array([len(p.paths) for p in pages])
        x = np.zeros((int(size.max()), len(pages), 2 * WIDTH + MEASURES), np.float32)
        t = np.concatenate([np.arange(n) for n in size])
        b = np.repeat(np.arange(len(pages)), size)
        path, path_flat, path_row = _sums(self.p["path"], [q for p in pages for q in p.paths])
        word, word_flat, word_row = _sums(self.p["word"], [q or [0] for p in pages for q in p.words])
        x[t, b] = np.concatenate([path, word, np.concatenate([p.measures for p in pages])], axis=1)
        return x, size, (t, b), ((path_flat, path_row), (word_flat, word_row))

    def _run(self, x: np.ndarray, way: str):
        """Hidden states of one direction. x is padded at its end in reading order."""
        w, c = self.p["w" + way], self.p["c" + way]
        steps, n, _ = x.shape
        h, cell = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        kept, hidden = [], np.empty((steps, n, HIDDEN), np.float32)
        for t in range(steps):
            z = np.concatenate([x[t], h], axis=1)
            a = z @ w + c
            gate = 1 / (1 + np.exp(-a[:, : 3 * HIDDEN]))
            new = np.tanh(a[:, 3 * HIDDEN :])
            i, f, o = np.split(gate, 3, axis=1)
            before, cell = cell, f * cell + i * new
            tc = np.tanh(cell)
            h = o * tc
            kept.append((z, i, f, o, new, before, tc))
            hidden[t] = h
        return hidden, kept

    def _turned(self, x: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Every page's rows in reverse order, its padding still at the end."""
        t = np.arange(x.shape[0])[:, None]
        at = np.where(t < size, size - 1 - t, t)
        return np.take_along_axis(x, at[:, :, None], axis=0)

    def scores(self, pages: list[Page]):
        x, size, where, bags = self._inputs(pages)
        hf, kept_f = self._run(x, "f")
        hb, kept_b = self._run(self._turned(x, size), "b")
        h = np.concatenate([hf, self._turned(hb, size)], axis=2)[where]
        score = h @ self.p["out"] + self.p["bias"][0]
        return score, (x, size, where, bags, h, kept_f, kept_b)

    def slopes(self, pages: list[Page], labels: np.ndarray) -> dict[str, np.ndarray]:
        score, (x, size, where, bags, h, kept_f, kept_b) = self.scores(pages)
        d = (1 / (1 + np.exp(-score)) - labels) / len(labels)
        g = {"out": h.T @ d, "bias": np.array([d.sum()])}
        dh = np.zeros((*x.shape[:2], 2 * HIDDEN), np.float32)
        dh[where] = d[:, None] * self.p["out"]
        dx = self._back(g, "f", kept_f, dh[:, :, :HIDDEN])
        dx = dx + self._turned(self._back(g, "b", kept_b, self._turned(dh[:, :, HIDDEN:], size)), size)
        dx = dx[where]
        for name, at, (flat, row) in zip(("path", "word"), (0, WIDTH), bags):
            g[name] = np.zeros_like(self.p[name])
            share = dx[:, at : at + WIDTH] / np.bincount(row, minlength=len(dx))[:, None]
            np.add.at(g[name], flat, share[row])
        return g

    def _back(self, g: dict, way: str, kept: list, dh: np.ndarray) -> np.ndarray:
        w = self.p["w" + way]
        dw, dc = np.zeros_like(w), np.zeros_like(self.p["c" + way])
        dx = np.zeros((len(kept), dh.shape[1], w.shape[0] - HIDDEN), np.float32)
        next_h, next_c = np.zeros_like(dh[0]), np.zeros_like(dh[0])
        for t in range(len(kept) - 1, -1, -1):
            z, i, f, o, new, before, tc = kept[t]
            own = dh[t] + next_h
            cell = next_c + own * o * (1 - tc**2)
            da = np.concatenate([
                cell * new * i * (1 - i), cell * before * f * (1 - f),
                own * tc * o * (1 - o), cell * i * (1 - new**2),
            ], axis=1)
            dw += z.T @ da
            dc += da.sum(axis=0)
            dz = da @ w.T
            dx[t], next_h, next_c = dz[:, :-HIDDEN], dz[:, -HIDDEN:], cell * f
        g["w" + way], g["c" + way] = dw, dc
        return dx

    def fit(self, pages: list[Page], labels: list[np.ndarray], passes: int = PASSES,
            together: int = 16, rate: float = 0.01, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        spread = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(passes):
            order = rng.permutation(len(pages))
            for at in range(0, len(order), together):
                own = order[at : at + together]
                g = self.slopes([pages[k] for k in own], np.concatenate([labels[k] for k in own]))
                step += 1
                for k, v in g.items():
                    mean[k] = 0.9 * mean[k] + 0.1 * v
                    spread[k] = 0.999 * spread[k] + 0.001 * v**2
                    move = mean[k] / (1 - 0.9**step) / (np.sqrt(spread[k] / (1 - 0.999**step)) + 1e-8)
                    self.p[k] -= (rate * move).astype(np.float32)

    def main_blocks(self, pages: list[Page]) -> list[np.ndarray]:
        """Which blocks of each page are main text."""
        found: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((k for k, p in enumerate(pages) if p.paths), key=lambda k: len(pages[k].paths))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and end - at < TOGETHER and (
                len(pages[order[end]].paths) * (end + 1 - at) <= TOGETHER_BLOCKS
            ):
                end += 1
            own = order[at:end]
            score, _ = self.scores([pages[k] for k in own])
            cuts = np.cumsum([len(pages[k].paths) for k in own])[:-1]
            for k, part in zip(own, np.split(score > 0, cuts)):
                found[k] = part
            at = end
        return found


# --- training pages ------------------------------------------------------------------

# Usual names of page parts, for the made-up layouts.
MAIN_NAMES = "article content post entry story main body text blog news page single".split()
PARTS = {
    "nav": "nav menu navbar navigation breadcrumb topbar links tabs".split(),
    "header": "header masthead banner top logo branding".split(),
    "footer": "footer bottom copyright legal colophon".split(),
    "aside": "sidebar aside widget related recommended popular rail trending more".split(),
    "div": "ad ads advert advertisement sponsor promo banner-ad".split(),
    "notice": "notice cookie consent alert gdpr popup modal newsletter subscribe".split(),
    "comments": "comments comment responses discussion replies disqus reader-comments".split(),
    "form": "form search login signup contact subscribe".split(),
    "share": "share social tags meta byline author pagination".split(),
}
_MAIN, _CHROME = frozenset({"article", "main"}), frozenset({"nav", "footer", "header", "aside", "form"})


def declared_labels(blocks) -> np.ndarray:
    """1 for blocks in an article or main element and in no part that names itself else."""
    others = {"." + n for names in PARTS.values() for n in names}
    return np.array([
        float(bool(_MAIN & set(path)) and not (_CHROME | others) & set(path)) for path, _, _ in blocks
    ])


def variant(rng: np.random.Generator, main: list[str], other: list[str]) -> str:
    """A page of another layout; its main text is marked."""
    esc = lambda t: html.escape(t, quote=False)
    pick = lambda x: x[int(rng.integers(len(x)))]
    some = lambda n: " ".join(pick(other).split()[: int(rng.integers(1, n))]) or "x"
    chance = lambda p: rng.random() < p

    def part(kind: str) -> str:
        name, attr = pick(PARTS[kind]), pick(["class", "id"])
        tag = kind if kind in _CHROME and chance(0.6) else pick(["div", "div", "section", "aside"])
        named = f' {attr}="{name}"' if tag not in _CHROME or chance(0.5) else ""
        if kind in ("nav", "share") or (kind in ("aside", "footer") and chance(0.5)):
            body = "<ul>" + "".join(f'<li><a href="/{k}">{esc(some(4))}</a></li>' for k in range(int(rng.integers(2, 9)))) + "</ul>"
            if kind == "aside":
                body = f"<h3>{esc(some(5))}</h3>" + body
        elif kind == "form":
            body = f"<label>{esc(some(4))}</label><input type=text><button>{esc(some(3))}</button>"
        elif kind == "comments":
            item = lambda: f'<{k}><p>{esc(some(40))}</p></{k}>'
            k = pick(["div", "li", 'div class="comment"'.split()[0]])
            body = f"<h3>{esc(some(4))}</h3>" + "".join(item() for _ in range(int(rng.integers(1, 5))))
        else:
            long = some(60)
            body = esc(long) if chance(0.5) else "".join(f"<p>{esc(some(30))}</p>" for _ in range(int(rng.integers(1, 4))))
        return f"<{tag}{named}>{body}</{tag}>"

    parts = [k for k in PARTS if k != "share"]
    before = "".join(part(k) for k in ("header", "nav", "div", "notice", "aside", "form") if chance(0.45))
    after = "".join(part(k) for k in ("share", "comments", "aside", "div", "form", "notice", "footer") if chance(0.45))
    title, *paras = main
    text = f"<h1>{MARK}{esc(title)}</h1>" if chance(0.85) else f"<div>{MARK}{esc(title)}</div>"
    for para in paras:
        if chance(0.06):
            text += part(pick(parts))
        tag = pick(["p"] * 12 + ["blockquote", "div", "h2", "li"])
        if tag == "h2":
            para = " ".join(para.split()[:8])
        if not para.strip():
            continue
        text += f"<ul><li>{MARK}{esc(para)}</li></ul>" if tag == "li" else f"<{tag}>{MARK}{esc(para)}</{tag}>"
    inner = "".join(part(k) for k in ("share", "comments", "div", "aside") if chance(0.15))
    how = rng.random()
    if how < 0.45:
        named = f' class="{pick(MAIN_NAMES)}"' if chance(0.4) else ""
        body = f"<article{named}>{text}{inner}</article>"
    elif how < 0.6:
        body = f"<main>{text}{inner}</main>"
    else:
        body = f'<div {pick(["class", "id"])}="{pick(MAIN_NAMES)}">{text}{inner}</div>'
    if chance(0.3):
        body = f'<div class="{pick(["wrapper", "container", "row", "layout", "site"])}">{before}{body}{after}</div>'
    else:
        body = before + body + after
    return f"<html><head><title>x</title></head><body>{body}</body></html>"


def _spread(n: int, most: int) -> np.ndarray:
    """At most ``most`` of n places, evenly spread, the first and the last among them."""
    return np.arange(n) if n <= most else np.unique(np.linspace(0, n - 1, most).astype(int))


def lesson(page: str | None):
    """(blocks, labels, measures) to learn from a page, of bounded size.

    Short pages are whole. Of more blocks, half of the windows are spread over those labelled
    as main text and half over the others. Measures are those within the whole page.
    """
    blocks = blocks_of(page)
    labels = declared_labels(blocks)
    if not labels.any():
        return [], labels[:0], np.zeros((0, MEASURES))
    measures = measures_of(blocks)
    if len(blocks) > LEARN_BLOCKS:
        sides = [np.flatnonzero(labels == y) for y in (1, 0)]
        middles = [side[k] for side in sides for k in _spread(len(side), WINDOWS // 2)]
        wide = LEARN_BLOCKS // WINDOWS
        at = np.concatenate([np.arange(m - wide // 2, m + wide // 2) for m in middles])
        at = np.unique(at[(at >= 0) & (at < len(blocks))])
        blocks, labels, measures = [blocks[k] for k in at], labels[at], measures[at]
    if sum(len(t) for _, t, _ in blocks) > LEARN_CHARS:
        most = LEARN_CHARS // len(blocks)
        blocks = [(path, _some_words(text, most), share) for path, text, share in blocks]
    if sum(len(path) for path, _, _ in blocks) > LEARN_NAMES:
        most = LEARN_NAMES // len(blocks)
        blocks = [(tuple(path[k] for k in _spread(len(path), most)), *rest) for path, *rest in blocks]
    return blocks, labels, measures


def _some_words(text: str, chars: int) -> str:
    """Words spread over a text that is longer than so many characters."""
    if len(text) <= chars:
        return text
    words = text.split()
    some = " ".join(words[k] for k in _spread(len(words), max(1, chars * len(words) // len(text))))
    return some[:chars]  # a word may be longer than all others together


def train(pages: list[str], seed: int = 3) -> Labeller:
    """A labeller fitted on the pages and on variants of them."""
    return fitted([lesson(page) for page in pages], seed)


def fitted(lessons: list, seed: int = 3) -> Labeller:
    rng = np.random.default_rng(seed)
    names, words = Slots(PATH_SLOTS), Slots(WORD_SLOTS)
    seen, labels, pool, articles = [], [], [], []
    for blocks, own, measures in lessons:
        if own.any():
            seen.append(Page(blocks, names, words, measures))
            labels.append(own)
            articles.append([t for (_, t, _), y in zip(blocks, own) if y])
            pool.extend(t for _, t, _ in blocks)
    if not articles:
        made = lambda n: " ".join("w" + str(k) for k in rng.integers(0, 999, n))
        articles = [[made(int(n)) for n in rng.integers(4, 60, 8)] for _ in range(50)]
        pool = [t for a in articles for t in a]
    for article in articles:
        for _ in range(VARIANTS):
            blocks = blocks_of(variant(rng, article[:40], pool))
            marked = np.array([MARK in t for _, t, _ in blocks], dtype=float)
            clean = [(p, t.replace(MARK, ""), s) for p, t, s in blocks]
            seen.append(Page(clean, names, words))
            labels.append(marked)
    labeller = Labeller()
    labeller.fit(seen, labels)
    return labeller


def main_texts(labeller: Labeller, pages: list[str | None], names: Slots, words: Slots) -> list[str]:
    found = [blocks_of(p) for p in pages]
    main = labeller.main_blocks([Page(b, names, words) for b in found])
    return ["\n".join(t for (_, t, _), y in zip(b, own) if y) for b, own in zip(found, main)]


def extract(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """(page_id, url, text) of every page."""
    learnable = pages.where("length(html) > 0")

    @F.pandas_udf("binary")
    def learnt(part: pd.Series) -> pd.Series:
        return part.map(lambda page: pickle.dumps(lesson(page)))

    # only the lessons of the pages whose keys hash low are made, sorted and sent
    lessons = learnable.select("page_id", "url", learnt("html").alias("lesson"))
    sample = hash_sample(lessons, ["page_id", "url"], sample_pages, learnable.count())
    labeller = fitted([pickle.loads(r["lesson"]) for r in sample.select("lesson").collect()])
    shared = pages.sparkSession.sparkContext.broadcast(labeller)  # of fixed size

    @F.pandas_udf("string")
    def text_of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names, words = Slots(PATH_SLOTS), Slots(WORD_SLOTS)
        for part in parts:
            rows = part.tolist()
            out: list[str] = []
            for at in range(0, len(rows), TOGETHER):
                out += main_texts(shared.value, rows[at : at + TOGETHER], names, words)
            yield pd.Series(out, dtype=object)

    return pages.select("page_id", "url", text_of(F.col("html")).alias("text"))
