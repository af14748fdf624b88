"""Main text of web pages by a recurrent block labeller.

A page is read into its leaf blocks: runs of text between block-level tags, each with the path of
open elements above it. A block becomes a vector: the hashed tokens of its tag path (tag names,
and the words of classes, ids and roles), hashed words, and a few figures such as its length and
its share of link text. A bidirectional LSTM in numpy reads the vectors of a page from both ends
and classifies every block in the light of the whole page.

Training. Pages that say where their article is (an ``article`` or ``main`` element) label their own
blocks. ``SAMPLE_PAGES`` pages (the first by a hash of the id), of these the ones with at most
``SAMPLE_CHARS`` characters, are read for it; this bounds the fit alone. As one site's layout teaches
nothing about others, each page is also laid out anew (``redressed``): its article blocks under
other containers, between menus, sidebars, notices, adverts, forms and reader comments that
are filled with texts of other pages. All blocks of all pages are classified with the whole of
their text.

Defined cases: null and empty html, and pages without text, give the empty text; unclosed tags,
comments and scripts end with the page, and a lone ``<`` is text; white space is what Python's
``split`` parts at, after character references are decoded; a ``br`` is white space, any block-level
tag ends a block; repeated rows have one result each; ties cannot matter, as a block's class depends
on its own page; null ids are kept; further columns are not read; an empty table gives an empty one;
where no page names its article, all text of the sample counts as articles' in the new layouts.
"""

import html
import math
import random
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremora.llm.common import Memo, small_batches

#: Pages that the labeller is fitted on, and the longest of them.
SAMPLE_PAGES, SAMPLE_CHARS = 240, 40_000
#: Sizes of the hashed path and word vectors, and of the hidden state each way.
PATH, WORDS, HIDDEN = 384, 48, 24
FIGURES = 8
EPOCHS, BATCH_PAGES, RATE = 10, 32, 0.02
#: New layouts that the sampled pages are given, together.
LAID_OUT = 1600
LIMIT = 0.5

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose tags end a block; all others are part of the line.
BLOCK = frozenset("""address article aside blockquote body button center datalist dd details dialog
dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup
hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody
td tfoot th thead title tr ul""".split())
#: Elements whose content is no text of the page.
RAW = "script|style|noscript|template|textarea|iframe|object|svg|canvas|audio|video"
UNSEEN = frozenset("head title select datalist".split())
#: Elements that end an open item of their own kind, up to the nearest of ``_HOLDERS``.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_HOLDERS = frozenset("ul ol dl table tbody thead body".split())
#: Open elements that a path names, from the outside and from the inside.
DEPTH = 24

_REST = r"""(?>(?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*)"""
_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)"
    rf"|<(?P<raw>{RAW})\b{_REST}>(?:.*?</(?P=raw)\s*>|.*)"
    r"|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<rest>{_REST})(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.I | re.S)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Block:
    path: tuple[str, ...]  # tag and name tokens from the outside in
    text: str
    linked: int  # characters within links


def _tokens(tag: str, rest: str) -> tuple[str, ...]:
    """The tag and the words of its class, id and role: ``div``, ``.side``, ``.bar``."""
    out = [tag]
    if rest and "=" in rest:
        for value in _NAMES.findall(rest):
            out += ["." + w.lower() for w in _PARTS.findall(value)]
    return tuple(out)


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page, in order."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    opened: Counter = Counter()
    parts: list[str] = []
    linked = 0
    names = Memo(lambda key: _tokens(*key), 2_000)

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                near = stack if len(stack) <= 2 * DEPTH else stack[:DEPTH] + stack[-DEPTH:]
                out.append(Block(tuple(t for _, tokens in near for t in tokens), text,
                                 min(linked, len(text))))
            parts.clear()
        linked = 0

    def pop_to(size: int) -> None:
        while len(stack) > size:
            opened[stack.pop()[0]] -= 1

    for match in _TOKEN.finditer(page):
        text = match["text"]
        if text is not None:
            if not any(opened[tag] for tag in UNSEEN):
                text = html.unescape(text)
                parts.append(text)
                if opened["a"]:
                    linked += len(text)
            continue
        tag = match["tag"]
        if tag is None:
            if match["raw"]:
                parts.append(" ")
            continue
        tag = tag.lower()
        if tag in BLOCK:
            flush()
        elif tag == "br":
            parts.append(" ")
        if match["end"]:
            if opened[tag]:  # of an element in the line, only up to the block that it stands in
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        pop_to(k)
                        break
                    if tag not in BLOCK and stack[k][0] in BLOCK:
                        break
            continue
        if tag in BLOCK:
            # it ends what is open in the line, and an open paragraph; items end their like
            while stack and (stack[-1][0] not in BLOCK or stack[-1][0] == "p"):
                pop_to(len(stack) - 1)
            if any(opened[t] for t in CLOSES.get(tag, ())):
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in CLOSES[tag]:
                        pop_to(k)
                    elif stack[k][0] in _HOLDERS:
                        break
            if tag == "body":  # an unclosed head ends here
                pop_to(1 if stack and stack[0][0] == "html" else 0)
        if tag not in VOID:
            opened[tag] += 1
            stack.append((tag, names[(tag, match["rest"])] if tag in BLOCK else ()))
    flush()
    return out


# --- blocks as vectors ------------------------------------------------------------------------

def _hash(token: str, size: int) -> int:
    return zlib.crc32(token.encode()) % size


def figures(block: Block, at: int, count: int) -> list[float]:
    text = block.text
    size = len(text)
    stops = sum(map(text.count, ".!?"))
    return [math.log1p(size) / 8, min(1.0, block.linked / size), min(1.0, 20 * stops / size),
            min(1.0, text.count(",") / size * 20), at / count,
            1.0 if text[-1] in ".!?:" else 0.0, min(1.0, len(block.path) / 16), 1.0]


class Vectors:
    """Block vectors in two parts: the path (a vector by path), and words with figures."""

    def __init__(self) -> None:
        self.word = Memo(lambda w: _hash(w, WORDS), 50_000)

    @staticmethod
    def path(path: tuple[str, ...]) -> np.ndarray:
        """The tokens; and as a tag's place says more, the last three elements by place."""
        row = np.zeros(PATH, np.float32)
        for token in path:
            row[_hash(token, PATH)] = 1.0
        for back, token in enumerate([t for t in path if not t.startswith(".")][-3:][::-1]):
            row[_hash(f"{back}{token}", PATH)] = 1.0
        return row

    def rest(self, page: list[Block]) -> np.ndarray:
        out = np.zeros((len(page), WORDS + FIGURES), np.float32)
        for k, block in enumerate(page):
            words = block.text.lower().split()
            counts = np.bincount([self.word[w] for w in words], minlength=WORDS)
            out[k, :WORDS] = np.sqrt(counts / len(words))
            out[k, WORDS:] = figures(block, k, len(page))
        return out

    def of(self, page: list[Block]) -> np.ndarray:
        if not page:
            return np.zeros((0, PATH + WORDS + FIGURES), np.float32)
        return np.concatenate([np.stack([self.path(b.path) for b in page]), self.rest(page)], 1)


class Gates:
    """What a labeller's inputs make of a block, both ways side by side: its vector times the input
    weights. The part of a path is worked out once per path."""

    def __init__(self, model: "Labeller", vectors: Vectors) -> None:
        weights = np.concatenate(model.inputs, 1)
        self.rest, self.shift = weights[PATH:], np.concatenate(model.shift)
        self.path = Memo(lambda path: vectors.path(path) @ weights[:PATH], 5_000)
        self.vectors = vectors

    def of(self, page: list[Block]) -> np.ndarray:
        if not page:
            return np.zeros((0, len(self.shift)), np.float32)
        return (np.stack([self.path[b.path] for b in page])
                + self.vectors.rest(page) @ self.rest + self.shift)


# --- the network ------------------------------------------------------------------------------

def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Labeller:
    """Weights: for each way inputs, recurrence and shift of the four gates; then the output."""
    inputs: list[np.ndarray]
    recurrence: list[np.ndarray]
    shift: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [*self.inputs, *self.recurrence, *self.shift, self.out, self.bias]


def new_labeller(size: int = PATH + WORDS + FIGURES, hidden: int = HIDDEN,
                 seed: int = 1) -> Labeller:
    r = np.random.default_rng(seed)

    def made(a, b):
        return (r.standard_normal((a, b)) * (1 / math.sqrt(a))).astype(np.float32)
    shift = np.zeros(4 * hidden, np.float32)
    shift[hidden:2 * hidden] = 1.0  # forget little at first
    return Labeller([made(size, 4 * hidden) * 2 for _ in range(2)],
                    [made(hidden, 4 * hidden) for _ in range(2)], [shift.copy(), shift.copy()],
                    made(2 * hidden, 1), np.zeros(1, np.float32))


def _layout(lengths: list[int]) -> tuple[np.ndarray, list[int]]:
    """Pages longest first, and how many of them have a block at each step."""
    order = np.argsort([-n for n in lengths], kind="stable")
    longest = max(lengths)
    alive = [0] * longest
    for n in lengths:
        alive[n - 1] += 1
    for k in range(longest - 2, -1, -1):
        alive[k] += alive[k + 1]
    return order, alive


def _one_way(x: np.ndarray, alive: list[int], w: np.ndarray, keep: list | None = None) -> np.ndarray:
    """The states of one direction; ``x`` (step, page, gates) already holds inputs and shift."""
    hidden = w.shape[0]
    h = np.zeros((x.shape[1], hidden), np.float32)
    c = np.zeros_like(h)
    states = np.zeros((x.shape[0], x.shape[1], hidden), np.float32)
    for t, n in enumerate(alive):
        before_h, before_c = h[:n], c[:n]
        z = x[t, :n] + before_h @ w
        gates = _sigmoid(z[:, :3 * hidden])
        i, f, o = gates[:, :hidden], gates[:, hidden:2 * hidden], gates[:, 2 * hidden:]
        g = np.tanh(z[:, 3 * hidden:])
        c = f * before_c + i * g
        tanh_c = np.tanh(c)
        h = o * tanh_c
        states[t, :n] = h
        if keep is not None:
            keep.append((before_h, before_c, i, f, o, g, tanh_c))
    return states


def _padded(pages: list[np.ndarray], order: np.ndarray, steps: int, back: bool) -> np.ndarray:
    out = np.zeros((steps, len(pages), pages[0].shape[1]), np.float32)
    for place, k in enumerate(order):
        page = pages[k]
        out[:len(page), place] = page[::-1] if back else page
    return out


def scores(model: Labeller, gates: list[np.ndarray]) -> list[np.ndarray]:
    """The probability of main text for every block of every page, from the pages' ``Gates``."""
    out = [np.zeros(0, np.float32)] * len(gates)
    filled = [k for k, p in enumerate(gates) if len(p)]
    if not filled:
        return out
    order, alive = _layout([len(gates[k]) for k in filled])
    total = [np.zeros(len(gates[k]), np.float32) for k in filled]
    hidden = model.recurrence[0].shape[0]
    for way in range(2):
        x = _padded([gates[k][:, 4 * hidden * way:4 * hidden * (way + 1)] for k in filled], order,
                    len(alive), way == 1)
        states = _one_way(x, alive, model.recurrence[way])
        part = model.out[way * hidden:(way + 1) * hidden, 0]
        for place, k in enumerate(order):
            mine = states[:len(total[k]), place] @ part
            total[k] += mine[::-1] if way else mine
    for k, value in zip(filled, total):
        out[k] = _sigmoid(value + model.bias[0])
    return out


def labels_of(pages: list[list[Block]], model: Labeller, gates: Gates,
              most: int = 20_000) -> list[np.ndarray]:
    """``scores`` of the pages, with about ``most`` blocks (or one page) in hand at a time."""
    out: list[np.ndarray] = []
    at = 0
    while at < len(pages):
        stop, size = at + 1, len(pages[at])
        # pages side by side take as much room as the longest of them
        longest = size
        while stop < len(pages) and max(longest, len(pages[stop])) * (stop + 1 - at) <= most:
            longest = max(longest, len(pages[stop]))
            stop += 1
        out += scores(model, [gates.of(p) for p in pages[at:stop]])
        at = stop
    return out


def _gradients(model: Labeller, pages: list[np.ndarray], labels: list[np.ndarray]) -> list[np.ndarray]:
    """Of the mean log loss over blocks, in the order of ``Labeller.arrays``."""
    order, alive = _layout([len(p) for p in pages])
    steps, hidden = len(alive), model.recurrence[0].shape[0]
    xs, kept, states = [], [], []
    for way in range(2):
        x = _padded(pages, order, steps, way == 1)
        keep: list = []
        states.append(_one_way(x @ model.inputs[way] + model.shift[way], alive,
                               model.recurrence[way], keep))
        xs.append(x)
        kept.append(keep)
    d_states = [np.zeros_like(s) for s in states]
    d_out, d_bias, count = np.zeros_like(model.out), 0.0, sum(len(p) for p in pages)
    for place, k in enumerate(order):
        n = len(pages[k])
        both = np.concatenate([states[0][:n, place], states[1][:n, place][::-1]], 1)
        wrong = (_sigmoid(both @ model.out[:, 0] + model.bias[0]) - labels[k]) / count
        d_out[:, 0] += both.T @ wrong
        d_bias += wrong.sum()
        d_states[0][:n, place] += wrong[:, None] * model.out[:hidden, 0]
        d_states[1][:n, place] += wrong[::-1, None] * model.out[hidden:, 0]
    d_in, d_rec, d_shift = [], [], []
    for way in range(2):
        w = model.recurrence[way]
        dz_all = np.zeros((steps, len(pages), 4 * hidden), np.float32)
        d_w = np.zeros_like(w)
        d_h = np.zeros((len(pages), hidden), np.float32)
        d_c = np.zeros_like(d_h)
        for t in range(steps - 1, -1, -1):
            n = alive[t]
            before_h, before_c, i, f, o, g, tanh_c = kept[way][t]
            dh = d_states[way][t, :n] + d_h[:n]
            dc = dh * o * (1 - tanh_c ** 2) + d_c[:n]
            dz = np.concatenate([dc * g * i * (1 - i), dc * before_c * f * (1 - f),
                                 dh * tanh_c * o * (1 - o), dc * i * (1 - g ** 2)], 1)
            dz_all[t, :n] = dz
            d_w += before_h.T @ dz
            d_h[:n] = dz @ w.T
            d_c[:n] = dc * f
        flat = dz_all.reshape(-1, 4 * hidden)
        d_in.append(xs[way].reshape(len(flat), -1).T @ flat)
        d_rec.append(d_w)
        d_shift.append(flat.sum(0))
    return [*d_in, *d_rec, *d_shift, d_out, np.array([d_bias], np.float32)]


def train(pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS,
          batch: int = BATCH_PAGES, rate: float = RATE, seed: int = 1) -> Labeller:
    """Adam over batches of pages of like length; the same weights for the same pages."""
    model = new_labeller(seed=seed)
    weights = model.arrays()
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    r = random.Random(seed)
    known = [k for k in range(len(pages)) if len(pages[k])]
    known.sort(key=lambda k: len(pages[k]))
    groups = [known[at:at + batch] for at in range(0, len(known), batch)]
    step = 0
    for epoch in range(epochs):
        r.shuffle(groups)
        for group in groups:
            step += 1
            found = _gradients(model, [pages[k] for k in group], [labels[k] for k in group])
            size = math.sqrt(sum(float((g * g).sum()) for g in found))
            for w, g, a, b in zip(weights, found, first, second):
                g = g * min(1.0, 5.0 / max(size, 1e-9))
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                fade = rate * (1 - epoch / epochs) / (1 - 0.9 ** step)
                w -= fade * a / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8) + rate * 1e-4 * w
    return model


def shuffled_words(pages: list[np.ndarray], seed: int = 1) -> list[np.ndarray]:
    """Every other page with its word numbers dealt anew, as other sites use other words."""
    r = np.random.default_rng(seed)
    out = []
    for k, page in enumerate(pages):
        if k % 2:
            order = PATH + r.permutation(WORDS)
            page = np.concatenate([page[:, :PATH], page[:, order], page[:, PATH + WORDS:]], 1)
        out.append(page)
    return out


# --- what it learns from ----------------------------------------------------------------------

_OUTER = {"article", "main"}
_ASIDE = {"nav", "aside", "footer", "form", "button", "menu", "dialog"}


def own_labels(page: list[Block]) -> list[int] | None:
    """1 for blocks of the article that the page itself names; None where it names none."""
    marks = [int(bool(_OUTER & set(b.path)) and not _ASIDE & set(b.path)) for b in page]
    return marks if any(marks) else None


#: Containers that pages put their article in, as elements with class or id names.
LAYOUTS = [
    "article", "main", "main|article", "div.content", "div#content", "div.main-content",
    "div.post|div.post-content", "div.entry|div.entry-content", "section.story|div.story-body",
    "div#main|div.article-body", "div.wrapper|div.text", "div.page|div.body-text", "div|div",
    "section|div", "div.container|article.post", "main#main|section.content",
    "td.content", "div.column|div.article", "article|section", "article|div.prose", "",
]
#: Elements around the article that are none of it: containers, tags of their blocks, and how many.
EXTRAS = {
    "before": [
        ("nav|ul", "li", (3, 8), "short"), ("div.menu|ul", "li", (3, 8), "short"),
        ("header|nav|ul", "li", (3, 7), "short"), ("header", "div", (1, 3), "short"),
        ("header", "", (1, 1), "short"), ("div.logo", "", (1, 1), "short"),
        ("div#header", "div", (1, 3), "short"), ("div.top-bar", "span", (1, 2), "short"),
        ("div.breadcrumbs", "span", (1, 1), "short"), ("div.cookie-notice", "p", (1, 2), "any"),
        ("div#cookie-banner", "p", (1, 2), "any"), ("div.notice", "p", (1, 2), "any"),
        ("div.alert", "p", (1, 1), "any"), ("div.consent|div", "p", (1, 2), "any"),
        ("div.ad", "", (1, 1), "any"), ("div.advert", "p", (1, 1), "any"),
        ("div.banner-ad", "", (1, 1), "any"), ("aside.sidebar", "p", (1, 4), "any"),
        ("div#sidebar|ul", "li", (3, 7), "short"), ("form.search", "label", (1, 2), "short"),
    ],
    "within": [
        ("div.ad", "", (1, 1), "any"), ("div.advertisement", "p", (1, 1), "any"),
        ("aside", "p", (1, 2), "any"), ("div.related|ul", "li", (2, 5), "short"),
        ("div.share|ul", "li", (2, 4), "short"), ("div.promo", "p", (1, 2), "any"),
        ("div.sponsored", "p", (1, 1), "any"), ("form.newsletter", "p", (1, 2), "any"),
        ("nav.toc|ol", "li", (2, 5), "short"), ("div.social", "", (1, 1), "short"),
    ],
    "after": [
        ("footer", "p", (1, 3), "any"), ("div#footer", "p", (1, 3), "any"),
        ("footer|ul", "li", (2, 6), "short"), ("div.footer|div", "", (1, 2), "short"),
        ("section#comments|ol|li.comment", "p", (1, 5), "long"),
        ("div.comments|div.comment", "p", (1, 5), "long"),
        ("div#disqus|div.reply", "p", (1, 4), "long"),
        ("section.reader-comments|article.comment", "p", (1, 4), "long"),
        ("form.comment-form", "label", (1, 4), "short"), ("form", "p", (1, 3), "any"),
        ("div.newsletter|form", "p", (1, 2), "any"), ("aside.sidebar", "p", (1, 4), "any"),
        ("aside", "li", (2, 6), "short"), ("div.sidebar|ul", "li", (2, 6), "short"),
        ("div.related|ul", "li", (2, 5), "short"), ("div.widget", "p", (1, 3), "any"),
        ("div.cookie-banner", "p", (1, 2), "any"), ("div.popup", "p", (1, 2), "any"),
        ("div.modal|div.consent", "p", (1, 2), "any"), ("div.ads", "", (1, 1), "any"),
        ("nav.pagination|ul", "li", (1, 3), "short"), ("div.author-bio", "p", (1, 1), "any"),
        ("div.legal", "p", (1, 2), "any"), ("div.copyright", "", (1, 1), "short"),
    ],
}
#: What blocks of an article are, by weight.
INSIDE = (["p"] * 24 + ["h2", "h3", "ul|li", "ol|li", "blockquote|p", "blockquote", "div",
                        "section|p", "pre", "figure|figcaption", "table|tbody|tr|td", "dl|dd"])


def _path(text: str) -> tuple[str, ...]:
    """``div.side-bar|p`` as the tokens that ``blocks`` gives."""
    out: list[str] = []
    for part in filter(None, text.split("|")):
        tag, *names = re.split(r"[.#]", part)
        out += _tokens(tag, f'class="{" ".join(names)}"' if names else "")
    return tuple(out)


def redressed(body: list[Block], pool: dict[str, list[str]], r: random.Random
              ) -> tuple[list[Block], list[int]]:
    """The article blocks of a page in another layout, with other things around them."""
    root = ("html", "body") + _path(r.choice(["", "", "", "div", "div#page", "div.wrapper|div"]))
    home = root + _path(r.choice(LAYOUTS))
    out: list[tuple[Block, int]] = []

    def extra(where: str, at: tuple[str, ...]) -> None:
        path, tag, (least, most), kind = r.choice(EXTRAS[where])
        if r.random() < 0.25:
            out.append((Block(at + _path(path.split("|")[0]) + _path(r.choice(["h2", "h3", "h4"])),
                              r.choice(pool["brief"]), 0), 0))
        for _ in range(r.randint(least, most)):
            text = r.choice(pool[kind])
            share = 1.0 if kind == "short" and r.random() < 0.8 else r.choice([0.0, 0.0, 0.3])
            out.append((Block(at + _path(path) + _path(tag), text, int(share * len(text))), 0))

    for _ in range(r.randint(0, 3)):
        extra("before", root)
    bare = home == root
    for k, block in enumerate(body):
        if k == 0:
            tag = r.choice(["h1", "h1", "h1", "h2", "header|h1", "p"])
        else:
            tag = r.choice(INSIDE)
            if not bare and r.random() < 0.08:
                extra("within", home)
        brief = tag not in ("p", "h1") and r.random() < 0.6 or r.random() < 0.04
        for _ in range(r.randint(2, 6) if brief and tag.endswith(("li", "td", "dd")) else 1):
            text = r.choice(pool["brief"]) if brief else block.text
            out.append((Block(home + _path(tag), text, 0 if r.random() < 0.9 else min(
                len(text), 12)), 1))
    for _ in range(r.randint(0, 4)):
        extra("after", home if not bare and r.random() < 0.25 else root)
    return [b for b, _ in out], [m for _, m in out]


def lessons(pages: list[list[Block]], seed: int = 1, layouts: int = LAID_OUT
            ) -> tuple[list[list[Block]], list[list[int]]]:
    """Labelled pages: those that label themselves, and about ``layouts`` new layouts of them."""
    r = random.Random(seed)
    marked = [(p, own_labels(p)) for p in pages if p]
    each = -(-layouts // max(1, len(marked)))
    body = [[b for b, m in zip(p, marks) if m] if marks else p for p, marks in marked]
    long_texts = [b.text for p in body for b in p if len(b.text) >= 40] or ["text"]
    others = [b.text for p, marks in marked if marks for b, m in zip(p, marks) if not m]
    brief = [" ".join(t.split()[:r.randint(1, 4)]) for t in long_texts[:2000]]
    pool = {"short": [t for t in others if len(t) < 40][:2000] + brief, "brief": brief,
            "long": long_texts, "any": others[:2000] + [
                " ".join(t.split()[:r.randint(4, 30)]) for t in long_texts[:2000]]}
    out, labels = [], []
    for (page, marks), main in zip(marked, body):
        if marks:
            out.append(page)
            labels.append(marks)
        for _ in range(each):
            cut = main[:r.randint(1, len(main))] if r.random() < 0.5 else main
            laid, found = redressed(cut[:60], pool, r)
            out.append(laid)
            labels.append(found)
    return out, labels


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
        sample_pages: int = SAMPLE_PAGES, sample_chars: int = SAMPLE_CHARS) -> Labeller:
    """A labeller from a bounded sample of ``pages``; the same for the same rows in any order."""
    mark = F.xxhash64(F.lit("lesson"), F.col(id_col))
    # the ids alone first, so that no task sends its own first pages to the driver
    last = (pages.select(mark.alias("mark")).distinct().orderBy("mark").limit(sample_pages)
            .agg(F.max("mark")).first()[0])
    text = F.col(html_col)
    rows = (pages.where((mark <= F.lit(last)) & (F.length(text) <= sample_chars))
            .select(mark.alias("mark"), text.alias("html")).distinct()
            .orderBy("mark", "html").limit(sample_pages).collect())
    found, marks = lessons([blocks(r.html) for r in rows])
    tool = Vectors()
    return train(shuffled_words([tool.of(p) for p in found]),
                 [np.array(m, np.float32) for m in marks])


def extract(pages: DataFrame, model: Labeller, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html", limit: float = LIMIT) -> DataFrame:
    """``page_id, url, text, n_chars, n_blocks, n_kept`` of every row of ``pages``."""
    small_batches(pages.sparkSession)
    spark = pages.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]

    def run(batches):
        gates = Gates(shared.value, Vectors())
        for batch in batches:
            found = [blocks(t) for t in batch.column(2).to_pylist()]
            marks = labels_of(found, shared.value, gates)
            kept = [[b.text for b, s in zip(p, m) if s >= limit] for p, m in zip(found, marks)]
            texts = ["\n".join(k) for k in kept]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([len(p) for p in found], pa.int64()),
                 pa.array([len(k) for k in kept], pa.int64())],
                ["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"])

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    return rows.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, "
                                "n_chars bigint, n_blocks bigint, n_kept bigint")
