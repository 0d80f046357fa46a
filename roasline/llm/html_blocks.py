"""HTML main-text extraction with a recurrent block labeller.

A page becomes its sequence of leaf blocks (runs of text between block-level tags).  Each leaf is a
vector: its tag path (tags, classes and ids of its ancestors, hashed), its words (hashed, averaged)
and its length and link share.  A bidirectional LSTM in NumPy reads the whole sequence, so every
block is judged in the context of the whole page, and labels each block main or not.

The network is trained here, on the driver, from `TRAIN_PAGES` labelled pages that a seeded layout
generator writes (a documented bound; nothing is read from the corpus); the weights are broadcast.
Pages are independent, so extraction is one pass without a shuffle.

Text: character references are decoded, white space inside a block becomes one space, blocks are
trimmed, empty ones skipped, and the main ones joined in page order by a blank line.  Scripts,
styles, comments and the head are not text.

Edge cases: null or empty html gives the empty text; markup cut off at the end is dropped, text
before it kept; unclosed and stray tags are closed or ignored as browsers do; repeated rows are
extracted each; null ids are carried; an empty table gives an empty result.  Extra columns of any
name are carried, but ones named like the added text and length columns are replaced by these.
Tags and attributes are read as browsers read them: a comment ends at `-->`, `--!>` or at once
(`<!-->`), a quote in an attribute counts only right after `=`.  Time is linear in the page, however
deep it is nested.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .flat import RangeHash, U64, Words, slices

PATH_DIM, WORD_DIM, EXTRA_DIM = 256, 32, 3
HIDDEN = 16
TRAIN_PAGES = 1500
EPOCHS = 14
UNNAMED = (0.0, 0.0, 0.0, 0.3, 1.0)  # shares of elements without a telling name, drawn for each training page
SEED = 42

# Element classes of HTML.
BLOCKS = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav noscript ol optgroup option p pre section select summary table tbody td textarea tfoot th thead tr ul".split())
VOID = frozenset("area base basefont bgsound br col embed frame hr img input link meta param source track wbr".split())
HIDDEN_TEXT = frozenset("head iframe script style svg template title".split())
FOREIGN = frozenset(("svg", "math"))
ENDS_P = BLOCKS - frozenset("body button caption html label legend noscript optgroup option select tbody td textarea tfoot th thead tr".split())
CLOSES = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dd dt", ("dl",)), "dd": ("dd dt", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}
# Attributes as HTML reads them: a quote counts only right after the equals sign.
ATTRS = r"""(?:[\s/]+|[^\s/>][^\s/>=]*(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*|(?=>)))?)*"""
TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    rf"|<(?P<raw>script|style|textarea|title|iframe|noframes)(?=[\s/>]){ATTRS}(?:>|\Z)(?P<body>.*?)(?:</(?P=raw)(?=[\s/>]|\Z)[^>]*(?:>|\Z)|\Z)"
    rf"|<(?P<close>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>{ATTRS})(?P<end>>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.I | re.S,
)
ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME = re.compile(r"[a-z]+", re.I)


class Leaf:
    """A leaf block; `path` holds the hashed tokens of its ancestors, one bit for each place of the vector."""

    __slots__ = ("path", "text", "linked")

    def __init__(self, path: int, text: str, linked: int):
        self.path, self.text, self.linked = path, text, linked


@lru_cache(4096)
def _names(tag: str, attrs: str) -> int:
    """The element's path bits: its tag, and the words of class, id and role marked as names; two places for every token."""
    tokens = {tag}
    for m in ATTR.finditer(attrs):
        tokens |= {"." + w.lower() for w in NAME.findall(m[2] or m[3] or m[4] or "")}
    bits = 0
    for token in tokens:
        for seed in (1, 2):
            bits |= 1 << xxhash.xxh64_intdigest(token, seed) % PATH_DIM
    return bits


def leaves(page: str) -> list[Leaf]:
    """Leaf blocks of a page in order."""
    stack: list[tuple[str, int]] = []  # open elements, each with the path bits down to it
    count: Counter[str] = Counter()  # open elements by tag, so that none is searched for in vain
    out: list[Leaf] = []
    buffer: list[str] = []
    linked, hidden = 0, 0

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                out.append(Leaf(stack[-1][1] if stack else 0, text, linked))
            buffer.clear()
        linked = 0

    def pop_to(place: int) -> None:
        nonlocal hidden
        if any(tag in BLOCKS for tag, _ in stack[place:]):
            flush()
        for tag, _ in stack[place:]:
            hidden -= tag in HIDDEN_TEXT
            count[tag] -= 1
        del stack[place:]

    def text(raw: str) -> None:
        nonlocal linked
        if not hidden and raw:
            plain = html.unescape(raw) if "&" in raw else raw
            buffer.append(plain)
            linked += len(plain) if count["a"] else 0

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        if m["raw"]:
            if m["raw"].lower() == "textarea":
                flush()
                buffer.append(html.unescape(m["body"]))
                stack.append(("textarea", (stack[-1][1] if stack else 0) | _names("textarea", "")))
                count["textarea"] += 1
                pop_to(len(stack) - 1)
            continue
        if not m["tag"] or not m["end"]:
            continue
        tag = m["tag"].lower()
        if m["close"]:
            for place in range(len(stack) - 1, -1, -1) if count[tag] else ():
                if stack[place][0] == tag:
                    pop_to(place)
                    break
            continue
        if tag == "br":
            buffer.append(" ")
            continue
        if tag in ENDS_P or tag in CLOSES:
            inner, outer = CLOSES.get(tag, ("", ()))
            wanted = {*inner.split(), "p"} if tag in ENDS_P else set(inner.split())
            for place in range(len(stack) - 1, -1, -1):
                if not any(count[t] for t in wanted):
                    break
                if stack[place][0] in wanted:
                    pop_to(place)
                elif stack[place][0] in outer or stack[place][0] == "button":
                    break
        if tag == "body" or tag in BLOCKS:
            if count["head"]:
                pop_to(next(place for place, (open_, _) in enumerate(stack) if open_ == "head"))
            flush()
        closed = tag in FOREIGN and m["attrs"].endswith("/")
        if tag not in VOID and not closed:
            stack.append((tag, (stack[-1][1] if stack else 0) | _names(tag, m["attrs"])))
            count[tag] += 1
            hidden += tag in HIDDEN_TEXT
    if at < len(page):
        text(page[at:])
    flush()
    return out


def features(blocks: list[Leaf]) -> np.ndarray:
    """(leaves, PATH_DIM + WORD_DIM + EXTRA_DIM)."""
    out = np.zeros((len(blocks), PATH_DIM + WORD_DIM + EXTRA_DIM), np.float32)
    if not blocks:
        return out
    bits = np.frombuffer(b"".join(leaf.path.to_bytes(PATH_DIM // 8, "little") for leaf in blocks), np.uint8)
    out[:, :PATH_DIM] = np.unpackbits(bits.reshape(len(blocks), -1), axis=1, bitorder="little")
    encoded = [leaf.text.encode("utf-8", "replace") for leaf in blocks]
    data = np.frombuffer(b"".join(encoded), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(e) for e in encoded])]).astype(np.int64)
    words = Words(data, offsets)
    place = (RangeHash(data, 3).of(words.start, words.end) % U64(WORD_DIM)).astype(np.int64)
    counts = np.bincount(words.row * WORD_DIM + place, minlength=len(blocks) * WORD_DIM).reshape(-1, WORD_DIM)
    out[:, PATH_DIM : PATH_DIM + WORD_DIM] = counts / np.maximum(words.count, 1)[:, None]
    out[:, -3] = np.log1p(words.count) / 5
    out[:, -2] = [leaf.linked / max(len(leaf.text), 1) for leaf in blocks]
    out[:, -1] = 1.0
    return out


# --- the network -----------------------------------------------------------------------------

def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(w: dict[str, np.ndarray], side: str, x: np.ndarray, mask: np.ndarray, keep: bool):
    """One direction over x (time, pages, dims); padded steps keep the state."""
    steps, pages, _ = x.shape
    h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
    inputs = (x.reshape(steps * pages, -1) @ w[side + "x"]).reshape(steps, pages, -1) + w[side + "b"]
    out, tape = np.zeros((steps, pages, HIDDEN), np.float32), []
    for t in range(steps):
        z = inputs[t] + h @ w[side + "h"]
        i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN :])
        m = mask[t][:, None]
        c_new = f * c + i * g
        squashed = np.tanh(c_new)
        if keep:
            tape.append((h, c, i, f, o, g, squashed, m))
        h, c = m * (o * squashed) + (1 - m) * h, m * c_new + (1 - m) * c
        out[t] = h
    return out, tape


def _backward(w: dict[str, np.ndarray], side: str, x: np.ndarray, tape: list, grad_out: np.ndarray, grads: dict[str, np.ndarray]) -> None:
    steps, pages, dims = x.shape
    dh, dc = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
    dz_all = np.zeros((steps, pages, 4 * HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        h, c, i, f, o, g, squashed, m = tape[t]
        dh = dh + grad_out[t]
        dho, dco = dh * m, dc * m
        dcn = dco + dho * o * (1 - squashed**2)
        dz = np.concatenate([dcn * g * i * (1 - i), dcn * c * f * (1 - f), dho * squashed * o * (1 - o), dcn * i * (1 - g**2)], axis=1)
        dz_all[t] = dz
        grads[side + "h"] += h.T @ dz
        dh, dc = dz @ w[side + "h"].T + dh * (1 - m), dcn * f + dc * (1 - m)
    flat = dz_all.reshape(steps * pages, -1)
    grads[side + "x"] += x.reshape(steps * pages, dims).T @ flat
    grads[side + "b"] += flat.sum(axis=0)


def _pad(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, mask = np.zeros((steps, len(pages), pages[0].shape[1]), np.float32), np.zeros((steps, len(pages)), np.float32)
    for n, p in enumerate(pages):
        x[: len(p), n], mask[: len(p), n] = p, 1
    return x, mask


def _reverse(x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Each page's steps in reverse order, padding still last."""
    out = np.zeros_like(x)
    for n, size in enumerate(mask.sum(axis=0).astype(int)):
        out[:size, n] = x[:size, n][::-1]
    return out


def _logits(w: dict[str, np.ndarray], x: np.ndarray, mask: np.ndarray, keep: bool = False):
    ahead, tape_a = _forward(w, "a", x, mask, keep)
    turned = _reverse(x, mask)
    back, tape_b = _forward(w, "z", turned, mask, keep)
    both = np.concatenate([ahead, _reverse(back, mask), x], axis=2)
    return both @ w["out"] + w["bias"], both, turned, tape_a, tape_b


def predict(w: dict[str, np.ndarray], pages: list[np.ndarray], group: int = 64) -> list[np.ndarray]:
    """A boolean per leaf for every page; pages of like length go together."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((n for n in range(len(pages)) if len(pages[n])), key=lambda n: len(pages[n]))
    start = 0
    while start < len(order):
        stop = start + 1
        while stop < len(order) and stop - start < group and (stop - start + 1) * len(pages[order[stop]]) <= 1 << 14:
            stop += 1
        part = order[start:stop]
        x, mask = _pad([pages[n] for n in part])
        scores = _logits(w, x, mask)[0]
        for k, n in enumerate(part):
            out[n] = scores[: len(pages[n]), k] > 0
        start = stop
    return out


# --- training pages -------------------------------------------------------------------------

# Names that layouts give to their parts.
PARTS_OUT = {
    "menu": "nav menu navbar navigation breadcrumb toc topbar tabs", "header": "header masthead banner logo top site-header",
    "footer": "footer copyright bottom legal site-footer colophon", "side": "sidebar side widget aside related recommended popular archive tags",
    "ad": "ad ads advert advertisement sponsor sponsored promo adbox banner-ad", "notice": "cookie notice consent alert banner-notice gdpr newsletter subscribe popup modal share social",
    "comments": "comments comment reply replies discussion respond comment-list disqus responses", "form": "form search login signup contact search-form",
}
PARTS_IN = "article content post entry main story body text post-content entry-content article-body page"
TAGS_OUT = {"menu": "nav div ul header", "header": "header div", "footer": "footer div", "side": "aside div section", "ad": "div aside section", "notice": "div aside section", "comments": "section div ol", "form": "form"}


def _layout(r: random.Random, unnamed: float = 0.0) -> tuple[str, list[bool]]:
    """A page and the label of each leaf, in order; a share `unnamed` of its elements has no telling name."""
    labels: list[bool] = []
    syllables = [a + b for a in "bdfghklmnprstvz" for b in ("a", "e", "i", "o", "u", "en", "er", "on", "th")]

    def words(low: int, high: int) -> str:
        return " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(r.randint(low, high))).capitalize() + r.choice([".", "", "!", " ***", "&amp;"])

    def untold(chance: float) -> str:
        """A class that tells nothing, as generated style sheets name them; main and other blocks get it alike."""
        if r.random() >= chance:
            return ""
        made = ["".join(r.choice(syllables) for _ in range(r.randint(1, 3))) for _ in range(r.randint(1, 3))]
        return f' class="{r.choice(["", "c-", "sc-", "u-"])}{r.choice(["__", "-", " "]).join(made)}"'

    def leaf(tag: str, main: bool, low: int, high: int, link: bool = False) -> str:
        labels.append(main)
        inner = words(low, high)
        inner = f'<a href="/x">{inner}</a>' if link else r.choice([inner, inner, f"<b>{inner}</b>", f"<span>{inner}<br></span>"])
        return f"<{tag}{untold(unnamed)}>{inner}" + (f"</{tag}>" if tag not in ("p", "li") or r.random() < 0.85 else "")

    def named(tag: str, names: str, inner: str, chance: float) -> str:
        name = r.choice(names.split())
        if r.random() < unnamed:
            return f"<{tag}{untold(0.7)}>{inner}</{tag}>"
        attr = f' {r.choice(["class", "class", "id"])}="{name}"' if r.random() < chance else ""
        return f"<{tag}{attr}>{inner}</{tag}>"

    def out_part(kind: str) -> str:
        tag = r.choice(TAGS_OUT[kind].split())
        if kind == "menu":
            inner = "".join(leaf("li", False, 1, 3, r.random() < 0.9) for _ in range(r.randint(2, 8)))
            inner = inner if tag == "ul" else f"<ul>{inner}</ul>"
        elif kind == "comments":
            inner = "".join(f'<{"li" if tag == "ol" else "div"}>' + leaf("p", False, 1, 40) + f'</{"li" if tag == "ol" else "div"}>' for _ in range(r.randint(1, 5)))
        elif kind == "form":
            inner = leaf("label", False, 1, 3) + "<input>" + leaf("button", False, 1, 2)
        elif r.random() < 0.5:
            labels.append(False)
            inner = words(1, 30)
        else:
            inner = "".join(leaf(r.choice(["p", "p", "li", "h3", "div"]), False, 1, 30, r.random() < 0.4) for _ in range(r.randint(1, 4)))
        plain = tag in ("nav", "header", "footer", "aside", "form")
        return named(tag, PARTS_OUT[kind], inner, 0.4 if plain else 1.0)

    def article() -> str:
        parts = [leaf("h1", True, 1, 9)] if r.random() < 0.85 else []
        for _ in range(r.choice([0, 1, 2, 3, 5, 8, 14, 30])):
            tag = r.choice(["p"] * 8 + ["h2", "blockquote", "pre", "ul", "table"])
            if tag == "ul":
                parts.append("<ul>" + "".join(leaf("li", True, 1, 12) for _ in range(r.randint(1, 4))) + "</ul>")
            elif tag == "table":
                parts.append("<table><tr>" + "".join(leaf("td", True, 1, 5) for _ in range(r.randint(1, 4))) + "</tr></table>")
            else:
                parts.append(leaf(tag, True, 1, r.choice([2, 10, 80])))
            if r.random() < 0.12:
                parts.append(out_part(r.choice(["ad", "side", "notice", "form", "menu"])))
        if r.random() < 0.15:
            parts.append(out_part(r.choice(["comments", "footer", "notice"])))
        body = "".join(parts)
        kind = r.random()
        if kind < 0.6:
            return named("article", PARTS_IN, body, 0.3)
        if kind < 0.8:
            return named("main", PARTS_IN, body, 0.3)
        return named(r.choice(["div", "section"]), PARTS_IN, body, 1.0)

    parts = [out_part(k) for k in r.sample(["menu", "header", "ad", "notice", "form", "side"], r.randint(0, 4))]
    core = article()
    wrapped = r.random()
    parts.append(f"<main>{core}</main>" if wrapped < 0.2 else f"<div><div>{core}</div></div>" if wrapped < 0.3 else core)
    parts += [out_part(k) for k in r.sample(["side", "comments", "footer", "notice", "ad", "menu"], r.randint(0, 4))]
    if unnamed and r.random() < 0.3:
        parts = ["<table><tr>" + "".join(f"<td>{p}</td>" for p in parts) + "</tr></table>"]
    cut = r.random() < 0.8
    page = f"<!DOCTYPE html><html><head><title>{words(1, 5)}</title><style>p{{}}</style></head><body>" + "".join(parts) + ("</body></html>" if cut else "")
    return page, labels


@lru_cache(4)
def train(pages: int = TRAIN_PAGES, epochs: int = EPOCHS, seed: int = SEED) -> dict[str, np.ndarray]:
    """Weights after `epochs` passes of Adam over `pages` generated pages."""
    r, draw = random.Random(seed), np.random.default_rng(seed)
    data = []
    while len(data) < pages:
        page, labels = _layout(r, r.choice(UNNAMED))
        found = leaves(page)
        if found and len(found) == len(labels):
            data.append((features(found), np.array(labels, np.float32)))
    dims = PATH_DIM + WORD_DIM + EXTRA_DIM
    w = {s + k: (draw.standard_normal(shape) * scale).astype(np.float32) for s in "az" for k, shape, scale in (("x", (dims, 4 * HIDDEN), 0.08), ("h", (HIDDEN, 4 * HIDDEN), 0.2))}
    for s in "az":
        w[s + "b"] = np.zeros(4 * HIDDEN, np.float32)
        w[s + "b"][HIDDEN : 2 * HIDDEN] = 1
    w["out"], w["bias"] = (draw.standard_normal(2 * HIDDEN + dims) * 0.1).astype(np.float32), np.zeros(1, np.float32)
    first, second, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    for epoch in range(epochs):
        order = sorted(draw.permutation(len(data)).tolist(), key=lambda n: len(data[n][0]) // 4)
        groups = [order[k : k + 32] for k in range(0, len(order), 32)]
        for k in draw.permutation(len(groups)):
            x, mask = _pad([data[n][0] for n in groups[k]])
            y = np.zeros(mask.shape, np.float32)
            for c, n in enumerate(groups[k]):
                y[: len(data[n][1]), c] = data[n][1]
            scores, both, turned, tape_a, tape_b = _logits(w, x, mask, keep=True)
            d = (_sigmoid(scores) - y) * mask / mask.sum()
            grads = {name: np.zeros_like(v) for name, v in w.items()}
            grads["out"] = np.tensordot(d, both, axes=([0, 1], [0, 1]))
            grads["bias"] = np.array([d.sum()], np.float32)
            db = d[:, :, None] * w["out"]
            _backward(w, "a", x, tape_a, db[:, :, :HIDDEN], grads)
            _backward(w, "z", turned, tape_b, _reverse(db[:, :, HIDDEN : 2 * HIDDEN], mask), grads)
            step += 1
            rate = 0.01 * (1 - 0.9 * epoch / epochs)
            for name in w:
                first[name] = 0.9 * first[name] + 0.1 * grads[name]
                second[name] = 0.99 * second[name] + 0.01 * grads[name] ** 2
                w[name] = w[name] - rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-7)
    return w


def main_texts(w: dict[str, np.ndarray], pages: list[str | None]) -> list[str]:
    """The main text of each page."""
    blocks = [leaves(p) if p else [] for p in pages]
    every = features([leaf for page in blocks for leaf in page])
    cuts = np.cumsum([0, *map(len, blocks)])
    marks = predict(w, [every[a:b] for a, b in zip(cuts, cuts[1:])])
    return ["\n\n".join(leaf.text for leaf, main in zip(page, mark) if main) for page, mark in zip(blocks, marks)]


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """All columns of `pages` but the html, plus the main text and its length in code points."""
    weights = pages.sparkSession.sparkContext.broadcast(train())
    carried = [c for c in pages.columns if c not in (html_col, text_col, chars_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, html_col, 1 << 20):
                texts = main_texts(weights.value, part.column(html_col).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(c) for c in carried] + [pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=[*carried, text_col, chars_col])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in carried] + [f"`{text_col}` string", f"`{chars_col}` long"])
    return pages.select(*[F.col(f"`{c}`") for c in (*carried, html_col)]).mapInArrow(run, schema)
