"""Main text of web pages: a recurrent labeller over the sequence of leaf blocks.

A page becomes its leaf blocks in page order: stretches of text between block-level tags, with
the path of open tags above them (names, classes, ids, roles). Scripts, styles, comments,
titles, drawings and selection lists are no text; character references are decoded; white space inside a block is one space.
A numpy bidirectional LSTM reads, for every block, hashed vectors of its tag path and its words
and a few counts, and labels the block with the whole page as context. Pages run through it in
batches of similar length.

The labeller is trained here on ``TRAINING_PAGES`` pages composed by rule: article, menus,
headers, footers, sidebars, notices, adverts, forms and comments in random order and nesting,
with random names. Training is seeded and needs no given page, so every run has the same model.

Null, empty and textless pages give an empty text. Unclosed, stray and unknown tags are
tolerated. Very long pages are labelled whole. Repeated rows give equal results; null ids and
URLs are carried. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import html as entities
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

TRAINING_PAGES, ROUNDS, SEED = 800, 6, 7
LONG_PAGES = ((240, 12), (64, 60), (32, 400))  # more of them: how many, blocks of an article at most
PATH_BINS, WORD_BINS, HIDDEN = 128, 64, 16
BATCH = 256  # pages
# Tags that cannot stand inside a title, svg or select: they end one that was left open.
_BLOCK = r"</?(?:html|head|body|article|main|section|header|footer|nav|aside|div|p|h[1-6]|ul|ol|li|dl|dt|dd|table|form|fieldset|figure|figcaption|blockquote|pre|address|details|center)(?=[\s/>])"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template)(?=[\s/>])[^>]*>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    r"|<svg(?=[\s/>])[^>]*/>"
    rf"|<svg(?=[\s/>])[^>]*>(?:<foreignobject(?=[\s/>]).*?</foreignobject\s*>|(?!</svg(?=[\s/>])|{_BLOCK}).)*(?:</svg(?=[\s/>])[^>]*>)?"
    rf"|<(?:select|title)(?=[\s/>])[^>]*>(?:(?!</(?:select|title)(?=[\s/>])|<(?:meta|link|base|script|style)(?=[\s/>])|{_BLOCK}).)*(?:</(?:select|title)(?=[\s/>])[^>]*>)?"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<[!?][^>]*>",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br img".split())
VOID = set("area base br col embed hr img input link meta source track wbr".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


def blocks(page: str) -> list[tuple[str, tuple[str, ...], float]]:
    """(text, names of the tag path, share of the text inside links) of every leaf block."""
    out: list[tuple[str, tuple[str, ...], float]] = []
    stack: list[tuple[str, list[str]]] = []
    text: list[str] = []
    linked, links, at = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        joined = " ".join(entities.unescape("".join(text)).split())
        if joined:
            out.append((joined, tuple(n for _, names in stack for n in names), min(1.0, linked / len(joined))))
        text.clear()
        linked = 0

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            text.append(page[at : m.start()])
            linked += (m.start() - at) * (links > 0)
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        if tag == "a":
            links = max(0, links + (-1 if m[2] else 1))
        if tag in INLINE:
            if tag in ("br", "img", "wbr"):
                text.append(" ")
            continue
        flush()
        links = 0
        if tag == "head":  # its tags have no text; what cannot stand in it belongs to the body
            continue
        if m[2]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        while stack and stack[-1][0] in CLOSES.get(tag, {"p"} if tag not in VOID else ()):
            stack.pop()
        if tag not in VOID:
            names = [tag]
            for a in _NAMES.finditer(m[4]):
                names += _WORD.findall((a[1] or a[2] or a[3] or "").lower())
            stack.append((tag, names))
    if at < len(page):
        text.append(page[at:])
    flush()
    return out


@functools.lru_cache(1 << 16)
def _bin(word: str, bins: int) -> tuple[int, float]:
    h = zlib.crc32(word.encode())
    return h % bins, 1.0 if h & 0x10000 else -1.0


def vectors(found: list[tuple[str, tuple[str, ...], float]]) -> np.ndarray:
    """The input of the labeller for each block of a page."""
    x = np.zeros((len(found), PATH_BINS + WORD_BINS + 7), np.float32)
    for row, (text, path, linked) in zip(x, found):
        for k, name in enumerate(reversed(path)):
            b, sign = _bin(name, PATH_BINS)
            row[b] += sign * (1.0 if k < 4 else 0.5)
        words = text.lower().split()
        for word in words:
            b, sign = _bin(word.strip(".,:;!?"), WORD_BINS)
            row[PATH_BINS + b] += sign
        row[PATH_BINS : PATH_BINS + WORD_BINS] /= max(1.0, np.sqrt(len(words)) * 2)
        stops = sum(text.count(c) for c in ".!?")
        row[-7:] = (
            np.log1p(len(words)) / 4, linked, min(1.0, stops / max(1, len(words)) * 8), float(text[-1] in ".!?…"),
            float(len(words) < 4), "©" in text or "copyright" in text.lower(), 1.0,
        )
    return x


class Labeller:
    """Bidirectional LSTM with a logistic output, forward and backward passes in numpy."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        n = PATH_BINS + WORD_BINS + 7
        self.p = {f"w{d}": rng.normal(0, 0.15, (n, 4 * HIDDEN)) for d in "fb"}
        self.p |= {f"u{d}": rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)) for d in "fb"}
        self.p |= {f"c{d}": np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]) for d in "fb"}
        self.p |= {"v": rng.normal(0, 0.2, 2 * HIDDEN + n), "k": np.zeros(1)}

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """Hidden states (time x page x HIDDEN); padded steps hand the state on unchanged."""
        h = c = np.zeros((x.shape[1], HIDDEN))
        out, kept = np.zeros((*x.shape[:2], HIDDEN)), []
        inputs = x @ self.p["w" + d] + self.p["c" + d]
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            z = inputs[t] + h @ self.p["u" + d]
            i, f, o = (1 / (1 + np.exp(-np.clip(z[:, k * HIDDEN : (k + 1) * HIDDEN], -30, 30))) for k in range(3))
            g, m = np.tanh(z[:, 3 * HIDDEN :]), mask[t][:, None]
            new = f * c + i * g
            kept.append((t, i, f, o, g, c, np.tanh(new), h, m))
            c = m * new + (1 - m) * c
            h = m * (o * np.tanh(new)) + (1 - m) * h
            out[t] = h
        return out, kept

    def scores(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Probability of main text for (time x page) blocks."""
        (a, ka), (b, kb) = self._run(x, mask, "f"), self._run(x, mask, "b")
        every = np.concatenate([a, b, x], 2)
        return 1 / (1 + np.exp(-np.clip(every @ self.p["v"] + self.p["k"], -30, 30))), (every, ka, kb)

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        score, (every, *kept) = self.scores(x, mask)
        error = (score - y) * mask / mask.sum()
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["v"], g["k"] = np.einsum("tp,tph->h", error, every), error.sum(keepdims=True).reshape(1)
        for side, (d, steps) in enumerate(zip("fb", kept)):
            to_h = error[:, :, None] * self.p["v"][side * HIDDEN : (side + 1) * HIDDEN]
            dh = dc = np.zeros((x.shape[1], HIDDEN))
            for t, i, f, o, n, c, tanh, h, m in reversed(steps):
                dh = dh + to_h[t]
                dnew = m * (dc + dh * o * (1 - tanh**2))
                dz = np.concatenate([dnew * n * i * (1 - i), dnew * c * f * (1 - f), m * dh * tanh * o * (1 - o), dnew * i * (1 - n**2)], 1)
                g["w" + d] += x[t].T @ dz
                g["u" + d] += h.T @ dz
                g["c" + d] += dz.sum(0)
                dc = dnew * f + (1 - m) * dc
                dh = dz @ self.p["u" + d].T + (1 - m) * dh
        return g

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Which blocks of each page are main text."""
        order = sorted(range(len(pages)), key=lambda k: len(pages[k]))
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        k = 0
        while k < len(order):
            longest = max(1, len(pages[order[min(len(order), k + BATCH) - 1]]))
            some = order[k : k + max(1, min(BATCH, 40_000 // longest))]
            x, mask = pad([pages[i] for i in some])
            score = self.scores(x, mask)[0] if len(x) else np.zeros((0, len(some)))
            for j, i in enumerate(some):
                out[i] = score[: len(pages[i]), j] >= 0.5
            k += len(some)
        return out


def pad(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pages side by side (time x page x input) and which steps are blocks."""
    longest = max(map(len, pages))
    x, mask = np.zeros((longest, len(pages), PATH_BINS + WORD_BINS + 7), np.float32), np.zeros((longest, len(pages)))
    for j, page in enumerate(pages):
        x[: len(page), j], mask[: len(page), j] = page, 1
    return x, mask


class PageComposer:
    """Pages by rule; texts of main blocks start with a mark that the trainer takes off."""

    MARK = "⁠"
    BODY = [("article", "")] * 5 + [("main", "")] * 2 + [ ("div", "content"), ("div", "post entry"), ("section", "story"), ("div", "article body"), ("div", "text")]
    SMALL = {
        "nav": [("nav", ""), ("div", "menu"), ("ul", "navigation"), ("div", "breadcrumb"), ("div", "topbar nav")],
        "header": [("header", ""), ("div", "header"), ("div", "masthead banner")],
        "footer": [("footer", ""), ("div", "footer"), ("div", "bottom copyright")],
        "aside": [("aside", ""), ("div", "sidebar"), ("div", "related"), ("section", "widget"), ("div", "share social"), ("div", "tags meta")],
        "ad": [("div", "ad"), ("div", "advert"), ("div", "promo sponsored"), ("aside", "ads"), ("div", "banner ad")],
        "notice": [("div", "cookie"), ("div", "notice consent"), ("div", "alert"), ("div", "gdpr popup"), ("section", "newsletter subscribe")],
        "comments": [("section", "comments"), ("div", "comment list"), ("div", "replies discussion"), ("ol", "commentlist")],
        "form": [("form", ""), ("form", "search"), ("div", "login form")],
    }
    PHRASES = {
        "footer": ["© 2024", "All rights reserved.", "Privacy policy", "Contact", "Terms of use", "Copyright"],
        "notice": ["We use cookies.", "Accept", "Subscribe to our newsletter", "Sign up"],
        "comments": ["Reply", "says:", "Leave a comment", "Comments"],
        "form": ["Search", "Submit", "Name", "Email", "Login"],
        "aside": ["Related articles", "Share", "Most read", "Tags"],
        "nav": ["Home", "About", "News", "Next", "Previous"],
        "ad": ["Advertisement", "Buy now", "Sponsored"],
        "header": ["Menu", "Skip to content"],
    }

    def __init__(self, seed: int, longest: int = 0):
        self.r = random.Random(seed)
        self.longest = longest  # blocks of a long article; 0 for usual ones
        self.learn_language()

    def learn_language(self) -> None:
        """New syllables for each page, so that only set phrases tell anything by their words."""
        pick = self.r.choice
        self.syllables = [pick("bcdfghklmnprstvwz") + pick("aeiouäéó") + pick(["", "n", "r", "st"]) for _ in range(self.r.choice([12, 40, 120]))]

    def words(self, low: int, high: int) -> str:
        n, out = self.r.randint(low, high), []
        if self.r.random() < 0.08:  # one word over and over, or a list
            return self.r.choice([" ", " | "]).join([self.r.choice(self.syllables) if k % self.r.choice([1, 9]) else self.syllables[0] for k in range(n)])
        for k in range(n):
            word = "".join(self.r.choice(self.syllables) for _ in range(self.r.randint(1, 3)))
            out.append(word.capitalize() if not k or out[-1].endswith(".") else word)
            if self.r.random() < 0.12 or (k == n - 1 and self.r.random() < 0.85):
                out[-1] += "."
        return " ".join(out)

    def wrap(self, choice: tuple[str, str], inside: str) -> str:
        tag, names = choice
        noise = self.r.choice(["", "", f"x{self.r.randrange(99)}", self.r.choice(self.syllables)])
        joined = self.r.choice([" ", "-"]).join(names.split() + ([noise] if noise else []))
        kind = self.r.choice(["class", "class", "id"])
        return f"<{tag} {kind}=\"{joined}\">{inside}</{tag}>" if joined else f"<{tag}>{inside}</{tag}>"

    def boilerplate(self, kind: str) -> str:
        r, parts = self.r, []
        if kind in ("nav", "aside") and r.random() < 0.8:
            parts.append("<ul>" + "".join(f"<li><a href=\"/{k}\">{self.words(1, 4)}</a></li>" for k in range(r.randint(2, 8))) + "</ul>")
        elif kind == "form":
            parts.append(f"<label>{self.words(1, 3)}</label><input><button>{r.choice(self.PHRASES[kind])}</button>")
        elif kind == "comments":
            parts += [self.wrap(r.choice([("div", "comment"), ("li", "reply"), ("div", "reply"), ("li", "comment")]), f"<p>{self.words(2, 50)}</p>") for _ in range(r.randint(1, 6))]
        else:
            tag = r.choice(["p", "div", "span", ""])
            most = r.choice([3, 40]) if self.longest else 40
            parts += [f"<{tag}>{self.words(1, most)}</{tag}>" if tag else self.words(1, most) for _ in range(r.randint(1, 2))]
        if self.longest and r.random() < 0.3:  # nothing but a set phrase
            parts = [f"{r.choice(self.PHRASES[kind])} {r.choice(self.syllables)}"]
        elif r.random() < 0.5:
            parts.insert(r.randint(0, len(parts)), f"<p>{r.choice(self.PHRASES[kind])}</p>")
        return self.wrap(r.choice(self.SMALL[kind]), "".join(parts))

    def run(self) -> str:
        """An article of many blocks of one kind, half of the time one text over and over."""
        r, tag = self.r, self.r.choice(["p", "p", "p", "li", "div", "td", "blockquote"])
        size = r.choice([(1, 12), (5, 30), (30, 90)])
        text = self.words(*size) if r.random() < 0.5 else ""
        parts = [f"<{tag}>{self.MARK}{text or self.words(*size)}</{tag}>" for _ in range(r.randint(1, self.longest))]
        if r.random() < 0.5:
            parts.insert(0, f"<h1>{self.MARK}{self.words(2, 12)}</h1>")
        return self.wrap(r.choice(self.BODY), "".join(parts))

    def article(self) -> str:
        r, mark, parts = self.r, self.MARK, []
        if self.longest and r.random() < 0.5:
            return self.run()
        if r.random() < 0.85:
            parts.append(f"<h1>{mark}{self.words(2, 12)}</h1>")
        for _ in range(r.randint(1, self.longest or 12)):
            tag = r.choice(["p"] * 8 + ["h2", "h3", "blockquote", "pre", "li", "div", "td", "figcaption"])
            text = mark + (self.words(1, 8) if tag in ("h2", "h3", "figcaption") else self.words(*r.choice([(1, 12), (5, 90), (40, 200)])))
            if tag == "li":
                parts.append("<ul>" + "".join(f"<li>{mark}{self.words(1, 20)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif tag == "td":
                parts.append(f"<table><tr><td>{text}</td><td>{mark}{self.words(1, 5)}</td></tr></table>")
            elif tag == "p" and r.random() < 0.2:
                parts.append(f"<p><b>{text}<br>")
            else:
                parts.append(f"<{tag}>{text}</{tag}>")
            if r.random() < 0.06:
                parts.append(self.boilerplate(r.choice(["ad", "aside", "notice", "form"])))
        inside = "".join(parts)
        if r.random() < 0.3:
            inside = self.wrap(r.choice(self.BODY), inside)
        return self.wrap(r.choice(self.BODY), inside)

    def page(self) -> str:
        r = self.r
        self.learn_language()
        share = r.choice([0.0, 0.5]) if self.longest else 0.5
        top = [self.boilerplate(k) for k in ("notice", "header", "nav", "ad", "form") if r.random() < share]
        r.shuffle(top)
        bottom = [self.boilerplate(k) for k in ("ad", "comments", "aside", "form", "notice") if r.random() < 0.8 * share]
        r.shuffle(bottom)
        bottom += [self.boilerplate("footer")] if r.random() < 0.8 else []
        body = "".join([*top, self.article() if r.random() < 0.96 else "", *bottom])
        return f"<html><head><title>{self.words(1, 9)}</title></head><body>{self.wrap(('div', 'page'), body) if r.random() < 0.4 else body}"


def training_set(n: int, seed: int, longest: int = 0) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Inputs and labels of composed pages, with articles of up to ``longest`` blocks if that is given."""
    composer, inputs, labels = PageComposer(seed, longest), [], []
    for _ in range(n):
        found = blocks(composer.page())
        if found:
            labels.append(np.array([composer.MARK in t for t, _, _ in found], float))
            inputs.append(vectors([(t.replace(composer.MARK, "") or ".", p, s) for t, p, s in found]))
    return inputs, labels


@functools.lru_cache(1)
def trained() -> Labeller:
    """The labeller, fitted with Adam on composed pages."""
    model = Labeller()
    inputs, labels = training_set(TRAINING_PAGES, SEED)
    usual = len(inputs)
    for n, longest in LONG_PAGES:
        more = training_set(n, SEED + longest, longest)
        inputs, labels = inputs + more[0], labels + more[1]
    rng = np.random.default_rng(SEED)
    first, second = ({k: np.zeros_like(v) for k, v in model.p.items()} for _ in "12")
    step = 0
    long = sorted(range(usual, len(inputs)), key=lambda k: len(inputs[k]))  # pages of like length together
    for turn in range(ROUNDS):
        rate = 0.01 * (1 - turn / ROUNDS)
        order = rng.permutation(usual)
        batches = [order[k : k + 16] for k in range(0, usual, 16)] + [long[k : k + 16] for k in range(0, len(long), 16)]
        for some in (batches[k] for k in rng.permutation(len(batches))):
            x, mask = pad([inputs[i] for i in some])
            y = np.zeros(mask.shape)
            for j, i in enumerate(some):
                y[: len(labels[i]), j] = labels[i]
            step += 1
            for name, g in model.gradients(x, mask, y).items():
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.99 * second[name] + 0.01 * g * g
                model.p[name] = model.p[name] - rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)
    return model


def extract_main(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    model = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4 * BATCH):
                part = batch.slice(start, 4 * BATCH)
                found = [blocks(h or "") for h in part.column("html").to_pylist()]
                keep = model.label([vectors(f) for f in found])
                texts = ["\n\n".join(t for (t, _, _), k in zip(f, some) if k) for f, some in zip(found, keep)]
                columns = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
