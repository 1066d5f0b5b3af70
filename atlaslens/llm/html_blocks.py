"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its leaf blocks: runs of text between
block-level tags, each with the path of open elements around it. A block's
vector counts hashed parts of the path (names, classes, ids) and hashed words,
besides a few sizes. A bidirectional LSTM in numpy reads the whole sequence, so
every block is judged in the light of the document before and after it.

The network is trained here, on pages that a small generator lays out with
known main text, and on a bounded sample of the given pages in which elements
that say what they are (article, nav, footer) give the labels. Any page may be in
the sample, whatever its length; of a long one a bounded run of blocks is learnt.
"""

from __future__ import annotations

import hashlib
import html
from random import Random
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from atlaslens.functions.html import ATTRIBUTE, RAW, VOID, Tags
from atlaslens.llm.common import text_blocks
from atlaslens.llm.texthash import Runs, words

# Elements that end a block where they begin and end, and elements whose text no reader sees.
BLOCK = frozenset((
    "address article aside blockquote body br button caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select "
    "summary table tbody td tfoot th thead tr ul"
).split())
UNSEEN = frozenset("script style noscript template textarea title svg math iframe object canvas audio video".split())
#: An opening tag of these closes an open one of the same name, as browsers do.
SELF_CLOSING = frozenset("p li dt dd option tr td th".split())

# So many path terms that few names share one.
PATH_TERMS, WORD_TERMS, SIZES = 320, 48, 6
WIDTH = PATH_TERMS + WORD_TERMS + SIZES
HIDDEN = 16
SAMPLE_PAGES = 200  # given pages to learn from, at most
SAMPLE_BLOCKS = 256  # neighbouring blocks of one of them, at most
MADE_PAGES = 600  # laid out by the generator
EPOCHS, BATCH, RATE, SEED = 18, 25, 0.02, 7
#: Longer sequences are read in windows of so many blocks, each beginning with the state the one before ended with.
WINDOW = 4_096


@dataclass
class Block:
    path: list[int]  # hashed names, classes and ids of all open elements, each once
    says: frozenset[str]  # those of them that labels look at
    text: str
    linked: float  # share of the text inside links


def _marks(name: str, raw: str) -> list[str]:
    out = [name]
    low = raw.lower()
    if "class" in low or "id" in low or "role" in low:
        for key, value in ATTRIBUTE.findall(raw):
            if key.lower() in ("class", "id", "role"):
                value = html.unescape(value[1:-1] if value[:1] in ("'", '"') else value).lower()
                out += [part for word in value.split() for part in (word, *word.replace("_", "-").split("-"))]
    return list(dict.fromkeys(out))


def blocks(source: str) -> list[Block]:
    """Leaf blocks in page order, without empty ones. White space in a block is one space."""
    out: list[Block] = []
    open_names: list[str] = []  # "" where an inline element ended before a block element inside it
    open_marks: list[list[str]] = []
    places: dict[str, list[int]] = {}  # where the open elements of a name are among them
    open_blocks: list[int] = []  # where block elements are
    # Running counts over all open elements, so that a block costs no more however deep it lies.
    around: dict[int, int] = {}
    telling: dict[str, int] = {}
    texts: list[str] = []
    linked = 0
    unseen = 0

    def flush() -> None:
        nonlocal linked
        if texts:
            text = " ".join("".join(texts).split())
            texts.clear()
            if text:
                out.append(Block(list(around), frozenset(telling), text, min(1.0, linked / len(text))))
        linked = 0

    def add(counted: dict, key: int | str, n: int) -> None:
        left = counted.get(key, 0) + n
        if left:
            counted[key] = left
        else:
            del counted[key]

    def note(marks: list[str], n: int) -> None:
        for mark in marks:
            add(around, _bucket(mark, PATH_TERMS), n)
            if mark in _TELLING:
                add(telling, mark, n)

    def close(name: str) -> None:
        nonlocal unseen
        if not places.get(name):
            return
        at = places[name][-1]
        if name not in BLOCK and name not in UNSEEN and open_blocks and open_blocks[-1] > at:
            # The end of an inline element leaves block elements inside it open.
            places[name].pop()
            note(open_marks[at], -1)
            open_names[at], open_marks[at] = "", []
            return
        while len(open_names) > at:
            last = open_names.pop()
            note(open_marks.pop(), -1)
            if last:
                places[last].pop()
                unseen -= last in UNSEEN
        while open_blocks and open_blocks[-1] >= at:
            open_blocks.pop()

    def say(text: str) -> None:
        nonlocal linked
        if unseen or not text:
            return
        text = html.unescape(text) if "&" in text else text
        texts.append(text)
        if places.get("a"):
            linked += len(text)

    tags, at = Tags(source), 0
    while (found := tags.next()) is not None:
        start, end, slash, name, raw = found
        if start > at:
            say(source[at:start])
        at = end
        if name is None:
            continue
        name = name.lower()
        if name in BLOCK:
            flush()
        if slash:
            close(name)
            continue
        if name in SELF_CLOSING and open_names and open_names[-1] == name:
            close(name)
        if name in VOID or raw.endswith("/"):
            continue
        places.setdefault(name, []).append(len(open_names))
        if name in BLOCK:
            open_blocks.append(len(open_names))
        open_names.append(name)
        open_marks.append(_marks(name, raw))
        note(open_marks[-1], 1)
        unseen += name in UNSEEN
        if name in RAW or name in ("textarea", "title"):
            # No markup until the end tag.
            low = source.find("</", at)
            while low >= 0 and source[low + 2 : low + 2 + len(name)].lower() != name:
                low = source.find("</", low + 2)
            at = tags.at = low if low >= 0 else len(source)
    say(source[at:])
    flush()
    return out


_hashes: dict[tuple[str, int], int] = {}


def _bucket(word: str, buckets: int) -> int:
    """Of all bytes of a name."""
    found = _hashes.get((word, buckets))
    if found is None:
        found = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "replace"), digest_size=8).digest(), "little") % buckets
        if len(word) <= 64:  # remembered, as most come again and again
            if len(_hashes) >= 200_000:
                _hashes.clear()
            _hashes[word, buckets] = found
    return found


_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?:;,")] = True
_STOPS = np.zeros(256, bool)
_STOPS[list(b".!?")] = True


def features_of(pages: list[list[Block]]) -> list[np.ndarray]:
    """The vectors of the blocks of each page, one array a page; words of many blocks are hashed at once."""
    every = [block for page in pages for block in page]
    x = np.zeros((len(every), WIDTH), dtype=np.float32)
    deep = np.fromiter((len(block.path) for block in every), np.int64, len(every))
    x[np.repeat(np.arange(len(every)), deep), np.fromiter(chain.from_iterable(block.path for block in every), np.int64, int(deep.sum()))] = 1.0
    for first, data, at in text_blocks(pa.array([block.text.lower() for block in every], pa.large_string())):
        found, n = words(data, at), len(at) - 1
        rows = x[first : first + n]
        bucket = (Runs(data).hash(found.starts, found.ends) % np.uint64(WORD_TERMS)).astype(np.int64)
        said = np.bincount(found.doc * WORD_TERMS + bucket, minlength=n * WORD_TERMS).reshape(n, WORD_TERMS)
        rows[:, PATH_TERMS : PATH_TERMS + WORD_TERMS] = 0.07 * np.log1p(said)  # long blocks stay in range
        ends = np.bincount(found.doc, _ENDS[data[found.ends - 1]], n)
        rows[:, -5] = np.log1p(found.count) / 5
        rows[:, -3] = ends / np.maximum(found.count, 1)
        rows[:, -2] = _STOPS[data[at[1:] - 1]]  # no block is empty
    x[:, -6] = np.log1p(np.fromiter((len(block.text) for block in every), np.int64, len(every))) / 6
    x[:, -4] = np.fromiter((block.linked for block in every), np.float32, len(every))
    x[:, -1] = 1.0
    return np.split(x, np.cumsum([len(page) for page in pages])[:-1]) if pages else []


def features(page: list[Block]) -> np.ndarray:
    return features_of([page])[0]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Direction:
    """One LSTM, over padded sequences (batch, time, width)."""

    def __init__(self, random: np.random.Generator):
        self.w = (random.normal(size=(WIDTH + HIDDEN, 4 * HIDDEN)) / np.sqrt(WIDTH + HIDDEN)).astype(np.float32)
        self.b = np.zeros(4 * HIDDEN, np.float32)
        self.b[HIDDEN : 2 * HIDDEN] = 1  # remember at first

    def windows(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(start, outputs) of a long sequence, window by window; one run over all of it gives the same."""
        state = None
        for first in range(0, len(x), WINDOW):
            part = x[None, first : first + WINDOW]
            out, _, state = self.steps(part, np.ones(part.shape[:2], bool), False, state)
            yield first, out[0]

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        return self.steps(x, mask, keep, None)[:2]

    def steps(self, x: np.ndarray, mask: np.ndarray, keep: bool, state: tuple | None) -> tuple[np.ndarray, list, tuple]:
        """Outputs, what ``backward`` needs, and the state at the end."""
        n, steps, _ = x.shape
        h, c = state or (np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32))
        out, tape = np.zeros((n, steps, HIDDEN), np.float32), []
        driven = x @ self.w[:WIDTH] + self.b
        for t in range(steps):
            z = driven[:, t] + h @ self.w[WIDTH:]
            i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            new_c = f * c + i * g
            tanh_c = np.tanh(new_c)
            m = mask[:, t, None]
            if keep:
                tape.append((h, c, i, f, o, g, tanh_c))
            h, c = np.where(m, o * tanh_c, h), np.where(m, new_c, c)
            out[:, t] = h
        return out, tape, (h, c)

    def backward(self, x: np.ndarray, mask: np.ndarray, tape: list, d_out: np.ndarray) -> list[np.ndarray]:
        d_w, d_b = np.zeros_like(self.w), np.zeros_like(self.b)
        d_h, d_c = np.zeros_like(tape[0][0]), np.zeros_like(tape[0][0])
        for t in range(x.shape[1] - 1, -1, -1):
            h, c, i, f, o, g, tanh_c = tape[t]
            m = mask[:, t, None]
            d_h = d_h + d_out[:, t]
            new_h = np.where(m, d_h, 0)
            new_c = np.where(m, d_c, 0) + new_h * o * (1 - tanh_c**2)
            d_z = np.hstack((new_c * g * i * (1 - i), new_c * c * f * (1 - f), new_h * tanh_c * o * (1 - o), new_c * i * (1 - g**2)))
            d_w[:WIDTH] += x[:, t].T @ d_z
            d_w[WIDTH:] += h.T @ d_z
            d_b += d_z.sum(0)
            d_h = np.where(m, d_z @ self.w[WIDTH:].T, d_h)
            d_c = np.where(m, new_c * f, d_c)
        return [d_w, d_b]


class Labeller:
    """A bidirectional LSTM and a logistic output per block."""

    def __init__(self, seed: int = SEED):
        random = np.random.default_rng(seed)
        self.ahead, self.back = Direction(random), Direction(random)
        # The output also sees the block itself.
        self.v = (random.normal(size=2 * HIDDEN + WIDTH) * 0.1).astype(np.float32)
        self.bias = np.zeros(1, np.float32)

    def _run(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        left, tape_l = self.ahead.forward(x, mask, keep)
        right, tape_r = self.back.forward(x[:, ::-1], mask[:, ::-1], keep)
        hidden = np.concatenate((left, right[:, ::-1], x), axis=2)
        return _sigmoid(hidden @ self.v + self.bias[0]), hidden, tape_l, tape_r

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Of each block of one page being main text; very long pages in windows, to the same result."""
        if len(x) <= WINDOW:
            return self._run(x[None], np.ones((1, len(x)), bool))[0][0] if len(x) else np.zeros(0, np.float32)
        sums = x @ self.v[2 * HIDDEN :] + self.bias[0]
        for direction, v, y in ((self.ahead, self.v[:HIDDEN], sums), (self.back, self.v[HIDDEN : 2 * HIDDEN], sums[::-1])):
            for first, out in direction.windows(x if y is sums else x[::-1]):
                y[first : first + len(out)] += out @ v
        return _sigmoid(sums)

    def probabilities_of(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """The same for many pages; those of like length share a run of at most ``WINDOW`` blocks."""
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
        order = sorted((k for k, x in enumerate(pages) if len(x)), key=lambda k: len(pages[k]))
        while order:
            longest = len(pages[order[-1]])
            some = [order.pop() for _ in range(min(len(order), max(1, WINDOW // longest), 64))]
            if len(some) == 1:
                out[some[0]] = self.probabilities(pages[some[0]])
                continue
            x, mask = np.zeros((len(some), longest, WIDTH), np.float32), np.zeros((len(some), longest), bool)
            for row, k in enumerate(some):
                x[row, : len(pages[k])], mask[row, : len(pages[k])] = pages[k], True
            for row, (k, p) in enumerate(zip(some, self._run(x, mask)[0])):
                out[k] = p[: len(pages[k])]
        return out

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = SEED) -> None:
        """Adam on the mean cross-entropy of blocks; pages of like length share a batch."""
        random = np.random.default_rng(seed)
        weights = [self.ahead.w, self.ahead.b, self.back.w, self.back.b, self.v, self.bias]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        step = 0
        order = sorted(range(len(pages)), key=lambda k: (len(pages[k][0]), k))
        batches = [order[k : k + BATCH] for k in range(0, len(order), BATCH)]
        for epoch in range(epochs):
            for number in random.permutation(len(batches)):
                chosen = [pages[k] for k in batches[number]]
                longest = max(len(x) for x, _ in chosen)
                x = np.zeros((len(chosen), longest, WIDTH), np.float32)
                y, mask = np.zeros((len(chosen), longest), np.float32), np.zeros((len(chosen), longest), bool)
                for k, (a, b) in enumerate(chosen):
                    x[k, : len(a)], y[k, : len(a)], mask[k, : len(a)] = a, b, True
                # Path terms are dropped now and then, so that no single class name decides.
                x[:, :, :PATH_TERMS] *= random.random((len(chosen), 1, PATH_TERMS)) > 0.1
                p, hidden, tape_l, tape_r = self._run(x, mask, keep=True)
                d = np.where(mask, p - y, 0).astype(np.float32) / mask.sum()
                d_hidden = d[:, :, None] * self.v
                grads = [
                    *self.ahead.backward(x, mask, tape_l, d_hidden[:, :, :HIDDEN]),
                    *self.back.backward(x[:, ::-1], mask[:, ::-1], tape_r, d_hidden[:, ::-1, HIDDEN : 2 * HIDDEN]),
                    np.einsum("nt,ntk->k", d, hidden), np.array([d.sum()], np.float32),
                ]
                step += 1
                rate = RATE * (1 - epoch / epochs) + 0.001
                for w, g, m, s in zip(weights, grads, first, second):
                    g = np.clip(g, -1, 1)
                    m += 0.1 * (g - m)
                    s += 0.01 * (g * g - s)
                    w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)


# Training pages. What parts of pages are called, as plain word lists.
_MAIN = [
    "article", "main", "div.content", "div.post", "div.entry-content", "section.article-body", "div#content", "div.story",
    "div.post-body", "main#main", "div.text", "section.story", "div.article", "div#main-content",
]
_OTHER = {
    "nav": ["nav", "ul.menu", "div.nav", "div#menu", "nav.breadcrumb", "div.navigation", "ul.nav", "div.breadcrumbs", "div.toc"],
    "header": ["header", "div.header", "div#header", "div.masthead", "div.banner", "header.site-header", "div.logo"],
    "footer": ["footer", "div.footer", "div#footer", "div.copyright", "footer.site-footer", "div.legal"],
    "side": ["aside", "div.sidebar", "div#sidebar", "div.widget", "div.related", "div.recommended", "aside.side", "div.promo", "div.popular"],
    "notice": ["div.notice", "div.cookie", "div.cookie-banner", "div.alert", "div#consent", "div.warning", "div.newsletter", "div.subscribe", "div.popup", "div.modal"],
    "ad": ["div.ad", "div.ads", "div.advert", "div.advertisement", "div.sponsored", "ins.adsbygoogle", "div#ad-top", "div.banner-ad", "aside.ad"],
    "form": ["form", "form.search", "form#login", "div.search", "form.contact", "div.form"],
    "comments": ["div.comments", "section.comments", "div#comments", "ol.commentlist", "div.comment", "div.replies", "section#comments", "div.discussion"],
    "share": ["div.share", "div.social", "ul.tags", "div.meta", "div.byline", "div.author-box"],
}
_UTILITY = (
    "flex flex-col items-center justify-between px-4 py-2 mt-4 mb-8 mx-auto w-full max-w-lg text-sm text-gray-700 font-bold "
    "rounded-md shadow-lg bg-white md:w-1/2 lg:px-8 clearfix col-md-8 d-flex post-12 type-post status-publish format-standard "
    "hentry widget_text textwidget-1 wp-block-group is-layout-flow has-background"
).split()
_SYLLABLES = "the an er on re in ti en st al or es it ar ou le la de ing tion ment ung sch der que ción".split()


def _word(random: Random) -> str:
    return "".join(random.choices(_SYLLABLES, k=random.randrange(1, 4)))


def _prose(random: Random, low: int, high: int) -> str:
    words = [_word(random) for _ in range(random.randrange(low, high))]
    words[0] = words[0].capitalize()
    if random.random() < 0.1:  # poor texts are main text too
        words = [w.upper() + "!!" for w in words] if random.random() < 0.4 else [w + random.choice(["###", "%%%", "$$$", "&amp;", " |"]) for w in words]
    return " ".join(w + (random.choice([",", ".", "."]) if random.random() < 0.12 else "") for w in words) + random.choice([".", ".", "!", "", ""])


def _utility(random: Random) -> str:
    """Classes that say nothing of what an element is, now and then."""
    return " ".join(random.sample(_UTILITY, random.randrange(4, 11))) if random.random() < 0.25 else ""


def _tag(random: Random, spec: str) -> tuple[str, str]:
    """Tags of an element; what says what it is comes last among its classes."""
    name, value, classes = spec, "", _utility(random)
    if "#" in spec:
        name, value = spec.split("#")
        value = f' id="{value}"'
    elif "." in spec:
        name, own = spec.split(".")
        classes = f"{classes} {own}".strip()
    return f"<{name}{value}" + (f' class="{classes}">' if classes else ">"), f"</{name}>"


def _part(random: Random, kind: str) -> str:
    opening, closing = _tag(random, str(random.choice(_OTHER[kind])))
    shape = random.random()
    if kind in ("nav", "share") or (kind == "side" and shape < 0.5):
        inside = "<ul>" + "".join(f'<li><a href="/{_word(random)}">{_word(random)}</a></li>' for _ in range(random.randrange(2, 9))) + "</ul>"
    elif kind == "form":
        inside = f'<label>{_word(random)}</label><input name="q"><button>{_word(random)}</button>'
    elif kind == "comments":
        inside = "".join(f"<div><b>{_word(random)}</b><p>{_prose(random, 4, 60)}</p></div>" for _ in range(random.randrange(1, 6)))
    elif kind in ("footer", "header") and shape < 0.5:
        inside = f"&copy; {_word(random)}.example.com &middot; {_prose(random, 2, 20)}"
    else:
        inside = random.choice(["", "<p>"]) + _prose(random, 3, 40 if kind in ("ad", "notice", "side") else 15)
    return opening + inside + closing


def made_page(random: Random) -> tuple[str, str]:
    """A page and its main text."""
    main: list[str] = []

    def add(text: str) -> str:
        main.append(text)
        return text

    pick = lambda *kinds: "".join(_part(random, k) for k in kinds if random.random() < 0.5)
    head = f"<html><head><title>{_word(random)}</title><style>p{{}}</style><script>var a = '<p>';</script></head><body>"
    before = pick("notice", "header", "nav", "form", "ad", "side")
    opening, closing = _tag(random, str(random.choice(_MAIN)))
    body = opening
    if random.random() < 0.8:
        name = str(random.choice(["h1", "h2", "header"]))
        body += f"<{name}>{add(_prose(random, 2, 10))}</{name}>" if name != "header" else f"<h1>{add(_prose(random, 2, 10))}</h1>"
    for _ in range(int(random.randrange(0 if len(main) else 1, 10))):
        shape, text = random.random(), _prose(random, 1, random.choice([12, 90]))
        if shape < 0.6:
            body += _tag(random, "p")[0] + add(text) + random.choice(["</p>", ""])
        elif shape < 0.7:
            body += f"<p><b>{add(text)}<br>"
        elif shape < 0.8:
            body += "<ul>" + "".join(f"<li>{add(_prose(random, 1, 12))}</li>" for _ in range(3)) + "</ul>"
        elif shape < 0.87:
            body += f"<h2>{add(_prose(random, 1, 8))}</h2>"
        elif shape < 0.92:
            body += f"<blockquote><p>{add(text)}</p></blockquote>"
        else:
            body += _tag(random, "div")[0] + f"{add(text)}</div>"
        if random.random() < 0.08:
            body += _part(random, str(random.choice(["ad", "share", "notice", "side", "form"])))
    if random.random() < 0.2:
        body += _part(random, "comments")
    after = pick("comments", "share", "side", "ad", "nav", "form", "footer")
    wrapped = before + body + closing
    if random.random() < 0.4:
        wrapped = f'<div class="{random.choice(["wrapper", "container", "page", "site", "row"])}">' + wrapped + random.choice(["</div>", ""])
    if random.random() < 0.15:  # a fragment, as some feeds hold them
        head = before = ""
        wrapped, after = body + closing, random.choice(["", after])
    return head + wrapped + after + random.choice(["</body></html>", ""]), " ".join(" ".join(html.unescape(m).split()) for m in main)


def _labels(page: list[Block], main: str) -> np.ndarray:
    """Marks the blocks that follow one another in the main text."""
    out, at = np.zeros(len(page), np.float32), 0
    for k, block in enumerate(page):
        if main.startswith(block.text, at) and main[at + len(block.text) : at + len(block.text) + 1] in ("", " "):
            out[k], at = 1, at + len(block.text) + 1
    return out


_AGAINST = frozenset("nav header footer aside form comments comment sidebar ad ads menu notice cookie".split())
_TELLING = _AGAINST | {"article", "main"}


def plain_labels(page: list[Block]) -> np.ndarray | None:
    """Labels of a given page that says itself what is what; None for others."""
    inside = [("article" in b.says or "main" in b.says) and not _AGAINST & b.says for b in page]
    return np.array(inside, np.float32) if any(inside) else None


def _given(sources: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors and labels of the sampled pages that say what is what: of a long page a run of blocks, placed by its hash."""
    for batch in sources:
        for order, source in zip(batch.column("o").to_pylist(), batch.column("html").to_pylist()):
            page = blocks(source or "")
            labels = plain_labels(page)
            if labels is None:
                continue
            low = order % max(1, len(page) - SAMPLE_BLOCKS + 1)
            x = features(page[low : low + SAMPLE_BLOCKS])
            yield pa.RecordBatch.from_arrays([
                pa.array([order], pa.int64()), pa.array([x.tobytes()], pa.binary()), pa.array([labels[low : low + SAMPLE_BLOCKS].tobytes()], pa.binary()),
            ], names=["o", "x", "y"])


def train(pages: DataFrame, sample: int = SAMPLE_PAGES, made: int = MADE_PAGES) -> Labeller:
    """On ``made`` generated pages and at most ``sample`` different given ones, chosen by a hash of the page.

    Every given page may be chosen; ``SAMPLE_BLOCKS`` bounds what one of them weighs and what comes to the driver.
    """
    random = Random(SEED)
    examples = []
    for _ in range(made):
        source, main = made_page(random)
        page = blocks(source)
        if page:
            examples.append((features(page), _labels(page, main)))
    order = F.xxhash64(F.coalesce("url", F.lit("")), F.coalesce("html", F.lit("")))
    hashed = pages.select("html", order.alias("o"))
    n = hashed.select("o").distinct().count()
    # So many of the hash values that twice the sample is to be expected; only these pages are read for it.
    some = hashed.where(F.pmod("o", F.lit(1 << 30)) < int((1 << 30) * min(1.0, 2 * sample / max(n, 1)))).dropDuplicates(["o"])
    for row in some.mapInArrow(_given, "o long, x binary, y binary").orderBy("o").limit(sample).collect():
        examples.append((np.frombuffer(row["x"], np.float32).reshape(-1, WIDTH), np.frombuffer(row["y"], np.float32)))
    model = Labeller()
    model.train(examples)
    return model


def main_texts(sources: list[str], model: Labeller, least: float = 0.5) -> list[str]:
    pages = [blocks(source) for source in sources]
    chosen = model.probabilities_of(features_of(pages))
    return [" ".join(block.text for block, p in zip(page, own) if p >= least) for page, own in zip(pages, chosen)]


def extract(pages: DataFrame, model: Labeller) -> DataFrame:
    """page_id, url, text (main text, empty if there is none) and n_chars of every page.

    A null page is empty. Repeated rows are read again; other columns are not.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for first in range(0, len(batch), 256):
                sources = batch.column("html").slice(first, 256).to_pylist()
                texts += main_texts([source or "" for source in sources], shared.value)
            yield pa.RecordBatch.from_arrays([
                batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
            ], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
