"""Operator 10: main text by a recurrent block labeller in numpy.

A page is cut into leaf blocks: the text between block-level tags, with inline
markup taken out. Each block becomes a vector of its tag path (learned rows of
hashed tags with their class and id words), its words (learned rows of hashed
words, averaged) and a few sizes. A bidirectional LSTM reads the page's whole
sequence of blocks, so that each is labelled with the document around it;
blocks labelled main text are joined in page order.

No table holds labels, so the labeller is fitted to a teacher on a bounded
sample of pages: a block is main text if its tag path passes through an
``article`` or ``main`` element, or a container named like one, and through no
element or name of ``BOILERPLATE`` below it. Sampled pages are learnt from
again with blocks of other pages set in under names of ``BOILERPLATE``, the
article renamed and up to ``WRAPPERS`` plain elements set around or within it,
so that other and deeper layouts than the sampled are covered.

Defined cases: a null or empty page, and one without text, gives an empty
text; unclosed and crossing tags close with the element around them; script,
style, title and the like never give blocks; equal pages give equal rows; with
no page to learn from every block outside ``BOILERPLATE`` is kept; an empty
table gives no rows.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zerobill.llm.common import Shared, table, typed
from zerobill.llm.text import hash_words, split_words

#: Bound of the training sample: pages, and characters of each.
SAMPLE_PAGES, SAMPLE_CHARS = 240, 1 << 15
PATH_ROWS, WORD_ROWS = 1 << 12, 1 << 10
PATH_DIM, WORD_DIM, SIZES, HIDDEN = 16, 8, 4, 16
WRAPPERS = 40
INPUT = PATH_DIM + WORD_DIM + SIZES

# Fixed values of the HTML standard and of common page layouts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TEXT = frozenset("script style noscript template title textarea select option svg iframe object head".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
MAIN = frozenset("article main".split())
BOILERPLATE = (
    "nav header footer aside form button menu dialog ad ads advert advertisement banner sponsor promo comment comments reply disqus cookie consent notice "
    "alert popup newsletter subscribe sidebar widget related share social breadcrumb breadcrumbs pagination login search copyright legal toolbar"
).split()
MAIN_NAMES = "article main content post entry story body-text article-body main-content post-content entry-content".split()

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?][^>]*>|[^<]+|<", re.S)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPACE = re.compile(r"[\s ]+")
_PARTS = re.compile(r"[^a-z]+")


def _element(tag: str, attributes: str) -> tuple[str, ...]:
    """An element's tag, then its class, id and role words."""
    names = [tag]
    if "=" in attributes:
        for m in _NAMES.finditer(attributes):
            names += (m[2] or m[3] or m[4] or "").lower().split()
    return tuple(names)


def blocks(page: str) -> list[tuple[tuple[tuple[str, ...], ...], str, int]]:
    """(tag path, text, characters inside links) of the leaf blocks in page order."""
    out: list = []
    stack: list[tuple[str, ...]] = []
    held: list[str] = []
    linked, hidden, links = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = _SPACE.sub(" ", html.unescape("".join(held))).strip()
            if text:
                out.append((tuple(e for e in stack if e[0] not in INLINE), text, linked))
            held.clear()
        linked = 0

    pos, n = 0, len(page)
    while pos < n:
        m = _TOKEN.match(page, pos)
        if m is None:
            held.append(page[pos])
            pos += 1
            continue
        pos = m.end()
        if m[2] is None:
            t = m[0]
            if not hidden and not (t.startswith("<!") or t.startswith("<?")):
                held.append(t)
                linked += len(t) if links else 0
            continue
        tag = m[2].lower()
        if m[1]:
            if any(e[0] == tag for e in stack):
                if tag not in INLINE:
                    flush()
                while stack:
                    gone = stack.pop()[0]
                    hidden -= gone in HIDDEN_TEXT
                    links -= gone == "a"
                    if gone == tag:
                        break
            continue
        if tag not in INLINE:
            flush()
        if tag in VOID:  # a slash at the end closes no other element
            continue
        if tag in ("script", "style"):
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, pos)
            pos = end.end() if end else n
            continue
        if tag in ("p", "li", "tr", "td", "th", "dt", "dd") and stack and stack[-1][0] == tag:
            stack.pop()
        if tag == "body":
            hidden -= sum(e[0] in HIDDEN_TEXT for e in stack)
            stack = [e for e in stack if e[0] not in HIDDEN_TEXT]
        stack.append(_element(tag, m[3]))
        hidden += tag in HIDDEN_TEXT
        links += tag == "a"
    flush()
    return out


def _is_boilerplate(element: tuple[str, ...]) -> bool:
    return any(part in BOILERPLATE for name in element for part in _PARTS.split(name.lower()))


def teacher(path: tuple[tuple[str, ...], ...]) -> bool:
    """Main text: the innermost telling element of the path speaks for it."""
    for e in reversed(path):
        if _is_boilerplate(e):
            return False
        if e[0] in MAIN or any(n in MAIN_NAMES for n in e[1:]):
            return True
    return False


def _path_rows(path: tuple[tuple[str, ...], ...], cache: dict) -> np.ndarray:
    """Rows of every name on the path, once each; a name's parts, too, so that 'ad-top' is near 'ad'."""
    if path not in cache:
        if len(cache) > 50_000:
            cache.clear()
        names = [(f"{'t' if i == 0 else 'n'}:{part}") for e in path for i, name in enumerate(e) for part in {name.lower(), *_PARTS.split(name.lower())} if part]
        names.append(f"leaf:{path[-1][0]}" if path else "leaf:")
        names = dict.fromkeys(names)  # wrappers of one name, however many, do not outweigh the others
        cache[path] = np.array([zlib.crc32(x.encode()) % PATH_ROWS for x in names], np.int64)
    return cache[path]


class Page:
    """A page's blocks as rows of the embedding tables and sizes."""

    def __init__(self, found: list, cache: dict):
        self.path = [_path_rows(p, cache) for p, _, _ in found]
        texts = [t.encode() for _, t, _ in found]
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        w = split_words(data, offsets, lower=True)
        self.words, self.word_ends = (hash_words(w) % np.uint64(WORD_ROWS)).astype(np.int64), w.docs
        n, at = np.array([len(t) for _, t, _ in found], np.float32), np.arange(len(found))
        linked = np.array([k for _, _, k in found], np.float32) / np.maximum(n, 1)
        self.sizes = np.stack([np.log1p(n) / 5, np.minimum(linked, 1), at / max(1, len(found)), np.log1p(np.diff(w.docs)) / 4], axis=1).astype(np.float32)


def _mean_rows(table: np.ndarray, rows: np.ndarray, ends: np.ndarray) -> np.ndarray:
    run = np.concatenate((np.zeros((1, table.shape[1])), np.cumsum(table[rows], axis=0, dtype=np.float64)))
    return ((run[ends[1:]] - run[ends[:-1]]) / np.maximum(np.diff(ends), 1)[:, None]).astype(np.float32)


class Labeller:
    NAMES = ("paths", "words", "forward", "backward", "out")

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.paths = rng.normal(0, 0.3, (PATH_ROWS, PATH_DIM)).astype(np.float32)
        self.words = rng.normal(0, 0.1, (WORD_ROWS, WORD_DIM)).astype(np.float32)
        gate = lambda: np.concatenate((rng.normal(0, 0.2, (INPUT + HIDDEN, 4 * HIDDEN)), np.tile(np.repeat([0, 1, 0, 0], HIDDEN), (1, 1)))).astype(np.float32)
        self.forward, self.backward = gate(), gate()
        self.out = np.append(rng.normal(0, 0.3, 2 * HIDDEN), 0).astype(np.float32)
        self.fitted = False

    def inputs(self, p: Page) -> np.ndarray:
        rows = np.concatenate(p.path) if p.path else np.zeros(0, np.int64)
        ends = np.concatenate(([0], np.cumsum([len(x) for x in p.path]))).astype(np.int64)
        return np.concatenate((_mean_rows(self.paths, rows, ends) * np.diff(ends)[:, None].astype(np.float32), _mean_rows(self.words, p.words, p.word_ends), p.sizes), axis=1)

    def _lstm(self, x: np.ndarray, w: np.ndarray, live: np.ndarray, keep: list | None = None) -> np.ndarray:
        """x: (steps, pages, INPUT); a page's state stands still where it has no block."""
        steps, pages, _ = x.shape
        h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        out = np.zeros((steps, pages, HIDDEN), np.float32)
        fixed = x @ w[:INPUT] + w[-1]
        for t in range(steps):
            z = fixed[t] + h @ w[INPUT:-1]
            s = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
            i, f, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            c2 = f * c + i * g
            th = np.tanh(c2)
            if keep is not None:
                keep.append((h, c, i, f, o, g, th))
            on = live[t][:, None]
            h, c = np.where(on, o * th, h), np.where(on, c2, c)
            out[t] = h
        return out

    def _lstm_back(self, x: np.ndarray, w: np.ndarray, live: np.ndarray, kept: list, dout: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        gw, dx = np.zeros_like(w), np.zeros_like(x)
        dh, dc = np.zeros(dout.shape[1:], np.float32), np.zeros(dout.shape[1:], np.float32)
        for t in range(len(x) - 1, -1, -1):
            h, c, i, f, o, g, th = kept[t]
            on = live[t][:, None].astype(np.float32)
            a = (dh + dout[t]) * on
            dc2 = dc * on + a * o * (1 - th**2)
            dz = np.concatenate((dc2 * g * i * (1 - i), dc2 * c * f * (1 - f), a * th * o * (1 - o), dc2 * i * (1 - g**2)), axis=1)
            gw[:INPUT] += x[t].T @ dz
            gw[INPUT:-1] += h.T @ dz
            gw[-1] += dz.sum(axis=0)
            dx[t] = dz @ w[:INPUT].T
            dh = (dh + dout[t]) * (1 - on) + dz @ w[INPUT:-1].T
            dc = dc * (1 - on) + dc2 * f
        return gw, dx

    @staticmethod
    def _padded(xs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        steps = max(len(x) for x in xs)
        out, live = np.zeros((steps, len(xs), INPUT), np.float32), np.zeros((steps, len(xs)), bool)
        for k, x in enumerate(xs):
            out[: len(x), k], live[: len(x), k] = x, True
        return out, live

    def label(self, pages: list[Page]) -> list[np.ndarray]:
        """Main or not, for every block of every page; pages of like length go together."""
        out: list[np.ndarray] = [np.zeros(len(p.path), bool) for p in pages]
        order = sorted((i for i, p in enumerate(pages) if p.path), key=lambda i: len(pages[i].path))
        for k in range(0, len(order), 128):
            some = order[k : k + 128]
            x, live = self._padded([self.inputs(pages[i]) for i in some])
            hf = self._lstm(x, self.forward, live)
            hb = self._lstm(x[::-1], self.backward, live[::-1])[::-1]
            z = hf @ self.out[:HIDDEN] + hb @ self.out[HIDDEN:-1] + self.out[-1]
            for col, i in enumerate(some):
                out[i] = z[: len(pages[i].path), col] > 0
        return out

    def train(self, pages: list[tuple[Page, np.ndarray]], epochs: int = 12, batch: int = 16, rate: float = 0.01, seed: int = 5) -> None:
        pages = [(p, y) for p, y in pages if len(y)]
        if not pages:
            return
        self.fitted = True
        rng = np.random.default_rng(seed)
        moments = {n: [np.zeros_like(getattr(self, n)), np.zeros_like(getattr(self, n))] for n in self.NAMES}
        t = 0
        for _ in range(epochs):
            order = rng.permutation(len(pages))
            for k in range(0, len(order), batch):
                some = [pages[i] for i in order[k : k + batch]]
                x, live = self._padded([self.inputs(p) for p, _ in some])
                y = np.zeros(live.shape, np.float32)
                for col, (_, own) in enumerate(some):
                    y[: len(own), col] = own
                kf, kb = [], []
                hf = self._lstm(x, self.forward, live, kf)
                hb = self._lstm(x[::-1], self.backward, live[::-1], kb)[::-1]
                z = hf @ self.out[:HIDDEN] + hb @ self.out[HIDDEN:-1] + self.out[-1]
                d = np.where(live, 1 / (1 + np.exp(-z)) - y, 0).astype(np.float32) / live.sum()
                g = {"out": np.concatenate(((hf * d[..., None]).sum(axis=(0, 1)), (hb * d[..., None]).sum(axis=(0, 1)), [d.sum()]))}
                g["forward"], dx = self._lstm_back(x, self.forward, live, kf, d[..., None] * self.out[:HIDDEN])
                g["backward"], dxb = self._lstm_back(x[::-1], self.backward, live[::-1], kb, (d[..., None] * self.out[HIDDEN:-1])[::-1])
                dx = dx + dxb[::-1]
                gp, gw = np.zeros_like(self.paths), np.zeros_like(self.words)
                for col, (p, own) in enumerate(some):
                    dp, dw = dx[: len(own), col, :PATH_DIM], dx[: len(own), col, PATH_DIM : PATH_DIM + WORD_DIM]
                    count = np.array([len(r) for r in p.path])
                    np.add.at(gp, np.concatenate(p.path), np.repeat(dp, count, axis=0))
                    n = np.diff(p.word_ends)
                    np.add.at(gw, p.words, np.repeat(dw / np.maximum(n, 1)[:, None], n, axis=0))
                g["paths"], g["words"] = gp, gw
                t += 1
                for n in self.NAMES:
                    m, v = moments[n]
                    grad = g[n].astype(np.float32)
                    m += 0.1 * (grad - m)
                    v += 0.01 * (grad**2 - v)
                    step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-7)
                    setattr(self, n, (getattr(self, n) - step).astype(np.float32))


def _wrapped(found: list, rng: np.random.Generator) -> list:
    """The page with plain elements set into every path, at one depth of the page."""
    marks = [(), *((f"w{i}",) for i in rng.integers(1 << 20, size=4))]  # names without a meaning
    new = tuple((("div", "section", "center", "td")[rng.integers(4)], *marks[rng.integers(len(marks))]) for _ in range(rng.integers(1, WRAPPERS + 1)))
    at = int(rng.integers(2, 4))  # around what the body holds, or within it
    return [((*p[:at], *new, *p[at:]), t, k) for p, t, k in found]


def _varied(found: list, others: list[str], rng: np.random.Generator) -> list:
    """The page with its article renamed and strangers' text set in under boilerplate names."""
    kind = rng.integers(3)
    name = MAIN_NAMES[rng.integers(len(MAIN_NAMES))]

    def renamed(path):
        if kind == 0:
            return path
        new = ("main",) if kind == 1 else ("div", name)
        return tuple(new if e[0] in MAIN else e for e in path)

    out = [(renamed(p), t, k) for p, t, k in found]
    for _ in range(rng.integers(2, 7)):
        at = int(rng.integers(len(out) + 1))
        around = out[at - 1][0] if at and rng.random() < 0.5 else (("html",), ("body",))
        word = BOILERPLATE[rng.integers(len(BOILERPLATE))]
        mark = (word,) if rng.random() < 0.4 else (("div", "section", "ul", "p")[rng.integers(4)], word + ("", "-box", "-list")[rng.integers(3)])
        inner = (("p",), ("li",), ("h3",), ("div",))[rng.integers(4)]
        for _ in range(rng.integers(1, 4)):
            text = others[rng.integers(len(others))]
            out.insert(at, ((*around, mark, inner), text, int(len(text) * (rng.random() < 0.3))))
    return out


def fit(pages: DataFrame, rows: int = SAMPLE_PAGES, chars: int = SAMPLE_CHARS) -> Labeller:
    sample = (
        typed(pages, "page_id", "html", types={"page_id": "bigint", "html": "string"})
        .where(F.length("html") <= chars)
        .orderBy(F.xxhash64("page_id", F.lit(3)), "page_id", F.xxhash64("html"))
        .limit(rows)
        .select("html")
        .collect()
    )
    parsed = [b for r in sample if (b := blocks(r["html"]))]
    others = [t for b in parsed for _, t, _ in b]
    rng, cache, data = np.random.default_rng(4), {}, []
    for b in parsed:
        for found in (b, _varied(b, others, rng), _varied(b, others, rng), _wrapped(_varied(b, others, rng), rng)):
            data.append((Page(found, cache), np.array([teacher(p) for p, _, _ in found], np.float32)))
    model = Labeller()
    model.train(data)
    return model


def extract(pages: list[str], model: Labeller, cache: dict) -> list[str]:
    found = [blocks(p) for p in pages]
    if model.fitted:
        keep = model.label([Page(b, cache) for b in found])
    else:
        keep = [[not any(map(_is_boilerplate, p)) for p, _, _ in b] for b in found]
    return [" ".join(t for (_, t, _), ok in zip(b, k) if ok) for b, k in zip(found, keep)]


def extract_pages(spark: SparkSession, pages: DataFrame, model: Labeller) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    shared = Shared(spark, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                texts = extract([h or "" for h in part.column("html").to_pylist()], shared.value, cache)
                cols = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, ["page_id", "url", "text", "n_chars"])

    rows = typed(pages, "page_id", "url", "html", types={"page_id": "bigint", "url": "string", "html": "string"})
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract_pages(spark, pages, fit(pages))
