"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks of text with their tag paths. A bidirectional LSTM in numpy
reads, for every leaf, vectors of its hashed path (tags, classes, ids) and of its hashed words
and a few sizes, and labels it with the whole page in view. It is trained on leaves of a
bounded sample of pages, whose content and surroundings are dealt anew into many layouts.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlake.llm.words import PLAIN, U64, text_words

# Fixed values of HTML: elements without an end tag, elements within a line, elements whose
# content is no markup and no text, other elements whose content is no text, and elements that
# end another of their kind.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data dfn em font i img kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr "
    # Formulas are part of the line that they stand in.
    "math semantics mrow mi mn mo ms mtext mspace msup msub msubsup mfrac msqrt mroot mover munder munderover mstyle mpadded "
    "mphantom menclose merror mtable mtr mtd".split()
)
RAW = "script|style|textarea"
SILENT = set("noscript template svg annotation annotation-xml iframe object canvas audio video select button".split())
ENDS_OWN = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}
HOLDS = set("ul ol dl table article section div main aside nav header footer body form".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + RAW + r")(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*>|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_HAS_SILENT = re.compile("<(?:" + "|".join(sorted(SILENT)) + r")[\s/>]", re.I)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


@dataclass
class Leaf:
    text: str
    path: tuple[str, ...]
    linked: float


def silent_parts(page: str) -> dict[int, int]:
    """Start and end of the silent elements that are closed by an end tag of their own.

    An element that its holder's end tag or the end of the page closes is not among them: what
    follows its start tag is read as text.
    """
    found: dict[int, int] = {}
    if not _HAS_SILENT.search(page):
        return found
    stack: list[tuple[str, int]] = []
    opened: Counter[str] = Counter()
    for match in _TOKEN.finditer(page):
        tag = match["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if match["close"]:
            while opened[tag]:
                name, start = stack.pop()
                opened[name] -= 1
                if name == tag:
                    if tag in SILENT:
                        found[start] = match.end()
                    break
        # Of silent elements only svg can be closed within the start tag; formulas and what svg holds can, too.
        elif tag not in VOID and not (match["attrs"].endswith("/") and tag not in SILENT - {"svg"}):
            stack.append((tag, match.start()))
            opened[tag] += 1
    return found


def leaves(page: str) -> list[Leaf]:
    """Leaf blocks of a page in order; white space within a block is one space, references are decoded."""
    silent, until = silent_parts(page), 0
    out: list[Leaf] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    text: list[str] = []
    path: tuple[str, ...] | None = None
    linked = links = 0

    def flush() -> None:
        nonlocal text, path, linked
        if text:
            own = " ".join(html.unescape("".join(text)).split())
            if own:
                out.append(Leaf(own, path, linked / max(1, sum(map(len, text)))))
        text, path, linked = [], None, 0

    for match in _TOKEN.finditer(page):
        if match.start() < until:
            continue
        piece = match["text"]
        if piece is not None:
            if path is None and not piece.isspace():
                path = stack[-1][1] if stack else ()
            text.append(piece)
            if links:
                linked += len(piece)
            continue
        tag = match["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in SILENT:
            until = silent.get(match.start(), 0)
            continue
        if tag not in INLINE:
            flush()
        elif tag == "br":
            text.append(" ")
        if match["close"]:
            if any(tag == x for x, _ in stack):
                while stack:
                    name, _ = stack.pop()
                    links -= name == "a"
                    if name == tag:
                        break
            continue
        if tag in ENDS_OWN:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in ENDS_OWN[tag]:
                    links -= sum(x == "a" for x, _ in stack[depth:])
                    del stack[depth:]
                    break
                if stack[depth][0] in HOLDS:
                    break
        elif tag in HOLDS and any(x == "p" for x, _ in stack):
            while stack[-1][0] != "p":
                links -= stack.pop()[0] == "a"
            stack.pop()
        if tag not in VOID and not match["attrs"].endswith("/"):
            names = [tag]
            for found in _NAMES.findall(match["attrs"]):
                names += [f".{x.lower()}" for x in _PARTS.findall("".join(found))]
            stack.append((tag, (stack[-1][1] if stack else ()) + tuple(names)))
            links += tag == "a"
    flush()
    return out


# Names in tag paths that mark what surrounds an article, and what holds it.
AROUND = set(
    "nav header footer aside form menu sidebar ad ads advert adverts advertisement promo sponsored banner cookie cookies "
    "consent notice notices alert comment comments reply replies discussion related share social breadcrumb breadcrumbs "
    "newsletter subscribe signup login search widget popup modal head copyright pagination toolbar legal disclaimer".split()
)
HOLDERS = set("article main content post entry story body text".split())


def taught(page: list[Leaf]) -> list[bool]:
    """Which leaves a page's own names mark as its article; without such names, its long unlinked text."""
    names = [{x.lstrip(".") for x in leaf.path} for leaf in page]
    marked = any({"article", "main"} & x for x in names)
    out = []
    for leaf, own in zip(page, names):
        around = bool(own & AROUND)
        inside = bool(own & {"article", "main"}) if marked else bool(own & (HOLDERS - {"body", "text"})) or (
            len(leaf.text) > 80 and leaf.linked < 0.3
        )
        out.append(inside and not around)
    return out


_LAYOUTS = {
    "holder": [("article",), ("main",), ("main", "article"), ("div", ".content"), ("div", ".post", ".body"), ("div", ".entry"),
               ("section", ".story"), ("div", ".main", ".content"), ("div", ".article", ".text"), ("div", ".wrapper", "article"),
               ("div", ".container", "main"), ("article", ".post", "div", ".text")],
    "head": [("html", "head", "title")],
    "header": [("header",), ("div", ".header"), ("header", "div", ".logo"), ("div", ".site", ".header", "h2"), ("header", "h1"), ("div", ".banner")],
    "menu": [("nav", "ul", "li", "a"), ("div", ".menu", "a"), ("ul", ".nav", "li", "a"), ("div", ".breadcrumbs", "a"), ("header", "nav", "a")],
    "sidebar": [("aside", "p"), ("aside", "ul", "li", "a"), ("div", ".sidebar", "p"), ("div", ".sidebar", "ul", "li"), ("aside", ".related", "a"),
                ("div", ".widget", "p"), ("div", ".related", ".posts", "li", "a"), ("aside", "div")],
    "notice": [("div", ".notice"), ("div", ".cookie", ".notice", "p"), ("div", ".cookie", ".banner"), ("div", ".alert"), ("div", ".consent", "p"),
               ("p", ".notice"), ("div", ".legal")],
    "advert": [("div", ".ad"), ("div", ".ads"), ("div", ".advert", "p"), ("div", ".sponsored"), ("div", ".promo", "p"), ("aside", ".ad"),
               ("div", ".advertisement"), ("section", ".promo", "a")],
    "form": [("form", "label"), ("form", "p"), ("div", ".newsletter", "form"), ("form", ".search"), ("div", ".subscribe", "p"), ("div", ".login", "form", "label")],
    "comments": [("div", ".comments", "div", ".comment", "p"), ("section", ".comments", "p"), ("ol", ".comment", ".list", "li", "p"),
                 ("div", ".comment"), ("section", ".discussion", "div", ".reply", "p"), ("div", ".comments", "h3"), ("ul", ".comments", "li")],
    "footer": [("footer",), ("footer", "p"), ("div", ".footer"), ("div", ".footer", "a"), ("footer", "nav", "a"), ("div", ".copyright")],
}


def _lines(rng, texts: list[str], low: int, high: int) -> str:
    words = texts[rng.integers(len(texts))].split()
    n = int(rng.integers(low, high + 1))
    at = int(rng.integers(max(1, len(words) - n)))
    return " ".join(words[at : at + n]) or "x"


def dealt(rng, content: list[Leaf], texts: list[str]) -> tuple[list[Leaf], list[bool]]:
    """A page's content in a layout of chance, with surroundings whose words come from any page."""
    page, labels = [], []

    def put(kind: str, count: int, low: int, high: int, linked: float, inside: tuple[str, ...] = ()) -> None:
        path = _LAYOUTS[kind][rng.integers(len(_LAYOUTS[kind]))]
        for _ in range(count):
            whole = path if path[:1] == ("html",) else ("html", "body") + inside + path
            page.append(Leaf(_lines(rng, texts, low, high), whole, linked))
            labels.append(False)

    def chance(p: float) -> bool:
        return rng.random() < p

    holder = _LAYOUTS["holder"][rng.integers(len(_LAYOUTS["holder"]))]
    if chance(0.8):
        put("head", 1, 3, 12, 0.0)
    if chance(0.5):
        put("header", 1, 1, 8, 0.0)
    if chance(0.8):
        put("menu", int(rng.integers(2, 9)), 1, 3, 1.0)
    for kind, p, count, low, high, linked in (("notice", 0.4, 1, 5, 40, 0.0), ("advert", 0.4, 1, 3, 30, 0.3), ("sidebar", 0.3, 3, 3, 40, 0.5)):
        if chance(p):
            put(kind, int(rng.integers(1, count + 1)), low, high, linked)
    for i, leaf in enumerate(content):
        tag = "h1" if i == 0 and chance(0.7) else "h2" if chance(0.05) else "li" if chance(0.05) else "p"
        if tag == "p" and i and chance(0.06):
            put("advert", 1, 3, 30, 0.3, holder if chance(0.5) else ())
        page.append(Leaf(leaf.text, ("html", "body") + holder + (("ul",) if tag == "li" else ()) + (tag,), leaf.linked))
        labels.append(True)
    for kind, p, count, low, high, linked in (
        ("comments", 0.5, 6, 3, 80, 0.0), ("sidebar", 0.4, 4, 2, 40, 0.5), ("form", 0.4, 2, 1, 12, 0.0), ("advert", 0.3, 1, 3, 30, 0.3),
        ("notice", 0.2, 1, 5, 40, 0.0), ("footer", 0.9, 2, 2, 30, 0.2),
    ):
        if chance(p):
            put(kind, int(rng.integers(1, count + 1)), low, high, linked, holder if kind in ("comments", "form") and chance(0.4) else ())
    return page, labels


_PATHS, _WORDS, _SIZES = 2048, 1024, 5


@dataclass
class Labeller:
    """Parameters of the network: embeddings of path parts and of words, two LSTMs, the output."""

    path_dim: int = 16
    word_dim: int = 4
    hidden: int = 12
    seed: int = 5
    values: dict[str, np.ndarray] = field(default_factory=dict)

    def start(self) -> "Labeller":
        rng = np.random.default_rng(self.seed)
        size, h = self.path_dim + self.word_dim + _SIZES, self.hidden
        self.values = {"paths": rng.normal(0, 0.1, (_PATHS, self.path_dim)), "words": rng.normal(0, 0.1, (_WORDS, self.word_dim)),
                       "out": rng.normal(0, 0.2, (2 * h + size, 1)), "bias": np.zeros(1)}
        for way in ("f", "b"):
            self.values |= {f"{way}in": rng.normal(0, size**-0.5, (size, 4 * h)), f"{way}own": rng.normal(0, h**-0.5, (h, 4 * h)),
                            f"{way}bias": np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)])}
        self.values = {k: v.astype(np.float32) for k, v in self.values.items()}
        return self

    def features(self, page: list[Leaf]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Hashed path parts of each leaf, its words' counts by bucket, and its sizes."""
        paths = [_path_parts(leaf.path) for leaf in page]
        words = np.zeros((len(page), _WORDS), np.float32)
        for first, hashes, places in text_words(pa.array([leaf.text for leaf in page], pa.string()), PLAIN):
            owner = np.repeat(np.arange(len(places) - 1), np.diff(places)) + first
            bucket = (hashes % U64(_WORDS)).astype(np.int64)
            words += np.bincount(owner * _WORDS + bucket, minlength=words.size).reshape(words.shape).astype(np.float32)
        total = words.sum(axis=1)
        words /= np.maximum(total, 1)[:, None]
        n = max(1, len(page))
        sizes = np.stack([
            np.log1p(total) / 4, [min(leaf.linked, 1.0) for leaf in page], np.arange(len(page)) / n,
            [len(leaf.path) / 8 for leaf in page], [(leaf.text[-1:] in ".!?") * 1.0 for leaf in page],
        ], axis=1).astype(np.float32) if page else np.zeros((0, _SIZES), np.float32)
        return paths, words, sizes

    def embed(self, features) -> np.ndarray:
        paths, words, sizes = features
        if not len(paths):
            return np.zeros((0, self.path_dim + self.word_dim + _SIZES), np.float32)
        own = np.stack([self.values["paths"][x].sum(axis=0) for x in paths])
        return np.concatenate([own, words @ self.values["words"], sizes], axis=1)

    def run(self, x: np.ndarray, lengths: np.ndarray):
        """Logits (page, leaf) of padded inputs, and what the backward pass needs."""
        states, kept = [], {}
        for way in ("f", "b"):
            own = x if way == "f" else _reversed(x, lengths)
            h = np.zeros((len(x), self.hidden), np.float32)
            c, outs, trace = np.zeros_like(h), [], []
            gates = own @ self.values[f"{way}in"] + self.values[f"{way}bias"]
            for t in range(x.shape[1]):
                z = gates[:, t] + h @ self.values[f"{way}own"]
                i, f, o = np.split(1 / (1 + np.exp(-np.clip(z[:, : 3 * self.hidden], -20, 20))), 3, axis=1)
                g = np.tanh(z[:, 3 * self.hidden :])
                before = (h, c)
                c = f * c + i * g
                tanh_c = np.tanh(c)
                h = o * tanh_c
                trace.append((before, i, f, o, g, tanh_c))
                outs.append(h)
            outs = np.stack(outs, axis=1) if outs else np.zeros((len(x), 0, self.hidden), np.float32)
            kept[way] = (own, trace)
            states.append(outs if way == "f" else _reversed(outs, lengths))
        whole = np.concatenate([*states, x], axis=2)
        return (whole @ self.values["out"])[:, :, 0] + self.values["bias"], (whole, kept)

    def slopes(self, x, lengths, error, memory) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of all parameters, and of the inputs."""
        whole, kept = memory
        grads = {"out": np.einsum("ptk,pt->k", whole, error)[:, None], "bias": np.array([error.sum()])}
        back = error[:, :, None] * self.values["out"][:, 0]
        to_input = back[:, :, 2 * self.hidden :].copy()
        for k, way in enumerate(("f", "b")):
            flow = back[:, :, k * self.hidden : (k + 1) * self.hidden]
            own, trace = kept[way]
            flow = flow if way == "f" else _reversed(flow, lengths)
            dh = np.zeros((len(x), self.hidden), np.float32)
            dc, dz_all = np.zeros_like(dh), np.zeros((*x.shape[:2], 4 * self.hidden), np.float32)
            grads[f"{way}own"] = np.zeros_like(self.values[f"{way}own"])
            for t in range(x.shape[1] - 1, -1, -1):
                (h, c), i, f, o, g, tanh_c = trace[t]
                dh = dh + flow[:, t]
                dc = dc + dh * o * (1 - tanh_c**2)
                dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tanh_c * o * (1 - o), dc * i * (1 - g**2)], axis=1)
                dz_all[:, t] = dz
                grads[f"{way}own"] += h.T @ dz
                dh, dc = dz @ self.values[f"{way}own"].T, dc * f
            grads[f"{way}in"] = np.einsum("pti,ptj->ij", own, dz_all)
            grads[f"{way}bias"] = dz_all.sum(axis=(0, 1))
            own_input = dz_all @ self.values[f"{way}in"].T
            to_input += own_input if way == "f" else _reversed(own_input, lengths)
        return grads, to_input

    def train(self, pages: list[tuple[list[Leaf], list[bool]]], *, epochs: int = 5, batch: int = 32, rate: float = 0.05, longest: int = 80) -> "Labeller":
        rng = np.random.default_rng(self.seed)
        made = [(self.features(page[:longest]), np.array(labels[:longest], np.float32)) for page, labels in pages if page]
        squares = {k: np.full_like(v, 1e-4) for k, v in self.values.items()}
        for _ in range(epochs):
            order = rng.permutation(len(made))
            for at in range(0, len(order), batch):
                part = [made[i] for i in order[at : at + batch]]
                lengths = np.array([len(y) for _, y in part])
                x, mask = _padded([self.embed(f) for f, _ in part], lengths)
                y = _padded([y[:, None] for _, y in part], lengths)[0][:, :, 0]
                logits, memory = self.run(x, lengths)
                error = (1 / (1 + np.exp(-np.clip(logits, -20, 20))) - y) * mask / mask.sum()
                grads, to_input = self.slopes(x, lengths, error.astype(np.float32), memory)
                grads["paths"], grads["words"] = np.zeros_like(self.values["paths"]), np.zeros_like(self.values["words"])
                for p, (f, _) in enumerate(part):
                    own = to_input[p, : lengths[p]]
                    for leaf, parts in enumerate(f[0]):
                        np.add.at(grads["paths"], parts, own[leaf, : self.path_dim])
                    grads["words"] += f[1].T @ own[:, self.path_dim : self.path_dim + self.word_dim]
                for k, g in grads.items():
                    squares[k] += g**2
                    self.values[k] -= (rate * g / np.sqrt(squares[k])).astype(np.float32)
        return self

    def label(self, pages: list[list[Leaf]]) -> list[np.ndarray]:
        """Chance of each leaf to be main text. Pages of like length run together."""
        out: list = [np.zeros(0)] * len(pages)
        order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
        for at in range(0, len(order), 64):
            part = [i for i in order[at : at + 64] if pages[i]]
            if not part:
                continue
            lengths = np.array([len(pages[i]) for i in part])
            everything = [leaf for i in part for leaf in pages[i]]
            bounds = np.concatenate([[0], np.cumsum(lengths)])
            paths, words, sizes = self.features(everything)
            place = np.arange(len(everything)) - np.repeat(bounds[:-1], lengths)
            sizes[:, 2] = place / np.repeat(lengths, lengths)
            embedded = self.embed((paths, words, sizes))
            x, _ = _padded([embedded[a:b] for a, b in zip(bounds[:-1], bounds[1:])], lengths)
            logits, _ = self.run(x, lengths)
            for row, i in enumerate(part):
                out[i] = 1 / (1 + np.exp(-np.clip(logits[row, : lengths[row]], -20, 20)))
        return out


_KNOWN_PATHS: dict[tuple[str, ...], np.ndarray] = {}


def _path_parts(path: tuple[str, ...]) -> np.ndarray:
    known = _KNOWN_PATHS.get(path)
    if known is None:
        if len(_KNOWN_PATHS) > 20_000:
            _KNOWN_PATHS.clear()
        # Tags within a line say nothing about the block; the last part counts once more.
        parts = [x for x in path if x not in INLINE or x == "a"] or ["none"]
        named = sorted(set(parts)) + [f"last {parts[-1]}"]
        known = _KNOWN_PATHS[path] = np.array([zlib.crc32(x.encode()) % _PATHS for x in named])
    return known


def _padded(rows: list[np.ndarray], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out = np.zeros((len(rows), int(lengths.max(initial=0)), rows[0].shape[1]), np.float32)
    for i, x in enumerate(rows):
        out[i, : len(x)] = x
    return out, (np.arange(out.shape[1]) < lengths[:, None]).astype(np.float32)


def _reversed(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each row's first `length` steps in reverse; padding stays behind."""
    step = np.arange(x.shape[1])
    at = np.where(step < lengths[:, None], lengths[:, None] - 1 - step, step)
    return np.take_along_axis(x, at[:, :, None], axis=1)


def fit(pages: DataFrame, *, sample: int = 240, layouts: int = 3, epochs: int = 6, seed: int = 5, longest: int = 60_000) -> Labeller:
    """Train on at most `sample` different pages, each in `layouts` layouts besides its own.

    They are those of up to `longest` characters whose html hashes smallest; if there are fewer,
    longer ones follow, short ones first, so that pages of any length can teach. They are chosen
    by length and hash; only the html of the chosen ones is read and sent to the driver.
    Without a page that has any text the labeller stays untrained; there is then nothing to label.
    """
    rank = F.struct(F.greatest(F.length("html"), F.lit(longest)).alias("length"), F.xxhash64("html").alias("hash"))
    some = pages.where(F.col("html").isNotNull() & (F.trim("html") != "")).select(rank.alias("_rank"), "html")
    chosen = some.select("_rank").distinct().orderBy("_rank").limit(sample).collect()
    if chosen:
        end = chosen[-1]["_rank"]
        last = F.struct(F.lit(end["length"]).alias("length"), F.lit(end["hash"]).alias("hash"))
        one_each = some.where(F.col("_rank") <= last).groupBy("_rank").agg(F.first("html").alias("html"))
        found = sorted(one_each.collect(), key=lambda r: tuple(r["_rank"]))
    else:
        found = []
    rng = np.random.default_rng(seed)
    parsed = [x for x in (leaves(r["html"]) for r in found) if x]
    texts = [leaf.text for page in parsed for leaf in page if len(leaf.text) > 40] or ["text"]
    made = []
    for page in parsed:
        labels = taught(page)
        made.append((page, labels))
        content = [leaf for leaf, label in zip(page, labels) if label]
        made += [dealt(rng, content, texts) for _ in range(layouts) if content]
    net = Labeller(seed=seed).start()
    return net.train(made, epochs=epochs) if made else net


def extract(pages: DataFrame, net: Labeller, *, cut: float = 0.5) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page.

    `text` joins the blocks of main text in page order by a line feed. Null and empty html and
    pages without main text give the empty text. Broken markup is read as far as it goes; very
    long pages are read whole. Null and repeated ids keep their rows. Other columns are ignored.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                parsed = [leaves(x.as_py() or "") for x in part.column(2)]
                texts = [
                    "\n".join(leaf.text for leaf, p in zip(page, chances) if p >= cut)
                    for page, chances in zip(parsed, net.label(parsed))
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(apply, f"page_id {kind}, url string, text string, n_chars long")
