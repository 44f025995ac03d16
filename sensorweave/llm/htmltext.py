"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks (runs of text between block-level tags) in page order. Each block
becomes a vector: hashed elements of its tag path (names, class, id and role words), hashed words,
and a few numbers (length, link share, capitals, digits, place). A bidirectional LSTM in numpy reads
the whole sequence and labels every block with the context of the document; the text of a page is
its content blocks, joined by a space.

Nobody labels blocks by hand. The labeller is trained on a bounded sample of pages whose blocks get
distant labels from their markup, and on pages laid out anew from the same blocks with the kinds of
containers that pages use.

Defined results: a NULL or empty page, and one without content, has empty text; markup that is not
closed ends with its parent or the page; a comment, script or style that is not closed runs to the
end; unknown references stay as they are; very long pages are read whole (time and memory grow with
their blocks); repeated rows give equal texts; an empty table gives an empty table.
"""

from __future__ import annotations

import html as references
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.llm.common import widened
from sensorweave.llm.neardup import words_at

SAMPLE_PAGES = 300  # documented bound: pages that the labeller is trained on
PATH_DIMS, WORD_DIMS, NUMBERS = 512, 32, 6
DIMS = PATH_DIMS + WORD_DIMS + NUMBERS
HIDDEN = 16
STEP_CELLS = 1 << 16  # blocks of a batch, padding included

# --- fixed values: element names of the HTML standard ---
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes"}
UNSEEN = {"head", "noscript", "template", "svg", "math", "object", "audio", "video", "canvas", "select", "datalist"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark",
    "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img",
}
# --- fixed values: words of class, id and role by which pages name their parts ---
CONTENT_WORDS = {"article", "content", "entry", "main", "post", "story"}
BOILER_TAGS = {"nav", "header", "footer", "aside", "form", "button", "menu", "dialog"}
BOILER_WORDS = {
    "ad", "ads", "advert", "advertisement", "alert", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "contentinfo",
    "cookie", "cookies", "disclaimer", "footer", "form", "header", "links", "login", "masthead", "menu", "modal", "nav", "navbar",
    "navigation", "newsletter", "notice", "pagination", "popup", "promo", "related", "replies", "reply", "search", "share", "sidebar",
    "signup", "social", "sponsor", "sponsored", "subscribe", "tags", "teaser", "toolbar", "warning", "widget",
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^>\"']++)*+)>",
    re.S,
)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
# an opening tag closes these, up to the nearest of the second set
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
_SPACE = re.compile(r"\s+")

Path = tuple[tuple[str, ...], ...]


@dataclass
class Block:
    text: str
    path: Path  # of each element: its name, then "."-words of class, id and role
    linked: int  # characters inside links


def _element(name: str, attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return (name,)
    found = []
    for _, value in _NAMED.findall(attributes):
        found += _WORDS.findall(_CAMEL.sub(" ", value).lower())
    return (name, *("." + w for w in found))


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks of a page, in page order."""
    page = page or ""
    stack: list[tuple[str, ...]] = []
    out: list[Block] = []
    parts: list[str] = []
    state = {"linked": 0, "link": 0, "unseen": 0}

    def flush() -> None:
        if parts:
            text = _SPACE.sub(" ", references.unescape("".join(parts))).strip()
            if text:
                out.append(Block(text, tuple(stack), min(state["linked"], len(text))))
            parts.clear()
        state["linked"] = 0

    def close(depth: int) -> None:
        flush()
        for element in stack[depth:]:
            state["unseen"] -= element[0] in UNSEEN
        del stack[depth:]

    def say(text: str) -> None:
        if text and not state["unseen"]:
            parts.append(text)
            if state["link"]:
                state["linked"] += len(text)

    at = 0
    lower = None
    while True:
        token = _TOKEN.search(page, at)
        if token is None:
            say(page[at:])
            break
        say(page[at : token.start()])
        at = token.end()
        name = token.group(2)
        if name is None:
            if token.group().startswith("<![CDATA["):
                say(references.unescape(token.group()[9:].removesuffix("]]>")).replace("&", "&amp;"))
            continue
        name = name.lower()
        if name in INLINE:
            if name == "a":
                state["link"] = 0 if token.group(1) else 1
            continue
        if token.group(1):  # a closing tag
            if name == "br":
                flush()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    close(depth)
                    break
            else:
                flush()
            continue
        flush()
        state["link"] = 0
        if name in RAW:
            lower = page.lower() if lower is None else lower
            end = lower.find(f"</{name}", at)
            if end < 0:
                break
            at = end
            stop = page.find(">", at)
            at = len(page) if stop < 0 else stop + 1
            continue
        if name in VOID:
            continue
        if name in _CLOSES:
            closed, fence = _CLOSES[name]
            depth = next((d for d in range(len(stack) - 1, -1, -1) if stack[d][0] in closed or stack[d][0] in fence), -1)
            if depth >= 0 and stack[depth][0] in closed:
                close(depth)
        else:
            depth = next((d for d in range(len(stack) - 1, -1, -1) if stack[d][0] == "p"), -1)
            if depth >= 0:  # a paragraph ends where another block begins
                close(depth)
        if name == "body":
            depth = next((d for d, e in enumerate(stack) if e[0] == "head"), -1)
            if depth >= 0:
                close(depth)
        stack.append(_element(name, token.group(3)))
        state["unseen"] += name in UNSEEN
    flush()
    return out


def distant_label(path: Path) -> bool:
    """Content by markup: inside a content container, not inside a boilerplate one."""
    inside = False
    for element in path:
        words = {w[1:] for w in element[1:]}
        if element[0] in BOILER_TAGS or words & BOILER_WORDS:
            return False
        inside = inside or element[0] in ("article", "main") or bool(words & CONTENT_WORDS)
    return inside


_paths: dict[Path, np.ndarray] = {}


def _path_vector(path: Path) -> np.ndarray:
    found = _paths.get(path)
    if found is None:
        found = np.zeros(PATH_DIMS, np.float32)
        for element in path:
            for word in element:
                found[zlib.crc32(word.encode()) % PATH_DIMS] += 1.0
        found = np.minimum(found, 2.0)
        if len(_paths) > 50_000:
            _paths.clear()
        _paths[path] = found
    return found


def vectors(pages: list[list[Block]]) -> list[np.ndarray]:
    """Input vectors (blocks x DIMS) of each page; all blocks are hashed in one go."""
    sizes = [len(p) for p in pages]
    every = [b for p in pages for b in p]
    n = len(every)
    out = np.zeros((n, DIMS), np.float32)
    if n:
        for i, block in enumerate(every):
            out[i, :PATH_DIMS] = _path_vector(block.path)
        coded = [b.text.encode("utf-8", "surrogatepass") for b in every]
        starts = np.cumsum([0, *[len(c) + 1 for c in coded]])[:-1]
        raw = np.frombuffer(b"\n".join(coded) + b"\n", np.uint8)
        hashes, begin = words_at(raw)
        owner = np.searchsorted(starts, begin, side="right") - 1
        cell = owner * WORD_DIMS + (hashes % np.uint64(WORD_DIMS)).astype(np.int64)
        words = np.bincount(cell, np.where(hashes >> np.uint64(63), 1.0, -1.0), n * WORD_DIMS).reshape(n, WORD_DIMS)
        norm = np.sqrt((words * words).sum(axis=1))
        out[:, PATH_DIMS : PATH_DIMS + WORD_DIMS] = words / np.maximum(1, norm)[:, None]
        length = np.array([len(b.text) for b in every], float)
        linked = np.array([b.linked for b in every], float)
        capital = np.add.reduceat(((raw >= 65) & (raw <= 90)).astype(np.int64), starts)
        digit = np.add.reduceat(((raw >= 48) & (raw <= 57)).astype(np.int64), starts)
        many = np.repeat(sizes, sizes)
        place = np.concatenate([np.arange(k) for k in sizes])
        numbers = (np.minimum(np.log1p(length) / 8, 1.0), linked / length, capital / length, digit / length, place / np.maximum(1, many - 1), np.minimum(np.log1p(many) / 6, 1.0))
        out[:, -NUMBERS:] = np.stack(numbers, axis=1)
    return np.split(out, np.cumsum(sizes)[:-1]) if pages else []


class Labeller:
    """Bidirectional LSTM with one output per block."""

    NAMES = ("xf", "hf", "bf", "xb", "hb", "bb", "out", "bias")

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def fresh(cls, seed: int) -> Labeller:
        draw = np.random.default_rng(seed)
        w = {}
        for side in "fb":
            w["x" + side] = draw.normal(0, 1 / np.sqrt(12), (DIMS, 4 * HIDDEN))
            w["h" + side] = draw.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
            w["b" + side] = np.zeros(4 * HIDDEN)
            w["b" + side][HIDDEN : 2 * HIDDEN] = 1.0  # remember at first
        w["out"], w["bias"] = draw.normal(0, 0.2, 2 * HIDDEN), np.zeros(1)
        return cls({k: v.astype(np.float32) for k, v in w.items()})

    @staticmethod
    def _sigmoid(x):
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    def _run(self, x: np.ndarray, side: str, keep: bool):
        """Hidden states (batch, time, HIDDEN) of one direction, and what the way back needs."""
        w_h = self.w["h" + side]
        pre = x @ self.w["x" + side] + self.w["b" + side]
        batch, time = x.shape[:2]
        h = np.zeros((batch, HIDDEN), np.float32)
        c = np.zeros_like(h)
        states, tape = np.zeros((batch, time, HIDDEN), np.float32), []
        for t in range(time):
            z = pre[:, t] + h @ w_h
            gates = self._sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            before, c = c, f * c + i * g
            s = np.tanh(c)
            if keep:
                tape.append((h, before, i, f, o, g, s))
            h = o * s
            states[:, t] = h
        return states, tape

    def _back(self, x, side, tape, d_states):
        """Gradients of one direction."""
        w_h = self.w["h" + side]
        time = x.shape[1]
        d_pre = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
        d_wh = np.zeros_like(w_h)
        dh = np.zeros((x.shape[0], HIDDEN), np.float32)
        dc = np.zeros_like(dh)
        for t in range(time - 1, -1, -1):
            h, before, i, f, o, g, s = tape[t]
            dh = dh + d_states[:, t]
            dc = dc + dh * o * (1 - s * s)
            dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * s * o * (1 - o), dc * i * (1 - g * g)], axis=1)
            d_pre[:, t] = dz
            d_wh += h.T @ dz
            dh, dc = dz @ w_h.T, dc * f
        flat = d_pre.reshape(-1, 4 * HIDDEN)
        return x.reshape(-1, x.shape[2]).T @ flat, d_wh, flat.sum(axis=0)

    @staticmethod
    def _turned(sizes: np.ndarray, time: int) -> np.ndarray:
        """Index that reverses each sequence in place and leaves the padding at the end."""
        place = np.arange(time)[None, :]
        return np.where(place < sizes[:, None], sizes[:, None] - 1 - place, place)

    def logits(self, x: np.ndarray, sizes: np.ndarray, keep: bool = False):
        turn = self._turned(sizes, x.shape[1])
        rows = np.arange(len(x))[:, None]
        ahead, tape_f = self._run(x, "f", keep)
        back, tape_b = self._run(x[rows, turn], "b", keep)
        states = np.concatenate([ahead, back[rows, turn]], axis=2)
        return states @ self.w["out"] + self.w["bias"][0], states, tape_f, tape_b, turn

    def gradients(self, x, sizes, labels):
        z, states, tape_f, tape_b, turn = self.logits(x, sizes, keep=True)
        mask = np.arange(x.shape[1])[None, :] < sizes[:, None]
        dz = np.where(mask, self._sigmoid(z) - labels, 0.0).astype(np.float32) / mask.sum()
        d_states = dz[:, :, None] * self.w["out"]
        rows = np.arange(len(x))[:, None]
        grad = {"out": (states * dz[:, :, None]).sum(axis=(0, 1)), "bias": np.array([dz.sum()], np.float32)}
        grad["xf"], grad["hf"], grad["bf"] = self._back(x, "f", tape_f, d_states[:, :, :HIDDEN])
        grad["xb"], grad["hb"], grad["bb"] = self._back(x[rows, turn], "b", tape_b, d_states[:, :, HIDDEN:][rows, turn])
        return grad

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Content mask of each page; pages of like length share a batch."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        while order:
            time = len(pages[order[-1]])
            most = max(1, STEP_CELLS // time)
            take, order = order[-most:], order[:-most]
            sizes = np.array([len(pages[i]) for i in take])
            x = np.zeros((len(take), time, DIMS), np.float32)
            for row, i in enumerate(take):
                x[row, : len(pages[i])] = pages[i]
            z = self.logits(x, sizes)[0]
            for row, i in enumerate(take):
                out[i] = z[row, : len(pages[i])] >= 0
        return out


# containers that laid-out training pages use, as (name, words); the words are those above
_CONTENT = [("article",), ("main",), ("div", ".content"), ("div", ".post"), ("div", ".entry", ".content"), ("section", ".story"), ("div", ".main"), ("div", ".article", ".body"), ("td", ".content")]
_LEAVES = [("p",), ("p",), ("p",), ("h2",), ("h3",), ("blockquote",), ("ul", "li"), ("ol", "li"), ("pre",), ("figure", "figcaption"), ("table", "tr", "td"), ("div",), ("section", "p")]
_FRAMES = [(), (("div", ".container"),), (("div", ".page"),), (("div", ".wrapper"), ("div", ".row")), (("div",),)]


def laid_out(real: list[list[Block]], count: int, seed: int) -> list[tuple[list[Block], np.ndarray]]:
    """Training pages made of the texts of real ones in other layouts, with their labels."""
    draw = np.random.default_rng(seed)
    good = [b.text for page in real for b in page if distant_label(b.path)] or ["text"]
    bad = [b.text for page in real for b in page if not distant_label(b.path)] or ["menu"]
    words = sorted(BOILER_WORDS)
    tags = sorted(BOILER_TAGS)

    def choice(items):
        return items[int(draw.integers(len(items)))]

    def boiler(under: Path) -> list[tuple[Block, bool]]:
        name = (choice(tags),) if draw.random() < 0.4 else (choice(["div", "div", "section", "ul", "p", "article", "span", "td"]), "." + choice(words))
        leaf = choice([(), ("p",), ("ul", "li"), ("div",), ("a",), ("h2",), ("label",), ("li",), ("div", "p")])
        link = draw.random() < 0.4
        made = []
        for _ in range(int(draw.integers(1, 7))):
            text = choice(bad) if draw.random() < 0.5 else choice(good)[: int(draw.integers(5, 300))]
            path = (*under, name, *((e,) for e in leaf if e != "a"))
            made.append((Block(text, path, len(text) if link else 0), False))
        return made

    pages = []
    for _ in range(count):
        top: Path = (("html",), ("body",), *choice(_FRAMES))
        inner: Path = (*top, choice(_CONTENT), *choice([(), (), (("div",),), (("article",),)]))
        body: list[tuple[Block, bool]] = []
        if draw.random() < 0.8:
            body.append((Block(choice(good)[: int(draw.integers(10, 80))], (*inner, ("h1",)), 0), True))
        for _ in range(int(draw.integers(1, 10))):
            if draw.random() < 0.15:
                body += boiler(inner)
            text = choice(good)
            if draw.random() < 0.4:
                text = text[: int(draw.integers(3, 60))].strip() or text
            body.append((Block(text, (*inner, *((e,) for e in choice(_LEAVES))), 0), True))
        if draw.random() < 0.1:
            body = body[:1]
        before = [b for _ in range(int(draw.integers(0, 4))) for b in boiler(top)]
        after = [b for _ in range(int(draw.integers(0, 4))) for b in boiler(top)]
        if draw.random() < 0.3:
            after += boiler(inner)
        whole = before + body + after
        pages.append(([b for b, _ in whole], np.array([y for _, y in whole], np.float32)))
    return pages


def train(pages: list[tuple[list[Block], np.ndarray]], epochs: int = 12, rate: float = 0.01, batch: int = 32, seed: int = 1) -> Labeller:
    """Adam on the cross-entropy of all blocks. Half of the pages of a batch come without words, so
    that the labeller does not lean on the wording where the markup tells."""
    model = Labeller.fresh(seed)
    pages = [(p, y) for p, y in pages if p]
    data = list(zip(vectors([p for p, _ in pages]), [y for _, y in pages]))
    draw = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in model.w.items()}
    second = {k: np.zeros_like(v) for k, v in model.w.items()}
    step = 0
    for epoch in range(epochs):
        size = np.array([len(y) for _, y in data])
        order = np.argsort(size + draw.random(len(data)) * 8)  # like lengths together, not always the same
        groups = [order[i : i + batch] for i in range(0, len(order), batch)]
        for g in draw.permutation(len(groups)):
            chosen = groups[g]
            sizes = size[chosen]
            x = np.zeros((len(chosen), sizes.max(), DIMS), np.float32)
            labels = np.zeros(x.shape[:2], np.float32)
            for row, i in enumerate(chosen):
                x[row, : sizes[row]], labels[row, : sizes[row]] = data[i]
            x[draw.random(len(chosen)) < 0.5, :, PATH_DIMS : PATH_DIMS + WORD_DIMS] = 0.0
            step += 1
            pace = rate * (1 - 0.9 * epoch / epochs)
            for k, d in model.gradients(x, sizes, labels).items():
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.99 * second[k] + 0.01 * d * d
                m, v = first[k] / (1 - 0.9**step), second[k] / (1 - 0.99**step)
                model.w[k] = (model.w[k] - pace * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return model


def fit(pages: DataFrame, html: str = "html", key: str = "page_id", sample: int = SAMPLE_PAGES, laid: int = 1500, seed: int = 1) -> Labeller:
    """Train on at most `sample` pages, those with the smallest keyed hash, and `laid` laid-out ones."""
    rows = pages.select(F.col(html).alias("html"), F.xxhash64(F.lit(seed), F.col(key)).alias("draw")).where("html IS NOT NULL")
    bound = rows.select("draw").orderBy("draw").limit(sample).agg(F.max("draw")).first()[0]
    got = [] if bound is None else rows.where(F.col("draw") <= bound).orderBy("draw", "html").limit(sample).collect()
    real = [b for b in (blocks(r.html) for r in got) if b]
    told = [(page, np.array([distant_label(b.path) for b in page], np.float32)) for page in real]
    return train([*told, *laid_out(real, laid, seed)], seed=seed)


def extract(pages: DataFrame, model: Labeller, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """`keep` columns plus `text` and `n_chars` of each page."""
    kept = [F.col(c) for c in keep]
    schema = widened(pages.select(*kept), "text string, n_chars long")
    names = schema.names

    def run(batches):
        for batch in batches:
            texts = []
            source = batch.column(batch.num_columns - 1).to_pylist()
            for i in range(0, len(source), 250):
                found = [blocks(h) for h in source[i : i + 250]]
                for page, mask in zip(found, model.label(vectors(found))):
                    texts.append(" ".join(b.text for b, y in zip(page, mask) if y))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=names
            )

    return pages.select(*kept, F.col(html).alias("_html")).mapInArrow(run, schema)
