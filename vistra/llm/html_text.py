"""Main text of web pages: a recurrent labeller over a page's blocks.

A page becomes its sequence of blocks (runs of text between block-level tags),
each with its tag path (element names, classes, ids and roles of what it stands
in) and its words. Path parts and words are hashed into two embedding tables;
a bidirectional LSTM reads a page's blocks in order, so each block's label
depends on the whole document. Blocks labelled as article text are the page's
text.

There are no labelled pages, so the labeller learns from names: what stands in
an element that says what it is (``article``, ``nav``, ``class="ad"``...) gets
its label from the fixed list below. Sampled pages are varied with it: wrappers
get other names and blocks of other pages are put in under the list's names,
so that the labeller sees all of them, and context where names say nothing.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistra.llm.common import draw_rows, table, texts_of

# --- fixed values: HTML's element kinds and common names of page parts -----------------
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img object param "
    # formulas
    "math semantics annotation annotation-xml maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style")  # without an end tag they reach to the end of the page
UNSEEN = ("noscript", "template", "iframe", "svg", "canvas", "annotation", "annotation-xml")  # with an end tag; else they are like others
IN_HEAD = ("meta", "link", "base", "basefont", "bgsound", "html", "head")
MAIN_NAMES = "article main content post entry story body-text article-body post-content entry-content".split()
OTHER_NAMES = (
    "nav navigation menu navbar breadcrumb breadcrumbs header masthead footer sidebar aside widget related notice cookie cookies consent banner alert "
    "ad ads advert advertisement sponsored promo form search login newsletter subscribe comment comments respond reply share social dialog modal popup pagination copyright"
).split()
PARTS = [("ul", "li"), ("ol", "li"), ("table", "tr", "td"), ("table", "tr", "th"), ("h2",), ("h3",), ("blockquote", "p"), ("pre",), ("div",), ("figure", "figcaption"), ("dl", "dd"), ("section", "p")]
LEAVES = [(), ("p",), ("ul", "li"), ("div",), ("h3",), ("label",), ("button",)]
# --- end of fixed values ----------------------------------------------------------

# Bound of what the labeller is trained on: whole pages drawn by hash; a variant of
# a page with more blocks is a window of so many, drawn from anywhere in the page.
FIT_PAGES = 300
FIT_BLOCKS = 120
VARIED_PAGES = 3000  # variants seen in training, however few pages there are
PATH_SLOTS, WORD_SLOTS = 1024, 512
PATH_SIZE, WORD_SIZE, HIDDEN = 16, 8, 16
NUMBERS = 4

# Elements nest this deep at most; one that begins further inside is taken as its content.
DEEPEST = 256
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
_START = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_MARK = re.compile(r"<(?=[a-zA-Z!?/])")
_QUOTES = re.compile(r"[>\"']")
_NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_TITLE_END = re.compile(r"</title\s*>", re.I)
_NAME_PART = re.compile(r"[a-z0-9]+(?:-[a-z0-9]+)*")


class Block:
    __slots__ = ("path", "text", "linked")

    def __init__(self, path: tuple[str, ...], text: str, linked: int):
        self.path, self.text, self.linked = path, text, linked


def _names(tag: str, attributes: str) -> tuple[str, ...]:
    out = [tag]
    if attributes:
        for _, a, b, c in _NAMED.findall(attributes):
            out += _NAME_PART.findall((a or b or c).lower())
    return tuple(out)


class Token:
    """A tag (``name`` in lower case) or other markup (no name) from ``start`` to ``end``."""

    __slots__ = ("start", "end", "closing", "name", "attributes")

    def __init__(self, start: int, end: int, closing: bool = False, name: str = "", attributes: str = ""):
        self.start, self.end, self.closing, self.name, self.attributes = start, end, closing, name, attributes


class Markup:
    """The markup of a page, found in time linear in its length, however broken it is.

    A tag ends at the first ``>`` outside quotes. While tags end, each is looked for
    by a pattern that reads what it takes. At the first that doesn't, the ends
    for all places are found once, from the page's end backwards.
    """

    def __init__(self, page: str):
        self.page = page
        self.places: list[int] | None = None
        self.ends: list[int] = []
        self.last = page.rfind(">")

    def _learn(self) -> None:
        """For each quote or ``>``: where a tag ends that is outside quotes there, -1 for nowhere."""
        found = [(m.start(), m[0]) for m in _QUOTES.finditer(self.page)]
        self.places, self.ends = [at for at, _ in found], [-1] * len(found)
        later = {}
        for i in range(len(found) - 1, -1, -1):
            at, mark = found[i]
            if mark == ">":
                self.ends[i] = at
            else:
                close = later.get(mark, len(found))
                self.ends[i] = self.ends[close + 1] if close + 1 < len(found) else -1
                later[mark] = i

    def _tag(self, at: int) -> Token | None:
        if self.places is None:
            m = _TAG.match(self.page, at)
            if m:
                return Token(at, m.end(), bool(m[1]), m[2].lower(), m[3])
            self._learn()
        # a name may hold quotes; what follows it is searched for the end
        m = _START.match(self.page, at)
        i = bisect_left(self.places, m.end())
        end = self.ends[i] if i < len(self.places) else -1
        return Token(at, end + 1, bool(m[1]), m[2].lower(), self.page[m.end() : end]) if end >= 0 else None

    def next(self, at: int) -> Token | None:
        """The first markup from ``at`` on."""
        page = self.page
        while m := _MARK.search(page, at):
            at = m.start()
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                return Token(at, end + 3 if end >= 0 else len(page))
            if at > self.last:  # nothing ends any more, but a comment may begin
                at = page.find("<!--", at)
                if at < 0:
                    return None
                continue
            if _START.match(page, at) and (tag := self._tag(at)):
                return tag
            if page[at + 1] in "!?/":
                return Token(at, page.index(">", at) + 1)
            at += 1
        return None

    def after_raw(self, tag: str, at: int) -> int:
        """Where the page goes on after a script or style whose start tag ends at ``at``."""
        end = re.compile(rf"</{tag}\s*>", re.I).search(self.page, at)
        return end.end() if end else len(self.page)

    def hidden_ends(self) -> dict[int, int]:
        """Start of each hidden element that has an end tag of its own, and where it ends."""
        ends: dict[int, int] = {}
        starts: dict[str, list[int]] = {tag: [] for tag in UNSEEN}
        at = 0
        while t := self.next(at):
            at = t.end
            if t.name in RAW and not t.closing:
                at = self.after_raw(t.name, at)
            elif t.name in starts:
                if not t.closing:
                    if not (t.name == "svg" and t.attributes.endswith("/")):
                        starts[t.name].append(t.start)
                elif starts[t.name]:
                    ends[starts[t.name].pop()] = t.end
        return ends


def parse_blocks(page: str) -> list[Block]:
    """Blocks of a page in order, with text (references decoded, white space single) and path.

    Broken markup is taken as browsers roughly do: a block element closes an
    open paragraph, an end tag closes what is open inside it, and one without a
    start is ignored. A head ends where the first other content begins.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    links: list[str] = []
    in_link, at, in_head = 0, 0, False
    hidden: dict[int, int] | None = None

    def flush():
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(tuple(n for _, names in stack for n in names), text, len("".join(links))))
            parts.clear()
            links.clear()

    def close(upto: int):
        nonlocal in_link
        for tag, _ in stack[upto:]:
            in_link -= tag == "a"
        del stack[upto:]

    markup, titles = Markup(page), True
    while m := markup.next(at):
        if m.start > at:
            run = page[at : m.start]
            in_head = in_head and run.isspace()
            parts.append(run)
            if in_link:
                links.append(run)
        at = m.end
        if not m.name:
            continue
        tag = m.name
        if tag == "head":
            flush()
            in_head = not m.closing
            continue
        if in_head:
            if m.closing and tag not in ("body", "html") or tag in IN_HEAD:
                continue
            if tag == "title" and titles:
                end = _TITLE_END.search(page, at)
                titles = end is not None  # without an end here there is none further on
                if end:
                    at = end.end()
                    continue
            in_head = tag in (*RAW, "noscript", "template")
        if m.closing:
            if tag not in INLINE:
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
                if stack[i][0] not in INLINE and tag in INLINE:
                    break  # an inline end tag doesn't close a block
            continue
        if tag in RAW:
            flush()
            at = markup.after_raw(tag, at)
            continue
        if tag in UNSEEN:
            if hidden is None:
                hidden = markup.hidden_ends()
            if m.start in hidden:
                if tag not in INLINE:
                    flush()
                at = hidden[m.start]
                continue
            in_head = False
            if tag == "svg" and m.attributes.endswith("/"):
                flush()
                continue
        if tag in INLINE:
            if tag == "br":
                parts.append(" ")
            elif tag not in VOID and not m.attributes.endswith("/") and len(stack) < DEEPEST:
                stack.append((tag, _names(tag, m.attributes)))
                in_link += tag == "a"
            continue
        flush()
        # a block element ends an open paragraph and what is open in it; an item ends the item before
        ends = ("p", tag) if tag in ("li", "dt", "dd", "tr", "td", "th", "option") else ("p",)
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in ends:
                close(i)
                break
            if stack[i][0] not in INLINE and stack[i][0] not in ends:
                break
        while stack and stack[-1][0] in INLINE:  # an unclosed inline element ends with its block
            close(len(stack) - 1)
        if tag not in VOID and len(stack) < DEEPEST:
            stack.append((tag, _names(tag, m.attributes)))
    if at < len(page):
        parts.append(page[at:])
    flush()
    return out


# --- features and weak labels -------------------------------------------------------------


def _slot(text: str, slots: int) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % slots


def weak_label(path: tuple[str, ...]) -> int:
    """1: article text, 0: other, -1: the names don't say. Within an article, another part's name wins."""
    if any(n in _OTHER for n in path):
        return 0
    return 1 if any(n in _MAIN for n in path) else -1


_MAIN, _OTHER = frozenset(MAIN_NAMES), frozenset(OTHER_NAMES)


def numbers_of(block: Block, place: float) -> tuple[float, ...]:
    size = len(block.text)
    return (np.log1p(size) / 8, min(1.0, block.linked / max(1, size)), sum(block.text.count(c) for c in ".!?") / max(1.0, size / 50) / 4, place)


class Features:
    """A batch of pages as padded arrays: path and word slots by block, numbers, and which cells are blocks.

    ``places``: each block's place in its page, where ``pages`` are parts of pages.
    """

    def __init__(self, pages: list[list[Block]], places: list[np.ndarray] | None = None):
        count, length = len(pages), max(1, max((len(p) for p in pages), default=1))
        self.mask = np.zeros((count, length), dtype=bool)
        self.numbers = np.zeros((count, length, NUMBERS))
        path_at, path_slot, word_at, word_slot = [], [], [], []
        slots: dict[str, int] = {}
        words: dict[str, int] = {}
        for i, page in enumerate(pages):
            self.mask[i, : len(page)] = True
            for j, b in enumerate(page):
                cell = i * length + j
                self.numbers[i, j] = numbers_of(b, places[i][j] if places else j / len(page))
                for n in b.path:
                    if n not in slots:
                        slots[n] = _slot(n, PATH_SLOTS)
                    path_at.append(cell)
                    path_slot.append(slots[n])
                for w in b.text.lower().split():
                    if w not in words:
                        words[w] = _slot(w, WORD_SLOTS)
                    word_at.append(cell)
                    word_slot.append(words[w])
        self.path = (np.array(path_at, np.int64), np.array(path_slot, np.int64))
        self.words = (np.array(word_at, np.int64), np.array(word_slot, np.int64))


def _bag(pairs, vectors: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean vector of each cell's slots, and the weight of each pair."""
    at, slot = pairs
    size = np.maximum(np.bincount(at, minlength=cells), 1)
    weight = 1.0 / size[at]
    out = np.zeros((cells, vectors.shape[1]))
    for k in range(vectors.shape[1]):
        out[:, k] = np.bincount(at, weights=vectors[slot, k] * weight, minlength=cells)
    return out, weight


# --- the network ----------------------------------------------------------------------


def new_model(seed: int = 3) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    inputs = PATH_SIZE + WORD_SIZE + NUMBERS
    model = {"path": rng.normal(0, 0.5, (PATH_SLOTS, PATH_SIZE)), "words": rng.normal(0, 0.1, (WORD_SLOTS, WORD_SIZE)), "out": rng.normal(0, 0.2, 2 * HIDDEN), "bias": np.zeros(1)}
    for side in ("f", "b"):
        model[f"w_{side}"] = rng.normal(0, 1 / np.sqrt(inputs + HIDDEN), (inputs + HIDDEN, 4 * HIDDEN))
        model[f"c_{side}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    return model


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _run(model, side: str, x: np.ndarray, mask: np.ndarray, keep: bool):
    """Hidden states of one direction; a padded cell passes the state on unchanged."""
    count, length, _ = x.shape
    w, c = model[f"w_{side}"], model[f"c_{side}"]
    inner = x @ w[: x.shape[2]] + c
    h, s = np.zeros((count, HIDDEN)), np.zeros((count, HIDDEN))
    out, tape = np.zeros((count, length, HIDDEN)), []
    for t in range(length) if side == "f" else range(length - 1, -1, -1):
        z = inner[:, t] + h @ w[x.shape[2] :]
        i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN :])
        on = mask[:, t, None]
        s_new = np.where(on, f * s + i * g, s)
        h_new = np.where(on, o * np.tanh(s_new), h)
        if keep:
            tape.append((t, h, s, i, f, o, g, s_new, on))
        h, s = h_new, s_new
        out[:, t] = h
    return out, tape


def _inputs(model, features: Features):
    count, length = features.mask.shape
    path, path_weight = _bag(features.path, model["path"], count * length)
    words, word_weight = _bag(features.words, model["words"], count * length)
    x = np.concatenate([path.reshape(count, length, -1), words.reshape(count, length, -1), features.numbers], axis=2)
    return x, path_weight, word_weight


def predict(model, pages: list[list[Block]]) -> list[np.ndarray]:
    """Probability of each block of each page to be article text."""
    features = Features(pages)
    x, _, _ = _inputs(model, features)
    both = np.concatenate([_run(model, side, x, features.mask, False)[0] for side in ("f", "b")], axis=2)
    p = _sigmoid(both @ model["out"] + model["bias"])
    return [p[i, : len(page)] for i, page in enumerate(pages)]


def gradients(model, features: Features, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy over labelled blocks (label -1: none) and its gradients, by back-propagation through time."""
    x, path_weight, word_weight = _inputs(model, features)
    runs = {side: _run(model, side, x, features.mask, True) for side in ("f", "b")}
    both = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)
    p = _sigmoid(both @ model["out"] + model["bias"])
    known = (labels >= 0) & features.mask
    total = max(1, known.sum())
    loss = -np.where(known, np.where(labels == 1, np.log(p + 1e-12), np.log(1 - p + 1e-12)), 0).sum() / total
    error = np.where(known, p - labels, 0) / total
    grads = {"out": np.einsum("bt,bth->h", error, both), "bias": np.array([error.sum()])}
    d_both, d_x = error[:, :, None] * model["out"], np.zeros_like(x)
    for n, side in enumerate(("f", "b")):
        w = model[f"w_{side}"]
        d_out, (_, tape) = d_both[:, :, n * HIDDEN : (n + 1) * HIDDEN], runs[side]
        d_w, d_c = np.zeros_like(w), np.zeros_like(model[f"c_{side}"])
        d_h, d_s = np.zeros((len(x), HIDDEN)), np.zeros((len(x), HIDDEN))
        for t, h, s, i, f, o, g, s_new, on in reversed(tape):
            d_h = d_h + d_out[:, t]
            th = np.tanh(s_new)
            ds = d_s + np.where(on, d_h * o * (1 - th * th), 0)
            dz = np.concatenate([ds * g * i * (1 - i), ds * s * f * (1 - f), d_h * th * o * (1 - o), ds * i * (1 - g * g)], axis=1) * on
            d_w[: x.shape[2]] += x[:, t].T @ dz
            d_w[x.shape[2] :] += h.T @ dz
            d_c += dz.sum(axis=0)
            d_x[:, t] += dz @ w[: x.shape[2]].T
            d_h = np.where(on, dz @ w[x.shape[2] :].T, d_h)
            d_s = np.where(on, ds * f, d_s)
        grads[f"w_{side}"], grads[f"c_{side}"] = d_w, d_c
    flat = d_x.reshape(-1, x.shape[2])
    for name, (at, slot), weight, low in (("path", features.path, path_weight, 0), ("words", features.words, word_weight, PATH_SIZE)):
        size = model[name].shape[1]
        grads[name] = np.zeros_like(model[name])
        np.add.at(grads[name], slot, flat[at, low : low + size] * weight[:, None])
    return float(loss), grads


def vary(pages: list[list[Block]], rng: np.random.Generator) -> tuple[list[list[Block]], list[np.ndarray], list[np.ndarray]]:
    """Pages, labels and places in the whole page to learn from: renamed wrappers, and other pages' blocks under the list's names.

    Of a page with more than FIT_BLOCKS blocks, a window from anywhere in it.
    """
    pool = [b for page in pages for b in page]
    out, labels, places = [], [], []
    for page in pages:
        first, total = 0, len(page)
        if total > FIT_BLOCKS:
            first = int(rng.integers(0, total - FIT_BLOCKS + 1))
            page = page[first : first + FIT_BLOCKS]
        kept = [(b, weak_label(b.path)) for b in page]
        main = str(rng.choice(MAIN_NAMES))
        rename = rng.random() < 0.5
        blocks = []
        for b, y in kept:
            path = b.path
            if y == 1 and rename:
                path = tuple(x for n in path for x in (("div", main) if n in _MAIN else (n,)))
            text = b.text
            if y == 1 and rng.random() < 0.15:  # articles hold more than paragraphs, and short blocks
                path = (*path[:-1], *PARTS[int(rng.integers(len(PARTS)))])
                text = " ".join(text.split(" ")[: int(rng.integers(1, 20))])
            blocks.append((Block(path, text, min(b.linked, len(text))), y))
        for _ in range(int(rng.integers(0, 4))):
            name, at = str(rng.choice(OTHER_NAMES)), int(rng.integers(0, len(blocks) + 1))
            near = blocks[min(at, len(blocks) - 1)][0].path if blocks else ()
            around = near[:-1] if rng.random() < 0.5 else ("html", "body")
            inner = [pool[int(rng.integers(len(pool)))] for _ in range(int(rng.integers(1, 4)))] if pool else []
            tag = str(rng.choice(["div", "section", "aside", name]))
            leaves = [LEAVES[int(rng.integers(len(LEAVES)))] for _ in inner]
            blocks[at:at] = [(Block((*around, *dict.fromkeys((tag, name)), *leaf), b.text, b.linked), 0) for b, leaf in zip(inner, leaves)]
        out.append([b for b, _ in blocks])
        places.append((first + np.arange(len(blocks))) / max(1, total + len(blocks) - len(page)))
        labels.append(np.array([y for _, y in blocks], dtype=np.int64))
    return out, labels, places


def train(pages: list[list[Block]], variants: int = VARIED_PAGES, seed: int = 3, batch: int = 25) -> dict[str, np.ndarray]:
    """A labeller trained on varied pages with Adam; bounded by FIT_PAGES and FIT_BLOCKS."""
    rng, model = np.random.default_rng(seed), new_model(seed)
    mean, square, step = {k: np.zeros_like(v) for k, v in model.items()}, {k: np.zeros_like(v) for k, v in model.items()}, 0
    pages = [p for p in pages if p]
    for _ in range(-(-variants // len(pages)) if pages else 0):
        varied, labels, places = vary(pages, rng)
        order = np.argsort([len(p) + rng.random() for p in varied])
        groups = [order[i : i + batch] for i in range(0, len(order), batch)]
        for g in rng.permutation(len(groups)):
            part = [varied[i] for i in groups[g]]
            features = Features(part, [places[i] for i in groups[g]])
            y = np.full(features.mask.shape, -1, dtype=np.int64)
            for i, k in enumerate(groups[g]):
                y[i, : len(labels[k])] = labels[k]
            _, grads = gradients(model, features, y)
            step += 1
            for k, d in grads.items():
                mean[k] = 0.9 * mean[k] + 0.1 * d
                square[k] = 0.99 * square[k] + 0.01 * d * d
                model[k] -= 0.02 * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
    return model


# --- Spark ------------------------------------------------------------------------------


def fit_labeller(pages: DataFrame, rows: int = FIT_PAGES, text: str = "html") -> dict[str, np.ndarray]:
    """A labeller from ``rows`` pages drawn by hash (they and the training are bounded)."""
    by = [text, *(c for c in ("page_id", "url") if c in pages.columns and c != text)]
    drawn = draw_rows(pages.filter(F.col(text).isNotNull()).select(*by), rows, *by)
    return train([parse_blocks(r[0]) for r in drawn])


def extract_text(pages: DataFrame, model: dict[str, np.ndarray], keep: list[str] = ("page_id", "url"), text: str = "html") -> DataFrame:
    """Every row with the columns in ``keep``, ``text`` (blocks joined by line feeds) and ``n_chars``. No shuffle.

    Null html: empty text. Repeated and null keys are rows of their own.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)
    source = pages.select(F.col(text).cast("string").alias("_html"), *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)])
    names = [f"_keep{i}" for i in range(len(keep))]

    def label(batches):
        for batch in batches:
            found = [parse_blocks(t) for t in texts_of(batch, "_html")]
            texts = [""] * len(found)
            # pages of like length together, so that little is padded; at most some 20,000 blocks at once
            order = sorted((i for i in range(len(found)) if found[i]), key=lambda i: len(found[i]))
            while order:
                size = max(1, min(256, 20_000 // len(found[order[-1]])))
                part, order = order[-size:], order[:-size]
                for i, p in zip(part, predict(shared.value, [found[i] for i in part]), strict=True):
                    texts[i] = "\n".join(b.text for b, q in zip(found[i], p) if q > 0.5)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*names, "text", "n_chars"])

    ddl = ", ".join([*(f"{n} {pages.schema[c].dataType.simpleString()}" for n, c in zip(names, keep)), "text string", "n_chars bigint"])
    return source.mapInArrow(label, ddl).select(*[F.col(n).alias(c) for n, c in zip(names, keep)], "text", "n_chars")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    pages = table(spark, sf_dir, "pages")
    return extract_text(pages, fit_labeller(pages))
