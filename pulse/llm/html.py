"""Main text of web pages by a recurrent block labeller.

A page is cut into its leaf blocks of text. Each block becomes a vector: hashed names of the tags
around it with their classes and ids, hashed words, and a few measures. A bidirectional LSTM reads
the whole sequence of a page's blocks, so that what stands before and after a block counts, and gives
each the probability of belonging to the article. The text is the blocks above one half, in order.

The network is trained by back-propagation on pages whose article is marked in the page itself
(`article` or `main`), a sample of at most `sample_pages` of at most `sample_chars` characters. Menus,
sidebars, forms, adverts, notices and reader comments inside the mark, known by their tags or names,
are not article. Each sampled page is also laid out anew in several ways, with other containers,
and with such parts around the article and inside it, made of text of the sample, so that tag names
are not all that the network learns.

Markup is read in a single pass that looks at every character a bounded number of times: what is
looked for and not found once, such as the end of a tag, is not looked for again. A block keeps a link to
its innermost container, which holds the hashed names of all around it. Text in comments, scripts,
styles, the head, form fields, drawings and the like is no block. Inline tags, formulas, embedded media
with what they hold, and line breaks do not end a block.

Defined results: a null or empty page has an empty text; a page without blocks too; broken or
unclosed markup is read as far as it goes; equal pages give equal texts; without a marked page in the
sample the network is trained on made-up layouts of the sample's own text, and an empty table
gives no rows and trains nothing. Other columns pass through, one with the name of the output is replaced.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections import Counter
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import in_parts, text_or_empty

# Names of the HTML standard.
SKIPPED = (
    "script style noscript template head title textarea select option button iframe datalist"
).split()
INLINE = (
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr input progress output "
    "svg object canvas audio video picture source track param embed "
    "math semantics annotation annotation-xml maction menclose merror mfrac mi mmultiscripts mn mo "
    "mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd "
    "mtext mtr munder munderover"
).split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
CLOSED_BY_NEXT = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}

# Elements whose content is no markup, and others that are skipped if they are closed.
RAW = "script style textarea title iframe".split()
SKIPPED_IF_CLOSED = "svg template noscript".split()
# Tags and names of what stands inside an article's mark without being article.
NOT_ARTICLE = {
    *"nav aside footer form dialog".split(),
    *".nav .menu .navbar .navigation .breadcrumbs .toc .footer .copyright".split(),
    *".sidebar .related .widget .recommended .trending .rail".split(),
    *".cookie .consent .popup .newsletter .subscribe .modal .notice".split(),
    *".ad .ads .advert .advertisement .sponsored .promo .promotion".split(),
    *".comments .comment .discussion .replies .responses .respond .share .social".split(),
}

TAG_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)")
TAG_STOP = re.compile(r">|=\s*+([\"'])")
END_OF = {name: re.compile(rf"</{name}\s*+>", re.I) for name in (*RAW, *SKIPPED_IF_CLOSED)}
NAMES = re.compile(r"\b(?:class|id|role)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))", re.I)
NAME_PARTS = re.compile(r"[A-Za-z]+")
WHITE = " \t\n\x0b\x0c\r"

PATH_SIZE = 96
WORD_SIZE = 48
MEASURES = 8
INPUT_SIZE = PATH_SIZE + WORD_SIZE + MEASURES


@dataclass(frozen=True)
class Settings:
    sample_pages: int = 200
    sample_chars: int = 200_000
    layouts: int = 6
    blocks_a_page: int = 40
    hidden: int = 16
    epochs: int = 10
    batch: int = 32
    rate: float = 0.01
    seed: int = 11


def bucket(name: str, size: int, cache: dict) -> int:
    known = cache.get(name)
    if known is None:
        if len(cache) > 200_000:
            cache.clear()
        known = cache[name] = zlib.crc32(name.encode()) % size
    return known


PATH_CACHE: dict[str, int] = {}
WORD_CACHE: dict[str, int] = {}


class Path:
    """A container: the one around it, its names, the hashed names of both, and whether it is in the
    article's mark (1), in something else inside that (2), or neither (0)."""

    __slots__ = ("around", "own", "bits", "marked")

    def __init__(self, around: Path | None, own: tuple[str, ...]):
        self.around, self.own = around, own
        self.bits = around.bits if around else 0
        for name in own:
            self.bits |= 1 << bucket(name, PATH_SIZE, PATH_CACHE)
        marked = around.marked if around else 0
        if not marked and own[0] in ("article", "main"):
            marked = 2 if ".comment" in own else 1
        elif marked == 1 and not NOT_ARTICLE.isdisjoint(own):
            marked = 2
        self.marked = marked

    @classmethod
    def of(cls, names: tuple[str, ...]) -> Path | None:
        """From names outermost first, a container each; those with a dot belong to the one before."""
        path, own = None, []
        for name in names:
            if name[0] != "." and own:
                path, own = cls(path, tuple(own)), []
            own.append(name)
        return cls(path, tuple(own)) if own else path

    @property
    def names(self) -> tuple[str, ...]:
        parts, at = [], self
        while at:
            parts.append(at.own)
            at = at.around
        return tuple(name for own in reversed(parts) for name in own)


class Block(NamedTuple):
    """A leaf block: its text, its innermost container, characters inside links."""

    text: str
    path: Path | None
    linked: int

    @property
    def in_article(self) -> bool:
        return self.path is not None and self.path.marked == 1


def markup(page: str):
    """Texts, as (None, text), and tags, as (name, attributes), the name with a slash if it closes."""
    at, size = 0, len(page)
    # Up to here quotes in tags are not looked at: a tag that began before did not end outside them.
    unquoted_to = 0
    unclosed: set[str] = set()
    while at < size:
        start = page.find("<", at)
        if start < 0:
            yield None, page[at:]
            return
        if start > at:
            yield None, page[at:start]
        if page.startswith("<!--", start):
            stop = page.find("-->", start + 4)
            at = size if stop < 0 else stop + 3
            continue
        tag = TAG_NAME.match(page, start + 1)
        if not tag and page[start + 1 : start + 2] not in ("!", "?", "/"):
            yield None, "<"
            at = start + 1
            continue
        at = tag.end() if tag else start + 1
        stop = -1
        if start >= unquoted_to:
            look = at
            while found := TAG_STOP.search(page, look):
                if not found.group(1):
                    stop = found.start()
                    break
                look = page.find(found.group(1), found.end()) + 1
                if not look:
                    break
            if stop < 0:
                unquoted_to = size
        if stop < 0:
            stop = page.find(">", at)
        if stop < 0:
            # No tag ends any more.
            yield None, page[start:].partition("<!--")[0]
            return
        attributes, at = page[at:stop], stop + 1
        if not tag:
            continue
        name = tag.group(2).lower()
        if tag.group(1) or name not in END_OF:
            yield tag.group(1) + name, attributes
        elif name in RAW:
            end = END_OF[name].search(page, at)
            at = end.end() if end else size
        elif not attributes.endswith("/") and name not in unclosed:
            end = END_OF[name].search(page, at)
            if end:
                at = end.end()
            else:
                unclosed.add(name)


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks in order."""
    blocks: list[Block] = []
    stack: list[tuple[str, Path]] = []
    opened: Counter[str] = Counter()
    parts: list[str] = []
    linked = in_link = hidden = 0

    def end_block():
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                path = stack[-1][1] if stack else None
                blocks.append(Block(text, path, min(linked, len(text))))
            parts.clear()
        linked = 0

    def close(to: int):
        nonlocal hidden
        end_block()
        for tag, _ in stack[to:]:
            hidden -= tag in SKIPPED
            opened[tag] -= 1
        del stack[to:]

    for tag, content in markup(page):
        if tag is None:
            if not hidden:
                text = html.unescape(content)
                parts.append(text)
                linked += len(text) * in_link
            continue
        closing = tag[0] == "/"
        tag = tag.lstrip("/")
        if tag in INLINE or tag in END_OF:
            if tag == "br":
                parts.append(" ")
            if tag == "a":
                in_link = 0 if closing else 1
            continue
        if closing:
            if tag == "body" or tag == "html":
                continue
            if opened[tag]:
                to = len(stack) - 1
                while stack[to][0] != tag:
                    to -= 1
                close(to)
            else:
                end_block()
            continue
        if stack and tag in CLOSED_BY_NEXT and stack[-1][0] in CLOSED_BY_NEXT[tag]:
            close(len(stack) - 1)
        elif tag == "body" and hidden:
            close(0)
        end_block()
        if tag in VOID or content.endswith("/"):
            continue
        names = [tag]
        for found in NAMES.findall(content):
            names.extend("." + part.lower() for part in NAME_PARTS.findall("".join(found)))
        stack.append((tag, Path(stack[-1][1] if stack else None, tuple(names))))
        opened[tag] += 1
        hidden += tag in SKIPPED
    close(0)
    return blocks


def vectors(blocks: list[Block]) -> np.ndarray:
    """One row of INPUT_SIZE per block."""
    rows = np.zeros((len(blocks), INPUT_SIZE), np.float32)
    bits = b"".join((path.bits if path else 0).to_bytes(PATH_SIZE // 8, "little") for _, path, _ in blocks)
    paths = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")
    rows[:, :PATH_SIZE] = paths.reshape(-1, PATH_SIZE)
    for row, (text, _, linked) in zip(rows, blocks, strict=True):
        words = text.split()
        hashed = np.bincount(
            [bucket(word.lower(), WORD_SIZE, WORD_CACHE) for word in words], minlength=WORD_SIZE
        )
        row[PATH_SIZE : PATH_SIZE + WORD_SIZE] = hashed / np.sqrt((hashed * hashed).sum())
        n = len(words)
        row[PATH_SIZE + WORD_SIZE :] = (
            np.log1p(n) / 4,
            min(n, 10) / 10,
            linked / len(text),
            text.count(",") / n,
            text[-1] in ".!?…:;\"”»",
            sum(map(text.count, "|©·»")) / n,
            text[0].isupper(),
            n > 1,
        )
    return rows


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Labeller:
    """A bidirectional LSTM with one output per block, in numpy."""

    def __init__(self, hidden: int, seed: int):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.weights: dict[str, np.ndarray] = {"out": rng.normal(0, 0.3, 2 * hidden), "out_b": np.zeros(1)}
        for side in ("fw", "bw"):
            scale = 1 / np.sqrt(INPUT_SIZE / 8)
            self.weights[side + "_x"] = rng.normal(0, scale, (INPUT_SIZE, 4 * hidden))
            self.weights[side + "_h"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden))
            bias = np.zeros(4 * hidden)
            bias[hidden : 2 * hidden] = 1
            self.weights[side + "_b"] = bias
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}

    def run(self, side: str, x: np.ndarray, mask: np.ndarray, keep: bool):
        """States of one direction over (time, page, input); padding keeps the state as it is.

        What the gradients need of every step is kept on request only: pages may be long."""
        w, h = self.weights, self.hidden
        steps, pages = x.shape[:2]
        given = x @ w[side + "_x"] + w[side + "_b"]
        state = cell = np.zeros((pages, h), np.float32)
        states = np.zeros((steps, pages, h), np.float32)
        saved = []
        order = range(steps) if side == "fw" else range(steps - 1, -1, -1)
        for t in order:
            gates = given[t] + state @ w[side + "_h"]
            opening = sigmoid(gates[:, : 3 * h])
            i, f, o = opening[:, :h], opening[:, h : 2 * h], opening[:, 2 * h :]
            g = np.tanh(gates[:, 3 * h :])
            m = mask[t][:, None]
            fresh = f * cell + i * g
            squashed = np.tanh(fresh)
            if keep:
                saved.append((t, state, cell, i, f, o, g, squashed, m))
            cell = m * fresh + (1 - m) * cell
            state = m * (o * squashed) + (1 - m) * state
            states[t] = state
        return states, saved

    def probabilities(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        fw, fw_saved = self.run("fw", x, mask, keep)
        bw, bw_saved = self.run("bw", x, mask, keep)
        both = np.concatenate([fw, bw], axis=2)
        return sigmoid(both @ self.weights["out"] + self.weights["out_b"][0]), both, fw_saved, bw_saved

    def gradients(self, x: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over all blocks."""
        h, w = self.hidden, self.weights
        p, both, *saved = self.probabilities(x, mask, keep=True)
        error = ((p - labels) * mask / mask.sum()).astype(np.float32)
        grads = {"out": np.einsum("tp,tph->h", error, both), "out_b": error.sum(keepdims=True)[0]}
        spread = error[:, :, None] * w["out"]
        for side, steps, part in zip(("fw", "bw"), saved, (spread[:, :, :h], spread[:, :, h:]), strict=True):
            d_gates = np.zeros((*x.shape[:2], 4 * h), np.float32)
            d_h = np.zeros_like(w[side + "_h"])
            d_state = d_cell = np.zeros((x.shape[1], h), np.float32)
            for t, state, cell, i, f, o, g, squashed, m in reversed(steps):
                d_state = d_state + part[t]
                d_new, d_fresh = d_state * m, d_cell * m
                d_fresh = d_fresh + d_new * o * (1 - squashed * squashed)
                gate = np.concatenate(
                    [
                        d_fresh * g * i * (1 - i),
                        d_fresh * cell * f * (1 - f),
                        d_new * squashed * o * (1 - o),
                        d_fresh * i * (1 - g * g),
                    ],
                    axis=1,
                )
                d_gates[t] = gate
                d_h += state.T @ gate
                d_state = d_state * (1 - m) + gate @ w[side + "_h"].T
                d_cell = d_cell * (1 - m) + d_fresh * f
            flat = d_gates.reshape(-1, 4 * h)
            grads[side + "_x"] = x.reshape(-1, x.shape[2]).T @ flat
            grads[side + "_h"], grads[side + "_b"] = d_h, flat.sum(axis=0)
        return grads


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(page) for page in pages)
    x = np.zeros((steps, len(pages), INPUT_SIZE), np.float32)
    mask = np.zeros((steps, len(pages)), np.float32)
    for at, page in enumerate(pages):
        x[: len(page), at] = page
        mask[: len(page), at] = 1
    return x, mask


def fit(pages: list[tuple[np.ndarray, np.ndarray]], settings: Settings) -> Labeller:
    """Adam over batches of pages of like length."""
    model = Labeller(settings.hidden, settings.seed)
    order = random.Random(settings.seed)
    pages = sorted(pages, key=lambda page: len(page[0]))
    batches = [pages[i : i + settings.batch] for i in range(0, len(pages), settings.batch)]
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    step = 0
    for _ in range(settings.epochs):
        order.shuffle(batches)
        for batch in batches:
            step += 1
            x, mask = padded([page for page, _ in batch])
            labels = np.zeros(mask.shape, np.float32)
            for at, (_, marks) in enumerate(batch):
                labels[: len(marks), at] = marks
            for name, grad in model.gradients(x, mask, labels).items():
                grad = np.clip(grad, -1, 1)
                first[name] = 0.9 * first[name] + 0.1 * grad
                second[name] = 0.99 * second[name] + 0.01 * grad * grad
                rate = settings.rate * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                model.weights[name] = (
                    model.weights[name] - rate * first[name] / (np.sqrt(second[name]) + 1e-8)
                ).astype(np.float32)
    return model


# Names that pages give to the containers of articles and of what surrounds them.
ARTICLE = "article main .content .post .entry .story .text .body .article .page".split()
MENUS = "nav .menu .navbar .navigation .breadcrumbs .topbar .links .toc".split()
HEADERS = "header .header .masthead .banner .site .logo .top".split()
FOOTERS = "footer .footer .copyright .bottom .legal .colophon".split()
SIDES = "aside .sidebar .related .widget .recommended .trending .rail .more".split()
NOTICES = ".cookie .notice .consent .alert .popup .newsletter .subscribe .modal dialog".split()
ADVERTS = ".ad .ads .advert .sponsored .promo .promotion .sponsor".split()
FORMS = "form .form .search .login .signup".split()
COMMENTS = ".comments .comment .discussion .replies .responses .respond".split()
SHARING = ".share .social .tags .meta .byline .author .pagination".split()


class Layouts:
    """Pages laid out anew from blocks of article text and of other text."""

    def __init__(self, seed: int, articles: list[list[str]], others: list[str]):
        self.random = random.Random(seed)
        self.articles = articles
        self.others = others or ["Home", "Contact us", "All rights reserved"]

    def prose(self, most: int) -> list[str]:
        lines = self.random.choice(self.articles)
        start = self.random.randrange(len(lines))
        return lines[start : start + self.random.randint(1, most)]

    def short(self) -> str:
        words = self.random.choice(self.others).split()
        start = self.random.randrange(len(words))
        return " ".join(words[start : start + self.random.randint(1, 4)])

    def container(self, names: list[str]) -> tuple[str, ...]:
        name = self.random.choice(names)
        return (name,) if name[0] != "." else (self.random.choice(["div", "section"]), name)

    def part(self, names: list[str], kind: str, inside: tuple[str, ...] = ("body",)) -> list[tuple]:
        around = (*inside, *self.container(names))
        rows = []
        if kind == "menu":
            for _ in range(self.random.randint(2, 8)):
                text = self.short()
                rows.append((text, (*around, "ul", "li"), len(text)))
        elif kind == "prose":
            for text in self.prose(4):
                rows.append((text, (*around, *self.random.choice([("p",), (), ("div",), ("ul", "li")])), 0))
        else:
            text = self.random.choice(self.others) if self.random.random() < 0.6 else self.prose(1)[0]
            rows.append((text, (*around, *self.random.choice([("p",), (), ("div",)])), 0))
        return rows

    def page(self, article: list[str]) -> tuple[list[Block], list[int]]:
        """Blocks and labels of one page around an article."""
        pick, blocks, labels = self.random, [], []

        def put(rows, label=0):
            blocks.extend(rows)
            labels.extend([label] * len(rows))

        def maybe(chance, names, kind):
            if pick.random() < chance:
                put(self.part(names, kind))

        maybe(0.3, NOTICES, "line")
        maybe(0.5, HEADERS, "line")
        maybe(0.7, MENUS, "menu")
        maybe(0.4, ADVERTS, "line")
        maybe(0.2, FORMS, "line")
        maybe(0.2, SIDES, pick.choice(["menu", "prose"]))
        around = ("body", *self.container(ARTICLE)) if pick.random() < 0.9 else ("body", "div")
        if pick.random() < 0.3:
            around = ("body", "div", *around[1:])
        if pick.random() < 0.7:
            put([(article[0][:60], (*around, pick.choice(["h1", "h2"])), 0)], 1)
        for text in article:
            tail = pick.choice([("p",)] * 12 + [("blockquote", "p"), ("ul", "li"), ("div",), ("h2",), ("pre",), ("table", "tr", "td")])
            put([(text, (*around, *tail), 0)], 1)
            if pick.random() < 0.08:
                put(self.part(pick.choice([ADVERTS, SHARING, NOTICES, SIDES]), "line", around))
        for names, kind in ((SIDES, "menu"), (MENUS, "menu"), (FORMS, "line"), (COMMENTS, "prose"), (FOOTERS, "line")):
            if pick.random() < 0.15:
                put(self.part(names, kind, around))
        maybe(0.3, SHARING, pick.choice(["menu", "line"]))
        maybe(0.4, COMMENTS, "prose")
        maybe(0.3, SIDES, pick.choice(["menu", "prose"]))
        maybe(0.3, ADVERTS, "line")
        maybe(0.2, FORMS, "line")
        maybe(0.7, FOOTERS, pick.choice(["menu", "line", "line"]))
        return [Block(text, Path.of(path), linked) for text, path, linked in blocks], labels


def training_pages(pages: list[str], settings: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """Vectors and labels of the sampled pages, as they are and laid out anew."""
    marked, articles, others = [], [], []
    for page in pages:
        blocks = blocks_of(page)
        labels = [int(block.in_article) for block in blocks]
        if any(labels):
            marked.append((blocks, labels))
        inside = [text for (text, _, _), label in zip(blocks, labels, strict=True) if label]
        article = inside or [text for text, _, _ in blocks if len(text) > 80]
        if article:
            articles.append(article)
        others.extend(text for (text, _, _), label in zip(blocks, labels, strict=True) if not label)
    if not articles:
        return []
    layouts = Layouts(settings.seed, articles, others)
    for article in articles:
        for _ in range(settings.layouts):
            start = layouts.random.randrange(max(1, len(article) // 2))
            marked.append(layouts.page(article[start : start + layouts.random.randint(1, 25)]))
    result = []
    for blocks, labels in marked:
        rows = vectors(blocks)
        for start in range(0, len(rows), settings.blocks_a_page):
            stop = start + settings.blocks_a_page
            result.append((rows[start:stop], np.array(labels[start:stop], np.float32)))
    return result


def train(pages: DataFrame, page: str = "html", order: str = "page_id", settings: Settings = Settings()) -> Labeller | None:
    """Fit on the sample: the first pages by a hash of their id, of those that are not too long for the
    driver. None if no such page has text.

    The hashes are picked first, so that no task sends pages that are not in the sample."""
    keyed = pages.where(F.length(page).between(1, settings.sample_chars)).select(F.xxhash64(order).alias("at"), page)
    first = keyed.select("at").distinct().orderBy("at").limit(settings.sample_pages).collect()
    sample = keyed.where(F.col("at").isin([row["at"] for row in first]))
    chosen = sample.groupBy("at").agg(F.min(page).alias("page")).collect() if first else []
    chosen.sort(key=lambda row: row["at"])
    examples = training_pages([row["page"] for row in chosen], settings)
    return fit(examples, settings) if examples else None


def main_texts(pages: list[str], model: Labeller) -> list[str]:
    """Main text of every page; pages of like length share a run of the network."""
    blocks = [blocks_of(page) for page in pages]
    texts = [""] * len(pages)
    order = sorted((at for at in range(len(pages)) if blocks[at]), key=lambda at: len(blocks[at]))
    group: list[int] = []

    def label():
        x, mask = padded([vectors(blocks[at]) for at in group])
        found = model.probabilities(x, mask)[0] > 0.5
        for column, at in enumerate(group):
            chosen = zip(blocks[at], found[:, column], strict=False)
            texts[at] = "\n".join(block[0] for block, yes in chosen if yes)
        group.clear()

    for at in order:
        group.append(at)
        if len(group) == 64 or len(group) * len(blocks[at]) > 20_000:
            label()
    if group:
        label()
    return texts


def extract_text(pages: DataFrame, model: Labeller | None, page: str = "html", name: str = "text") -> DataFrame:
    """Adds the main text of every page."""
    if model is None:
        return pages.withColumn(name, F.lit(""))
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def texts(batch: pa.Array) -> pa.Array:
        found = [text for part in in_parts(batch) for text in main_texts(part, shared.value)]
        return pa.array(found, pa.string())

    return pages.withColumn(name, texts(text_or_empty(page)))
