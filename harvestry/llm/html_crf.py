"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is cut into leaf blocks (runs of text between block-level tags) in page order, each
with the tags and the class, id and role words of its ancestors. A chain with two labels
scores blocks by ancestor and text features and by the label before; Viterbi finds the best
labelling, and the blocks labelled main make the text.

The model is trained on labelled pages: layouts with known parts, rendered by ``training_pages``
in many variants (semantic and plain markup, class names present or missing, tags left open).
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.session import ship_package

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr br img input "
    # Formulas are read in line; their annotations repeat them.
    "math semantics mrow mi mo mn ms mtext msup msub msubsup mfrac msqrt mroot mover munder "
    "munderover mtable mtr mlabeledtr mtd mspace mstyle mpadded mphantom menclose mfenced "
    "mmultiscripts mprescripts none merror maction annotation annotation-xml".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is raw up to the end tag, or not text at all.
RAW = frozenset("script style textarea title iframe noscript noembed noframes xmp".split())
UNSEEN = frozenset("template svg object audio video canvas select datalist annotation annotation-xml".split())
#: A start tag of the key ends an open tag of the value, unless one of STOPS stands between.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
          "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
STOPS = frozenset("ul ol dl table select".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"'=]|=\s*\"[^\"]*\"|=\s*'[^']*'|[\"'=])*+)>"
    r"|<[a-zA-Z][^>]*\Z", re.S)
ATTRIBUTE = re.compile(
    r"(?<![^\s\"'/])(class|id|role|itemprop|hidden|style|aria-hidden)"
    r"(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*")


@dataclass(slots=True, eq=False)
class Place:
    """A block-level element by its parent, so that elements share what they stand in. ``new``
    holds the path features that the parent's path does not have."""
    parent: Place | None
    tag: str
    words: frozenset
    new: tuple[str, ...]


@dataclass(slots=True)
class Block:
    path: Place | None
    text: str
    linked: int  # characters inside links


@lru_cache(maxsize=20_000)
def words_of(attributes: str) -> frozenset:
    """The words of a tag's class, id, role and itemprop, singular and lower-case."""
    found = set()
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("hidden", "style", "aria-hidden"):
            if name == "hidden" or value.lower() == "true" or re.search(
                    r"display\s*:\s*none", value, re.I):
                found.add("hidden")
            continue
        for word in PARTS.findall(value):
            word = word.lower()
            found.add(word[:-1] if len(word) > 2 and word.endswith("s") else word)
    return frozenset(found)


def element_features(tag: str, words: frozenset, opened: Counter) -> list[str]:
    """What an element adds to the features of a path, given the open elements."""
    found = ["t:" + tag, *("w:" + w for w in words)]
    if tag in ("header", "aside") and opened["article"]:
        found.append("inner:" + tag)
    if tag == "article":
        found += ["inner:" + outer for outer in ("header", "aside") if opened[outer]]
    return found


def leaf_blocks(page: str) -> list[Block]:
    """The leaf blocks with text, in page order. Character references are decoded, white space
    becomes one space, ends are trimmed. Any markup is accepted; what is left open at the end
    is closed. Time and memory are in proportion to the page, however deep its elements stand."""
    blocks: list[Block] = []
    stack: list[tuple[str, Place | None]] = []  # open elements, and the place inside them
    opened: Counter = Counter()  # open elements by tag
    scopes: list[Counter] = [Counter()]  # the same, since each open one of STOPS
    seen: Counter = Counter()  # path features of the open elements
    parts: list[str] = []
    linked = unseen = at = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text and not unseen:
                blocks.append(Block(stack[-1][1] if stack else None, text, linked))
            parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not unseen:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if opened["a"]:
                linked += len(text)

    def open_(name: str, words: frozenset) -> None:
        nonlocal unseen
        place = stack[-1][1] if stack else None
        if name not in INLINE:
            new = element_features(name, words, opened)
            place = Place(place, name, words, tuple(f for f in new if not seen[f]))
            seen.update(place.new)
        stack.append((name, place))
        opened[name] += 1
        unseen += name in UNSEEN
        scopes[-1][name] += 1
        if name in STOPS:
            scopes.append(Counter())

    def close(place: int) -> None:
        """Close the open elements from ``place`` on."""
        nonlocal unseen
        if any(name not in INLINE for name, _ in stack[place:]):
            flush()
        while len(stack) > place:
            name, inside = stack.pop()
            if name in STOPS:
                scopes.pop()
            opened[name] -= 1
            scopes[-1][name] -= 1
            unseen -= name in UNSEEN
            if name not in INLINE:
                seen.subtract(inside.new)

    while at < len(page):
        found = TOKEN.search(page, at)
        if not found:
            break
        add(page[at:found.start()])
        at = found.end()
        end, start, attributes = found.groups()
        if end:
            end = end.lower()
            if opened[end]:
                place = len(stack) - 1
                while stack[place][0] != end:
                    place -= 1
                close(place)
            elif end not in INLINE:
                flush()
        elif start:
            start = start.lower()
            if start == "br" or start == "wbr":
                parts.append(" " if start == "br" else "")
                continue
            if start not in INLINE:
                flush()
                ends = {"p"} if start not in CLOSES else CLOSES[start] | {"p"}
                # All of them since the last of STOPS: what is walked over is closed.
                left, place = sum(scopes[-1][name] for name in ends), len(stack)
                while left:
                    place -= 1
                    left -= stack[place][0] in ends
                close(place)
            if start in RAW:
                stop = re.compile(rf"</{re.escape(start)}(?=[\s/>])|\Z", re.I).search(page, at)
                if start == "title":
                    open_(start, frozenset())
                    add(page[at:stop.start()])
                    close(len(stack) - 1)
                at = stop.start()
                continue
            if start not in VOID and not (attributes.endswith("/") and start in UNSEEN):
                open_(start, words_of(attributes) if attributes else frozenset())
    if at < len(page):
        add(page[at:])
    flush()
    return blocks


HINTS = {
    "rights": re.compile(r"©|\(c\)|copyright|all rights reserved", re.I),
    "consent": re.compile(r"cookie|privacy|consent", re.I),
    "act": re.compile(r"^(subscribe|sign (up|in)|log in|share|search|read more|menu|home|reply|"
                      r"skip to|next|previous|advertisement|sponsored|related)", re.I)}
ENDS = tuple(".!?…:;\"'”»)")


def path_features(path: Place | None) -> set[str]:
    found = set(own_features(path))
    while path:
        found.update(path.new)
        path = path.parent
    return found


def own_features(path: Place | None) -> tuple[str, ...]:
    """Of the innermost element alone."""
    return ("own:" + path.tag, *("ownw:" + w for w in path.words)) if path else ()


def text_features(block: Block) -> tuple[str, ...]:
    """Bucketed features of a block's text."""
    words = block.text.count(" ") + 1
    size = next((str(n) for n in (1, 3, 6, 12, 30) if words <= n), "more")
    density = min(3, int(4 * block.linked / len(block.text)))
    return (f"n:{size}", f"link:{density}", f"end:{block.text.endswith(ENDS)}",
            *(name for name, pattern in HINTS.items() if pattern.search(block.text)))


@dataclass
class Chain:
    """Weights by feature for the labels other (0) and main (1), and of label pairs."""
    weights: dict[str, tuple[float, float]]
    turns: tuple[tuple[float, float], tuple[float, float]]
    known: dict = field(default_factory=dict)

    def __getstate__(self):
        return {"weights": self.weights, "turns": self.turns, "known": {}}

    def _sum(self, key, names) -> tuple[float, float]:
        if key not in self.known:
            if len(self.known) > 50_000:
                self.known.clear()
            found = [self.weights[n] for n in names() if n in self.weights]
            self.known[key] = (sum(f[0] for f in found), sum(f[1] for f in found))
        return self.known[key]

    def _path_sum(self, path: Place | None, sums: dict) -> tuple[float, float]:
        """Of a path's features; ``sums`` holds those of the places met in a page."""
        waiting, place = [], path
        while place and place not in sums:
            waiting.append(place)
            place = place.parent
        total = sums[place] if place else (0.0, 0.0)
        for place in reversed(waiting):
            more = self._sum(place.new, lambda p=place: p.new)
            total = sums[place] = (total[0] + more[0], total[1] + more[1])
        own = own_features(path)
        more = self._sum(own, lambda: own)
        return total[0] + more[0], total[1] + more[1]

    def labels(self, blocks: list[Block]) -> list[int]:
        """The best labelling, by Viterbi."""
        back, best, sums = [], (0.0, 0.0), {}
        (same0, to1), (to0, same1) = self.turns
        for at, block in enumerate(blocks):
            own = text_features(block)
            place = self._path_sum(block.path, sums)
            form = self._sum(own, lambda o=own: o)
            if at:
                from0, from1 = best[0] + same0, best[1] + to0
                into0, into1 = best[0] + to1, best[1] + same1
                back.append((from1 > from0, into1 >= into0))
                best = (max(from0, from1), max(into0, into1))
            best = (best[0] + place[0] + form[0], best[1] + place[1] + form[1])
        if not blocks:
            return []
        label = int(best[1] >= best[0])
        found = [label]
        for step in reversed(back):
            label = int(step[label])
            found.append(label)
        return found[::-1]


def fit(pages: list[tuple[list[Block], list[int]]], rounds: int = 250,
        penalty: float = 0.003) -> Chain:
    """Maximum likelihood by gradient steps (Adam); all pages run through the forward-backward
    recursions together, padded to the longest."""
    sequences = [[sorted(path_features(b.path) | set(text_features(b))) for b in blocks]
                 for blocks, _ in pages]
    names = sorted({n for page in sequences for block in page for n in block})
    index = {n: i for i, n in enumerate(names)}
    count, longest = len(pages), max(len(b) for b, _ in pages)
    rows, columns = [], []
    truth = np.zeros((count, longest), np.int64)
    real = np.zeros((count, longest), bool)
    for p, (page, (_, labels)) in enumerate(zip(sequences, pages, strict=True)):
        truth[p, :len(labels)] = labels
        real[p, :len(labels)] = True
        for t, block in enumerate(page):
            rows += [p * longest + t] * len(block)
            columns += [index[n] for n in block]
    rows, columns = np.array(rows), np.array(columns)
    gold = np.eye(2)[truth] * real[..., None]
    both = real[:, 1:] & real[:, :-1]
    turned = np.einsum("pti,ptj->ij", gold[:, :-1] * both[..., None], gold[:, 1:])
    theta = np.zeros((len(names) + 2, 2))
    m, v = np.zeros_like(theta), np.zeros_like(theta)

    def summed(at, values, size):
        return np.stack([np.bincount(at, values[:, i], size) for i in (0, 1)], axis=1)

    def add(a, axis):
        top = a.max(axis=axis, keepdims=True)
        return np.log(np.exp(a - top).sum(axis=axis)) + np.squeeze(top, axis)

    for step in range(1, rounds + 1):
        weights, turns = theta[:-2], theta[-2:]
        score = summed(rows, weights[columns], count * longest).reshape(count, longest, 2)
        ahead, behind = np.zeros_like(score), np.zeros_like(score)
        ahead[:, 0] = score[:, 0]
        for t in range(1, longest):
            new = add(ahead[:, t - 1, :, None] + turns, 1) + score[:, t]
            ahead[:, t] = np.where(real[:, t, None], new, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            new = add((score[:, t + 1] + behind[:, t + 1])[:, None] + turns, 2)
            behind[:, t] = np.where(real[:, t + 1, None], new, 0)
        total = add(ahead[:, -1], 1)[:, None, None]
        chance = np.exp(ahead + behind - total) * real[..., None]
        pair = np.exp(ahead[:, :-1, :, None] + turns + (score + behind)[:, 1:, None]
                      - total[..., None]) * both[..., None, None]
        apart = (gold - chance).reshape(-1, 2)
        slope = summed(columns, apart[rows], len(theta))
        slope[-2:] = turned - pair.sum(axis=(0, 1))
        slope = slope / count - penalty * theta / 10
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope ** 2
        theta += 0.15 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return Chain({n: tuple(theta[i].tolist()) for n, i in index.items()},
                 tuple(map(tuple, theta[-2:].tolist())))


class _Layout:
    """Renders one labelled page; ``main`` and ``other`` mark the texts' labels."""

    def __init__(self, rng: random.Random):
        self.rng, self.labels, self.named = rng, {}, rng.random() < 0.85

    def say(self, low: int, high: int, end: str = ".") -> str:
        rng = self.rng
        words = ["".join(rng.choice("aeiou") + rng.choice("bcdlmnrst") for _ in range(
            rng.randint(1, 4))) for _ in range(rng.randint(low, high))]
        if rng.random() < 0.3 and len(words) > 6:
            words[len(words) // 2] += ","
        return (" ".join(words)).capitalize() + end

    def leaf(self, tag: str, label: int, text: str) -> str:
        self.labels[" ".join(text.split())] = label
        form = self.rng.random()
        if form < 0.1 and tag == "p":
            return f"<p>{text}"
        inner = f"<b>{text}</b>" if form > 0.9 else text
        return f"<{tag}>{inner}</{tag}>"

    def box(self, tags: str, names: str, inner: str, bare: float = 0.15) -> str:
        """A container: a random one of ``tags``, with one of ``names`` as class or id."""
        tag = self.rng.choice(tags.split())
        if tag in ("div", "section", "ul", "ol", "p") and self.named or self.rng.random() > bare:
            kind = self.rng.choice(["class", "class", "id"])
            extra = self.rng.choice(["", "", " box", " col-2", " clearfix"])
            return f'<{tag} {kind}="{self.rng.choice(names.split())}{extra}">{inner}</{tag}>'
        return f"<{tag}>{inner}</{tag}>"

    def links(self, low: int, high: int) -> str:
        items = "".join(self._link() for _ in range(self.rng.randint(low, high)))
        return f"<ul>{items}</ul>"

    def _link(self) -> str:
        text = self.say(1, 4, "")
        self.labels[text] = 0
        return f'<li><a href="/{text[:4]}">{text}</a></li>'

    def other(self, low=1, high=12) -> str:
        return "".join(self.leaf(self.rng.choice(["p", "p", "div"]), 0, self.say(
            low, high, self.rng.choice([".", ".", "", "!"]))) for _ in range(
            self.rng.randint(1, 2)))

    def sentences(self, tag="p") -> str:
        text = " ".join(self.say(3, 14) for _ in range(self.rng.choice([1, 1, 2, 4, 7])))
        return self.leaf(tag, 1, text)

    def advert(self) -> str:
        return self.box("div div aside section", "ad ads advert advertisement sponsored promo "
                        "banner ad-slot adbox", self.other(3, 14), 0)

    def notice(self) -> str:
        return self.box("div div section aside", "cookie-notice notice cookie-banner consent "
                        "alert gdpr popup modal site-notice", self.other(4, 16), 0)

    def form(self) -> str:
        text = self.say(2, 8)
        self.labels[text] = 0
        press = self.say(1, 2, "")
        self.labels[press] = 0
        return (f'<form action="/s" class="{self.rng.choice(["search", "newsletter", "login"])}">'
                f"<label>{text}</label><input name=q><button>{press}</button></form>")

    def comments(self) -> str:
        one = [self.box("div li article", "comment reply comment-body", self.other(1, 3)
                        + "".join(self.leaf("p", 0, self.say(4, 20)) for _ in range(
                            self.rng.randint(1, 2))), 0) for _ in range(self.rng.randint(1, 4))]
        head = self.leaf("h3", 0, self.say(1, 2, ""))
        return self.box("section div ol", "comments comment-list reader-comments responses "
                        "discussion", head + "".join(one), 0)

    def side(self) -> str:
        inner = self.leaf("h3", 0, self.say(1, 3, "")) + (
            self.links(2, 6) if self.rng.random() < 0.6 else self.other(4, 18))
        return self.box("aside div aside", "sidebar side widget related secondary rail", inner, 0)

    def article(self) -> str:
        rng, parts = self.rng, []
        for _ in range(rng.randint(1, 9)):
            parts.append(self.sentences())
            chance = rng.random()
            if chance < 0.12:
                parts.append(self.leaf(rng.choice(["h2", "h3"]), 1, self.say(1, 6, "")))
            elif chance < 0.2:
                parts.append("<ul>" + "".join(self.leaf("li", 1, self.say(2, 12, rng.choice(
                    [".", ""]))) for _ in range(3)) + "</ul>")
            elif chance < 0.25:
                parts.append(f"<blockquote>{self.sentences()}</blockquote>")
            elif chance < 0.28:
                parts.append(self.leaf("pre", 1, self.say(2, 9, "")))
            elif chance < 0.31:
                parts.append("<table><tr>" + "".join(self.leaf("td", 1, self.say(
                    1, 3, "")) for _ in range(3)) + "</tr></table>")
            elif chance < 0.46:
                parts.append(rng.choice([self.advert, self.advert, self.form, self.side,
                                         self.notice])())
        return "".join(parts)

    def page(self) -> tuple[str, dict[str, int]]:
        rng, bare = self.rng, self.rng.random() < 0.15
        title = self.leaf("h1", 1, self.say(2, 10, rng.choice(["", "."])))
        body = self.article()
        if rng.random() < 0.25:
            body += self.comments()
        kind = rng.random()
        if kind < 0.45:
            core = f"<article>{title}{body}</article>"
        elif kind < 0.55:
            core = f"<article><header>{title}</header>{body}</article>"
        elif kind < 0.7:
            core = f"<main>{title}{body}</main>"
        else:
            core = title + self.box("div section", "content main post entry-content article "
                                    "article-body story main-content post-body text", body, 0)
            core = rng.choice([core, f"<main>{core}</main>", f'<div id="main">{core}</div>'])
        menu = self.links(3, 8)
        top = [f"<nav>{menu}</nav>" if rng.random() < 0.6 else self.box(
            "div ul", "nav menu navbar navigation topnav breadcrumb", menu, 0)]
        if rng.random() < 0.5:
            top.insert(0, self.box("header header div", "header masthead site-header top",
                                   self.other(1, 8)))
        for part, chance in ((self.notice, 0.3), (self.advert, 0.5), (self.form, 0.25)):
            if rng.random() < chance:
                top.append(part())
        tail = []
        for part, chance in ((self.comments, 0.3), (self.side, 0.4), (self.advert, 0.3),
                             (self.form, 0.25), (self.notice, 0.15)):
            if rng.random() < chance:
                tail.append(part())
        foot = self.box("footer footer div", "footer site-footer bottom copyright", self.leaf(
            "p", 0, rng.choice(["© ", "&copy; ", ""]) + self.say(2, 12)), 0 if bare else 0.5)
        if rng.random() < 0.3:
            top, tail = [*top, self.side()], tail
        heading = self.say(2, 8, "")
        self.labels.setdefault(heading, 0)
        return (f"<!DOCTYPE html><html><head><title>{heading}</title><style>p{{}}</style></head>"
                f"<body>{''.join(top)}{core}{''.join(tail)}{foot}<script>x()</script>"
                "</body></html>"), self.labels


def training_pages(pages: int = 500, seed: int = 11):
    """Labelled pages: (blocks, labels). Their number is the bound of the training set."""
    found = []
    for number in range(pages):
        page, labels = _Layout(random.Random(seed * 100_003 + number)).page()
        known = {html.unescape(text): label for text, label in labels.items()}
        blocks = leaf_blocks(page)
        found.append((blocks, [known[b.text] for b in blocks]))
    return found


@lru_cache(maxsize=1)
def trained() -> Chain:
    return fit(training_pages())


def main_text(page: str | None, model: Chain) -> str:
    """The main blocks in page order, joined by line feeds; null, empty and textless pages
    give the empty text."""
    blocks = leaf_blocks(page) if page else []
    return "\n".join(b.text for b, label in zip(blocks, model.labels(blocks), strict=True)
                     if label)


def extract(pages: DataFrame, model: Chain | None = None) -> DataFrame:
    """Every row of ``pages`` (``page_id``, ``url``, ``html``) as ``page_id``, ``url``,
    ``text`` and ``n_chars`` (code points). Repeated rows stay; nulls in page_id and url pass;
    other columns are not read."""
    ship_package(pages.sparkSession)
    model = trained() if model is None else model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, model) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
