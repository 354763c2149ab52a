"""Main text of web pages: gradient-boosted trees over DOM nodes and a decoding that respects the tree."""

from __future__ import annotations

import html as references
import re
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages that the trees are fitted on, about, each as it is and in made-up layouts.
MAX_PAGES = 240
LAYOUTS = 3
TREES, DEPTH, BINS, RATE = 60, 4, 32, 0.2

START = re.compile(r"<!--|<[!?]|</?[a-zA-Z]")
TAG = re.compile(r"</?[a-zA-Z][^\s/>]*+((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
NAME_END, SPECIAL = re.compile(r"[\s/>]"), re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"""(class|id|role|itemprop|aria-label|name|hidden|style)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: One attribute after the other, so that nothing inside a value is taken for one.
ATTRIBUTES = re.compile(r"""([^\s=/>"']++)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
TOKEN = re.compile(r"[a-z]+")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
LONG_REFERENCE = re.compile(r"&#(?:([0-9]{8,})|[xX]([0-9a-fA-F]{7,}));?")

# HTML's void elements, elements whose content is no text, and block elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template textarea title svg iframe object select option button canvas head".split())
#: What can stand in a head; anything else, text too, ends it.
HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
RAW = frozenset("script style textarea title iframe noscript".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul hr".split()
)
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
#: Where an implied end stops looking.
FENCES = frozenset("table ul ol dl body html div article section main aside nav td th".split())
CONTENT_TAGS, FURNITURE_TAGS = frozenset("article main".split()), frozenset("nav header footer aside form menu dialog".split())
CONTENT_WORDS = frozenset("article content main post entry story body text prose page".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert advertisement banner promo sponsored sponsor nav navigation menu navbar breadcrumb breadcrumbs header masthead footer sidebar aside "
    "widget cookie cookies consent notice alert popup modal newsletter subscribe signup login search share social related recommended comment comments "
    "reply replies respond discussion disqus copyright legal pagination pager toolbar tags hidden".split()
)
ADVERT_WORDS = frozenset("ad ads advert advertisement banner promo sponsored sponsor".split())
COMMENT_WORDS = frozenset("comment comments reply replies respond discussion disqus".split())


class Node:
    __slots__ = ("tag", "tokens", "parent", "children", "depth", "pieces", "linked", "tags")

    def __init__(self, tag: str, tokens: tuple, parent: Node | None):
        self.tag, self.tokens, self.parent = tag, tokens, parent
        self.children: list[Node] = []
        self.depth = parent.depth + 1 if parent else 0
        self.pieces: list[str] = []  # of a run of text
        self.linked = self.tags = 0
        if parent:
            parent.children.append(self)


class Tags:
    """The tags of a page from the left, each found in time that does not depend on what comes after it.

    A tag ends at the first ``>`` outside quotes; without one, its ``<`` is text. To know this for every ``<`` of a page with odd
    quotes, the ends are worked out once from the right: one step for each quote and ``>``.
    """

    def __init__(self, page: str):
        self.page, self.name_end, self.at, self.ends = page, 0, None, None

    def _end(self, start: int) -> int:
        """Where the tag whose name and attributes begin before ``start`` ends; -1 if nowhere."""
        if self.at is None:
            self.at = [m.start() for m in SPECIAL.finditer(self.page)]
            self.ends, later = [-1] * (len(self.at) + 1), {}
            for i in range(len(self.at) - 1, -1, -1):
                c = self.page[self.at[i]]
                if c == ">":
                    self.ends[i] = self.at[i]
                else:
                    close = later.get(c)
                    self.ends[i] = -1 if close is None else self.ends[close + 1]
                    later[c] = i
        return self.ends[bisect_left(self.at, start)]

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """The next markup from ``at``: its start and end, whether it is an end tag, the name ("": none) and the attributes."""
        page = self.page
        while (m := START.search(page, at)) is not None:
            start = m.start()
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, len(page) if end < 0 else end + 3, False, "", ""
            if page[start + 1] in "!?":
                end = page.find(">", start + 2)
                return start, len(page) if end < 0 else end + 1, False, "", ""
            closing = page[start + 1] == "/"
            name = start + 1 + closing
            tag = TAG.match(page, start) if self.at is None else None
            if tag is not None:
                return start, tag.end(), closing, page[name : tag.start(1)].lower(), tag[1]
            if self.name_end <= name:
                found = NAME_END.search(page, name)
                self.name_end = found.start() if found else len(page)
            end = self._end(self.name_end)
            if end >= 0:
                return start, end + 1, closing, page[name : self.name_end].lower(), page[self.name_end : end]
            at = m.end()
        return None


class Open:
    """The open elements, each with the block that holds it. Looking one up by its name takes one step however many are open."""

    def __init__(self, root: Node):
        self.stack: list[tuple[str, Node, bool]] = [("body", root, False)]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.links = self.skip = 0

    def push(self, tag: str, node: Node, unseen: bool = False) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCKS:
            self.blocks.append(len(self.stack))
        unseen = unseen or tag in SKIPPED
        self.stack.append((tag, node, unseen))
        self.links += tag == "a"
        self.skip += unseen

    def cut(self, k: int) -> None:
        """Close the elements from place ``k`` on."""
        while len(self.stack) > k:
            tag, _, unseen = self.stack.pop()
            self.places[tag].pop()
            if tag in BLOCKS:
                self.blocks.pop()
            self.links -= tag == "a"
            self.skip -= unseen

    def place(self, tag: str) -> int:
        """The place of the innermost one of that name; 0 if there is none."""
        found = self.places.get(tag)
        return found[-1] if found else 0

    def begin(self, tag: str) -> None:
        """Close what the beginning of a block ends: an open paragraph, and what ``CLOSES`` names, up to a fence."""
        ended = CLOSES.get(tag, frozenset()) | {"p"}
        fence = max(self.place(name) for name in FENCES - ended)
        first = len(self.stack)
        for name in ended:
            found = self.places.get(name)
            if found and found[-1] > fence:
                first = min(first, found[bisect_right(found, fence)])
        self.cut(first)


def parse(page: str) -> Node:
    """The block elements of a page as a tree, in time linear in the page. Text inside one block stands in leaves called ``#run``.

    Inline elements only shape the runs, but the text of hidden ones and of adverts among them is left out.
    """
    root = node = Node("body", (), None)
    opened, tags = Open(root), Tags(page)
    run: Node | None = None
    at = 0
    headless = True  # a head can still come
    said: list[str] = []  # by the tags of the page and the body

    def end_head() -> None:
        nonlocal headless
        headless = False
        if opened.stack[-1][0] == "head":  # its end tag may be left out
            opened.cut(len(opened.stack) - 1)

    def text(raw: str) -> None:
        nonlocal run
        if raw and not raw.isspace():
            end_head()
        if opened.skip or not raw:
            return
        if run is None:
            if raw.isspace():
                return
            run = Node("#run", (), node)
        run.pieces.append(raw)
        if opened.links:
            run.linked += len(raw)

    end = len(page)
    while at < end:
        found = tags.next(at)
        if found is None:
            text(page[at:])
            break
        start, after, closing, tag, attributes = found
        if start > at:
            text(page[at:start])
        at = after
        if not tag:
            continue
        if closing:
            if tag == "br":
                text(" ")
                continue
            place = opened.place(tag)
            if not place:
                continue
            if tag in BLOCKS:
                run = None
            elif opened.blocks and opened.blocks[-1] > place:
                continue  # an inline end does not close blocks
            opened.cut(place)
            node = opened.stack[-1][1]
            continue
        if tag not in HEAD and tag != "html":
            end_head()
        if tag == "head":
            if not headless:
                continue
            headless = False
        if tag in ("html", "body"):
            if attributes:
                said += tokens_of(attributes)
            continue
        if tag in VOID:
            if tag == "br":
                text(" ")
            elif tag == "hr":
                run = None
            elif run is not None and tag == "img":
                run.tags += 1
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if tag in BLOCKS:
            run = None
            opened.begin(tag)
            node = Node(tag, tokens_of(attributes) if attributes else (), opened.stack[-1][1])
            opened.push(tag, node)
        elif not attributes.endswith("/"):
            if run is not None:
                run.tags += 1
            opened.push(tag, node, bool(attributes) and not unseen_in_line(attributes).isdisjoint(UNSEEN_WORDS))
        elif run is not None:
            run.tags += 1
    root.tokens = tuple(said)
    return root


def unseen_in_line(attributes: str) -> set[str]:
    """What the attributes of an inline element say about whether it is seen."""
    found: set[str] = set()
    for m in ATTRIBUTES.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id"):
            found.update(TOKEN.findall(value))
        elif name == "hidden" or (name == "style" and UNSEEN.search(value)):
            found.add("hidden attribute")
    return found


#: For inline elements; a class called hidden says little there.
UNSEEN_WORDS = ADVERT_WORDS | {"hidden attribute"}


def tokens_of(attributes: str) -> tuple:
    found: list[str] = []
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "style":
            found += ["hidden"] if UNSEEN.search(value) else []
        else:
            found += TOKEN.findall(value)
    if re.search(r"(?:^|\s)hidden(?:\s|$|/)", attributes):
        found.append("hidden")
    return tuple(found)


def decoded(raw: str) -> str:
    """Character references decoded; one with more digits than any character has stands for none."""

    def short(m: re.Match) -> str:
        digits = (m[1] or m[2]).lstrip("0")
        return "\ufffd" if len(digits) > 7 else f"&#{'' if m[1] else 'x'}{digits or 0};"

    return references.unescape(LONG_REFERENCE.sub(short, raw))


def block_text(run: Node) -> str:
    """White space becomes one space. Each piece is decoded by itself: a tag inside a reference ends it."""
    return " ".join("".join(map(decoded, run.pieces)).split())


TAG_GROUPS = ("#run", "p", "div", "section", "li", "ul", "h1", "h2", "article", "main", "nav", "header", "footer", "aside", "form", "td")
FEATURES = len(TAG_GROUPS) + 21


def describe(root: Node) -> tuple[list[Node], np.ndarray]:
    """The nodes in page order and their features."""
    nodes: list[Node] = []
    waiting = [root]
    while waiting:
        n = waiting.pop()
        nodes.append(n)
        waiting.extend(reversed(n.children))
    number = {id(n): k for k, n in enumerate(nodes)}
    size, linked, tags, runs, marks = (np.zeros(len(nodes)) for _ in range(5))
    for k, n in enumerate(nodes):
        if n.tag == "#run":
            raw = "".join(n.pieces)
            size[k], linked[k], tags[k], runs[k] = len(raw), n.linked, n.tags, 1
            marks[k] = raw.count(".") + raw.count(",")
        else:
            tags[k] = 1
    for k in range(len(nodes) - 1, 0, -1):
        p = number[id(nodes[k].parent)]
        for a in (size, linked, tags, runs, marks):
            a[p] += a[k]
    x = np.zeros((len(nodes), FEATURES))
    whole = max(size[0], 1.0)
    good, bad, talk, tagged = (np.zeros(len(nodes), bool) for _ in range(4))
    for k, n in enumerate(nodes):
        own_good, own_bad = sum(t in CONTENT_WORDS for t in n.tokens), sum(t in FURNITURE_WORDS for t in n.tokens)
        own_talk = any(t in COMMENT_WORDS for t in n.tokens)
        p = number[id(n.parent)] if n.parent else -1
        good[k] = (p >= 0 and good[p]) or own_good > 0
        bad[k] = (p >= 0 and bad[p]) or own_bad > 0 or n.tag in FURNITURE_TAGS
        talk[k] = (p >= 0 and talk[p]) or own_talk
        tagged[k] = (p >= 0 and tagged[p]) or n.tag in CONTENT_TAGS
        if n.tag in TAG_GROUPS:
            x[k, TAG_GROUPS.index(n.tag)] = 1
        siblings = n.parent.children if n.parent else [n]
        around = size[p] if p >= 0 else size[k]
        x[k, len(TAG_GROUPS) :] = (
            n.depth, own_good, own_bad, own_talk, good[k], bad[k], talk[k], tagged[k],
            np.log1p(size[k]), size[k] / whole, size[k] / max(around, 1.0), linked[k] / max(size[k], 1.0), size[k] / max(tags[k], 1.0), runs[k],
            size[k] / max(runs[k], 1.0), marks[k] / max(size[k], 1.0), len(n.children), len(siblings), k / len(nodes),
            linked[p] / max(size[p], 1.0) if p >= 0 else 0.0, runs[p] if p >= 0 else 0.0,
        )
    return nodes, x


class Boosted:
    """Gradient-boosted trees for a yes or no, fitted on binned features."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        binned = self._bin(x)
        rate = np.clip(y.mean(), 0.01, 0.99)
        self.base, self.trees = float(np.log(rate / (1 - rate))), []
        z = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-z))
            tree = self._grow(binned, y - p, p * (1 - p))
            self.trees.append(tree)
            z += self._leaf(tree, binned)
        return self

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, "right") for e, c in zip(self.edges, x.T)], 1)

    def _grow(self, binned: np.ndarray, g: np.ndarray, h: np.ndarray):
        """A full tree as arrays by place (children of k: 2k+1, 2k+2): feature (-1: none), bin to go right from, value."""
        size = (1 << (DEPTH + 1)) - 1
        feature, cut, value = np.full(size, -1), np.zeros(size, int), np.zeros(size)
        rows = {0: np.arange(len(g))}
        for k in range(size):
            r = rows.pop(k, None)
            if r is None or not len(r):
                continue
            G, H = g[r].sum(), h[r].sum()
            value[k] = RATE * G / (H + 1)
            if 2 * k + 2 >= size or len(r) < 20:
                continue
            best = (1e-3, -1, 0)
            for f in range(binned.shape[1]):
                b = binned[r, f]
                left_g, left_h = (np.bincount(b, weights=w[r], minlength=BINS).cumsum()[:-1] for w in (g, h))
                gain = left_g**2 / (left_h + 1) + (G - left_g) ** 2 / (H - left_h + 1) - G * G / (H + 1)
                gain[(left_h < 0.5) | (H - left_h < 0.5)] = 0
                if gain.max() > best[0]:
                    best = (gain.max(), f, int(gain.argmax()) + 1)
            if best[1] >= 0:
                feature[k], cut[k] = best[1:]
                right = binned[r, best[1]] >= best[2]
                rows[2 * k + 1], rows[2 * k + 2] = r[~right], r[right]
        return feature, cut, value

    @staticmethod
    def _leaf(tree, binned: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        at = np.zeros(len(binned), int)
        for _ in range(DEPTH):
            f = feature[at]
            at = np.where(f >= 0, 2 * at + 1 + (binned[np.arange(len(binned)), f] >= cut[at]), at)
        return value[at]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        binned = self._bin(x)
        return self.base + sum(self._leaf(t, binned) for t in self.trees)


def decode(nodes: list[Node], odds: np.ndarray) -> np.ndarray:
    """The most likely choice of nodes such that what is inside a rejected node is rejected too.

    A node's value when kept is its log odds and, for every child, the better of keeping and rejecting it; when rejected, nothing
    inside counts. The page itself is kept.
    """
    number = {id(n): k for k, n in enumerate(nodes)}
    value = odds.copy()
    for k in range(len(nodes) - 1, 0, -1):
        value[number[id(nodes[k].parent)]] += max(value[k], 0.0)
    kept = np.zeros(len(nodes), bool)
    for k, n in enumerate(nodes):
        kept[k] = n.parent is None or (kept[number[id(n.parent)]] and value[k] > 0)
    return kept


def main_text(nodes: list[Node], kept: np.ndarray) -> str:
    blocks = (block_text(n) for n, k in zip(nodes, kept) if k and n.tag == "#run")
    return "\n\n".join(b for b in blocks if b)


# --- training pages -------------------------------------------------------------------------------------------------------

CONTAINERS = ("article", "main", 'div class="content"', 'div id="main-content"', 'div class="post-body"', 'section class="entry"', 'div class="article-text"', "div", 'div class="page"')
FURNITURE = (
    "nav", "header", "footer", "aside", "form", 'div class="sidebar"', 'div class="ad"', 'div class="promo banner"', 'div class="cookie-notice"', 'div id="footer"',
    'div id="header"', 'form class="newsletter"', 'div class="related"', 'div class="social-share"', 'ul class="menu"', 'div class="breadcrumbs"', 'div role="navigation"',
    'div class="notice"', 'section class="widget"', 'div class="advert"',
)
TALK = ('div class="comments"', 'section id="comments"', 'div class="comment-list"', 'ol class="comments"', 'div id="disqus"')


def _inside(nodes: list[Node], wanted: str) -> np.ndarray:
    """For every node, in page order, whether it or one around it is the wanted element or has the wanted token."""
    number, found = {id(n): k for k, n in enumerate(nodes)}, np.zeros(len(nodes), bool)
    for k, n in enumerate(nodes):
        found[k] = wanted in n.tokens or n.tag == wanted or (n.parent is not None and found[number[id(n.parent)]])
    return found


def made_up(rng: np.random.Generator, blocks: list[str], other: list[str]) -> str:
    """A page around the given blocks: a container of a random kind, furniture and reader comments with prose of other pages."""
    pick = lambda options: options[rng.integers(len(options))]

    def furniture() -> str:
        kind = pick(FURNITURE)
        words = pick(other).split()[: rng.integers(2, 30)]
        style = rng.integers(4)
        if style == 0:
            inner = "<ul>" + "".join(f'<li><a href="/{w}">{w}</a></li>' for w in words[:10]) + "</ul>"
        elif style == 1:
            inner = f"<p>{' '.join(words)}</p>"
        elif style == 2:
            inner = f"<h3>{' '.join(words[:3])}</h3><p>{' '.join(words)}</p><p><a href='#'>{' '.join(words[:2])}</a></p>"
        else:
            inner = " ".join(words)
        return f"<{kind}>{inner}</{kind.split()[0]}>"

    def talk() -> str:
        kind = pick(TALK)
        item = "li" if kind.startswith("ol") else "div class='comment'"
        inner = "".join(f"<{item}><p>{' '.join(pick(other).split()[: rng.integers(3, 60)])}</p></{item.split()[0]}>" for _ in range(rng.integers(1, 5)))
        return f"<{kind}>{inner}</{kind.split()[0]}>"

    kind = pick(CONTAINERS)
    body = []
    for k, b in enumerate(blocks):
        tag = "h1" if k == 0 else ("h2" if len(b) < 60 and rng.random() < 0.5 else pick(("p", "p", "p", "p", "blockquote", "li", "div")))
        body.append(f"<ul><li class='gold'>{references.escape(b)}</li></ul>" if tag == "li" else f"<{tag} class='gold'>{references.escape(b)}</{tag}>")
        if rng.random() < 0.08:
            body.append(furniture())
    if rng.random() < 0.4:
        body.append(talk())
    content = f"<{kind}>{''.join(body)}</{kind.split()[0]}>"
    if rng.random() < 0.4:
        content = f"<div class='wrapper'>{content}{furniture()}</div>"
    before, after = ("".join(furniture() for _ in range(rng.integers(0, 4))) for _ in range(2))
    return f"<body>{before}{content}{talk() if rng.random() < 0.4 else ''}{after}</body>"


def _labelled(root: Node, wanted: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and, for every node, whether wanted text is inside."""
    nodes, x = describe(root)
    number = {id(n): k for k, n in enumerate(nodes)}
    y = np.array([n.tag == "#run" and inside for n, inside in zip(nodes, _inside(nodes, wanted))], float)
    for k in range(len(nodes) - 1, 0, -1):
        if y[k]:
            y[number[id(nodes[k].parent)]] = 1
    return x, y


def fit_pages(pages: list[str]) -> Boosted | None:
    """Trees fitted on pages whose article element holds the main text, and on made-up layouts of the same texts."""
    rng, xs, ys, texts = np.random.default_rng(7), [], [], []
    for page in pages:
        root = parse(page)
        nodes, _ = describe(root)
        if any(n.tag == "article" for n in nodes):
            x, y = _labelled(root, "article")
            xs.append(x)
            ys.append(y)
            blocks = [b for n, inside in zip(nodes, _inside(nodes, "article")) if n.tag == "#run" and inside if (b := block_text(n))]
            if blocks:
                texts.append(blocks)
    prose = [b for blocks in texts for b in blocks] or ["text"]
    for blocks in texts:
        for _ in range(LAYOUTS):
            x, y = _labelled(parse(made_up(rng, blocks, prose)), "gold")
            xs.append(x)
            ys.append(y)
    return Boosted().fit(np.concatenate(xs), np.concatenate(ys)) if xs else None


def extract_text(pages: DataFrame, training: DataFrame | None = None, max_pages: int = MAX_PAGES) -> DataFrame:
    """``pages`` with ``html`` replaced by ``text``, the main text, and ``n_chars``, its code points.

    Every block node gets log odds of holding main text from boosted trees over its features (density of the subtree, attribute
    tokens, depth, siblings, what its ancestors say); ``decode`` picks the best consistent set, so nothing is taken out of a rejected
    block. The trees are fitted in one task on about ``max_pages`` pages of ``training`` (``pages`` if None) that mark their text with
    an article element, chosen by a hash of the html, and on made-up layouts of these, in which containers have other names and
    furniture and reader comments hold prose. The whole html of every page is read; pages are never shuffled but for the sample.

    A null or empty html, or one without text, has an empty text. Character references are decoded, white space in a block becomes one
    space, blocks are joined by two line feeds. Broken markup is read as browsers do, roughly, and in time linear in the page. Without training pages the whole text of
    the page is taken. Repeated rows are read each; an empty table gives no rows.
    """
    source = (pages if training is None else training).where("html LIKE '%<article%'").select("html")
    n = source.count()
    unit = F.shiftrightunsigned(F.xxhash64(F.lit(11), "html"), 11) / F.lit(float(1 << 53))
    sample = source.where(unit < F.lit(min(1.0, max_pages / max(n, 1)))).select("html", F.lit(0).alias("all"))

    def fit(pdf):
        import pickle

        import pandas as pd

        return pd.DataFrame({"model": [pickle.dumps(fit_pages(sorted(pdf["html"])))]})

    fitted = sample.groupBy("all").applyInPandas(fit, "model binary").collect()
    model = pages.sparkSession.sparkContext.broadcast(bytes(fitted[0].model) if fitted else None)
    kept = [f for f in pages.schema.fieldNames() if f not in ("html", "text", "n_chars")]
    schema = ", ".join([*(f"`{f}` {pages.schema[f].dataType.simpleString()}" for f in kept), "text string", "n_chars bigint"])

    def read(batches):
        import pickle

        trees = pickle.loads(model.value) if model.value else None
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                part = batch.slice(a, 64)
                parsed = [describe(parse(page or "")) for page in part.column(part.schema.get_field_index("html")).to_pylist()]
                odds = trees.log_odds(np.concatenate([x for _, x in parsed])) if trees else np.ones(sum(len(x) for _, x in parsed))
                cuts = np.cumsum([len(x) for _, x in parsed])
                texts = [main_text(nodes, decode(nodes, o)) for (nodes, _), o in zip(parsed, np.split(odds, cuts[:-1]))]
                columns = [part.column(part.schema.get_field_index(f)) for f in kept] + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "text", "n_chars"])

    return pages.mapInArrow(read, schema)


def op2(spark, sf):
    return extract_text(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html"))


QUERIES = {"op2_html_extraction": (op2, None)}
