"""Main text of web pages by a tree-structured graphical model.

A page's elements form a tree. Each element is content or not, with a log-linear potential
of its own features (tag group, cue words of class, id and role, length, link share,
punctuation, place) and a potential with its parent that favours agreement. On a tree,
sum-product message passing is exact: one pass from the leaves up, one from the root
down give every element's marginal. All pages of an Arrow batch are passed level by
level together, in numpy. Text whose element is content with probability 0.5 or more
stays.

Weights are trained from labelled pages: pages whose source marks the article with
``article`` or ``main``. An element with text of its own is labelled by whether the mark
encloses it; elements without text are latent. Each such page teaches three times: as it
is; with a plain ``div`` for the mark and paragraphs set as notices, side bars, adverts,
comments and the like around and inside the article; and with the paragraphs
bare in the body, among menus and footers without names. So the model learns from structure and
text as well as from the mark. The likelihood's gradient is the difference of the
marginals with and without the labels. Weights are drawn to a table of prior means
(what HTML's own element names and common class names say), which holds where no page
teaches otherwise, and alone where no page is labelled. At most ``SAMPLE`` labelled pages of at
most ``LARGEST`` characters, those of smallest hash, are used for the fit (a documented
bound); every page is read whole and extracted.

Text: character references decoded, white space (Unicode's) in a block turned into one
space, blocks joined in page order by a line feed. ``br`` is white space. Unclosed and
stray tags are treated as HTML does in the common cases (a block closes an open ``p``, an item
the item before); an unclosed comment or raw element hides the rest of the page.

Defined results: a null or empty html gives an empty text; page_id and url are carried as
they are, nulls and repeats included; an empty table gives an empty table; only page_id, url
and html are read, so extra columns are harmless.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rtdw.llm.common import pieces

SAMPLE = 300
LARGEST = 50_000
ROUNDS = 80

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes noscript template svg math object".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span "
                   "strike strong sub sup time tt u var wbr img br".split())
ITEMS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
         "th": ("td", "th"), "option": ("option",)}

# Tag groups and cue groups with their prior weights (content is positive).
TAGS = {
    "article": ("article", 3.0), "main": ("main", 2.0), "nav": ("nav menu", -4.0), "header": ("header", -2.5),
    "footer": ("footer", -4.0), "aside": ("aside", -4.0),
    "form": ("form button select option label fieldset legend input datalist output dialog", -4.0),
    "section": ("section", 0.0), "div": ("div center", 0.0), "p": ("p", 0.5), "title": ("h1", 0.5),
    "heading": ("h2 h3 h4 h5 h6 hgroup", 0.0),
    "list": ("ul ol dl", 0.0), "item": ("li dt dd", 0.0), "a": ("a", 0.0), "quote": ("blockquote pre", 0.3),
    "inline": (" ".join(sorted(INLINE - {"a"})), 0.0),
    "table": ("table tbody thead tfoot tr td th caption", 0.0), "figure": ("figure figcaption picture", 0.0),
    "address": ("address", -1.0), "top": ("html body", -1.0), "other": ("", 0.0),
}
CUES = {
    "body": ("article post entry content story text main body blog prose markdown", 1.5),
    "menu": ("nav navbar navigation menu breadcrumb breadcrumbs topbar toolbar pagination pager toc skip", -3.5),
    "ad": ("ad ads advert adverts advertisement adsense banner sponsor sponsored promo promotion promoted", -4.0),
    "comment": ("comment comments respond reply replies discussion disqus commentlist reader", -4.5),
    "side": ("sidebar side aside widget widgets rail secondary complementary", -3.5),
    "notice": ("cookie cookies consent gdpr notice alert popup modal overlay disclaimer paywall warning toast", -4.0),
    "share": ("share sharing social follow twitter facebook", -3.5),
    "related": ("related recommended recommendations more trending popular teaser teasers outbrain taboola", -3.0),
    "edge": ("footer foot copyright header masthead colophon contentinfo legal logo", -3.0),
    "form": ("newsletter subscribe subscription signup login search form register feedback", -3.5),
    "meta": ("byline tags tag meta author date category", -0.7),
    "hidden": ("hidden", -5.0),
}
FIGURES = {"length": 0.3, "links": -2.5, "own length": 0.0, "marks": 0.5, "edge": 0.0, "share": 0.5, "short": 0.0,
           "under": -4.0, "within": 2.5}
OTHER = list(TAGS).index("other")
MARKS = (list(TAGS).index("article"), list(TAGS).index("main"))
GROUP_OF = {t: i for i, (names, _) in enumerate(TAGS.values()) for t in names.split()}
CUE_OF = {w: 1 << i for i, (words, _) in enumerate(CUES.values()) for w in words.split()}
N_TAGS, N_CUES = len(TAGS), len(CUES)
WIDTH = 1 + N_TAGS + N_CUES + len(FIGURES)
#: potentials with the parent (both not, both content) of inline elements, of block elements, and
#: of block elements that their name or a cue sets apart, which say little about their parent
PAIRS = np.array([[5.0, 5.0], [1.5, 1.5], [0.5, 0.0]])
TAG_WEIGHT = [w for _, w in TAGS.values()]
CUE_WEIGHT = [w for _, w in CUES.values()]
PRIOR = np.concatenate(([-0.5], [w for _, w in TAGS.values()], [w for _, w in CUES.values()], list(FIGURES.values()),
                        PAIRS.ravel()))


# ------------------------------------------------------------------ pages --

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)|<[A-Za-z][^>]*+\Z", re.S)
_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in RAW}
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'])(class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_TOKENS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_LABEL = re.compile(r"data-y=([01])")
_MARKS = re.compile(r"[.,;:!?…。！？、]")


@lru_cache(4096)
def _cues(attributes: str) -> int:
    found = CUE_OF["hidden"] if _HIDDEN.search(attributes) else 0
    for _, a, b, c in _ATTRIBUTE.findall(attributes):
        for word in _TOKENS.findall(a or b or c):
            found |= CUE_OF.get(word.lower(), 0)
    return found


@lru_cache(4096)
def _apart(tag: int, cue: int) -> bool:
    """Whether name and cues speak against an element more than a little."""
    return TAG_WEIGHT[tag] + sum(w for i, w in enumerate(CUE_WEIGHT) if cue >> i & 1) < -2


class Tree:
    """The elements of one page in page order, and its text: (block, element, text).
    Element 0 is the page itself."""

    def __init__(self, source: str):
        self.parent, self.depth, self.tag, self.cue, self.inline = [0], [0], [GROUP_OF["html"]], [0], [False]
        self.in_link, self.label, self.apart, self.under, self.within = [False], [0], [False], [False], [False]
        self.text: list[tuple[int, int, str]] = []
        # open elements: (name, element, place of the nearest block at or below)
        self.open = [("", 0, 0)]
        self.names: dict[str, int] = {}
        self.block = 0
        at = 0
        while True:
            m = _TOKEN.search(source, at)
            if m is None:
                self._data(source[at:])
                return
            self._data(source[at:m.start()])
            at, name = m.end(), (m[2] or "").lower()
            if not name:
                continue
            if m[1]:
                self._end(name)
            elif name in RAW:
                end = _END[name].search(source, at)
                at = end.end() if end else len(source)
            else:
                self._start(name, m[3])

    def _data(self, data: str) -> None:
        if data:
            self.text.append((self.block, self.open[-1][1], entities.unescape(data) if "&" in data else data))

    def _pop(self, upto: int) -> None:
        for name, _, _ in self.open[upto:]:
            self.names[name] -= 1
            self.block += name not in INLINE
        del self.open[upto:]

    def _start(self, name: str, attributes: str) -> None:
        inline = name in INLINE
        if not inline:
            self.block += 1
            near = self.open[-1][2]
            if self.open[near][0] == "p":
                self._pop(near)
            if name in ITEMS:
                near = self.open[-1][2]
                while self.open[near][0] in ITEMS[name]:
                    self._pop(near)
                    near = self.open[-1][2]
        elif name == "br":
            self.text.append((self.block, self.open[-1][1], " "))
        if name in VOID:
            return
        up = self.open[-1][1]
        me = len(self.parent)
        group = GROUP_OF.get(name, OTHER)
        if name == "header" and (self.names.get("article") or self.names.get("main")):
            group = GROUP_OF["section"]          # the article's own heading
        self.parent.append(up)
        self.depth.append(self.depth[up] + 1)
        self.tag.append(group)
        # a body's classes speak of the whole page
        cue = _cues(attributes) if attributes and not attributes.isspace() and name not in ("html", "body") else 0
        self.cue.append(cue)
        self.apart.append(_apart(group, cue))
        self.under.append(self.under[up] or self.apart[up])
        # an element set apart ends what the mark encloses
        self.within.append((self.within[up] or self.tag[up] in MARKS) and not self.apart[me])
        self.inline.append(inline)
        self.in_link.append(self.in_link[up] or name == "a")
        given = _LABEL.search(attributes) if "data-y=" in attributes else None
        self.label.append(int(given[1]) if given else self.label[up])
        self.open.append((name, me, self.open[-1][2] if inline else len(self.open)))
        self.names[name] = self.names.get(name, 0) + 1

    def _end(self, name: str) -> None:
        if not self.names.get(name):
            return
        low = self.open[-1][2] if name in INLINE else 1
        at = len(self.open) - 1
        while at >= low and self.open[at][0] != name:
            at -= 1
        if at >= max(low, 1):
            self._pop(at)


class Forest:
    """Features of the elements of several pages, and message passing over them."""

    def __init__(self, trees: list[Tree]):
        sizes = [len(t.parent) for t in trees]
        self.first = first = np.concatenate(([0], np.cumsum(sizes)))[:-1].astype(np.int64)
        flat = lambda name, kind: np.concatenate([np.array(getattr(t, name), kind) for t in trees])
        page = np.repeat(np.arange(len(trees)), sizes)
        self.parent = flat("parent", np.int64) + first[page]
        self.depth = flat("depth", np.int64)
        tag, cue = flat("tag", np.int64), flat("cue", np.int64)
        self.kind = np.where(flat("apart", bool), 2, np.where(flat("inline", bool), 0, 1))
        self.label = flat("label", np.int64)
        n = len(page)
        own, words, marks = np.zeros(n), np.zeros(n), np.zeros(n)
        for t, start in zip(trees, first):
            for _, element, text in t.text:
                some = text.split()
                if some:
                    own[start + element] += sum(map(len, some))
                    words[start + element] += len(some)
                    marks[start + element] += len(_MARKS.findall(text))
        self.observed = own > 0
        links = np.where(flat("in_link", bool), own, 0.0)
        # elements of each depth, deepest last; a page's root has depth 0
        order = np.argsort(self.depth, kind="stable")
        cuts = np.searchsorted(self.depth[order], np.arange(self.depth.max(initial=0) + 2))
        self.levels = [order[a:b] for a, b in zip(cuts[1:-1], cuts[2:])]
        total = [x.copy() for x in (own, words, marks, links)]
        for level in reversed(self.levels):
            for x in total:
                np.add.at(x, self.parent[level], x[level])
        chars, words, marks, links = total
        # characters before an element on its page: those of all elements that start earlier
        before = np.cumsum(own) - own
        before -= before[first][page]
        whole = np.maximum(chars[first], 1.0)[page]
        place = (before + chars / 2) / whole
        # links inside a block are the block's matter: an inline link goes with its block
        figures = [np.log1p(chars) / 6, np.where(flat("inline", bool), 0.0, links / np.maximum(chars, 1.0)), np.log1p(own) / 6,
                   np.minimum(1.0, 10 * marks / np.maximum(words, 1.0)), np.abs(2 * np.clip(place, 0, 1) - 1),
                   chars / whole, ((own > 0) & (own < 30)).astype(float), flat("under", float), flat("within", float)]
        self.x = np.zeros((n, WIDTH))
        self.x[:, 0] = 1
        self.x[np.arange(n), 1 + tag] = 1
        self.x[:, 1 + N_TAGS:1 + N_TAGS + N_CUES] = (cue[:, None] >> np.arange(N_CUES)) & 1
        self.x[:, 1 + N_TAGS + N_CUES:] = np.stack(figures, 1)

    def marginals(self, weights: np.ndarray, given: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """P(content) of every element, and P(both not), P(both content) of every
        element with its parent; ``given``: with the labels of elements with text."""
        own = np.zeros((len(self.x), 2))
        own[:, 1] = self.x @ weights[:WIDTH]
        if given:
            seen = np.flatnonzero(self.observed)
            own[seen, 1 - self.label[seen]] = -1e6
        same = weights[WIDTH:].reshape(PAIRS.shape)[self.kind]          # element: (both not, both content)
        # up: what the subtree says of the parent
        inside, up = own, np.zeros_like(own)
        for level in reversed(self.levels):
            low, agree = inside[level], same[level]
            up[level, 0] = np.logaddexp(low[:, 0] + agree[:, 0], low[:, 1])
            up[level, 1] = np.logaddexp(low[:, 0], low[:, 1] + agree[:, 1])
            np.add.at(inside, self.parent[level], up[level])
        # down: what the rest of the page says of the element
        belief = inside.copy()
        both = np.zeros_like(own)
        for level in self.levels:
            rest, agree = belief[self.parent[level]] - up[level], same[level]
            low = inside[level]
            joint = np.stack((rest[:, 0] + low[:, 0] + agree[:, 0], rest[:, 0] + low[:, 1],
                              rest[:, 1] + low[:, 0], rest[:, 1] + low[:, 1] + agree[:, 1]), 1)
            joint = np.exp(joint - joint.max(1, keepdims=True))
            joint /= joint.sum(1, keepdims=True)
            both[level] = joint[:, [0, 3]]
            down = np.stack((np.logaddexp(rest[:, 0] + agree[:, 0], rest[:, 1]),
                             np.logaddexp(rest[:, 0], rest[:, 1] + agree[:, 1])), 1)
            belief[level] = low + down
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -700, 700))), both


# --------------------------------------------------------------- training --

_ARTICLE = re.compile(r"<(/?)(article|main)(?=[\s>])", re.I)
_NAMED = re.compile(r"<(/?)(?:nav|footer|header|aside|div class=\"ad\")[^>]*>", re.I)
_BLOCK = re.compile(r"<(p|h[1-6]|ul|ol|table|blockquote|pre|figure|div|section)(?=[\s>])", re.I)
_PARAGRAPH = re.compile(r"<p[^>]*>([^<>]{20,})</p>", re.I)
_NOISE = ['<div class="cookie-notice">', '<aside class="sidebar">', '<div class="advert">', '<section id="comments">',
          '<div class="comment">', '<div class="related">', '<div class="newsletter">', '<div class="share">',
          "<aside>", "<form>", '<header class="masthead">', '<div class="menu">', '<div class="popup">', "<footer>"]


def _noise(source: str, k: int, some: list[str]) -> str:
    start = _NOISE[(len(source) + 5 * k) % len(_NOISE)]
    name = re.match(r"<(\w+)", start)[1]
    text = some[(k * 7) % len(some)][:400]
    words = text.split()
    inside = (f"<p>{text}</p>", f"<h3>{' '.join(words[:3])}</h3><p>{text}</p>", f"<h4>{words[0]}</h4><ul><li>{text}</li></ul>",
              f"<h2>{words[-1]}</h2><div><p>{text}</p><p>{words[0]}</p></div>")[(len(source) + k) % 4]
    return f"{start[:-1]} data-y=0>{inside}</{name}>"


def training_pages(source: str) -> list[str]:
    """The page as it is; the page with a plain ``div`` for its mark and with noise around
    and inside its article; and the page whose paragraphs stand in the body itself, its
    menus and footers without names. Labels are given by ``data-y``."""
    marked = _ARTICLE.sub(lambda m: f"</{m[2]}" if m[1] else f"<{m[2]} data-y=1", source)
    plain = _ARTICLE.sub(lambda m: "</div" if m[1] else "<div data-y=1", source)
    some = _PARAGRAPH.findall(source)
    cut = plain.find("<div data-y=1")
    head, body = plain[:cut], plain[cut:]
    end = body.rfind("</div")
    if not some or end < 0:
        return [marked, plain]
    body, tail = body[:end], body[end + 6:]
    noise = [_noise(source, k, some) for k in range(6)]
    # articles hold lists and inner boxes too
    words = some[-1].split()
    box = "section" if len(source) % 2 else "div"
    body += f"<ul><li>{' '.join(words[:20])}</li><li>{words[0]}</li></ul><{box}><p>{some[0]}</p>{words[-1]}</{box}>"
    after = body.find("</p>") + 4
    noisy = body[:after] + noise[2] + body[after:] if after > 3 else body
    noisy = head + noise[0] + noise[1] + noisy + noise[3] + "</div>" + noise[4] + noise[5] + tail
    bare = lambda text: _NAMED.sub(lambda m: f"</{box}>" if m[1] else f"<{box} data-y=0>", text)
    blocks = _BLOCK.sub(r"<\1 data-y=1", body.split(">", 1)[1])
    return [marked, noisy, bare(head) + blocks + noise[3] + noise[4] + bare(tail)]


def fit(pages: list[str], rounds: int = ROUNDS, pull: float = 0.01, pull_pairs: float = 0.5) -> np.ndarray:
    """Weights that maximise the pages' mean log likelihood, less half the squared distance from
    the prior means times ``pull`` (adaptive gradient steps). The potentials with the
    parent are held closer: pages of one make would take them for certain."""
    weights = PRIOR.copy()
    pulls = np.concatenate((np.full(WIDTH, pull), np.full(PAIRS.size, pull_pairs)))
    if not pages:
        return weights
    forest = Forest([Tree(p) for page in pages for p in training_pages(page)])
    count = float(len(forest.first))
    kinds = np.stack([forest.kind == k for k in range(len(PAIRS))]).astype(float)
    kinds[:, forest.depth == 0] = 0

    def expected(given: bool) -> np.ndarray:
        p, both = forest.marginals(weights, given)
        return np.concatenate((p @ forest.x, (kinds @ both).ravel()))

    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for k in range(1, rounds + 1):
        step = (expected(True) - expected(False)) / count - pulls * (weights - PRIOR)
        first = 0.9 * first + 0.1 * step
        second = 0.99 * second + 0.01 * step * step
        weights = weights + 0.1 * (first / (1 - 0.9 ** k)) / (np.sqrt(second / (1 - 0.99 ** k)) + 1e-6)
    return weights


def train(pages: DataFrame, sample: int = SAMPLE, largest: int = LARGEST, rounds: int = ROUNDS) -> np.ndarray:
    """Fit on the labelled pages of smallest hash (bounded, see above)."""
    source = pages["html"].cast("string")
    marked = pages.where(source.rlike(r"(?i)<(article|main)[\s>]") & (F.length(source) <= largest)).select(
        source.alias("html"), F.xxhash64(source).alias("hash"))
    # hashes first, so that no more than the sample reaches the driver; copies count once
    last = marked.select("hash").distinct().orderBy("hash").limit(sample).agg(F.max("hash")).first()[0]
    if last is None:
        return fit([], rounds)
    some = marked.where(F.col("hash") <= last).groupBy("hash").agg(F.min("html").alias("html")).orderBy("hash")
    return fit([r["html"] for r in some.collect()], rounds)


# ------------------------------------------------------------- extraction --

def texts(sources: list[str | None], weights: np.ndarray) -> list[str]:
    trees = [Tree(s or "") for s in sources]
    if not trees:
        return []
    forest = Forest(trees)
    content = forest.marginals(weights)[0] >= 0.5
    out = []
    for t, start in zip(trees, forest.first):
        blocks: dict[int, list[str]] = {}
        for block, element, text in t.text:
            if content[start + element]:
                blocks.setdefault(block, []).append(text)
        lines = (" ".join("".join(b).split()) for b in blocks.values())
        out.append("\n".join(x for x in lines if x))
    return out


def extract(pages: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """Per row: page_id, url, text, n_chars."""
    weights = train(pages) if weights is None else weights
    slim = pages.select("page_id", "url", pages["html"].cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 2):
            found = texts(b.column(2).to_pylist(), weights)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.string()),
                                              pa.array([len(x) for x in found], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in slim.schema.fields}
    return slim.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
