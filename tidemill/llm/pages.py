"""HTML extraction by maximum-scoring subsequence.

A page is a sequence of words and tags. Words score by where they stand (positive in prose, negative in menus, headers,
footers, sidebars, notices, adverts, forms and comments) and tags score negative; both weights come from labelled
pages. One linear scan finds the contiguous run with the highest sum: the content region. Within it, what scores
negative itself (an advert inside the article) is left out; and where a long advert cuts an article in two, the parts
outside the region that score positive and stand in the same article, main or content element belong to it too.

Labelled pages are of two kinds. Pages of a table whose article element says what their text is: a bounded sample of them,
held-out ones excepted, is learned from by learn(). And pages put together here from declared building blocks
(labelled_pages), for names that a table's pages don't have. The weights are fitted by logistic regression in numpy on the
names of the elements, classes, ids and roles around a word. A class of several words ("social-science") counts as a whole and
by its first, last and other words, each apart from the class of that single word; and a name within an article counts apart
from the same name elsewhere, so that an article's own header stays. Pages of any layout get scores from the same names.
Scores go down from each element to those in it, so that deep nesting takes time in proportion to the page.

Broken markup is read as far as it goes: unclosed elements end where their parents do, a stray end tag is ignored, a
cut tag is dropped, what looks like a tag inside a script is script, and a quotation mark opens a value only after an equals
sign. Scripts and styles run on to their own end tag, or to the page's end without one; titles, text areas, inline frames and
noscript to theirs, or to the next tag. Buttons, selects, objects, templates and drawings aren't content as a whole; one
that never closes counts only up to the first block in it, so that it takes no article with it. Formulas (math) are text of
their paragraph. Character references are decoded, white space inside a block becomes one space, blocks are joined by an
empty line. Nothing is capped. Of two regions of equal sums the first counts; of two elements that hold as much of the region,
the one that comes first in it. Defined results: null html is empty and, like a page without prose, gives the empty text;
null page_id and url pass through; repeated rows repeat; an empty table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

import functools
import html
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import held_out, in_arrow, slices
from tidemill.llm.samples import pick

# HTML's void elements, raw text elements, elements that are read but aren't content, those in which tags follow
# XML, elements within these that hold HTML, elements that another start of the same name closes, and elements that stand on
# a line with others; then those that end a paragraph, that start a block, and that can't stand in a drawing or formula.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript textarea title iframe".split())
ASIDE = frozenset("svg object template select button".split())
FOREIGN = frozenset("svg math".split())
HOLDS_HTML = ("foreignobject", "desc", "mi", "mo", "mn", "ms", "mtext", "annotation-xml")
ONE_AT_A_TIME = frozenset("select button".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br math svg object template select button".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
BLOCKS = CLOSES_P | frozenset("body caption center dd dt figcaption html li summary tbody td tfoot th thead tr".split())
NOT_FOREIGN = BLOCKS | frozenset("b big code em embed i img nobr ruby s small span strike strong sub sup tt u var".split())
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^<>]*\Z", re.S)
NAME = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
SPACE = re.compile(r"[\s\x1c-\x1f\x85]+")
#: Before a name that holds within an article.
IN = "in "


@dataclass
class Text:
    """A run of text: its block, the element whose names hold for it, and the innermost element that it stands in."""

    block: int
    node: int
    text: str
    element: int


@dataclass
class Page:
    #: Text runs, and for each tag the string "tag".
    items: list = field(default_factory=list)
    #: Of each element: the one around it, its tag, and what it is called. Element 0 is the page itself.
    parents: list[int] = field(default_factory=lambda: [0])
    tags: list[str] = field(default_factory=lambda: [""])
    called: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    #: Of each element: the one around it whose names hold in it, the names that it adds to those, whether an article is around it.
    above: list[int] = field(default_factory=lambda: [0])
    added: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    within: list[bool] = field(default_factory=lambda: [False])

    def names(self, node: int) -> frozenset[str]:
        """All names that hold in an element."""
        found: list[str] = []
        while node:
            found += self.added[node]
            node = self.above[node]
        return frozenset(found)

    def scores(self, w: Weights) -> list[float]:
        """Of each element the score of a word in it."""
        sums = [w.bias]
        for above, added in zip(self.above[1:], self.added[1:], strict=True):
            sums.append(sums[above] + sum(w.names.get(n, 0.0) for n in added))
        return [w.bounded(x) for x in sums]

    def depth(self) -> int:
        depths = [0]
        for parent in self.parents[1:]:
            depths.append(depths[parent] + 1)
        return max(depths)


@dataclass
class Aside:
    """An open element of ASIDE: where its items start, its place in the stack, the block around it, where a block in it starts."""

    start: int
    at: int
    block: int
    cut: int | None = None


@functools.lru_cache(maxsize=50_000)
def names_of(tag: str, attributes: str) -> tuple[str, ...]:
    """What an element is called: its tag, and its classes, ids and roles.

    A name of one word is that word. One of several is also "first-", "-last" and "-other-" words. What the whole page is called
    (html, body) tells nothing of its parts.
    """
    found = {f"<{tag}>"}
    for m in NAME.finditer(attributes) if tag not in ("html", "body") else ():
        for token in html.unescape(m[2] or m[3] or m[4] or "").split():
            words = [x.lower() for x in PART.findall(token)]
            if len(words) > 1:
                found.update(("=" + "-".join(words), f"{words[0]}-", f"-{words[-1]}", *(f"-{x}-" for x in words[1:-1])))
            else:
                found.update(words)
    return tuple(sorted(found))


def read(source: str) -> Page:
    page, stack, block, at = Page(), [], 0, 0
    items = page.items
    around, new, held = [0], [()], set()
    barriers: list[str] = []
    opened: list[Aside] = []
    spans: list[tuple[int, int]] = []
    depth, ends, inside = Counter(), {}, [0]

    def text(piece: str) -> None:
        if piece and not piece.isspace():
            items.append(Text(block, around[-1], html.unescape(piece), inside[-1]))
        elif piece and items and isinstance(items[-1], Text):
            items.append(Text(block, around[-1], " ", inside[-1]))

    def close(by_own_tag: bool = False) -> str:
        nonlocal block
        around.pop()
        held.difference_update(new.pop())
        inside.pop()
        tag = stack.pop()
        depth[tag] -= 1
        if tag == "p" or tag in ASIDE:
            barriers.pop()
        if tag in ASIDE:
            aside = opened.pop()
            whole = by_own_tag or aside.cut is None
            spans.append((aside.start, len(items) if whole else aside.cut))
            block = aside.block if whole else block
        return tag

    def close_to(tags: frozenset[str]) -> None:
        while close() not in tags:
            pass

    while True:
        m = TAG.search(source, at)
        if m is None:
            text(source[at:])
            break
        text(source[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        ended = m[3].rstrip().endswith("/")
        foreign = bool(depth["svg"] or depth["math"]) and not any(depth[x] for x in HOLDS_HTML)
        if tag in RAW and not m[1]:
            key = (tag, foreign)
            if key not in ends or (ends[key] and ends[key].start() < at):
                ends[key] = re.compile(rf"</({re.escape(tag)}{'|svg|math' * foreign})\s*>", re.I).search(source, at)
            end = ends[key]
            if not foreign or (not ended and end and end[1].lower() == tag):
                if end:
                    at = end.end()
                else:
                    at = len(source) if tag in ("script", "style") else max(source.find("<", at), at) if "<" in source[at:] else len(source)
                items.append("tag")
                continue
        if tag == "br":
            if items and isinstance(items[-1], Text):
                items.append(Text(block, around[-1], " ", inside[-1]))
            continue
        if not m[1]:
            if foreign and tag in NOT_FOREIGN:
                # what it stands in was never closed
                close_to(FOREIGN)
            if tag in ONE_AT_A_TIME and depth[tag]:
                close_to(frozenset((tag,)))
        if tag not in INLINE and (tag in BLOCKS or not depth["math"]):
            block += 1
            items.append("tag")
        if m[1]:
            if depth[tag]:
                while stack[-1] != tag:
                    close()
                close(True)
        elif tag not in VOID and not ended:
            if tag in CLOSES_P and barriers and barriers[-1] == "p":
                # a paragraph ends here, and with it what it left open
                close_to(frozenset(("p",)))
            elif tag in ("li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1] == tag:
                close()
            if tag in BLOCKS and opened and opened[-1].cut is None:
                # if these never close, their names don't hold for what follows
                for x in reversed(opened):
                    if x.cut is not None:
                        break
                    x.cut, first = len(items), x.at
                around[first:] = [around[first]] * (len(around) - first)
                for i in range(first + 1, len(new)):
                    held.difference_update(new[i])
                    new[i] = ()
            if tag in ASIDE:
                opened.append(Aside(len(items), len(stack), block))
            stack.append(tag)
            depth[tag] += 1
            if tag == "p" or tag in ASIDE:
                barriers.append(tag)
            own, outer = names_of(tag, m[3]), around[-1]
            article = page.within[outer] or page.tags[outer] == "article"
            fresh = tuple(n for n in (*own, *(IN + n for n in own)) if n not in held and (article or not n.startswith(IN)))
            held.update(fresh)
            new.append(fresh)
            page.parents.append(inside[-1])
            page.tags.append(tag)
            page.called.append(own)
            page.above.append(outer)
            page.added.append(fresh)
            page.within.append(article)
            inside.append(len(page.tags) - 1)
            around.append(inside[-1])
    while stack:
        close()
    if spans:
        page.items = without(items, spans)
    return page


def without(items: list, spans: list[tuple[int, int]]) -> list:
    """items with one tag for each stretch of them that spans (start, stop) cover."""
    edges, inside, out = Counter(), 0, []
    for start, stop in spans:
        edges[start] += 1
        edges[stop] -= 1
    for i, x in enumerate(items):
        before = inside
        inside += edges[i]
        if not inside:
            out.append(x)
        elif not before:
            out.append("tag")
    return out


# Words that pages use in classes, ids and roles for what isn't the article, and for the article.
OTHER = """nav navbar navigation menu breadcrumb breadcrumbs header masthead banner footer foot copyright legal sidebar side aside widget related recommended ad ads advert
    advertisement sponsor sponsored promo promotion cookie cookies consent notice alert popup modal overlay newsletter subscribe signup login search form comment comments reply replies discussion
    disqus share sharing social tags pagination pager toolbar skip hidden""".split()
# Of the first, those that also name parts of the article itself; and words that name boxes, whatever is in them.
EITHER = "header foot legal side social tags".split()
BOX = "list item box links wrapper inner container bar block area group".split()
MAIN = "article content main post entry story body text page prose markdown paragraph title headline section wrapper container layout inner column".split()


def labelled_pages(n: int = 600, seed: int = 1) -> list[tuple[Page, list[bool]]]:
    """Pages put together from building blocks, and for each text run whether it belongs to the article."""
    rng = np.random.default_rng(seed)
    pick = lambda words: words[int(rng.integers(len(words)))]
    words = lambda low, high: " ".join(["word"] * int(rng.integers(low, high)))

    any_ = lambda: "".join(chr(97 + int(c)) for c in rng.integers(0, 26, 8))
    never = [x for x in OTHER if x not in EITHER]

    def other(called: list[str] = OTHER) -> str:
        c = pick(called)
        mark = pick([f'class="{c}"', f'id="{c}"', f'role="{c}"', f'class="{pick(MAIN)}-{c}"', f'class="{c}-{pick(BOX)}"', f'class="{any_()}-{c}"', f'class="{pick(never)}-{c}"'])
        links = "".join(f'<li><a href="#">{words(1, 3)}</a></li>' for _ in range(int(rng.integers(2, 8))))
        body = pick([f"<ul>{links}</ul>", f"<p>{words(3, 40)}</p>", words(3, 20), f"<h3>{words(1, 4)}</h3><p>{words(5, 30)}</p>", f"<p>{words(3, 9)} <a href='#'>{words(1, 4)}</a></p>"])
        return pick([f"<nav>{body}</nav>", f"<footer>{body}</footer>", f"<header>{body}</header>" if called is OTHER else f"<div {mark}>{body}</div>", f"<aside>{body}</aside>", f"<form>{body}</form>", f"<div {mark}>{body}</div>", f"<section {mark}>{body}</section>"])

    def own() -> str:
        """A part of an article under a name that elsewhere stands for something else, or that says nothing."""
        text = f"<p>{words(5, 60)}</p>"
        c = pick(EITHER)
        return pick([f"<header>{text}</header>", *[f'<div class="{pick(MAIN)}-{c}">{text}</div>', f'<div class="{pick(MAIN)}-{c}">{words(3, 30)}</div>'] * 2, f'<p class="{c}">{words(5, 60)}</p>', f'<section class="{pick(OTHER)}-{any_()}">{text}</section>', f'<section class="{c}-{any_()}">{text}</section>', f'<div class="{any_()}">{text}</div>'])

    out = []
    for _ in range(n):
        blocks = [f"<h1>{words(2, 9)}</h1>"] + [pick([f"<p>{words(5, 90)}</p>"] * 5 + [f"<h2>{words(2, 6)}</h2>", f"<ul><li>{words(3, 12)}</li><li>{words(3, 12)}</li></ul>", f"<p>{words(4, 30)} <a href='#'>{words(1, 4)}</a> {words(3, 20)}</p>", f"<blockquote><p>{words(5, 30)}</p></blockquote>", f"<div>{words(4, 60)}</div>", f"<p><span>{words(3, 30)}</span></p>", f"<pre>{words(3, 20)}</pre>"]) for _ in range(int(rng.integers(1, 14)))]
        holder = pick(["article", "article", "main", "div", "section"])
        mark = f' class="{pick(MAIN)}"' if holder in ("div", "section") or rng.random() < 0.3 else ""
        before, after = ("".join(other() for _ in range(int(rng.integers(1, 5)))) for _ in range(2))
        if holder == "article" and rng.random() < 0.8:
            blocks[int(rng.integers(1, len(blocks) + 1)):0] = [own() for _ in range(int(rng.integers(1, 5)))]
        inside = [*blocks]
        if rng.random() < 0.4:
            inside.insert(int(rng.integers(1, len(inside) + 1)), other(never))
        outer = pick(["", f'<div class="{pick(MAIN)}">'])
        # every part is closed, so it gives as many text runs by itself as within the page
        runs = lambda part: sum(isinstance(x, Text) for x in read(part).items)
        source = f"<html><head><meta></head><body>{outer}{before}<{holder}{mark}>{''.join(inside)}</{holder}>{after}{'</div>' * bool(outer)}</body></html>"
        page, marks = read(source), [False] * runs(before)
        for b in inside:
            marks += [b in blocks] * runs(b)
        marks += [False] * runs(after)
        out.append((page, marks))
    return out


@dataclass
class Weights:
    names: dict[str, float]
    bias: float
    tag: float

    @staticmethod
    def bounded(odds: float) -> float:
        """The score of a word: its log odds of being content, within bounds.

        The lower bound is the nearer, so that a short notice inside an article doesn't cut it in two.
        """
        return max(-1.0, min(3.0, odds))


def fit(labelled: list[tuple[Page, list[bool], float]]) -> Weights:
    """Weights from pages, whether each of their text runs belongs to the article, and how much a page counts."""
    rows, y, size = [], [], []
    inside = outside = 0.0
    pages_of: Counter = Counter()
    for page, marks, much in labelled:
        marks_left, last = iter(marks), False
        names = {node: page.names(node) for node in {x.node for x in page.items if isinstance(x, Text)}}
        pages_of.update(frozenset().union(*names.values()))
        for x in page.items:
            if isinstance(x, Text):
                last = next(marks_left)
                rows.append(names[x.node])
                y.append(last)
                size.append(max(1, x.text.count(" ")) * much**2)
            elif last:
                inside += much
            else:
                outside += much
    # a name of a single page tells of that page alone
    known = sorted(n for n, pages in pages_of.items() if pages > 1)
    at = {n: i for i, n in enumerate(known)}
    # runs in the same surroundings are one row
    sums: dict[frozenset[str], list[float]] = {}
    for r, label, n in zip(rows, y, size, strict=True):
        both = sums.setdefault(frozenset(x for x in r if x in at), [0.0, 0.0])
        both[label] += math.sqrt(n)
    x = np.zeros((len(sums), len(known) + 1))
    for i, r in enumerate(sums):
        x[i, [at[n] for n in r]] = 1
    x[:, -1] = 1
    no, yes = np.array(list(sums.values())).T
    w, theta = no + yes, np.zeros(x.shape[1])
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(x.shape[1])
        theta -= np.linalg.solve(hess, x.T @ (w * p - yes) + 0.5 * theta)
    # a tag's log odds of standing in the article, held negative: a run pays for each tag that it spans
    tag = min(-0.25, math.log((inside + 1) / (outside + 1)) / 2)
    return Weights(dict(zip(known, theta[:-1], strict=True)), float(theta[-1]), tag)


@functools.lru_cache(maxsize=1)
def made() -> list[tuple[Page, list[bool]]]:
    """The labelled pages, put together once."""
    return labelled_pages()


@functools.lru_cache(maxsize=1)
def weights() -> Weights:
    """From the pages made here alone; the same on every run."""
    return fit([(page, marks, 1.0) for page, marks in made()])


@dataclass(frozen=True)
class Parameters:
    #: The bound of the sample: about so many pages with an article element, none longer than so many code points.
    pages: int = 200
    most_chars: int = 100_000
    #: Elements that stand in each other; pages with more are not learned from.
    most_depth: int = 200


def marked(page: Page) -> list[bool]:
    """Whether each text run of a page stands in an article element."""
    within = [False]
    for parent, tag in zip(page.parents[1:], page.tags[1:], strict=True):
        within.append(tag == "article" or within[parent])
    return [within[x.element] for x in page.items if isinstance(x, Text)]


def learn(pages: DataFrame, p: Parameters = Parameters()) -> Weights:
    """Weights from such pages of the table, those not held out (by page_id), and from the pages made here."""
    rows = pages.filter(~held_out("page_id") & (F.length("html") <= p.most_chars) & F.lower("html").contains("<article"))
    chosen, _ = pick(rows.select(F.col("page_id").alias("doc_id"), F.lit("page").alias("label"), "html"), p.pages, p.pages)
    sources = sorted(r["html"] for r in chosen.collect())
    told = [(page, marked(page)) for page in map(read, sources) if page.depth() <= p.most_depth]
    told = [(page, marks) for page, marks in told if any(marks) and not all(marks)]
    return fit([(page, marks, 1.0) for page, marks in made()] + [(page, marks, len(made()) / len(told)) for page, marks in told])


def region(page: Page, w: Weights) -> tuple[int, int, list[float]]:
    """Start and stop of the best run of items, and each item's score."""
    words = page.scores(w)
    scores = [w.tag if isinstance(x, str) else words[x.node] * len(x.text.split()) for x in page.items]
    best, start, stop, total, begin = 0.0, 0, 0, 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, i
        total += s
        if total > best:
            best, start, stop = total, begin, i + 1
    return start, stop, scores


#: Elements that can hold an article, besides article and main themselves.
HOLDERS = frozenset("div section td".split())


def holders(page: Page, w: Weights) -> list[int]:
    """Of each element the one that holds the article that it is part of: article, else main, else the nearest that is called like one.

    What has none of these is held by the page itself, 0.
    """
    found = [(0, 0, 0)]
    for e in range(1, len(page.tags)):
        article, main, like = found[page.parents[e]]
        tag = page.tags[e]
        if tag == "article":
            article = e
        elif tag == "main":
            main = e
        elif tag in HOLDERS and sum(w.names.get(n, 0.0) for n in page.called[e] if n[0] != "<") > 0.5:
            like = e
        found.append((article, main, like))
    return [article or main or like for article, main, like in found]


def main_text(source: str, w: Weights | None = None) -> str:
    w = w or weights()
    page = read(source)
    items = page.items
    start, stop, scores = region(page, w)
    of = holders(page, w)
    held: Counter = Counter()
    for x, s in zip(items[start:stop], scores[start:stop], strict=True):
        if isinstance(x, Text) and s > 0:
            held[of[x.element]] += s
    same = max(held, key=held.get, default=None)
    blocks: dict[int, list[str]] = {}
    # white space between two parts of a block scores nothing and goes with the part before it
    kept = False
    for i, (x, s) in enumerate(zip(items, scores, strict=True)):
        if not isinstance(x, Text):
            kept = False
            continue
        if start <= i < stop:
            kept = s >= 0
        elif s or not kept:
            kept = s > 0 and of[x.element] == same
        if kept:
            blocks.setdefault(x.block, []).append(x.text)
    whole = (SPACE.sub(" ", "".join(parts)).strip() for parts in blocks.values())
    return "\n\n".join(b for b in whole if b)


def extract(pages: DataFrame, w: Weights | None = None) -> DataFrame:
    """page_id, url, text, n_chars of each row: one narrow pass. w: of learn(), else those of the pages made here."""
    schema = T.StructType([pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    shared = pages.sparkSession.sparkContext.broadcast(w or weights())

    def run(batches):
        w = shared.value
        for part, sources in slices(batches, "html"):
            texts = [main_text(s, w) for s in sources]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=schema.names)

    return in_arrow(pages.select("page_id", "url", F.col("html").cast("string").alias("html")), run, schema)
