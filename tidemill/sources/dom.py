"""A small document tree over the standard library's HTML parser, with the selectors that parsers here need."""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator
from html.entities import html5
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNREAD = frozenset(("script", "style"))


@functools.lru_cache(maxsize=1024)
def _simple(told: str) -> tuple[str, tuple[str, ...], tuple[tuple[str, str], ...]]:
    """A simple selector's tag, classes and attributes."""
    tag, rest = re.match(r"([\w-]*)(.*)", told).groups()
    marks = re.findall(r"([.#])([\w-]+)|\[([\w-]+)=([^\]]*)\]", rest)
    return tag, tuple(name for mark, name, _, _ in marks if mark == "."), tuple(("id", name) if mark else (key, value) for mark, name, key, value in marks if mark != ".")


@functools.lru_cache(maxsize=1024)
def _steps(path: str) -> tuple:
    """The parts of a path: simple selectors, and None for a +."""
    return tuple(None if x == "+" else _simple(x) for x in path.replace("+", " + ").split())


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "prior", "last", "_below")

    def __init__(self, tag: str, attrs: dict | None = None, parent: Node | None = None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs or {}, parent, []
        # the element before this one, the last element in it, and all below it once they were asked for
        self.prior, self.last, self._below = None, None, None

    def add(self, node: Node) -> None:
        node.prior, self.last = self.last, node
        self.children.append(node)

    def texts(self, breaks: bool = False) -> Iterator[str]:
        """All text nodes in order, without scripts and styles; breaks: <br> is a line break."""
        open_ = [iter(self.children)]
        while open_:
            for x in open_[-1]:
                if isinstance(x, str):
                    yield x
                elif x.tag == "br" and breaks:
                    yield "\n"
                elif x.tag not in UNREAD:
                    open_.append(iter(x.children))
                    break
            else:
                open_.pop()

    def text(self) -> str:
        return "".join(self.texts())

    def walk(self) -> list[Node]:
        """All nodes below this one in order; made once, when the tree is whole."""
        if self._below is None:
            found, open_ = [], [x for x in reversed(self.children) if isinstance(x, Node)]
            while open_:
                node = open_.pop()
                found.append(node)
                if node.last is not None:
                    open_.extend(x for x in reversed(node.children) if isinstance(x, Node))
            self._below = found
        return self._below

    def _is(self, simple: tuple) -> bool:
        tag, classes, attrs = simple
        if tag and tag != self.tag:
            return False
        if classes:
            own = (self.attrs.get("class") or "").split()
            if any(name not in own for name in classes):
                return False
        return all(self.attrs.get(key) == value for key, value in attrs)

    def matches(self, simple: str) -> bool:
        return self._is(_simple(simple))

    def before(self) -> Node | None:
        return self.prior

    def _selected(self, path: str) -> Iterator[Node]:
        parts = _steps(path)

        def fits(node: Node, i: int) -> bool:
            if not node._is(parts[i]):
                return False
            if i == 0:
                return True
            if parts[i - 1] is None:
                return node.prior is not None and fits(node.prior, i - 2)
            up = node.parent
            while up is not None and up is not self:
                if fits(up, i - 1):
                    return True
                up = up.parent
            return False

        return (n for n in self.walk() if fits(n, len(parts) - 1))

    def select(self, path: str) -> list[Node]:
        """Nodes below this one; a path is simple selectors with blanks (below) or + (right after) between them."""
        return list(self._selected(path))

    def first(self, path: str) -> Node | None:
        return next(self._selected(path), None)


# Plain tags, which most are, and elements whose content HTMLParser reads in a way of its own.
_START = re.compile(r'<([a-zA-Z][a-zA-Z0-9]*)((?: [a-zA-Z-]+="[^"<>&]*")*)>')
_ATTRS = re.compile(r' ([a-zA-Z-]+)="([^"]*)"')
_END = re.compile(r"</([a-zA-Z][a-zA-Z0-9]*)>")
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript plaintext".split())


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("")
        self.open = Counter()

    def updatepos(self, i, j):
        """Nothing here asks for lines and columns."""
        return j

    def parse_starttag(self, i):
        found = _START.match(self.rawdata, i)
        if found is None or (tag := found[1].lower()) in RAW:
            return super().parse_starttag(i)
        self.handle_starttag(tag, [(name.lower(), value) for name, value in _ATTRS.findall(found[2])] if found[2] else [])
        return found.end()

    def parse_endtag(self, i):
        found = _END.match(self.rawdata, i)
        if found is None or self.cdata_elem is not None or (tag := found[1].lower()) in RAW:
            return super().parse_endtag(i)
        self.handle_endtag(tag)
        return found.end()

    def handle_starttag(self, tag, attrs):
        if tag == "p" and self.at.tag == "p" or tag in ("li", "tr", "td", "th", "option") and self.at.tag == tag:
            self.open[tag] -= 1
            self.at = self.at.parent
        node = Node(tag, {k: v if v is not None else "" for k, v in attrs}, self.at)
        self.at.add(node)
        if tag not in VOID:
            self.open[tag] += 1
            self.at = node

    def handle_endtag(self, tag):
        if not self.open[tag]:
            return
        while self.at.tag != tag:
            self.open[self.at.tag] -= 1
            self.at = self.at.parent
        self.open[tag] -= 1
        self.at = self.at.parent

    def handle_data(self, data):
        self.at.children.append(data)


_REFERENCE = re.compile(r"&(?:#(?:[0-9]+|[xX][0-9a-fA-F]+);|([A-Za-z][A-Za-z0-9]*;))?")


def _literal(found: re.Match) -> str:
    """A reference as it is if it is known and ends in a semicolon; else its & as text."""
    told, name = found[0], found[1]
    return told if len(told) > 1 and (name is None or name in html5) else "&amp;" + told[1:]


def parse(html: str, terminated: bool = False) -> Node:
    """The tree of a page. terminated: a character reference without its semicolon, as in a text that was cut, stays as it is."""
    builder = _Builder()
    builder.feed(_REFERENCE.sub(_literal, html) if html and terminated else html or "")
    builder.close()
    return builder.root
