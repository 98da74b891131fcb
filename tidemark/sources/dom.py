"""A small document tree with the selectors that listings and pages are described by."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: A start tag that ends an open one of these.
CLOSES = {"li": {"li"}, "p": {"p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
BLOCKS = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "pre", "section", "table", "ul"}


class Node:
    __slots__ = ("attrs", "kids", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.kids: list[Node | str] = []

    def nodes(self) -> Iterator[Node]:
        """All below, in document order."""
        todo = [x for x in reversed(self.kids) if isinstance(x, Node)]
        while todo:
            n = todo.pop()
            yield n
            todo += [x for x in reversed(n.kids) if isinstance(x, Node)]

    def text(self, without: frozenset[int] = frozenset()) -> str:
        out: list[str] = []
        todo: list[Node | str] = [self]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
            elif id(x) not in without:
                todo += reversed(x.kids)
        return "".join(out)

    def all(self, selector: str) -> list[Node]:
        wanted = compiled(selector)
        return [n for n in self.nodes() if any(matches(n, steps) for steps in wanted)]

    def first(self, selector: str) -> Node | None:
        wanted = compiled(selector)
        return next((n for n in self.nodes() if any(matches(n, steps) for steps in wanted)), None)

    def attr(self, name: str) -> str | None:
        return self.attrs.get(name)

    def remove(self, selector: str) -> None:
        for n in self.all(selector):
            if n.parent is not None and any(k is n for k in n.parent.kids):
                n.parent.kids = [k for k in n.parent.kids if k is not n]


PART = re.compile(r"([a-zA-Z][\w-]*|\*)|#([\w-]+)|\.([\w-]+)|\[([\w:-]+)(?:([*^$]?=)\"?([^\"\]]*?)\"?(\s+i)?)?\]")


@lru_cache(maxsize=512)
def compiled(selector: str) -> list[list[list[tuple]]]:
    """Groups of steps (from the ancestor to the node itself), each a list of conditions. Raises for what isn't understood."""
    out = []
    for group in re.split(r",(?![^\[]*\])", selector):
        steps = []
        for step in re.split(r"\s+(?![^\[]*\])", group.strip()):
            conds, at = [], 0
            while at < len(step):
                m = PART.match(step, at)
                if not m:
                    raise ValueError(f"selector {selector!r}")
                conds.append(m.groups())
                at = m.end()
            steps.append(conds)
        out.append(steps)
    return out


def _is(n: Node, conds: list[tuple]) -> bool:
    for tag, ident, cls, attr, op, value, fold in conds:
        if tag:
            if tag != "*" and n.tag != tag.lower():
                return False
        elif ident:
            if n.attrs.get("id") != ident:
                return False
        elif cls:
            if cls not in n.attrs.get("class", "").split():
                return False
        else:
            own = n.attrs.get(attr)
            if own is None:
                return False
            if op:
                a, b = (own.lower(), value.lower()) if fold else (own, value)
                if not {"=": a == b, "*=": bool(b) and b in a, "^=": bool(b) and a.startswith(b), "$=": bool(b) and a.endswith(b)}[op]:
                    return False
    return True


def matches(n: Node, steps: list[list[tuple]]) -> bool:
    if not _is(n, steps[-1]):
        return False
    up, left = n.parent, len(steps) - 2
    while left >= 0:
        while up is not None and not _is(up, steps[left]):
            up = up.parent
        if up is None:
            return False
        up, left = up.parent, left - 1
    return True


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {}, None)
        self.at = self.root

    def handle_starttag(self, tag: str, attrs) -> None:
        ends = {"p"} if tag in BLOCKS else CLOSES.get(tag, set())
        if self.at.tag in ends:
            self.at = self.at.parent
        n = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.kids.append(n)
        if tag not in VOID:
            self.at = n

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        n = self.at
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.at = n.parent

    def handle_data(self, data: str) -> None:
        self.at.kids.append(data)


def tree(html: str | None) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


def squash(text: str | None) -> str:
    return re.sub(r"\s+", " ", text or "").strip()
