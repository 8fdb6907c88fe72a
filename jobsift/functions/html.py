"""A small DOM over the standard-library HTML parser, and element matching.

Used inside ``mapInPandas`` tasks: each task parses its own pages; nothing
is gathered on the driver.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from html import unescape
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
        "track", "wbr"}
NOT_RENDERED = {"script", "style", "template", "noscript", "head"}
BREAKS_LINE = {"address", "article", "aside", "blockquote", "br", "dd", "div", "dl", "dt", "fieldset",
               "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "li",
               "main", "nav", "ol", "p", "pre", "section", "table", "tr", "ul"}
CLOSES_P = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption",
            "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav",
            "ol", "p", "pre", "section", "table", "ul"}
IMPLIED_CLOSE = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
                 "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
# an implied end tag does not reach past these
SCOPE_LIMIT = {"#document", "html", "body", "table", "ul", "ol", "dl", "select", "td", "th", "template"}
IMPLIED_END = {"p", *(t for closed in IMPLIED_CLOSE.values() for t in closed)}

#: A plain tag (lower case, attributes in double quotes without entities) and the text up to the next ``<``.
_PLAIN = re.compile(r'<(?:/([a-z][a-z0-9]*)|([a-z][a-z0-9]*)((?: [a-z][a-z0-9-]*="[^"&]*")*))>([^<]*)')
_PLAIN_ATTR = re.compile(r' ([a-z][a-z0-9-]*)="([^"]*)"')
#: Elements whose content is not markup; feeds of the library parser before all that is left of the page goes to it.
NOT_PLAIN = {"script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}
ODD_FEEDS = 8


class Node:
    #: ``number``: place in document order; ``last``: that of its last descendant; ``nth``: place among its element siblings
    __slots__ = ("tag", "attrs", "children", "parent", "number", "last", "nth", "elements")

    def __init__(self, tag, attrs, parent, number=0):
        self.tag = tag
        self.attrs = attrs
        self.children = []
        self.parent = parent
        self.number = self.last = number
        self.elements = 0
        self.nth = 1
        if parent is not None:
            parent.elements += 1
            self.nth = parent.elements

    def get(self, name):
        return self.attrs.get(name)

    def element_children(self):
        return [c for c in self.children if isinstance(c, Node)]

    def iter(self):
        """Descendants in document order (self excluded)."""
        stack = list(reversed(self.element_children()))
        while stack:
            n = stack.pop()
            yield n
            stack.extend(reversed(n.element_children()))

    def text(self):
        """Rendered-style text content: block elements and ``<br>`` break lines,
        whitespace inside a line collapses, empty lines drop; NULL (None) when
        empty. Script, style, template and noscript content is not text."""
        if not self.elements and self.tag not in NOT_RENDERED:
            text = "".join(self.children)
            if "\n" not in text:
                return " ".join(text.split()) or None
        parts = []
        stack = [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                parts.append(n)
            elif n.tag in NOT_RENDERED:
                continue
            elif n.tag in BREAKS_LINE:
                parts.append("\n")
                stack.append("\n")
                stack.extend(reversed(n.children))
            else:
                stack.extend(reversed(n.children))
        lines = (" ".join(line.split()) for line in "".join(parts).split("\n"))
        t = "\n".join(line for line in lines if line)
        return t or None


def _attrs(pairs) -> dict:
    out = {}
    for k, v in pairs:
        out.setdefault(k, v if v is not None else "")  # a repeated attribute keeps its first value
    return out


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#document", {}, None)
        self.cur = self.root
        self.nodes = [self.root]
        self.open_ends = set()  # met elements whose end can be implied

    def read(self, html: str) -> None:
        """The whole page: plain tags by one pattern each, what is not plain by the library parser."""
        at, end = 0, len(html)
        while at < end:
            m = _PLAIN.match(html, at)
            if m is None or m[2] in NOT_PLAIN:
                for _ in range(ODD_FEEDS):
                    to = html.find("<", at + 1)
                    to = end if to < 0 else to
                    self.feed(html[at:to])
                    at = to
                    if not self.rawdata and self.cdata_elem is None:
                        break
                else:
                    self.feed(html[at:])
                    at = end
                continue
            closed, tag, attrs, text = m.groups()
            if tag is None:
                self.handle_endtag(closed)
            else:
                self.handle_starttag(tag, _PLAIN_ATTR.findall(attrs) if attrs else ())
            if text:
                self.cur.children.append(unescape(text) if "&" in text else text)
            at = m.end()
        self.close()

    def _close_implied(self, tag):
        """HTML5 implied end tags, for the common cases: a block start closes an
        open ``p``; ``li`` / ``dt`` / ``dd`` / ``tr`` / ``td`` / ``th`` / ``option``
        close an open sibling of their kind."""
        closes = IMPLIED_CLOSE.get(tag)
        if tag in CLOSES_P:
            closes = (closes or ()) + ("p",)
        if not closes or self.open_ends.isdisjoint(closes):
            return
        n = self.cur
        while n is not None and n.tag not in SCOPE_LIMIT:
            if n.tag in closes:
                self.cur = n.parent
                return
            n = n.parent

    def handle_starttag(self, tag, attrs):
        self._close_implied(tag)
        if tag in IMPLIED_END:
            self.open_ends.add(tag)
        n = Node(tag, _attrs(attrs), self.cur, len(self.nodes))
        self.nodes.append(n)
        self.cur.children.append(n)
        if tag not in VOID:
            self.cur = n

    def handle_startendtag(self, tag, attrs):
        # '<div/>' does not close a non-void element in HTML
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        n = self.cur
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.cur = n.parent

    def handle_data(self, data):
        self.cur.children.append(data)


def _parsed(html: str) -> _Builder:
    b = _Builder()
    b.read(html or "")
    return b


def parse(html: str) -> Node:
    return _parsed(html).root


# --- element tests -----------------------------------------------------------

def match(node: Node, tag=None, attrs=None, has=(), class_has=None, class_token=None) -> bool:
    """``tag``; ``attrs`` equal; ``has`` present; ``class_has`` a substring of the
    class attribute (XPath ``contains(@class, ..)``); ``class_token`` one class."""
    if tag is not None and node.tag != tag:
        return False
    if attrs:
        for k, v in attrs.items():
            if node.attrs.get(k) != v:
                return False
    for k in has:
        if k not in node.attrs:
            return False
    if class_has is None and class_token is None:
        return True
    cls = node.attrs.get("class", "")
    if class_has is not None and class_has not in cls:
        return False
    if class_token is not None and class_token not in cls.split():
        return False
    return True


def find(node: Node, **test):
    """First descendant (document order) passing ``match``; None when absent."""
    for n in node.iter():
        if match(n, **test):
            return n
    return None


def find_all(node: Node, **test):
    return [n for n in node.iter() if match(n, **test)]


def nth_child(node: Node) -> int:
    return node.nth


def _step_ok(n: Node, step: dict) -> bool:
    nth = step.get("nth")
    if nth is not None and nth_child(n) != nth:
        return False
    return match(n, step.get("tag"), step.get("attrs"), step.get("has", ()), step.get("class_has"), step.get("class_token"))


def find_chain(node: Node, steps):
    """First descendant (document order) matching a child-combinator chain
    ``s1 > s2 > ...``, as ``querySelector`` on ``node`` finds it: the element is
    inside ``node``; its ancestors in the chain may be anywhere above it.

    Each step is a dict of ``match`` arguments plus an optional ``nth`` (1-based
    position among the parent's element children, ``:nth-child``).
    """
    return next((n for n in node.iter() if _chain_ok(n, steps)), None)


def _chain_ok(n: Node, steps) -> bool:
    for step in reversed(steps):
        if n is None or not _step_ok(n, step):
            return False
        n = n.parent
    return True


class Page:
    """A parsed page with an index: per named rule (a chain of steps, see ``find_chain``) its elements in document order.

    Every element is looked at once, for the rules of its tag; what lies inside an element is
    then found by its numbers, so the work grows with the page, not with cards x fields x elements.
    """

    def __init__(self, html: str, rules: dict[str, list[dict]]):
        nodes = _parsed(html).nodes
        self.root = nodes[0]
        of_tag: dict = {}
        for name, steps in rules.items():
            last = steps[-1]
            has = next(iter((*last.get("attrs", ()), *last.get("has", ()), *(["class"] if "class_has" in last or "class_token" in last else ()))), None)
            of_tag.setdefault(last.get("tag"), []).append((name, steps, has, last.get("nth")))
        self.found: dict[str, list[Node]] = {name: [] for name in rules}
        self.numbers: dict[str, list[int]] = {name: [] for name in rules}
        any_tag = of_tag.pop(None, [])
        for n in nodes[1:]:
            for name, steps, has, nth in (*any_tag, *of_tag.get(n.tag, ())):
                # what rules most elements out comes before the whole test
                if (has is None or has in n.attrs) and (nth is None or nth == n.nth) and _chain_ok(n, steps):
                    self.found[name].append(n)
                    self.numbers[name].append(n.number)
        for n in reversed(nodes[1:]):
            n.parent.last = max(n.parent.last, n.last)

    def first(self, name: str, inside: Node) -> Node | None:
        """First element of a rule below ``inside``; None when absent."""
        at = bisect_right(self.numbers[name], inside.number)
        if at < len(self.numbers[name]) and self.numbers[name][at] <= inside.last:
            return self.found[name][at]
        return None


def has_ancestor(n: Node, tag: str) -> bool:
    p = n.parent
    while p is not None:
        if p.tag == tag:
            return True
        p = p.parent
    return False
