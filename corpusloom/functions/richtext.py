"""HTML reduced to a small safe subset, and plain text derived from that subset alone.

One pass of the standard parser builds a small tree; unclosed ``p``, ``li``, ``td`` and
``tr`` are closed as browsers do. Rules of the subset are tables below.
"""

from __future__ import annotations

import html
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.decode import repaired

# Fixed values of the subset: elements dropped with what they hold, renamed, kept; the kept
# ones' attributes; schemes of addresses; blocks of the subset, and other blocks, which
# become paragraphs where they hold no block; what a table is made of.
DROPPED = frozenset("script style noscript form iframe object embed applet select option textarea button map svg".split())
RENAMED = {"b": "strong", "i": "em", "u": "em", "cite": "em", "h1": "h3", "h2": "h3", "h5": "h4", "h6": "h4"}
KEPT = frozenset("p br hr h3 h4 blockquote ul ol li table thead tbody tfoot tr th td strong em sub sup a img".split())
ATTRIBUTES = {"a": ("href",), "img": ("src", "alt", "title", "width", "height"), "td": ("colspan", "rowspan"), "th": ("colspan", "rowspan")}
SCHEMES = ("http:", "https:", "mailto:", "ftp:")
TABULAR = frozenset("table thead tbody tfoot tr th td".split())
BLOCKS = frozenset("p h3 h4 blockquote ul ol li hr".split()) | TABULAR
OTHER_BLOCKS = frozenset("div center section article aside header footer main address dl dt dd pre figure figcaption fieldset legend caption nav details summary".split())
#: Times that emptied and one-column tables are looked for in turn.
ROUNDS = 4
_VOID = frozenset(("br", "img", "hr", "input", "meta", "link", "wbr"))
_CLOSES = {"p": ("p",), "li": ("li", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "tr": ("tr", "td", "th", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p")}


class Element:
    __slots__ = ("attrs", "children", "tag")

    def __init__(self, tag: str, attrs: dict | None = None) -> None:
        self.tag, self.attrs, self.children = tag, attrs or {}, []


class _Tree(HTMLParser):
    def __init__(self, source: str) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("body")
        self.open = [self.root]
        self.feed(source)
        self.close()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _CLOSES:
            while len(self.open) > 1 and self.open[-1].tag in _CLOSES[tag]:
                self.open.pop()
        elif tag in (BLOCKS | OTHER_BLOCKS) and self.open[-1].tag == "p":
            self.open.pop()
        element = Element(tag, dict(attrs))
        self.open[-1].children.append(element)
        if tag not in _VOID:
            self.open.append(element)

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def safe_url(url: str | None) -> str | None:
    """An address of an allowed scheme, or one without a scheme; white space and controls, which
    browsers ignore, can't hide a scheme."""
    url = (url or "").strip()
    bare = re.sub(r"[\x00-\x20]", "", url).lower()
    head = re.split(r"[/?#]", bare, maxsplit=1)[0]
    return url if bare and (bare.startswith(SCHEMES) or ":" not in head) else None


def _text_in(node) -> bool:
    return bool(node.strip()) if isinstance(node, str) else any(map(_text_in, node.children))


def _has(node, tags) -> bool:
    return isinstance(node, Element) and (node.tag in tags or any(_has(c, tags) for c in node.children))


def _kept(tag: str, attrs: dict, children: list) -> list:
    """An element of the subset with its attributes; a link without an address is its children."""
    own = {k: v for k, v in attrs.items() if k in ATTRIBUTES.get(tag, ()) and v is not None}
    for k in ("href", "src"):
        if k in own and (url := safe_url(own.pop(k))):
            own[k] = url
    if tag == "a" and "href" not in own:
        return children
    out = Element(tag, own)
    out.children = children
    return [out]


def _cleaned(node) -> list:
    """The node in the subset: itself, a paragraph, its children, or nothing."""
    if isinstance(node, str):
        return [re.sub(r"\s+", " ", node)]
    if node.tag in DROPPED:
        return []
    children = [x for child in node.children for x in _cleaned(child)]
    tag = RENAMED.get(node.tag, node.tag)
    if tag in KEPT:
        return _kept(tag, node.attrs, children)
    return _unwrapped(tag, children)


def _unwrapped(tag: str, children: list) -> list:
    """A block outside the subset: a paragraph if it holds no block, else what it holds."""
    if tag in OTHER_BLOCKS and not any(_has(c, BLOCKS) for c in children):
        return _kept("p", {}, children)
    return children


def _pruned(nodes: list) -> list:
    """Without the blocks that hold nothing; an image counts, but not as all of a table."""
    out = []
    for n in nodes:
        if isinstance(n, Element) and n.tag in BLOCKS and n.tag != "hr" and not _text_in(n) and (n.tag in TABULAR or not _has(n, ("img",))):
            continue
        if isinstance(n, Element):
            n.children = _pruned(n.children)
        out.append(n)
    return out


def _rows(table: Element) -> list[Element]:
    """A table's own rows, not those of tables inside it."""
    out = []
    for c in table.children:
        if isinstance(c, Element) and c.tag != "table":
            out += [c] if c.tag == "tr" else _rows(c)
    return out


def _undone(nodes: list) -> tuple[list, bool]:
    """Tables none of whose rows has two cells as the blocks they stand for, and whether there were any."""
    out, found = [], False
    for n in nodes:
        if not isinstance(n, Element):
            out.append(n)
            continue
        n.children, inside = _undone(n.children)
        found |= inside
        if n.tag == "table" and max((sum(isinstance(c, Element) and c.tag in ("td", "th") for c in r.children) for r in _rows(n)), default=0) <= 1:
            out += _loosened(n)
            found = True
        else:
            out.append(n)
    return out, found


def _loosened(node: Element) -> list:
    children = [x for c in node.children for x in (_loosened(c) if isinstance(c, Element) and c.tag in TABULAR and c.tag != "table" else [c])]
    return _unwrapped("div", children)


def _blank(node) -> bool:
    return not node.strip() if isinstance(node, str) else node.tag == "br"


def _paragraphs(nodes: list) -> list:
    """Runs of inline nodes between blocks as paragraphs; two breaks end one."""
    out: list = []
    run: list = []

    def flush() -> None:
        while run and _blank(run[-1]):
            run.pop()
        while run and _blank(run[0]):
            run.pop(0)
        if run:
            if isinstance(run[0], str):
                run[0] = run[0].lstrip()
            if isinstance(run[-1], str):
                run[-1] = run[-1].rstrip()
            out.extend(_kept("p", {}, run[:]))
        run.clear()

    breaks = 0
    for n in nodes:
        if isinstance(n, Element) and n.tag in BLOCKS:
            flush()
            out.append(n)
            breaks = 0
            continue
        if isinstance(n, Element) and n.tag == "br":
            breaks += 1
        elif not _blank(n):
            if breaks > 1:
                flush()
            breaks = 0
        run.append(n)
    flush()
    return out


def _written(node) -> str:
    if isinstance(node, str):
        return html.escape(node, quote=False)
    attrs = "".join(f' {k}="{html.escape(v)}"' for k, v in node.attrs.items())
    inner = "".join(map(_written, node.children))
    return f"<{node.tag}{attrs}>" if node.tag in _VOID else f"<{node.tag}{attrs}>{inner.strip() if node.tag in BLOCKS else inner}</{node.tag}>"


def _body(root: Element) -> list:
    """What a page's body holds, or a fragment; a page's head is none of it."""
    found = _find(root, "body") or _find(root, "html") or root
    return [c for c in found.children if not (isinstance(c, Element) and c.tag == "head")]


def _find(node: Element, tag: str) -> Element | None:
    for c in node.children:
        if isinstance(c, Element):
            if c.tag == tag:
                return c
            if c.tag in ("html", "head", "body") and (found := _find(c, tag)):
                return found
    return None


def _subset(nodes: list) -> list:
    """Nodes of any markup as top blocks of the subset."""
    nodes = [x for n in nodes for x in _cleaned(n)]
    for _ in range(ROUNDS):
        nodes, found = _undone(_pruned(nodes))
        if not found:
            break
    return _pruned(_paragraphs(nodes))


def _tree(source: str) -> list:
    return _subset(_body(_Tree(source).root))


def _markup(nodes: list) -> str:
    return "\n".join(map(_written, nodes))


def clean(source: str | None) -> str:
    """The subset's markup, a top block a line."""
    return _markup(_tree(source or ""))


_APART = frozenset("p h3 h4 blockquote ul ol table hr".split())


def _walk(node, out: list[str], place: int = 0) -> None:
    if isinstance(node, str):
        out.append(node)
    elif node.tag == "br":
        out.append("\n")
    elif node.tag == "li":
        out.append(f"\n{place}. " if place else "\n• ")
        _inside(node, out)
    elif node.tag == "tr":
        cells: list[str] = []
        _inside(node, cells)
        out.append("".join(cells).rstrip("\t") + "\n")
    elif node.tag in ("td", "th"):
        part: list[str] = []
        _inside(node, part)
        out.append(" ".join("".join(part).split()) + "\t")
    elif node.tag != "img":
        apart = node.tag in _APART
        if apart:
            out.append("\n\n")
        _inside(node, out)
        if apart:
            out.append("\n\n")


def _inside(node: Element, out: list[str]) -> None:
    n = 0
    for child in node.children:
        n += isinstance(child, Element) and child.tag == "li"
        _walk(child, out, n if node.tag == "ol" else 0)


def _plain(nodes: list) -> str:
    out: list[str] = []
    for node in nodes:
        _walk(node, out)
    text = re.sub(r"[ \t]+", lambda m: "\t" if "\t" in m.group() else " ", "".join(out).replace("\xa0", " "))
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]*\n[ \t]*", "\n", text)).strip()


def to_text(markup: str | None) -> str:
    """Plain text of markup in the subset."""
    return _plain(_Tree(markup or "").root.children)


def extracted(source: str) -> tuple[str, str]:
    """(body, body_html) from one tree. A wrong decode is undone on the markup, before the text
    is made of it, so the text always follows from the markup."""
    nodes = _tree(source)
    markup = _markup(nodes)
    fixed, method = repaired(markup)
    return (to_text(fixed), fixed) if method else (to_text(markup), markup)


_EXTRACTED = T.StructType([T.StructField("body", T.StringType()), T.StructField("body_html", T.StringType())])


@F.pandas_udf(_EXTRACTED)
def extract(sources: pd.Series) -> pd.DataFrame:
    """struct(body, body_html): the text always follows from the markup."""
    rows = []
    for s in sources:
        rows.append(extracted(s) if isinstance(s, str) else (None, None))
    return pd.DataFrame(rows, columns=["body", "body_html"])


@F.pandas_udf(T.StringType())
def text_of(markup: pd.Series) -> pd.Series:
    return markup.map(lambda m: to_text(m) if isinstance(m, str) else None)
