"""Main text of web pages by composite text density.

A page becomes a tree of nodes; nodes that are no reading text by their tag, role, class or id are left out. Every other
node has its characters C, tags T, link characters LC and link tags LT (with everything below it). Its density is

    C / T * log(C / LC * T / LT, base ln(C / (C - LC) * LC + LCb / Cb * C + e))

with Cb and LCb those of the body, and 1 in place of 0. The density sum of a node is the sum of its children's densities. The
least density on the path from the node with the largest sum up to the body is the threshold: from the body downwards,
every node that reaches it gives its descendant of the largest sum, and the chosen subtrees make up the text. The title and what
stands beside the path inside the body's branch stay if less than a third of it are links; so does an ``article`` or ``main``
beside the path.

What a class or id calls surroundings stays if the page has no text besides; an ``article`` or ``main`` in it always stays. Outside of
those any word of a class or id tells; inside, where an author names things, a class or id only as a whole.

Blocks are cut at block-level tags. Character references are decoded, white space in a block (line-break tags too) becomes
one space, blocks are trimmed and joined by one line break; empty blocks vanish.

Null and empty pages have an empty text; so have pages without any text left. Broken markup never fails: unclosed and stray
tags are taken as a browser would roughly take them. Repeated rows get equal results, ties go to the node that comes first.
An empty table gives an empty table. Other columns are kept; the output columns are replaced. A page is read whole.
"""

from __future__ import annotations

import html
import math

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fieldlab.llm.frames import arrow_map, texts_of

# Elements of the HTML standard by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset(
    "script style noscript template iframe object embed applet canvas svg math audio video map head title nav footer aside form "
    "button select textarea input dialog menu noembed noframes xmp".split()
)
#: Start tags that end an open paragraph.
ENDS_PARAGRAPH = BLOCK - frozenset("body head html caption tbody td tfoot th thead tr legend option optgroup".split())
#: Start tags that end an open element of the same kind, within the given container.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Roles, and words of classes and ids, of what surrounds an article.
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
NAMES = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising advertorial sponsor sponsored sponsors promo promos promotion banner "
    "banners nav navbar navigation menu menus submenu breadcrumb breadcrumbs header masthead topbar footer bottombar sidebar sidebars "
    "aside rail widget widgets related recommended recommendations cookie cookies consent gdpr notice notices alert alerts popup "
    "modal overlay search searchbox side sidenav copyright newsletter subscribe subscription signup login comment comments commentlist "
    "commentform respond replies reply disqus share sharing social toolbar pagination pager skip".split()
)

_TOKEN = regex.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)", regex.S
)
_ATTRIBUTE = regex.compile(r"([^\s=/\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+))")
_NAME_WORD = regex.compile(r"[a-z]+")
#: Class names that tell about a layout, not about the element's own part in it.
_LAYOUT = regex.compile(r"(?:has|with|without|no|is|js)[-_].*|.*[-_](?:free|open|closed|on|off|enabled|disabled|wrapper|container|layout)")


class Node:
    """An element: its children are nodes and texts."""

    __slots__ = ("tag", "above", "children", "chars", "tags", "link_chars", "link_tags", "density", "total", "suspect")

    def __init__(self, tag: str, above: Node | None):
        self.tag, self.above, self.children, self.suspect = tag, above, [], False


def surrounds(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element is no part of the article. ``inside``: within an article or main element, whose header stays."""
    if tag in DROPPED or tag == "header" and not inside:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "role" and value.strip() in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and regex.search(r"display\s*:\s*none", value):
            return True
    return bool(regex.search(r"(?:^|\s)hidden(?:\s|$)", attributes.lower())) and "=" not in attributes


def named_surroundings(tag: str, attributes: str, inside: bool) -> bool:
    """Whether a class or id calls an element surroundings of the article."""
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        if name.lower() not in ("class", "id"):
            continue
        for own in "".join(values).lower().split():
            if _LAYOUT.fullmatch(own):
                continue
            if own != "header" and own in NAMES if inside else any(word in NAMES for word in _NAME_WORD.findall(own)):
                return True
    return False


def parsed(page: str) -> Node:
    """The tree of a page without what surrounds the article. Dropped elements stay as empty nodes while they are open."""
    root = Node("body", None)
    stack = [root]
    gone = 0  # how many elements of the stack, from its end, are inside a dropped one
    at, end = 0, len(page)

    def pop_to(index: int) -> None:
        nonlocal gone
        gone = max(0, gone - (len(stack) - index))
        del stack[index:]

    def open_at(tags, until) -> int | None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                return i
            if stack[i].tag in until:
                return None
        return None

    while at < end:
        mark = page.find("<", at)
        if mark < 0:
            mark = end
        found = _TOKEN.match(page, mark) if mark < end else None
        while mark < end and found is None:  # a lone "<" is text
            mark = page.find("<", mark + 1)
            mark = end if mark < 0 else mark
            found = _TOKEN.match(page, mark) if mark < end else None
        if mark > at and not gone:
            stack[-1].children.append(html.unescape(page[at:mark]))
        if mark >= end:
            break
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            if tag in ("body", "html"):
                continue
            if tag in ("p",) and open_at({"p"}, ENDS_PARAGRAPH - {"p"}) is None:
                if not gone:
                    stack[-1].children.append(Node("p", stack[-1]))
                continue
            limit = () if tag in BLOCK else BLOCK
            i = open_at({tag}, limit)
            if i is not None:
                pop_to(i)
            continue
        if tag in ("html", "body"):
            continue
        if tag in ENDS_PARAGRAPH and (i := open_at({"p"}, {"table", "button", "td", "th", "caption", "object", "template"})) is not None:
            pop_to(i)
        if tag in SIBLINGS and (i := open_at(*SIBLINGS[tag])) is not None:
            pop_to(i)
        if tag != "head" and len(stack) > 1 and stack[-1].tag == "head" and tag not in ("title", "meta", "link", "base", "script", "style", "noscript", "template"):
            pop_to(len(stack) - 1)
        node = Node(tag, stack[-1])
        if tag in VOID:
            if not gone:
                stack[-1].children.append(node)
            continue
        attributes = found[3] or ""
        if tag in RAW:
            close = regex.compile(rf"</{regex.escape(tag)}(?=[\s/>])[^>]*>", regex.I).search(page, at)
            at = close.end() if close else end
            continue
        inside = any(x.tag in ("article", "main") for x in stack)
        if attributes.endswith("/") and tag in ("svg", "path", "use"):
            continue
        if not gone and surrounds(tag, attributes, inside):
            stack[-1].children.append(Node("hr" if tag in BLOCK else "wbr", stack[-1]))
            stack.append(node)
            gone = 1
            continue
        if not gone:
            node.suspect = named_surroundings(tag, attributes, inside)
            stack[-1].children.append(node)
        else:
            gone += 1
        stack.append(node)
    return root


def without_suspects(root: Node) -> Node:
    """Empty the nodes that are surroundings by name, if the page has text besides; of those with an article, all but the way to it."""
    nodes = in_page_order(root)
    holds: set[int] = set()
    for node in reversed(nodes):
        if node.tag in ("article", "main") or id(node) in holds:
            holds.add(id(node))
            if node.above is not None:
                holds.add(id(node.above))
    gone = [n for n in nodes if n.suspect and id(n) not in holds]
    if gone:
        kept = [(n, n.children) for n in gone]
        for n in gone:
            n.children = []
    for n in nodes:
        if n.suspect and id(n) in holds and n.tag not in ("article", "main"):
            n.children = [c for c in n.children if isinstance(c, Node) and id(c) in holds]
    if gone:
        if not any(isinstance(c, str) and c.strip() for n in in_page_order(root) for c in n.children):
            for n, children in kept:
                n.children = children
    return root


def in_page_order(root: Node) -> list[Node]:
    """All nodes, parents before their children."""
    nodes, todo = [], [root]
    while todo:
        node = todo.pop()
        nodes.append(node)
        todo.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return nodes


def weighed(root: Node) -> list[Node]:
    """Set every node's counts, density and density sum; nodes in page order."""
    nodes = in_page_order(root)
    for node in reversed(nodes):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for child in node.children:
            if isinstance(child, str):
                node.chars += len(child) - sum(map(child.count, " \n\t\r\f"))
            else:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags + (child.tag == "a")
        if node.tag == "a":
            node.link_chars = node.chars
    body_share = root.link_chars / max(1, root.chars)
    for node in nodes:
        chars, tags, links = node.chars, max(1, node.tags), node.link_chars
        base = math.log(chars / max(1, chars - links) * links + body_share * chars + math.e)
        inner = chars / max(1, links) * tags / max(1, node.link_tags)
        node.density = chars / tags * math.log(inner) / math.log(base) if chars and inner > 0 and base > 1 else chars / tags
    for node in nodes:
        node.total = sum(c.density for c in node.children if isinstance(c, Node))
    return nodes


def best_below(node: Node) -> Node:
    """The node of the largest density sum in a subtree, the first of equals."""
    return max(in_page_order(node), key=lambda n: n.total)


def chosen(root: Node) -> list[Node]:
    """The subtrees that hold the article, in page order."""
    weighed(root)
    best = best_below(root)
    if best.total <= 0:
        return [root]
    path = [best, *_ancestors(best)]
    threshold = min(n.density for n in path)
    on_path = set(map(id, path))
    marked: list[Node] = []
    todo = [root]
    while todo:
        node = todo.pop()
        if node.density < threshold and id(node) not in on_path:
            beside = node.tag in ("h1", "article", "main") or node.above is not root
            if beside and 3 * node.link_chars < node.chars:
                marked.append(node)
            continue
        if id(node) not in on_path or node is best:
            marked.append(node if node.total <= 0 or node is best else best_below(node))
            continue
        loose = [c for c in node.children if isinstance(c, str) and c.strip()]
        if loose:  # text beside elements is the node's own
            marked.append(node)
            continue
        todo.extend(c for c in reversed(node.children) if isinstance(c, Node) and c.chars)
    return marked or [root]


def _ancestors(node: Node) -> list[Node]:
    found = []
    while node.above is not None:
        node = node.above
        found.append(node)
    return found


def blocks(node: Node) -> list[str]:
    """Texts of a subtree cut at block-level tags."""
    made: list[str] = []
    run: list[str] = []

    def cut() -> None:
        text = " ".join("".join(run).split())
        if text:
            made.append(text)
        run.clear()

    todo: list = [node]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            run.append(item)
        elif item is None:
            cut()
        else:
            if item.tag in BLOCK:
                cut()
                todo.append(None)
            elif item.tag == "br":
                run.append(" ")
            todo.extend(reversed(item.children))
    cut()
    return made


def main_text(page: str | None) -> str:
    """The article of a page."""
    if not page:
        return ""
    return "\n".join(b for node in chosen(without_suspects(parsed(page))) for b in blocks(node))


def extracted(pages: DataFrame, source: str = "html", text: str = "text") -> DataFrame:
    """Add the main text of a column of pages."""
    kept = pages.drop(text)
    schema = T.StructType(list(kept.schema.fields)).add(text, "string")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [main_text(p) for p in texts_of(batch.column(source))]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=schema.names)

    return arrow_map(kept, run, schema)
