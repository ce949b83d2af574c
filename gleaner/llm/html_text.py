"""Main text of web pages by tree scoring.

The page is cut into tags and texts and made into a tree. Parts that are never main text (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles, comments of readers) are left out by tag, role, or a class or id token that
names one as a whole. A name or a form does not leave out what holds the only article or main part, or most of the prose; it
halves its points. Each
paragraph gives points for its length and its commas to its parent, half of them to the parent's parent; a container's
points are discounted by the share of its text that lies in links. If the best container lies in an ``article`` or
``main`` part, that whole part is kept, link lists and the articles beside it included. Otherwise it is kept with all that stands beside it or beside
its parents and is not mostly links. A page without any paragraph gives the blocks of its body.

A block is the text between the borders of block elements. White space in it, line breaks included, becomes one space;
character references are decoded; blocks are joined in page order by a line feed.

Defined results: a null, empty or tagless-and-blank page has an empty text; broken, unclosed and truncated markup is
read as browsers do in the main (a block element ends an open paragraph, an end tag without a start is skipped, a tag
cut off at the end of the page is dropped, a quote inside a bare attribute value is a character, a quoted value that never ends is
read as a bare one); inline parts that are left out do not split a block; repeated rows give equal texts; an empty table gives no row; other columns
stay. Pages are worked on one by one where they are; nesting of any depth is handled without recursion.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gleaner.llm.common import map_batches

#: An attribute as the standard has it: a name, and maybe a value in quotes or bare. A quote inside a bare value is a character like
#: any other, and a quoted value without its end is read as a bare one, so it never swallows the rest of the page.
_PART = r"(?:\s+|/|[^\s/>=][^\s/>=]*(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]*))?|=)"
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*)({_PART}*+)(?:>|\Z)", re.DOTALL
)
ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
#: The slash of a bare value is part of it.
SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/$")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup.
RAW = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)|\Z", re.IGNORECASE) for name in "script style textarea title noscript xmp iframe noembed".split()}
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
#: An open element of the first kind ends where a start tag of the second kind comes.
ENDS = {"p": BLOCKS - {"option", "caption"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
        "th": {"td", "th", "tr"}, "option": {"option"}}
#: What an implied end does not reach out of.
BARRIERS = frozenset("table td th ul ol dl div article section main body html blockquote form aside nav header footer figure".split())
OUT_TAGS = frozenset(
    "head nav header footer aside form script style noscript template iframe object embed button select textarea input svg canvas audio"
    " video dialog menu noembed applet map".split()
)
OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar status".split())
#: Names of such parts, as whole class or id tokens. Words that take an ending of their own are in ``PLACES``.
OUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adbox sponsor sponsored sponsors promo promos promotion banner"
    " sidebar side-bar menu menus mainmenu nav navbar navigation breadcrumb breadcrumbs header masthead footer cookie cookies consent gdpr"
    " notice notices notification notifications popup modal overlay newsletter subscribe subscription signup login social share sharing"
    " related recommended recommendations comment comments commentlist respond reply replies disqus pager pagination toolbar widget widgets"
    " skiplink skip-link disclaimer paywall".split()
)
#: What may stand before or after such a name in a token: where the part is or what it is made of.
PLACES = frozenset(
    "site page main top bottom left right global primary secondary mobile sticky fixed post article blog user list links link box bar area"
    " container wrapper wrap inner outer block section panel unit slot form button buttons icons nav menu bar content posts articles"
    " thread holder overlay message text".split()
)
#: Parts of these names may hold most of the prose of a page and are still no main text.
NEVER_MAIN = frozenset(
    "ad ads advert adverts advertisement advertisements advertising cookie cookies consent gdpr popup modal newsletter comment comments"
    " commentlist respond reply replies disqus paywall disclaimer".split()
)
#: The head or foot of a page is named by its place on the page; that of an article or a section belongs to it.
HEADS = frozenset("header masthead footer".split())
PAGE_PLACES = PLACES - frozenset("post posts article articles content section block panel unit box list text message thread blog user".split())
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
KEPT_TAGS = frozenset("html body main article".split())
SENTENCE = frozenset("p pre td blockquote li dd div section article main body".split())


def out_words(names: str) -> set[str]:
    """The listed names among class or id tokens.

    A token counts if it is such a name, or one together with words of ``PLACES`` only: ``site-header`` and
    ``comment-list`` do, ``has-sidebar``, ``related-work`` and ``ad-hoc`` do not.
    """
    found = set()
    for token in names.split():
        token = CAMEL.sub("-", token).lower()
        if token in OUT_NAMES:
            found.add(token)
            continue
        words = [word for word in re.split("[-_]+", token.rstrip("0123456789-_")) if word]
        listed = [word for word in words if word in OUT_NAMES]
        places = PAGE_PLACES if HEADS.issuperset(listed) else PLACES
        if listed and all(word in places or word in OUT_NAMES or word.isdigit() for word in words):
            found.update(listed)
    return found


class Node:
    __slots__ = ("tag", "parent", "children", "out", "named", "never", "score", "text", "linked", "commas")

    def __init__(self, tag: str, parent: Node | None, out: bool, named: bool = False, never: bool = False):
        self.tag, self.parent, self.out, self.named, self.never = tag, parent, out, named, never
        self.children: list[Node | str] = []
        self.score, self.text, self.linked, self.commas = 0.0, 0, 0, 0


def left_out(tag: str, attributes: str) -> tuple[bool, bool, bool]:
    """Is this element never main text? Is that by its name only (or as a form)? Is it by a name that no prose outweighs?"""
    if tag in OUT_TAGS and tag != "form":
        return True, False, False
    named, never = tag == "form", False
    if not attributes or tag in KEPT_TAGS:
        return named, named, never
    for name, *values in ATTRIBUTE.findall(attributes):
        value, name = "".join(values), name.lower()
        if name == "role" and value.lower() in OUT_ROLES:
            return True, False, False
        if name in ("class", "id") and (words := out_words(html.unescape(value))):
            named, never = True, never or not NEVER_MAIN.isdisjoint(words)
        if name == "aria-hidden" and value.lower() == "true" or name == "style" and "display:none" in value.replace(" ", "").lower():
            return True, False, False
        if name == "hidden" and value.lower() != "until-found":
            return True, False, False
    return named, named, never


def parse(page: str) -> Node:
    """The tree of a page."""
    root = node = Node("html", None, False)
    opened: dict[str, int] = {}
    position = 0
    while position < len(page):
        match = TAG.search(page, position)
        if match is None:
            break
        if match.start() > position:
            node.children.append(page[position : match.start()])
        position = match.end()
        closing, name, attributes = match.groups()
        if name is None or page[position - 1] != ">":
            continue
        name = name.lower()
        if closing:
            if name in ("br", "p") and not opened.get(name):
                continue
            node = _close(node, name, opened)
        elif name in VOID:
            node.children.append(Node(name, node, False))
        elif name in RAW:
            position = RAW[name].search(page, position).end()
        elif name in ("html", "body"):
            continue
        else:
            node = _make_room(node, name, opened)
            child = Node(name, node, *left_out(name, attributes))
            node.children.append(child)
            if name in BLOCKS or not SELF_CLOSED.search(attributes):
                opened[name] = opened.get(name, 0) + 1
                node = child
    if position < len(page):
        rest = page[position:]
        node.children.append(rest if not re.match(r"</?[a-zA-Z]", rest) else "")
    return root


def _close(node: Node, name: str, opened: dict[str, int]) -> Node:
    """The node that is open after an end tag; one without a start is skipped."""
    if not opened.get(name):
        return node
    while node.tag != name:
        opened[node.tag] -= 1
        node = node.parent
    opened[name] -= 1
    return node.parent


def _make_room(node: Node, name: str, opened: dict[str, int]) -> Node:
    """The node under which a start tag goes, after the ends it implies."""
    for ended, starts in ENDS.items():
        if name in starts and opened.get(ended):
            at = node
            while at.tag != ended and at.tag not in BARRIERS and at.parent:
                at = at.parent
            if at.tag == ended:
                node = _close(node, ended, opened)
    return node


def walk(root: Node) -> Iterator[tuple[Node, bool]]:
    """All kept elements below a node: (node, True) where one starts, (node, False) where it ends."""
    stack: list[tuple[Node, bool]] = [(root, True)]
    while stack:
        node, start = stack.pop()
        yield node, start
        if start:
            stack.append((node, False))
            stack.extend((c, True) for c in reversed(node.children) if isinstance(c, Node) and not c.out)


def measure(root: Node) -> None:
    """Text lengths, linked text lengths and the points of all containers."""
    for node, start in walk(root):
        if start:
            continue
        in_blocks = [0, 0]
        for child in node.children:
            if isinstance(child, str):
                node.text += len(child) - child.count(" ")
                node.commas += sum(map(child.count, ",，、"))
            elif not child.out:
                node.text += child.text
                node.linked += child.linked
                node.commas += child.commas
                if child.tag in BLOCKS:
                    in_blocks[0] += child.text
                    in_blocks[1] += child.commas
        if node.tag == "a":
            node.linked = node.text
        own = node.text - in_blocks[0]
        if node.tag in SENTENCE and own >= 10 and node.parent:
            points = (1 + node.commas - in_blocks[1] + min(own / 100, 3)) * (1 - density(node))
            node.parent.score += points
            if node.parent.parent:
                node.parent.parent.score += points / 2
            if node.tag not in ("p", "li", "dd", "td"):
                node.score += points


def take_back(root: Node) -> None:
    """Named parts around the only article or main part, or around most of the prose, are not left out."""
    named: list[Node] = []
    stack: list[tuple[Node, bool]] = [(root, True)]
    order: list[tuple[Node, bool]] = []
    while stack:
        node, free = stack.pop()
        free = free and not node.out
        order.append((node, free))
        if node.named:
            named.append(node)
        stack.extend((c, free) for c in reversed(node.children) if isinstance(c, Node) and (c.named or not c.out))
    if not named:
        return
    # As if nothing were left out by a name.
    for node in named:
        node.out = False
    measure(root)
    points = {id(node): node.score for node, _ in order}
    prose: dict[int, float] = {}
    for node, _ in reversed(order):
        prose[id(node)] = prose.get(id(node), 0.0) + points[id(node)]
        if node.parent:
            prose[id(node.parent)] = prose.get(id(node.parent), 0.0) + prose[id(node)]
    for node, _ in order:
        node.score, node.text, node.linked, node.commas = 0.0, 0, 0, 0
    for node in named:
        node.out = True
    for tag in ("main", "article"):
        if any(free and node.tag == tag for node, free in order):
            break
        held = [node for node, _ in order if node.tag == tag]
        if held:
            at = max(held, key=lambda node: prose[id(node)])
            while at:
                at.out = False
                at = at.parent
            break
    for node in named:
        if not node.never and 2 * prose[id(node)] > prose[id(root)]:
            node.out = False


def worth(node: Node) -> float:
    return node.score * (1 - density(node)) * (0.5 if node.named else 1)


def density(node: Node) -> float:
    return node.linked / node.text if node.text else 0.0


def main_parts(root: Node) -> list[Node]:
    """The best container and its good siblings, or the article or main part around it, in page order."""
    best, most = root, 0.0
    for node, start in walk(root):
        if start and (points := worth(node)) > most:
            best, most = node, points
    around, whole = best, {}
    while around:
        whole[around.tag] = around
        around = around.parent
    if "main" in whole:
        # An article beside others of one main part is not the whole of it.
        inside = articles(whole["main"])
        return inside if "article" in whole and len(inside) == 1 else [whole["main"]]
    if "article" in whole:
        return articles(whole["article"].parent or whole["article"])
    if best.parent is None or most == 0:
        return [best if most else root]
    # Up to the highest parent that has prose beside the best container.
    path, node = {id(best)}, best
    top = best
    while node.parent:
        if any(beside(child) for child in node.parent.children if child is not node):
            top = node.parent
        node = node.parent
        path.add(id(node))
    kept: list[Node] = []
    stack: list[Node | str] = [top]
    while stack:
        node = stack.pop()
        if isinstance(node, Node) and node is not best and id(node) in path:
            stack.extend(reversed(together(node, path)))
        elif node is best or beside(node) or worth(node) >= max(2.0, 0.2 * most):
            kept.append(node)
    return kept


def articles(root: Node) -> list[Node]:
    """The outermost articles at or below a node, in page order."""
    if root.tag == "article":
        return [root]
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.tag == "article":
            found.append(node)
        else:
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.out)
    return found


def beside(node: Node | str) -> bool:
    """Is this prose that belongs to what stands beside it?"""
    if isinstance(node, str):
        return bool(node.strip())
    return not node.out and node.text > 0 and density(node) < 0.3


def together(node: Node, path: set[int]) -> list[Node]:
    """The children of a node that are not left out; runs of texts and inline elements off the path are one each."""
    found: list[Node] = []
    run = None
    for child in node.children:
        inline = isinstance(child, str) or child.tag not in BLOCKS and id(child) not in path
        if isinstance(child, Node) and child.out:
            run = None
        elif not inline:
            found.append(child)
            run = None
        else:
            if run is None:
                run = Node("span", node, False)
                found.append(run)
            run.children.append(child)
            run.text += len(child) - child.count(" ") if isinstance(child, str) else child.text
            run.linked += 0 if isinstance(child, str) else child.linked
    return found


def blocks(parts: list[Node]) -> list[str]:
    """The blocks of text of these parts; outside an article or main part, lists of nothing but links are menus and stay out."""
    found: list[str] = []
    current: list[str] = []

    def end() -> None:
        text = " ".join(html.unescape("".join(current)).split())
        current.clear()
        if text:
            found.append(text)

    for part in parts:
        menus = part.tag not in ("article", "main")
        stack: list[Node | str | None] = [part]
        end()
        while stack:
            item = stack.pop()
            if item is None:
                end()
            elif isinstance(item, str):
                current.append(item)
            elif item.tag == "br":
                current.append(" ")
            elif item.out or menus and item.tag in ("ul", "ol") and item.text and density(item) > 0.9:
                if item.tag in BLOCKS:
                    end()
                else:
                    current.append(" ")
            elif item.tag in BLOCKS:
                end()
                stack.append(None)
                stack.extend(reversed(item.children))
            else:
                stack.extend(reversed(item.children))
        end()
    return found


def main_text(page: str | None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    root = parse(page)
    take_back(root)
    measure(root)
    return "\n".join(blocks(main_parts(root)))


def extract(pages: DataFrame, source: str = "html") -> DataFrame:
    """``pages`` with ``text`` in place of the markup."""
    kept = [f for f in pages.drop("text").schema.fields if f.name != source]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(p.as_py()) for p in batch.column(source)], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), texts], [*(f.name for f in kept), "text"])

    return map_batches(pages.drop("text"), run, T.StructType([*kept, T.StructField("text", T.StringType())]))
