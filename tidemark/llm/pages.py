"""Main text of web pages by wrapper induction: pages of a host are aligned as trees, what varies is content."""

from __future__ import annotations

import contextlib
import gc
import re
import sys
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, stored, text_or_empty

#: Different pages of a host that are aligned together, and hosts or repeated pages whose counts are broadcast.
TOGETHER, BROADCAST_ROWS = 64, 200_000
#: Elements in each other that stay so, and open elements among which a tag looks for the one it ends.
DEPTH, REACH = 100, 512
#: Pairs of siblings that are all compared; more are first taken apart at equal children. Nodes of two subtrees, multiplied, up to which their exact matching weighs them.
CELLS, EXACT = 4_096, 4_096

# Elements of HTML by the way they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
MAIN = frozenset(("article", "main"))
NOISE = frozenset("nav aside footer form script style textarea title noscript iframe template head button select option dialog menu object svg canvas audio video input fieldset datalist map".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote li td th dd dt figcaption".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table article section div body main aside nav blockquote".split())
_NAME, _STOP = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)"), re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"""(class|id|role|itemprop|aria-label|hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NOISY = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookie\w*|consent|gdpr|notice\w*|alert|popup|modal|overlay|newsletter|subscribe|signup|login|"
    r"paywall|nav|navbar|navigation|menu|breadcrumb\w*|pagination|pager|toolbar|sidebar\w*|side-bar|complementary|widget\w*|related|recommend\w*|share\w*|sharing|social|"
    r"comment\w*|replies|reply|respond|disqus|discussion|footer|foot|contentinfo|masthead|site-header|page-header|topbar|search|skip-link|hidden|"
    r"kommentar\w*|werbung|anzeige\w*|hinweis\w*|publicidad|comentario\w*|publicite|commentaire\w*)(?=$|[\s_-]|\d)", re.I)


class Node:
    """``noise`` tells whether its names call it a menu, an advert or the like; pages that are aligned may overrule them."""

    __slots__ = ("tag", "names", "children", "block", "noise")

    def __init__(self, tag: str, names: str = ""):
        self.tag, self.names, self.children, self.block, self.noise = tag, names, [], None, False


class _Scan:
    """One pass over a page for the ends of tags; what was looked for in vain is not looked for again."""

    def __init__(self, html: str):
        self.html, self.quoted = html, True
        self.last = {q: html.rfind(q) for q in ">\"'"}
        self.missing: set[str] = set()

    def tag_end(self, at: int) -> int:
        """Where the tag ends that begins before ``at``: at the next ``>`` that no pair of quotes holds; -1 if none is left.

        Where quotes would hide the rest of the page they are taken for characters, from there on throughout.
        """
        if at > self.last[">"]:
            return -1
        place = at
        while self.quoted:
            found = _STOP.search(self.html, place)
            if found is None:
                self.quoted = False
            elif found[0] == ">":
                return found.start()
            elif found.start() == self.last[found[0]]:
                place = found.end()  # a quote that nothing closes
            else:
                place = self.html.find(found[0], found.end()) + 1
        return self.html.find(">", at)

    def raw_end(self, tag: str, at: int) -> int:
        """Where the end tag of an element ends whose content is no markup; -1 if there is none."""
        if tag not in self.missing:
            found = re.compile(f"</{re.escape(tag)}\\b", re.I).search(self.html, at)
            end = self.html.find(">", found.end()) if found else -1
            if end >= 0:
                return end + 1
            self.missing.add(tag)
        return -1


class _Open:
    """The elements that are open, and the tree they build.

    Elements below ``DEPTH`` others are flattened, as browsers do: they and their
    text become children of the one at that depth, in page order. Noise among
    them hides its text.
    """

    def __init__(self):
        self.root = Node("#page")
        self.stack, self.noise_at = [self.root], None

    def text(self, some: str) -> None:
        if some and self.noise_at is None:
            self.stack[min(len(self.stack) - 1, DEPTH)].children.append(some)

    def element(self, node: Node, stays_open: bool) -> None:
        if self.noise_at is None:
            self.stack[min(len(self.stack) - 1, DEPTH)].children.append(node)
        if stays_open:
            if len(self.stack) > DEPTH and self.noise_at is None and is_noise(node, True):
                self.noise_at = len(self.stack)
            self.stack.append(node)

    def cut(self, i: int) -> None:
        """Close the elements from number ``i`` on; where flattened ones were blocks, what follows begins a line."""
        if len(self.stack) > DEPTH + 1 and any(x.tag not in INLINE for x in self.stack[max(i, DEPTH + 1) :]):
            self.stack[DEPTH].children.append(Node("#end"))
        del self.stack[i:]
        if self.noise_at is not None and len(self.stack) <= self.noise_at:
            self.noise_at = None


@contextlib.contextmanager
def _uncollected() -> Iterator[None]:
    """Without the cyclic collector, which would walk the trees of a large page time and again; they hold no cycles."""
    if not gc.isenabled():
        yield
        return
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


@_uncollected()
def parse(html: str) -> Node:
    """A tree of elements and character data; end tags may miss, be too many or cross. Takes one pass, whatever the page is like."""
    scan, tree = _Scan(html), _Open()
    at = begun = 0  # what stands from ``begun`` on is text so far
    while (at := html.find("<", at)) >= 0:
        if html.startswith("<!--", at):
            tree.text(html[begun:at])
            end = html.find("-->", at + 4)
            at = begun = end + 3 if end >= 0 else len(html)
            continue
        name = _NAME.match(html, at)
        if name is None and html[at + 1 : at + 2] not in ("!", "?"):
            at += 1
            continue
        end = scan.tag_end(name.end() if name else at + 2)
        if end < 0:
            break
        tree.text(html[begun:at])
        closes, attributes, at = name and name[1], html[name.end() : end] if name else "", end + 1
        begun = at
        if name is None:
            continue
        tag = name[2].lower()
        if closes:
            _close(tree, tag)
            continue
        if tag not in INLINE:
            _make_room(tree, tag)
        names = " ".join(v for a in _ATTRIBUTE.finditer(attributes) for v in (a[2] or a[3] or a[4] or ("hidden" if a[1].lower() == "hidden" else ""),) if v) if attributes else ""
        empty = tag in VOID or tag in RAW or attributes.endswith("/") and tag in ("svg", "path")
        tree.element(Node(tag, names), not empty)
        if tag in RAW:
            end = scan.raw_end(tag, at)
            at = begun = end if end >= 0 else len(html) if tag in ("script", "style") else at
    tree.text(html[begun:])
    _mark(tree.root, False)
    return tree.root


def _close(tree: _Open, tag: str) -> None:
    stack = tree.stack
    for i in range(len(stack) - 1, max(0, len(stack) - 1 - REACH), -1):
        if stack[i].tag == tag:
            tree.cut(i)
            return
        if tag in INLINE and stack[i].tag not in INLINE:
            return  # an inline end tag closes nothing outside its block


def _make_room(tree: _Open, tag: str) -> None:
    """A block ends an open paragraph and the inline elements in it; an item ends the item before."""
    ends, stack = {"p"} | CLOSED_BY.get(tag, set()), tree.stack
    for i in range(len(stack) - 1, max(0, len(stack) - 1 - REACH), -1):
        if stack[i].tag in ends:
            tree.cut(i)
            return
        if stack[i].tag in SCOPE:
            return


def is_noise(node: Node, inside: bool) -> bool:
    """Menus, headers, footers, sidebars, notices, adverts, forms, comments and what is not text.

    A ``header`` inside the article holds its title and stays.
    """
    return node.tag in NOISE or (node.tag == "header" and not inside) or bool(node.names and node.tag not in ("body", "html") and _NOISY.search(node.names))


def _mark(node: Node, inside: bool) -> None:
    inside = inside or _is_main(node)
    for child in node.children:
        if isinstance(child, Node):
            child.noise = is_noise(child, inside)
            _mark(child, inside)


def _is_block(node: Node) -> bool:
    """A block, or an inline element that holds one."""
    if node.block is None:
        node.block = node.tag not in INLINE or any(isinstance(c, Node) and _is_block(c) for c in node.children)
    return node.block


def _is_main(node: Node) -> bool:
    return node.tag in MAIN or bool(node.names and re.search(r"(?:^|\s)(?:main|articleBody)(?:$|\s)", node.names))


def _parts(node: Node) -> list[tuple[int, list[Node | str] | Node]]:
    """(number of the first child, what it is) in page order: a line of text and inline elements, or a block. Inline noise is left out."""
    out: list = []
    line = None
    for k, child in enumerate(node.children):
        if isinstance(child, Node) and (_is_block(child) or child.noise):
            if not child.noise or child.tag not in INLINE:
                out.append((k, child))
                line = None
        elif line is None:
            out.append((k, line := [child]))
        else:
            line.append(child)
    return out


def _line_text(children: list[Node | str]) -> str:
    return "".join(c if isinstance(c, str) else " " if c.tag == "br" else "" if c.noise else _line_text(c.children) for c in children)


def _linked(children: list[Node | str]) -> int:
    """Characters that stand in links."""
    if len(children) == 1 and isinstance(children[0], str):
        return 0
    return sum(len(" ".join(_line_text(c.children).split())) if c.tag == "a" else _linked(c.children) for c in children if isinstance(c, Node) and not c.noise)


def _gist(node: Node, lines: list[str]) -> int:
    """Adds the lines of text in an element and returns how many of their characters stand in links."""
    links = 0
    for _, part in _parts(node):
        if isinstance(part, Node):
            links += _gist(part, lines)
        elif words := _line_text(part).split():
            lines.append(" ".join(words))
            links += min(_linked(part), len(lines[-1]))
    return links


class Shape:
    """An element or a line of text for alignment; ``key`` names it in a template.

    What names call noise is aligned as one leaf, and does not count in the
    text, size and ``chars`` of what it stands in. ``weight`` and ``links`` are
    the characters of all text and of links, ``lines`` the lines.
    """

    __slots__ = ("label", "key", "children", "text", "size", "chars", "prose", "inside", "kinds", "below", "node", "noise", "weight", "links", "lines")

    def __init__(self, node: Node, inside: bool = False):
        self.label, self.key, self.inside, self.prose = f"{node.tag} {node.names}", id(node), inside, node.tag in PROSE
        self.node, self.noise, self.children, self.kinds, self.below = node, node.noise, [], None, None
        if node.noise:
            lines: list[str] = []
            self.links = _gist(node, lines)
            self.text, self.size, self.chars, self.weight, self.lines = hash((self.label, *lines)), 1, 0, sum(map(len, lines)), len(lines)
            return
        inside = inside or _is_main(node)
        size, chars, weight, links, lines_below, texts = 1, 0, 0, 0, 0, []
        for k, part in _parts(node):
            if isinstance(part, Node):
                child = Shape(part, inside)
            elif words := _line_text(part).split():
                child = Shape._line((id(node), k), " ".join(words), inside, _linked(part))
            else:
                continue
            self.children.append(child)
            weight, links, lines_below = weight + child.weight, links + child.links, lines_below + child.lines
            if not child.noise:
                size, chars = size + child.size, chars + child.chars
                texts.append(child.text)
        self.text, self.size, self.chars, self.weight, self.links, self.lines = hash((self.label, *texts)), size, chars, weight, links, lines_below

    @classmethod
    def _line(cls, key: tuple[int, int], text: str, inside: bool, links: int) -> Shape:
        line = cls.__new__(cls)
        line.label, line.key, line.inside, line.prose, line.node, line.noise = "#line", key, inside, True, None, False
        line.children, line.text, line.size, line.chars, line.kinds, line.below = [], hash(text), 1, len(text), None, None
        line.weight, line.links, line.lines = len(text), min(links, len(text)), 1
        return line


def _whole(shape: Shape) -> int:
    """A hash of all text, noise as well."""
    return hash((shape.text, *map(_whole, shape.children)))


def _kinds(shape: Shape) -> Counter:
    """How often each label and each text stands below."""
    if shape.kinds is None:
        shape.kinds = Counter(x for c in shape.children for x in (c.label, c.text))
        for child in shape.children:
            shape.kinds.update(_kinds(child))
    return shape.kinds


def _below(shape: Shape) -> set[int]:
    """All texts in a subtree."""
    if shape.below is None:
        shape.below = {shape.text}.union(*map(_below, shape.children))
    return shape.below


def _weight(a: Shape, b: Shape) -> int:
    """What a pair is worth: its matched nodes, those of equal text twice; of large subtrees what they hold in common."""
    if a.label != b.label:
        return 0
    if a.text == b.text:
        return 2 * a.size
    if not a.children or not b.children:
        return 1
    if a.size == b.size == 2:
        return 2 if a.children[0].label == b.children[0].label else 1
    if a.size * b.size > EXACT:
        return 1 + sum((_kinds(a) & _kinds(b)).values())
    return 1 + sum(_weight(x, y) for x, y in _matched(a.children, b.children))


def _matched(left: list[Shape], right: list[Shape]) -> list[tuple[Shape, Shape]]:
    """Pairs of children in order, of equal labels and of the most worth, whatever their number."""
    n, head = min(len(left), len(right)), 0
    while head < n and left[head].text == right[head].text and left[head].label == right[head].label:
        head += 1
    tail = 0
    while tail < n - head and left[-1 - tail].text == right[-1 - tail].text and left[-1 - tail].label == right[-1 - tail].label:
        tail += 1
    ends = list(zip(left[:head], right[:head])), list(zip(left[len(left) - tail :], right[len(right) - tail :]))
    left, right = left[head : len(left) - tail], right[head : len(right) - tail]
    return ends[0] + (_best(left, right) if len(left) * len(right) <= CELLS else _apart(left, right)) + ends[1]


def _best(left: list[Shape], right: list[Shape]) -> list[tuple[Shape, Shape]]:
    weights = [[_weight(x, y) for y in right] for x in left]
    best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    for i, row in enumerate(weights):
        for j, weight in enumerate(row):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + weight)
    found, i, j = [], len(left), len(right)
    while i and j:
        if weights[i - 1][j - 1] and best[i][j] == best[i - 1][j - 1] + weights[i - 1][j - 1]:
            i, j = i - 1, j - 1
            found.append((left[i], right[j]))
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return found[::-1]


def _apart(left: list[Shape], right: list[Shape]) -> list[tuple[Shape, Shape]]:
    """Children in long rows: equal ones (the k-th with the k-th) that keep their order are pairs, between them all are compared or, in long rows still, blocks of equal number."""

    def numbered(row: list[Shape]) -> dict:
        seen: Counter = Counter()
        keys = {}
        for i, x in enumerate(row):
            keys[x.label, x.text, seen[x.label, x.text]] = i
            seen[x.label, x.text] += 1
        return keys

    there = numbered(right)
    ends: list[int] = []
    chains: list[tuple] = []  # the best chain of each length, as (pair, chain before)
    for key, i in numbered(left).items():
        if (j := there.get(key)) is not None:
            at = bisect_left(ends, j)
            link = ((i, j), chains[at - 1] if at else None)
            if at == len(ends):
                ends.append(j)
                chains.append(link)
            else:
                ends[at], chains[at] = j, link
    anchors, link = [(len(left), len(right))], chains[-1] if chains else None
    while link:
        anchors.append(link[0])
        link = link[1]
    found, i, j = [], 0, 0
    for x, y in reversed(anchors):
        some, others = left[i:x], right[j:y]
        cuts = 1
        while -(-len(some) // cuts) * -(-len(others) // cuts) > CELLS:
            cuts += 1
        for c in range(cuts):
            found += _best(some[len(some) * c // cuts : len(some) * (c + 1) // cuts], others[len(others) * c // cuts : len(others) * (c + 1) // cuts])
        if x < len(left):
            found.append((left[x], right[y]))
        i, j = x + 1, y + 1
    return found


def align(a: Shape, b: Shape) -> list[tuple[Shape, Shape]]:
    """Tree matching: the pairs of an order-keeping mapping of equal labels that prefers equal texts.

    Below a pair without a text in common only children whose label each side has once are paired: places that pages share, whatever stands there.
    """
    if a.label != b.label:
        return []
    found = [(a, b)]
    for x, y in _only(a, b) if _below(a).isdisjoint(_below(b)) else _matched(a.children, b.children):
        found += align(x, y)
    return found


def _only(a: Shape, b: Shape) -> list[tuple[Shape, Shape]]:
    left, right = Counter(c.label for c in a.children), Counter(c.label for c in b.children)
    once = {c.label: c for c in b.children if right[c.label] == left[c.label] == 1}
    return [(c, once[c.label]) for c in a.children if c.label in once]


def _blocks(node: Node, template: set, out: list[str], line: list[str]) -> None:
    for k, part in _parts(node):
        if isinstance(part, Node):
            if part.tag not in INLINE:
                _flush(out, line)
            if not part.noise and id(part) not in template:
                _blocks(part, template, out, line)
            if part.tag not in INLINE:
                _flush(out, line)
        elif (id(node), k) not in template:
            line.append(_line_text(part))


def _flush(out: list[str], line: list[str]) -> None:
    text = " ".join(unescape("".join(line)).split())
    line.clear()
    if text:
        out.append(text)


def extract(tree: Node, template: set) -> str:
    """All of a page outside its template and noise in page order, one line per block."""
    out: list[str] = []
    _blocks(tree, template, out, line := [])
    _flush(out, line)
    return "\n".join(out)


def _mains(shape: Shape, roots: list[Shape]) -> list[Shape]:
    """The outermost main elements outside noise; what stands in one is ``inside``."""
    for child in shape.children:
        if child.noise:
            continue
        if any(c.inside and not c.noise for c in child.children) and not child.inside:
            roots.append(child)
        elif not child.inside:
            _mains(child, roots)
    return roots


def _outside(shape: Shape, root: Shape) -> set:
    """All that neither is ``root`` nor holds it."""
    if shape is root:
        return set()
    inner = [_outside(c, root) for c in shape.children]
    if not any(c is root or None not in some for c, some in zip(shape.children, inner)):
        return {None}
    return set().union(*({c.key} if None in some else some for c, some in zip(shape.children, inner)))


def _lone(shape: Shape) -> set:
    """A page that no other can be aligned with: its one main element decides, if that holds most of the text."""
    roots = _mains(shape, [])
    return _outside(shape, roots[0]) if len(roots) == 1 and 2 * roots[0].chars > shape.chars else set()


def _constant(shape: Shape, same: set, few: bool, out: set) -> None:
    """The outermost constant nodes. In a main element prose stays if few pages agree, or between prose that varies."""
    varying = [i for i, c in enumerate(shape.children) if c.key not in same and c.chars]
    for i, child in enumerate(shape.children):
        if child.key not in same or not child.chars:
            _constant(child, same, few, out)
        elif not (child.inside and child.prose and (few or varying and varying[0] < i < varying[-1])):
            out.add(child.key)


def _chars_of(shape: Shape, keys: set) -> int:
    return sum(c.chars if c.key in keys else _chars_of(c, keys) for c in shape.children)


def _prose_in_main(shape: Shape, keys: set) -> set:
    return set().union(*({c.key} if c.key in keys and c.inside and c.prose else _prose_in_main(c, keys) for c in shape.children))


def _noisy(shape: Shape, found: list[Shape]) -> list[Shape]:
    """The outermost elements that names call noise."""
    for child in shape.children:
        if child.noise:
            found.append(child)
        else:
            _noisy(child, found)
    return found


def _link_lists(shape: Shape, template: set, found: list[Shape]) -> list[Shape]:
    """The outermost blocks outside the main element that are lists of links, whatever they are called: three lines or more, nearly all of it linked."""
    for child in shape.children:
        if child.key in template or child.inside:
            continue
        if not child.prose and child.lines >= 3 and 10 * child.links >= 9 * child.weight > 0:
            found.append(child)
        else:
            _link_lists(child, template, found)
    return found


def _agreed(held: list[dict], voters: list[int], few: bool) -> set:
    """The slots, by the node of the reference, that most pages (of few pages all) found to be of a kind."""
    votes = Counter(key for i in voters for key in set(held[i].values()))
    return {key for key, n in votes.items() if (n == len(voters) if few else 2 * n > len(voters))}


def induce(trees: list[Node], decided: Counter | None = None, names_decide: bool = True) -> list[set]:
    """The template of each page: nodes and lines aligned with a page of the group and of equal text in most of the pages.

    Pages are aligned whole with the one whose tree is of median size, noise by
    name included. Those of equal text outside noise count once. Slots, the
    places that pages share, are judged over the group: constant ones are
    template, and so are lists of links outside the main element that leave the
    larger part of the page. Names then take out what varies and is called
    noise, unless most pages would keep no text: such a slot is content,
    whatever it is called. Of two or three different pages all have to agree,
    and then prose in a main element stays. Where template prose would be most
    of a page's main element, pages copy each other and it stays.

    ``decided`` counts the characters that constancy, links and names take out
    and those that are kept, and pages by how they were judged.
    """
    shapes = [Shape(t) for t in trees]
    distinct = {s.text: i for i, s in reversed(list(enumerate(shapes)))}
    count = Counter() if decided is None else decided
    if len(distinct) < 2 and names_decide and not any(s.chars for s in shapes):  # all they hold is called noise
        distinct = {_whole(s): i for i, s in reversed(list(enumerate(shapes)))}
    if len(distinct) < 2:
        templates = [_lone(s) for s in shapes]
        for shape, template in zip(shapes, templates):
            out = _chars_of(shape, template)
            count.update({"by main element": out, "by names": sum(s.weight for s in _noisy(shape, [])), "kept": shape.chars - out, "lone pages": 1})
        return templates
    voters = sorted(distinct.values())
    few = len(voters) < 4
    reference = shapes[sorted(voters, key=lambda i: (shapes[i].size, i))[len(voters) // 2]]
    mapped = [align(reference, s) for s in shapes]
    votes = Counter(r.key for i in voters for r, s in mapped[i] if r.text == s.text)
    sames, templates = [], []
    for shape, pairs in zip(shapes, mapped):
        same = {s.key for r, s in pairs if r.text == s.text and (votes[r.key] == len(voters) or not few and votes[r.key] * 2 > len(voters))}
        _constant(shape, same, few, template := set())
        prose = _prose_in_main(shape, template)
        if prose and 2 * _chars_of(shape, prose) > sum(r.chars for r in _mains(shape, [])):
            template -= prose
        sames.append(same)
        templates.append(template)
    slot = [{s.key: r.key for r, s in pairs} for pairs in mapped]
    left = [shape.chars - _chars_of(shape, template) for shape, template in zip(shapes, templates)]
    if names_decide:
        heaviest = [max((s for s in _noisy(shape, []) if s.weight > 2 * s.links and s.key not in same), key=lambda s: s.weight, default=None)
                    for shape, same in zip(shapes, sames)]
        held = [{s.key: at[s.key]} if s is not None and not chars and s.key in at else {} for s, at, chars in zip(heaviest, slot, left)]
        if spared := _agreed(held, voters, few):
            for shape, at in zip(shapes, slot):
                for s in _noisy(shape, []):
                    if at.get(s.key) in spared:
                        s.node.noise = False
            return induce(trees, decided, names_decide=False)
    held = [{s.key: at[s.key] for s in _link_lists(shape, template, []) if s.key in at and chars >= 3 * s.chars}
            for shape, template, at, chars in zip(shapes, templates, slot, left)]
    lists = _agreed(held, voters, few)
    for i, shape in enumerate(shapes):
        constant = _chars_of(shape, templates[i])
        by_links = {key for key, at in held[i].items() if at in lists}
        templates[i] |= by_links
        linked = _chars_of(shape, templates[i]) - constant
        noise = _noisy(shape, [])
        agreed = sum(s.weight for s in noise if s.key in sames[i])
        menus = sum(s.weight for s in noise if s.key in by_links and s.key not in sames[i])
        count.update({"constant": constant + agreed, "by links": linked + menus, "by names": sum(s.weight for s in noise) - agreed - menus,
                      "kept": shape.chars - constant - linked, "few pages" if few else "aligned pages": 1})
    return templates


def _extract_group(df: pd.DataFrame) -> pd.DataFrame:
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 60 * DEPTH))  # trees are at most DEPTH deep
    df = df.sort_values(["digest", "page_id"], kind="stable")
    pages = {}
    with _uncollected():
        for digest, pressed in zip(df["digest"], df["html"]):
            if digest not in pages:
                pages[digest] = parse(zlib.decompress(pressed).decode("utf-8", "surrogatepass"))
        texts = dict(zip(pages, (extract(tree, template) for tree, template in zip(pages.values(), induce(list(pages.values()))))))
    found = [texts[d] for d in df["digest"]]
    return pd.DataFrame({"page_id": df["page_id"], "url": df["url"], "host": df["host"], "digest": df["digest"], "copied": df["copied"], "text": found, "n_chars": [len(t) for t in found]})


def _pressed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Pages are shuffled compressed."""
    html = pa.array([zlib.compress(t.encode("utf-8", "surrogatepass"), 1) for t in batch.column("html").to_pylist()], pa.binary())
    return batch.set_column(batch.schema.get_field_index("html"), "html", html)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row.

    Of the equal pages of a host one is extracted, and its text is joined to the
    others. The different pages of a host are dealt by a hash into groups of
    about 64, in which their trees are aligned, so a host with any share of all
    pages is spread over many tasks and nothing depends on the order of rows.
    Content is all that varies, in page order, without template nodes and
    without menus, headers, footers, sidebars, notices, adverts, forms, scripts
    and comments. ``article`` and ``main`` only break ties: on a host with one
    page, and for prose that agrees between pages. A null page is empty and
    gives an empty text; a null address is a host of its own; repeated rows
    stay; other columns are not read; an empty table gives no rows. Pages of any
    length are read in one pass; elements nested more than ``DEPTH`` deep are
    flattened with their text in place.
    """
    address = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), text_or_empty(html_col).alias("html"),
                        F.lower(F.regexp_extract(address, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)", 1)).alias("host"))
    rows = rows.withColumn("digest", F.unhex(F.md5("html"))).withColumn("own", F.xxhash64("page_id", "url"))
    page = ["host", "digest"]
    held = stored(rows.groupBy(*page).agg(F.min("own").alias("chosen"), F.count("*").alias("n")), "page-digests")
    hosts = held.groupBy("host").agg(F.ceil(F.count("*") / TOGETHER).cast("long").alias("groups"))
    copied = held.where("n > 1").select(*page, "chosen")
    n_hosts, n_copied = (x.limit(BROADCAST_ROWS + 1).count() for x in (hosts, copied))
    hosts, copied = (F.broadcast(x) if n <= BROADCAST_ROWS else x for x, n in ((hosts, n_hosts), (copied, n_copied)))
    marked = rows.join(copied, page, "left") if n_copied else rows.withColumn("chosen", F.lit(None).cast("long"))
    chosen = marked.where("chosen IS NULL OR own = chosen").withColumn("copied", F.col("chosen").isNotNull()).join(hosts, "host")
    chosen = chosen.select("page_id", "url", "html", *page, "copied", F.pmod(F.xxhash64("digest"), "groups").alias("group"))
    kind = rows.schema["page_id"].dataType.simpleString()
    pressed = map_batches(chosen, _pressed, f"page_id {kind}, url string, html binary, host string, digest binary, copied boolean, `group` bigint")
    # Groups are dealt to shuffle partitions by host and number, as groupBy asks.
    texts = pressed.groupBy("host", "group").applyInPandas(
        _extract_group, f"page_id {kind}, url string, host string, digest binary, copied boolean, text string, n_chars bigint")
    names = ("page_id", "url", "text", "n_chars")
    if not n_copied:
        return texts.select(*names)
    texts = stored(texts, "page-texts")
    copies = marked.where("own <> chosen").select("page_id", "url", *page)
    copies = copies.join(texts.where("copied").dropDuplicates(page).select(*page, "text", "n_chars"), page)
    return texts.select(*names).union(copies.select(*names))
