"""A tolerant reader of HTML into trees of blocks, and simple tree matching between two of them."""

from __future__ import annotations

import html
import re
import sys
from collections import Counter
from collections.abc import Set
from dataclasses import dataclass, field

import numpy as np

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
#: Markup of its own, where a slash closes an element; the text of math counts, that of svg does not.
FOREIGN = frozenset(("svg", "math"))
#: A start tag of these ends open foreign markup, unless it lies where that holds HTML.
_BREAKS_OUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
    "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var article main section".split()
)
_HOLDS_HTML = frozenset(("foreignobject", "desc", "annotation-xml"))
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr img map object picture audio video canvas meter progress output".split()
)
#: Elements that are never part of the main text.
APART = frozenset(
    "nav header footer aside form menu dialog button select option input fieldset legend label datalist "
    "head object embed canvas audio video map svg annotation annotation-xml".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form toolbar".split()
)
#: Words of class and id that mark what surrounds a text.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial adslot adsbygoogle banner sponsor sponsored promo "
    "promotion cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe "
    "subscription signup login paywall nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar "
    "rail footer header masthead topbar comment comments disqus replies reply share sharing social related "
    "recommended recommendations teaser teasers widget toolbar skip hidden".split()
)
#: Beside one of these in a name, a mark says something of a text, not what the element is.
NO_MARKS = frozenset(
    "has have no not non with without of for to and the is are open opened closed enabled disabled on off".split()
)
#: Marks of what may hold articles that are not the page's own.
LISTS = frozenset(
    "comment comments disqus replies reply related recommended recommendations teaser teasers promo widget".split()
)
MAIN = frozenset(("article", "main"))
#: A start tag of these ends an open paragraph; li, dt, dd, tr, td, th and option also end their own kind.
_ENDS_OWN = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
             "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "p": ("p",)}
_SCOPE = frozenset("ul ol dl table tbody thead tfoot div section article main body td th blockquote".split())

_TAG = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[A-Za-z]+")
TEXT = "#"
#: Differing siblings whose table is kept whole; longer lists are halved where a best mapping
#: passes, so that memory stays linear.
SIBLINGS = 500
#: Weights of siblings kept at once while rows of a long list are computed.
KEPT_WEIGHTS = 4_000_000


@dataclass
class Page:
    """Nodes in page order: depth, label, the text of text nodes, whether it belongs to the main text."""

    depth: list[int] = field(default_factory=list)
    label: list[str] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    main: list[bool] = field(default_factory=list)

    def add(self, depth: int, label: str, text: str, main: bool) -> None:
        self.depth.append(depth)
        self.label.append(label)
        self.text.append(text)
        self.main.append(main)


def _is_apart(tag: str, attributes: dict[str, str], in_main: bool) -> bool:
    """Whether HTML itself sets the element apart."""
    if tag == "header" and in_main:
        return False  # the head of the article itself holds its title
    if tag in APART or tag in RAW:
        return True
    if not attributes:
        return False
    if attributes.get("role", "").lower() in ROLES or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    return "display:none" in attributes.get("style", "").replace(" ", "").lower()


def _marks(tag: str, attributes: dict[str, str], in_main: bool) -> set[str]:
    """Words of class and id that set the element apart; none on the page or an article as a whole."""
    if not attributes or tag in ("html", "body") or tag in MAIN or attributes.get("role") == "main":
        return set()
    if tag == "header" and in_main:
        return set()
    out: set[str] = set()
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        # Words of camelCase, kebab-case and snake_case names.
        words = {w.lower() for w in _WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name))}
        if words.isdisjoint(NO_MARKS):
            out |= words & MARKS
    return out


def read_page(source: str) -> Page:
    """The page's blocks. White space in a text is one space; character references are decoded.

    A mark on an element that holds an article or main element does not set it
    apart. One of LISTS does, unless all of the page's articles lie in such ones.
    """
    page, has_main, chains = _read(source, frozenset())
    forgiven = {at for chain in chains if not any(listed for _, listed in chain) for at, _ in chain}
    if not forgiven and not has_main:
        forgiven = {at for chain in chains for at, _ in chain}
    return _read(source, forgiven)[0] if forgiven else page


def _read(source: str, forgiven: Set[int]) -> tuple[Page, bool, list[list[tuple[int, bool]]]]:
    """The page, whether it has an article outside marked elements, and what encloses the others.

    That is, per article in marked elements, their (place, whether of LISTS); the
    marks at the places in ``forgiven`` do not count.
    """
    page = Page()
    # Open elements: tag, is a block, lies apart, lies in an article or main element,
    # place and kind of its mark if only that sets it apart, lies in foreign markup.
    stack: list[tuple[str, bool, bool, bool, tuple[int, bool] | None, bool]] = []
    chains: list[list[tuple[int, bool]]] = []
    unclosed: set[str] = set()
    opened: Counter[str] = Counter()  # open elements by tag, so that none is looked for in vain
    pieces: list[str] = []
    depth = 0
    has_main = False

    def flush() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                page.add(depth, TEXT, text, bool(stack) and stack[-1][3])

    def close_to(index: int) -> None:
        nonlocal depth
        if any(block for _, block, *_ in stack[index:]):
            flush()
        while len(stack) > index:
            tag, block, *_ = stack.pop()
            opened[tag] -= 1
            depth -= block

    def close_nearest(tags: tuple[str, ...]) -> None:
        if not any(opened[t] for t in tags):
            return
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in tags:
                close_to(k)
                return
            if stack[k][0] in _SCOPE and stack[k][0] not in tags:
                return

    at, size = 0, len(source)
    while at < size:
        found = _TAG.search(source, at)
        end = found.start() if found else size
        apart = bool(stack) and stack[-1][2]
        if end > at and not apart:
            pieces.append(source[at:end])
        if not found:
            break
        start, at = found.start(), found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue  # a comment or declaration
        if found[1] or found[4]:  # an end tag
            if tag == "br":
                flush()
            if not opened[tag]:
                continue
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    close_to(k)
                    break
            continue
        if stack and stack[-1][5] and tag in _BREAKS_OUT:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in _HOLDS_HTML:
                    break
                if stack[k][0] in FOREIGN and not (k and stack[k - 1][5]):
                    close_to(k)
                    break
        foreign = tag in FOREIGN or bool(stack) and stack[-1][5]
        if tag in ("br", "hr") and not foreign:
            flush()
        if tag in VOID:
            continue
        raw_attributes = found[3] if found[2] else found[6]
        if foreign and raw_attributes.endswith("/"):
            continue
        attributes = {}
        if raw_attributes and "=" in raw_attributes or raw_attributes and "hidden" in raw_attributes:
            attributes = {
                m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw_attributes)
            }
        block = tag not in INLINE and not foreign
        if block:
            close_nearest(("p",))
            if tag in _ENDS_OWN and tag != "p":
                close_nearest(_ENDS_OWN[tag])
            flush()
        in_main = bool(stack) and stack[-1][3]
        apart = bool(stack) and stack[-1][2]
        if tag in RAW:
            # Its text is no markup: go on behind its end tag.
            stop = None
            if tag not in unclosed:
                stop = re.compile(rf"</{re.escape(tag)}\s*[^>]*>", re.I).search(source, at)
            if stop:
                at = stop.end()
            elif tag in ("script", "style"):
                at = size
            else:  # never closed: what follows is the page
                unclosed.add(tag)
            continue
        own_apart, mark = apart or _is_apart(tag, attributes, in_main), None
        if not own_apart and start not in forgiven or apart and stack[-1][4]:
            # Within a marked element, whether something else sets this one apart too.
            words = _marks(tag, attributes, in_main)
            if not apart or not _is_apart(tag, attributes, in_main):
                mark = (start, not words.isdisjoint(LISTS)) if words else (-1, False) if apart else None
            own_apart = apart or bool(words)
        if not block and own_apart and not apart and tag != "svg":
            pieces.append(" ")
        is_main = tag in MAIN or attributes.get("role") == "main"
        if is_main and mark:
            chains.append([m for *_, m, _ in stack if m and m[0] >= 0])
        own_main = (in_main or is_main) and not own_apart
        has_main = has_main or own_main
        if block:
            kind = attributes.get("class", "")
            page.add(depth, f"{tag}.{kind}" if kind else tag, "", own_main)
            depth += 1
        stack.append((tag, block, own_apart, own_main, mark, foreign))
        opened[tag] += 1
    flush()
    if not has_main:  # no article element: everything that does not lie apart
        page.main = [True] * len(page.main)
    return page, has_main, chains


def children_of(depth: list[int]) -> list[list[int]]:
    """Children of every node, and of the root at the end."""
    out: list[list[int]] = [[] for _ in range(len(depth) + 1)]
    open_nodes: list[int] = []
    for k, d in enumerate(depth):
        del open_nodes[d:]
        out[open_nodes[-1] if open_nodes else len(depth)].append(k)
        open_nodes.append(k)
    return out


class Matching:
    """Simple tree matching: the largest order-preserving mapping of equal labels, top down."""

    def __init__(self, a_depth: list[int], a_label: list[str], b_depth: list[int], b_label: list[str]):
        self.a, self.b = children_of(a_depth), children_of(b_depth)
        self.a_label, self.b_label = a_label, b_label
        ids: dict[tuple, int] = {}
        self.a_shape = self._shapes(self.a, a_label, ids)
        self.b_shape = self._shapes(self.b, b_label, ids)
        self.a_size, self.b_size = self._sizes(self.a), self._sizes(self.b)
        deepest = max([0, *a_depth, *b_depth])
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 8 * deepest + 1000))

    @staticmethod
    def _shapes(children, label, ids) -> list[int]:
        """Equal numbers for equal subtrees of both pages."""
        out = [0] * len(label)
        for k in range(len(label) - 1, -1, -1):
            key = (label[k], *(out[c] for c in children[k]))
            out[k] = ids.setdefault(key, len(ids))
        return out

    @staticmethod
    def _sizes(children) -> list[int]:
        out = [1] * len(children)
        for k in range(len(children) - 2, -1, -1):
            out[k] += sum(out[c] for c in children[k])
        return out

    def pairs(self) -> list[tuple[int, int]]:
        """Matched (node of a, node of b)."""
        found: list[tuple[int, int]] = []
        self._match(self.a[-1], self.b[-1], found)
        return found

    def _match(self, left: list[int], right: list[int], found: list | None) -> int:
        """Weight of the best mapping of two lists of siblings; its pairs go to ``found``."""
        total, start = 0, 0
        stop_l, stop_r = len(left), len(right)
        # Equal subtrees at either end are matched whole: no mapping can gain more from them.
        while start < min(stop_l, stop_r) and self.a_shape[left[start]] == self.b_shape[right[start]]:
            total += self._whole(left[start], right[start], found)
            start += 1
        while stop_l > start and stop_r > start and self.a_shape[left[stop_l - 1]] == self.b_shape[right[stop_r - 1]]:
            stop_l, stop_r = stop_l - 1, stop_r - 1
            total += self._whole(left[stop_l], right[stop_r], found)
        left, right = left[start:stop_l], right[start:stop_r]
        if not left or not right:
            return total
        if len(left) > 1 and max(len(left), len(right)) > SIBLINGS:
            if found is None:
                return total + int(self._last_row(left, right)[-1])
            half = len(left) // 2
            before = self._last_row(left[:half], right)
            behind = self._last_row(left[half:][::-1], right[::-1])[::-1]
            at = int(np.argmax(before + behind))
            self._match(left[:half], right[:at], found)
            self._match(left[half:], right[at:], found)
            return total + int(before[at] + behind[at])
        weight: dict[tuple[int, int], int] = {}
        best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
        for i, x in enumerate(left):
            row, above = best[i + 1], best[i]
            for j, y in enumerate(right):
                w = 0
                if self.a_label[x] == self.b_label[y]:
                    w = weight[i, j] = self._weight(x, y)
                row[j + 1] = max(above[j + 1], row[j], above[j] + w)
        if found is not None:
            i, j = len(left), len(right)
            while i and j:
                w = weight.get((i - 1, j - 1), 0)
                if w and best[i][j] == best[i - 1][j - 1] + w:
                    i, j = i - 1, j - 1
                    found.append((left[i], right[j]))
                    self._match(self.a[left[i]], self.b[right[j]], found)
                elif best[i][j] == best[i - 1][j]:
                    i -= 1
                else:
                    j -= 1
        return total + best[-1][-1]

    def _last_row(self, left: list[int], right: list[int]) -> np.ndarray:
        """Weight of the best mapping of ``left`` and every beginning of ``right``."""
        _, first, kind = np.unique([self.b_shape[y] for y in right], return_index=True, return_inverse=True)
        of_label: dict[str, list[int]] = {}
        for k, at in enumerate(first.tolist()):
            of_label.setdefault(self.b_label[right[at]], []).append(k)
        kept: dict[int, np.ndarray] = {}
        best = np.zeros(len(right) + 1, np.int64)
        for x in left:
            weights = kept.get(self.a_shape[x])
            if weights is None:
                weights = np.zeros(len(first), np.int64)
                for k in of_label.get(self.a_label[x], ()):
                    weights[k] = self._weight(x, right[first[k]])
                if len(kept) * len(first) < KEPT_WEIGHTS:
                    kept[self.a_shape[x]] = weights
            row = best.copy()
            np.maximum(row[1:], best[:-1] + weights[kind], out=row[1:])
            best = np.maximum.accumulate(row)
        return best

    def _weight(self, x: int, y: int) -> int:
        if self.a_shape[x] == self.b_shape[y]:
            return self.a_size[x]
        return 1 + self._match(self.a[x], self.b[y], None)

    def _whole(self, x: int, y: int, found: list | None) -> int:
        if found is not None:
            found += [(x + k, y + k) for k in range(self.a_size[x])]
        return self.a_size[x]
