"""Main text of web pages by composite text density.

Each node of a page's tree gets a density: its characters for each tag, weighed down the more of them, and of its
tags, are links. The sum of a node's children's densities is largest for the node that holds the article: it has
many dense children. From there the article grows up the path to the body, as long as a node is about as dense as the body
with all its furniture; what it then holds stays unless most of its text is links, because a title or a short section is
never as dense as the nodes around it. Menus, headers, footers, notices, adverts, forms and comments count as empty. A
name that an article's own section may have as well, such as `discussion`, leaves out only what does not read like one,
and no name or form leaves out what holds the article or nearly all of a page. Names of a state, such as
`with-sidebar`, leave out nothing.

A page is one row and is worked on alone, in time in proportion to its length, within Arrow batches.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed values of HTML: elements without end tags, elements that start a block of text, and those whose content
# is not text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
# Fixed values of HTML: open elements that a start tag closes, up to the nearest element that bounds them.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Elements that the end tag of an inline element outside them does not close.
END_BOUNDS = ("table", "article", "body")
P_BOUNDS = frozenset("button table td th caption article section div blockquote body li main".split())

# What is no part of an article, by element, by role, and by words in class or id.
LEFT_OUT = frozenset(
    "aside button dialog footer head iframe menu nav noscript object script select style svg template textarea".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu navigation search".split())
# Words that name furniture and nothing else, alone or before and after a word of DOUBTFUL or a thing on a page.
DOUBTFUL_WORDS = (
    r"(?:advert\w*|sponsor\w*|promo\w*|banner|consent|notices?|modal|subscribe|related|recommend\w*|share|sharing|social"
    r"|navigation|repl(?:y|ies)|discussion|responses|legal|copyright|disclaimer|(?:page|main)-?header)"
)
THINGS = (
    r"(?:posts?|articles?|stor(?:y|ies)|links?|buttons?|btns?|bar|box|lists?|icons?|items?|cards?|news|reads?|videos?|products?|tools"
    r"|thread|form|forms|panel|overlay|dialog|popup|slot|unit|media|networks?|wrapper|wrap|container)"
)
FURNITURE = re.compile(
    r"(?<![a-z])(?:ads?|cookies?|popup|newsletter|sidebar|widgets?|breadcrumbs?|menus?|nav|navbar|footer"
    r"|(?:site|top)-?header|masthead|comments?|commentlist|disqus|paywall|pagination|pager|toolbar"
    rf"|{DOUBTFUL_WORDS}-+(?:{DOUBTFUL_WORDS}|{THINGS})|{THINGS}-+{DOUBTFUL_WORDS})(?![a-z])",
    re.IGNORECASE,
)
# Names of a page's state or layout say what stands elsewhere, such as with-sidebar or comments-open.
STATE = re.compile(
    r"^(?:with|without|no|has|is|show|hide|hides|shows|not)-|-(?:open|opened|closed|on|off|enabled|disabled|allowed|visible|active|layout|true|false)$"
)
COMMENTS = re.compile(r"(?<![a-z])(?:comments?|commentlist|disqus|repl(?:y|ies)|responses)(?![a-z])")
DOUBTFUL = re.compile(rf"(?<![a-z]){DOUBTFUL_WORDS}(?![a-z])", re.IGNORECASE)
# What a doubtful element without headings must have of text besides links, in characters.
LEAST_PROSE = 80
# How much less dense than the whole body the article may be: titles and short sections thin it out.
NEARLY = 0.8
# The share of a page's text besides links that no furniture holds, whatever its name; a form or what holds the
# first heading needs half.
WHOLE_PAGE, HALF_PAGE = 0.9, 0.5
HOLDERS = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe)\b(?:[^>]*)(?:>.*?(?:</(?P=raw)\s*[^>]*>|\Z)|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<more>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<more2>[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.IGNORECASE)


def _mostly_links(chars: float, link_chars: float) -> bool:
    return 2 * link_chars > chars


class _Tree:
    """Nodes in page order; a node's parent comes before it. Texts are (node, text)."""

    def __init__(self, page: str):
        self.tags, self.parents, self.left_out = ["#page"], [-1], [False]
        self.in_holder = [False]
        # Left out by a name, or a form: for sure only when the whole page is known. The second are reader comments.
        self.suspects: set[int] = set()
        self.comments: set[int] = set()
        self.doubtful: set[int] = set()
        self.pieces: list[tuple[int, str | None]] = []  # text None: a block starts or ends here
        self.open = [0]
        self.depths: dict[str, list[int]] = {}  # where in `open` the elements of a name are
        at = 0
        for token in TOKEN.finditer(page):
            if token.start() > at:
                self._text(page[at : token.start()])
            at = token.end()
            name = token["name"] or token["name2"]
            if name is None:
                continue
            if token["end"] or token["end2"]:
                self._end(name.lower())
            else:
                self._start(name.lower(), token["more"] or token["more2"] or "")
        if at < len(page):
            self._text(page[at:])
        if self.suspects:
            self._settle_suspects()
        if self.doubtful:
            self._settle_doubtful()

    def _settle_suspects(self) -> None:
        """Leave out suspects, but none that holds the page's article or nearly all of its text."""
        count = len(self.tags)
        plain, free, in_link, in_suspect, in_comments = [0] * count, 0, [False] * count, [False] * count, [False] * count
        for node in range(1, count):
            up = self.parents[node]
            in_link[node] = in_link[up] or self.tags[node] == "a"
            in_suspect[node] = in_suspect[up] or node in self.suspects
            in_comments[node] = in_comments[up] or node in self.comments
        for node, text in self.pieces:
            if text and not self.left_out[node] and not in_link[node]:
                plain[node] += len(" ".join(text.split()))
        headed = [tag == "h1" for tag in self.tags]
        for node in range(count - 1, 0, -1):
            if not self.left_out[node]:
                up = self.parents[node]
                plain[up] += plain[node]
                headed[up] = headed[up] or headed[node]
        holders = [n for n in range(count) if self.tags[n] in HOLDERS and not self.left_out[n] and n not in self.suspects]
        holders = [n for n in holders if not in_comments[n]] or holders
        kept = set()
        if holders:
            up = max(holders, key=lambda n: (plain[n], -n))
            while up > 0:
                kept.add(up)
                up = self.parents[up]
        for node in range(1, count):
            if self.left_out[self.parents[node]]:
                self.left_out[node] = True
            elif node in self.suspects and node not in kept:
                needed = HALF_PAGE if self.tags[node] == "form" or headed[node] else WHOLE_PAGE
                self.left_out[node] = node in self.comments or plain[node] <= needed * plain[0]

    def _settle_doubtful(self) -> None:
        """Leave out the doubtful elements that are mostly links, and those without headings and with little text."""
        count = len(self.tags)
        chars, link_chars, headed, in_link = [0] * count, [0] * count, [False] * count, [False] * count
        for node in range(1, count):
            in_link[node] = in_link[self.parents[node]] or self.tags[node] == "a"
        for node, text in self.pieces:
            if text and not self.left_out[node]:
                length = len(" ".join(text.split()))
                chars[node] += length
                link_chars[node] += length if in_link[node] else 0
        for node in range(count - 1, 0, -1):
            headed[node] = headed[node] or (self.tags[node] in HEADINGS and chars[node] > 0)
            if node in self.doubtful:
                little = not headed[node] and chars[node] - link_chars[node] < LEAST_PROSE
                self.left_out[node] = self.left_out[node] or little or _mostly_links(chars[node], link_chars[node])
            if not self.left_out[node]:
                up = self.parents[node]
                chars[up] += chars[node]
                link_chars[up] += link_chars[node]
                headed[up] = headed[up] or headed[node]
        for node in range(1, count):
            self.left_out[node] = self.left_out[node] or self.left_out[self.parents[node]]

    def _text(self, text: str) -> None:
        self.pieces.append((self.open[-1], html.unescape(text) if "&" in text else text))

    def _deepest(self, names: Iterable[str]) -> int:
        return max((self.depths[name][-1] for name in names if self.depths.get(name)), default=0)

    def _cut(self, depth: int) -> None:
        for node in self.open[depth:]:
            self.depths[self.tags[node]].pop()
        del self.open[depth:]

    def _close(self, names: set[str] | frozenset[str], bounds: set[str] | frozenset[str]) -> None:
        depth = self._deepest(names)
        if depth > self._deepest(bounds):
            self._cut(depth)

    def _start(self, tag: str, more: str) -> None:
        if tag == "br":
            self._text(" ")
            return
        if tag in BLOCK:
            self._close({"p"}, P_BOUNDS)
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        parent = self.open[-1]
        node = len(self.tags)
        self.tags.append(tag)
        self.parents.append(parent)
        holder = self.in_holder[parent] or tag in HOLDERS
        self.in_holder.append(holder)
        self.left_out.append(self.left_out[parent] or self._is_furniture(tag, more, self.in_holder[parent], node))
        if tag in BLOCK:
            self.pieces.append((node, None))
        if tag not in VOID and not more.endswith("/"):
            self.depths.setdefault(tag, []).append(len(self.open))
            self.open.append(node)

    def _is_furniture(self, tag: str, more: str, in_holder: bool, node: int) -> bool:
        """Whether an element is left out for what it is; by its names, it is a suspect or doubtful only."""
        if tag in LEFT_OUT or (tag == "header" and not in_holder):
            return True
        if tag == "form":
            self.suspects.add(node)
        if not more or tag in ("html", "body", "main"):
            return False
        for name, quoted in ATTRIBUTE.findall(more):
            name, value = name.lower(), quoted.strip("\"'").lower()
            if name in ("class", "id"):
                for word in value.replace("_", "-").split():
                    if STATE.search(word):
                        continue
                    if FURNITURE.search(word):
                        self.suspects.add(node)
                        if COMMENTS.search(word):
                            self.comments.add(node)
                    elif DOUBTFUL.search(word):
                        self.doubtful.add(node)
            elif name == "role":
                if value in ROLES:
                    return True
            elif name == "style":
                if "display:none" in value.replace(" ", ""):
                    return True
            elif name == "hidden" or value == "true":
                return True
        return False

    def _end(self, tag: str) -> None:
        if tag in BLOCK:
            self.pieces.append((self.open[-1], None))
        depth = self._deepest((tag,))
        if depth and (tag in BLOCK or depth > self._deepest(END_BOUNDS)):
            self._cut(depth)


def _density(chars: float, tags: float, link_chars: float, links: float, body_chars: float, body_link_chars: float) -> float:
    """Characters for each tag, times the logarithm of how little of it is links. The logarithm's base grows with
    the links; one is added to it, as it must not be 1."""
    if not chars:
        return 0.0
    plain = max(chars - link_chars, 1.0)
    base = math.log(chars * link_chars / plain + body_link_chars * chars / max(body_chars, 1.0) + math.e) + 1.0
    return chars / tags * math.log(chars / max(link_chars, 1.0) * tags / max(links, 1.0)) / math.log(base)


def _loose(tree: _Tree, on_path: set[int], solid: list[bool], in_link: list[bool]) -> tuple[set[int], set[int]]:
    """Texts and inline nodes right in a node of the path, in runs between blocks, that are not mostly links:
    the numbers of the texts that belong to the path's nodes, and the inline nodes."""
    texts, nodes = set(), set()
    run: list[tuple[int, int, int]] = []  # number, child of the path, length

    def settle() -> None:
        length = sum(n for _, _, n in run)
        if not _mostly_links(length, sum(n for i, _, n in run if in_link[tree.pieces[i][0]])):
            texts.update(i for i, top, _ in run if top in on_path)
            nodes.update(top for _, top, _ in run if top not in on_path)
        run.clear()

    top = [0] * len(tree.tags)
    for node in range(1, len(tree.tags)):
        parent = tree.parents[node]
        top[node] = node if node in on_path or parent in on_path else top[parent]
    at = None
    for number, (node, text) in enumerate(tree.pieces):
        head = top[node]
        holder = head if head in on_path else tree.parents[head]
        if text is None or holder != at or solid[head] and head not in on_path:
            settle()
            at = holder
        if text and holder in on_path and not tree.left_out[node] and (head in on_path or not solid[head]):
            run.append((number, head, len(" ".join(text.split()))))
    settle()
    return texts, nodes


def _diluted(tree: _Tree, body: int) -> list[float]:
    """Each node's density with everything in it that is written, furniture too."""
    count = len(tree.tags)
    chars, link_chars, links, tags = [0] * count, [0] * count, [0] * count, [1] * count
    in_link = [False] * count
    for node in range(1, count):
        in_link[node] = in_link[tree.parents[node]] or tree.tags[node] == "a"
        links[node] = int(tree.tags[node] == "a")
    for node, text in tree.pieces:
        if text:
            length = len(" ".join(text.split()))
            chars[node] += length
            link_chars[node] += length if in_link[node] else 0
    for node in range(count - 1, 0, -1):
        up = tree.parents[node]
        chars[up] += chars[node]
        link_chars[up] += link_chars[node]
        links[up] += links[node]
        tags[up] += tags[node]
    whole = (float(chars[body]), float(link_chars[body]))
    return [_density(chars[n], tags[n], link_chars[n], links[n], *whole) for n in range(count)]


def _title_before(tree: _Tree, holder: int, chars: list[int]) -> set[int]:
    """The last first-level heading before a holder that has none itself."""
    found, inside = None, [False] * len(tree.tags)
    for node in range(1, len(tree.tags)):
        inside[node] = node == holder or inside[tree.parents[node]]
        if tree.tags[node] == "h1" and chars[node] and not tree.left_out[node]:
            if inside[node]:
                return set()
            if node < holder:
                found = node
    return set() if found is None else {found}


def _article(tree: _Tree) -> tuple[set[int], set[int]]:
    """The nodes whose subtrees are the article, and the numbers of the texts beside them that are part of it.

    The threshold is near the body's density with all its furniture, which dilutes it. The article is the highest node
    below the body, on the path from the node of the largest sum, that is so dense, furniture counted; a holder below it
    or itself is taken instead. In the article, all but lists of links stays. Beside it, on the way to the body, headings,
    paragraphs, blocks with one link among text and blocks as dense as the threshold belong to it too.
    """
    count = len(tree.tags)
    chars, own = [0] * count, [0] * count
    link_chars, links, tags = [0] * count, [0] * count, [1] * count
    in_link = [False] * count
    for node in range(1, count):
        in_link[node] = in_link[tree.parents[node]] or tree.tags[node] == "a"
        links[node] = int(tree.tags[node] == "a")
    for node, text in tree.pieces:
        if text and not tree.left_out[node]:
            length = len(" ".join(text.split()))
            own[node] += length
            if in_link[node]:
                link_chars[node] += length
    for node in range(count - 1, -1, -1):
        chars[node] += own[node]
        if node and not tree.left_out[node]:
            up = tree.parents[node]
            chars[up] += chars[node]
            tags[up] += tags[node]
            link_chars[up] += link_chars[node]
            links[up] += links[node]
    body = next((n for n in range(count) if tree.tags[n] == "body"), 0)
    whole = (float(chars[body]), float(link_chars[body]))
    density = [0.0 if tree.left_out[n] else _density(chars[n], tags[n], link_chars[n], links[n], *whole) for n in range(count)]
    total = [_density(own[n], 1, own[n] if in_link[n] else 0, 0, *whole) for n in range(count)]
    for node in range(1, count):
        total[tree.parents[node]] += density[node]
    best = max(range(count), key=lambda n: (total[n], -n))
    if not chars[best]:
        return set(), set()
    path = [best]
    while path[-1] not in (body, 0):
        path.append(tree.parents[path[-1]])
    diluted = _diluted(tree, body)
    threshold = NEARLY * diluted[body]
    dense = [n for n in path if n != body and diluted[n] >= threshold]
    # Where nothing on the path is so dense, the body's furniture is as dense as the article: all of it is looked at.
    top_place = path.index(dense[-1] if dense else path[-1])
    holder = next((n for n in reversed(path[: top_place + 1]) if tree.tags[n] in HOLDERS), None)
    if holder is not None:
        return {holder, *_title_before(tree, holder, chars)}, set()
    place = {node: n for n, node in enumerate(path)}
    on_path = set(path[1:])
    solid = [tag in BLOCK for tag in tree.tags]
    for node in range(count - 1, 0, -1):
        if solid[node]:
            solid[tree.parents[node]] = True
    texts, roots = _loose(tree, on_path, [s or n == best for n, s in enumerate(solid)], in_link)
    roots.add(best)
    # Blocks that are mostly links and stand beside the path: what they hold is looked at by itself.
    link_lists = set()
    for node in range(1, count):
        up = tree.parents[node]
        if node in on_path or node == best or not chars[node] or not solid[node]:
            continue
        if up in on_path:
            bare = chars[node] == link_chars[node]
            one = links[node] == 1 and not bare or tree.tags[node] in HEADINGS or tree.tags[node] == "p" and not links[node]
            inside = place[up] <= top_place
            if one or density[node] >= threshold or inside and not _mostly_links(chars[node], link_chars[node]):
                roots.add(node)
            else:
                link_lists.add(node)
        elif up in link_lists and tree.tags[node] not in HEADINGS:
            (link_lists if _mostly_links(chars[node], link_chars[node]) else roots).add(node)
    return roots, texts


def main_text(page: str) -> str:
    """The article of a page: its blocks in page order, one line each."""
    tree = _Tree(page)
    roots, texts = _article(tree)
    if not roots:
        return ""
    inside = [False] * len(tree.tags)
    for node in range(len(tree.tags)):
        inside[node] = not tree.left_out[node] and (node in roots or (node > 0 and inside[tree.parents[node]]))
    blocks, current = [], []
    for number, (node, text) in enumerate(tree.pieces):
        if text is None:
            blocks.append("".join(current))
            current = []
        elif inside[node] or number in texts:
            current.append(text)
    blocks.append("".join(current))
    return "\n".join(filter(None, (" ".join(block.split()) for block in blocks)))


@F.pandas_udf(StringType())
def _main_texts(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield batch.map(lambda page: main_text(page) if page else "")


def extract(pages: DataFrame, html_column: str | Column = "html") -> DataFrame:
    """`pages` with `text`, its main text, in place of any column of that name; its other columns stay.

    A null or empty page has an empty text, and so has one of furniture only. Rows may repeat.
    """
    return pages.withColumn("text", _main_texts(html_column))
