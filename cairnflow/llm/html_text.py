"""Main text of web pages by composite text density.

Every page becomes a DOM tree. Only what never holds readable text (scripts,
styles, controls, hidden elements) is left out at once. Each node gets its
characters, tags, link characters and link tags, bottom-up, and from these the
composite density: characters per tag, adjusted by the share of links against
the page body. The node whose children's densities have the largest sum is the
core of the article. The densities on its path to the body are the thresholds
for what else belongs to it: below the body, flow text (paragraphs, headings,
lists ...) beside the path and own text of its elements join unless they are
mostly links, containers if they reach the least density on the path; anywhere,
containers join whose own density sum is at least half the core's.

Markup that says what it is counts only within that choice: an ``article`` or
``main`` element around the core, or the densest one inside it, is the article
as a whole; navigation, aside, footer, form and menu elements in it go; an
element with a boilerplate class, id or role (every word of the name must be
one) adds nothing to a sum, does not join, and goes inside the core unless it has
most of its text; where only an id of a section or of flow text says so, which a
heading may have given, it goes inside the core only if it is thinner than half
the core's density or holds marked comments.

Text is decoded, white space inside a block becomes one space, blocks are
joined in page order by one space, and nothing else is dropped or cut.

Edge cases: null or empty html, and pages without text, give an empty text;
unclosed, misnested and cut-off markup is repaired as browsers do for block
elements; pages are read whole, however long or deep; rows with null ids are
kept; repeated rows are all returned; an empty table gives an empty result;
other columns are ignored, whatever they are called.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, bound_batches

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)(>|\Z)""", re.S)
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.S)

# --- fixed values: HTML elements by their role, and words that name boilerplate ---
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
SILENT = frozenset("head script style textarea title xmp iframe noembed noframes noscript template svg canvas object audio video select option datalist button input dialog".split())
BOILERPLATE = frozenset("nav footer aside form menu".split())
BLOCK = frozenset("address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul caption".split())
CLOSES = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
SCOPE = frozenset("ul ol dl table select html body td th div article section main aside nav footer header form blockquote".split())
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising adsbygoogle banner breadcrumb breadcrumbs consent cookie cookies copyright footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promotion recommended related share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split()
)
COMMENTS = frozenset("comment comments disqus discussion replies respond".split())
#: Words that may stand beside a hint in a name without changing what it says.
PARTS = frozenset("area bar block bottom box col column container content fixed form global header holder inner item items left links list module outer page panel posts primary right secondary section site slot small sticky thread top unit wrap wrapper".split())
FLOW = frozenset("p blockquote pre h1 h2 h3 h4 h5 h6 ul ol dl table figure address details".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr picture q rp rt ruby s samp small source span strike strong sub sup time tt u var wbr".split())


class Tree:
    """Nodes in page order: parent, tag, text pieces as (node, text) in page order, and the nodes taken out."""

    def __init__(self, page: str):
        self.parent, self.tag, self.out = [-1], ["html"], [False]
        self.hinted: dict[int, str] = {}  # node -> "tag", "name", "comment" or "slug" (a name that a heading may have given)
        self.pieces: list[tuple[int, str]] = []
        self.end = [0]
        self._parse(page)

    def _open(self, tag: str, up: int) -> int:
        self.parent.append(up)
        self.tag.append(tag)
        self.out.append(False)
        return len(self.tag) - 1

    def _parse(self, page: str) -> None:
        stack = [0]
        at, n = 0, len(page)
        find = _TOKEN.search
        while at < n:
            m = find(page, at)
            if not m:
                self.pieces.append((stack[-1], page[at:]))
                break
            if m.start() > at:
                self.pieces.append((stack[-1], page[at : m.start()]))
            at = m.end()
            tag = m[2]
            if tag is None:
                continue
            tag = tag.lower()
            if m[1]:
                self._close(stack, tag)
                continue
            if not m[4] and at == n:
                break  # a tag cut off at the end of the page
            self._implied(stack, tag)
            if tag in ("html", "body", "head"):
                if tag == "html" or tag == "body" and "body" in self.tag:
                    continue
                stack[:] = [s for s in stack if self.tag[s] != "head"]
            node = self._open(tag, stack[-1])
            self._hint(node, tag, m[3])
            if tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
                at = close.end() if close else n
            elif tag not in VOID and not m[3].endswith("/"):
                stack.append(node)
            elif tag in BLOCK:
                self.pieces.append((node, " "))

    def _implied(self, stack: list[int], tag: str) -> None:
        """End tags that a start tag implies: p before a block, li before li and so on."""
        if tag in BLOCK and tag != "br":
            for k in range(len(stack) - 1, 0, -1):
                t = self.tag[stack[k]]
                if t == "p":
                    del stack[k:]
                    break
                if t in BLOCK:
                    break
        ends = CLOSES.get(tag)
        if ends:
            for k in range(len(stack) - 1, 0, -1):
                t = self.tag[stack[k]]
                if t in ends:
                    del stack[k:]
                    if tag != "tr":
                        break
                elif t in SCOPE:
                    break

    def _close(self, stack: list[int], tag: str) -> None:
        if tag == "br":
            self.pieces.append((stack[-1], " "))
            return
        for k in range(len(stack) - 1, 0, -1):
            t = self.tag[stack[k]]
            if t == tag:
                del stack[k:]
                return
            if t in SCOPE and tag not in BLOCK:
                return  # an inline end tag does not leave its block

    def _hint(self, node: int, tag: str, attrs: str) -> None:
        if tag in SILENT:
            self.out[node] = True
        elif tag in BOILERPLATE or tag == "header":
            self.hinted[node] = "tag"
        if attrs and tag not in ("html", "body"):
            for name, a, b, c in _ATTR.findall(attrs):
                name, value = name.lower(), (a or b or c).lower()
                if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value) or name == "aria-hidden" and value == "true":
                    self.out[node] = True
                elif name == "role" and value in ROLES:
                    self.hinted.setdefault(node, "tag")
                elif name in ("class", "id"):
                    for token in value.split():
                        words = {w for w in re.split(r"[^a-z]+", token) if w}
                        if words and words <= HINTS | COMMENTS | PARTS and not words <= PARTS:
                            slug = name == "id" and (tag == "section" or tag in FLOW)
                            self.hinted[node] = "slug" if slug else "name" if words.isdisjoint(COMMENTS) else "comment"


def densities(tree: Tree, chars: list[int]) -> list[float]:
    """Composite density of each node from its own and its descendants' characters, tags, link characters and link tags."""
    n = len(tree.tag)
    c, t, lc, lt = list(chars), [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for k in range(n):
        in_link[k] = tree.tag[k] in ("a", "button", "select") or k > 0 and in_link[tree.parent[k]]
        if in_link[k]:
            lc[k] = chars[k]
    for k in range(n - 1, 0, -1):
        up = tree.parent[k]
        if tree.out[k]:
            c[k] = t[k] = lc[k] = lt[k] = 0
            continue
        c[up] += c[k]
        lc[up] += lc[k]
        t[up] += t[k] + (tree.tag[k] not in INLINE or in_link[k])  # emphasis and line breaks don't thin a text out
        lt[up] += lt[k] + in_link[k]
    body = c[0] or 1
    page_links = lc[0] / body
    out = [0.0] * n
    for k in range(n):
        if c[k]:
            tags, links, link_tags = t[k] or 1, lc[k] or 1, lt[k] or 1
            base = math.log(c[k] / max(c[k] - lc[k], 1) * lc[k] + page_links * c[k] + math.e)
            ratio = c[k] / links * tags / link_tags
            out[k] = max(0.0, c[k] / tags * (math.log(ratio) / math.log(max(base, 1.0001)) if ratio > 0 else 0.0))
    tree.chars, tree.link_chars = c, lc
    return out


def core_of(tree: Tree, density: list[float]) -> tuple[int, list[float]]:
    """The node with the largest sum of its children's densities, and the sums.

    Inline elements pass theirs on to the element around them. What is marked as boilerplate adds nothing around it and is no core,
    unless most of the page's text is in it.
    """
    n = len(tree.tag)
    total, holder = [0.0] * n, [0] * n  # holder: the nearest node around that is not inline
    off = [False] * n
    for k in range(1, n):
        up = tree.parent[k]
        holder[k] = up if tree.tag[up] not in INLINE else holder[up]
        off[k] = off[up] or tree.out[k] or k in tree.hinted and 2 * tree.chars[k] <= tree.chars[0]
        if not off[k] and tree.tag[k] not in INLINE:
            total[holder[k]] += density[k]
    return max(range(n), key=lambda k: (total[k], -k)), total


def article_of(tree: Tree, core: int, path: list[int]) -> int:
    """The article or main element that the core stands for: one around it, or the one with most text of its own kind inside it."""
    for tag in ("article", "main"):
        around = [k for k in path if tree.tag[k] == tag]
        if around:
            return around[-1]
        inside = [False] * len(tree.tag)
        inside[core] = True
        found = []
        for k in range(core + 1, len(tree.tag)):
            inside[k] = inside[tree.parent[k]]
            if inside[k] and tree.tag[k] == tag and not tree.out[k] and tree.hinted.get(k) != "comment":
                found.append(k)
        if found:
            return max(found, key=lambda k: (tree.chars[k], -k))
    return core


def _pruned(tree: Tree, core: int, density: list[float]) -> list[bool]:
    """What goes out of the subtree of the core: boilerplate elements, thin elements with a boilerplate name, and reader comments."""
    n = len(tree.tag)
    inside, holds, gone = [False] * n, [False] * n, list(tree.out)
    inside[core] = True
    for k in range(n - 1, 0, -1):
        holds[k] = holds[k] or tree.tag[k] == "h1"
        holds[tree.parent[k]] = holds[tree.parent[k]] or holds[k]
    comments = [False] * n  # are marked below
    for k in range(n - 1, 0, -1):
        up = tree.parent[k]
        comments[up] = comments[up] or comments[k] or tree.hinted.get(k) == "comment"
    in_article = [False] * n
    for k in range(1, n):
        up = tree.parent[k]
        inside[k] = inside[k] or inside[up]
        in_article[k] = in_article[up] or tree.tag[up] in ("article", "main")
        kind = tree.hinted.get(k)
        if not kind or not inside[k] or k == core:
            continue
        most = 2 * tree.chars[k] > tree.chars[core]
        thin = 2 * density[k] < density[core]
        if kind == "tag":
            gone[k] = gone[k] or not (tree.tag[k] == "header" and (in_article[k] or holds[k]) or tree.tag[k] == "form" and most)
        elif kind == "slug":
            gone[k] = gone[k] or not most and (thin or comments[k])
        else:
            gone[k] = gone[k] or not most and not holds[k]
    return gone


def main_text(page: str | None) -> str:
    """Main text of one page."""
    if not page:
        return ""
    tree = Tree(page)
    n = len(tree.tag)
    for k in range(1, n):
        tree.out[k] = tree.out[k] or tree.out[tree.parent[k]]
    chars, texts = [0] * n, []
    for node, raw in tree.pieces:
        if tree.out[node]:
            continue
        text = html.unescape(raw) if "&" in raw else raw
        texts.append((node, text))
        chars[node] += len("".join(text.split()))
    density = densities(tree, chars)
    core, total = core_of(tree, density)
    path = [core]
    while path[-1] > 0:
        path.append(tree.parent[path[-1]])
    whole = article_of(tree, core, path)
    if whole != core:
        core, path = whole, [whole]
        while path[-1] > 0:
            path.append(tree.parent[path[-1]])
    gone = _pruned(tree, core, density)
    inner = [k for k in path if k and tree.tag[k] != "body"]  # the path below the body
    least = min((density[k] for k in inner), default=0.0)
    on_path, named = set(path), tree.tag[core] in ("article", "main")
    take = [False] * n
    take[core] = True
    for k in range(1, n):
        up = tree.parent[k]
        if gone[k]:
            continue
        if take[up] and (up not in on_path or up == core):
            take[k] = True
        elif k in on_path:
            take[k] = k == core or not named and tree.tag[k] != "body"  # its own text; its children are judged one by one
        elif up in on_path and up != core and tree.chars[k] and k not in tree.hinted and not named:
            linked = 10 * tree.link_chars[k] >= 3 * tree.chars[k]
            flow = tree.tag[k] in FLOW or tree.tag[k] in INLINE
            take[k] = not linked and up in inner and (flow or density[k] >= least > 0) or not linked and not flow and 2 * total[k] >= total[core] > 0
    pieces = []
    last = None
    block = _blocks(tree)
    for node, text in texts:
        if take[node]:
            if last is not None and block[node] != last:
                pieces.append(" ")
            last = block[node]
            pieces.append(text)
    return " ".join("".join(pieces).split())


def _blocks(tree: Tree) -> list[int]:
    """The block that each node's own text belongs to."""
    out = [0] * len(tree.tag)
    for k in range(1, len(out)):
        out[k] = k if tree.tag[k] in BLOCK else out[tree.parent[k]]
    return out


def _extract(source):
    for cols in batches(source):
        texts = [main_text(x) for x in cols["html"]]
        yield pa.RecordBatch.from_arrays([pa.array(cols["page_id"], pa.int64()), pa.array(cols["url"], pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, url, text, n_chars) of every page; a map over pages without any shuffle."""
    bound_batches(pages.sparkSession)
    own = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return own.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
