"""Main text of web pages by composite text density.

A page becomes a tree of elements (unclosed, misplaced and cut-off tags are
mended as browsers do). What is never article text goes first: scripts,
styles, forms, menus, page headers and footers, sidebars, notices, adverts and
reader comments, told by element, role, class or id, and lists of links. Every
other node gets its composite density: characters per tag, times a logarithm
that falls as the share of characters and tags in links rises against that of
the page. Then the sums of the children's densities are compared:

* the scope is the page's ``article`` or ``main`` with the most text, or the body;
* the subtree with the largest sum is content, whole;
* the threshold is the least density on the path from the scope down to that
  subtree; beside the path, the largest-sum subtree of any node that reaches
  the threshold, and ``SHARE`` of the largest sum, is content too;
* between pieces of content under one parent, and everywhere in an explicit
  article, blocks that are mostly not links belong to it, and so does the
  heading before the first piece.

A block is the text between two starts or ends of block elements; its white
space becomes single spaces, ``br`` and table cells included. Blocks are joined
in page order by a blank line. Character references are decoded.

Null and empty pages have an empty text. Repeated rows and ids each give their
row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memberlens.llm.common import pieces

#: A later subtree must have this part of the largest sum to count as content.
SHARE = 0.1

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes plaintext script style textarea title xmp".split())
HEAD = frozenset("base link meta noscript script style template title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = HEADINGS | frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form header "
    "hgroup hr li main menu nav ol p pre search section summary table ul".split())
BLOCKS = CLOSES_P | frozenset("body caption html legend optgroup option tbody tfoot thead tr".split())
CELLS = frozenset("td th".split())
WALLS = frozenset("button caption marquee object table td template th".split())
#: By the start tag: the open elements that it ends, and those that it does not look past.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "option": ({"option"}, {"select"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
           "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
           "thead": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot"}, {"table"})}

# Elements, roles and words of class or id that mark what is not the article.
NEVER = RAW | frozenset("aside audio button canvas dialog embed footer head input map menu nav noscript object search select "
                        "svg template video".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search tablist "
                  "toolbar".split())
HEADER_WORDS = frozenset("header masthead topbar".split())
COMMENT_WORDS = frozenset("comment commentlist comments commentsection discussion disqus replies reply respond".split())
ADVERT_WORDS = frozenset("ad adbox ads adsense adslot adunit advert advertisement advertisements advertising adverts adwrap "
                         "outbrain sponsor sponsored sponsors taboola".split())
OTHER_WORDS = frozenset(
    "alert announcement banner breadcrumb breadcrumbs colophon consent cookie cookiebar cookies copyright footer gdpr "
    "interstitial lightbox login masthead menu menubar modal nav navbar navigation newsletter notice notices notification "
    "overlay pager pagination paywall popup privacy promo promotion rail recommendations recommended related search "
    "searchbox searchform share sharing sidebar signin signup skip social subscribe subscription toc toolbar trending widget "
    "widgets".split())
NOT_MARKING = frozenset("has is no non with without".split())

TOKEN = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))"""
                   r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+)(?:>|\Z)"""
                   r"""|<(?:[!?]|/(?=[^a-zA-Z]))[^>]*(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
MARKED = re.compile(r"class|id\s*=|role|hidden|style|itemprop", re.I)
HIDDEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
WORD = re.compile(r"[a-z0-9]+")


class Page:
    """The elements of a page as lists by number; an element comes after its parent."""

    def __init__(self, source: str):
        self.name, self.parent, self.marks = ["body"], [-1], [""]
        self.texts: list[tuple[int, int, bool, str]] = []  # element, block, in a link, text
        self._stack, self._block = [0], 0
        self._at: dict[str, list[int]] = {"body": [0]}  # by name: the depths of the open elements
        self._solid = [0]  # the depths of the open blocks
        self._links: list[int] = []  # open links
        self._read(source)

    def _push(self, name: str, marks: str) -> None:
        self.name.append(name)
        self.parent.append(self._stack[-1])
        self.marks.append(marks)
        if name not in VOID:
            self._at.setdefault(name, []).append(len(self._stack))
            if name in BLOCKS or name in WALLS:
                self._solid.append(len(self._stack))
            self._stack.append(len(self.name) - 1)
            if name == "a":
                self._links.append(self._stack[-1])

    def _pop(self) -> None:
        node = self._stack.pop()
        self._at[self.name[node]].pop()
        if self._solid[-1] == len(self._stack):
            self._solid.pop()
        if self._links and self._links[-1] == node:
            self._links.pop()

    def _depth(self, names) -> int:
        """The depth of the innermost open element of ``names``; 0 if there is none."""
        return max((self._at[n][-1] for n in names if self._at.get(n)), default=0)

    def _end(self, names, wall: int) -> None:
        """Close the innermost open element of ``names`` and all in it, unless it is not deeper than ``wall``."""
        depth = self._depth(names)
        while depth > wall and len(self._stack) > depth:
            self._pop()

    def _end_link(self) -> None:
        """A link ends; if elements in it go on, their text is no longer in it."""
        if self._links:
            if self._stack[-1] == self._links[-1]:
                self._pop()
            else:
                self._links.pop()

    def _start(self, name: str, marks: str) -> None:
        if name in ("html", "body"):
            self._end(("head",), 0)
            return
        if name not in HEAD:
            self._end(("head",), 0)
        if name in CLOSES_P:
            self._end(("p",), self._depth(WALLS))
        if name in IMPLIED:
            ends, walls = IMPLIED[name]
            self._end(ends, self._depth(walls))
        if name == "a":
            self._end_link()
        if name in HEADINGS and self.name[self._stack[-1]] in HEADINGS:
            self._pop()
        self._push(name, marks)

    def _close(self, name: str) -> None:
        if name in ("html", "body"):
            return
        if name == "a":
            self._end_link()
        elif name in HEADINGS:
            self._end(HEADINGS, self._depth(WALLS))
        elif name in BLOCKS or name in WALLS:
            self._end((name,), 0 if name in WALLS else self._depth(WALLS))
        else:  # never across the start of a block
            self._end((name,), self._solid[-1])

    def _text(self, text: str) -> None:
        if text:
            if not text.isspace():
                self._end(("head",), 0)
            self.texts.append((self._stack[-1], self._block, bool(self._links), html.unescape(text)))

    def _read(self, source: str) -> None:
        at = 0
        while True:
            found = TOKEN.search(source, at)
            if found is None:
                self._text(source[at:])
                return
            self._text(source[at:found.start()])
            at = found.end()
            if not found.group(2):
                continue
            name = found.group(2).lower()
            if name in BLOCKS:
                self._block += 1
            elif name == "br" or name in CELLS:
                self.texts.append((self._stack[-1], self._block, False, " "))
            if found.group(1):
                self._close(name)
                continue
            raw = found.group(3)
            self._start(name, raw if MARKED.search(raw) else "")
            if name in RAW:  # its content is no markup and no text of the page
                until = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
                at = until.end() if until and name != "plaintext" else len(source)
                self._end((name,), 0)


def _kind(name: str, marks: str) -> str:
    """Why an element is not article text: ``never``, ``header``, ``comment``, ``advert``, ``other``, or nothing."""
    if name in NEVER:
        return "never"
    if name in ("header", "form"):
        return "header" if name == "header" else "other"
    if not marks:
        return ""
    words: list[str] = []
    for key, *values in ATTRIBUTE.findall(marks):
        key, value = key.lower(), next((v for v in values if v), "")
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and HIDDEN.search(value)):
            return "never"
        if key == "role" and value.lower() in ROLES:
            return "other"
        if key in ("class", "id"):
            for part in html.unescape(value).split():
                found = WORD.findall(CAMEL.sub("-", part).lower())
                words += [w for k, w in enumerate(found) if not k or found[k - 1] not in NOT_MARKING]
                words += [""]
    own = set(words)
    if own & COMMENT_WORDS:
        return "comment"
    if own & ADVERT_WORDS:
        return "advert"
    if own & OTHER_WORDS:
        return "other"
    return "header" if own & HEADER_WORDS else ""


def _pruned(page: Page) -> list[bool]:
    """Whether each element is, or lies in, what is not the article."""
    n = len(page.name)
    kind = [""] * n
    for i in range(1, n):
        kind[i] = _kind(page.name[i], page.marks[i])
        # The article itself may be marked for what stands next to it.
        if page.name[i] in ("article", "main") and kind[i] not in ("never", "comment", "advert"):
            kind[i] = ""
    in_comment = [False] * n
    for i in range(1, n):
        in_comment[i] = in_comment[page.parent[i]] or kind[i] in ("never", "comment", "advert")
    article, title, paragraphs = [False] * n, [False] * n, [0] * n
    for node, _, _, text in page.texts:
        if page.name[node] == "p":
            paragraphs[node] += len(text)
    for i in range(n - 1, 0, -1):
        if not in_comment[i]:
            article[i] |= page.name[i] in ("article", "main")
            title[i] |= page.name[i] == "h1"
            up = page.parent[i]
            article[up] |= article[i]
            title[up] |= title[i]
        paragraphs[page.parent[i]] += paragraphs[i]
    gone, inside, only = [False] * n, [False] * n, [True] * n
    for i in range(1, n):
        up = page.parent[i]
        if ((kind[i] == "header" and article[i]) or (kind[i] == "other" and (article[i] or title[i]))
                or (page.name[i] == "form" and 2 * paragraphs[i] > paragraphs[0])):
            kind[i] = ""  # it wraps the article
        inside[i] = inside[up] or page.name[i] in ("article", "main")
        only[i] = only[up] and kind[i] in ("", "header")
        # Headings in the header of an article are its own.
        gone[i] = (gone[up] or kind[i] != "") and not (page.name[i] in HEADINGS and not kind[i] and inside[i] and only[i])
    return gone


class _Sums:
    """Of every kept element's subtree: characters, tags, those in links, density and the children's sum."""

    def __init__(self, page: Page, gone: list[bool]):
        n = len(page.name)
        self.chars, self.tags, self.link_chars, self.link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        own, all_chars, all_links = [0] * n, 0, 0
        for node, _, link, text in page.texts:
            size = len("".join(text.split()))
            if page.name[node] not in RAW:
                all_chars += size
                all_links += size * link
            if not gone[node]:
                self.chars[node] += size
                self.link_chars[node] += size * link
                own[node] += size * (not link)
        for i in range(n - 1, 0, -1):
            if not gone[i]:
                up = page.parent[i]
                self.tags[up] += self.tags[i] + 1
                self.link_tags[i] += page.name[i] == "a"
                for of in (self.chars, self.link_chars, self.link_tags):
                    of[up] += of[i]
        ratio = all_links / all_chars if all_chars else 0.0
        self.density = [_density(c, t, lc, lt, ratio) for c, t, lc, lt in
                        zip(self.chars, self.tags, self.link_chars, self.link_tags)]
        self.sum = [0.0] * n
        for i in range(n):
            if own[i] and (page.name[i] not in CLOSES_P or page.name[i] in ("article", "div", "main", "section")):
                self.sum[i] += _density(own[i], 1, 0, 0, ratio)  # text right in a container
        for i in range(n - 1, 0, -1):
            if not gone[i]:
                self.sum[page.parent[i]] += self.density[i]

    def linked(self, i: int) -> bool:
        """Mostly links."""
        return 2 * self.link_chars[i] > self.chars[i]


def _density(chars: int, tags: int, link_chars: int, link_tags: int, ratio: float) -> float:
    """Characters per tag, adjusted by links; ``ratio`` is the page's share of characters in links."""
    tags = max(tags, 1)
    if not chars or not ratio:
        return chars / tags
    base = math.log(chars / max(chars - link_chars, 1) * link_chars + ratio * chars + math.e)
    rest = chars / max(link_chars, 1) * tags / max(link_tags, 1)
    return max(0.0, chars / tags * math.log(rest) / math.log(base)) if rest > 1 else 0.0


def _link_lists(page: Page, gone: list[bool], sums: _Sums) -> bool:
    """Drop lists and groups of three links or more with hardly any text beside them."""
    found = False
    for i in range(1, len(page.name)):
        if gone[page.parent[i]] and not gone[i] and page.name[i] not in HEADINGS:
            gone[i] = True
        elif not gone[i] and sums.link_tags[i] >= 3 and 5 * sums.link_chars[i] > 4 * sums.chars[i] and page.name[i] != "a":
            gone[i] = found = True
    return found


def _content(page: Page, gone: list[bool], sums: _Sums) -> tuple[list[int], int, bool]:
    """The roots of the content, the scope, and whether an element names that as the article."""
    n = len(page.name)
    named = [i for i in range(1, n) if not gone[i] and page.name[i] in ("article", "main")
             and sums.chars[i] > sums.link_chars[i]]
    scope = max(named, key=lambda i: (sums.chars[i] - sums.link_chars[i], page.name[i] == "article"), default=0)
    inner = [i for i in named if page.name[i] == "article" and i > scope and 2 * sums.chars[i] >= sums.chars[scope]]
    scope = inner[-1] if inner else scope
    in_scope = [False] * n
    in_scope[scope] = True
    for i in range(scope + 1, n):
        in_scope[i] = not gone[i] and in_scope[page.parent[i]]
    best = max((i for i in range(scope, n) if in_scope[i]), key=lambda i: (sums.sum[i], -i))
    path, i = {best}, best
    while i != scope:
        i = page.parent[i]
        path.add(i)
    threshold = min(sums.density[i] for i in path)
    top = list(range(n))  # the largest sum in each subtree, the outer of equals
    for i in range(n - 1, scope, -1):
        if in_scope[i] and sums.sum[top[i]] > sums.sum[top[page.parent[i]]]:
            top[page.parent[i]] = top[i]
    roots, done = [best], [False] * n
    for i in range(scope, n):
        if not in_scope[i]:
            continue
        done[i] = done[i] or i == best or (i != scope and done[page.parent[i]])
        if i in path or done[i]:
            continue
        if (sums.density[i] >= threshold and not sums.linked(i)
                and max(sums.sum[top[i]], sums.density[i]) >= SHARE * sums.sum[best]):
            roots.append(top[i])
            done[i] = True
    return roots, scope, scope > 0


def main_text(source: str | None) -> str:
    """The article of a page."""
    if not source:
        return ""
    page = Page(source)
    gone = _pruned(page)
    sums = _Sums(page, gone)
    if _link_lists(page, gone, sums):
        sums = _Sums(page, gone)
    if not sums.chars[0]:
        return ""
    roots, scope, explicit = _content(page, gone, sums)
    common = scope if explicit else _joint(page, roots)
    n = len(page.name)
    chosen, under, within, block_of = [False] * n, [False] * n, [False] * n, [0] * n
    for r in roots:
        chosen[r] = True
    for i in range(n):
        up = max(page.parent[i], 0)
        chosen[i] = chosen[i] or chosen[up]
        under[i] = i == scope or under[up]
        within[i] = i == common or within[up]
        block_of[i] = i if page.name[i] in BLOCKS else block_of[up]
    blocks: dict[int, list[tuple[int, bool, str]]] = {}
    for node, block, link, text in page.texts:
        if under[node] and not gone[node]:
            blocks.setdefault(block, []).append((node, link, text))
    made = []  # text, in the content, mostly links, within the common element, name of the block's element
    for parts in blocks.values():
        text = " ".join("".join(t for _, _, t in parts).split())
        if text:
            solid = [(node, link, t) for node, link, t in parts if not t.isspace()]
            links = sum(len(t) for _, link, t in solid if link)
            made.append((text, any(chosen[node] for node, _, _ in solid), 2 * links > sum(len(t) for _, _, t in solid),
                         within[solid[0][0]], page.name[block_of[solid[0][0]]]))
    at = [k for k, m in enumerate(made) if m[1]]
    if not at:
        return ""
    everywhere = explicit or common != scope
    keep = [m[1] or (not m[2] and m[3] and (everywhere or at[0] < k < at[-1])) for k, m in enumerate(made)]
    first = keep.index(True)
    if not any(m[4] == "h1" for m, k in zip(made, keep) if k):
        before = [k for k in range(first) if made[k][4] == "h1"]
        if not before and first and made[first - 1][4] in HEADINGS:
            before = [first - 1]
        if before:
            keep[before[-1]] = True
    return "\n\n".join(m[0] for m, k in zip(made, keep) if k)


def _joint(page: Page, roots: list[int]) -> int:
    """The innermost element that holds all of them."""
    joint = roots[0]
    for r in roots[1:]:
        while joint != r:  # a parent has the smaller number
            if joint > r:
                joint = page.parent[joint]
            else:
                r = page.parent[r]
    return joint


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "html"):
        texts = [main_text(source) for source in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            ["id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row: the page's main text and its number of code points."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    kind = rows.schema["id"].dataType.simpleString()
    made = rows.mapInArrow(_extracted, f"id {kind}, url string, text string, n_chars long")
    return made.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
