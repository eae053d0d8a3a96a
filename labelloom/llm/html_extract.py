"""Main text of web pages by wrapper induction over the pages of a host.

1. Every page is parsed into a tree. Neighbouring siblings of one kind (tag, class, id, role) that repeat are
   one node that repeats, so a tree is as large as its layout, not as its text.
2. The trees of a host are aligned by simple tree matching and merged: aligned nodes become one node of the
   wrapper, all others are added beside them. A node keeps the number of pages that have it, whether its
   text was the same on all of them, and how much of its text is in links. Merging is associative, so every
   task merges the pages it has and the wrappers of a host are merged in two further steps: all pages of a
   host count, and a host with most of the pages is no burden for a task.
3. In the finished wrapper, a node whose text is the same on several pages is template; one whose text
   varies is a slot. The content region is the marked article where the layout has one, else the body. In
   it, slots are content unless their kind (navigation, header, footer, aside, form, script, advert, notice,
   reader comments, ...) says otherwise or most of their text is links on pages that repeat them. In a marked
   article, a node that is constant with all nodes below it is a box of the layout and goes: it must be on at
   least half of the pages that have its parent and on ``TEMPLATE_PAGES`` pages of different text. A title (h1)
   stays, inline nodes of a running text stay, and so does all of an article that is the same on every page.
4. Every page is aligned with its host's wrapper by the same matching and the text of its content nodes is
   written out.

Inside a content slot everything is content, also a passage that many pages share: sameness is judged by
node, not by sentence. Neighbours of one kind are one node, so a constant paragraph among others stays.

Defined cases: a null or empty page has an empty text; a null url is a host of its own; a host with a single
page has no template, only kinds; unclosed and crossing tags close as browsers do; text outside any element
belongs to the body; repeated pages are repeated rows. Extra columns are ignored.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom import scale
from labelloom.llm.inputs import pieces

# HTML's elements by their role in parsing and in a page's layout.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math".split())
BLOCK = frozenset("""address article aside blockquote body br caption center dd details dialog div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre
section summary table tbody td tfoot th thead title tr ul""".split())
CLOSES_P = BLOCK - frozenset("br body html caption dd dt legend li option tbody td tfoot th thead title tr".split())
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
               "th": {"td", "th"}, "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"},
               "tfoot": {"tbody", "thead", "tr", "td", "th"}}
SCOPES = frozenset("article aside body div fieldset footer form header html main nav ol section table td th ul".split())
DROPPED = frozenset("""head script style noscript template iframe svg math object canvas audio video nav header footer
aside form button select textarea input dialog menu""".split())
DROPPED_NAMES = re.compile(
    r"""(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|banner|sponsor(?:ed)?|promo|nav(?:bar|igation)?|menu|
    breadcrumbs?|header|masthead|footer|sidebar|aside|cookies?|consent|gdpr|notice|newsletter|subscribe|popup|modal|
    comments?|disqus|replies|respond|share|sharing|social|related|recommend(?:ed|ations)?|pagination|pager|login|
    signup|search|skip|toolbar|widget)(?:$|[\s_-]|\d)""", re.I | re.X)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
ARTICLE = frozenset(("article", "main"))
ARTICLE_NAMES = re.compile(r"(?:^|\s)(?:article|post|entry|story|main)(?:[-_](?:body|content|text))?(?:$|\s)|articleBody", re.I)

TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|"
                 r"<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"""([A-Za-z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
DIGITS = re.compile(r"\d+")
#: A node that repeats a text on so many pages is template.
TEMPLATE_PAGES = 3
#: Blocks of running text: inline nodes are part of it.
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 li td th dt dd blockquote pre figcaption caption".split())


class Node:
    __slots__ = ("kind", "children", "text", "links")

    def __init__(self, kind: tuple):
        # kind: tag, names (class and id without numbers), role
        self.kind, self.children, self.text, self.links = kind, [], [], 0


def _kind(tag: str, attributes: str) -> tuple:
    names = role = ""
    hidden = False
    if attributes:
        for m in ATTRIBUTE.finditer(attributes):
            key = m[1].lower()
            if key in ("class", "id", "itemprop"):
                names += " " + DIGITS.sub("", m[2] or m[3] or m[4] or "")
            elif key == "role":
                role = (m[2] or m[3] or m[4] or "").lower()
            elif key == "hidden" or (key == "aria-hidden" and (m[2] or m[3] or m[4] or "").lower() == "true"):
                hidden = True
    return tag, names.strip(), "hidden" if hidden else role


def parse(page: str) -> Node:
    """The tree of a page; the root is the body's parent and always there. A text child is a string."""
    root = Node(("html", "", ""))
    stack, at, n = [root], 0, len(page)
    while at < n:
        m = TAG.search(page, at)
        if m is None:
            stack[-1].children.append(page[at:])
            break
        if m.start() > at:
            stack[-1].children.append(page[at:m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            if m[0].startswith("<![CDATA["):
                stack[-1].children.append(html.escape(m[0][9:-3] if m[0].endswith("]]>") else m[0][9:]))
            continue
        tag = tag.lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].kind[0] == tag:
                    del stack[i:]
                    break
                # A closing inline tag does not reach out of its block.
                if tag not in BLOCK and stack[i].kind[0] in SCOPES:
                    break
            continue
        if tag == "html":
            continue
        if tag in CLOSES_P:
            _close(stack, {"p"})
        elif tag in SAME_CLOSES:
            _close(stack, SAME_CLOSES[tag])
        node = Node(_kind(tag, m[3]))
        stack[-1].children.append(node)
        if tag in VOID or m[3].endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            node.children.append(page[at:end.start() if end else n])
            at = end.end() if end else n
            continue
        stack.append(node)
    return root


def _close(stack: list[Node], tags: set[str]) -> None:
    """Close the innermost open element of these tags, if no other scope lies between."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].kind[0] in tags:
            del stack[i:]
            return
        if stack[i].kind[0] in SCOPES and stack[i].kind[0] not in tags:
            return


def dropped(kind: tuple) -> bool:
    """True for a kind of node that is not part of an article whatever it holds."""
    tag, names, role = kind
    if tag in DROPPED or role in DROPPED_ROLES or role == "hidden":
        return True
    return bool(names) and tag not in ("html", "body", "article", "main") and bool(DROPPED_NAMES.search(names))


# A wrapper node: [kind, pages, text length, length of text in links, hash of its text or None if it varies,
# children, hashes of the texts of up to TEMPLATE_PAGES different pages that have it]. Text that a node holds
# itself counts as its own; a layout is the tree of such nodes.
KIND, PAGES, LENGTH, LINKED, SAME, CHILDREN, TEXTS = range(7)


def _strings(node: Node) -> Iterator[str]:
    for child in node.children:
        if isinstance(child, str):
            yield child.strip()
        else:
            yield from _strings(child)


def layout(node: Node, groups: dict | None = None, mark: str | None = None) -> list:
    """The wrapper of a single page. Nodes of a dropped kind are leaves. ``groups`` takes, for each node, its
    wrapper's children and the nodes that each of them stands for; ``mark`` is the hash of the page's text."""
    mark = hash_text(list(_strings(node))) if mark is None else mark
    own, children, members, linked, length = [], [], [], 0, 0
    for child in node.children:
        if isinstance(child, str):
            piece = child.strip()
            own.append(piece)
            length += len(piece)
            continue
        made = layout(child, groups, mark)
        length += made[LENGTH]
        linked += made[LENGTH] if child.kind[0] == "a" else made[LINKED]
        if children and children[-1][KIND] == made[KIND]:
            children[-1] = merge(children[-1], made, siblings=True)
            members[-1].append(child)
        else:
            children.append(made)
            members.append([child])
    out = [node.kind, 1, length, linked, hash_text(own), children, [mark]]
    if groups is not None:
        groups[id(node)] = children, members
    if dropped(node.kind):
        out[CHILDREN] = []
    return out


def hash_text(own: list[str]) -> str:
    import xxhash
    return xxhash.xxh64_hexdigest("\x1f".join(own).strip("\x1f"))


def matching(left: list, right: list) -> list[tuple[int, int]]:
    """Simple tree matching of two lists of children: the order-keeping pairs of equal kinds with the largest
    number of matched nodes at and below them."""
    kinds = [c[KIND] for c in left]
    if kinds == [c[KIND] for c in right] and len(set(kinds)) == len(kinds):
        return [(i, i) for i in range(len(left))]
    return _weighed(left, right)[1]


def _weighed(left: list, right: list) -> tuple[int, list[tuple[int, int]]]:
    """The number of matched nodes of all levels, and the pairs of this one."""
    n, m = len(left), len(right)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    weight = {}
    for i in range(n):
        for j in range(m):
            here = 0
            if left[i][KIND] == right[j][KIND]:
                here = weight[i, j] = 1 + _weighed(left[i][CHILDREN], right[j][CHILDREN])[0]
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + here)
    pairs, i, j = [], n, m
    while i and j:
        if (i - 1, j - 1) in weight and best[i][j] == best[i - 1][j - 1] + weight[i - 1, j - 1]:
            pairs.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return best[n][m], pairs[::-1]


def merge(left: list, right: list, siblings: bool = False) -> list:
    """Align two wrappers with roots of one kind. ``siblings``: both are on the same page and so are one
    repeated node of it."""
    pairs = matching(left[CHILDREN], right[CHILDREN])
    children, i, j = [], 0, 0
    for a, b in [*pairs, (len(left[CHILDREN]), len(right[CHILDREN]))]:
        children += left[CHILDREN][i:a] + right[CHILDREN][j:b]
        if a < len(left[CHILDREN]):
            children.append(merge(left[CHILDREN][a], right[CHILDREN][b], siblings))
        i, j = a + 1, b + 1
    same = left[SAME] if left[SAME] == right[SAME] else None
    pages = left[PAGES] if siblings else left[PAGES] + right[PAGES]
    return [left[KIND], pages, left[LENGTH] + right[LENGTH], left[LINKED] + right[LINKED], same, _folded(children),
            sorted({*left[TEXTS], *right[TEXTS]})[:TEMPLATE_PAGES]]


def _folded(children: list) -> list:
    """Unaligned children of a kind that is there already are folded into it, so wrappers stay small."""
    out: list = []
    for child in children:
        if out and out[-1][KIND] == child[KIND]:
            out[-1] = merge(out[-1], child, siblings=True)
        else:
            out.append(child)
    return out


def written(wrapper: list) -> str:
    return json.dumps(wrapper, ensure_ascii=False, separators=(",", ":"))


def read(text: str) -> list:
    def deep(w):
        w[KIND] = tuple(w[KIND])
        for c in w[CHILDREN]:
            deep(c)
        return w
    return deep(json.loads(text))


def is_template(node: list) -> bool:
    """Aligned on several pages, without nodes below, and with the same text on all of them."""
    return node[PAGES] >= TEMPLATE_PAGES and node[SAME] is not None and not node[CHILDREN]


def is_constant(node: list) -> bool:
    """The same text on all pages that have it, also in the nodes below."""
    return node[SAME] is not None and all(map(is_constant, node[CHILDREN]))


def is_box(node: list, parent: list) -> bool:
    """In a marked article: a constant part of the layout."""
    tag = node[KIND][0]
    if tag == "h1" or (tag not in BLOCK and (parent[SAME] is None or parent[KIND][0] in RUNNING)):
        return False
    return len(node[TEXTS]) >= TEMPLATE_PAGES and 2 * node[PAGES] >= parent[PAGES] and is_constant(node)


def is_link_list(node: list) -> bool:
    return node[LENGTH] > 0 and node[LINKED] > 0.8 * node[LENGTH] and node[KIND][0] in ("ul", "ol", "div", "p", "table", "section")


def _has_heading(node: Node) -> bool:
    """An article's own header holds its title; a page's header lies outside."""
    return any(not isinstance(c, str) and (c.kind[0] in ("h1", "h2", "h3") or _has_heading(c)) for c in node.children)


def _articles(node: Node) -> list[Node]:
    """The outermost marked articles that are not inside a dropped node."""
    out = []
    for child in node.children:
        if isinstance(child, str) or dropped(child.kind):
            continue
        if child.kind[0] in ARTICLE or child.kind[2] == "main":
            out.append(child)
        else:
            out += _articles(child)
    return out


def extract(page: str, wrapper: list | None) -> str:
    """The text of a page's content nodes, given its host's wrapper."""
    root = parse(page)
    groups: dict[int, tuple] = {}
    if wrapper is not None:
        layout(root, groups)
    regions = _articles(root)
    inner = [a for r in regions if r.kind[0] == "main" or r.kind[2] == "main" for a in _articles(r)]
    chosen = {id(n) for n in (inner or regions)}
    blocks: list[list[str]] = [[]]

    def walk(node: Node, slot: list | None, inside: bool, varies: bool = False) -> None:
        inside = inside or not chosen or id(node) in chosen
        if slot is not None and id(node) in chosen:
            varies = not is_constant(slot)
        slots = {}
        if slot is not None:
            children, members = groups[id(node)]
            slots = {id(c): slot[CHILDREN][b] for a, b in matching(children, slot[CHILDREN]) for c in members[a]}
        for child in node.children:
            if isinstance(child, str):
                if inside:
                    blocks[-1].append(child)
                continue
            if dropped(child.kind) and not (inside and chosen and child.kind[0] == "header" and _has_heading(child)):
                if child.kind[0] in BLOCK:
                    blocks.append([])
                continue
            mine = slots.get(id(child))
            breaks = child.kind[0] in BLOCK
            # Template nodes are left out; without a marked article, lists of links too.
            if mine is not None and (varies and is_box(mine, slot) if chosen else is_template(mine) or is_link_list(mine)):
                if breaks:
                    blocks.append([])
                continue
            if breaks:
                blocks.append([])
            walk(child, mine, inside, varies)
            if breaks:
                blocks.append([])

    walk(root, wrapper, False)
    out = [" ".join(html.unescape("".join(b)).split()) for b in blocks]
    return " ".join(b for b in out if b)


def host_of(url: str) -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _page_wrappers(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    found: dict[str, list] = {}
    for frame in pieces(frames, 256):
        for host, page in zip(frame["host"], frame["html"]):
            made = layout(parse(page))
            found[host] = merge(found[host], made) if host in found else made
        if len(found) > 2_000:
            yield _rows(found)
            found = {}
    if found:
        yield _rows(found)


def _rows(found: dict[str, list]) -> pd.DataFrame:
    return pd.DataFrame({"host": list(found), "wrapper": [written(w) for w in found.values()]})


def _merged(frame: pd.DataFrame) -> pd.DataFrame:
    texts = sorted(frame["wrapper"])  # the order of arrival must not matter
    wrapper = read(texts[0])
    for text in texts[1:]:
        wrapper = merge(wrapper, read(text))
    return pd.DataFrame({"host": [frame["host"].iloc[0]], "wrapper": [written(wrapper)]})


def wrappers(pages: DataFrame) -> DataFrame:
    """``host``, ``wrapper``: the merged layout of all pages of each host."""
    rows = pages.mapInPandas(_page_wrappers, "host string, wrapper string").withColumn(
        "part", F.pmod(F.xxhash64("wrapper"), F.lit(64)))
    some = rows.groupBy("host", "part").applyInPandas(_merged, "host string, wrapper string")
    return some.groupBy("host").applyInPandas(_merged, "host string, wrapper string")


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``text``, ``n_chars``."""
    own = pages.select("page_id", F.col("url").cast("string").alias("url"),
                       F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    own = own.withColumn("host", host_of("url"))
    known = scale.stage(wrappers(own.select("host", "html")), "wrappers")
    with_wrapper = scale.attach(own, known, ["host"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, list] = {}
        for frame in pieces(frames, 256):
            texts = []
            for page, wrapper in zip(frame["html"], frame["wrapper"]):
                if wrapper not in cache:
                    if len(cache) > 500:
                        cache.clear()
                    cache[wrapper] = read(wrapper) if isinstance(wrapper, str) else None
                texts.append(extract(page, cache[wrapper]))
            yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": texts,
                                "n_chars": [len(t) for t in texts]})

    kind = own.schema["page_id"].dataType.simpleString()
    return with_wrapper.select("page_id", "url", "html", "wrapper").mapInPandas(
        run, f"page_id {kind}, url string, text string, n_chars bigint")
