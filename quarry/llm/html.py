"""Main text of web pages by wrapper induction.

Each page becomes a tree of its structural elements (sections, lists of blocks
inside them).  The trees of one host are aligned by simple tree matching and
merged into a wrapper: a node keeps how many pages have it and which text
blocks all of them share there.  Blocks constant over the host's pages are
template, varying slots are content.  Slots that vary without being content
(menus, adverts, comments, ...) are told by element, role and class names,
which are fixed lists below, and by being nothing but links.

Wrappers are merged inside each task, then per (host, salt), then per host, so
a host with a third of all pages is one small row per task.  They are joined
to the pages by host; which join is left to Spark and the size it measures.

Text rules: character references are decoded; white space inside a block
becomes one space and is trimmed; blocks are joined in page order by one line
feed; ``br`` is white space.  A title element is not part of the article.

Defined cases: null, empty and markup-free html give the plain text there is
(none: an empty string); unclosed and misnested elements are closed where a
block begins; a host whose pages are all equal, or too few, has no template;
if the template would leave nothing, the page is read without it, and if
names alone still leave nothing, without them; a null or
malformed url is a host of its own; repeated rows give equal results; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import json
import re
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash

MIN_PAGES = 3               # pages a slot needs before what they share is template
SALT = 64                   # groups in which a host's partial wrappers are merged first
MAX_DEPTH = 200             # deeper elements count as part of their parent
WIDE = 40                   # children above which equal names are merged before matching

# Element names by role.
STRUCTURE = set("address article aside body center details dialog div fieldset footer form header html main nav "
                "section".split())
FLOW = set("blockquote caption dd dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr legend li ol option p pre "
           "summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe textarea title svg math object select button".split())
BOILERPLATE = set("aside dialog fieldset footer form nav".split())
BOILERPLATE_ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation "
                        "search toolbar".split())
BOILERPLATE_WORDS = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright disqus feedback footer form gdpr login masthead menu menus modal nav navbar navigation "
    "newsletter notice notices notification outbrain overlay pager pagination popup promo promoted promotion "
    "recommended related reply replies respond search share sharing sidebar signup skip social sponsor sponsored "
    "subscribe subscription taboola teaser toolbar topbar widget widgets".split())
STATE_WORDS = set("has no not with without is".split())      # "has-sidebar" tells of a page, not of the element
REMARKS = set("comment comments disqus replies reply respond responses".split())
BOILERPLATE_WORDS |= {"alert", "responses", "sidenav", "sidemenu", "leaderboard", "adsense", "adslot", "adbox"}

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>?|"
    r"<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW}


class Node:
    """A structural element: its key, whether it is boilerplate, and its
    blocks and child nodes in page order."""

    __slots__ = ("tag", "key", "drop", "items", "title", "head", "named")

    def __init__(self, tag: str, key: str, drop: bool, named: frozenset = frozenset()):
        self.tag, self.key, self.drop, self.items, self.title = tag, key, drop or bool(named), [], False
        self.named = frozenset() if drop else named              # words that alone make it boilerplate
        self.head = tag == "header" or tag == "div" and "header" in key.split()

    def children(self):
        return [x for x in self.items if isinstance(x, Node)]


def _open(tag: str, raw: str, by_name: bool = True) -> Node:
    attrs = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(raw)} if raw.strip() else {}
    names = [w.lower() for w in _NAME.findall(f"{attrs.get('class', '')} {attrs.get('id', '')}")]
    drop = (tag in BOILERPLATE or attrs.get("role", "").lower() in BOILERPLATE_ROLES or "hidden" in attrs
            or attrs.get("aria-hidden", "").lower() == "true"
            or "display:none" in attrs.get("style", "").replace(" ", "").lower())
    named: set = set()
    if by_name and tag not in ("html", "body", "main"):
        for token in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
            parts = {w.lower() for w in _NAME.findall(token)}
            if not parts & STATE_WORDS:
                named |= parts & BOILERPLATE_WORDS
    return Node(tag, " ".join([tag, *sorted(set(names))]), drop, frozenset(named))


class _Blocks:
    """Collects text and cuts it into blocks."""

    def __init__(self):
        self.parts, self.linked = [], 0

    def add(self, text: str, in_link: bool) -> None:
        self.parts.append(text)
        if in_link:
            self.linked += len(text.strip())

    def cut(self, node: Node) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            node.items.append((text, self.linked >= 0.8 * len(text)))
        self.parts, self.linked = [], 0


def parse(html: str | None, by_name: bool = True) -> Node:
    """The tree of a page; never fails on malformed markup.  Without
    ``by_name``, class and id words make nothing boilerplate."""
    root = Node("html", "html", False)
    stack = [root]
    held = _Blocks()
    link = 0
    skip = []                                   # open flow elements that are boilerplate by class
    pos, html = 0, html or ""
    while pos < len(html):
        m = _TOKEN.match(html, pos)
        pos = m.end()
        tag = m[2]
        if tag is None:
            text = m[0]
            if not text.startswith("<") and not skip:
                held.add(unescape(text), link > 0)
            elif text == "<" and not skip:
                held.add(text, link > 0)
            elif text.startswith("<![CDATA[") and not skip:
                held.add(text[9:-3], link > 0)
            continue
        tag, closing = tag.lower(), bool(m[1])
        if tag in RAW and not closing:
            if not m[3].rstrip().endswith("/"):
                end = _END[tag].search(html, pos)
                pos = end.end() if end else len(html) if tag in ("script", "style", "title", "textarea") else pos
            continue
        if tag == "head":
            if not closing:
                end = re.compile(r"</head\s*>|<body\b", re.I).search(html, pos)
                pos = (end.start() if end[0].lower() == "<body" else end.end()) if end else pos
            continue
        if tag in STRUCTURE:
            held.cut(stack[-1])
            link, skip = 0, []
            if tag in ("html", "body"):
                continue
            if not closing:
                node = _open(tag, m[3], by_name)
                if len(stack) < MAX_DEPTH and not m[3].rstrip().endswith("/"):
                    stack[-1].items.append(node)
                    stack.append(node)
            elif any(n.tag == tag for n in stack[1:]):
                while stack.pop().tag != tag:
                    pass
        elif tag in FLOW:
            held.cut(stack[-1])
            link = 0
            if closing:
                if tag in skip:
                    del skip[skip.index(tag):]
            else:
                if skip and skip[-1] == tag and tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
                    skip.pop()                  # an unclosed one of the same kind ends here
                if skip or ("=" in m[3] or "hidden" in m[3]) and _open(tag, m[3], by_name).drop:
                    if tag not in VOID:
                        skip.append(tag)
                if tag == "h1":
                    stack[-1].title = True
        elif tag == "a":
            link = 0 if closing else 1
        elif tag == "br":
            held.add(" ", False)
    held.cut(stack[-1])
    for node in list(_walk(root)):
        # a header may hold the title of its article; elsewhere it is page furniture
        if node.head and not any(n.title for n in _walk(node)):
            node.drop = True
    _restore(root)
    return root


def _restore(root: Node) -> None:
    """What is boilerplate by its names alone stays if it holds an article,
    a main element or a title, or (remarks aside) most of the page's text."""
    size: dict = {}
    holds: dict = {}
    nodes = list(_walk(root))[::-1]                                  # children first
    for n in nodes:
        kids = n.children()
        size[id(n)] = sum(size[id(c)] for c in kids) + sum(len(b[0]) for b in n.items if not isinstance(b, Node))
    for n in nodes:
        kids = [c for c in n.children() if not c.drop]
        holds[id(n)] = n.title or any(c.tag in ("article", "main") or holds[id(c)] for c in kids)
        if n.named and (holds[id(n)] or 2 * size[id(n)] > size[id(root)] and not n.named & REMARKS):
            n.drop = False


def _walk(node: Node):
    todo = [node]
    while todo:
        n = todo.pop()
        yield n
        todo.extend(n.children())


def _hash(text: str) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 11


def shape(node: Node) -> list:
    """[key, pages, shared block hashes, children] of one page."""
    kids = [shape(c) for c in node.children()]
    blocks = sorted({_hash(b[0]) for b in node.items if not isinstance(b, Node)})
    return [node.key, 1, blocks, _narrow(kids)]


def _narrow(kids: list) -> list:
    """Neighbours of one name become one slot; very wide lists, all of a name."""
    out: list = []
    for k in kids:
        if out and out[-1][0] == k[0]:
            _absorb(out[-1], k)
        else:
            out.append(k)
    if len(out) > WIDE:
        by: dict = {}
        for k in out:
            if k[0] in by:
                _absorb(by[k[0]], k)
            else:
                by[k[0]] = k
        out = list(by.values())
    return out


def _absorb(a: list, b: list) -> None:
    """Two elements of the same page in one slot: blocks of either."""
    a[2] = sorted(set(a[2]) | set(b[2]))
    a[3] = _narrow([*a[3], *b[3]]) if a[3] or b[3] else a[3]


def match(a: list, b: list):
    """Simple tree matching of two child lists: (size, [(i, j), ...])."""
    n, m = len(a), len(b)
    if not n or not m:
        return 0, []
    weight = [[1 + match(x[3], y[3])[0] if x[0] == y[0] else 0 for y in b] for x in a]
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n):
        for j in range(m):
            here = best[i][j] + weight[i][j] if weight[i][j] else 0
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], here)
    pairs, i, j = [], n, m
    while i and j:
        w = weight[i - 1][j - 1]
        if w and best[i][j] == best[i - 1][j - 1] + w:
            pairs.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return best[n][m], pairs[::-1]


def merge(a: list, b: list) -> list:
    """The wrapper of both: aligned nodes share blocks, others stay as they are."""
    pairs = match(a[3], b[3])[1]
    kids, i, j = [], 0, 0
    for p, q in [*pairs, (len(a[3]), len(b[3]))]:
        kids.extend(a[3][i:p])
        kids.extend(b[3][j:q])
        if p < len(a[3]):
            kids.append(merge(a[3][p], b[3][q]))
        i, j = p + 1, q + 1
    if len(kids) > 4 * WIDE:                    # many layouts on one host: slots by name
        by: dict = {}
        for k in kids:
            by[k[0]] = merge(by[k[0]], k) if k[0] in by else k
        kids = list(by.values())
    return [a[0], a[1] + b[1], sorted(set(a[2]) & set(b[2])), kids]


def _text(node: Node, wrapper, pages: int, inside: bool, out: list) -> None:
    """Content blocks of a node in page order."""
    slots: dict = {}
    if wrapper is not None:
        kids = node.children()
        shapes = [[k.key, 1, [], []] for k in kids]
        # neighbours of one name share the slot of the first
        groups = []
        for k, s in enumerate(shapes):
            if groups and groups[-1][0] == s[0]:
                groups[-1][4].append(k)
            else:
                groups.append([s[0], 1, [], [], [k]])
        for p, q in match([g[:4] for g in groups], wrapper[3])[1]:
            for k in groups[p][4]:
                slots[id(kids[k])] = wrapper[3][q]
    shared = set()
    if wrapper is not None and wrapper[1] >= MIN_PAGES and 2 * wrapper[1] >= pages:
        shared = set(wrapper[2])
    for x in node.items:
        if isinstance(x, Node):
            if not x.drop:
                _text(x, slots.get(id(x)), pages, inside or x.tag in ("article", "main"), out)
        elif _hash(x[0]) not in shared and (inside or not x[1]):
            out.append(x[0])


def _main_nodes(root: Node, tag: str) -> list[Node]:
    """Outermost elements of a name that are not inside boilerplate."""
    found, todo = [], [root]
    while todo:
        n = todo.pop()
        for c in reversed(n.children()):
            if not c.drop:
                if c.tag == tag:
                    found.append(c)
                else:
                    todo.append(c)
    return found


def extract(html: str | None, wrapper: list | None = None) -> str:
    """Main text of a page, given the wrapper of its host."""
    pages = wrapper[1] if wrapper else 0
    usable = wrapper if wrapper and pages >= MIN_PAGES and wrapper[4] else None
    # if nothing is left: without the template, then without the names
    for template, by_name in [(usable, True), *([(None, True)] if usable else []), (usable, False), (None, False)]:
        root = parse(html, by_name)
        marked: list = []
        _text(root, template, pages, False, marked)
        for tag in ("article", "main"):
            held = set(map(id, _main_nodes(root, tag)))
            if held:
                texts = []
                _inside(root, template, pages, held, texts)
                longest = max((sum(map(len, t)) for t in texts), default=0)
                marked = [b for t in texts if 3 * sum(map(len, t)) >= longest for b in t] if longest else marked
                if longest:
                    break
        if marked:
            return "\n".join(marked)
    return ""


def _inside(node: Node, wrapper, pages: int, wanted: set, out: list) -> None:
    """Texts of the wanted nodes, each aligned on the way down to it."""
    if id(node) in wanted:
        own: list = []
        _text(node, wrapper, pages, True, own)
        out.append(own)
        return
    kids = node.children()
    slots: dict = {}
    if wrapper is not None:
        for p, q in match([[k.key, 1, [], []] for k in kids], wrapper[3])[1]:
            slots[id(kids[p])] = wrapper[3][q]
    for k in kids:
        if not k.drop:
            _inside(k, slots.get(id(k)), pages, wanted, out)


def _page_wrapper(html: str | None) -> list:
    """[key, pages, shared, children, varies, whole-page hash]."""
    root = parse(html)
    whole = _hash("\n".join(b[0] for n in _walk(root) for b in n.items if not isinstance(b, Node)))
    return [*shape(root), False, whole]


def merge_wrappers(a: list, b: list) -> list:
    return [*merge(a[:4], b[:4]), a[4] or b[4] or a[5] != b[5], a[5]]


def _host(url: str):
    return F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def induce(pages: DataFrame) -> DataFrame:
    """(host, wrapper as JSON) from (host, html)."""
    def partial(batches):
        import pyarrow as pa
        held: dict = {}
        for b in batches:
            for host, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                one = _page_wrapper(html)
                held[host] = merge_wrappers(held[host], one) if host in held else one
        from pyspark import TaskContext
        salt = TaskContext.get().partitionId() % SALT
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array([salt] * len(held), pa.int32()),
                 pa.array([json.dumps(w) for w in held.values()], pa.string())], names=["host", "salt", "wrapper"])

    def combine(table):
        import pyarrow as pa
        total = None
        for text in table.column("wrapper").to_pylist():
            one = json.loads(text)
            total = one if total is None else merge_wrappers(total, one)
        return pa.table({"host": table.column("host")[:1], "salt": table.column("salt")[:1],
                         "wrapper": pa.array([json.dumps(total)], pa.string())})

    kind = "host string, salt int, wrapper string"
    return (pages.mapInArrow(partial, kind).groupBy("host", "salt").applyInArrow(combine, kind)
            .groupBy("host").applyInArrow(combine, kind).select("host", "wrapper"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    slim = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    slim = slim.withColumn("host", F.coalesce(_host("url"), F.lit("")))
    wrappers = stash(induce(slim.select("host", "html")), "html-wrappers")

    def run(batches):
        import pyarrow as pa
        known: dict = {}
        for b in batches:
            texts = []
            for html, w in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                if w not in known:
                    if len(known) > 200:
                        known.clear()
                    known[w] = json.loads(w) if w else None
                texts.append(extract(html, known[w]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return (slim.join(wrappers, "host", "left").select("page_id", "url", "html", "wrapper")
            .mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint"))
