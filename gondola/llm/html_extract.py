"""Main-text extraction with a site style tree.

Pages of one host are merged: every element's signature path (tags with their class and id, digits
dropped, from the root) is a node of the host's tree. A node's presentation importance is the
entropy of the styles it shows (the sequence of its child elements; for an element without any, the
order of magnitude of its length), as a share of that of STYLES even styles; its content importance
is one less the mean of log_m of the number of its m pages that share its content. The first is
drawn towards what the node's position (the same path) shows on all other hosts, by up to
PRIOR_PAGES pages, and towards 1/2 by as many as those hosts can't fill; the second towards 1/2 by
PRIOR_COPIES pages. So a host with one page is judged by what its positions are elsewhere, a shape
that no other host has is low on more than PRIOR_PAGES / 4 pages only, a text on more than PRIOR_COPIES / 4.

A block whose two importances are not low is meaningful, with all that it holds but nodes of low
content importance (text that the site repeats). A page's branches of which less than LOW is
meaningful text are removed. Elements that by tag, role or name are menus, headers, footers,
sidebars, notices, adverts, forms or comments are left out before, and the article (else the main
element, else one named as content, else the body) is what the tree prunes. Where less than KEEP of
that would be left (all pages of a host are of one shape), content importance alone decides; where
that leaves less, nothing is removed. So the tree never empties a page. Headings, paragraphs and
list items are never removed by themselves, only with a branch: near copies on a host look like
templates.

The host's model is as many rows as it has low nodes; it is broadcast behind a check of its size.

Defined cases: a null html is an empty page (empty text); a null or relative url has no host, so
only names decide; pages that repeat count once in the tree; an empty table gives no rows; other
columns of the input are not read. Time is linear in a page's length, however its tags are nested.
"""

from __future__ import annotations

import hashlib
import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import map_in_arrow, materialise

#: A node of an importance below this is low.
LOW = 0.4
#: So many pages of other hosts (or that know nothing) are added to each node's.
PRIOR_PAGES = 20
PRIOR_COPIES = 10
#: As many styles, all alike in number, are full importance: a template has few on however many pages.
STYLES = 32
#: Of the text that names leave, importances may remove all but this share.
KEEP = 0.2
#: A model up to this many low paths (about 60 bytes each) is broadcast; a larger one is joined by shuffle.
BROADCAST_PATHS = 500_000

# Fixed values of the HTML vocabulary.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
NOISE_TAGS = frozenset(
    "head nav aside footer form script style noscript template iframe object embed canvas svg button select textarea input dialog menu search audio video map noembed noframes".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar tablist".split())
NOISE_NAMES = frozenset(
    "ad ads adsbygoogle adv advert adverts advertisement advertisements advertising adbox adslot sponsor sponsored sponsors promo promos promotion banner banners cookie cookies consent gdpr"
    " notice notices notification notifications popup modal overlay newsletter subscribe subscription signup login sidebar sidebars widget widgets nav navbar navigation navi sidenav topnav menu menus sidemenu"
    " breadcrumb breadcrumbs header masthead topbar footer comment comments commentlist disqus reply replies respond share sharing social related recommended recommendations"
    " pagination pager toolbar skip paywall disclaimer".split()
)
COMMENT_NAMES = frozenset("comment comments commentlist disqus reply replies respond".split())
NOT_NAMES = frozenset("has with no without is".split())
#: An open element of the first kind ends where one of the second starts.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option", "optgroup"}}
#: The other way round: what a starting tag ends.
ENDED_BY = {tag: [open_ for open_, by in ENDS.items() if tag in by] for tag in set().union(*ENDS.values())}
SCOPES = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}

#: Of these only whole branches above them are removed by importance, unless they have a name.
TEXT_LEVEL = frozenset("h1 h2 h3 h4 h5 h6 p li dd dt blockquote pre td th tr tbody figcaption caption".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/><]*)((?:[^<>"']++|"[^"]*"|'[^']*')*+)>|<[!?/][^<>]*>|([^<]+|<)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Node:
    __slots__ = ("children", "names", "noise", "path", "role", "tag", "text")

    def __init__(self, tag: str, names: str = "", role: str = ""):
        self.tag, self.names, self.role, self.children, self.noise = tag, names, role, [], False


class _Open:
    """The open elements, with the places of each tag and of all blocks among them."""

    def __init__(self, root: Node):
        self.stack, self.at, self.blocks = [root], {}, []

    def last(self, tag: str) -> int:
        return self.at[tag][-1] if self.at.get(tag) else -1

    def push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.stack))
        if node.tag in BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append(node)

    def cut(self, place: int) -> None:
        """Close the element at a place and all inside it."""
        for node in self.stack[place:]:
            self.at[node.tag].pop()
        while self.blocks and self.blocks[-1] >= place:
            self.blocks.pop()
        del self.stack[place:]


def parse(page: str) -> Node:
    """The element tree of a page; children are nodes and strings. Forgiving, like a browser."""
    root = Node("#root")
    held = _Open(root)
    at, end = 0, len(page)
    while at < end:
        token = _TOKEN.match(page, at)
        at = token.end()
        closing, tag, attributes, text = token.groups()
        if text is not None:
            held.stack[-1].children.append(entities.unescape(text) if "&" in text else text)
        elif tag is None:
            continue
        elif tag.lower() in RAW and not closing:
            tag = tag.lower()
            close = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            at = close.start() if close else end
            if close:
                at = page.find(">", close.start()) + 1 or end
        elif closing:
            tag = tag.lower()
            place = held.last(tag)
            # a stray inline end tag closes nothing outside its block
            if place > 0 and (tag in BLOCK or not held.blocks or held.blocks[-1] < place):
                held.cut(place)
        else:
            tag = tag.lower()
            if tag in BLOCK and held.blocks and held.stack[held.blocks[-1]].tag == "p":
                held.cut(held.blocks[-1])  # an open paragraph ends at any block
            if tag in ENDED_BY:
                place = max(map(held.last, ENDED_BY[tag]))
                if place > max(map(held.last, SCOPES.get(tag, ())), default=-1):
                    held.cut(place)
            names = role = ""
            if attributes:
                for m in _ATTRIBUTE.finditer(attributes):
                    key = m[1].lower()
                    if key in ("class", "id"):
                        names += " " + (m[2] or m[3] or m[4] or "")
                    elif key in ("role", "itemprop"):
                        role = (m[2] or m[3] or m[4] or "").lower()
            node = Node(tag, names.strip(), role)
            held.stack[-1].children.append(node)
            if tag not in VOID and (tag in BLOCK or not attributes.rstrip().endswith("/")):  # <div/> opens a div
                held.push(node)
    return root


def _tokens(names: str) -> set[str]:
    """Words of class and id names; a name that says has-x or no-x says nothing about itself."""
    out: set[str] = set()
    for name in names.split():
        words = [w.lower() for w in _NAME.findall(name)]
        if words and words[0] not in NOT_NAMES:
            out.update(words)
    return out


def mark_noise(root: Node) -> None:
    """Flag elements that by tag, role or name are no part of an article."""
    todo = [(root, False)]
    while todo:
        node, inside = todo.pop()
        if node.noise:
            continue
        tag = node.tag
        words = _tokens(node.names) if node.names else ()
        article = tag in ("article", "main") or node.role in ("main", "articlebody")
        if tag in NOISE_TAGS or node.role in NOISE_ROLES or tag == "header" and not inside:
            node.noise = True
        elif words:
            if article or tag in ("html", "body"):
                node.noise = bool(COMMENT_NAMES.intersection(words)) and tag == "article"
            elif tag not in ("h1", "h2", "h3", "p") or not inside:
                node.noise = bool(NOISE_NAMES.intersection(words)) and not (inside and words & {"header"} and not words & (NOISE_NAMES - {"header"}))
        if not node.noise:
            todo.extend((c, inside or article) for c in node.children if isinstance(c, Node))


def signature(node: Node) -> str:
    return node.tag + ("." + re.sub(r"\d+", "", node.names) if node.names else "")


def blocks(node: Node) -> list[str]:
    """Texts of the blocks below node in page order, without noise; white space is one space."""
    out: list[str] = []
    run: list[str] = []

    def flush():
        if run:
            text = " ".join("".join(run).split())
            run.clear()
            if text:
                out.append(text)

    todo: list = [node]
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            run.append(x)
        elif x.noise:
            continue
        elif x.tag == "br":
            run.append(" ")
        else:
            block = x.tag in BLOCK
            if block:
                flush()
                todo.append(None)
            todo.extend(reversed(x.children))
    flush()
    return out


def style_paths(root: Node) -> dict[int, int]:
    """id of every element -> hash of its signature path."""
    out: dict[int, int] = {}
    todo = [(root, b"")]
    while todo:
        node, above = todo.pop()
        path = hashlib.blake2b(above + b"/" + signature(node).encode("utf-8", "surrogatepass"), digest_size=8).digest()
        out[id(node)] = int.from_bytes(path, "little", signed=True)
        todo.extend((c, path) for c in node.children if isinstance(c, Node))
    return out


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def style_rows(page: str) -> list[tuple[int, int, int]]:
    """(path, style, content) of every path of the page that holds text; elements of the same path are taken together."""
    root = parse(page)
    paths = style_paths(root)
    found: dict[int, list] = {}
    inner: list[list] = [[]]  # of each open element: what it holds, as texts and the hashes of elements
    sizes = [0]
    todo: list = [(root, False)]
    while todo:
        x, leaving = todo.pop()
        if leaving:
            held, size = inner.pop(), sizes.pop()
            if held:
                content = str(_hash("\x1f".join(held)))
                inner[-1].append(content)
                sizes[-1] += size
                entry = found.setdefault(paths[id(x)], [[], [], 0, False])
                below = [c.tag for c in x.children if isinstance(c, Node)]
                entry[0].append(",".join(below))
                entry[1].append(content)
                entry[2] += size
                entry[3] |= bool(below)
        elif isinstance(x, str):
            if text := " ".join(x.split()):
                inner[-1].append(text)
                sizes[-1] += len(text)
        else:
            inner.append([])
            sizes.append(0)
            todo.append((x, True))
            todo.extend((c, False) for c in reversed(x.children))
    return [(path, _hash("|".join(s) if parents else f"#{size.bit_length()}"), _hash(",".join(c))) for path, (s, c, size, parents) in found.items()]


def drop_low(content: list[Node], paths: dict[int, int], plain: frozenset, repeated: frozenset) -> bool:
    """Mark the branches of low importance as noise; plain, repeated: the paths of low presentation and of low content importance.

    content: elements whose text stands so far. False, and nothing marked, if less than KEEP of it would be left.
    """
    share: dict[int, list] = {}  # of each element: its text, and how much of it is meaningful
    order = []
    todo = [(x, False) for x in content]
    while todo:
        x, kept = todo.pop()
        path = paths[id(x)]
        if path in repeated and (x.tag not in TEXT_LEVEL or x.names):
            kept = False
        elif path not in plain and path not in repeated and x.tag in BLOCK:
            kept = True
        n = sum(len(" ".join(c.split())) for c in x.children if isinstance(c, str))
        share[id(x)] = [n, n * kept]
        order.append(x)
        todo.extend((c, kept) for c in x.children if isinstance(c, Node) and not c.noise)
    for x in reversed(order):  # children before their parents
        for c in x.children:
            if isinstance(c, Node) and not c.noise:
                share[id(x)][0] += share[id(c)][0]
                share[id(x)][1] += share[id(c)][1]
    gone, left = [], 0
    todo = list(content)
    while todo:
        x = todo.pop()
        n, good = share[id(x)]
        if n and good < LOW * n and (x.tag not in TEXT_LEVEL or x.names) and x.tag in BLOCK and x.tag not in ("html", "body", "head"):
            gone.append(x)
            continue
        left += sum(len(" ".join(c.split())) for c in x.children if isinstance(c, str))
        todo.extend(c for c in x.children if isinstance(c, Node) and not c.noise)
    if not left or left < KEEP * sum(share[id(x)][0] for x in content):
        return False
    for x in gone:
        x.noise = True
    return True


def _named_content(root: Node) -> list[Node]:
    """Where the text is: surviving articles, else main elements, else elements named as content, else the page."""
    articles, mains, named = [], [], []
    todo = [(root, False, False)]
    while todo:
        x, in_main, in_named = todo.pop()
        if x.noise:
            continue
        if x.tag == "article" or x.role == "articlebody":
            articles.append(x)
            continue
        if x.tag == "main" or x.role == "main":
            if not in_main:
                mains.append(x)
            in_main = True
        elif x.names and x.tag in ("div", "section", "td") and _tokens(x.names) & {"content", "article", "post", "entry", "story", "main"}:
            if not in_named:
                named.append(x)
            in_named = True
        todo.extend((c, in_main, in_named) for c in reversed(x.children) if isinstance(c, Node))
    return articles or mains or named or [root]


def main_text(page: str, plain: frozenset = frozenset(), repeated: frozenset = frozenset(), names: bool = True) -> str:
    """The page's article: blocks joined by an empty line; plain, repeated: paths of low importance on its host.

    names: whether tags, roles and names decide beside the tree.
    """
    root = parse(page)
    content = [root]
    if names:
        mark_noise(root)
        content = _named_content(root)
    if plain or repeated:
        paths = style_paths(root)
        drop_low(content, paths, plain, repeated) or drop_low(content, paths, frozenset(), repeated)
    return "\n\n".join(b for x in content for b in blocks(x))


def host_of(url):
    """Lower-case host of an absolute url, null for others."""
    host = F.regexp_extract(F.col(url).cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.lower(host), F.lit(""))


def node_importance(pages: DataFrame) -> DataFrame:
    """host, path, pages, presentation, content: the importances of every node of each host's style tree; pages(host, html)."""

    def run(batches):
        for b in batches:
            rows = [(host, key, *found) for host, key, page in zip(*[b.column(k).to_pylist() for k in range(3)]) for found in style_rows(page or "")]
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *[pa.array(c, pa.int64()) for c in columns[1:]]], ["host", "page", "path", "style", "content"])

    held = pages.where("host is not null").select("host", F.xxhash64("html").alias("page"), "html")
    nodes = map_in_arrow(held, run, "host string, page long, path long, style long, content long").distinct()  # pages that repeat count once
    # counts of each style and content, then their entropies: small aggregations, hot hosts and positions combined map-side
    shown = nodes.select("host", "path", F.inline(F.array(F.struct(F.lit(0).alias("kind"), F.col("style").alias("value")), F.struct(F.lit(1).alias("kind"), F.col("content").alias("value")))))
    counts = materialise(shown.groupBy("host", "path", "kind", "value").agg(F.count(F.lit(1)).alias("n")), "style-counts")
    own = _importances(counts, ["host", "path"])
    everywhere = _importances(counts.groupBy("path", "kind", "value").agg(F.sum("n").alias("n")), ["path"])
    others = everywhere.select("path", F.col("pages").alias("_all"), F.col("presentation").alias("_presentation"))
    m, elsewhere = F.col("pages"), F.col("_all") - F.col("pages")
    weight = PRIOR_PAGES * elsewhere / (elsewhere + PRIOR_PAGES)
    presentation = (m * F.col("presentation") + weight * F.col("_presentation") + (PRIOR_PAGES - weight) / 2) / (m + PRIOR_PAGES)
    content = (m * F.col("content") + PRIOR_COPIES / 2) / (m + PRIOR_COPIES)
    return own.join(others, "path").select("host", "path", "pages", presentation.alias("presentation"), content.alias("content"))


def _importances(counts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, pages, presentation, content, as they are found; counts(*keys, kind, value, n)."""
    sums = counts.groupBy(*keys).agg(
        F.sum(F.when(F.col("kind") == 0, F.col("n"))).alias("pages"),
        *[F.sum(F.when(F.col("kind") == k, F.col("n") * F.log("n"))).alias(name) for k, name in ((0, "_style"), (1, "_content"))],
    )
    m = F.col("pages")
    # of the styles: entropy log m - sum(n log n) / m; of the contents: sum over values of n/m * log_m(n) is 1 if all pages show the same
    presentation = F.least(F.lit(1.0), (F.log(m) - F.col("_style") / m) / F.log(F.lit(float(STYLES))))
    content = F.when(m > 1, 1 - F.col("_content") / (m * F.log(m))).otherwise(F.lit(0.5))
    return sums.select(*keys, "pages", presentation.alias("presentation"), content.alias("content"))


def low_paths(pages: DataFrame) -> DataFrame:
    """host, path, plain, repeated: the nodes whose presentation or whose content importance is low."""
    found = node_importance(pages).select("host", "path", (F.col("presentation") < LOW).alias("plain"), (F.col("content") < LOW).alias("repeated"))
    return found.where("plain or repeated")


def extract(pages: DataFrame, names: bool = True) -> DataFrame:
    """pages(page_id, url, html) with text, the page's article. names: see main_text."""
    rows = pages.select("page_id", "url", "html").withColumn("host", host_of("url"))
    low = materialise(low_paths(rows), "style-trees")
    # as long as a site has distinct template elements: digits are dropped from names
    models = low.groupBy("host").agg(*[F.collect_set(F.when(F.col(kind), F.col("path"))).alias(f"_{kind}") for kind in ("plain", "repeated")])
    if low.count() <= BROADCAST_PATHS:
        models = F.broadcast(models)
    joined = rows.join(models, "host", "left").select("page_id", "url", "html", "_plain", "_repeated")

    def run(batches):
        for b in batches:
            found = zip(*[b.column(k).to_pylist() for k in (2, 3, 4)])
            texts = [main_text(p or "", frozenset(plain or ()), frozenset(repeated or ()), names) for p, plain, repeated in found]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    types = dict(rows.dtypes)
    return map_in_arrow(joined, run, f"page_id {types['page_id']}, url {types['url']}, text string")
