"""Main text of web pages with a site style tree.

The pages of a host are merged into one tree whose nodes are the paths of element names and
classes. A node's presentation importance is the entropy of its styles (the inline elements its
instances hold) against the greatest for so many styles: a template repeats, an article varies. Its
content importance is one less the mean entropy, over the host's pages, of the texts found there:
what stands on every page is noise, what stands on one is content. Both are combined with the weight
gamma to the power of the number of styles, as in the published style tree, but never to less
than the content importance: text of its own is content in whatever style, on hosts of any size. Pages
with equal html have one vote together. Statistics are sums per (host, path, feature), pre-aggregated
before the shuffle, and what goes back to the pages are the paths of unimportant branches.

Marks are a prior. Elements that by name, role or class are menus, headers, footers, sidebars, notices,
adverts, forms, scripts or reader comments have no importance; a class word alone never removes an
article or the main part, and inside an article it must be the class's whole meaning (``related`` and
``related-posts``, not ``related-work``). If a page marks its article (or else its main part), what lies
outside is not content, and a branch inside is removed below ``LEAST_MARKED`` instead of
``LEAST_IMPORTANCE``, unless such branches hold most of the text there (then it is the article that
repeats on many pages). A page that would lose all its text without any such mark keeps it. A
host with fewer than ``MIN_PAGES`` different pages says nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflow.llm.common import cut, small, small_batches

GAMMA = 0.9
LEAST_IMPORTANCE = 0.5
LEAST_MARKED = 0.1      # inside a marked article or main part
MIN_PAGES = 10
BROADCAST_PATHS = 500_000

# fixed values: HTML's element kinds
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCKS = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th
thead tr ul""".split())
CLOSES_P = BLOCKS - set("body caption html legend option tbody td tfoot th thead tr".split())
# an opening element ends an open one of these names, unless one of the fences lies between
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"})}
# fixed values: names of elements, roles and class words that are not the article
NOISE_TAGS = set("""nav footer aside form script style noscript template iframe svg button select textarea input dialog menu object canvas
head title search math audio video""".split())
NOISE_ROLES = set("navigation contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
NOISE_WORDS = set("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu breadcrumb
breadcrumbs sidebar sidenav footer cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe
subscription signup login comment comments disqus reply replies respond share sharing social related recommended recommendations widget
widgets toolbar pagination pager skip""".split())
# of them, what an article itself may be
COMMENT_WORDS = set("comment comments disqus reply replies respond".split())
# words that add nothing to a class's meaning
PLAIN_WORDS = set("area bar block body box button buttons container content group header inner item items link links list panel post posts row section slot text title unit wrapper".split())
# these are noise unless inside the article, where they hold its title
PAGE_TAGS, PAGE_ROLES, PAGE_WORDS = {"header"}, {"banner"}, {"header", "masthead", "banner", "topbar"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[/!?a-zA-Z][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(?=[\s/]|\Z))", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Node:
    """An open element: its name, the hash of its path, whether it is noise, and the landmark it lies in (0 none, 1 main, 2 article)."""

    __slots__ = ("tag", "path", "noise", "landmark")

    def __init__(self, tag: str, path: int, noise: bool, landmark: int):
        self.tag, self.path, self.noise, self.landmark = tag, path, noise, landmark


def _by_words(classes: str, tag: str, landmark: int, inside: bool) -> bool:
    """Whether class words make an element noise."""
    if tag in ("html", "body"):
        return False
    names = [{w.lower() for w in _WORD.findall(c)} for c in classes.split()]
    if landmark:
        return any(n & COMMENT_WORDS for n in names)
    return any(n & NOISE_WORDS and (not inside or n <= NOISE_WORDS | PLAIN_WORDS) for n in names)


def _node(parent: Node, tag: str, attributes: str) -> Node:
    at = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in reversed(list(_ATTRIBUTE.finditer(attributes)))} if attributes else {}
    words = {w.lower() for w in _WORD.findall(at.get("class", "") + " " + at.get("id", ""))}
    role = at.get("role", "").strip().lower()
    landmark = 2 if tag == "article" or role == "article" else 1 if tag == "main" or role == "main" else 0
    noise = (parent.noise or tag in NOISE_TAGS or role in NOISE_ROLES or "hidden" in at
             or bool(words & NOISE_WORDS) and _by_words(at.get("class", "") + " " + at.get("id", ""), tag, landmark, parent.landmark == 2)
             or (parent.landmark < 2 and landmark < 2 and (tag in PAGE_TAGS or role in PAGE_ROLES
                                                          or (bool(words & PAGE_WORDS) and tag not in ("html", "body")))))
    name = tag + "".join(f".{w}" for w in sorted(words))
    return Node(tag, xxhash.xxh3_64_intdigest(name, seed=parent.path), noise, max(landmark, parent.landmark))


class Block:
    """A stretch of text between block boundaries: path of its block element, inline elements, text."""

    __slots__ = ("path", "style", "text", "noise", "landmark")

    def __init__(self, node: Node, style: str, text: str):
        self.path, self.noise, self.landmark = node.path - (1 << 63), node.noise, node.landmark
        self.style, self.text = style, text


def blocks(page: str) -> list[Block]:
    """All non-blank text blocks of a page in order, references decoded, white space collapsed."""
    root = Node("", 0, False, 0)
    stack, out = [root], []
    depth: Counter = Counter()  # open elements by name: what is not open is not looked for in a deep stack
    holder, text, style, raw = root, [], [], []

    def put(piece: str) -> None:
        if piece:
            raw.append(piece)

    def settle() -> None:  # adjacent pieces are decoded together: a tag never splits a reference
        if raw:
            text.append(unescape("".join(raw)))
            raw.clear()

    def flush() -> None:
        settle()
        t = " ".join("".join(text).split())
        if t:
            out.append(Block(holder, " ".join(style), t))
        text.clear()
        style.clear()

    def holder_of() -> Node:
        for n in reversed(stack):
            if n.tag in BLOCKS or n.noise:
                return n
        return root

    def innermost(tag: str) -> int:
        return next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0) if depth[tag] else 0

    def close(k: int) -> None:
        nonlocal holder
        if any(n.tag in BLOCKS or n.noise for n in stack[k:]):
            flush()
        depth.subtract(n.tag for n in stack[k:])
        del stack[k:]
        holder = holder_of()

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            put(page[at:])
            break
        put(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<!--"):
                settle()
            continue  # comments, declarations and what is no whole tag
        settle()
        tag = m[2].lower()
        if m[1]:
            k = innermost(tag)
            if k:
                close(k)
            elif tag == "p" or tag == "br":
                flush() if tag == "p" else put(" ")
            continue
        if tag in CLOSES_P:
            k = innermost("p")
            if k:
                close(k)
        if tag in ENDS:
            names, fences = ENDS[tag]
            first = 0
            for i in range(len(stack) - 1, 0, -1) if any(depth[x] for x in names) else ():
                if stack[i].tag in fences:
                    break
                if stack[i].tag in names:
                    first = i
            if first:
                close(first)
        if tag == "br":
            put(" ")
        if tag in VOID:
            if tag in BLOCKS:
                flush()
            continue
        if m[3].endswith("/") and tag in ("svg", "math", "path"):
            continue
        node = _node(stack[-1], tag, m[3])
        if tag in BLOCKS or node.noise != stack[-1].noise:
            flush()
        else:
            style.append(tag)
        if tag in RAW:  # not markup inside
            e = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = e.end() if e else n
            continue
        stack.append(node)
        depth[tag] += 1
        if tag in BLOCKS or node.noise:
            holder = node
    flush()
    return out


def _host(url_col: str) -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html, copies) -> per page: a row for each path (kind 2), style of a path (0), text of a path (1), with
    its count and the page's part of a vote."""
    for b in batches:
        cols: tuple[list, ...] = ([], [], [], [], [], [])
        for host, page, copies in zip(*(b.column(i).to_pylist() for i in range(3))):
            n: Counter = Counter()
            for x in blocks(page or ""):
                n[x.path, 0, xxhash.xxh3_64_intdigest(x.style) - (1 << 63)] += 1
                n[x.path, 1, xxhash.xxh3_64_intdigest(x.text) - (1 << 63)] += 1
                n[x.path, 2, 0] = 1
            for (path, kind, feature), k in n.items():
                for c, v in zip(cols, (host, path, kind, feature, k, 1 / copies)):
                    c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            cols, (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64()))], ["host", "path", "kind", "feature", "n", "vote"])


def importance(pages: DataFrame, url_col: str = "url", html_col: str = "html", min_pages: int = MIN_PAGES) -> DataFrame:
    """The merged style trees: (host, path, pages, importance), importance from 0 (noise) to 1."""
    d = pages.select(_host(url_col).alias("host"), F.col(html_col).alias("html")).withColumn(
        "key", F.xxhash64("html", F.length("html")))
    again = cut(d.groupBy("host", "key").agg(F.count("*").alias("copies")).where("copies > 1").select(
        F.col("host").alias("host2"), F.col("key").alias("key2"), "copies"))
    d = d.join(small(again, BROADCAST_PATHS), F.expr("host = host2 and key = key2"), "left")
    rows = d.select("host", "html", F.coalesce("copies", F.lit(1)).alias("copies")).mapInArrow(
        _features, "host string, path long, kind int, feature long, n long, vote double")
    n, vote = F.col("n").cast("double"), F.col("vote")
    # equal pages add up to one: whole again after rounding
    f = rows.groupBy("host", "path", "kind", "feature").agg(
        *[F.round(F.sum(c * vote), 6).alias(a) for c, a in ((n, "t"), (n * F.log(n), "s"), (F.lit(1.0), "m"))])
    of = lambda kind, c: F.when(F.col("kind") == kind, c)
    nodes = f.groupBy("host", "path").agg(
        F.max(of(2, F.round("m").cast("long"))).alias("pages"), F.count(of(0, F.lit(1))).alias("styles"), F.sum(of(0, F.col("t"))).alias("all"),
        F.sum(of(0, F.col("t") * F.log("t"))).alias("styled"), F.avg(of(1, F.log("t") - F.col("s") / F.col("t"))).alias("spread"))
    one = F.lit(1.0)
    presentation = F.when(F.col("styles") > 1, (F.log("all") - F.col("styled") / F.col("all")) / F.log("styles")).otherwise(F.lit(0.0))
    content = F.when(F.col("pages") > 1, 1 - F.col("spread") / F.log(F.col("pages").cast("double"))).otherwise(one)
    weight = F.pow(F.lit(GAMMA), F.col("styles"))
    value = F.greatest(content, (1 - weight) * presentation + weight * content)
    return nodes.select("host", "path", "pages", F.when(F.col("pages") < min_pages, one).otherwise(value).alias("importance"))


def main_text(page: str, unimportant: set[int], template: set[int] = frozenset()) -> str:
    """The page's blocks that are left after removing noise and unimportant branches, one per line; inside a
    marked article or main part those of ``template`` go instead of all ``unimportant`` ones."""
    found = [x for x in blocks(page) if not x.noise]
    best = max((x.landmark for x in found), default=0)
    if best:
        found = [x for x in found if x.landmark == best]
        left = [x for x in found if x.path not in template]
        enough = 2 * sum(len(x.text) for x in left) >= sum(len(x.text) for x in found)
    else:
        left = [x for x in found if x.path not in unimportant]
        enough = bool(left)
    return "\n".join(x.text for x in (left if enough else found))


def extracted(pages: DataFrame, url_col: str = "url", html_col: str = "html", out: str = "__main_text",
              min_pages: int = MIN_PAGES) -> DataFrame:
    """Adds ``out``, the main text of each page. All rows and columns of ``pages`` stay. A null page
    is empty; pages whose url is null or has no host form one host."""
    small_batches(pages.sparkSession)
    low = cut(importance(pages, url_col, html_col, min_pages).where(F.col("importance") < LEAST_IMPORTANCE).select(
        "host", "path", F.when(F.col("importance") < LEAST_MARKED, F.col("path")).alias("sure")))
    noise = low.groupBy("host").agg(F.collect_list("path").alias("__noise"), F.collect_list("sure").alias("__template")).withColumnRenamed("host", "__host")
    # the broadcast is bounded by the number of paths it holds; beyond that both sides are shuffled
    total = low.limit(BROADCAST_PATHS + 1).count()
    noise = F.broadcast(noise) if total <= BROADCAST_PATHS else noise

    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for columns in batches:
            yield pa.array([main_text(x or "", set(p or ()), set(t or ())) for x, p, t in zip(*(c.to_pylist() for c in columns))],
                           pa.string())

    udf = F.arrow_udf(run, "string")
    joined = pages.withColumn("__h", _host(url_col)).join(noise, F.col("__h") == F.col("__host"), "left")
    return joined.withColumn(out, udf(F.col(html_col), F.col("__noise"), F.col("__template"))).drop(
        "__h", "__host", "__noise", "__template")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per page: id, url, text (empty if none), n_chars (its code points)."""
    t = extracted(pages.select(id_col, url_col, html_col), url_col, html_col, min_pages=min_pages)
    return t.select(id_col, url_col, F.col("__main_text").alias("text"), F.char_length("__main_text").cast("long").alias("n_chars"))
