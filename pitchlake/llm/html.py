"""HTML main text with site template removal (operator 9).

Every page is parsed into a tree of elements.  Each block element is hashed
with all that is in it; Spark counts, for each host, the distinct pages on which
a hash occurs: pages whose text is the same before any template is deleted are
one page, so copies of an article are no template.  A subtree found on at least
``min_pages`` distinct pages and ``share`` of those of its host belongs to the
site's template and is deleted, unless it holds an article or main element.  So
is one of ``LONG`` characters or more without an h1 on ``MANY`` distinct pages and
``FEW`` of those of its host: menus of a section, notices or adverts of a pool.
Shorter ones, such as headings and cells, recur in articles too.  What the markup names as something other than the
article (navigation, adverts, forms, comments, ...) goes too, and of what is
left the article (or main) elements are kept, or the whole body without them.

A class or id names something else only by a whole name of it, words of layout
aside (``share-buttons``, not ``social-history``), and ids of headings name
nothing.  An article so named stays where no other root has a text and it has an h1, most
of the page's text or all that is left, and another
element where it holds most of the page's text and an h1 if there is one.
Articles without an h1 that hold less than half of the text of main, or of the
body, are teasers; then that text is kept.

Null and empty pages, and pages without an article text, give an empty text; a
null url is a host of its own; broken markup is read like browsers do
(implied ends, raw script text, unclosed tags); repeated pages count once and
keep their rows; other columns are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import written

MIN_PAGES = 10
SHARE = 0.3
MANY, FEW, LONG = 100, 0.001, 30
HOST_LIST = 1_000

# fixed values: element groups of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
BLOCK = frozenset("""address article aside blockquote body br caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu
    nav ol p pre section summary table tbody td tfoot th thead title tr ul""".split())
ENDS_P = BLOCK - frozenset("br td th tr tbody thead tfoot caption body html".split())
CLOSES = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "option": ("option", "select"),
    "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"),
    "tbody": ("tbody thead tfoot tr td th", "table"), "thead": ("tbody thead tfoot tr td th", "table"),
    "tfoot": ("tbody thead tfoot tr td th", "table"), "body": ("head", "html"),
}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}
DROPPED = frozenset("""head script style noscript template nav footer aside form button select textarea iframe svg
    canvas object audio video dialog menu title math""".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
# words of class and id values that name something other than the article
HINTS = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo
    promotion promoted banner cookie cookies consent gdpr notice notices notification popup modal overlay newsletter
    subscribe subscription signup login sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs
    footer masthead topbar comment comments commentlist disqus replies respond share sharing social related
    recommended recommendations widget widgets toolbar pagination pager skip""".split())
# words that say where or in what shape something is; a name may have them beside those of HINTS
LAYOUT = frozenset("""area aside bar bars block blocks body bottom box boxes button buttons center column container
    div entries form frame group header icon icons inner item items label left line link links list lists module outer pane
    panel post posts right row section site slot slots space spot tab tabs text title top unit units wrap wrapper x
    article articles stories story""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?][^>]*(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "parent", "parts", "mark", "off", "named", "hash", "main", "core", "text", "size", "head")

    def __init__(self, tag: str, parent, off: bool, named: bool, mark: str):
        self.tag, self.parent, self.off, self.named, self.mark = tag, parent, off, named, mark
        self.parts: list = []  # texts and nodes, in page order


def attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(raw):
        out.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return out


@lru_cache(1 << 14)
def is_hint(name: str) -> bool:
    """Whether a class or id, as a whole, names something other than the article."""
    found = [w for w in SPLIT.split(CAMEL.sub(" ", name).lower()) if w and not w[0].isdigit()]
    return not HINTS.isdisjoint(found) and all(w in HINTS or w in LAYOUT for w in found)


def names_other(tag: str, raw: str) -> tuple[bool, bool, str]:
    """Whether the element is none of the article by its tag, role or being
    hidden, whether its class or id names something else, and what of the
    attributes counts for the hash."""
    if not raw.strip(" /\n\t\r"):
        return tag in DROPPED, False, ""
    a = attributes(raw)
    own = " ".join([a.get("class", ""), a.get("id", "")])
    if tag in ("html", "body", "main"):
        return False, False, own
    hinted = any(is_hint(x) for x in (a.get("class", "") if tag in HEADINGS else own).split())
    hidden = "hidden" in a or a.get("aria-hidden", "").lower() == "true" \
        or "display:none" in a.get("style", "").lower().replace(" ", "")
    return tag in DROPPED or hidden or a.get("role", "").lower() in DROPPED_ROLES, hinted, own


def parse(html: str) -> list[Node]:
    """The elements in page order; the first is the root."""
    root = Node("", None, False, False, "")
    nodes, top, at, n = [root], root, 0, len(html)

    def close(stop: frozenset[str], scope: frozenset[str]):
        nonlocal top
        x = top
        while x is not root and x.tag not in scope:
            if x.tag in stop:
                top = x.parent
                return
            x = x.parent

    while at < n:
        m = TOKEN.search(html, at)
        if not m:
            rest = html[at:]
            cut = re.search(r"<[a-zA-Z/!?]", rest)  # an unfinished tag at the end
            top.parts.append(rest[:cut.start()] if cut else rest)
            break
        if m.start() > at:
            top.parts.append(html[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            x = top
            while x is not root and x.tag != tag:
                x = x.parent
            if x is not root:
                top = x.parent
            elif tag in ("p", "br"):
                top.parts.append(Node("br", top, False, False, ""))
            continue
        if tag in ENDS_P:
            close(frozenset(("p",)), frozenset(("td", "th", "table", "button", "object", "caption", "div", "article", "section")))
        if tag in CLOSES:
            close(*CLOSES[tag])
            if tag in ("tr", "tbody", "thead", "tfoot"):
                close(*CLOSES[tag])
        node = Node(tag, top, *names_other(tag, m[3]))
        top.parts.append(node)
        nodes.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>|</{tag}\Z", re.I).search(html, at)
            if tag == "title" or tag == "textarea":
                node.parts.append(html[at:end.start() if end else n])
            at = end.end() if end else n
        elif tag not in VOID and not m[3].rstrip().endswith("/") or tag in BLOCK and tag not in VOID:
            top = node
    return nodes


def summarise(nodes: list[Node]) -> None:
    """Hash of every subtree, whether it holds the article, how long its text
    is and whether an h1 is in it, both without what is none of the article."""
    for x in reversed(nodes):  # children come after their parents
        h = blake2b(f"{x.tag} {x.mark}\0".encode("utf-8", "surrogatepass"), digest_size=8)
        x.main, x.text = x.tag in ("article", "main", "h1"), False
        x.size, x.head, x.core = 0, x.tag == "h1", x.tag in ("article", "main")
        for p in x.parts:
            if isinstance(p, str):
                t = " ".join(unescape(p).split())
                x.text |= bool(t)
                x.size += len(t)
                h.update(t.encode("utf-8", "surrogatepass"))
            elif p.tag != "br":
                x.main |= p.main
                x.core |= p.core
                x.text |= p.text
                if not (p.off or p.tag == "header" and outside(p)):
                    x.size += p.size
                    x.head |= p.head
                h.update(p.hash)
        x.hash = h.digest()


def number(digest: bytes) -> int:
    return int.from_bytes(digest, "little", signed=True)


def block_number(x: Node) -> int:
    """The hash of a subtree; odd where it is long enough to be template by ``MANY``."""
    return number(x.hash) & ~1 | (x.size >= LONG and not (x.main or x.head))


def subtree_hashes(html: str | None) -> tuple[int, list[int]]:
    """What tells distinct pages apart, a hash of the text with nothing deleted
    as template, and the distinct hashes of the block subtrees that could be
    template."""
    nodes = parse(html or "")
    summarise(nodes)
    content = blake2b(kept_text(nodes, set()).encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return number(content), sorted({block_number(x) for x in nodes[1:] if x.tag in BLOCK and x.text and not x.core})


def main_text(html: str | None, template: set[int], common: set[int] | None = None) -> str:
    """The text of the article; ``template`` holds the subtree hashes to delete
    and ``common`` those of them that go inside an article too (all, if not given)."""
    nodes = parse(html or "")
    summarise(nodes)
    return kept_text(nodes, template, template if common is None else common)


def kept_text(nodes: list[Node], template: set[int], common: set[int] = frozenset()) -> str:
    dropped = drop(nodes, template, common, set())
    named = [x for x in nodes if x.tag == "article" and x.named]
    if named:
        heads = dropped | {id(x) for x in nodes if x.tag == "h1"}
        if not any(texts(x, heads) for x in nodes[1:] if x.tag in ("article", "main") and id(x) not in heads):
            rest = texts(nodes[0], dropped)
            spared = {id(x) for x in named if not rest or x.head or 2 * x.size > nodes[0].size}
            dropped = drop(nodes, template, common, spared)
    kept = [x for x in nodes[1:] if x.tag in ("article", "main") and id(x) not in dropped]
    roots = outermost([x for x in kept if x.tag == "article"])
    own = {id(x) for x in roots}
    wider = outermost([x for x in kept if x.tag == "main"]) or nodes[:1]
    blocks = [b for r in roots for b in texts(r, dropped)]
    if not any(y.tag == "h1" and id(y) not in dropped and own & {id(z) for z in ancestors(y)} for y in nodes):  # they may be teasers
        around = [b for r in wider for b in texts(r, dropped)]
        if 2 * sum(map(len, blocks)) < sum(map(len, around)):
            blocks = around
    return " ".join(blocks)


def drop(nodes: list[Node], template: set[int], common: set[int], spared: set[int]) -> set[int]:
    """The elements that are none of the article.  ``spared`` articles stay
    whatever their class names."""
    dropped, page = set(), nodes[0]
    for x in nodes[1:]:  # parents come first
        inside = id(x.parent) in dropped
        header = x.tag == "header" and outside(x)
        rescued = x.main and x.tag not in ("article", *DROPPED) and holds_article(x)
        if x.tag == "article":
            named = x.named and id(x) not in spared
        else:
            named = x.named and not rescued and not (2 * x.size > page.size and (x.head or not page.head))
        other = x.off and not rescued or named
        if inside or header or other or (template and not x.core and x.tag in BLOCK and (h := block_number(x)) in template
                                         and (h in common or outside(x))):
            dropped.add(id(x))
    return dropped


def outermost(found: list[Node]) -> list[Node]:
    inner = {id(x) for x in found}
    return [x for x in found if not any(id(y) in inner for y in ancestors(x))]


def ancestors(x: Node):
    while x.parent is not None:
        x = x.parent
        yield x


def outside(x: Node) -> bool:
    """Whether the element is in no article or main."""
    return not any(y.tag in ("article", "main") for y in ancestors(x))


def holds_article(x: Node) -> bool:
    stack = [x]
    while stack:
        y = stack.pop()
        for p in y.parts:
            if not isinstance(p, str):
                if p.tag in ("article", "main") and not p.off and not p.named:
                    return True
                stack.append(p)
    return False


def texts(root: Node, dropped: set[int]) -> list[str]:
    """The texts of the blocks below ``root``, white space made single spaces."""
    out, now = [], []

    def flush():
        t = " ".join("".join(now).split())
        if t:
            out.append(t)
        now.clear()

    stack = [iter(root.parts)]
    opened = [root]
    while stack:
        p = next(stack[-1], None)
        if p is None:
            stack.pop()
            if opened.pop().tag in BLOCK:
                flush()
        elif isinstance(p, str):
            now.append(unescape(p))
        elif id(p) in dropped:
            if p.tag in BLOCK:
                flush()
        else:
            if p.tag in BLOCK:
                flush()
            stack.append(iter(p.parts))
            opened.append(p)
    flush()
    return out


def host() -> "F.Column":
    return F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def page_subtrees(pages: DataFrame) -> DataFrame:
    """host, page (md5 of the markup), content, hashes of every page."""
    def hashes(batches):
        for b in batches:
            found = [subtree_hashes(h.as_py()) for h in b.column("html")]
            yield pa.RecordBatch.from_arrays(
                [b.column("host"), b.column("page"), pa.array([c for c, _ in found], pa.int64()),
                 pa.array([h for _, h in found], pa.list_(pa.int64()))], names=["host", "page", "content", "hashes"])

    return pages.select(host().alias("host"), markup().alias("page"), F.col("html").cast("string").alias("html")) \
        .mapInArrow(hashes, "host string, page binary, content long, hashes array<long>")


def markup() -> "F.Column":
    return F.unhex(F.md5(F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")))


def site_templates(rows: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """host, hash, common: the subtrees of each site's template, and whether
    they are on ``share`` of its pages, so that they go inside articles too;
    ``rows`` are those of :func:`page_subtrees`."""
    # distinct in each task and over all tasks first, then counted, so pages of
    # the same host meet as counts only; hash 0 stands for the page itself
    counts = rows.select("host", "content", F.explode(F.concat(F.array(F.lit(0).cast("long")), "hashes")).alias("hash")) \
        .groupBy("host", "hash").agg(F.count_distinct("content").alias("n")).where(F.col("n") >= min_pages)
    counts = written(counts, "page-subtree-counts")
    total = counts.where("hash = 0").select("host", F.col("n").alias("pages"))
    long = F.col("hash").bitwiseAND(F.lit(1).cast("long")) == 1
    return counts.where("hash != 0").join(total, "host").where(
        (F.col("n") >= share * F.col("pages")) | long & (F.col("n") >= MANY) & (F.col("n") >= FEW * F.col("pages"))) \
        .select("host", "hash", (F.col("n") >= share * F.col("pages")).alias("common"))


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE, host_list: int = HOST_LIST) -> DataFrame:
    """page_id, url, text, n_chars of every page.  The template of a host goes
    with each of its pages up to ``host_list`` subtrees; of a larger one each
    page gets only those that are on it, by joins."""
    subtrees = written(page_subtrees(pages), "page-subtrees")
    templates = written(site_templates(subtrees, min_pages, share), "site-templates")
    large = written(templates.groupBy("host").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > host_list).select("host"), "large-hosts")
    both = [F.collect_list("hash").alias("hashes"), F.collect_list(F.when(F.col("common"), F.col("hash"))).alias("common")]
    of_host = written(templates.join(large, "host", "left_anti").groupBy("host")
                      .agg(F.struct(*both).alias("of_host")), "host-templates")
    of_page = written(subtrees.join(large, "host", "left_semi").select("host", "page", F.explode("hashes").alias("hash")).distinct()
                      .join(templates, ["host", "hash"]).groupBy("host", "page").agg(F.struct(*both).alias("of_page")), "page-templates")
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host().alias("host"), markup().alias("page")) \
        .join(of_host, "host", "left").join(of_page, ["host", "page"], "left") \
        .select("page_id", "url", "html", F.coalesce("of_host", "of_page").alias("template")) \
        .select("page_id", "url", "html", "template.hashes", "template.common")
    schema = rows.select("page_id", "url", F.lit("").alias("text")).schema

    def texts_of(batches):
        for b in batches:
            out = [main_text(h.as_py(), set(t.as_py() or ()), set(c.as_py() or ()))
                   for h, t, c in zip(b.column("html"), b.column("hashes"), b.column("common"))]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string())],
                                             names=["page_id", "url", "text"])

    return rows.mapInArrow(texts_of, schema).withColumn("n_chars", F.char_length("text").cast("long"))
