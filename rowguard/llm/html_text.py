"""Main text of web pages by removal of the site's template.

Every element subtree that holds no article is hashed (tag, text, children). The hashes are counted
per host over its different pages in Spark; subtrees on many of them are the site's template and are
deleted, inside articles too, where it takes more of the pages: texts of a site share sentences.
Elements that say what they are go as well (menus, headers, footers, sidebars, adverts, notices,
forms, scripts, comments). Of what is left, articles are the text if there are any, else the main
element, else the body. Work on a page grows with its length, however deep its elements are nested.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowguard.llm.common import written

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|title|textarea)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>"
    # A quote counts only where a value begins.
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*+)?+)*+)>",
    re.S | re.I,
)
_NAMED = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section "
    "summary table tbody tfoot thead tr ul".split()
)
#: Left out with all they contain. Only raw text (see ``_TOKEN``) runs on without an end tag.
_SKIPPED = frozenset("noscript template iframe svg math object head select".split())
#: What a head can hold; anything else ends it.
_IN_HEAD = frozenset("head base basefont bgsound link meta noscript template".split())
#: Ends drawings and formulas that are open, except inside elements of theirs that hold HTML.
_BREAKS_OUT = _BLOCKS | frozenset("body br b big code em embed i img nobr ruby s small span strong sub sup tt u".split())
_HOLD_HTML = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())
_DROPPED = frozenset("nav footer aside form button menu dialog input label".split())
#: Whole names in class, id or role that say an element is not main text.
_HINTS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar "
    "comment comments disqus respond reply replies cookie cookies consent gdpr notice notices alert popup "
    "modal newsletter subscribe subscription menu nav navbar navigation breadcrumb breadcrumbs footer "
    "masthead topbar pagination pager share sharing social related recommended widget login signup "
    "contentinfo complementary search dialog".split()
)
#: Of these names and tags an element that holds most of the text of a page may be the text after all.
_UNSURE = frozenset(
    "search dialog social share sharing widget sidebar banner notice notices alert popup modal login signup "
    "complementary masthead topbar related recommended form aside header".split()
)
_NO_ARTICLE = frozenset("comment comments reply replies ad ads related sponsored promo".split())
_ADVERTS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion".split())
_TEXT = frozenset("h1 h2 h3 h4 h5 h6 hgroup section p blockquote pre ul ol dl table figure".split())
#: What a start tag closes, up to the next element that holds such tags.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_P_HOLDERS = frozenset("article aside body div section main table td th li blockquote html form footer header nav".split())


class Element:
    """An element: its tag, its parts (texts and elements in order), whether it says that it is no
    main text (``sure``: whatever it holds), whether it is inside an article."""

    __slots__ = ("tag", "parts", "dropped", "sure", "inside", "digest")

    def __init__(self, tag: str, names: frozenset[str] = frozenset(), inside: bool = False) -> None:
        self.tag, self.parts, self.inside, self.digest = tag, [], inside, 0
        # Speech in an article is text; a dialog of the page's own has a tag or stands outside.
        reasons = names & _HINTS - {"dialog"} if inside else names & _HINTS
        if tag in ("html", "body", "main"):
            reasons = frozenset()
        elif tag == "article":
            reasons &= _NO_ARTICLE
        elif tag in _DROPPED or (tag == "header" and not inside):
            reasons |= {tag}
        self.dropped = bool(reasons)
        self.sure = not reasons <= _UNSURE

    def elements(self) -> list[Element]:
        return [p for p in self.parts if isinstance(p, Element)]


def _names(tag: str, attributes: str, in_article: bool) -> frozenset[str]:
    """Names by which an element can say what it is. Headings, sections and paragraphs of an article
    are its text, whatever their ids and however they look; only adverts among them are not."""
    text = in_article and tag in _TEXT
    found = set()
    for kind, *values in _NAMED.findall(attributes):
        if not (text and kind.lower() == "id"):
            found.update("".join(values).lower().split())
    return frozenset(found & _ADVERTS if text else found)


def parse(page: str) -> Element:
    """The tree of a page. Tags that are missing at the end, and stray ones, do no harm."""
    root = Element("html")
    stack, at, last_ends = [root], 0, {}
    open_at: dict[str, list[int]] = defaultdict(list)

    def innermost(tags: Iterable[str]) -> int:
        """Depth of the innermost open element with one of the tags; 0 if there is none."""
        return max((open_at[tag][-1] for tag in tags if open_at.get(tag)), default=0)

    def close(depth: int) -> None:
        while len(stack) > depth:
            open_at[stack.pop().tag].pop()

    def close_one_of(tags: Iterable[str], holders: Iterable[str]) -> None:
        depth = innermost(tags)
        if depth > innermost(holders):
            close(depth)

    for found in _TOKEN.finditer(page):
        if found.start() > at:
            words = page[at : found.start()]
            if stack[-1].tag == "head" and words.strip():
                close(len(stack) - 1)
            stack[-1].parts.append(words)
        at = found.end()
        tag = found[3]
        if tag is None:
            continue
        tag = tag.lower()
        if found[2]:
            if open_at.get(tag):
                close(open_at[tag][-1])
            continue
        if tag == "html":
            continue
        if stack[-1].tag == "head" and tag not in _IN_HEAD:
            close(len(stack) - 1)
        if tag in _BREAKS_OUT and (open_at.get("svg") or open_at.get("math")):
            close_one_of(("svg", "math"), _HOLD_HTML)
        if tag in _CLOSES:
            close_one_of(*_CLOSES[tag])
        if tag in _BLOCKS and open_at.get("p"):
            close_one_of(("p",), _P_HOLDERS)
        inside = stack[-1].inside or stack[-1].tag == "article"
        new = Element(tag, _names(tag, found[4], inside) if found[4] else frozenset(), inside)
        if tag in _SKIPPED:
            if tag != "head" and tag not in last_ends:
                ends = re.finditer(rf"</{tag}\b", page, re.I)
                last_ends[tag] = max((end.start() for end in ends), default=-1)
            if found[4].endswith("/") or (tag != "head" and last_ends[tag] < at):
                continue
        else:
            stack[-1].parts.append(new)
        if tag not in _VOID and not found[4].endswith("/"):
            open_at[tag].append(len(stack))
            stack.append(new)
    if at < len(page):
        if stack[-1].tag == "head":
            close(len(stack) - 1)
        stack[-1].parts.append(page[at:])
    _keep_around_texts(root)
    return root


def _postorder(root: Element) -> list[Element]:
    """Elements, children before parents, without recursion."""
    order, todo = [], [root]
    while todo:
        e = todo.pop()
        order.append(e)
        todo += e.elements()
    return order[::-1]


def _keep_around_texts(root: Element) -> None:
    """What is around the main element is kept, whatever it says of itself; without one, what is
    around articles where no article is left outside of such elements. On a page with neither, an
    element that may be the text after all is kept if it holds most of it. Elements of comments and
    the like, and teasers in a sidebar next to an article, stay out."""
    order = _postorder(root)
    wanted = {id(e) for e in order if e.tag == "main"}
    if not wanted:
        below_dropped: set[int] = set()
        for e in reversed(order):
            if e.dropped or id(e) in below_dropped:
                below_dropped.update(id(p) for p in e.elements())
        wanted = {id(e) for e in order if e.tag == "article" and not e.dropped}
        if wanted - below_dropped:
            return
    if wanted:
        for e in order:
            if any(id(p) in wanted for p in e.elements()):
                wanted.add(id(e))
                e.dropped = False
        return
    held: dict[int, int] = {}
    for e in order:
        texts = (held[id(p)] if isinstance(p, Element) else len("".join(p.split())) for p in e.parts)
        held[id(e)] = 0 if e.dropped and e.sure else sum(texts)
    for e in order:
        if e.dropped and not e.sure and 2 * held[id(e)] > held[id(root)]:
            e.dropped = False


def hash_subtrees(root: Element) -> tuple[list[Element], int]:
    """Sets ``digest`` of every element that holds no article; returns those with text, and a number
    for the texts of the page's articles (0 without any). A digest of 0 stands for none, an odd one
    for an element inside an article."""
    found, around, articles = [], set(), []
    for e in _postorder(root):
        parts, texts = [e.tag], False
        for p in e.parts:
            if isinstance(p, Element):
                if p.tag == "article" or id(p) in around:
                    around.add(id(e))
                texts = texts or p.digest != 0
                parts.append(str(p.digest))
            elif words := " ".join(p.split()):
                parts.append("'" + words)
                texts = True
        if e.tag == "article":
            articles.append("\0".join(parts))
        elif texts and id(e) not in around and e.tag not in ("html", "body", "main"):
            digest = xxhash.xxh64_intdigest("\0".join(parts)) - (1 << 63)
            e.digest = digest | 1 if e.inside else (digest & ~1) or 2
            found.append(e)
    return found, xxhash.xxh64_intdigest("\1".join(articles)) - (1 << 63) if articles else 0


def _regions(root: Element, template: frozenset[int]) -> list[Element]:
    """The outermost articles that are left, else main elements, else the whole page."""
    for tag in ("article", "main"):
        own, todo = [], [root]
        while todo:
            e = todo.pop()
            if e.dropped or (e.digest and e.digest in template):
                continue
            if e.tag == tag:
                own.append(e)
            else:
                todo += e.elements()[::-1]
        if own:
            return own
    return [root]


def main_text(page: str, template: frozenset[int] = frozenset()) -> str:
    """Blocks in page order, each with single blanks, joined by two line ends."""
    root = parse(page)
    if template:
        hash_subtrees(root)
    blocks, run = [], []

    def close() -> None:
        if text := " ".join("".join(run).split()):
            blocks.append(text)
        run.clear()

    for region in _regions(root, template):
        close()
        todo: list[Element | str | None] = [region]
        while todo:
            x = todo.pop()
            if x is None:
                close()
            elif isinstance(x, str):
                run.append(html.unescape(x))
            elif not (x.dropped or (x.digest and x.digest in template)):
                if x.tag in _BLOCKS:
                    close()
                    todo.append(None)
                elif x.tag in ("br", "td", "th", "img"):
                    run.append(" ")
                todo += reversed(x.parts)
        close()
    return "\n\n".join(blocks)


def host_of(url: Column) -> Column:
    """Host of an address in lower case, without port; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[^:/?#]*:?//(?:[^/@?#]*@)?([^:/?#]*)", 1), F.lit("")))


_FOUND = pa.schema([("host", pa.string()), ("page", pa.int64()), ("subtree", pa.int64())])


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per host, page and subtree; a page gives one with subtree 0 besides. Pages with the same
    articles count as one, and those without any where all of them is equal."""
    for whole in batches:
        for at in range(0, len(whole), 500):
            batch = whole.slice(at, 500)
            hosts, pages, subtrees = [], [], []
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                elements, articles = hash_subtrees(parse(page))
                own = {0, *(e.digest for e in elements)}
                hosts += [host] * len(own)
                pages += [articles or xxhash.xxh64_intdigest(page) - (1 << 63)] * len(own)
                subtrees += own
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(pages, pa.int64()), pa.array(subtrees, pa.int64())], schema=_FOUND)


def site_templates(
    pages: DataFrame, *, least_pages: int = 3, least_share: float = 0.3, least_share_inside: float = 0.5
) -> DataFrame:
    """host and its template as a list of subtree hashes: those on ``least_pages`` different pages of
    it and on ``least_share`` of them (``least_share_inside`` for what is in articles), so the list is
    bounded by the subtrees of a few pages. Pages with equal articles count once. Hosts with many pages
    are counted in the tasks before the shuffle."""
    rows = pages.select(host_of(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    found = rows.mapInArrow(_subtrees, "host string, page bigint, subtree bigint").distinct()
    counts = written(found.groupBy("host", "subtree").agg(F.count("*").alias("n")), "html-subtrees")
    whole = counts.filter("subtree = 0").select("host", F.col("n").alias("pages"))
    often = counts.filter(f"subtree <> 0 and n >= {least_pages}").join(whole, "host")
    inside = F.col("subtree").bitwiseAND(F.lit(1)) == 1
    often = often.filter(F.col("n") >= F.col("pages") * F.when(inside, least_share_inside).otherwise(least_share))
    return often.groupBy("host").agg(F.collect_list("subtree").alias("template"))


def extract_pages(pages: DataFrame, *, broadcast_subtrees: int = 1_000_000, **options) -> DataFrame:
    """Per page: page_id, url, text, n_chars.

    Null html is empty, and a page without main text gives an empty one. Pages without a host share
    one. Columns besides page_id, url and html are not read; repeated rows are kept; an empty table
    gives no rows. Templates are broadcast up to ``broadcast_subtrees`` hashes and hosts together.
    """
    templates = written(site_templates(pages, **options), "html-templates")
    few = (templates.agg(F.sum(F.size("template") + 1).alias("n")).first()["n"] or 0) <= broadcast_subtrees
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of(F.col("url")).alias("host"))
    rows = rows.join(F.broadcast(templates) if few else templates, "host", "left")
    id_type = dict(pages.dtypes)["page_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 500):
                batch = whole.slice(at, 500)
                texts = [
                    main_text(page, frozenset(template or ()))
                    for page, template in zip(batch.column("html").to_pylist(), batch.column("template").to_pylist())
                ]
                columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    return rows.select("page_id", "url", "html", "template").mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars bigint")
