"""HTML extraction with site template removal.

Every page is parsed into its element tree. The hash of each element subtree outside the passages is counted for its host in
Spark, once for each different main text; a subtree that recurs across many pages of a host is template, and the text below it is deleted, be it
inside the article or outside. What these counts leave open is settled by names: what tags, roles and class names mark as navigation,
header, footer, sidebar, notice, advert, form or comment is deleted, and what then stays inside the article (`article`, `main`,
`role=main`; the body where there is none) is the main text.

Containers are hashed: sections, lists, tables and figures, inside an article too. Paragraphs, headings and quotations are never
template however often a passage is repeated on a site, and nothing inside them is, unless class names mark a paragraph or heading
as an advert, notice or the like: then counts decide.

Counts go by host and hash, so a host with a third of all pages is spread. A host's template list holds subtrees on at
least SHARE of its pages, so it is no longer than the mean number of hashed elements of a page / SHARE, whatever the host's size.

Class names and forms (but for class names like `has-sidebar`, which tell the layout) delete no article below them unless another
article of the page is below none, and nothing of a body without an article that has no other text.

Defined cases: null and empty pages give an empty text; a null url has the empty host; unclosed, crossed and stray tags are
mended as browsers do in the common cases; rows of a host with one main text (repeated rows, mirrors under other urls) count as one
page, so that copies do not turn their own text into template; a very long page is read whole.
"""

import re
from collections.abc import Callable, Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from steadycare.sources.staging import stage

from .url_digest import host_of

LEAST_PAGES, SHARE = 5, 0.1

_RAW = "script|style|textarea|title|xmp|iframe|noembed|noframes"  # fixed value: elements whose content is not markup
_TOKEN = re.compile(
    rf"<(?i:({_RAW}))(?=[\s/>])[^>]*(?:>.*?(?:</(?i:\1)(?=[\s/>])[^>]*(?:>|\Z)|\Z)|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)(?:>|((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z))"
    r"|<!--.*?(?:-->|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
#: Every name=value pair, one after the other, so that no part of a value or of a longer name is taken for a name.
_ATTRIBUTE = re.compile(r"([^\s/>=\"'][^\s/>=]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?|=\s*(?:\"[^\"]*\"|'[^']*')")

#: Elements of the HTML standard by how they are read.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
CLOSES_P = BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "option", "optgroup", "body", "html", "legend"}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}, "thead": {"tbody", "thead"}, "tfoot": {"tbody", "thead", "tr", "td", "th"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}}
TABLE = {"table"}
P, P_SCOPE = ("p",), {"article", "main", "div", "section", "td", "th", "li", "blockquote", "button"}
OUTER, NO_SCOPE, ARTICLE_SCOPE = {"html", "body", "article", "main", "table"}, frozenset(), {"article", "main", "table"}
NO_ATTRIBUTES: dict[str, str] = {}
PARAGRAPH = set("p h1 h2 h3 h4 h5 h6".split())
PASSAGE = PARAGRAPH | {"blockquote", "pre"}
INLINE = set("a b i em strong span u s small sub sup code q cite abbr mark time font br img var kbd samp del ins label".split())
DROPPED = set(
    "head script style noscript template nav footer aside button select option textarea input iframe object svg canvas "
    "audio video dialog menu title noembed noframes math map".split()
)
NOT_HASHED = set(
    "html body head title meta link script style noscript article main li p h1 h2 h3 h4 h5 h6 blockquote pre dt dd figcaption tbody tr td th".split()
) | INLINE
PART = set("thead tfoot caption colgroup legend summary".split())  # heads and feet of a table or list in an article go with their own whole
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|advertisement|sponsor\w*|promo\w*|banner\w*|cookies?|consent|notice\w*|notification\w*|nav\w*|menu\w*"
    r"|breadcrumbs?|header|masthead|footer|side-?bar\w*|comments?|commentlist|disqus\w*|reply|replies|respond|related|recommend\w*"
    r"|share|sharing|social\w*|subscribe\w*|newsletter|signup|login|popup\w*|modal\w*|overlay|widget\w*|pagination|pager|toc"
    r"|copyright|disclaimer|skip-?link\w*|hidden)(?:$|[\s_-])",
    re.I,
)
STATE = re.compile(r"(?:^|(?<=\s))(?:has|no|with|without)-\S*", re.I)  # class names that say how a page is laid out, not what an element is
#: How surely names delete an element, and where the text of a page stands, from the likeliest place of its main text on.
STAYS, MARK, TAG = range(3)
ARTICLE, MARKED_ARTICLE, BODY, MARKED_BODY, NOWHERE = range(5)


class _Element:
    __slots__ = ("tag", "start", "dropped", "content", "below_mark", "prose")

    def __init__(self, tag, start, dropped, content, below_mark, prose):
        self.tag, self.start, self.dropped, self.content, self.below_mark, self.prose = tag, start, dropped, content, below_mark, prose

    def place(self) -> int:
        if self.dropped == TAG or self.content and self.dropped:
            return NOWHERE
        if self.content:
            return MARKED_ARTICLE if self.below_mark else ARTICLE
        return MARKED_BODY if self.dropped else BODY


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for k, v in _ATTRIBUTE.findall(text):
        if k:
            found.setdefault(k.lower(), v.strip("\"'"))
    return found


def _marked(attributes: dict[str, str]) -> bool:
    return any(MARKED.search(STATE.sub("", attributes[k])) for k in ("class", "id", "itemprop") if k in attributes)


def _dropped(tag: str, attributes: dict[str, str], content: bool) -> int:
    if tag in DROPPED or attributes.get("role", "").lower() in ROLES - {"form"} or "hidden" in attributes:
        return TAG
    if tag == "header":
        return STAYS if content else TAG
    if tag in ("html", "body", "main", "article", "p", "h1", "h2", "h3", "h4", "h5", "h6"):
        return STAYS
    return MARK if tag == "form" or attributes.get("role", "").lower() == "form" or _marked(attributes) else STAYS


def _is_content(tag: str, attributes: dict[str, str]) -> bool:
    return tag in ("article", "main") or attributes.get("role", "").lower() == "main"


class Page:
    """Blocks of text with the subtrees above them. `subtrees`: hash of each hashed element, None while it is open. `main`: the
    place of the main text. What marks delete comes back where they would leave nothing, be it an article or the body."""

    def __init__(self, html: str):
        self.html = html
        self.subtrees: list[int | None] = []
        self.blocks: list[tuple[str, tuple[int, ...], int]] = []  # text, numbers of subtrees, place; of the whole page
        self._stack: list[tuple[_Element, int | None]] = []
        self._text: dict[int, tuple[tuple[int, ...], list[str]]] = {}  # of the block that is open, by place
        self.main = NOWHERE
        self._parse()
        self.main = min([self.main, *(place for *_, place in self.blocks)])

    def _flush(self) -> None:
        for place, (above, said) in self._text.items():
            text = "".join(said)
            text = " ".join((unescape(text) if "&" in text else text).split())
            if text:
                self.blocks.append((text, above, place))
        if self._text:
            self._text = {}

    def _open(self, tag: str, attributes: dict[str, str], start: int) -> None:
        top = self._stack[-1][0] if self._stack else None
        inherited, within, below_mark = (top.dropped, top.content, top.below_mark) if top else (STAYS, False, False)
        content = within or _is_content(tag, attributes)
        if content and not within and inherited == MARK:
            inherited, below_mark = STAYS, True
        inside = bool(top and top.prose)
        prose = content and (inside or tag in PASSAGE)
        dropped = max(inherited, _dropped(tag, attributes, within))
        number = None
        if tag in PARAGRAPH and not inside and attributes and _marked(attributes) or not prose and tag not in NOT_HASHED and not (content and tag in PART):
            number = len(self.subtrees)
            self.subtrees.append(None)
        element = _Element(tag, start, dropped, content, below_mark, prose)
        if content and not dropped:
            self.main = min(self.main, element.place())
        self._stack.append((element, number))

    def _close(self, end: int) -> None:
        element, number = self._stack.pop()
        if number is not None:
            self.subtrees[number] = xxhash.xxh64_intdigest(self.html[element.start : end].strip()) >> 1

    def _close_to(self, tags, scope, at: int) -> None:
        """Close up to and including the nearest open element of `tags`, unless one of `scope` stands before it."""
        for i in range(len(self._stack) - 1, -1, -1):
            tag = self._stack[i][0].tag
            if tag in tags:
                self._flush()
                while len(self._stack) > i:
                    self._close(at)
                return
            if tag in scope:
                return

    def _say(self, text: str) -> None:
        if not text:
            return
        place = self._stack[-1][0].place() if self._stack else BODY
        if place not in self._text:
            self._text[place] = tuple(n for _, n in self._stack if n is not None), []
        self._text[place][1].append(text)

    def _parse(self) -> None:
        html, at = self.html, 0
        for token in _TOKEN.finditer(html):
            start, end = token.span()
            if start > at:
                self._say(html[at:start])
            at = end
            _, closing, tag, attributes = token.groups()
            if not tag:  # a comment, a declaration or an element without markup inside
                continue
            tag = tag.lower()
            block = tag in BLOCK
            if block or tag == "br":
                self._flush()
            if closing:
                if block:
                    self._close_to((tag,), NO_SCOPE if tag in OUTER else ARTICLE_SCOPE, end)
                else:
                    self._close_inline(tag, end)
                continue
            if tag in CLOSES_P:
                self._close_to(P, P_SCOPE, start)
            if tag in SAME:
                self._close_to(SAME[tag], SCOPE.get(tag, TABLE), start)
            if tag in VOID or attributes and not block and attributes.rstrip().endswith("/"):
                continue
            self._open(tag, _attributes(attributes) if attributes else NO_ATTRIBUTES, start)
        self._say(html[at:])
        self._flush()
        while self._stack:
            self._close(len(html))

    def _close_inline(self, tag: str, at: int) -> None:
        for i in range(len(self._stack) - 1, -1, -1):
            if self._stack[i][0].tag == tag:
                while len(self._stack) > i:
                    self._close(at)
                return
            if self._stack[i][0].tag in BLOCK:
                return

    def main_blocks(self) -> list[tuple[str, list[int]]]:
        """Text of the blocks in the article, or in the body where there is none, with the hashes above each."""
        return [(t, above) for t, above in self.all_blocks() if t is not None]

    def all_blocks(self) -> list[tuple[str | None, list[int]]]:
        """All blocks of the page with the hashes above each; the text is None where names delete it."""
        return [(t if place == self.main < NOWHERE else None, [self.subtrees[n] for n in above]) for t, above, place in self.blocks]


_BLOCKS = pa.list_(pa.struct([("text", pa.string()), ("above", pa.list_(pa.int64()))]))


def _parser(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parsed = [Page(html or "") for html in batch.column("html").to_pylist()]
        blocks = [p.all_blocks() for p in parsed]
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(c) for c in ("page_id", "url", "host")],
                pa.array([xxhash.xxh128_digest("\n".join(t for t, _ in b if t is not None)) for b in blocks], pa.binary()),
                pa.array([sorted(set(p.subtrees)) for p in parsed], pa.list_(pa.int64())),
                pa.array([[{"text": t, "above": a} for t, a in b] for b in blocks], _BLOCKS),
            ],
            names=["page_id", "url", "host", "main", "subtrees", "blocks"],
        )


def parse_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, host, hash of the main text, distinct subtree hashes and blocks of each page, staged: a page is parsed once."""
    kind = pages.schema["page_id"].dataType.simpleString()
    return stage(
        pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host")).mapInArrow(
            _parser,
            f"page_id {kind}, url string, host string, main binary, subtrees array<bigint>, blocks array<struct<text: string, above: array<bigint>>>",
        ),
        "pages",
    )


def site_templates(parsed: DataFrame, least: int = LEAST_PAGES, share: float = SHARE) -> DataFrame:
    """host and the hashes of its template subtrees, one row for each host that has any."""
    once = parsed.select("host", "main", F.explode("subtrees").alias("subtree")).distinct()  # rows with one main text are one page
    counts = once.groupBy("host", "subtree").agg(F.count("*").alias("pages"))
    totals = parsed.select("host", "main").distinct().groupBy("host").agg(F.count("*").alias("host_pages"))
    recurring = counts.where(F.col("pages") >= least).join(totals, "host").where(F.col("pages") >= share * F.col("host_pages"))
    return recurring.groupBy("host").agg(F.sort_array(F.collect_set("subtree")).alias("template"))


def _with_templates(parsed: DataFrame, least: int, share: float) -> tuple[DataFrame, Callable[[Column], Column]]:
    """Pages with the template list of their host, and whether counts delete a block."""
    templates = stage(site_templates(parsed, least, share), "templates")  # staged, so that its size is known to the join
    template = F.coalesce("template", F.array().cast("array<bigint>"))
    pages = parsed.select("page_id", "url", "host", "blocks").join(templates, "host", "left")
    return pages, lambda b: F.arrays_overlap(b["above"], template)


def extract_text(pages: DataFrame, least: int = LEAST_PAGES, share: float = SHARE) -> DataFrame:
    """page_id, url, text and n_chars for each page; other columns are ignored."""
    placed, recurs = _with_templates(parse_pages(pages), least, share)
    kept = F.filter("blocks", lambda b: ~recurs(b) & b["text"].isNotNull())
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n")
    return placed.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))


def deleted_blocks(pages: DataFrame, least: int = LEAST_PAGES, share: float = SHARE) -> DataFrame:
    """One row: blocks that counts delete, those of them that names would leave, blocks that names delete after that, blocks kept."""
    placed, recurs = _with_templates(parse_pages(pages), least, share)
    number = lambda name, rule: F.coalesce(F.sum(F.size(F.filter("blocks", rule))), F.lit(0)).alias(name)
    return placed.agg(
        number("by_counts", recurs),
        number("by_counts_only", lambda b: recurs(b) & b["text"].isNotNull()),
        number("by_names", lambda b: ~recurs(b) & b["text"].isNull()),
        number("kept", lambda b: ~recurs(b) & b["text"].isNotNull()),
    )
