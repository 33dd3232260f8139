"""Main text of web pages by template deduction from equivalence classes of tokens.

1. A page becomes tokens: the starts of its block elements, named by their path of tags and classes,
   and its blocks of text, named by path and text.
2. Tokens that occur equally often on each page of a host share an occurrence vector; copies of a
   page count once. Vectors are compared by a sum of hashes of (page, count), which is built by
   ordinary partial aggregation, so a host with many pages costs no more per row and nothing is
   gathered. Tokens with the same vector on enough pages form an equivalence class.
3. On a page, a class is valid where its tokens stand in the class's order and nest with the larger
   valid classes: in one of their slots, outside or around them. Valid classes, nested, are the
   page's template; what is no token of theirs stands in its slots.
4. Slots under article, or where the page has none under its main region, that are not under a
   boilerplate element (by tag or by the words in MARKED) give the text.
"""

from __future__ import annotations

import html as html_lib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliate.llm.common import materialize, prepare, table, text_or_empty
from foliate.llm.url_filter import url_host

#: A fixed text must stand on so many pages of a host and on this share of them to be template.
LEAST_PAGES = 3
SHARE = 0.6
#: Most template tokens (8 bytes each) that are broadcast, and the salts of the join used beyond that.
BROADCAST_CLASSES = 500_000
SALTS = 16

#: Elements whose content is not text (fixed values).
RAW = ("script", "style", "noscript", "template", "svg", "iframe", "textarea", "title", "xmp", "noembed", "object", "canvas")
RAW_CDATA = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
#: Elements that never hold main text.
BOILERPLATE = ("nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "head", "label", "fieldset", "datalist", "option")
#: Words of class, id and role that mark such elements.
MARKED = (
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "dialog", "disqus",
    "footer", "gdpr", "header", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "overlay", "pagination", "popup", "promo", "promoted", "related",
    "replies", "reply", "respond", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
)
BLOCKS = (
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3",
    "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
)
#: A start of one of these closes an open element of the set (HTML's implied end tags).
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}

HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
#: Elements that words mark inside an article too; its headings and paragraphs are its text.
CONTAINERS = ("div", "section", "ul", "ol", "dl", "span", "table", "figure", "details", "p")
#: Words that say nothing beside those of MARKED.
FILLERS = ("area", "bar", "block", "bottom", "box", "button", "buttons", "container", "content", "form", "inner", "item", "items", "left", "link", "links", "list", "outer", "panel", "post", "posts", "right", "section", "site", "slot", "top", "unit", "wrap", "wrapper")
#: Ids that mark an element of an article by themselves.
MARKED_IDS = ("comment", "comments", "disqus", "replies", "respond")

# An attribute by HTML's states: a quote opens a value behind = only.
_VALUE = r"""(?:"{0}[^"]*{1}(?:"|\Z)|'{0}[^']*{1}(?:'|\Z)|{0}[^\s>"'][^\s>]*+{1})"""
_NAMED = r"""[^\s/>][^\s/>=]*+"""
_TOKEN = re.compile(rf"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]++|{_NAMED}(?:\s*=\s*{_VALUE.format("", "")}?)?)*+)(?:>|\Z)|<[!?][^>]*(?:>|\Z)|[^<]+|<""", re.S)
_ATTRIBUTE = re.compile(rf"""({_NAMED})(?:\s*=\s*{_VALUE.format("(", ")")}?)?""", re.S)
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_blocks, _void, _raw, _boiler, _marked = set(BLOCKS), set(VOID), set(RAW), set(BOILERPLATE), set(MARKED)
_containers, _fillers, _marked_ids = set(CONTAINERS), set(FILLERS), set(MARKED_IDS)


def attributes_of(text: str) -> dict[str, str]:
    """Names in lower case and values; the first of several with one name counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return found


def _words(name: str) -> list[str]:
    return _NAME.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())


def _says_so(name: str) -> bool:
    """Whether one of the names is made of marked words, with fillers or numbers beside them at most."""
    for one in name.split():
        words = _words(one)
        if any(w in _marked for w in words) and all(w in _marked or w in _fillers or w.isdigit() for w in words):
            return True
    return False


def _label(tag: str, attributes: str, inside: bool = False) -> tuple[str, bool]:
    """Tag with class, and whether the element is marked as boilerplate.

    inside: in article or main, where only containers are marked, and only by a name that has no
    other words (related-posts does, related-work doesn't); an id alone marks reader comments.
    """
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return tag, tag in _boiler
    found = attributes_of(attributes)
    if inside:
        marked = tag in _containers and (any(_says_so(found.get(n, "")) for n in ("class", "role", "aria-label")) or bool(_marked_ids & set(_words(found.get("id", "")))))
    else:
        marked = bool(_marked & {w for name in ("class", "id", "role", "aria-label") for w in _words(found.get(name, ""))})
    hidden = "hidden" in found or bool(_HIDDEN.search(found.get("style", "")))
    bad = tag in _boiler or (tag not in ("html", "body", "article", "main") and marked) or hidden and tag not in ("html", "body")
    return f"{tag}.{found['class'].strip().lower()}" if found.get("class", "").strip() else tag, bad


#: A place: hash of the labels from the root, and bits for article (1) and main (2) among them.
Place = tuple[int, int]
_SEED = (0x9E3779B97F4A7C15, 0)


class _Open:
    """The open elements. Each knows by number what holds for it and all elements around it, so no
    step looks at the whole stack and memory is in proportion to depth."""

    def __init__(self) -> None:
        # tag, path hash, roots, nearest block (its index here, or -1), blocks so far, marked, marked inline, in a header
        self.rows: list[tuple[str, int, int, int, int, bool, bool, bool]] = []
        self.at: dict[str, list[int]] = {}

    def push(self, tag: str, label: str, bad: bool) -> int:
        _, path, roots, block, blocks, marked, inline, header = self.rows[-1] if self.rows else ("", *_SEED, -1, 0, False, False, False)
        path = hash_of(f"{path}/{label}")
        is_block = tag in _blocks
        root = 1 if tag == "article" else 2 if tag == "main" else 0
        self.at.setdefault(tag, []).append(len(self.rows))
        self.rows.append((tag, path, roots | root, len(self.rows) if is_block else block, blocks + is_block, marked or bad, inline or bad and not is_block, header or tag == "header"))
        return path

    def cut(self, k: int) -> None:
        while len(self.rows) > k:
            self.at[self.rows.pop()[0]].pop()

    def last(self, tags) -> int:
        """Place of the innermost open element with one of the tags, or -1."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=-1)

    def first_after(self, tags, k: int) -> int:
        """Place of the outermost open element with one of the tags behind place k, or -1."""
        found = [own[i] for t in tags if (own := self.at.get(t)) and (i := bisect_right(own, k)) < len(own)]
        return min(found, default=-1)

    def blocks_from(self, k: int) -> int:
        return self.rows[-1][4] - (self.rows[k - 1][4] if k else 0)


def hash_of(x: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) - (1 << 63)


def blocks(page: str, tags: list[tuple[int, int, bool]] | None = None) -> list[tuple[Place, str, bool]]:
    """The blocks of a page in order: place, text, and whether an element around it is boilerplate.

    Unclosed p, li, dd, dt, tr, td and th end where HTML ends them; a block's own text and the text
    after an inner block are blocks for themselves; br is white space. tags, where given, takes the
    block elements' starts: how many blocks came before, hash of the path, and whether it is marked.
    """
    out: list[tuple[Place, str, bool]] = []
    stack = _Open()
    pieces: list[str] = []
    skip_to: str | None = None
    at, n = 0, len(page)

    def flush() -> None:
        if pieces:
            text = _SPACE.sub(" ", html_lib.unescape("".join(pieces))).strip()
            pieces.clear()
            if text:
                # The path of the nearest block; inline elements don't make a slot.
                top = stack.rows[-1] if stack.rows else ("", *_SEED, -1, 0, False, False, False)
                tag, path, roots = stack.rows[top[3]][:3] if top[3] >= 0 else ("", *_SEED)
                out.append(((path, roots), text, top[5] or (tag not in HEADINGS and top[7])))

    while at < n:
        if skip_to is not None:  # raw text ends at its own end tag only
            found = re.compile(rf"</{re.escape(skip_to)}(?=[\s/>])", re.I).search(page, at)
            if not found:
                break
            at, skip_to = found.start(), None
        m = _TOKEN.match(page, at)
        at = m.end()
        tag = m[2]
        if tag is None:
            if (m[0][0] != "<" or m[0] == "<") and not (stack.rows and stack.rows[-1][6]):
                pieces.append(m[0])
            continue
        tag = tag.lower()
        if m[1]:
            k = stack.last((tag,))
            if k < 0:
                if tag == "p":
                    flush()
            elif tag in _blocks or not stack.blocks_from(k):
                if stack.blocks_from(k):
                    flush()
                stack.cut(k)
            continue
        if tag in _void:
            if tag == "hr":
                flush()
            elif tag in ("br", "wbr"):
                pieces.append(" " if tag == "br" else "")
            continue
        if tag in _blocks:
            flush()
            block = stack.rows[-1][3] if stack.rows else -1
            if block >= 0 and stack.rows[block][0] == "p":  # a block start closes an open p
                stack.cut(block)
            if tag in CLOSES:
                ends, stop = CLOSES[tag]
                k = stack.first_after(ends, stack.last(stop))
                if k >= 0:
                    stack.cut(k)
        if tag in _raw and not m[0].endswith("/>"):
            if tag in RAW_CDATA:
                skip_to = tag
                continue
        label, bad = _label(tag, m[3] or "", bool(stack.rows and stack.rows[-1][2]))
        if bad and tag == "header" and stack.at.get("article"):
            bad = False  # an article's own header: its headings are text
        path = stack.push(tag, label, bad or tag in _raw)
        if tags is not None and tag in _blocks:
            tags.append((len(out), path, stack.rows[-1][5]))
    flush()
    return out


def token(place: Place, text: str) -> int:
    return hash_of(f"{place[0]}\x00{text}")


def tokens_of(page: str) -> tuple[list[tuple[Place, str, bool]], list[int]]:
    """The blocks of a page, and all its tokens in order: starts of block elements and texts."""
    tags: list[tuple[int, int, bool]] = []
    parts = blocks(page, tags)
    marks, k = [], 0
    for i, (place, text, _) in enumerate(parts):
        while k < len(tags) and tags[k][0] <= i:
            marks.append(tags[k][1])
            k += 1
        marks.append(token(place, text))
    return parts, marks + [t[1] for t in tags[k:]]


def nested(classes: list[list[int]], first: dict[int, int]) -> list[list[int]]:
    """The classes that are valid on a page, given the place of each token's first occurrence.

    A class is valid where its tokens stand in the template's order and where it nests: against
    every valid class of more tokens it lies in one slot of that class, outside it, or around it.
    """
    valid: list[list[int]] = []
    spans: list[list[int]] = []
    for members in sorted(classes, key=lambda c: (-len(c), c)):
        at = [first[t] for t in members if t in first]
        if not at or any(x >= y for x, y in zip(at, at[1:], strict=False)):
            continue
        if all(_nests(at, other) for other in spans):
            valid.append(members)
            spans.append(at)
    return valid


def _nests(inner: list[int], outer: list[int]) -> bool:
    """Whether all of one class stands between two neighbouring tokens of the other, or before or behind it."""
    return bisect_left(outer, inner[0]) == bisect_left(outer, inner[-1]) or bisect_left(inner, outer[0]) == bisect_left(inner, outer[-1])


def text_of(page: str, classes: list[list[int]]) -> str:
    """What stands in the slots of a page: the texts that are no token of a valid class.

    On pages where a class isn't valid it is no template and its texts stay. Where nothing would be
    left of the article, the main region or, without them, of the page, all of it stays.
    """
    parts, marks = tokens_of(page)
    first: dict[int, int] = {}
    for k, t in enumerate(marks):
        first.setdefault(t, k)
    fixed = {t for members in nested(classes, first) for t in members}
    content = [(place, text, token(place, text) in fixed) for place, text, bad in parts if not bad]
    for root in (1, 2):
        inside = [c for c in content if c[0][1] & root]
        if inside:
            content = inside
            break
    kept = [text for _, text, out in content if not out]
    return "\n".join(kept or [text for _, text, _ in content])


def template_of(tokens: DataFrame, hosts: DataFrame) -> DataFrame:
    """host and its classes array<array<long>>: tokens with equal occurrence vectors, in page order.

    tokens: host, token, n (occurrences on the page), page, place, body; hosts: host and page (a hash
    of its html) of every row. Rows with equal html are one page. What stands in an article or main
    region (body) is text on however many pages.
    """
    tokens = tokens.dropDuplicates(["host", "token", "page"])
    vector = F.sum(F.pmod(F.xxhash64("page", "n"), F.lit(1 << 31)))
    seen = tokens.groupBy("host", "token").agg(F.count("*").alias("pages"), vector.alias("vector"), F.avg("place").alias("place"), F.max("body").alias("body"))
    sizes = hosts.distinct().groupBy("host").agg(F.count("*").alias("of"))
    enough = ~F.col("body") & (F.col("pages") >= SHARE * F.col("of"))
    # At most a page's tokens / SHARE of a host get here, however many pages it has.
    classes = seen.where(F.col("pages") >= LEAST_PAGES).join(sizes, "host").where(enough).groupBy("host", "vector").agg(F.array_sort(F.collect_list(F.struct("place", "token"))).alias("members"))
    return classes.groupBy("host").agg(F.collect_list(F.transform("members", lambda m: m["token"])).alias("classes"))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars.

    A null html is empty and gives an empty text; pages with a null url share the empty host;
    repeated rows are extracted each for itself; an empty table gives an empty result. Pages are
    read whole. Other columns are neither read nor returned. Templates are broadcast while they
    are few; beyond BROADCAST_CLASSES they are joined on host and a salt.
    """
    spark = pages.sparkSession
    prepare(spark)
    kind = pages.schema[id_col].dataType.simpleString()
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text_or_empty(html_col).alias("html"))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts, marks = tokens_of(page)
                of_text = {token(place, text): (place, bad) for place, text, bad in parts}
                seen: dict[int, list] = {}
                for k, t in enumerate(marks):
                    place, bad = of_text.get(t, (_SEED, False))
                    if not bad:
                        seen.setdefault(t, [0, k, place[1] > 0])[0] += 1
                key = hash_of(page)
                rows += [(host, t, n, key, k, body) for t, (n, k, body) in seen.items()]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["host", "token", "n", "page", "place", "body"])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text_of(page, classes or []) for page, classes in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    host = url_host(F.col("url"))
    made = source.select(host.alias("host"), "html").mapInArrow(tokens, "host string, token long, n int, page long, place int, body boolean")
    template = materialize(template_of(made, source.select(host.alias("host"), F.xxhash64("html").alias("page"))), "html-template")
    size = template.agg(F.coalesce(F.sum(F.aggregate("classes", F.lit(0), lambda a, c: a + F.size(c))), F.lit(0))).first()[0]
    hosted = source.withColumn("host", host)
    if size <= BROADCAST_CLASSES:
        joined = hosted.join(F.broadcast(template), "host", "left")
    else:
        salted = hosted.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
        copies = template.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = salted.join(copies, ["host", "salt"], "left")
    return joined.select("page_id", "url", "html", "classes").mapInArrow(extract, f"page_id {kind}, url string, text string, n_chars long")


def op7_html_text(spark, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
