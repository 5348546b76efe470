"""HTML extraction by site template removal.

Every element subtree of a page gets a hash. Spark counts for each host on how many different pages
a subtree stands, and subtrees that recur on many pages of their host are deleted. What is left of
the article - or of the body where there is none - loses elements whose tag or role says that they
are no main text, or whose class or id names nothing else, and becomes blocks of text. Pages are read
in time linear in their length, whatever their markup."""

from __future__ import annotations

import bisect
import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

# Element names and class words of HTML pages.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr blockquote pre figcaption caption".split())
OUTSIDE = frozenset(
    "script style noscript template nav footer aside form button select textarea iframe svg canvas object applet audio video menu dialog head title datalist input option map math noembed noframes".split()
)
WHOLE = frozenset("html body main article".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner banners sponsor sponsored promo promotion nav navbar navigation menu menus topbar masthead header footer "
    "sidebar sidebars widget widgets cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login search breadcrumb breadcrumbs "
    "pagination pager share sharing social comment comments disqus replies respond related recommended recommendations trending toolbar".split()
)
#: Words that say where an element stands, not what it is.
PLACES = frozenset(
    "main site page post posts article articles block box container wrapper section area bar panel list item items link links group inner outer content top bottom left right side module region box1 js".split()
)
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}

_OPEN = re.compile(rf"<!--|<[!?]|<({'|'.join(sorted(RAW))})(?![^\s/>])|<(/?)([a-z][^\s/>]*)", re.I)
#: The rest of a tag up to its close, quoted stretches whole; tried on so many characters.
_REST, _NEAR = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"), 256
_QUOTE = re.compile(r"[>\"']")
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

#: A subtree is a template from this many different pages of its host on if they are this share of
#: them, or MANY at any share; inside an article only from the larger share on.
LEAST_PAGES, SHARE, ARTICLE_SHARE, MANY = 5, 0.05, 0.5, 200
#: Levels up to which an element's start looks for those it closes.
_LEVELS = 64
#: Most template subtrees that are broadcast (8 bytes each); beyond it the join is salted instead.
BROADCAST_ROWS, SALTS = 1 << 20, 64


class _Closes:
    """Where tags of a source close, if quoted stretches are skipped: found for all places at once, from
    the end to the start."""

    def __init__(self, source: str):
        self.at = [m.start() for m in _QUOTE.finditer(source)]
        self.close: list[int] = [-1] * (len(self.at) + 1)  # from the k-th sign on; -1 where a quote stays open
        after = {'"': -1, "'": -1}
        for k in range(len(self.at) - 1, -1, -1):
            sign = source[self.at[k]]
            if sign == ">":
                self.close[k] = self.at[k]
            else:
                self.close[k] = self.close[after[sign] + 1] if after[sign] >= 0 else -1
                after[sign] = k

    def find(self, at: int) -> int:
        return self.close[bisect.bisect_left(self.at, at)]


class Page:
    """Elements of a page in order of their start tags, and its events: a text (str), an element's
    start (its number) or its end (the complement of it)."""

    def __init__(self, source: str):
        self.tags, self.attrs, self.parents, self.hashes, self.events = [], [], [], [], []
        self._stack: list[int] = []
        self._parts: list[list[bytes]] = [[]]
        self._open: list[Counter] = [Counter()]  # open elements by tag, anew in each whole one
        self._open_p = at = 0
        done, last, closes = 0, source.rfind(">"), None
        while m := _OPEN.search(source, at):
            at, raw, tag = m.end(), m[1], m[3]
            if not raw and not tag:
                end = source.find("-->" if m[0] == "<!--" else ">", at)
                stop = len(source) if end < 0 else end + (3 if m[0] == "<!--" else 1)
            else:
                if at > last:
                    break  # no tag closes any more
                if near := _REST.match(source, at, min(len(source), at + _NEAR)):
                    stop = near.end()
                else:
                    closes = closes or _Closes(source)
                    end = closes.find(at)
                    stop = (end if end >= 0 else source.find(">", at)) + 1
            if m.start() > done:
                self._text(source[done : m.start()])
            if raw:
                self._start(raw.lower(), source[at : stop - 1])
                end = _RAW_END[raw.lower()].search(source, stop)
                self._parts[-1].append(source[stop : end.start() if end else len(source)].encode("utf-8", "surrogatepass"))
                self._pop()
                stop = end.end() if end else len(source)
            elif tag and m[2]:
                self._end(tag.lower())
            elif tag:
                self._start(tag.lower(), source[at : stop - 1])
            done = at = stop
        if done < len(source):
            self._text(source[done:])
        while self._stack:
            self._pop()

    def _text(self, raw: str) -> None:
        text = entities.unescape(raw) if "&" in raw else raw
        self.events.append(text)
        if words := text.split():
            self._parts[-1].append(" ".join(words).encode("utf-8", "surrogatepass"))

    def _pop(self) -> None:
        number, parts = self._stack.pop(), self._parts.pop()
        tag = self.tags[number]
        if tag in WHOLE:
            self._open.pop()
        self._open[-1][tag] -= 1
        self._open_p -= tag == "p"
        self.events.append(~number)
        if parts:
            digest = xxhash.xxh64_digest(b"\0".join([tag.encode(), *parts]))
            self.hashes[number] = int.from_bytes(digest)
            self._parts[-1].append(digest)

    def _start(self, tag: str, attrs: str) -> None:
        if self._open_p and tag not in INLINE and tag not in VOID:
            self._close({"p"}, {"button", "object", "table"})
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        number = len(self.tags)
        self.tags.append(tag)
        self.attrs.append(attrs)
        self.parents.append(self._stack[-1] if self._stack else -1)
        self.hashes.append(0)
        self.events.append(number)
        if tag in VOID:
            self.events.append(~number)
            return
        self._open_p += tag == "p"
        self._open[-1][tag] += 1
        if tag in WHOLE:
            self._open.append(Counter())
        self._stack.append(number)
        self._parts.append([])

    def _close(self, names: set[str], scope: set[str]) -> None:
        deep = None
        for k in range(len(self._stack) - 1, max(-1, len(self._stack) - 1 - _LEVELS), -1):
            tag = self.tags[self._stack[k]]
            if tag in names:
                deep = k
            elif tag in scope:
                break
        while deep is not None and len(self._stack) > deep:
            self._pop()

    def _end(self, tag: str) -> None:
        if not self._open[-1][tag] and not (tag in WHOLE and any(c[tag] for c in self._open[-_LEVELS:])):
            return
        while self._stack:
            have = self.tags[self._stack[-1]]
            self._pop()
            if have == tag:
                return

    def inside(self, names: frozenset[str] | set[str]) -> list[bool]:
        out: list[bool] = []
        for tag, parent in zip(self.tags, self.parents):
            out.append(tag in names or parent >= 0 and out[parent])
        return out

    def blocks(self, skip: list[bool], only: list[bool] | None = None) -> Iterator[str]:
        """Text of each block, white space made one space; without the elements of skip, and of
        those of only alone."""
        text, stack, hidden, tags = [], [], 0, self.tags
        for e in self.events:
            if isinstance(e, str):
                if not hidden and (only is None or stack and only[stack[-1]]):
                    text.append(e)
                continue
            number = e if e >= 0 else ~e
            if text and (tags[number] not in INLINE or skip[number]):
                if done := " ".join("".join(text).split()):
                    yield done
                text = []
            if e >= 0:
                stack.append(number)
                hidden += skip[number]
            else:
                stack.pop()
                hidden -= skip[number]
        if done := " ".join("".join(text).split()):
            yield done


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(raw)} if raw.strip(" /") else {}


def subtrees(page: Page) -> dict[int, bool]:
    """Hashes of the page's subtrees, with whether they stand in an article."""
    article = page.inside({"article", "main"})
    found: dict[int, bool] = {}
    for k, h in enumerate(page.hashes):
        if h and page.tags[k] not in WHOLE and page.tags[k] not in INLINE:
            found[h] = found.get(h, True) and article[k]
    return found


def _named(attributes: dict[str, str], inner: bool, tag: str) -> bool:
    """Whether a class or id says that an element is no main text. Inside an article the whole name has
    to say so: `related-posts` does, `related-work` does not."""
    for key in ("class", "id"):
        for name in attributes.get(key, "").split():
            words = {w.lower() for w in _WORD.findall(name)}
            if words & WORDS and (words <= WORDS | PLACES if inner or tag == "article" else True):
                return True
    return False


def main_text(page: Page, templates: dict[int, bool] | None = None) -> str:
    """Text of the page's main blocks, joined by a space. templates: hashes of subtrees to delete,
    with whether they go inside articles too."""
    templates, article = templates or {}, page.inside({"article", "main"})
    skip, hidden = [], []
    for k, tag in enumerate(page.tags):
        inner = page.parents[k] >= 0 and article[page.parents[k]]
        gone = tag in OUTSIDE or tag == "header" and not inner
        if not gone and page.hashes[k] in templates and tag not in WHOLE:
            gone = templates[page.hashes[k]] or not inner
        if not gone and (a := _attributes(page.attrs[k])):
            gone = tag not in ("html", "body", "main", "h1", "h2", "h3") and _named(a, inner, tag)
            gone = gone or a.get("role", "").lower() in ROLES or "hidden" in a or a.get("aria-hidden", "").lower() == "true"
        skip.append(gone)
        hidden.append(gone or page.parents[k] >= 0 and hidden[page.parents[k]])
    shown = any(a and not h for a, h in zip(article, hidden))
    return " ".join(page.blocks(skip, article if shown else None))


def extract_text(
    pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    least_pages: int = LEAST_PAGES, share: float = SHARE, article_share: float = ARTICLE_SHARE, many: int = MANY, broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """(id_col, url_col, text, n_chars) of every page.

    A subtree is a template of its host where at least least_pages different pages hold it, and either
    `share` of the host's or `many` at any share; one that stands only in articles goes from there
    where article_share of the host's pages have it. Pages of equal html count once, so a page that a
    host repeats makes no template of its article. A null or empty html gives an empty text; a null
    url or one without a host has no templates; repeated rows each give a row; an empty table gives
    none; other columns are ignored, whatever their names. Pages are read whole, in linear time; a tag
    that never closes is text, and a quote that never closes ends with its tag."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "html")
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("u"), F.coalesce(F.col(html_col), F.lit("")).alias("h"), F.when(host != "", F.xxhash64(host)).alias("host"))

    def hash_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[tuple[int, int, int, bool]] = set()
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found, sign = subtrees(Page(source)), xxhash.xxh64_intdigest(source.encode("utf-8", "surrogatepass"))
                seen.add((host, 0, sign, True))
                seen.update((host, h, sign, inner) for h, inner in found.items())
            cols = [pa.array([x[k] for x in seen], pa.int64() if k == 0 else pa.uint64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([cols[0], cols[1].view(pa.int64()), cols[2].view(pa.int64()), pa.array([x[3] for x in seen], pa.bool_())], ["host", "hash", "sign", "inner"])

    each = rows.where("host is not null").select("host", "h").mapInArrow(hash_all, "host long, hash long, sign long, inner boolean")
    counts = each.groupBy("host", "hash", "sign").agg(F.min("inner").alias("inner")).groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n"), F.min("inner").alias("inner"))
    counts = scratch.write(counts.where((F.col("n") >= least_pages) | (F.col("hash") == 0)), "counts")
    size = counts.where("hash = 0").select("host", F.col("n").alias("pages"))
    often = counts.where("hash <> 0").join(size, "host").where((F.col("n") >= F.col("pages") * share) | (F.col("n") >= many))
    often = scratch.write(often.select("host", "hash", (F.col("n") >= F.col("pages") * article_share).alias("all")), "templates")
    scratch.drop("counts")
    lists = often.groupBy("host").agg(F.collect_list("hash").alias("gone"), F.collect_list("all").alias("gone_all"))  # at most a page's subtrees / share, and the host's subtrees on `many` pages
    if often.count() <= broadcast_rows:
        rows = rows.join(F.broadcast(lists), "host", "left")
    else:
        salt = F.pmod(F.xxhash64("id", "u"), F.lit(SALTS))
        lists = lists.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        rows = rows.withColumn("salt", salt).join(lists, ["host", "salt"], "left")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, last, gone = [], None, {}
            for host, source, hashes, inner in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4, 5))):
                if host != last:
                    last, gone = host, {h & 0xFFFFFFFFFFFFFFFF: a for h, a in zip(hashes or (), inner or ())}
                texts.append(main_text(Page(source), gone))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "u", "text", "n_chars"])

    id_type, url_type = (pages.schema[c].dataType.simpleString() for c in (id_col, url_col))
    out = rows.select("id", "u", "host", "h", "gone", "gone_all").mapInArrow(read, f"id {id_type}, u {url_type}, text string, n_chars long")
    return out.withColumnsRenamed({"id": id_col, "u": url_col})
