"""Main text of HTML pages: site templates are element subtrees that recur over many pages of a host."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.common import small, stored, texts_of

#: A subtree is a template if it is on so many pages of the host with different main texts, however large the host is.
MIN_PAGES, MIN_SHARE = 10, 0.0
#: A paragraph, list or heading inside an article is one if, moreover, it is on this share of the host's pages: a notice stands on
#: nearly all of them, while a passage that many articles quote does not.
PROSE_SHARE = 0.5
#: Subtrees nested deeper than so many block containers, as browsers nest elements, are hashed with the container around them only.
DEPTH = 512

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg math object canvas audio video select datalist".split())
BLOCKS = frozenset(("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                    "head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul").split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose subtrees are hashed; those of the second row count as prose inside an article or main.
CONTAINERS = frozenset("aside details dialog div fieldset footer form header menu nav section".split())
PROSE = frozenset("blockquote dl figure ol p pre table ul".split()) | HEADINGS
#: An open element of the second kind ends where one of the first kind begins.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
          "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": set(), "tbody": {"table"}, "tfoot": {"table"}}

#: What is never main text, by element and by role; for subtrees that do not recur. The words of class or id are only
#: a hint: they count for subtrees without article or main, up to NAMED_SHARE of the page's text in all.
NAMED_SHARE = 0.5
ASIDE_TAGS = frozenset("aside button footer head header menu nav search".split())
#: These too, but for an article or main inside them if the page has none elsewhere: some servers wrap whole pages in a form.
WRAPPER_TAGS = frozenset("dialog fieldset form".split())
ASIDE_WORDS = frozenset(("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright disqus "
                         "footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promotion recommended "
                         "related replies respond share sharing sidebar signup skip social sponsor sponsored subscribe toolbar topbar widget").split())
ASIDE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*'|["'])*+)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|[\s/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$)""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"\d+")
#: Letters for digits, so that hashes inside hashes stay as they are when numbers are folded.
_LETTERS = str.maketrans("0123456789", "ghijklmnop")


def attributes(text: str) -> dict[str, str]:
    """The attributes that matter here."""
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)} if text else {}


def set_aside(tag: str, own: dict[str, str], in_article: bool) -> int:
    """2 if an element's subtree cannot be main text, whatever it holds; 1 if only an article or main in it can; else 0."""
    if tag in ASIDE_TAGS:
        return 0 if tag == "header" and in_article else 2
    if own and tag not in ("html", "body", "main"):
        if "hidden" in own or own.get("aria-hidden", "").lower() == "true" or "display:none" in own.get("style", "").replace(" ", "").lower():
            return 2
        if own.get("role", "").lower() in ASIDE_ROLES:
            return 1 if own["role"].lower() in WRAPPER_TAGS else 2
    return int(tag in WRAPPER_TAGS)


def named_aside(tag: str, own: dict[str, str]) -> bool:
    """Whether an element's class or id has a word for what stands beside the main text."""
    if not own or tag in ("html", "body", "main", "article") or own.get("role", "").lower() == "main":
        return False
    words = {w.lower() for name in ("class", "id") for w in _WORDS.findall(own.get(name, ""))}
    return bool(words & (ASIDE_WORDS - {"header", "banner"} if tag in HEADINGS else ASIDE_WORDS))


class _Open:
    __slots__ = ("tag", "aside", "spared", "article", "main", "node", "parts", "own", "named")

    def __init__(self, tag: str, aside: int, spared: bool, article: int, main: bool, node: int, parts: list | None, own: str, named: tuple[int, ...]):
        self.tag, self.aside, self.spared, self.article, self.main, self.node, self.parts, self.own, self.named = tag, aside, spared, article, main, node, parts, own, named


class Page:
    """Blocks of text of one page, and the hashes of its container subtrees.

    ``blocks`` holds [text, set aside, article number or 0, in main, container nodes around, named elements around]; ``hashes`` the
    hash of each container node: its tag, class, id and role, the text (digits as 0, but in prose) and elements inside; ``prose``
    whether it is prose inside an article or main.
    """

    def __init__(self, html: str):
        self.blocks: list[list] = []
        self.hashes: list[int] = []
        self.prose: list[bool] = []
        self.articles = 0
        self.whole: list[bool] = []     # of each named element, whether it holds an article or main
        self.stack = [_Open("", 0, False, 0, False, -1, None, "", ())]
        self.text: list[str] = []
        self.header = 0
        at = 0
        match = _TAG.search(html)
        while match:
            self._text(html[at:match.start()])
            at = match.end()
            if match[2]:
                tag = match[2].lower()
                if match[1]:
                    self._end(tag)
                elif tag in RAW:
                    if not match[3].endswith("/") or tag not in ("svg", "math"):
                        close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                        at = close.end() if close else len(html)
                elif tag in VOID:
                    if tag == "hr":
                        self._flush()
                    else:
                        self.text.append(" " if tag in ("br", "wbr") else "")
                else:
                    self._start(tag, attributes(match[3]))
            match = _TAG.search(html, at)
        self._text(html[at:])
        self._flush()
        while len(self.stack) > 1:
            self._pop()
        # articles inside a wrapper count if there is no other one
        others = any(not b[1] and b[1] is not None and (b[2] or b[3]) for b in self.blocks)
        for b in self.blocks:
            b[1] = others if b[1] is None else b[1]
        self._set_named_aside()

    def _set_named_aside(self) -> None:
        """Set the smallest named elements aside, up to the share of the text that is not set aside yet."""
        chars: dict[int, int] = {}
        for text, aside, *_, named in self.blocks:
            for i in () if aside else named:
                chars[i] = chars.get(i, 0) + len(text)
        left = NAMED_SHARE * sum(len(b[0]) for b in self.blocks if not b[1])
        for i in sorted(chars, key=lambda i: (chars[i], -i)):
            if not self.whole[i]:
                inside = [b for b in self.blocks if not b[1] and i in b[5]]
                left -= sum(len(b[0]) for b in inside)
                if left < 0:
                    return
                for b in inside:
                    b[1] = True

    def _text(self, raw: str) -> None:
        if raw:
            text = unescape(raw) if "&" in raw else raw
            self.text.append(text)
            if (parts := self.stack[-1].parts) is not None:
                parts.append(" ".join(text.split()))

    def _flush(self) -> None:
        text = " ".join("".join(self.text).split())
        self.text = []
        if text:
            top = self.stack[-1]
            around = [e.node for e in self.stack if e.node >= 0]
            # of an article's own header only the headings are main text
            aside = top.aside or self.header and not any(e.tag in HEADINGS for e in self.stack)
            self.blocks.append([text, True if aside else None if top.spared else False, top.article, top.main, around, top.named])

    def _start(self, tag: str, own: dict[str, str]) -> None:
        if tag in BLOCKS:
            self._flush()
            self._close({"p"}, {"article", "td", "th", "button", "body"})
        if tag in CLOSES:
            self._close(CLOSES[tag], SCOPES[tag])
        up = self.stack[-1]
        aside, article, spared = max(up.aside, set_aside(tag, own, up.article > 0)), up.article, up.spared
        starts_main = tag == "main" or own.get("role", "").lower() == "main"
        if aside == 1 and (tag == "article" or starts_main):
            aside, spared = 0, True
        if tag == "article" and not article and not aside:
            self.articles += 1
            article = self.articles
        main = up.main or starts_main
        if article > up.article or main and not up.main:
            for i in up.named:
                self.whole[i] = True
        named = up.named
        if not aside and named_aside(tag, own):
            named = (*named, len(self.whole))
            self.whole.append(False)
        node, parts = -1, None
        if tag in CONTAINERS or tag in PROSE:
            if sum(e.node >= 0 for e in self.stack) < DEPTH:
                node, parts = len(self.hashes), []
                self.hashes.append(0)
                self.prose.append(tag in PROSE and bool(article or main))
        if parts is None and up.parts is not None:
            parts = []
        if tag == "header" and article:
            self.header += 1
        self.stack.append(_Open(tag, aside, spared, article, main, node, parts, f"{tag} {own.get('class', '')} {own.get('id', '')} {own.get('role', '')}", named))

    def _end(self, tag: str) -> None:
        if tag in BLOCKS:
            self._flush()
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                while len(self.stack) > i:
                    self._pop()
                return
            # an end tag of an inline element doesn't reach out of a block
            if tag not in BLOCKS and self.stack[i].tag in BLOCKS:
                return

    def _close(self, tags: set[str], scope: set[str]) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                while len(self.stack) > i:
                    self._pop()
                return
            if self.stack[i].tag in scope or self.stack[i].tag in CONTAINERS:
                return

    def _pop(self) -> None:
        self._flush() if self.stack[-1].tag in BLOCKS else None
        done = self.stack.pop()
        if done.tag == "header" and done.article:
            self.header -= 1
        if done.parts is None:
            return
        above = self.stack[-1].parts
        if done.node < 0:
            if above is not None:
                above.extend([done.own, *done.parts, ""])
            return
        whole = "\0".join([done.own, *done.parts])
        # in templates numbers vary (dates, counts); prose is compared as it is
        folded = xxhash.xxh64_intdigest(_DIGITS.sub("0", whole).encode("utf-8", "surrogatepass"))
        value = xxhash.xxh64_intdigest(("prose " + whole).encode("utf-8", "surrogatepass")) if self.prose[done.node] else folded
        self.hashes[done.node] = value - (1 << 64) if value >> 63 else value
        if above is not None:
            above.append(f"{folded:x}".translate(_LETTERS))

    def open_blocks(self) -> list[tuple[str, int, list[int]]]:
        """(text, place, hashes around) of what is not set aside; place is 2 in an article, 1 in main, else 0."""
        return [(b[0], 2 if b[2] else int(b[3]), [self.hashes[n] for n in b[4]]) for b in self.blocks if not b[1]]


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without one."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def parsed_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, content, subtrees, prose, blocks) per row of ``pages``.

    ``content`` is a hash of the text in articles and main (else of all), ``subtrees`` the hashes of all container subtrees but the
    prose in articles, ``prose`` those of that, and ``blocks``
    has each block's text that is not set aside, its place (2 in an article, 1 in main, else 0) and the hashes of the containers around it.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for html in texts_of(batch["html"]):
                page = Page(html)
                blocks = page.open_blocks()
                least = min(1, max((place for _, place, _ in blocks), default=0))
                content = xxhash.xxh64_intdigest("\n".join(t for t, place, _ in blocks if place >= least).encode("utf-8", "surrogatepass")) >> 1
                subtrees = [sorted({h for h, prose in zip(page.hashes, page.prose, strict=True) if prose == kind}) for kind in (False, True)]
                out.append((content, *subtrees, [{"text": t, "place": place, "around": h} for t, place, h in blocks]))
            yield batch.drop(columns="html").assign(content=[x[0] for x in out], subtrees=[x[1] for x in out], prose=[x[2] for x in out], blocks=[x[3] for x in out])

    url = F.col("url").cast("string")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), F.col("html").cast("string").alias("html"), host_of(url).alias("host"))
    return rows.mapInPandas(run, "page_id long, url string, host string, content long, subtrees array<long>, prose array<long>, blocks array<struct<text:string,place:int,around:array<long>>>")


def templates(subtrees: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, subtree) that recur over pages of the host with different main texts.

    Copies of a page count once. Both counts are taken over distinct rows first, so a host with a third of all
    pages spreads over all tasks.
    """
    per_host = subtrees.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    on = subtrees.select("host", "subtree", "content").distinct().groupBy("host", "subtree").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    return on.join(per_host, "host").where(F.col("n") >= min_share * F.col("pages")).select("host", "subtree")


def main_texts(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, prose_share: float = PROSE_SHARE) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages`` (page_id, url, html).

    Subtrees that recur across many pages of a host are deleted (prose inside an article if it is on ``prose_share`` of
    them); navigation, header, footer and aside elements, forms and hidden ones go too, small elements whose class or
    id names such things, scripts, styles and markup. From what is left, the blocks in all articles of the page (else
    those in main, else all) are joined by \\n, with character references decoded and white space inside a block as one
    space. An article in a form, dialog or fieldset counts if the page has no other.

    Null html is empty and gives an empty text; a null url is a host of its own (the empty one). Repeated rows
    give equal results and count as one page. Other columns are ignored; an empty table gives an empty result.
    """
    parsed = stored(parsed_pages(pages))
    found = templates(parsed.select("host", "content", F.explode("subtrees").alias("subtree")), min_pages, min_share)
    found = stored(found.unionByName(templates(parsed.select("host", "content", F.explode("prose").alias("subtree")), min_pages, prose_share)).distinct())
    # what a page loses depends on its host and the containers around its blocks alone
    around = F.array_distinct(F.flatten(F.transform("blocks", lambda b: b["around"])))
    parsed = parsed.withColumn("around", around)
    used = parsed.select("host", "around", F.explode("around").alias("subtree"))
    gone = stored(used.join(small(found), ["host", "subtree"]).groupBy("host", "around").agg(F.collect_set("subtree").alias("gone")))
    kept = F.filter("blocks", lambda b: ~F.coalesce(F.arrays_overlap(b["around"], F.col("gone")), F.lit(False)))
    best = F.array_max(F.transform("kept", lambda b: b["place"]))
    text = F.array_join(F.transform(F.filter("kept", lambda b: b["place"] == best), lambda b: b["text"]), "\n")
    rest = parsed.join(small(gone, F.size("around") + F.size("gone")), ["host", "around"], "left").withColumn("kept", kept)
    return rest.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
