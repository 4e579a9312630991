"""Main text of web pages by site template removal.

Every element subtree of a page gets a hash of its tags, classes and texts.
Spark counts, for each host, on how many different pages a hash occurs; what
recurs on many of them is the site's template and is deleted.  Pages with the
same content count once, so that an article that a site shows under many
addresses is not taken for a template.  Inside <article> or <main> plain
paragraphs and headings are never deleted for recurring.

Counting cannot tell hosts with few pages, nor what changes from page to page
(rotating adverts, menus with links to other pages).  There the element tells:
navigation, asides, forms and the like by their tags, and others by words in
class, id and role.  Outside an article any word of a name counts, but for the
header of a post; inside one a whole name such as class="ad" and the first or
last word of a compound such as "comment-list", but for those that only say
what is beside them ("has-sidebar"); paragraphs, headings and list items go by
the few names of adverts alone.  On a page with an <article> or <main> that is
not itself in such an element, the text outside it is not the main text, unless
the paragraphs there are longer than all that the articles hold: then these are
teasers, and all stays.

A host's templates are few: a subtree must be on ``MIN_SHARE`` of its pages, so
there are at most (subtrees per page) / MIN_SHARE.  They go to all tasks if
they are counted and few, and otherwise meet the pages in a join on host and
salt, so that the pages of a hot host are dealt out like others.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundalake.llm.common import cut, small

MIN_PAGES = 4
MIN_SHARE = 0.05
#: Parts of a host's pages in the join.
SALTS = 16

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.I)
_WORDS = re.compile(r"[a-z]+")

#: Names of elements, and words in class, id and role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
SKIP = RAW | frozenset("head nav aside footer form button select svg canvas object audio video dialog menu label".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote li dd dt td th figcaption".split())
BOILERPLATE = frozenset("ad ads advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer gdpr header login masthead menu menus modal nav navbar navigation newsletter notice notices pagination pager popup popups promo promoted promotion related replies share sharing sidebar sidebars signup social sponsor sponsored subscribe subscription toolbar widget widgets complementary contentinfo search".split())
#: Of these, the whole names that tell inside an article, and those that tell on paragraphs and the like.
INSIDE = BOILERPLATE - frozenset("header search notices masthead complementary contentinfo replies".split())
ADVERT = frozenset("ad ads advert adverts advertisement advertising sponsored".split())
#: Words that make a header one of the text, and words that begin names of what surrounds the text.
OF_TEXT = frozenset("post entry article story content".split())
BESIDE = frozenset("no has with without is before after main body content".split())
#: Which open elements a start tag ends.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_LIMITS = frozenset("ul ol dl table div section article main body html td th".split())
_STOPS = _LIMITS | SKIP


class Page:
    """The elements of a page in the order of their start tags, and its texts between block boundaries."""

    def __init__(self, html: str) -> None:
        self.tag, self.parent, self.names, self.hidden = [""], [-1], [""], [False]
        self.items: list[tuple[int, str] | None] = []  # None: a block begins or ends
        self.parts: list[list[str]] = [[]]
        self.hash = [0]
        self._parse(html)

    def _parse(self, html: str) -> None:
        stack, at, n, last = [0], 0, len(html), html.rfind(">")
        self.open: dict[str, list[int]] = {}  # the depths of the open elements of each name
        self.limits, self.stops = [0], [0]  # the depths of those in _LIMITS, and in _STOPS
        while at < n:
            lt = html.find("<", at)
            if lt < 0:
                self._text(stack[-1], html[at:])
                break
            if lt > at:
                self._text(stack[-1], html[at:lt])
            if html.startswith("<!--", lt):
                end = html.find("-->", lt + 4)
                at = n if end < 0 else end + 3
                continue
            if html.startswith(("<!", "<?"), lt):
                end = html.find(">", lt)
                at = n if end < 0 else end + 1
                continue
            m = _TAG.match(html, lt) if lt < last else None
            if not m:
                self._text(stack[-1], "<")
                at = lt + 1
                continue
            at = m.end()
            closing, name, rest = m.group(1, 2, 3) if m.group(2) else m.group(4, 5, 6)
            name = name.lower()
            if closing:
                self._close(stack, name)
                continue
            if name == "br":
                self.items.append((stack[-1], " "))
                continue
            if name in BLOCK:
                self.items.append(None)
                self._imply(stack, name)
            if name in VOID:
                continue
            node = self._open(stack[-1], name, rest)
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
                at = end.end() if end else n
            elif not (rest.rstrip().endswith("/") and name in ("svg", "path")):
                for kind, depths in ((_LIMITS, self.limits), (_STOPS, self.stops)):
                    if name in kind:
                        depths.append(len(stack))
                self.open.setdefault(name, []).append(len(stack))
                stack.append(node)
        while len(stack) > 1:
            self._end(stack.pop())
        self.items.append(None)

    def _text(self, node: int, text: str) -> None:
        self.items.append((node, text))
        if not text.isspace():
            self.parts[node].append(text)

    def _open(self, parent: int, name: str, rest: str) -> int:
        names, hidden = "", False
        if rest and rest.strip():
            for k, a, b, c in _ATTRIBUTE.findall(rest):
                k, v = k.lower(), (a or b or c).lower()
                if k == "hidden" or (k == "aria-hidden" and v == "true"):
                    hidden = True
                elif k != "aria-hidden":
                    names += f" {v}"
        self.tag.append(name)
        self.parent.append(parent)
        self.names.append(names)
        self.hidden.append(hidden)
        self.parts.append([])
        self.hash.append(0)
        return len(self.tag) - 1

    def _end(self, node: int) -> None:
        name, depth = self.tag[node], self.open[self.tag[node]].pop()
        for kind, depths in ((_LIMITS, self.limits), (_STOPS, self.stops)):
            if name in kind and depths[-1] == depth:
                depths.pop()
        if parts := self.parts[node]:
            self.hash[node] = h = xxhash.xxh64_intdigest(f"{self.tag[node]}{self.names[node]}>{'|'.join(parts)}") or 1
            self.parts[self.parent[node]].append(f"{h:x}")
            self.parts[node] = []
        if self.tag[node] in BLOCK:
            self.items.append(None)

    def _close(self, stack: list[int], name: str) -> None:
        if not self.open.get(name):
            if name in ("br", "p"):
                self.items.append(None)
            return
        depth = self.open[name][-1]
        if name in BLOCK or depth >= self.limits[-1]:
            while len(stack) > depth:
                self._end(stack.pop())

    def _imply(self, stack: list[int], name: str) -> None:
        """A block ends an open paragraph; a list item ends the one before it; and so on."""
        wanted = CLOSES.get(name, set()) if name in ("option", "optgroup") else {"p"} | CLOSES.get(name, set())
        depth = max((self.open[x][-1] for x in wanted if self.open.get(x)), default=0)
        if depth and depth >= self.stops[-1]:
            while len(stack) > depth:
                self._end(stack.pop())

    def _marks(self) -> tuple[list[bool], list[bool]]:
        """Which elements are in an article, and which contain one."""
        n = len(self.tag)
        inside, holds, out = [False] * n, [False] * n, [False] * n
        for i in range(1, n):
            p = self.parent[i]
            out[i] = out[p] or (not inside[p] and (self.tag[i] in SKIP or self.hidden[i] or self._by_name(i)))
            inside[i] = inside[p] or (not out[i] and (self.tag[i] in ("article", "main") or "main" in self.names[i].split()))
        for i in range(n - 1, 0, -1):
            if holds[i] or (inside[i] and not inside[self.parent[i]]):
                holds[self.parent[i]] = True
        return inside, holds

    def _by_name(self, i: int, inside: bool = False) -> bool:
        """Whether the element's names tell that it is no main text."""
        if not self.names[i] or self.tag[i] in ("html", "body"):
            return False
        if self.tag[i] in PLAIN:
            return not ADVERT.isdisjoint(self.names[i].split())
        for name in self.names[i].split():
            words = _WORDS.findall(name)
            if name in (INSIDE if inside else BOILERPLATE):
                return True
            if inside and len(words) > 1 and words[0] not in BESIDE and (words[0] in INSIDE or words[-1] in INSIDE):
                return True
            if not inside and not BOILERPLATE.isdisjoint(words) and (OF_TEXT.isdisjoint(words) or not BOILERPLATE.isdisjoint(set(words) - {"header"})):
                return True
        return False

    def blocks(self, templates: frozenset[int] | set[int] = frozenset()) -> list[str]:
        """The texts that stay, without the subtrees whose hash is among ``templates``."""
        inside, holds = self._marks()
        gone = [False] * len(self.tag)
        for i in range(1, len(self.tag)):
            tag, within = self.tag[i], inside[self.parent[i]]
            drop = gone[self.parent[i]] or tag in SKIP or self.hidden[i]
            if not drop and not holds[i]:
                drop = self._by_name(i, within) or (tag == "header" and not within)
                if not drop and self.hash[i] in templates and self.deletable(i, inside, holds):
                    drop = True
            gone[i] = drop
        scoped = any(inside) and not self._teasers(inside, gone)
        out, line = [], []
        for item in self.items:
            if item is None:
                if line:
                    text = "".join(line)
                    if text := " ".join((unescape(text) if "&" in text else text).split()):
                        out.append(text)
                    line = []
            elif not gone[item[0]] and (inside[item[0]] or not scoped):
                line.append(item[1])
        return out

    def _teasers(self, inside: list[bool], gone: list[bool]) -> bool:
        """Whether the paragraphs outside the articles are longer than all texts inside."""
        within = around = 0
        for item in self.items:
            if item is not None and not gone[item[0]]:
                if inside[item[0]]:
                    within += len(item[1])
                elif self.tag[item[0]] in ("p", "pre", "blockquote"):
                    around += len(item[1])
        return around > within

    def deletable(self, i: int, inside: list[bool], holds: list[bool]) -> bool:
        if holds[i] or self.tag[i] in ("html", "body", "article", "main"):
            return False
        return not inside[i] or self.tag[i] not in PLAIN and self.tag[i] in BLOCK or bool(self.names[i])

    def candidates(self) -> set[int]:
        """Hashes of the subtrees that may be templates."""
        inside, holds = self._marks()
        return {self.hash[i] for i in range(1, len(self.tag)) if self.hash[i] and (self.tag[i] in BLOCK or self.names[i]) and self.deletable(i, inside, holds)}


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, contents, hashes = [], [], []
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            page = Page(html)
            content = _signed(xxhash.xxh64_intdigest("\n".join(page.blocks())))
            found = [0, *map(_signed, page.candidates())]
            hosts += [host] * len(found)
            contents += [content] * len(found)
            hashes += found
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(hashes, pa.int64()), pa.array(contents, pa.int64())], names=["host", "hash", "content"])


def host(url) -> F.Column:
    """Lower-case host of an address without user and port; empty if there is none."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, hashes): the subtrees that recur on many different pages of a host."""
    rows = pages.filter("html is not null").select(host(F.col("url")).alias("host"), "html").mapInArrow(_subtrees, "host string, hash long, content long")
    counts = cut(rows.groupBy("host", "hash").agg(F.countDistinct("content").alias("n")))
    total = counts.filter("hash = 0").select("host", F.col("n").alias("pages"))
    often = counts.filter((F.col("hash") != 0) & (F.col("n") >= min_pages)).join(total, "host").filter(F.col("n") >= min_share * F.col("pages"))
    return often.groupBy("host").agg(F.collect_list("hash").alias("hashes"))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, known = [], {}
        for html, where, hashes in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4)):
            if where not in known:
                known = {where: frozenset(h & ((1 << 64) - 1) for h in hashes.as_py() or ())}
            texts.append("\n".join(Page(html).blocks(known[where])) if html else "")
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(page_id, url, text, n_chars), a row per row of ``pages``.

    A null or empty html gives an empty text; a very long one is read whole, in
    time in proportion; pages without an address share the empty host; repeated
    rows give repeated rows; broken markup is read as far as it goes (unclosed
    elements end with their parent); other columns are ignored; an empty table
    gives an empty result.
    """
    known = cut(templates(pages, min_pages, min_share))
    rows = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    sent = small(known)
    if sent is known:
        sent = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "html"), F.lit(SALTS)).cast("int"))
    rows = rows.join(sent, [c for c in sent.columns if c != "hashes"], "left").select("page_id", "url", "html", "host", "hashes")
    return rows.mapInArrow(_texts, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
