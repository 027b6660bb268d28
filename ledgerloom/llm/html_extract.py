"""Main text of web pages by equivalence classes of tokens across the pages of a host.

A page is read once, as a sequence of tokens: element starts, named by their path, and text nodes, named by path and text. The
occurrence vector of a token has its count in each page of the host. Tokens of equal vectors form an equivalence class; a class is
kept if it is large (`least_tokens`) and frequent (`least_share` of the host's pages, at least `least_pages`), and on a page if its
tokens come in one order there. Classes nest into the host's template by the paths of their elements: elements that stand once on a page are the
template's slots, each within the one around it, and text nodes of a class are template text.

The slots that hold the article are deduced from the template, once per host: from the root on, the slot with most of the text that is neither
template text nor a link is entered, as long as it holds most of what the slot around it has (`main_slot`). Of slots that lie within one
another and hold nearly the same text, the page's own marks choose (`article`, `main`, names). Text outside the main slot and template text are
dropped, and of what lies inside, slots that are mostly links, and parts that are menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles or
reader comments by element, role or name: what readers write has the shape of an article, and no class can tell it apart.

A vector is represented by the number of pages and two sums of hashes of (row, count), which no order or grouping changes, so classes are found by
map-side combined groupings and no page list of a host is ever gathered; a host's template has at most the tokens that
`least_share` of its pages have. Templates meet their pages in SALTS parts, so that a host with a third of all pages is no single task.

Pages of hosts without a template (few pages, or pages that are mostly copies of one another, whose constant text may be their article) have
only their own marks. Defined results: null html is empty; null or odd urls have no host and no template; repeated rows get equal texts; a page
without its host's main slot is read by its own marks; very long pages are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import discard, split_rows, stored

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end when one of the elements beside them starts.
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table html body article section div main aside nav header footer form td th li".split())
#: Elements whose text is no part of an article.
APART = frozenset("head nav footer aside form script style noscript template iframe button select textarea svg canvas object audio video map menu dialog title".split())
APART_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
APART_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup "
    "modal overlay newsletter subscribe subscription signup login paywall sidebar widget menu nav navbar navigation breadcrumb breadcrumbs topbar footer masthead comment "
    "comments commentlist discussion replies reply respond disqus related recommended recommendations share sharing social toolbar pagination pager search skip".split()
)
MAIN_NAMES = frozenset("content main article post entry story".split())
SPACE = re.compile(r"\s+")
NAME = re.compile(r"[^a-z]+")


#: Pages of a host that a token of its template needs.
LEAST_PAGES = 4


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _token(text: str) -> int:
    return _signed(xxh64_intdigest(text.encode("utf-8", "surrogatepass")))


class Page(HTMLParser):
    """The elements of a page by path, and its text nodes in order."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool, int, bool]] = []  # element, path, whether apart, rank as a main part, whether in a link
        #: By path, a hash of the path around it and the element's name: the path around it, occurrences, place of the first one, characters of text within that are not apart, those in links, rank.
        self.elements: dict[int, list] = {}
        #: Text nodes: block, path, place, text, whether apart, rank.
        self.nodes: list[tuple[int, int, int, str, bool, int]] = []
        self.block, self.used, self.place = 0, False, 0
        self.state = (False, 0)
        self.feed(html)
        self.close()

    def _end_block(self) -> None:
        if self.used:
            self.block, self.used = self.block + 1, False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br" or tag in VOID:
            if tag == "hr":
                self._end_block()
            elif tag == "br" and self.used:
                self._add(" ")
            return
        if tag in BLOCKS:
            if any(t == "p" for t, *_ in self.open[-8:]):
                self._close("p", SCOPES)
            self._end_block()
        for k in range(len(self.open) - 1, -1, -1):
            other = self.open[k][0]
            if tag in ENDED_BY.get(other, ()):
                del self.open[k:]
                break
            if other in SCOPES:
                break
        _, around, apart, rank, link = self.open[-1] if self.open else ("", 0, False, 0, False)
        names = set()
        if attrs:
            found = dict(attrs)
            names = set(NAME.split(f"{found.get('class') or ''} {found.get('id') or ''}".lower()))
            style = (found.get("style") or "").replace(" ", "").lower()
            apart = apart or (found.get("role") or "").lower() in APART_ROLES or "hidden" in found or "display:none" in style or found.get("aria-hidden") == "true"
            if (found.get("role") or "").lower() == "main":
                rank = max(rank, 2)
            names.discard("")
        if tag not in ("html", "body", "article", "main") and names & APART_NAMES:
            apart = True
        if tag in APART or ((tag == "header" or "header" in names) and rank < 2):
            apart = True
        if tag == "article" and not names & APART_NAMES:
            rank = 3
        elif tag == "article":
            apart = True
        elif tag == "main":
            rank = max(rank, 2)
        elif tag in ("div", "section") and names & MAIN_NAMES:
            rank = max(rank, 1)
        path = _token(f"{around}/{tag}" + "".join(f".{n}" for n in sorted(names)))
        self.open.append((tag, path, apart, rank, link or tag == "a"))
        self.place += 1
        found = self.elements.get(path)
        if found is None:
            self.elements[path] = [around, 1, self.place, 0, 0, rank]
        else:
            found[1] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _close(self, tag: str, within: frozenset[str]) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                return
            if self.open[k][0] in within:
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self._end_block()
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                break

    def handle_data(self, data: str) -> None:
        _, _, apart, rank, _ = self.open[-1] if self.open else ("", 0, False, 0, False)
        if (apart, rank) != self.state:
            self._end_block()
            self.state = (apart, rank)
        self._add(SPACE.sub(" ", data))

    def _add(self, text: str) -> None:
        _, path, apart, rank, link = self.open[-1] if self.open else ("", 0, False, 0, False)
        self.place += 1
        self.used = True
        self.nodes.append((self.block, path, self.place, text, apart, rank))
        n = len(text.strip())
        while n and path and not apart:
            found = self.elements[path]
            found[3] += n
            found[4] += n if link else 0
            path = found[0]


def main_text(nodes: list[tuple], template: frozenset[int] = frozenset()) -> str:
    """The blocks of the nodes (block, token, text, apart, rank) that are of the highest rank and not apart, without template text, joined by blank lines."""
    rank = max((r for _, _, text, apart, r in nodes if not apart and text.strip()), default=0)
    blocks: dict[int, list[str]] = {}
    for block, token, text, apart, r in nodes:
        if not apart and r >= rank and token not in template:
            blocks.setdefault(block, []).append(text)
    texts = (SPACE.sub(" ", "".join(parts)).strip() for parts in blocks.values())
    return "\n\n".join(t for t in texts if t)


def _host(url: str = "url"):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


PARSED = (
    "row bigint, page_id bigint, url string, host string, main bigint, e_token array<bigint>, e_around array<bigint>, e_n array<bigint>, e_place array<bigint>, e_chars array<bigint>, "
    "e_links array<bigint>, e_rank array<bigint>, n_block array<bigint>, n_element array<bigint>, n_token array<bigint>, n_place array<bigint>, n_text array<string>, n_apart array<boolean>, n_rank array<bigint>, "
    "t_token array<bigint>, t_around array<bigint>, t_n array<bigint>, t_place array<bigint>, t_chars array<bigint>"
)


def parsed(pages: DataFrame) -> DataFrame:
    """Each page as parallel arrays of its elements (e_), text nodes (n_) and distinct text tokens (t_); main is a digest of what its own marks give as its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_rows(batches, "html"):
            main, lists = [], {c: [] for c in ("e_token", "e_around", "e_n", "e_place", "e_chars", "e_links", "e_rank", "n_block", "n_element", "n_token", "n_place", "n_text", "n_apart", "n_rank", "t_token", "t_around", "t_n", "t_place", "t_chars")}
            for html in batch.column("html").to_pylist():
                page = Page(html or "")
                rows = list(page.elements.values())
                own = [_token(f"{path}\n{text.strip()}") if text.strip() else 0 for _, path, _, text, _, _ in page.nodes]
                texts: dict[int, list[int]] = {}
                for t, (_, path, place, text, apart, _) in zip(own, page.nodes, strict=True):
                    if t:
                        found = texts.setdefault(t, [path, 0, place, 0])
                        found[1] += 1
                        found[3] += 0 if apart else len(text.strip())
                made = {
                    "e_token": list(page.elements), **{c: [r[i] for r in rows] for i, c in enumerate(("e_around", "e_n", "e_place", "e_chars", "e_links", "e_rank"))},
                    "n_token": own, **{c: [n[i] for n in page.nodes] for i, c in enumerate(("n_block", "n_element", "n_place", "n_text", "n_apart", "n_rank"))},
                }
                made |= {"t_token": list(texts)} | {c: [t[i] for t in texts.values()] for i, c in enumerate(("t_around", "t_n", "t_place", "t_chars"))}
                for c, values in made.items():
                    lists[c].append(values)
                main.append(_token(main_text([(n[0], 0, n[3], n[4], n[5]) for n in page.nodes])))
            kind = lambda c: pa.list_(pa.string() if c == "n_text" else pa.bool_() if c == "n_apart" else pa.int64())
            columns = {c: batch.column(c) for c in ("row", "page_id", "url", "host")} | {"main": pa.array(main, pa.int64())}
            yield pa.RecordBatch.from_pydict(columns | {c: pa.array(v, kind(c)) for c, v in lists.items()})

    return pages.select("row", "page_id", "url", "host", "html").mapInArrow(run, PARSED)


def occurrences(pages: DataFrame) -> DataFrame:
    """(host, token, element, n, v1, v2, place, around, total, chars, links, rank) of each token of a host, from parsed pages.

    n pages have it; v1 and v2 stand for its vector; the others are sums over pages, and for text nodes `around` is their element.
    """
    named = pages.where("host <> ''")
    elements = named.select("host", "row", F.explode(F.arrays_zip("e_token", "e_around", "e_n", "e_place", "e_chars", "e_links", "e_rank")).alias("e")).select(
        "host", "row", F.col("e.e_token").alias("token"), F.lit(True).alias("element"), F.col("e.e_n").alias("count"), F.col("e.e_place").alias("place"), F.col("e.e_around").alias("around"),
        F.col("e.e_chars").alias("chars"), F.col("e.e_links").alias("links"), F.col("e.e_rank").alias("rank"))
    none = F.lit(0).cast("bigint")
    texts = named.select("host", "row", F.explode(F.arrays_zip("t_token", "t_around", "t_n", "t_place", "t_chars")).alias("e")).select(
        "host", "row", F.col("e.t_token").alias("token"), F.lit(False).alias("element"), F.col("e.t_n").alias("count"), F.col("e.t_place").alias("place"), F.col("e.t_around").alias("around"),
        F.col("e.t_chars").alias("chars"), none.alias("links"), none.alias("rank"))
    mark = F.xxhash64("row", "count")
    return elements.unionByName(texts).groupBy("host", "token", "element").agg(
        F.count(F.lit(1)).alias("n"), F.sum(mark.bitwiseAND(F.lit(0xFFFFFFFF))).alias("v1"), F.sum(F.shiftrightunsigned(mark, 32)).alias("v2"), F.sum("place").alias("place"), F.min("around").alias("around"),
        F.sum("count").alias("total"), F.sum("chars").alias("chars"), F.sum("links").alias("links"), F.max("rank").alias("rank"))


def main_slot(slots: dict[int, dict], share: float = 0.6, tie: float = 0.8) -> int | None:
    """The token of the element that holds the article, from a host's template elements (token: around, single, fresh, links, rank).

    fresh counts characters that are neither template text nor links. From the root on, the fullest slot within is entered while it stands once on
    a page and holds `share` of what is around it. Of the slots entered of whose text the last one holds `tie`, the best marked one counts, else the last one.
    """
    inside: dict[int, list[int]] = {}
    for token, s in slots.items():
        inside.setdefault(s["around"] if s["around"] in slots else 0, []).append(token)
    fullest = lambda tokens: max(tokens, key=lambda t: (slots[t]["fresh"], -t))
    roots = inside.get(0)
    if not roots:
        return None
    entered = [fullest(roots)]
    while inside.get(entered[-1]):
        best = fullest(inside[entered[-1]])
        if not slots[best]["single"] or slots[best]["fresh"] < share * slots[entered[-1]]["fresh"] or not slots[best]["fresh"]:
            break
        entered.append(best)
    near = [t for t in entered if slots[entered[-1]]["fresh"] >= tie * slots[t]["fresh"]]
    return max(near, key=lambda t: (slots[t]["rank"], entered.index(t)))


def templates(found: DataFrame, hosts: DataFrame, least_tokens: int = 3, least_share: float = 0.5, least_pages: int = LEAST_PAGES, link_share: float = 0.8) -> DataFrame:
    """(host, main, apart, classes): per host its main slot, slots that are mostly links, and its classes, each a list of tokens in order."""
    hosts = hosts.where((F.col("pages") >= least_pages) & (F.col("mains") >= 0.5 * F.col("pages")))
    frequent = found.where(F.col("n") >= least_pages).join(hosts, "host").where(F.col("n") >= least_share * F.col("pages"))
    rows = frequent.groupBy("host").agg(F.collect_list(F.struct("token", "element", "n", "v1", "v2", (F.col("place") / F.col("n")).alias("at"), "around", "total", "chars", "links", "rank")).alias("t"))

    def deduced(tokens: list[dict]) -> tuple[int | None, list[int], list[list[int]]]:
        classes: dict[tuple, list[dict]] = {}
        for t in tokens:
            classes.setdefault((t["n"], t["v1"], t["v2"]), []).append(t)
        classes = {k: sorted(c, key=lambda t: (t["at"], t["token"])) for k, c in classes.items() if len(c) >= least_tokens}
        slots = {t["token"]: {"around": t["around"], "single": t["total"] == t["n"], "fresh": t["chars"] - t["links"], "links": t["links"], "chars": t["chars"], "rank": t["rank"]} for t in tokens if t["element"]}
        for c in classes.values():
            for t in c:
                token = 0 if t["element"] else t["around"]
                while token in slots:  # template text is no text of the slots around it
                    slots[token]["fresh"] -= t["chars"]
                    token = slots[token]["around"]
        in_classes = {t["token"] for c in classes.values() for t in c}
        slots = {k: s for k, s in slots.items() if k in in_classes or not s["single"]}
        main = main_slot(slots)
        linked = [k for k, s in slots.items() if s["around"] == main and s["single"] and s["links"] >= link_share * s["chars"] > 0]
        return main, linked, [[t["token"] for t in c] for c in classes.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [deduced(t) for t in batch.column("t").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "host": batch.column("host"), "slot": pa.array([m[0] for m in made], pa.int64()), "linked": pa.array([m[1] for m in made], pa.list_(pa.int64())),
                "classes": pa.array([m[2] for m in made], pa.list_(pa.list_(pa.int64()))),
            })

    return rows.mapInArrow(run, "host string, slot bigint, linked array<bigint>, classes array<array<bigint>>")


def _ordered(classes: list[list[int]], places: dict[int, int]) -> frozenset[int]:
    """Tokens of the classes that a page has in the classes' order."""
    good: set[int] = set()
    for tokens in classes:
        at = [places[t] for t in tokens if t in places]
        if all(a < b for a, b in zip(at, at[1:], strict=False)):
            good.update(tokens)
    return frozenset(good)


def slot_text(page: dict, slot: int | None, linked: list[int], classes: list[list[int]]) -> str:
    """The text of a parsed page by its host's template; by its own marks where it has none or lacks the main slot."""
    nodes = list(zip(page["n_block"], page["n_token"], page["n_text"], page["n_apart"], page["n_rank"], strict=True))
    around = dict(zip(page["e_token"], page["e_around"], strict=True))
    if not classes or slot not in around:
        return main_text(nodes)
    places = dict(zip(page["e_token"], page["e_place"], strict=True))
    for token, place in zip(page["n_token"], page["n_place"], strict=True):
        places.setdefault(token, place)
    inside, out = {slot: True, 0: False} | dict.fromkeys(linked, False), []

    def within(token: int) -> bool:
        way = []
        while token not in inside:
            way.append(token)
            token = around[token]
        inside.update(dict.fromkeys(way, inside[token]))
        return inside[token]

    for node, element in zip(nodes, page["n_element"], strict=True):
        if within(element):
            out.append(node)
    return main_text(out, _ordered(classes, places) - {0})


#: Parts in which a host's pages meet its template, where Spark finds the templates too large to broadcast.
SALTS = 8


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of pages (page_id, url, html)."""
    read = stored(parsed(pages.select("page_id", "url", "html", _host().alias("host"), F.monotonically_increasing_id().alias("row"))), "pages")
    mains = read.where("host <> ''").groupBy("host", "main").agg(F.count(F.lit(1)).alias("n")).groupBy("host").agg(F.sum("n").alias("pages"), F.count(F.lit(1)).alias("mains"))
    found = stored(occurrences(read).where(F.col("n") >= LEAST_PAGES), "page-tokens")
    template = stored(templates(found, mains), "page-templates")
    discard(found)
    salted = template.select(F.col("host").alias("_h"), "slot", "linked", "classes", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_s"))
    names = ["e_token", "e_around", "e_place", "n_block", "n_element", "n_token", "n_place", "n_text", "n_apart", "n_rank"]
    both = read.join(salted, (F.col("host") == F.col("_h")) & (F.pmod("row", F.lit(SALTS)) == F.col("_s")), "left").select("page_id", "url", *names, "slot", "linked", "classes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for at in range(0, batch.num_rows, 64):  # a few pages as Python objects at a time
                part = batch.slice(at, 64).select([*names, "slot", "linked", "classes"])
                texts += [slot_text(page, page["slot"], page["linked"] or [], page["classes"] or []) for page in part.to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64()),
            })

    return both.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
