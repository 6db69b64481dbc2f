"""Main-text extraction by site style trees.

All pages of a host are merged into one tree of styles: a style is a path of block elements with
their classes, ids and, for containers, their place among like ones. A style's content importance
falls with the entropy of what it shows over the host's distinct pages (phrases that stand on every
page have entropy 1) and with the share of its text that is links; its presentation importance is
the entropy of its child sequences. Both are composed up the tree. The tree's main branch is where
most of the host's text is; branches of low importance are cut from each page, those beside the
main branch the sooner the less text they hold. What markup itself declares to be no article
(navigation, forms, adverts and so on) is cut too, as its words may differ on every page.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.work import short_batches, stored

LEAST_IMPORTANCE = 0.3  # of a branch beside the main one
LEAST_INSIDE = 0.15  # of a branch inside the main one
GAMMA = 0.9  # weight of what is below a style against its own presentation, to the power of its child sequences
VOLUME = 0.1  # share of a host's text from which a branch beside the main one has its full importance
PLACES = 8  # places of like containers that are told apart; those from the last on are one style

#: Elements that hold no article text (fixed values).
SKIP = frozenset("nav footer aside form script style noscript template button select option textarea input iframe object svg math canvas audio video dialog menu head title map datalist label fieldset".split())
#: Elements whose content is not markup.
RAW = frozenset("script style textarea title xmp noscript iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
#: Elements that end an open element of the names on the right.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
    "tbody": ("tr", "thead", "tbody"), "tfoot": ("tr", "tbody"), "body": ("head",),
}
SCOPES = frozenset("ul ol dl table div section article main aside nav footer header form blockquote body html menu".split())
#: Words in classes and ids that mark a branch as no article text (fixed values).
MARKS = frozenset(
    """nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars footer masthead ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored sponsors promo promos
    promotion banner banners cookie cookies consent gdpr notice notices notification popup popover modal overlay newsletter subscribe subscription signup login signin social share sharing shares related
    recommended recommendations comment comments commentlist respond replies disqus widget widgets toolbar pagination pager skip paywall outbrain taboola search searchform hidden print""".split()
)
#: Those of them that mark readers' comments.
COMMENTS = frozenset("comment comments commentlist respond replies disqus".split())
#: Containers that are told apart by their place among like ones.
CONTAINERS = frozenset("div section article main aside header footer nav table form ul ol dl center".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())

_TOKEN = re.compile(r"<(?:!--.*?(?:--!?>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[!?/][^>]*>)", re.S)
_ATTR = re.compile(r"([a-zA-Z][\w:-]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PHRASE = re.compile(r"[.,;:!?|()\u00b7\u2022\u2013\u2014]+\s*")
_MARK = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_raw_ends: dict[str, re.Pattern] = {}


def _key(parent: int, name: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{parent}/{name}".encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


class Page:
    """A page's elements and texts: for each element name, parent, style key, and whether its markup declares it to be no article: 2 by its element, role or being hidden, 1 by a word of its class or id, 3 by a word for comments."""

    def __init__(self, html: str, keys: dict | None = None, host: str = ""):
        keys = {} if keys is None else keys
        root = keys.get((0, host))
        if root is None:
            root = keys[0, host] = _key(0, host)
        self.name, self.parent, self.key, self.no, self.child = [""], [-1], [root], [0], [[]]
        self.block, places = [0], [{}]  # the nearest block element of each element; like containers among its children so far
        self.texts: list[tuple[int, str | None]] = []  # element and text; None is the border of a block
        # Open elements besides the root; names open since each container, innermost last; containers open by name.
        stack, self.since, self.scopes = [0], [{}], dict.fromkeys(SCOPES, 0)
        at, end, last = 0, len(html), html.rfind(">") + 1
        add = self.texts.append
        while at < end:
            # Beyond the last ">" no tag ends, so that part is not searched for one from each of its "<".
            m = _TOKEN.search(html, at, last) if at < last else None
            if m is None:
                note = html.find("<!--", at)
                rest = html[at:note] if note >= 0 else html[at:]
                cut = re.search(r"<[a-zA-Z/!][^<>]*\Z", rest) if note < 0 else None  # an unfinished tag at the end of a cut page
                if note != at:
                    add((stack[-1], rest[: cut.start()] if cut else rest))
                break
            if m.start() > at:
                add((stack[-1], html[at : m.start()]))
            at = m.end()
            if at == last and html.startswith("<!--", m.start()) and not html.endswith(("-->", "--!>"), m.start() + 4, at):
                break  # a comment without an end goes on to that of the page
            name = m[2] or m[5]
            if not name:
                continue
            name, closing = name.lower(), m[1] or m[4]
            if closing:
                self._close(stack, name, add)
                continue
            if name in BLOCKS:
                add((stack[-1], None))
                self._end(stack, ("p",))
            for other in ENDS.get(name, ()):
                self._end(stack, (other,))
            parent = stack[-1]
            attrs = (m[3] or m[6] or "").strip()
            style = name
            no = 2 if name in SKIP or name == "header" and not self.scopes["article"] + self.scopes["main"] else 0
            if attrs and name not in VOID and name != "a":
                got = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(attrs)}
                if marks := f"{got.get('class') or ''} {got.get('id') or ''}".strip():
                    words = {w.lower() for w in _MARK.findall(marks)}
                    style += "." + ".".join(sorted(words))
                    if not no and name not in ("body", "html", "main") and (name != "article" or words & COMMENTS):
                        no = 3 if words & COMMENTS else int(bool(words & MARKS))
                if (got.get("role") or "").lower() in ROLES or "hidden" in got or (got.get("aria-hidden") or "").lower() == "true" or "display:none" in (got.get("style") or "").replace(" ", "").lower():
                    no = 2
            if name in VOID:
                add((parent, " " if name in ("br", "wbr") else None if name == "hr" else ""))
                continue
            me, up = len(self.name), self.block[parent]
            if name in BLOCKS:
                if name in CONTAINERS:
                    places[up][style] = place = places[up].get(style, 0) + 1
                    style += f"#{min(place, PLACES)}"
                key = keys.get((self.key[up], style))
                if key is None:
                    key = keys[self.key[up], style] = _key(self.key[up], style)
                self.block.append(me)
                places.append({})
            else:
                key = self.key[up]
                self.block.append(up)
                places.append(places[up])
            self.name.append(name)
            self.parent.append(parent)
            self.key.append(key)
            self.no.append(no)
            self.child.append([])
            if name not in RAW:
                self.child[up].append(style)
            if name in RAW:
                pattern = _raw_ends.setdefault(name, re.compile(rf"</{name}(?=[\s/>])[^>]*>|\Z", re.I))
                stop = pattern.search(html, at, last) if at < last else None
                if stop is None or stop.end() == stop.start():
                    break
                at = stop.end()
                continue
            if not attrs.endswith("/") or name in BLOCKS or name in ("a", "b", "i", "span"):
                stack.append(me)
                if name in SCOPES:
                    self.scopes[name] += 1
                    self.since.append({})
                else:
                    now = self.since[-1]
                    now[name] = now.get(name, 0) + 1

    def _pop_to(self, stack: list[int], names: tuple[str, ...]) -> None:
        """Ends open elements up to the nearest one of these names, which is there."""
        while True:
            name = self.name[stack.pop()]
            if name in SCOPES:
                self.scopes[name] -= 1
                self.since.pop()
            else:
                self.since[-1][name] -= 1
            if name in names:
                return

    def _end(self, stack: list[int], names: tuple[str, ...]) -> None:
        """Ends the nearest open element of these names, none of them a container, unless a container stands between."""
        now = self.since[-1]
        for x in names:
            if now.get(x):
                self._pop_to(stack, names)
                return

    def _close(self, stack: list[int], name: str, add) -> None:
        """An end tag: that of a container ends the nearest one of its name, any other only within its container."""
        if name in BLOCKS:
            add((stack[-1], None))
        if self.scopes[name] if name in SCOPES else self.since[-1].get(name):
            self._pop_to(stack, (name,))

    def digest(self) -> int:
        """A hash of the page's text, without scripts, styles, comments and attributes."""
        return _key(2, " ".join(" ".join(t for _, t in self.texts if t).split()))

    def styles(self) -> tuple[list[tuple[int, int, int]], list[tuple]]:
        """What the page shows: (style, kind, hash) of phrases (kind 0) and child sequences (kind 1), and per style (style, parent, is a heading, elements, chars, link chars)."""
        link, own = [False] * len(self.name), {}
        for k in range(1, len(self.name)):
            link[k] = self.name[k] == "a" or link[self.parent[k]]
        size: dict[int, list] = {}
        for k in range(len(self.name)):
            if self.block[k] == k:
                got = size.setdefault(self.key[k], [self.key[self.block[self.parent[k]]] if k else 0, len(self.name[k]) == 2 and self.name[k][0] == "h" and self.name[k][1].isdigit(), 0, 0, 0])
                got[2] += 1
        for k, t in self.texts:
            if t and not t.isspace():
                n, style = len(t.strip()), self.key[k]
                own.setdefault(self.block[k], []).append(t)
                size[style][3] += n
                size[style][4] += n * link[k]
        shown = {(self.key[k], 0, _key(0, x)) for k, ts in own.items() for x in (x.strip() for x in _PHRASE.split(" ".join("".join(ts).split()))) if x}
        shown |= {(self.key[k], 1, _key(1, repr(self.child[k]))) for k in range(len(self.name)) if self.block[k] == k}
        return list(shown), [(style, *v) for style, v in size.items()]

    def main_text(self, low: set[int]) -> str:
        """The blocks of the article: without what is declared to be none, and without branches of low importance unless that leaves nothing."""
        return self._main_text(low) or (self._main_text(set()) if low else "")

    def _main_text(self, low: set[int]) -> str:
        n = len(self.name)
        hard = [False] * n
        for k in range(1, n):
            hard[k] = self.no[k] == 2 or hard[self.parent[k]]
        size, core = [0] * n, [False] * n
        for k, t in self.texts:
            if t and not hard[k]:
                size[k] += len(t.strip())
        for k in range(n - 1, 0, -1):
            core[k] = core[k] or self.name[k] in ("main", "article") and not self.no[k]
            size[self.parent[k]] += size[k]
            core[self.parent[k]] = core[self.parent[k]] or core[k]
        # A word of a class does not cut what holds the article or most of the page's text (a layout "with sidebar").
        cut, inside = [False] * n, [False] * n
        for k in range(1, n):
            by_word = self.no[k] in (1, 3) and not core[k] and (self.no[k] == 3 or 5 * size[k] < 3 * size[0])
            cut[k] = cut[self.parent[k]] or hard[k] or by_word or self.block[k] == k and self.key[k] in low and self.name[k] not in ("html", "body", "main", "article")
        scope = next((s for s in ("main", "article") if any(self.name[k] == s and not cut[k] for k in range(n))), None)
        for k in range(n):
            inside[k] = scope is None or self.name[k] == scope or k > 0 and inside[self.parent[k]]
        blocks, open_ = [], []
        for k, t in self.texts:
            if t is None:
                if open_:
                    blocks.append("".join(open_))
                    open_ = []
            elif inside[k] and not cut[k]:
                open_.append(t)
                if self.name[k] in ("td", "th"):
                    open_.append(" ")
        blocks.append("".join(open_))
        words = (" ".join(html_lib.unescape(b).split()) for b in blocks)
        return "\n\n".join(b for b in words if b)


def _host():
    return F.coalesce(F.lower(F.regexp_extract(F.col("url").cast("string"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def style_statistics(pages: DataFrame) -> DataFrame:
    """(host, style, parent, heading, m, elements, chars, links, content, presentation, shapes) of every style of a host over its distinct pages.

    ``m``: pages that have it; ``content``: mean over what it shows, each phrase as often as pages show
    it, of the phrase's entropy over those pages (one of c pages: log c to the base m); ``presentation``:
    entropy of its ``shapes`` child sequences. Pages with the same text are one page.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: dict = {}
        schema = pa.schema([("page", pa.int64()), ("style", pa.int64()), ("kind", pa.int32()), ("feature", pa.int64()), ("host", pa.string()), ("heading", pa.bool_()), ("elements", pa.int64()), ("chars", pa.int64()), ("links", pa.int64())])
        for batch in batches:
            rows: set[tuple] = set()
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if html:
                    page = Page(html, keys, host)
                    ident = page.digest()
                    shown, styles = page.styles()
                    rows.update((ident, style, kind, x, None, None, None, None, None) for style, kind, x in shown)
                    rows.update((ident, style, 2, up, host, *rest) for style, up, *rest in styles)
            if len(keys) > 500_000:
                keys.clear()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [()] * 9, schema.types, strict=True)], schema=schema)

    schema = "page long, style long, kind int, feature long, host string, heading boolean, elements long, chars long, links long"
    seen = pages.select(_host().alias("host"), F.col("html").cast("string").alias("html")).mapInArrow(run, schema)
    # One row for each page's text, so copies count once, whichever way their markup differs.
    each = [F.max(c).alias(c) for c in ("host", "heading", "elements", "chars", "links")]
    counts = seen.groupBy("style", "kind", "feature", "page").agg(*each).groupBy("style", "kind", "feature").agg(F.count("*").alias("c"), F.max("host").alias("host"), F.max("heading").alias("heading"), *[F.sum(x).alias(x) for x in ("elements", "chars", "links")])
    is_kind = lambda k, x: F.when(F.col("kind") == k, x)
    clogc, c = F.col("c") * F.log("c"), F.col("c")
    d = counts.groupBy("style").agg(
        F.max("host").alias("host"), F.max(is_kind(2, F.col("feature"))).alias("parent"), F.max("heading").alias("heading"), F.sum(is_kind(2, c)).alias("m"), F.sum("elements").alias("elements"), F.sum("chars").alias("chars"), F.sum("links").alias("links"),
        F.sum(is_kind(0, c)).alias("c0"), F.sum(is_kind(0, clogc)).alias("s0"), F.sum(is_kind(1, c)).alias("c1"), F.sum(is_kind(1, clogc)).alias("s1"), F.count(is_kind(1, c)).alias("shapes"),
    )
    base = F.when(F.col("m") > 1, F.log("m"))
    content = F.when(F.col("c0") > 0, F.coalesce(F.col("s0") / F.col("c0") / base, F.lit(0.0)))
    presentation = F.least(F.coalesce((F.log("c1") - F.col("s1") / F.col("c1")) / base, F.lit(1.0)), F.lit(1.0))
    return d.select("host", "style", "parent", "heading", "m", "elements", "chars", "links", content.alias("content"), presentation.alias("presentation"), "shapes")


def importance(rows: list[dict], least: float = LEAST_IMPORTANCE, inside: float = LEAST_INSIDE, gamma: float = GAMMA, volume: float = VOLUME) -> tuple[dict[int, float], list[int]]:
    """The composite importance of a host's styles, and the topmost styles that are low."""
    by = {r["style"]: r for r in rows}
    below: dict[int, list[int]] = {}
    for r in rows:
        below.setdefault(r["parent"], []).append(r["style"])
    order, todo = [], [r["style"] for r in rows if r["parent"] not in by]
    tops = list(todo)
    while todo:
        k = todo.pop()
        order.append(k)
        todo += below.get(k, ())
    text, value = {}, {}
    for k in reversed(order):
        r, kids = by[k], below.get(k, [])
        plain = r["chars"] - r["links"]
        text[k] = plain + sum(text[j] for j in kids)
        own = (1 - r["content"]) * plain / r["chars"] if r["chars"] else None
        if kids:
            weights = [text[j] + 1 for j in kids]
            inner = sum(value[j] * w for j, w in zip(kids, weights, strict=True)) / sum(weights)
            g = gamma ** min(r["shapes"], 1000)
            kept = (1 - g) * r["presentation"] * (inner > 0) + g * inner
            value[k] = kept if own is None else (own * plain + kept * (text[k] - plain + 1)) / (text[k] + 1)
        else:
            value[k] = own if own is not None else r["presentation"] * 0.0
    total = sum(text[k] for k in tops)
    # The main branch: down to the last element, one a page, that holds most of the host's text and has elements below.
    main, chain = None, set()
    for k in tops:
        while k is not None and 2 * text[k] >= total > 0 and 10 * by[k]["elements"] <= 12 * by[k]["m"] and any(text[j] for j in below.get(k, ())):
            main = k
            chain.add(k)
            k = max(below[k], key=lambda j: (text[j], j))
    low, todo = [], [(k, False) for k in tops]
    while todo:
        k, in_main = todo.pop()
        r = by[k]
        most = total > 0 and 2 * text[k] >= total
        if k not in chain and not most and r["m"] > 1:
            share = 1.0 if in_main or r["heading"] else min(1.0, text[k] / (volume * total)) if total else 1.0
            if value[k] * share < (inside if in_main else least):
                low.append(k)
                continue
        todo += [(j, in_main or k == main) for j in below.get(k, ())]
    return value, low


def low_styles(pages: DataFrame, least: float = LEAST_IMPORTANCE, inside: float = LEAST_INSIDE) -> DataFrame:
    """(host, low): per host the topmost styles of low importance. A host's styles, not its pages, meet in one task; a style on one page only is important."""
    names = ["style", "parent", "heading", "m", "elements", "chars", "links", "content", "presentation", "shapes"]

    def run(t: pa.Table) -> pa.Table:
        _, low = importance(t.select(names).to_pylist(), least, inside)
        return pa.Table.from_arrays([pa.array([t.column("host")[0].as_py()]), pa.array([sorted(low)], pa.list_(pa.int64()))], ["host", "low"])

    return style_statistics(pages).groupBy("host").applyInArrow(run, "host string, low array<long>").filter(F.size("low") > 0)


def extract(pages: DataFrame, least: float = LEAST_IMPORTANCE, inside: float = LEAST_INSIDE) -> DataFrame:
    """page_id, url, text and n_chars of every row of pages (page_id, url, html).

    Null and empty pages have an empty text. A null url belongs to the host without a name. Pages of
    one text count once in their host's statistics, and repeated rows give repeated results; other
    columns are not read. An empty table gives an empty result. With ``least`` and ``inside`` below 0
    the tree cuts nothing.
    """
    short_batches(pages.sparkSession)
    low = stored(low_styles(pages, least, inside), "low-styles")
    d = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), _host().alias("host"))
    d = d.join(low, "host", "left").select("page_id", "url", "html", "low", "host")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: dict = {}
        for batch in batches:
            texts = [Page(h, keys, host).main_text(set(low or ())) if h else "" for h, low, host in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True)]
            if len(keys) > 500_000:
                keys.clear()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(np.array([len(t) for t in texts], np.int64))], ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return d.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
