"""Operator 2, HTML extraction by equivalence-class template deduction.

Tokens of a page are its tags, named by their path, and its text nodes, named by path and text.  A token's occurrence
vector tells how often each page of a host has it.  Tokens with equal vectors form an equivalence class; classes of two
tokens or more that half of a host's pages have are candidates, and those whose tokens come in one order on all of these
pages are its template.  Tokens are named by paths from the root, so of two tags one path begins the other or they lie apart:
the classes nest in one tree on every page.

What lies between template tokens is a slot.  Slots are judged over all pages of the host: the article is the deepest
template element, one a page, that holds nearly all prose of the slots and the pages' top headings, so an advert or a box
beside it is out whatever it is called, and a title beside the body is in.  From the article only template text, elements that HTML itself sets aside
(navigation, forms, footers) and readers' comments are taken out.  Hosts with one page, pages without a readable address and hosts
without a template share a template among them.  A page on which the article's element is missing, and every page where there is no
template at all, is judged by itself: by ``article`` and ``main``, then by where its prose is.

Vectors are never built: a grouped sum of page hashes times occurrences is a digest of a vector, it combines before the
shuffle, and tokens of one host with equal digests have equal vectors.  A host's template is no larger than two pages.

A page takes time and memory in proportion to its length, whatever it holds: paths are hashes, elements nested deeper than
``DEPTH`` stand beside each other there, and patterns don't backtrack.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from silverbrook.llm import wordarrays as wa
from silverbrook.llm.storage import attach, cut

#: Tokens of a class, and the share of a host's pages (two at least; of text ``TEXT_PAGES``) that must have it.
CLASS_TOKENS, CLASS_SHARE, TEXT_PAGES = 2, 0.5, 3
#: Shares of a host's prose, and of its pages' top headings, that the element of the article holds; ``article`` and ``main``
#: need the lower one.
MAIN_SHARE, TAG_SHARE, HEADED_SHARE = 0.8, 0.5, 0.9
#: Most of a page's prose that may be the template's: a page with more is a copy of others, and keeps its prose.
COPIED_SHARE = 0.5
#: Least of a page's prose that elements named as the article must hold to be it, where the page is judged by itself.
NAMED_SHARE = 0.5

#: The most open elements; what opens beyond them takes the innermost one's place.
DEPTH = 512

# A quoted value may hold brackets; a quote that isn't closed within 4096 characters is a character like others.
_INSIDE = r"(?:[^<>=]++|=\s*+\"[^\"]{0,4096}+\"|=\s*+'[^']{0,4096}+'|=)*+"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|select|svg|iframe|title)\b{_INSIDE}>.*?(?:</\1\s*+>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/<>]*+)({_INSIDE})>|<[!?][^<>]*+>|[^<]++|<",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME_PART = re.compile(r"[^a-z]+")
_SPACE = re.compile(r"\s+")
_CLOSED = re.compile(r"(?:[\s\"']|^)/$")

# Fixed values of HTML: elements without content, elements that don't begin a new block, and those whose start ends
# an open one.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
LIST_ROOTS = frozenset(("ul", "ol", "dl", "table", "article", "section", "div", "body"))
HEADINGS = {f"h{i}": i for i in range(1, 7)}
# Fixed values of this operator: elements and roles that HTML sets aside, elements of prose, and names of readers' comments, which no
# template tells from an article.
ASIDE_TAGS = frozenset("nav footer aside form head button menu dialog fieldset object".split())
ASIDE_ROLES = frozenset("navigation contentinfo complementary search form alert alertdialog dialog menu menubar".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li td th dd dt figcaption".split())
READER_NAMES = frozenset("comment comments commentlist disqus".split())


class Template:
    """What a host's pages share: its tokens, and the path of the element that holds the article."""

    def __init__(self, tokens: frozenset[int], main: int):
        self.tokens, self.main = tokens, main

    @classmethod
    def settled(cls, candidates: list[dict], facts: list[dict]) -> Template:
        """Keep the candidates of classes with one order, and choose the element of the article."""
        ordered = {f["id"] for f in facts if f["kind"] == ORDER and f["low"] == f["high"]}
        tokens = frozenset(c["token"] for c in candidates if c["class"] in ordered)
        slots = [f for f in facts if f["kind"] == SLOT]
        whole = next((f for f in slots if f["id"] == ROOT), None)
        best = ROOT, 0
        for f in slots if whole else ():
            share = TAG_SHARE if f["named"] else MAIN_SHARE
            if f["id"] in tokens and f["prose"] >= share * whole["prose"] > 0 and f["headed"] >= HEADED_SHARE * whole["headed"] and f["low"] > best[1]:
                best = f["id"], f["low"]
        return cls(tokens, best[0])


ROOT = 0
#: Kinds of facts: the order of a class on a page, and what an element holds.
ORDER, SLOT = 0, 1


class Page:
    """The elements and text nodes of a page, in order."""

    def __init__(self, html: str):
        self.tag, self.parent, self.path = ["#"], [-1], [ROOT]
        self.named_main, self.mark = [False], [False]
        #: (element, block, text, in a link)
        self.texts: list[tuple[int, int, str, bool]] = []
        #: The elements before each of them.
        self.opened: list[int] = []
        stack, block, links = [0], 0, 0
        self.open: Counter = Counter()
        for m in _TOKEN.finditer(html):
            raw = m[0]
            if raw[0] != "<" or raw == "<":
                self._text(stack[-1], block, raw, links > 0)
                continue
            tag = m[3]
            if tag is None:
                continue
            tag = tag.lower()
            if tag not in INLINE:
                block += 1
            if m[2]:
                if tag == "a":
                    links = 0
                if tag == "p" or tag in VOID:
                    if tag == "br":
                        self._text(stack[-1], block, " ", False)
                    self._close(stack, (tag,), LIST_ROOTS)
                    continue
                self._close(stack, (tag,), ())
                continue
            if tag == "br":
                self._text(stack[-1], block, " ", False)
                continue
            if tag in VOID:
                continue
            if tag not in INLINE:
                self._close(stack, ("p",), LIST_ROOTS)
                if tag in CLOSES:
                    self._close(stack, CLOSES[tag], LIST_ROOTS)
            if tag == "a":
                links = 1
            if len(stack) > DEPTH:
                self._cut(stack, len(stack) - 1)
            stack.append(self._open(tag, m[4] or "", stack[-1]))
            self.open[tag] += 1
            if _CLOSED.search(m[4]):
                self._cut(stack, len(stack) - 1)
        self._settle()

    def _text(self, e: int, block: int, text: str, link: bool) -> None:
        self.texts.append((e, block, text, link))
        self.opened.append(len(self.tag))

    def _settle(self) -> None:
        """Which elements aren't part of an article, and the article that each is in."""
        count = len(self.tag)
        self.aside, self.holder = [False] * count, [None] * count
        for e in range(1, count):
            up = self.parent[e]
            self.aside[e] = self.aside[up] or self.mark[e]
            self.holder[e] = e if self.named_main[e] and not self.aside[e] else self.holder[up]

    def _sums(self, sizes: Iterable[tuple[int, int]]) -> list[int]:
        """What each element holds, of sizes by element."""
        out = [0] * len(self.tag)
        for e, n in sizes:
            out[e] += n
        for e in range(len(out) - 1, 0, -1):
            out[self.parent[e]] += out[e]
        return out

    def _cut(self, stack: list[int], i: int) -> None:
        for e in stack[i:]:
            self.open[self.tag[e]] -= 1
        del stack[i:]

    def _close(self, stack: list[int], tags: tuple[str, ...], walls) -> None:
        if not any(self.open[t] for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            name = self.tag[stack[i]]
            if name in tags:
                self._cut(stack, i)
                return
            if name in walls:
                return

    def _open(self, tag: str, attributes: str, parent: int) -> int:
        names, role, label = set(), "", ""
        if "=" in attributes:
            for key, *value in _ATTRIBUTE.findall(attributes):
                value = "".join(value).lower()
                if key.lower() == "role":
                    role = value
                else:
                    label += "." + value if key.lower() == "class" else ""
                    if tag not in PROSE and tag not in INLINE:  # ids of headings are often made of their words
                        names.update(_NAME_PART.split(value))
        self.tag.append(tag)
        self.parent.append(parent)
        self.path.append(token_hash(f"{self.path[parent]}/{tag}{label}", False))
        self.named_main.append(tag in ("article", "main") or role == "main")
        self.mark.append(tag in ASIDE_TAGS or role in ASIDE_ROLES or tag not in ("html", "body") and not names.isdisjoint(READER_NAMES))
        return len(self.tag) - 1

    def tokens(self) -> Counter:
        """Occurrences of the page's tokens."""
        found = Counter(self.path)
        found.update(self._text_token(e, t) for e, _, t, _ in self.texts if not t.isspace())
        return found

    def _text_token(self, e: int, t: str) -> int:
        return token_hash(f"{self.path[e]}#{' '.join(t.split())}", True)

    def _of_template(self, template: frozenset[int]) -> list[bool]:
        """Which text nodes are the template's.  Where it has most of a page's prose, that prose stays."""
        found = [False] * len(self.texts)
        if not template:
            return found
        prose = [False] * len(self.tag)
        for e in range(1, len(self.tag)):
            prose[e] = prose[self.parent[e]] or self.tag[e] in PROSE or self.holder[e] is not None
        whole, copied = 0, 0
        for i, (e, _, t, link) in enumerate(self.texts):
            if not self.aside[e] and t.strip():
                found[i] = self._text_token(e, t) in template
                if prose[e] and not link:
                    whole += len(t.strip())
                    copied += len(t.strip()) * found[i]
        if copied > COPIED_SHARE * whole:
            found = [x and not prose[e] for x, (e, *_) in zip(found, self.texts, strict=True)]
        return found

    def _prose(self, of_template: list[bool]) -> list[int]:
        """The prose that each element holds, without the template's and without links outside articles."""
        return self._sums((e, len(t.strip())) for (e, _, t, link), out in zip(self.texts, of_template, strict=True) if not (self.aside[e] or out or link and self.holder[e] is None))

    def facts(self, classes: dict[int, int], once: frozenset[int]) -> Iterator[tuple]:
        """What this page says of its host's candidates (token to class; ``once``: tags that a page has once):
        (kind, id, low, high, named, prose, headed)."""
        orders: dict[int, dict[int, None]] = {}
        for token in self._in_order():
            if token in classes:
                orders.setdefault(classes[token], {})[token] = None
        for c, tokens in orders.items():
            order = token_hash(",".join(map(str, tokens)), False)
            yield ORDER, c, order, order, False, 0, 0
        of_template = self._of_template(frozenset(classes))
        prose = self._prose(of_template)
        level, depth = [0] * len(self.tag), [0] * len(self.tag)
        for e in range(1, len(self.tag)):
            depth[e] = depth[self.parent[e]] + 1
            level[e] = HEADINGS.get(self.tag[e], level[self.parent[e]])
        heads = [(level[e], e, len(t.strip())) for (e, _, t, _), out in zip(self.texts, of_template, strict=True) if level[e] and t.strip() and not (self.aside[e] or out)]
        top = min(heads)[0] if heads else 0
        headed = self._sums((e, n) for at, e, n in heads if at == top)
        for e, path in enumerate(self.path):
            if e == 0 or path in once:
                yield SLOT, path, depth[e], depth[e], self.named_main[e], prose[e], int(bool(heads) and headed[e] == headed[0])

    def _in_order(self) -> Iterator[int]:
        at = 0
        for (e, _, t, _), opened in zip(self.texts, self.opened, strict=True):
            yield from self.path[at:opened]
            at = max(at, opened)
            if not t.isspace():
                yield self._text_token(e, t)
        yield from self.path[at:]

    def _main(self, template: Template | None, of_template: list[bool]) -> list[int]:
        """The elements that hold the page's text."""
        size = self._prose(of_template)
        if template:
            best = [e for e, path in enumerate(self.path) if path == template.main and not self.aside[e]]
            if best and any(size[e] for e in best):
                return best
        else:
            named: dict[bool, list[int]] = {True: [], False: []}
            for e in range(1, len(self.tag)):
                if self.named_main[e] and not self.aside[e] and size[e]:
                    kind, up = self.tag[e] == "article", self.parent[e]
                    while up >= 0 and not (self.named_main[up] and (self.tag[up] == "article") == kind):
                        up = self.parent[up]
                    if up < 0:
                        named[kind].append(e)
            best = max(named.values(), key=lambda es: sum(size[e] for e in es))
            if best and sum(size[e] for e in best) >= NAMED_SHARE * size[0]:
                return best
        return [max((e for e in range(len(self.tag)) if size[e] and size[e] == size[0]), default=0)]

    def main_text(self, template: Template | None) -> str:
        of_template = self._of_template(template.tokens if template else frozenset())
        inside = [False] * len(self.tag)
        for e in self._main(template if template and template.main in self.path else None, of_template):
            inside[e] = True
        for e in range(1, len(self.tag)):
            inside[e] = inside[e] or inside[self.parent[e]]
        blocks, now, parts = [], None, []
        for (e, block, t, _), out in zip(self.texts, of_template, strict=True):
            if not inside[e] or self.aside[e] or out:
                continue
            if block != now:
                blocks.append("".join(parts))
                now, parts = block, []
            parts.append(t)
        blocks.append("".join(parts))
        clean = (_SPACE.sub(" ", unescape(b)).strip() for b in blocks)
        return "\n\n".join(b for b in clean if b)


def token_hash(token: str, text: bool) -> int:
    """64 bits, the last one for the kind."""
    return (xxhash.xxh64_intdigest(token) - (1 << 63)) & ~1 | text


_HALF = (1 << 31) - 1


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in wa.slices(batches, "html"):
        found: dict[tuple[str, int], list[int]] = {}
        for host, page, html in zip(*(part.column(c).to_pylist() for c in ("host", "page", "html")), strict=True):
            a, b = page & _HALF, (page >> 31) & _HALF
            for token, n in Page(html).tokens().items():
                row = found.setdefault((host, token), [0, 0, 0, 0])
                row[0] += 1
                row[1] += a * n
                row[2] += b * n
                row[3] += n
        columns = [[h for h, _ in found], [t for _, t in found], *zip(*found.values(), strict=True)] if found else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *[pa.array(list(c), pa.int64()) for c in columns[1:]]], ["host", "token", "pages", "a", "b", "n"])


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?i)^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/@]*@)?([^/:?#]+)", 1))


def _keyed(pages: DataFrame) -> DataFrame:
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.select(F.col("page_id"), F.col("url"), host_of(F.col("url")).alias("host"), html.alias("html"))


_CANDIDATES = "array<struct<token:long,class:long,once:boolean>>"
_FACTS = "kind int, id long, low long, high long, named boolean, prose long, headed long"
#: The group of pages whose host has no other page, or isn't known.
OTHERS = ""


class _ByHost:
    """What is known of each row's host, made once for a run of its rows."""

    def __init__(self, columns: tuple[str, ...], make, default):
        self.columns, self.make, self.default, self.known = columns, make, default, {}

    def of(self, part: pa.RecordBatch) -> list:
        values, out = [part.column(c) for c in self.columns], []
        for i, host in enumerate(part.column("host").to_pylist()):
            if host not in self.known:
                if len(self.known) > 1000:
                    self.known.clear()
                given = [v[i].as_py() for v in values]
                self.known[host] = self.default if given[0] is None else self.make(*given)
            out.append((host, self.known[host], not values[0][i].is_valid))
        return out


def _classes(candidates: list[dict]) -> tuple[dict[int, int], frozenset[int]]:
    return {c["token"]: c["class"] for c in candidates}, frozenset(c["token"] for c in candidates if c["once"])


def _judge(default: list[dict]):
    """Facts of each host, summed over a slice of pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hosts = _ByHost(("candidates",), _classes, _classes(default))
        for part in wa.slices(batches, "html"):
            found: dict[tuple, list] = {}
            for (host, (classes, once), other), html in zip(hosts.of(part), part.column("html").to_pylist(), strict=True):
                for kind, i, low, high, named, prose, headed in Page(html).facts(classes, once) if classes else ():
                    row = found.setdefault((OTHERS if other else host, kind, i), [low, high, False, 0, 0])
                    row[0], row[1], row[2] = min(row[0], low), max(row[1], high), row[2] or named
                    row[3] += prose
                    row[4] += headed
            columns = [*zip(*found, strict=True), *zip(*found.values(), strict=True)] if found else [[]] * 8
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["host", "kind", "id", "low", "high", "named", "prose", "headed"])

    return run


def _extract(default: Template | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hosts = _ByHost(("candidates", "facts"), Template.settled, default)
        for part in wa.slices(batches, "html"):
            texts = [Page(html).main_text(template) for (_, template, _), html in zip(hosts.of(part), part.column("html").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return run


def candidates(keyed: DataFrame) -> DataFrame:
    """``host, candidates``: the tokens of valid classes of each host that has some; pages of one-page hosts are those of ``OTHERS``."""
    rows = keyed.select("host", F.xxhash64("page_id", "url").alias("page"), "html")
    hosts = keyed.groupBy("host").agg(F.count(F.lit(1)).alias("all_pages"))
    sums = [F.sum(c).alias(c) for c in ("pages", "a", "b", "n")]
    vectors = rows.mapInArrow(_vectors, "host string, token long, pages long, a long, b long, n long").groupBy("host", "token").agg(*sums)
    group = F.when(F.col("all_pages") == 1, OTHERS).otherwise(F.col("host")).alias("host")
    grouped = vectors.join(hosts, "host").where("all_pages = 1 or pages > 1").select(group, "token", "pages", "a", "b", "n").groupBy("host", "token").agg(*sums)
    often = cut(grouped.where((F.col("pages") > 1) & ((F.col("token") % 2 == 0) | (F.col("pages") >= TEXT_PAGES))), "vectors")
    whole = hosts.select(group, "all_pages").groupBy("host").agg(F.sum("all_pages").alias("all_pages"))
    classes = often.groupBy("host", "a", "b", "pages").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= CLASS_TOKENS)
    valid = classes.join(whole, "host").where(F.col("pages") >= F.greatest(F.lit(2), CLASS_SHARE * F.col("all_pages"))).select("host", "a", "b", "pages")
    one = F.struct("token", F.xxhash64("a", "b", "pages").alias("class"), (F.col("n") == F.col("pages")).alias("once"))
    return often.join(valid, ["host", "a", "b", "pages"]).groupBy("host").agg(F.sort_array(F.collect_list(one)).alias("candidates"))


def templates(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(found, facts)``: ``host, candidates`` as a table, and what all pages say of them, ``host, facts``.  Both are written."""
    found = cut(candidates(keyed), "candidates")
    shared = found.where(F.col("host") == OTHERS).first()
    own = found.where(F.col("host") != OTHERS)
    tie, size = F.xxhash64("page_id", "url"), F.size("candidates") * 17 + F.octet_length("host")
    seen = attach(keyed, own, "host", size, tie).select("host", "candidates", "html")
    seen = seen.mapInArrow(_judge(shared["candidates"] if shared else []), f"host string, {_FACTS}")
    sums = [F.min("low").alias("low"), F.max("high").alias("high"), F.max("named").alias("named"), F.sum("prose").alias("prose"), F.sum("headed").alias("headed")]
    facts = seen.groupBy("host", "kind", "id").agg(*sums).groupBy("host").agg(F.collect_list(F.struct("kind", "id", "low", "high", "named", "prose", "headed")).alias("facts"))
    return found, cut(facts, "facts")


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of each row of ``pages`` (page_id, url, html; others are ignored).

    Three passes read the pages: tokens, then orders and slots, then texts; the narrow tables between are written while the result is
    built.  A null or empty html has an empty text.  Pages without a readable address and hosts with a single page share one
    template.  page_id may be of any type, null or repeated; rows that repeat are pages of their host like others.  An
    empty table gives no rows.  A page takes some 100 times its bytes of memory while it is read.
    """
    keyed = _keyed(pages)
    found, facts = templates(keyed)
    both = found.join(facts, "host")
    shared = both.where(F.col("host") == OTHERS).first()
    default = Template.settled(*([r.asDict() for r in shared[c]] for c in ("candidates", "facts"))) if shared else None
    size = F.size("candidates") * 17 + F.size("facts") * 60 + F.octet_length("host")
    joined = attach(keyed, both.where(F.col("host") != OTHERS), "host", size, F.xxhash64("page_id", "url"))
    kind = dict(keyed.dtypes)["page_id"]
    return joined.select("page_id", "url", "host", "html", "candidates", "facts").mapInArrow(_extract(default), f"page_id {kind}, url string, text string, n_chars long")
