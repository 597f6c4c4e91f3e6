"""Each operator against a brute-force version or an exact round trip, with the odd rows its docstring speaks of."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from silverbrook.llm import exact_join, fingerprints, jaccard_join, language_id, mixing, motion_jpeg, packing, page_text, queries, quotations, rarity, substring_dedup, token_counts, wordarrays as wa
from silverbrook.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [(9001, None), (9002, ""), (9003, " \t\n"), (9004, "one"), (9005, "two words"), (9006, "é ß 漢字 Ω x"), (9007, "a b " * 40), (9008, "long " * 3000)]


@pytest.fixture(scope="module")
def docs(spark, data):
    """Documents with odd rows, a repeated row and columns whose names clash with the operators' own."""
    some = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "lang", "source")
    odd = spark.createDataFrame(ODD, "doc_id long, text string").withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit(None).cast("string"))
    all_ = some.unionByName(odd).unionByName(some.where("doc_id = 5"))
    return all_.withColumns({c: F.lit(c) for c in ("n_words", "size", "keys", "tag", "node", "bucket", "words", "rep")}).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("doc_id = -1")


# 1


def test_fingerprints_edit_and_order(docs, rows, empty):
    found = fingerprints.compare_edited(docs).collect()
    once = sorted(rows, key=lambda r: (-r[0], r[1]))
    expected = Counter()
    for k, (i, x) in enumerate(once):
        after, n = once[(k + 1) % len(once)][1], len(x)
        expected[i, n, hashlib.sha256((x[: n - n // 3] + after[: n // 3]).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == expected
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    long = [r for r in found if r.n_chars > 400 and r.doc_id < 9000]
    assert np.mean([r.near_edited > 0.15 for r in long]) > 0.95
    assert np.median([r.near_next for r in long]) < 0.05
    assert fingerprints.compare_edited(empty).count() == 0
    assert fingerprints.compare_edited(docs.where("doc_id = 9004")).first().near_next == 1.0
    null_ids = docs.limit(3).withColumn("doc_id", F.lit(None).cast("long"))
    assert fingerprints.compare_edited(null_ids).count() == 3


def test_fingerprints_of_far_and_repeated_ids(spark):
    """Buckets stay small whatever the ids, and the order of documents holds across them."""
    rng = random.Random(9)
    ids = [*range(1500), 1 << 61, -(1 << 63), (1 << 63) - 1, *[(7 << 48) + i for i in range(1500)], *[(9 << 40) + 5] * 1500, *[None] * 1500]
    rows = [(i, f"word{rng.randrange(10**6)} and word{k}") for k, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    dealt, n = fingerprints._bucketed(df)
    sizes = [r["count"] for r in dealt.groupBy("bucket").count().collect()]
    assert n == len(rows) and max(sizes) <= 3 * fingerprints.BUCKET
    nexts = {(r.doc_id, r.text): r.next_text for r in fingerprints.beside_next(df).select("doc_id", "text", "next_text").collect()}
    hashes = {r.text: r.h for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1]]))
    assert all(nexts[row] == order[(k + 1) % len(order)][1] for k, row in enumerate(order))


def _cyclic(hashes, k):
    """The cyclic polynomial of each k hashes."""
    out, mask = [], (1 << 64) - 1
    for i in range(len(hashes) - k + 1):
        value = 0
        for h in hashes[i : i + k]:
            value = ((value << 1 | value >> 63) & mask) ^ (h & mask)
        out.append(value)
    return out


def test_winnowing_chooses_rightmost_minimum(spark, rows):
    """Positions and hashes are those of the definition."""
    texts = [x for _, x in rows if len(x) > 400][:20] + ["a b c d " * 40]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id long, text string")
    grams = df.withColumn("u", F.filter(F.split("text", fingerprints.SPACE), lambda x: x != "")).withColumn("g", F.transform("u", lambda x: F.xxhash64(x)))
    known = {r.id: _cyclic(r.g, 3) for r in grams.collect()}
    for r in fingerprints.with_fingerprint(df).collect():
        g = known[r.id]
        w = 1
        while w < 16 and len(g) >= 16 * w:
            w *= 2
        expected = []
        for i in range(len(g) - w + 1):
            best = min(range(i, i + w), key=lambda j: (g[j] >> 33, -j))
            if (g[best], best) not in expected:
                expected.append((g[best], best))
        assert [(x.hash & (1 << 64) - 1, x.at) for x in r.words] == expected


def test_likeness_of_fingerprints(spark, docs, rows):
    """Both likenesses and both fingerprints, by value, from hashes of units alone; equal texts have equal fingerprints."""
    by_id = dict(rows)
    some = [(i, by_id[i]) for i in sorted(by_id)[:60] + [i for i, _ in ODD]] + [(8000, by_id[3]), (8001, "b a " * 30), (8002, "b a " * 30)]
    df = spark.createDataFrame(some, "doc_id long, text string")
    found = {r.doc_id: r for r in fingerprints.compare_edited(df).collect()}
    order = sorted(dict(some).items(), reverse=True)
    pairs = {i: (x, order[(k + 1) % len(order)][1]) for k, (i, x) in enumerate(order)}
    edited = {i: x[: len(x) - len(x) // 3] + y[: len(x) // 3] for i, (x, y) in pairs.items()}
    units = {u for x in [*edited.values(), *dict(some).values()] for u in [*WORD.findall(x), *(x if len(x) <= fingerprints.SHORT else "")]}
    hashes = {r.u: r.h for r in spark.createDataFrame([(u,) for u in units], "u string").select("u", F.xxhash64("u").alias("h")).collect()}

    def chosen(parts, k):
        g = _cyclic([hashes[u] for u in parts] + [0] * max(0, k - len(parts)), k) if parts else []
        w = 1
        while w < 16 and len(g) >= 16 * w:
            w *= 2
        return [(g[j], j) for j in dict.fromkeys(min(range(i, i + w), key=lambda j: (g[j] >> 33, -j)) for i in range(len(g) - w + 1))]

    def made(x):
        return chosen(WORD.findall(x), fingerprints.K), chosen(list(x), fingerprints.SHORT_K) if len(x) <= fingerprints.SHORT else None

    def alike(a, b):
        part = 1 if a[1] is not None and b[1] is not None else 0
        a, b = ({h for h, _ in y[part]} for y in (a, b))
        return len(a & b) / len(a | b) if a | b else 1.0

    text = lambda f: "|".join(" ".join(f"{h:X}:{j}" for h, j in part or ()) for part in f)
    for i, (x, y) in pairs.items():
        own, new, r = made(x), made(edited[i]), found[i]
        assert (r.fingerprint, r.edited_fingerprint) == (text(own), text(new))
        assert r.near_edited == pytest.approx(alike(own, new)) and r.near_next == pytest.approx(alike(own, made(y)))
    assert found[8001].fingerprint == found[8002].fingerprint and found[8000].fingerprint == found[3].fingerprint


# 2


def _page(body: str, head: str = "") -> str:
    return f"<html><head><title>t</title>{head}</head><body>{body}</body></html>"


def test_page_text_cases():
    text = lambda html: page_text.Page(html).main_text(None)
    html = _page(
        "<nav><a href=x>Home</a></nav><div class='cookie-notice'>We use cookies</div><header><h2>Site</h2></header>"
        "<article><h1>A &amp; B</h1><p>One\n  two<br>three <b>bold</b> <a href=y>link</a></p><p>Unclosed<p>Next&nbsp;&mdash; end"
        "<form><input>Send</form><script>var a='</p>';</script><aside>Ad</aside><ul><li>i<li>j</ul>"
        "<div id='comments'><p>First!</p></div></article><section class=comments><article>Reader</article></section><footer>c</footer>",
        "<style>p{}</style>",
    )
    assert text(html) == "A & B\n\nOne two three bold link\n\nUnclosed\n\nNext — end\n\ni\n\nj"
    assert text("") == "" and text("plain words") == "plain words" and text("<p>a < b</p>") == "a < b"
    assert text("<article><p>never closed") == "never closed"
    assert text("<script>only") == "" and text("<!-- x --><p>y") == "y"
    wrapped = _page("<div class='wrap has-sidebar'><div class=sidebar>s</div><article><h1>T</h1><p>" + "w " * 50 + "</p></article><div id=comments><article>" + "r " * 500 + "</article></div></div>")
    assert text(wrapped) == "T\n\n" + ("w " * 50).strip()
    quoted = _page("<article><p><a title=\"next > page\" href='/x'>link</a> <img alt=\"<b>bold</b> view\">end</p><div data-u=/a/>in</div><p title=it's>Don't \"stop\"</p><br/><i/>x<p class=\"open>y</p></article>")
    assert text(quoted) == "link end\n\nin\n\nDon't \"stop\"\n\nx\n\ny"
    boxes = "<article><p>lead</p><section class=share><p>Market share fell.</p></section><div class=related><p>Study</p></div><div class=reply><p>The minister's reply</p></div></article>"
    assert text(_page(boxes)) == "lead\n\nMarket share fell.\n\nStudy\n\nThe minister's reply"


def test_template_text_goes_and_skewed_join_agrees(spark, monkeypatch):
    pages = [(i, f"http://h{i % 2}.example.com/{i}", _page(f"<div><span>Shared banner</span><div><p>{'text%d ' % i * 30}</p><p>tail {i}</p></div></div>")) for i in range(12)]
    pages += [(50, None, None), (51, "not a url", ""), (52, "http://solo.example.org/", _page("<article><p>alone</p></article>")), (3, pages[3][1], pages[3][2])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"host": F.lit("x"), "tokens": F.lit(1)})
    found = sorted((r.page_id, r.text, r.n_chars) for r in page_text.extract_text(df).collect())
    expected = {i: f"{('text%d ' % i * 30).strip()}\n\ntail {i}" for i in range(12)} | {50: "", 51: "", 52: "alone"}
    assert found == sorted((p, expected[p], len(expected[p])) for p, _, _ in pages)
    monkeypatch.setattr("silverbrook.llm.storage.BROADCAST_BYTES", -1)
    assert sorted((r.page_id, r.text, r.n_chars) for r in page_text.extract_text(df).collect()) == found
    assert page_text.extract_text(df.limit(0)).count() == 0


def test_page_text_of_the_tables(spark, data):
    for r in page_text.extract_text(spark.read.parquet(f"{data}/pages.parquet")).join(spark.read.parquet(f"{data}/pages.parquet").select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        from html import unescape

        blocks = [re.sub(r"\s+", " ", unescape(re.sub(r"</?b>", "", b.replace("<br>", " ")))).strip() for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_page_text_loses_no_part_of_an_article():
    text = lambda html: page_text.Page(html).main_text(None)
    story, lead = ("word " * 60).strip(), ("lead " * 12).strip()
    assert text(_page(f"<div class=x><div><h1>Title</h1><p>{lead}</p><div class=body><p>{story}</p></div></div></div>")) == f"Title\n\n{lead}\n\n{story}"
    assert text(_page(f"<article><p>Teaser</p></article><main><h1>T</h1><p>{story}</p></main>")) == f"T\n\n{story}"
    assert text(_page(f"<div><article><p>{story}</p></article></div><div><article><p>{lead}</p></article></div>")) == f"{story}\n\n{lead}"
    assert text(_page(f"<article><p>Teaser</p></article><div><p>{story}</p></div>")) == f"Teaser\n\n{story}"
    two = f"<main><article><p>{story}</p></article><article><p><a href=x>{lead}</a></p></article></main>"
    assert text(_page(two)) == f"{story}\n\n{lead}"
    assert text(_page(f"<article><p><a href=x>One link</a></p><ul><li><a>Two</a><li><a>Three</a></ul></article><div class=x>.</div>")) == "One link\n\nTwo\n\nThree"
    odd = f"<article><p>a</p><h2 id='related'>Related work</h2><p>{lead}</p><p class='notice'>important</p><section id='social'><p>b</p></section><p class='ad-hoc'>c</p><div class='ad-hoc'>d</div><div class='ad-box'>e</div></article>"
    assert text(_page(odd)) == f"a\n\nRelated work\n\n{lead}\n\nimportant\n\nb\n\nc\n\nd\n\ne"
    slugs = f"<article><h2 id='social-effects'>Effects</h2><p>{story}</p><section id='related-work'><h2 id=related>Work</h2><p id='notice-periods'>{lead}</p></section><section id=comments><p>c</p></section></article>"
    assert text(_page(slugs)) == f"Effects\n\n{story}\n\nWork\n\n{lead}"


def _brute_templates(pages):
    """host -> template tokens, from whole occurrence vectors and whole orders."""
    hosts = defaultdict(dict)
    for i, url, html in pages:
        hosts[url.split("/")[2]][i] = page_text.Page(html)
    out = {}
    for host, read in hosts.items():
        counts, classes = {i: p.tokens() for i, p in read.items()}, defaultdict(set)
        for token in {t for c in counts.values() for t in c}:
            classes[tuple(counts[i][token] for i in sorted(counts))].add(token)
        chosen = set()
        for v, ts in classes.items():
            least = max(2, page_text.CLASS_SHARE * len(v))
            ts = {t for t in ts if sum(n > 0 for n in v) >= (max(least, page_text.TEXT_PAGES) if t % 2 else least)}
            orders = {tuple(dict.fromkeys(t for t in p._in_order() if t in ts)) for i, p in read.items() if counts[i].keys() & ts}
            if len(ts) >= page_text.CLASS_TOKENS and len(orders) == 1:
                chosen |= ts
        out[host] = frozenset(chosen)
    return out


def _found_templates(spark, pages):
    found, facts = page_text.templates(page_text._keyed(spark.createDataFrame(pages, "page_id long, url string, html string")))
    return {r.host: page_text.Template.settled(r.candidates, r.facts) for r in found.join(facts, "host").collect()}


def test_templates_are_those_of_whole_vectors(spark):
    """Pages without an article element: slots of the deduced template hold the planted article, and nothing else."""
    rng = random.Random(8)
    words = lambda n: " ".join("".join(rng.choice("abcdefghijklmnoprstu") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    pages, truth = [], {}
    for host in range(4):
        lines = [words(6) for _ in range(8)]
        box = "div" if host % 2 else "section"
        for k in range(1 + 9 * (host < 3)):
            blocks = [words(4), *(words(rng.randrange(5, 40)) for _ in range(rng.randrange(2, 6)))]
            body = "".join([f"<h1>{blocks[0]}</h1>", *(f"<p>{b}</p>" for b in blocks[1:])])
            links = "".join(f"<li><a href=/{i}>{lines[i]}</a></li>" for i in range(4))
            some = f"<div class=m>{lines[6]}<span>{lines[7]}</span></div>" if k % 3 else ""
            page = len(pages)
            pages.append((page, f"http://h{host}.example.com/{k}", _page(f"<div class=a><b>{lines[4]}</b><i>{lines[5]}</i></div><div class=z><ul>{links}</ul></div>{some}<{box} class=q><div class=r>{body}</div></{box}><div class=y>{lines[6]} {lines[7]}</div><div class=y2>{lines[0]}</div>")))
            truth[page] = "\n\n".join(blocks) if host < 3 else None
    found = {r.page_id: r.text for r in page_text.extract_text(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)).collect()}
    plain = _brute_templates(pages)
    made = _found_templates(spark, pages)
    assert {h: t.tokens for h, t in made.items()} == {h: ts for h, ts in plain.items() if ts}
    for page, url, html in pages:
        assert found[page] == page_text.Page(html).main_text(made.get(url.split("/")[2]))
        assert truth[page] is None or found[page] == truth[page]


def test_classes_must_keep_their_order(spark):
    """Two lines that change places from page to page are no template; in one place they are."""
    pages = []
    for i in range(8):
        lines = ["<p>First line</p>", "<p>Second line</p>"]
        for host in range(2):
            body = "".join(lines[:: -1 if host and i % 2 else 1])
            pages.append((len(pages), f"http://h{host}.example.com/{i}", _page(f"<article><h1>Head {i}</h1>{body}<p>{f'own{i} ' * 30}</p></article>")))
    found = {r.page_id: r.text for r in page_text.extract_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all("First" not in found[p] for p in found if p % 2 == 0) and all("First" in found[p] for p in found if p % 2)
    assert {h: t.tokens for h, t in _found_templates(spark, pages).items()} == _brute_templates(pages)


def test_slots_decide_what_names_do_not(spark):
    """Boxes beside the article go whatever they are called, in hosts of one page by the template that such hosts share."""
    own = lambda i: f"text{i} " * 40
    body = lambda i, box: _page(f"<div class={box}><p>Buy number {i}</p></div><div class=k><h1>Head {i}</h1><p>{own(i)}</p><div class={box}><p>In the middle {i}</p></div></div><div>Number {i} of many</div>")
    pages = [(i, f"http://a.example.com/{i}", body(i, "c17")) for i in range(6)] + [(10 + i, f"http://b.example.com/{i}", body(i, "advert-box")) for i in range(6)]
    pages += [(20 + i, f"http://only{i}.example.com/", body(i, "promo")) for i in range(6)]
    found = {r.page_id: r.text for r in page_text.extract_text(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)).collect()}
    assert found == {p: f"Head {p % 10}\n\n{own(p % 10).strip()}\n\nIn the middle {p % 10}" for p, *_ in pages}
    empty = page_text.Template(frozenset(), page_text.ROOT)
    assert all(page_text.Page(html).main_text(empty) != found[p] for p, _, html in pages)


def test_pages_that_are_hard_to_parse():
    """Time in proportion to the length for deep, unclosed and broken markup."""
    import time

    for html in ("<a b" * 100_000, "<a " + '"' * 400_000, "<script " * 50_000, "<div>" * 80_000 + "end", "<b>" * 60_000 + "</i>" * 60_000, "<p><div>" + "<b>" * 60_000 + "<li>" * 60_000, "<!-- " * 80_000, "<" * 400_000):
        begun = time.time()
        page = page_text.Page(html)
        page.main_text(page_text.Template(frozenset(page.tokens()), page_text.ROOT))
        list(page.facts(dict.fromkeys(page.tokens(), 1), frozenset(page.tokens())))
        assert time.time() - begun < 20
    assert page_text.Page("<div>" * 80_000 + "end").main_text(None) == "end"
    deep = "<div>" * 600 + "<p>one</p></div><p>two</p>"
    assert page_text.Page(deep).main_text(None) == "one\n\ntwo"


def test_template_text_inside_articles_goes(spark):
    """Lines that a host repeats go from articles and paragraphs too; pages that are copies keep their text."""
    own = lambda i: f"text{i} " * 20
    pages = [(i, f"http://a.example.com/{i}", _page(f"<article><h1>Head {i}</h1><p>{own(i)}</p><p>Read our weekly letter</p><span>Tell your friends</span></article>")) for i in range(6)]
    pages += [(10 + i, f"http://b.example.com/{i}", _page(f"<div><p>All rights are ours</p><div><h1>Head {i}</h1><p>{own(i)}</p></div></div>")) for i in range(6)]
    pages += [(20 + i, f"http://c.example.com/{i}", _page("<article><h1>Same</h1><p>The same text twice</p></article>")) for i in range(2)]
    pages += [(30 + i, f"http://d.example.com/{i}", _page(f"<article><p>Card</p></article><div><h1>Head {i}</h1><p>{own(i)}</p></div>")) for i in range(6)]
    found = {r.page_id: r.text for r in page_text.extract_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for i in range(6):
        for base in (0, 10, 30):
            assert found[base + i] == f"Head {i}\n\n{own(i).strip()}"
    assert found[20] == found[21] == "Same\n\nThe same text twice"


# 3


def test_quotations(spark):
    messages = [
        (1, 0, "user", "How do I sort a big table?\nIt does not fit in memory."),
        (1, 1, "assistant", "> how do I sort a big  table\nUse an external sort."),
        (1, 2, "user", ">> How do I sort a big table?\n> Use an external sort.\nThanks, it works very well."),
        (2, 0, "user", "> It does not fit in memory.\nSame problem here today."),
        (2, 1, "user", None),
        (3, 0, "user", "> nobody ever said this line\n> ok"),
        (3, 0, "user", "> nobody ever said this line\n> ok"),
        (None, 0, "user", "> How do I sort a big table?"),
    ]
    df = spark.createDataFrame(messages, "conv_id long, turn long, role string, text string").withColumns({"level": F.lit(1), "hash": F.lit("h")})
    out = {(r.conv_id, r.turn): r for r in quotations.reply_conversations(df).collect()}
    assert quotations.reply_conversations(df).count() == len(messages)
    assert (out[1, 1].parent_conv, out[1, 1].parent_turn, out[1, 1].depth, out[1, 1].body) == (1, 0, 1, "Use an external sort.")
    assert (out[1, 2].parent_turn, out[1, 2].depth, out[1, 2].n_quoted, out[1, 2].n_linked) == (1, 2, 2, 2)
    assert (out[2, 0].parent_conv, out[2, 0].parent_turn, out[2, 0].thread_id) == (1, 0, 1)
    assert out[2, 1].body == "" and out[3, 0].n_linked == 0 and out[3, 0].n_quoted == 2 and out[3, 0].thread_id == 3
    assert out[None, 0].parent_conv is None
    assert quotations.reply_conversations(df.limit(0)).count() == 0


def test_a_line_that_all_say_links_once(spark):
    df = spark.createDataFrame([(c, t, "user", "this is the same long line" if t < 3 else "> this is the same long line") for c in range(30) for t in range(4)], "conv_id long, turn long, role string, text string")
    links = quotations.link_quotations(df).collect()
    assert len(links) == 30 and all((r.to_conv, r.to_turn) == (r.conv_id, 2) for r in links)


def test_wrapped_and_short_quotations(spark):
    messages = [
        (1, 0, "The quick brown fox jumps over the lazy dog while the cat sleeps in the warm sun"),
        (1, 1, "> The quick brown fox jumps over\n> the lazy dog while the cat\n> sleeps in the warm sun\nIndeed it does."),
        (2, 0, "First sentence of some length. Second sentence that is also long.\nYes."),
        (2, 1, ">> First sentence of\n>> some length. Second sentence\n>> that is cut\nI see."),
        (2, 2, "> Yes.\n> 好的\nFine"),
        (3, 0, "Yes.\n好的"),
        (3, 1, "> 好的\nok"),
        (4, 0, "wrapped by its author over\nseveral lines of text"),
        (5, 0, "> wrapped by its author over several lines of text\nnew"),
        (6, 0, "no"),
        (6, 1, "no"),
        (6, 2, "> no\nwhich"),
    ]
    df = spark.createDataFrame([(c, t, "user", x) for c, t, x in messages], "conv_id long, turn long, role string, text string")
    out = {(r.conv_id, r.turn): (r.parent_conv, r.parent_turn, r.n_linked) for r in quotations.reply_conversations(df).collect()}
    assert out[1, 1] == (1, 0, 3) and out[2, 1] == (2, 0, 2) and out[2, 2] == (2, 0, 1)
    assert out[3, 1] == (3, 0, 1) and out[5, 0] == (4, 0, 1) and out[6, 2] == (None, None, 0)


def test_short_quotations_link_where_one_message_says_them(spark):
    messages = [(1, 0, "short one\nsaid once"), (1, 1, "both say"), (2, 0, "both say"), (3, 0, "> short one\n> both say\n> ---\n> unheard\nmine")]
    df = spark.createDataFrame([(c, t, "user", x) for c, t, x in messages], "conv_id long, turn long, role string, text string")
    out = {(r.conv_id, r.turn): r for r in quotations.reply_conversations(df).collect()}
    assert (out[3, 0].parent_conv, out[3, 0].parent_turn, out[3, 0].n_quoted, out[3, 0].n_linked, out[3, 0].thread_id) == (1, 0, 3, 1, 1)


def test_lines_that_announce_quotations_go(spark):
    texts = {
        "On Monday Ann wrote:\n> hello there\nHi Ann": "Hi Ann",
        "Hi\n\nAm 3. Mai schrieb Bob <b@x.de>:\n\n> hallo": "Hi",
        "Bob said:\nnothing of note\n> other": "Bob said:\nnothing of note",
        "They wrote:\nno quotation here": "They wrote:\nno quotation here",
        "Le 3 mai, Zoé a écrit :\r\n> oui\r\nnon\rpeut-être": "non\npeut-être",
        "a > b\nwrites:": "a > b\nwrites:",
    }
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i long, text string")
    assert [r.b for r in df.select("i", quotations.unquoted(F.col("text")).alias("b")).orderBy("i").collect()] == list(texts.values())


def test_conversations_are_written_in_reply_order(spark, tmp_path):
    rows = [(c, t, "user", f"say {c} {t} in so many words" if not t else f"> say {c % 3} 0 in so many words\nanswer {t}") for c in range(9) for t in range(1 + c % 4)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    quotations.write_conversations(df, str(tmp_path / "threads"), 3)
    found = spark.read.parquet(str(tmp_path / "threads"))
    threads = defaultdict(list)
    for path in sorted((tmp_path / "threads").glob("*.parquet")):
        for r in spark.read.parquet(str(path)).collect():
            threads[r.thread_id].append((r.position, r.conv_id, r.turn))
    assert found.count() == len(rows) and set(threads) == {0, 1, 2, 4, 8}
    for seen in threads.values():
        assert [p for p, *_ in seen] == list(range(1, len(seen) + 1)) and [x[1:] for x in seen] == sorted(x[1:] for x in seen)


def _brute_threads(messages):
    """What reply_conversations says of each (conv, turn), with plain loops."""
    said, quoted = set(), set()
    for c, t, _, x in messages:
        if c is not None and t is not None:
            said |= {(c, t, u[4], u[5]) for u in quotations._units_of(x or "", False)}
            quoted |= {(c, t, x, *u) for u in quotations._units_of(x or "", True)}
    lines = defaultdict(lambda: [0, None, None])
    for c, t, x, first, last, level, kind, key, short in quoted:
        earlier = sorted(u for d, u, k, _ in said if d == c and k == key and u < t)
        anywhere = sorted((d, u) for d, u, k, _ in said if k == key)
        to = None
        if earlier and (not short or len(set(earlier)) == 1):
            to = (c, earlier[-1])
        elif anywhere and anywhere[0] < (c, t) and (not short or len(anywhere) == 1):
            to = anywhere[0]
        for n in range(first, last + 1):
            row = lines[c, t, x, n]
            row[0] = max(row[0], level)
            row[1] = max(row[1] or "", key) if kind == 0 else row[1]
            if to:
                row[2] = min(row[2] or (9,), (kind, first, to))
    shown = defaultdict(lambda: (set(), set(), Counter()))
    pairs = []
    for (c, t, _, n), (level, key, to) in lines.items():
        if key or to:
            counted, linked, votes = shown[c, t]
            counted.add(n)
            if to:
                linked.add(n)
                votes[level, to[2]] += 1
                pairs.append((c, to[2][0]))
    parent = {m: max(v[2].items(), key=lambda i: (-i[0][0], i[1], i[0][1]))[0][1] for m, v in shown.items() if v[2]}
    top = {}

    def find(c):
        while top.get(c, c) != c:
            c = top[c]
        return c

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        top[y] = x
    out = {}
    for c, t, *_ in messages:
        depth, at = 0, (c, t)
        while at in parent:
            depth, at = depth + 1, parent[at]
        counted, linked, _ = shown.get((c, t), (set(), set(), None))
        out[c, t] = (len(counted), len(linked), *parent.get((c, t), (None, None)), depth, find(c))
    return out


@pytest.mark.parametrize("kind", ["long", "string"])
def test_quotations_against_plain_loops(spark, kind, monkeypatch):
    rng = random.Random(12)
    pool = ["yes", "no, thanks", "ok"] + [" ".join("".join(rng.choice("abcdeghilmnoprst") for _ in range(rng.randrange(2, 8))) for _ in range(rng.randrange(3, 14))) + rng.choice([".", "!", "?", ""]) for _ in range(40)]
    name = (lambda c: c) if kind == "long" else (lambda c: f"c{c:03}")
    messages = []
    for c in range(40):
        for t in range(rng.randrange(1, 7)):
            lines = []
            for _ in range(rng.randrange(3)):
                if messages and rng.random() < 0.8:
                    source = rng.choice(messages[-6:] if rng.random() < 0.7 else messages)[3] or "nothing"
                    words = " ".join(rng.sample(source.split("\n"), rng.randrange(1, 1 + len(source.split("\n"))))).split()
                    while words:  # wrapped elsewhere, and one level deeper
                        k = rng.randrange(2, 20)
                        line, words = " ".join(words[:k]), words[k:]
                        lines.append(("> " if not line.startswith(">") else ">") + (line.upper() if rng.random() < 0.1 else line))
            lines += [" ".join(rng.sample(pool, rng.randrange(1, 3))) for _ in range(rng.randrange(1, 4))]
            messages.append((name(c), t, "user", "\n".join(lines)))
    messages += [messages[3], (name(5), 1, "user", "> " + pool[5]), (name(41), 0, "user", None), (name(41), 1, "user", "")]
    df = spark.createDataFrame([*messages, (None, 0, "user", "> " + pool[4]), (name(1), None, "user", pool[4])], f"conv_id {kind}, turn long, role string, text string").repartition(3)
    expected = _brute_threads(messages)
    seen = lambda: {(r.conv_id, r.turn): (r.n_quoted, r.n_linked, r.parent_conv, r.parent_turn, r.depth, r.thread_id) for r in quotations.reply_conversations(df).collect() if r.conv_id is not None and r.turn is not None}
    assert seen() == expected
    assert sum(v[1] > 0 for v in expected.values()) > 30 and max(v[4] for v in expected.values()) > 1
    if kind == "long":  # hot lines dealt to parts
        monkeypatch.setattr("silverbrook.llm.storage.BROADCAST_BYTES", -1)
        assert seen() == expected


# 4


def _shingles(text: str, n: int) -> frozenset:
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def _classes(rows, n, percent):
    sets = {i: _shingles(x, n) for i, x in rows}
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    by = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            by[g].append(i)
    for i, s in sets.items():
        for j, both in Counter(j for g in s for j in by[g] if j < i).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                top[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_a_chained_family_is_copied_by_its_keys(spark, monkeypatch):
    """Texts that are alike in a chain: the tiles of a text are no more than its keys, however long the chain is."""
    monkeypatch.setattr(jaccard_join, "TILE_TEXTS", 4)
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdeghilmnoprst") for _ in range(6)) for _ in range(900)]
    rows = [(i, " ".join(words[i * 3 : i * 3 + 60])) for i in range(280)] + [(1000 + i, " ".join(words[i : i + 3])) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    whole = jaccard_join.placed_tiles
    monkeypatch.setattr(jaccard_join, "placed_tiles", lambda *a: seen.append(whole(*a)) or seen[-1])
    found = {r.doc_id: r.component_id for r in jaccard_join.jaccard_classes(docs, 4, 85).collect()}
    assert found == {i: c for i, (_, c) in _classes(rows, 4, 85).items()} and found[279] == 0
    sizes = [r.n for r in seen[0].select(F.size("tiles").alias("n")).collect()]
    assert len(sizes) == 280 and max(sizes) <= 2 * jaccard_join.bands(0.85) < 280 / 4
    assert "key/" in seen[0].first().tiles[0]


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (2, 60)])
def test_jaccard_classes(docs, rows, n, percent, monkeypatch):
    expected = _classes(rows, n, percent)
    if n == 2:  # many tiles
        monkeypatch.setattr(jaccard_join, "TILE_TEXTS", 2)
    found = jaccard_join.jaccard_classes(docs, n, percent).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected


def test_jaccard_large_family_and_empty(spark, empty):
    rng = random.Random(1)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 400):
        w = list(base)
        for _ in range(rng.randrange(5)):
            w[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_classes(df).collect()}
    assert found == _classes(rows, 4, 85)
    assert jaccard_join.jaccard_classes(empty).count() == 0


def test_tile_links_bound_loses_nothing():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 300).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(300) > rng.random() * 0.2], rng.integers(0, 2**63, rng.integers(0, 20)).astype(np.uint64)])) for _ in range(60)]
    links = jaccard_join.tile_links(np.arange(60), sets, 85)

    def classes(edges):
        top = list(range(60))
        for a, b in edges:
            x, y = top[a], top[b]
            top = [x if t == y else t for t in top]
        return [top.index(t) for t in top]

    exact = [(i, j) for i in range(60) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))]
    assert exact and classes(links) == classes(exact)


def test_prefixes_and_bitmaps_lose_no_link():
    """Sets that link share an n-gram of their prefixes and pass the bound of their bitmaps, whatever the classes."""
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 300).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(300) > rng.random() * 0.2], rng.integers(0, 2**63, rng.integers(0, 20)).astype(np.uint64)])) for _ in range(60)]
    sets += [np.unique(rng.choice(base[:9], rng.integers(1, 9))) for _ in range(60)]
    sets.sort(key=len)
    values, at = np.concatenate(sets), np.cumsum([0] + [len(x) for x in sets])
    size, n = np.diff(at), len(sets)
    exact = {(i, j) for j in range(n) for i in range(j) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))}
    grams, ends = exact_join.prefixes(values, at, rng.integers(0, 3, rarity.SLOTS).astype(np.uint8), 85)
    heads = [set(grams[i:j].tolist()) for i, j in zip(ends[:-1], ends[1:], strict=True)]
    assert len(exact) > 20 and all(heads[i] & heads[j] for i, j in exact)
    bits = exact_join.Bitmaps(pa.array(exact_join.bitmaps(values, at), pa.binary()))
    pairs = np.array([(i, j) for j in range(n) for i in range(j)])
    apart = bits.apart(pairs[:, 0], pairs[:, 1])
    assert all(k <= len(np.setxor1d(sets[i], sets[j])) for (i, j), k in zip(pairs, apart, strict=True))
    none = np.zeros(n, bool)
    found = {(int(x), int(y)) for a, b in exact_join.candidates(np.zeros(n, np.int64), size, bits, np.arange(n), none, 85) for x, y in zip(a, b, strict=True)}
    assert exact <= found and len(found) < len(pairs) / 2


def test_forest_spans():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 200, (2, 300))
    a, b = a[a != b], b[a != b]
    taken = exact_join.forest(a, b, 200)

    def top(edges):
        label = np.arange(200)
        for x, y in edges:
            label[label == max(label[x], label[y])] = min(label[x], label[y])
        return label

    chosen = list(zip(a[taken], b[taken], strict=True))
    whole = top(zip(a, b, strict=True))
    assert (top(chosen) == whole).all() and len(chosen) == 200 - len(set(whole.tolist()))


def test_jaccard_long_chain_is_linear(spark):
    """Texts of which each shares three quarters with the next form no family of which all pairs meet."""
    rng = random.Random(5)
    words = [f"w{rng.randrange(10**7)}" for _ in range(3000 * 10 + 40)]
    rows = [(i, " ".join(words[10 * i : 10 * i + 40])) for i in range(3000)] + [(5000 + i, " ".join(words[10 * i : 10 * i + 39])) for i in range(0, 3000, 100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    signed, made, nodes = exact_join._nodes(df, 4, 85)
    lists = exact_join._lists(nodes, 85)
    nothing = nodes.select("rep").limit(0).select("rep", F.col("rep").alias("label"))
    assert exact_join._all_tiles(lists, nothing).count() < 40 * len(rows)
    assert lists.count() < 2 * len(rows)
    found = {r.doc_id: r.component_id for r in exact_join.exact_classes(df).collect()}
    assert all(found[5000 + i] == i for i in range(0, 3000, 100)) and len(set(found.values())) == 3000


def test_jaccard_null_ids_and_all_links(spark):
    text = " ".join(f"w{i}" for i in range(60))
    near = text + " x"
    df = spark.createDataFrame([(None, text), (7, text), (5, text), (5, text), (9, near), (None, near), (11, "other words that stand alone here"), (12, None), (13, "")], "doc_id long, text string")
    for classes in (exact_join.exact_classes, jaccard_join.jaccard_classes):
        found = sorted(((r.doc_id or 0), r.component_id) for r in classes(df).collect())
        assert found == [(0, None), (0, None), (5, 5), (5, 5), (7, 5), (9, 5), (11, 11), (12, 12), (13, 13)]
    counts = {r.doc_id: r.n_links for r in exact_join.link_counts(df).collect()}
    assert counts == {5: 2, 7: 2, 9: 2, 11: 0, 12: 0, 13: 0}


def test_jaccard_all_links_are_found(docs, rows):
    """Recall and precision of the links between different sets, against all pairs."""
    links, members = exact_join.exact_links(docs, 2, 60, spanning=False)
    sets = {}
    for i, x in rows:
        sets.setdefault(_shingles(x, 2), i)
        sets[_shingles(x, 2)] = min(i, sets[_shingles(x, 2)])
    sets = {i: s for s, i in sets.items() if s}
    exact = {(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= 60 * len(sets[i] | sets[j])}
    assert {(r.a, r.b) for r in links.collect()} == exact and exact


def test_exact_and_minhash_joins_agree(spark, data, monkeypatch):
    """Recall of the minhash families at the threshold and just above it: all that the exact join finds."""
    monkeypatch.setattr(exact_join, "TILE", 2)
    rng, rows = random.Random(31), []
    for g in range(60):
        base = [f"g{g}w{i}" for i in range(403)]
        rows.append((10 * g, " ".join(base)))
        for k in range(1, 4):  # of 400 shingles 32 or 33 change: a similarity of 368/432 to 367/433, on either side of 0.85
            cut = [*base[: 400 - 32 - rng.randrange(2) + 3], *(f"g{g}x{k}y{i}" for i in range(32))]
            rows.append((10 * g + k, " ".join(cut)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    exact = {r.doc_id: r.component_id for r in exact_join.exact_classes(df).collect()}
    assert exact == {i: c for i, (_, c) in _classes(rows, 4, 85).items()}
    assert len(set(exact.values())) < len(rows) and {r.doc_id: r.component_id for r in jaccard_join.jaccard_classes(df).collect()} == exact


@pytest.mark.parametrize("hub", [1000, 5])
def test_components(spark, hub, monkeypatch):
    monkeypatch.setattr("silverbrook.llm.components.HUB_EDGES", hub)
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000, i) for i in range(1001, 1200)] + [(i, i + 1) for i in range(2000, 2100)] + [(None, 5)]
    top = {}

    def find(i):
        top.setdefault(i, i)
        while top[i] != i:
            i = top[i]
        return i

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            top[y] = x
    found = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: find(i) for i in top}


# 5


def test_language_held_out(spark, data):
    docs = spark.read.parquet(f"{data.replace('0.001', '0.01')}/documents.parquet")
    model = language_id.document_model(docs.where("doc_id % 2 = 0"))
    held = docs.where("doc_id % 2 = 1")
    plain = held.select(F.col("doc_id").alias("id"), "text", F.lit(None).cast("string").alias("declared"), F.lit(None).cast("string").alias("host"))
    found = language_id.identify(plain, model).join(held.select(F.col("doc_id").alias("id"), "lang"), "id").collect()
    assert np.mean([r.language == r.lang for r in found]) > 0.97
    pages = language_id.identify_pages(spark.read.parquet(f"{data}/pages.parquet"), model)
    assert pages.where("language = declared").count() > 0.97 * pages.count()


def test_language_evidence_and_odd_rows(spark, data, docs, empty):
    model = language_id.document_model(spark.read.parquet(f"{data}/documents.parquet"))
    weak = [(i, "the and of it with that", "en", "a.example.fr") for i in range(30)] + [(100, "", None, None), (101, None, "fr", "b.example.fr"), (102, "12 34", None, None), (100, "", None, None)]
    out = {r.id: r for r in language_id.identify(spark.createDataFrame(weak, "id long, text string, declared string, host string"), model).collect()}
    assert out[0].language == "en" and out[100].language == "und" and out[102].language == "und" and out[101].trigrams == 0
    kept = language_id.accepted(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert {r for r in range(200)} <= ids and not ids & {9001, 9002, 9003}
    assert language_id.accepted(empty).count() == 0


@pytest.mark.parametrize("broadcast", [True, False])
def test_fused_evidence_against_plain_sums(spark, data, broadcast, monkeypatch):
    """Priors of hosts and suffixes, declarations and leave-one-out, from the likelihoods alone."""
    if not broadcast:
        monkeypatch.setattr("silverbrook.llm.storage.BROADCAST_BYTES", -1)
    docs = spark.read.parquet(f"{data}/documents.parquet")
    model = language_id.document_model(docs)
    rng, width = random.Random(7), len(model.hypotheses)
    texts = [" ".join(r.text.split()[:3]) for r in docs.select("text").limit(60).collect()] + ["", None, "1 2 3", "zq xv"]
    rows = [(i, rng.choice(texts), rng.choice([None, "en", "DE", "xx"]), rng.choice([None, "a.example.de", "b.example.de", "c.example.org", "HOST"])) for i in range(300)]
    rows += [rows[0], (None, texts[0], "en", None)]
    logs, n = model.score(pa.array([x for _, x, _, _ in rows], pa.string()), False)
    soft = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    own = [soft(x) if k else np.zeros(width) for x, k in zip(logs, n, strict=True)]
    hosts, suffixes, said = (defaultdict(lambda: np.zeros(width)) for _ in range(3))
    for (_, _, d, h), p in zip(rows, own, strict=True):
        host = (h or "").lower()
        hosts[host] += p
        suffixes[host.split(".")[-1]] += p
        if d:
            said[d.lower()] += p
    base = sum(own) + 0.5
    base /= base.sum()
    spoken = sum(said.values())
    expected = Counter()
    for (i, _, d, h), p, x, k in zip(rows, own, logs, n, strict=True):
        host = (h or "").lower()
        s = suffixes[host.split(".")[-1]]
        prior = (s + language_id.SUFFIX_PULL * base) / (s.sum() + language_id.SUFFIX_PULL)
        others = np.maximum(0, hosts[host] - p)
        fused = x + np.log((others + language_id.HOST_PULL * prior) / (others.sum() + language_id.HOST_PULL))
        if d:
            c = said[d.lower()]
            fused = fused + np.log((c + language_id.DECLARED_PULL * (c.sum() + 1) / (spoken.sum() + 10)) / (spoken + language_id.DECLARED_PULL))
        post = soft(fused)
        blind = not k and not d and not h
        expected[i, "und" if blind else model.hypotheses[post.argmax()], round(float(post.max()), 9), model.hypotheses[x.argmax()] if k else "und", int(k)] += 1
    df = spark.createDataFrame(rows, "id long, text string, declared string, host string").repartition(3)
    found = Counter((r.id, r.language, round(r.posterior, 9), r.text_language, r.trigrams) for r in language_id.identify(df, model).collect())
    assert found == expected


def test_equal_posteriors_and_long_texts(spark):
    same = [(i, "the very same words", x) for i, x in enumerate(("bb", "aa"))]
    model = language_id.fit(spark.createDataFrame(same, "id long, text string, label string"))
    found = language_id.identify(spark.createDataFrame([(1, "the very same words", None, None)], "id long, text string, declared string, host string"), model).first()
    assert found.language == found.text_language == "aa"
    text = "der Text über ein Haus " * 500
    whole = model.score(pa.array([text, "x", text]), False)
    parts = language_id.Model(model.languages, model.logs)
    language_id.BLOCK, block = 1 << 10, language_id.BLOCK
    try:
        small = parts.score(pa.array([text, "x", text]), False)
    finally:
        language_id.BLOCK = block
    assert (whole[1] == small[1]).all() and np.allclose(whole[0], small[0])


def test_rare_labels_are_fitted(spark, empty):
    """Each label has rows in the sample, whatever the table's size and however many labels there are."""
    rare = "ქართული ენის ტექსტი აქ არის და კიდევ სიტყვები"
    common = [(i, f"the house number {i} and the street of it", "en", "s") for i in range(3000)]
    docs = spark.createDataFrame([*common, (9000, rare, "ka", "s"), (9001, "123", "xx", "s")], "doc_id long, text string, lang string, source string")
    model = language_id.fit(docs.selectExpr("doc_id id", "text", "lang label"), rows=20)
    assert model.languages == ["en", "ka"]
    batch = pa.array([rare, "the street and the house"])
    assert [model.hypotheses[i] for i in model.score(batch, False)[0].argmax(1)] == ["ka", "en"]
    same = spark.createDataFrame([(1, "one text again", "en")] * 3000 + [(2, rare, "ka")], "id long, text string, label string")
    assert abs(language_id.fit(same, rows=1).logs[0] - language_id.fit(same.limit(0), rows=1).logs[0]).max() > 1
    many = spark.range(230).selectExpr("id doc_id", "concat('text of the label ', id) text", "concat('l', id) lang", "'s' source")
    assert len(language_id.document_model(many).languages) == 230
    null_ids = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert 9000 in {r.doc_id for r in language_id.accepted(docs).collect()} and rare in {r.text for r in language_id.accepted(null_ids).collect()}


# 6


def test_motion_jpeg_round_trip(docs, rows):
    found = {r.doc_id: r for r in motion_jpeg.media_digests(docs).collect()}
    files = {r.doc_id: bytes(r.media) for r in motion_jpeg.text_videos(docs.where("doc_id >= 9000")).collect()}
    for i, x in rows:
        raw = x.encode()
        payload = raw + b" " * (max(192, -(-len(raw) // 192) * 192) - len(raw))
        r = found[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        if i in files:
            assert hashlib.sha256(files[i]).hexdigest() == r.media_sha256 and len(files[i]) == r.media_bytes
            assert motion_jpeg.read_samples(files[i])[0].tobytes() == payload


def test_decoder_agrees_symbol_by_symbol():
    samples = np.random.default_rng(5).integers(0, 256, (3, motion_jpeg.FRAME)).astype(np.uint8)
    samples[1] = 255
    data, size = motion_jpeg.encode_frames(samples)
    at = np.cumsum(size) - size
    for k in range(3):
        pixels = motion_jpeg.decode_frame(data[at[k] : at[k] + size[k]].tobytes())
        assert (pixels.reshape(motion_jpeg.HIGH, 8, motion_jpeg.WIDE, 8) == samples[k].reshape(motion_jpeg.HIGH, 1, motion_jpeg.WIDE, 1)).all()


def test_shots_and_bad_files(spark):
    rng = np.random.default_rng(1)
    dark, light = rng.integers(0, 60, (10, 192)), rng.integers(180, 240, (15, 192))
    media = motion_jpeg.write_avi(np.concatenate([dark, light]).astype(np.uint8).tobytes())
    df = spark.createDataFrame([(1, bytearray(media)), (2, None), (3, bytearray(b"RIFFxxxxWAVE")), (4, bytearray(media[: len(media) // 2]))], "doc_id long, media binary")
    out = defaultdict(list)
    for r in motion_jpeg.clips(df).collect():
        out[r.id].append((r.clip, r.first_frame, r.end_frame, r.start_s, r.error is None))
    assert sorted(out[1]) == [(0, 0, 10, 0.0, True), (1, 10, 25, 0.4, True)]
    assert [x[-1] for x in out[2] + out[3]] == [False, False] and out[4]
    assert len(motion_jpeg.find_shots(np.zeros((30, 192), np.uint8))) == 1


def test_shots_against_plain_loops():
    rng = np.random.default_rng(4)
    for frames in (2, 3, 40, 200):
        base = np.repeat(rng.integers(0, 256, (frames // 10 + 1, motion_jpeg.FRAME)), 10, 0)[:frames]
        samples = np.clip(base + rng.integers(-9, 9, base.shape), 0, 255).astype(np.uint8)
        bins = [np.bincount(f >> 4, minlength=motion_jpeg.BINS) for f in samples]
        change = [np.abs(x - y).sum() / (2 * motion_jpeg.FRAME) for x, y in zip(bins, bins[1:], strict=False)]
        cuts = [0]
        for i, c in enumerate(change):
            near = [change[j] for j in range(max(0, i - motion_jpeg.AROUND), min(len(change), i + motion_jpeg.AROUND + 1)) if j != i]
            mean, spread = (np.mean(near), np.std(near)) if near else (0, 0)
            if c > max(motion_jpeg.LEAST, mean + motion_jpeg.DEVIATIONS * spread):
                cuts.append(i + 1)
        assert motion_jpeg.find_shots(samples).tolist() == cuts


# 7


def _best(word: str, scores: dict) -> tuple[float, int]:
    best = [(0.0, 0)] + [(-1e300, 0)] * len(word)
    for j in range(1, len(word) + 1):
        options = [(best[i][0] + scores[word[i:j]], best[i][1] + 1) for i in range(j) if word[i:j] in scores]
        size = len(word[j - 1].encode())
        if word[j - 1] not in scores:
            options.append((best[j - 1][0] + token_counts.BYTE_SCORE * size, best[j - 1][1] + size))
        best[j] = max(options, key=lambda o: o[0])
    return best[-1]


def test_token_counts(docs, rows, empty, monkeypatch):
    path = queries.tokenizer_path("piece_bpe_32k.model")
    scores = token_counts.vocabulary(path)
    monkeypatch.setattr(token_counts, "MOST_NODES", 5000)
    known: dict = {}
    found = {r.doc_id: (r.n_words, r.n_tokens, r.log_score) for r in token_counts.count_tokens(docs, path).collect()}
    for i, x in rows:
        words = WORD.findall(x)
        for w in words:
            if w not in known:
                known[w] = _best(token_counts.MARK + w, scores)
        assert found[i][0] == len(words)
        assert found[i][2] == pytest.approx(sum(known[w][0] for w in words))
        assert found[i][1] == sum(known[w][1] for w in words)
    assert token_counts.count_tokens(empty, path).count() == 0


# 8


def _deduped(rows, window):
    seen, out = set(), {}
    for i, x in sorted(dict(rows).items()):
        w = WORD.findall(x)
        gone = set()
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            if key in seen:
                gone.update(range(s, s + window))
            seen.add(key)
        out[i] = (len(w), len(gone), hashlib.sha256(" ".join(y for j, y in enumerate(w) if j not in gone).encode()).hexdigest())
    return out


@pytest.mark.parametrize("window", [20, 5])
def test_substring_dedup(docs, rows, window, monkeypatch):
    if window == 5:
        monkeypatch.setattr(substring_dedup, "SLICE", 3000)
    found = substring_dedup.remove_repeats(docs.repartition(5), window).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == _deduped(rows, window)


def test_passage_that_all_documents_have(spark, monkeypatch):
    """A common passage is dealt to many buckets, and its strings travel once a task."""
    monkeypatch.setattr(substring_dedup, "SLICE", 3000)
    rng = random.Random(6)
    word = lambda: f"w{rng.randrange(10**5)}"
    passage = " ".join(word() for _ in range(90))
    rows = [(i, " ".join([*(word() for _ in range(rng.randrange(40))), passage, *(word() for _ in range(rng.randrange(40)))])) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(df).collect()}
    assert found == _deduped(rows, 20)
    classes = rarity.common_classes(df, substring_dedup.GRAM)
    _, _, text, _, _, key, common = substring_dedup.super_kmers(pa.array([x for _, x in rows]), classes, 20)
    assert common.mean() > 0.2 and len(set(key[common].tolist())) > 10
    keyed = substring_dedup._keyed(df).select("doc_id", "tag", "text")
    blobs = keyed.mapInArrow(substring_dedup._travel(classes, 1, 20), "bucket int, blob binary").collect()
    strings = Counter(bytes(x) for r in blobs for x in [r.blob])
    sizes = [substring_dedup._unpack(bytes(r.blob)) for r in blobs]
    held = [s for s in sizes if len(s[1]) > 5 * len(s[0])]
    assert len(held) == 3 and strings
    monkeypatch.setattr(substring_dedup, "HELD_BYTES", 1)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(df).collect()} == found


def test_substring_dedup_ids(spark, empty):
    text = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(None, text), (1, text), (1, text), (2, "q " + text)], "doc_id long, text string")
    out = sorted((r.doc_id or -1, r.n_removed) for r in substring_dedup.remove_repeats(df).collect())
    assert out == [(-1, 0), (1, 30), (1, 30), (2, 30)]
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_colliding_hashes_are_told_apart(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(wa.Words, "hashes", lambda self: np.ones(len(self.start), np.uint64))
    texts = [" ".join(f"a{i}" for i in range(25)), " ".join(f"b{i}" for i in range(25)), " ".join(f"a{i}" for i in range(25))]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([0, 0, 0], pa.int64()), pa.array(texts)], ["doc_id", "tag", "text"])
    blobs = [x for r in substring_dedup._travel(np.zeros(rarity.SLOTS, np.uint8), 1, 20)(iter([batch])) for x in r.column("blob").to_pylist()]
    doc, _, start, end = substring_dedup.repeated_spans(blobs, 20)
    assert set(doc.tolist()) == {3} and (start.min(), end.max()) == (0, 25)


# 9


def test_mix(docs, rows, empty):
    out = mixing.mix(docs).collect()
    sources = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    assert len(out) == len(rows)
    size, target, taken = Counter(), {}, Counter()
    for r in out:
        s = sources[r.doc_id]
        size[s] += r.size
        target[s] = (r.source_size, r.target)
        taken[s] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    want, free, rest = {}, set(order), sum(size.values())
    while True:  # the plain way: clamp, share again, until none is above its cap
        share = {s: weight[s] * rest / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] >= 3 * size[s]]
        if not over:
            break
        for s in over:
            want[s] = 3 * size[s]
            rest -= want[s]
            free.discard(s)
    want |= share
    for s in order:
        assert target[s] == (size[s], pytest.approx(want[s])) and abs(taken[s] - want[s]) <= 1
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, out), key=repr)
    assert mixing.mix(empty).count() == 0
    assert mixing.mix(docs.where("text is null")).first().taken == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(name, spark, data):
    from silverbrook.catalog.compare import connect, differences

    assert differences(queries.queries()[name](spark, data), connect(data), queries.oracle_sql()[name]) == []


# 10


def test_packing(docs, rows, empty):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    ids = {i: np.array(e.ids + [1], "<u4") for (i, _), e in zip(rows, tokenizer.encode_batch([x for _, x in rows], add_special_tokens=False), strict=True)}
    out = [r.asDict() for r in packing.pack(docs, path, keep_ids=True).collect()]
    times = Counter(i for i, _ in rows)
    covered, windows = defaultdict(list), defaultdict(list)
    for r in out:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert bytes(r["ids"]) == part.tobytes() and r["ids_crc32"] == zlib.crc32(part.tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])
        covered[r["doc_id"]] += range(r["start"], r["start"] + r["length"])
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, n in times.items():
        assert sorted(covered[i]) == sorted(list(range(len(ids[i]))) * n)
    padded = total = 0
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= packing.LENGTH
        total, padded = total + at, padded + (at if at & (at - 1) == 0 else packing.LENGTH)
    assert total == sum(len(ids[i]) * n for i, n in times.items()) and 1 - total / padded < 0.02
    assert packing.pack(empty, path).count() == 0


def test_word_hashes_that_collide(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    words = packing.WordIds(path)
    plain = wa.Words.hashes
    monkeypatch.setattr(wa.Words, "hashes", lambda self, base=0: plain(self, base) if base else np.full(len(self.start), 7, np.uint64))
    for x in ["one two one three", "two four, one five"]:
        assert words.encode(pa.array([x, ""]))[0].tolist() == Tokenizer.from_file(path).encode(x, add_special_tokens=False).ids + [1, 1]


def test_null_ids(spark):
    """Rows without an id are rows like others in the operators that work row by row."""
    rows = [(None, "one two three"), (None, "one two three"), (None, None), (4, "four")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"size": F.lit(1), "media": F.lit("x"), "start": F.lit(0), "source": F.lit("s")})
    count = lambda out, *columns: Counter(tuple(r[c] for c in ("doc_id", *columns)) for r in out.collect())
    assert count(motion_jpeg.media_digests(df), "n_bytes") == {(None, 13): 2, (None, 0): 1, (4, 4): 1}
    assert count(token_counts.count_tokens(df, queries.tokenizer_path("piece_bpe_32k.model")), "n_words") == {(None, 3): 2, (None, 0): 1, (4, 1): 1}
    assert count(mixing.mix(df), "size") == {(None, 3): 2, (None, 0): 1, (4, 1): 1}
    packed = packing.pack(df, queries.tokenizer_path())
    whole = Counter((r.doc_id, r.doc_tokens) for r in packed.where("start = 0").collect())
    assert sum(whole.values()) == 4 and whole[None, 1] == 1 and packed.agg(F.sum("length")).first()[0] == sum(n * k for (_, n), k in whole.items())


def test_very_long_texts(spark):
    """A text of a megabyte beside short ones, and its near copy."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randrange(2, 9))) for _ in range(5000)]
    long = " ".join(rng.choice(words) for _ in range(180_000))
    rows = [(1, long, "en", "s"), (2, long + " more", "en", "s"), (3, "short one", "en", "s"), (4, "x" * 1_000_000, "en", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").cache()
    queries.let_workers_import(spark)
    assert {r.doc_id: r.component_id for r in jaccard_join.jaccard_classes(df).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    assert {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(df).collect()} == {1: 0, 2: 180_000, 3: 0, 4: 0}
    assert {r.doc_id for r in language_id.accepted(df).collect()} >= {1, 2}
    assert {r.doc_id: r.payload_bytes for r in motion_jpeg.media_digests(df).collect()} == {i: -(-len(x) // 192) * 192 for i, x, *_ in rows}
    assert {r.doc_id: r.n_words for r in token_counts.count_tokens(df, queries.tokenizer_path("piece_bpe_32k.model")).collect()} == {1: 180_000, 2: 180_001, 3: 2, 4: 1}
    assert mixing.mix(df).agg(F.sum("taken")).first()[0] == 360_004
    pieces = packing.pack(df, queries.tokenizer_path()).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("k")).collect()
    assert len(pieces) == 4 and all(r.n == r.k for r in pieces)
    near = {r.doc_id: r.near_edited for r in fingerprints.compare_edited(df).collect()}
    assert len(near) == 4 and near[2] > 0.4


def test_lay_out_is_optimal():
    rng = random.Random(2)
    for _ in range(30):
        at = sorted({0, 200, *range(0, 200, 25), *[rng.randrange(200) for _ in range(30)]})
        cost = [0] + [rng.choice([0, 12, 40]) for _ in at[1:]]
        limit, best = 64, [0] + [10**9] * (len(at) - 1)
        pad = lambda n: 0 if n == 32 else 64 - n
        for j in range(1, len(at)):
            best[j] = cost[j] + packing.WINDOW + min(best[i] + pad(at[j] - at[i]) for i in range(j) if at[j] - at[i] <= limit)
        cuts = packing.lay_out(at, cost, limit)
        found = sum(cost[at.index(c)] + packing.WINDOW + pad(c - b) for b, c in zip([0, *cuts], cuts, strict=False))
        assert cuts[-1] == 200 and found == best[-1]


def test_word_ids_equal_whole_text_ids():
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    import pyarrow as pa

    words = packing.WordIds(path)
    for x in ["It's THE dog's, you'll see... éa É ÀB İx ΣΑΣ ﬁ 漢字,語 12,3 a b  c <|endoftext|> x\x1cy 'S ½.", "don't! stop?!... (yes); «no» — ok:", "", "ñandú, über. naïve; ß"]:
        ids, length, _ = words.encode(pa.array([x]))
        assert ids.tolist() == tokenizer.encode(x, add_special_tokens=False).ids + [1] and length[0] == len(ids)
