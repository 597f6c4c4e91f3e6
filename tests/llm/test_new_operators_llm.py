"""Nearest neighbours, vector codes and source divergence against brute-force versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverbrook.catalog.compare import connect, differences
from silverbrook.llm import divergence, queries, vector_codes, vector_search

VECTORS = "vec_id long, embedding array<float>, label int, score double, q long, vector string, list int"


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, 0.0, 1, "clash", 2) for i, v, label in rows], VECTORS)


def _random_rows(n, seed, length=64, spread=12):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((spread, length))
    x = (centres[rng.integers(0, spread, n)] + 0.4 * rng.standard_normal((n, length))).astype(np.float32)
    return [(i, v.tolist(), int(i % 5) if i % 7 else None) for i, v in enumerate(x)]


NAN, INF = float("nan"), float("inf")
ODD = [(9001, None, 1), (9002, [0.0] * 64, 1), (9003, [None] + [1.0] * 63, None), (9004, [NAN] + [1.0] * 63, 2), (9005, [INF] + [1.0] * 63, 2), (9006, [1.0] * 63, 2), (9007, [], 3)]


@pytest.mark.parametrize("name", ["op12_vector_codes", "op13_source_divergence"])
def test_sql(name, spark, data):
    con = connect(data)
    assert differences(queries.queries()[name](spark, data), con, queries.oracle_sql()[name]) == []


# 11


def _true(rows, asked, k=10):
    x = np.array([v for _, v, _ in rows], np.float64)
    ids = np.array([i for i, *_ in rows])
    for i in asked:
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        d[ids == ids[i]] = np.inf
        yield ids[i], [(ids[j], d[j]) for j in np.lexsort((ids, d))[:k] if np.isfinite(d[j])]


def test_search_on_whole_tables(spark, monkeypatch):
    """Several lists, parts and blocks of queries; copies and ties; rows that take no part."""
    for name, value in {"LIST_ROWS": 100, "PART_ROWS": 64, "PART_QUERIES": 3, "OPENING": 16}.items():
        monkeypatch.setattr(vector_search, name, value)
    rows = _random_rows(3000, 1)
    hot = rows[200][1]
    rows += [(10_000 + i, hot, 1) for i in range(1500)]
    odd = [(None, rows[3][1], 1), (500, None, 0), *ODD]
    found = defaultdict(list)
    for r in vector_search.search(_vectors(spark, rows + odd), F.col("vec_id") % 100 == 0).collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    hit = total = 0
    for i, near in _true(rows, [j for j, (i, *_) in enumerate(rows) if i % 100 == 0]):
        got = sorted(found.pop(i))
        assert [x for x, *_ in got] == list(range(1, 11)) and i not in [v for _, v, _ in got]
        assert [(s, v) for _, v, s in got] == sorted((s, v) for _, v, s in got)
        hit, total = hit + len({v for v, _ in near} & {v for _, v, _ in got}), total + len(near)
        if i >= 10_000 or i == 200:
            assert [v for _, v, _ in got] == [v for v, _ in near] and got[-1][2] == 0
    assert not found and hit / total >= 0.9


def test_search_is_exact_within_its_lists(spark):
    rows = _random_rows(120, 2, 24)
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v, _ in rows], "vec_id long, embedding array<double>")
    for i, near in _true(rows, range(0, 120, 20), 3):
        got = vector_search.search(df, F.col("vec_id") == int(i), k=3).orderBy("rank").collect()
        assert [r.vec_id for r in got] == [v for v, _ in near] and np.allclose([r.score for r in got], [d for _, d in near], rtol=1e-14)
    few = vector_search.search(df.where("vec_id < 4"), F.col("vec_id") % 2 == 0).groupBy("query_id").count().collect()
    assert {r.query_id: r["count"] for r in few} == {0: 3, 2: 3}
    assert vector_search.search(df.where("vec_id < 0"), F.col("vec_id") == 0).count() == 0
    assert vector_search.search(df.where("vec_id = 0"), F.col("vec_id") == 0).count() == 0
    again = vector_search.search(df.where("vec_id < 2").unionByName(df.where("vec_id < 2")), F.col("vec_id") == 0).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in again] == [(0, 1, 1)] * 2


def test_abandoned_candidates_are_few(monkeypatch):
    """The test loses next to no neighbour and measures few rows in full."""
    rng = np.random.default_rng(5)
    x, turn, measured = rng.standard_normal((4000, 64)), vector_search.rotation(64), []
    part, whole = vector_search.Part(x, turn), vector_search.Part._measure
    monkeypatch.setattr(vector_search.Part, "_measure", lambda self, q, at: measured.append(len(at)) or whole(self, q, at))
    hit = 0
    for i in range(50):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        bound = np.sort(d)[10]
        hit += len(set(np.argsort(d)[:11]) & set(part.scan(x[i], x[i] @ turn, bound, 11)[0]))
    assert hit >= 0.99 * 550 and max(measured) < 400
    assert np.allclose(turn @ turn.T, np.eye(64))


# 12


def _codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * np.float64(np.float32(c))) for c in v], label) for i, v, label in rows]
    kept.sort(key=lambda r: r[0])
    width = len(kept[0][1]) // parts
    x = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for _, v, _ in kept]
    books = [[list(v[p]) for v in x[:entries]] for p in range(parts)]
    far = lambda a, b: sum((s - t) ** 2 for s, t in zip(a, b, strict=True))
    assign = lambda: [[min(range(len(books[p])), key=lambda e: (far(v[p], books[p][e]), e)) for p in range(parts)] for v in x]
    for _ in range(rounds):
        own = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [v[p] for v, o in zip(x, own, strict=True) if o[p] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    own, labels = assign(), Counter()
    errors = [sum(far(v[p], books[p][o[p]]) for p in range(parts)) for v, o in zip(x, own, strict=True)]
    for (_, _, label), e in zip(kept, errors, strict=True):
        labels[label] += e
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return sorted((i, "".join(f"{c:02x}" for c in o), e, labels[label], digest) for (i, _, label), o, e in zip(kept, own, errors, strict=True))


@pytest.mark.parametrize("rows", [_random_rows(400, 3), _random_rows(20, 4), [(i, [(i % 3) / 256, *[0.0] * 63], None) for i in range(150)]], ids=["many", "few", "ties"])
def test_codes(spark, rows):
    got = vector_codes.encode(_vectors(spark, rows + [x for x in ODD if x[0] != 9002]).repartition(3)).collect()
    assert sorted(tuple(r) for r in got) == _codes(rows)


def test_codes_of_odd_tables(spark):
    one = _vectors(spark, [(7, [0.5] * 64, None)] * 3 + [(None, [0.25] * 64, 1)])
    got = vector_codes.encode(one).collect()
    assert len(got) == 4 and {r.error for r in got} == {0} and len({r.code for r in got}) == 2
    assert vector_codes.encode(_vectors(spark, ODD[:1])).count() == 0
    with pytest.raises(ValueError, match="parts"):
        vector_codes.encode(_vectors(spark, [(1, [1.0] * 63, 1)]))
    with pytest.raises(ArithmeticError):
        vector_codes.encode(_vectors(spark, [(1, [3e6] * 64, 1)]))


def test_bounds_give_what_a_full_scan_gives():
    """Each round's assignment equals a full scan, large numbers and ties too, and most distances aren't computed."""
    rng = np.random.default_rng(8)
    for scale in (3, 40, 1 << 27):
        x = rng.integers(-scale, scale, (3000, 4))
        now = x[:64].copy()
        group = vector_codes.clustered(now, 8)
        own, best, low = vector_codes.Bounds(now, group, np.zeros(group.max() + 1, np.int64)).first(x)
        work = []
        for _ in range(5):
            old = now
            now = np.stack([x[own == e].sum(0) // (own == e).sum() if (own == e).any() else old[e] for e in range(64)])
            b = vector_codes._bounds(now[None], old[None], [group])[0]
            own, best, low, n = b.again(x, own, low)
            full = ((x[:, None].astype(object) - now.astype(object)) ** 2).sum(2)
            assert (own == np.array([min(range(64), key=lambda e: (r[e], e)) for r in full])).all()
            assert (best == full.min(1)).all()
            work.append(n / (64 * len(x)))
        if scale == 40:
            assert work[-1] < 0.5


# 13


def _audit(rows, ranks=200):
    docs = [(x or "", lang or "", source or "") for x, lang, source in rows]
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    seen, count = defaultdict(Counter), defaultdict(Counter)
    for x, lang, source in docs:
        found = term.findall(x.translate(lower))
        seen[lang].update(set(found))
        count[lang, source].update(found)
    out = set()
    for lang in {d[1] for d in docs}:
        kept = [t for t, n in seen[lang].items() if n >= 3]
        group = {s: count[la, s] for la, s in count if la == lang}
        whole = sum(group.values(), Counter())
        share = lambda c: {t: 1 + 1_000_000_000 * (c[t] + 1) // (sum(c[u] for u in kept) + len(kept)) for t in kept}  # noqa: E731, B023
        p, q = {s: share(c) for s, c in group.items()}, share(whole)
        for s in group:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in group if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if group[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, v, r) for r, (v, item) in enumerate(found, 1) if part == "pair" or r <= ranks}
    return out


def test_divergence(spark, monkeypatch):
    rng = random.Random(6)
    words = ["".join(rng.choice("aBcéßüж漢𝄞zZ") for _ in range(rng.randrange(1, 6))) for _ in range(400)]
    rows = [(" ".join(rng.choices(words, k=rng.randrange(0, 60), weights=[1 / (i + 1) for i in range(400)])), rng.choice(["en", "de"]), rng.choice("abcdefg")) for _ in range(150)]
    rows += [(None, None, None), ("", "xx", "a"), ("once", "xx", "b"), ("3 4, -", "yy", None), ("K É k é" * 9, None, None), *[("tie " * 3, None, "t")] * 3, *[("x" * 3000 + " y", "zz", "q")] * 4]
    docs = spark.createDataFrame([(*r, "clash", 1, 2.0, "g") for r in rows], "text string, lang string, source string, term string, n long, p double, `group` string").repartition(3)
    for block, ranks, held in ((256, 200, 1000), (2, 5, 50)):
        monkeypatch.setattr(divergence, "SOURCE_BLOCK", block)
        monkeypatch.setattr(divergence, "TERM_SHARE", 40)
        monkeypatch.setattr(divergence, "PAIRS", 100)
        monkeypatch.setattr(divergence, "HELD", held)
        got = divergence.audit(docs, ranks=ranks).collect()
        assert len(got) == len(set(got)) and {tuple(r) for r in got} == _audit(rows, ranks)
    assert divergence.audit(docs.limit(0)).count() == 0


def test_radix_selection(spark):
    """Long shared prefixes, keys that begin others, groups small and large."""
    rng = random.Random(2)
    keys = {(0, rng.randbytes(6)) for _ in range(3000)} | {(1, b"\x00" * 500 + rng.randbytes(2)) for _ in range(500)} | {(2, b"z" * n) for n in range(400)} | {(3, bytes([i])) for i in range(3)}
    rows = spark.createDataFrame([(g, bytearray(k)) for g, k in keys], "group long, key binary")
    got = {(r.group, bytes(r["key"]), r["rank"]) for r in divergence.first_keys(rows, 20).collect()}
    assert got == {(g, k, i) for g in range(4) for i, k in enumerate(sorted(k for h, k in keys if h == g)[:20], 1)}
