"""Operator 13, source divergence audit: radix-select ranking and sparse pairs with a corrected baseline.

The terms that a language keeps have a smoothed share ``p`` in each source and in the language; the divergence of a term is
``(p - q)**2 // q``.  Counts come from one pass over whole texts, summed in each task before they are shuffled.

* Pairs of sources sum the divergence over all kept terms, most of which neither source has.  That baseline is known from
  the shares of a count of zero; what a source's own terms change against a source without them comes from a histogram of its
  counts, and terms that both have are corrected one by one.  Terms are dealt to tasks with the sources that have them, in
  blocks of sources, and a task sums what it finds for each pair: no row is made for a pair and a term.
* A group's ``k`` first terms come from a radix selection.  A term's key is its divergence, complemented, and then its UTF-8
  bytes, so the order of keys is the ranking.  A round counts the keys of each group by their next bytes and keeps the prefix
  in which the ``k``-th lies; when few enough keys are left up to it, they are ranked exactly.  Bytes that all keys share are
  jumped over.  Counts combine before the shuffle and no task ever holds a group's terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType

from silverbrook.llm import wordarrays as wa
from silverbrook.llm.storage import attach, cut

LEAST_DOCS, UNIT, RANKS = 3, 1_000_000_000, 200
#: Different terms of all groups that a task holds before it hands their counts on.
HELD = 250_000
#: Keys of a group that may be ranked together, as a multiple of the ranks.
SPARE = 4
#: Sources of a block, and terms of one task's share of a language.
SOURCE_BLOCK, TERM_SHARE = 256, 2000
#: Pairs that are compared at once.
PAIRS = 1 << 18

# Everything but letters of ASCII becomes a space, and A-Z are lowered; bytes of other characters stay.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_TERM).split()


def _count(most: int):
    """Occurrences of each term in each group, and documents, once for each run of texts."""

    def table(counts: dict[tuple, Counter], docs: dict[tuple, Counter]) -> pa.RecordBatch:
        keys = [(*group, t, n, docs[group][t]) for group, found in counts.items() for t, n in found.items()]
        columns = list(zip(*keys, strict=True)) if keys else [()] * 5
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
        made = [[t.decode("utf-8", "replace") for t in c] if i == 2 else c for i, c in enumerate(columns)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(made, kinds, strict=True)], ["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, docs, held = {}, {}, 0
        for part in wa.slices(batches, "text"):
            for lang, source, text in zip(*(part.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
                found, seen = counts.setdefault((lang, source), Counter()), docs.setdefault((lang, source), Counter())
                terms, known = Counter(terms_of(text)), len(found)
                found.update(terms)
                seen.update(terms.keys())
                held += len(found) - known
            if held > most:
                yield table(counts, docs)
                counts, docs, held = {}, {}, 0
        if held:
            yield table(counts, docs)

    return run


def share(n: Column, whole: Column) -> Column:
    """``1 + floor(UNIT * (n + 1) / whole)`` by long division, three digits at a time: exact while ``whole`` is below 2**53, an error
    where it is so large that a digit overflows."""
    div = lambda a, b: F.call_function("div", a, b)
    whole, rest, value = F.greatest(whole, F.lit(1)).cast("long"), (n + 1).cast("long"), F.lit(1).cast("long")
    for digits in (UNIT // 1000, UNIT // 1_000_000, 1):
        value, rest = value + div(rest * 1000, whole) * digits, (rest * 1000) % whole
    return value


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _alone(group: pd.DataFrame, bins: pd.DataFrame) -> pd.DataFrame:
    """What one source adds to its pairs with all others by itself: the baseline, and its terms against sources without them."""
    first = group.iloc[0]
    level, own = np.array(first["levels"], np.int64), int(first["level"])
    p, n = bins["p"].to_numpy(np.int64)[:, None], bins["n"].to_numpy(np.int64)
    as_p, as_q = np.zeros(len(level), np.int64), np.zeros(len(level), np.int64)
    flat, back = _apart(np.int64(own), level), _apart(level, np.int64(own))
    step = max(1, PAIRS // max(1, len(p)))
    for at in range(0, len(level), step):
        q = level[at : at + step]
        as_p[at : at + step] = (n[:, None] * (_apart(p, q) - flat[at : at + step])).sum(0)
        as_q[at : at + step] = (n[:, None] * (_apart(q, p) - back[at : at + step])).sum(0)
    others = np.flatnonzero(np.arange(len(level)) != first["place"])
    me = np.full(len(others), first["place"], np.int64)
    value = np.concatenate([(as_p + flat * int(first["kept"]))[others], as_q[others]])
    return pd.DataFrame({"lang": first["lang"], "a": np.concatenate([me, others]), "b": np.concatenate([others, me]), "value": value})


def _together(key: tuple, found: pd.DataFrame, width: int, most: int) -> pd.DataFrame:
    """What terms that two sources have add to the pair, summed over one share of a language's terms and two blocks of sources."""
    found = found.sort_values("term", kind="stable")
    places, at = np.unique(found["place"].to_numpy(np.int64), return_inverse=True)
    block = places // width
    p, level = found["p"].to_numpy(np.int64), found["level"].to_numpy(np.int64)
    _, start, size = np.unique(found["term"].to_numpy(object), return_index=True, return_counts=True)
    ends, total = np.cumsum(size * size), np.zeros(len(places) ** 2, np.int64)
    i = 0
    while i < len(size):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + most)))
        n, begin = size[i:j], start[i:j]
        left = np.repeat(np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin, n), np.repeat(n, n))
        many = n * n
        right = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        right = right % np.repeat(n, many) + np.repeat(begin, many)
        x, y = at[left], at[right]
        use = (x != y) & ((key[1] == key[2]) | (block[x] != block[y]))
        left, right, x, y = left[use], right[use], x[use], y[use]
        value = _apart(p[left], p[right]) - _apart(p[left], level[right]) - _apart(level[left], p[right]) + _apart(level[left], level[right])
        np.add.at(total, x * len(places) + y, value)
        i = j
    used = np.flatnonzero(total)
    return pd.DataFrame({"lang": key[0], "a": places[used // len(places)], "b": places[used % len(places)], "value": total[used]})


_PAIRS = "lang string, a long, b long, value long"


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, a, b, value`` for each two sources of a language, by their places."""
    bins = kept.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("n"))
    levels = groups.groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "level"))), lambda x: x["level"]).alias("levels"))
    alone = groups.join(levels, "lang").groupBy("lang", "source").cogroup(bins.groupBy("lang", "source")).applyInPandas(_alone, _PAIRS)
    last = F.floor((F.col("sources") - 1) / SOURCE_BLOCK).cast("long")
    mine = F.floor(F.col("place") / SOURCE_BLOCK).cast("long")
    dealt = kept.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last))).select(
        "lang", F.least("other", mine).alias("low"), F.greatest("other", mine).alias("high"), "term", "place", "p", "level",
        F.pmod(F.xxhash64("term"), F.ceil(F.col("kept") / TERM_SHARE).cast("long")).alias("part"),
    )
    width, most = SOURCE_BLOCK, PAIRS
    together = dealt.groupBy("lang", "low", "high", "part").applyInPandas(lambda key, found: _together(key, found, width, most), _PAIRS)
    return alone.unionByName(together).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


@F.pandas_udf(IntegerType())
def _next_length(low: pd.Series, high: pd.Series) -> pd.Series:
    """Two bytes more than two keys share."""

    def shared(a: bytes, b: bytes) -> int:
        n = min(len(a), len(b))
        x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
        apart = np.flatnonzero(x != y)
        return int(apart[0]) if len(apart) else n

    return pd.Series([shared(bytes(a), bytes(b)) + 2 for a, b in zip(low, high, strict=True)], dtype="int32")


def _front(key: str, length: Column) -> Column:
    return F.substring(F.col(key), F.lit(1), length)


def first_keys(keys: DataFrame, k: int) -> DataFrame:
    """``group, key, rank`` of the ``k`` first keys, as bytes, of each group of ``keys`` (group, key), by radix selection.

    Runs a job or two a round while the result is built; ``keys`` is read in each, so it should be a written table.  No two
    keys of a group may be equal.  Groups and keys may be of any number and length."""
    size = F.lit(64)
    tie = F.xxhash64("key")
    state = keys.groupBy("group").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count(F.lit(1)).alias("n"))
    state = cut(state.withColumns({"prefix": F.lit(b""), "before": F.lit(0).cast("long"), "length": _next_length("low", "high")}), "ranks")
    settled = [state.where(F.col("n") <= SPARE * k).select("group", F.col("high").alias("upto"))]
    left = state.where(F.col("n") > SPARE * k).select("group", "prefix", "before", "length")
    while not left.isEmpty():
        held = attach(keys, left, "group", size, tie).where(F.col("prefix").isNotNull() & (_front("key", F.octet_length("prefix")) == F.col("prefix")))
        bins = held.groupBy("group", "before", _front("key", F.col("length")).alias("digit")).agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.partitionBy("group").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)) + F.col("before")
        here = bins.withColumn("upto", upto).where((F.col("upto") >= k) & (F.col("upto") - F.col("n") < k))
        state = cut(here.withColumn("length", _next_length("low", "high")), "ranks")
        few = F.col("upto") <= SPARE * k
        settled.append(state.where(few).select("group", F.col("high").alias("upto")))
        left = state.where(~few).select("group", F.col("digit").alias("prefix"), (F.col("upto") - F.col("n")).alias("before"), "length")
    ends = settled[0]
    for more in settled[1:]:
        ends = ends.unionByName(more)
    near = attach(keys, ends, "group", size, tie).where(F.col("key") <= F.col("upto"))
    order = Window.partitionBy("group").orderBy("key")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("group", "key", "rank")


_TOP = (1 << 63) - 1


def audit(documents: DataFrame, ranks: int = RANKS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``lang, source, part, item, value, rank`` for ``documents`` (text, lang, source; other columns are ignored).

    Part ``pair`` has every other source of a source's language, part ``term`` the first ``ranks`` terms that a source has
    and uses more than its language.  Tables are written while the result is built.  A null text, lang or source counts as
    an empty one; repeated rows are documents of their own.  Values that tie are ranked by the UTF-8 bytes of the item.  A
    language without kept terms has pairs of value 0, one with a single source has none, and an empty table gives no
    rows.  A task holds ``HELD`` counts, or those of its longest text; sums of more than 2**63 raise.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    docs = documents.select(*[blank(c).alias(c) for c in ("lang", "source", "text")])
    found = docs.mapInArrow(_count(HELD), "lang string, source string, term string, n long, docs long")
    counts = cut(found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs).drop("docs")
    used = cut(counts.drop("docs").join(terms, ["lang", "term"]), "kept")
    per_lang = used.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.count_distinct("term").alias("kept"))
    named = docs.select("lang", "source").distinct().join(per_lang, "lang", "left").na.fill(0, ["lang_n", "kept"])
    sums = used.groupBy("lang", "source").agg(F.sum("n").alias("own_n"))
    whole = F.col("own_n") + F.col("kept")
    in_lang = Window.partitionBy("lang")
    groups = named.join(sums, ["lang", "source"], "left").na.fill(0, ["own_n"])
    groups = groups.withColumns(
        {"place": F.row_number().over(in_lang.orderBy("source")).cast("long") - 1, "sources": F.count(F.lit(1)).over(in_lang), "level": share(F.lit(0), whole)}
    )
    groups = cut(groups, "groups")
    key = F.struct("lang", "source").alias("group")
    about = groups.select(key, "lang_n", "kept", "own_n", "place", "sources", "level")
    size = F.octet_length("group.lang") + F.octet_length("group.source") + 64
    joined = attach(used.withColumn("group", key), about, "group", size, F.xxhash64("term"))
    kept = cut(joined.withColumns({"p": share(F.col("n"), whole), "q": share(F.col("all_n"), F.col("lang_n") + F.col("kept"))}).drop("all_n", "lang_n", "own_n"), "shares")

    value = F.call_function("div", (F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("q"))
    order = F.concat(F.unhex(F.lpad(F.hex(F.lit(_TOP) - value), 16, "0")), F.col("term").cast("binary"))
    keys = cut(kept.where("p > q").select("group", order.alias("key")), "keys")
    first = first_keys(keys, ranks)
    text = F.decode(F.expr("substring(key, 9)"), "UTF-8")
    points = F.lit(_TOP) - F.conv(F.hex(F.expr("substring(key, 1, 8)")), 16, 10).cast("long")
    top = first.select("group.lang", "group.source", F.lit("term").alias("part"), text.alias("item"), points.alias("value"), F.col("rank").cast("int").alias("rank"))

    name = lambda place, out: groups.select("lang", F.col("place").alias(place), F.col("source").alias(out))
    pairs = _pairs(kept, groups).join(name("a", "source"), ["lang", "a"]).join(name("b", "item"), ["lang", "b"])
    level = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(level).alias("rank"))
    return pairs.unionByName(top)


#: The same result in DuckDB's SQL.
ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
t AS (SELECT i, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT i) >= {LEAST_DOCS}),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
c AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(s, 0) AS s FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(n) AS s FROM c GROUP BY ALL) USING (lang, source)),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS all_n,
    CAST(1 + CAST({UNIT} AS HUGEINT) * (coalesce(c.n, 0) + 1) // (g.s + v.v) AS HUGEINT) AS p, CAST(1 + CAST({UNIT} AS HUGEINT) * (k.n + 1) // (v.n + v.v) AS HUGEINT) AS q
  FROM g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE n > 0 AND p > q),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', item, value FROM terms)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts) WHERE part = 'pair' OR rank <= {RANKS}
"""
