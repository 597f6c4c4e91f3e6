"""Operator 4 without a probability of a miss, for all links or those that span classes.

:mod:`silverbrook.llm.jaccard_join` finds the texts that may meet by minhash keys; here they are found by an exact rule, and
texts that are linked in a chain only form no family whose members all meet.  It shuffles more.

A text's set holds the hashes of its distinct word n-grams.  The join is exact, up to equal 64-bit hashes:

1. One pass over the texts gives each its set's size, a 128-bit digest, a parity bitmap and its prefix: its rarest
   n-grams, so many that two linked texts share one of them whatever else they share.  Rare is an order of the whole
   corpus, so that what many texts have isn't in prefixes.  Texts with equal sets are one node from then on.
2. Nodes that share an n-gram of their prefixes form lists.  A list of more sizes than two neighbouring bands, within
   which sizes differ by the threshold, is parted into pairs of bands; lists with the same members are one.
3. Lists are dealt into tiles of bounded size.  In a tile the bits in which two bitmaps differ bound the symmetric
   difference from below and so the overlap from above; pairs that may still link are compared exactly as sorted arrays.
   Small bitmaps come first: most lists hold texts that share a phrase and no more, and whoever has no partner there goes.
4. First each node meets others in a few lists only, and of a tile's candidates a spanning forest is compared.  That
   joins groups of near copies, each text once or a few times.  A second forest is taken from all lists whose members
   aren't joined yet.  Last, such lists are searched in full, but for pairs that are joined: members of a list's largest
   component don't meet each other, and hardly any pair is left.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from silverbrook.llm import rarity, wordarrays as wa
from silverbrook.llm.components import components
from silverbrook.llm.jaccard_join import digests, gram_sets
from silverbrook.llm.storage import cut, passing

#: Nodes of a tile, or of each side of one.
TILE = 512
#: Lists in which each node is first compared, and ways in which a large one of them is dealt into tiles.
FIRST_LISTS, DEALS = 3, 2
#: Bits of the smallest and of the largest bitmap; others have this many an n-gram of the set, rounded up to a power of two.
#: With four the bound is nearly the difference itself: few pairs pass it that don't link.
LEAST_BITS, MOST_BITS, GRAM_BITS, FIRST_BITS = 64, 1 << 16, 4, 0.5
#: Bytes of doc_ids that are broadcast to choose texts by.
ID_BYTES = 64 << 20
#: Pairs that are looked at together.
PAIRS = 1 << 18


def least_overlap(size: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap of a set of that size with any set that it links to."""
    return -(-percent * size // 100)


def prefixes(values: np.ndarray, at: np.ndarray, classes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, offsets): so many of the rarest of each set that it has a common one with that of any set it links to."""
    size = np.diff(at)
    order = np.lexsort((rarity.ranks(values, classes), np.repeat(np.arange(len(size)), size)))
    count = np.where(size > 0, size - least_overlap(size, percent) + 1, 0)
    ends = np.cumsum(count)
    return values[order[np.arange(ends[-1] if len(ends) else 0) + np.repeat(at[:-1] - (ends - count), count)]], np.concatenate([[0], ends])


def bitmaps(values: np.ndarray, at: np.ndarray, each: float = GRAM_BITS) -> list[bytes]:
    """For each set the parities of the numbers of n-grams that fall on each of about ``each`` bits an n-gram."""
    out = []
    for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        bits = min(MOST_BITS, max(LEAST_BITS, 1 << max(0, math.ceil(each * (j - i)) - 1).bit_length()))
        out.append(np.packbits(np.bincount((values[i:j] & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).tobytes())
    return out


def _signatures(n: int, percent: int, classes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in wa.slices(batches, "text", 1 << 20):
            values, at = gram_sets(part.column("text"), n)
            node, seen, again = digests(values, at), set(), []
            for d, known in zip(node, part.column("doc_id").is_valid().to_pylist(), strict=True):
                again.append(d in seen or not known)
                if known:
                    seen.add(d)
            grams, ends = prefixes(values, at, classes, percent)
            mask = pa.array(np.array(again, bool) | (np.diff(at) == 0))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(grams.view(np.int64)), mask=mask)
            maps = pa.array([None if m else x for m, x in zip(mask.to_pylist(), bitmaps(values, at, FIRST_BITS), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(at)), pa.array(node, pa.binary()), lists, maps], ["doc_id", "n_shingles", "node", "prefix", "bits"])

    return run


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in wa.slices(batches, "text", 1 << 20):
            values, at = gram_sets(part.column("text"), n)
            raw = [values[at[i] : at[i + 1]].tobytes() for i in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(raw, pa.binary())], ["doc_id", "grams"])

    return run


def _bits(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in wa.slices(batches, "text", 1 << 20):
            values, at = gram_sets(part.column("text"), n)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(at)), pa.array(bitmaps(values, at), pa.binary())], ["rep", "n", "bits"])

    return run


def _of(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows with one of the doc_ids; these are made a table."""
    ids = cut(ids.distinct(), "ids")
    return rows.join(F.broadcast(ids) if ids.count() * 16 <= ID_BYTES else ids, "doc_id", "left_semi")


def _flat(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


class Bitmaps:
    """Bitmaps of several widths; two are compared at the smaller width, to which the wider one is folded."""

    def __init__(self, column: pa.Array):
        data, offsets = wa.raw(column.cast(pa.binary()))
        self.width, self.start, self.data, self.folded = np.diff(offsets), offsets[:-1], data, {}

    def _at(self, width: int) -> np.ndarray:
        if width not in self.folded:
            out = np.zeros((len(self.width), width // 8), np.uint64)
            for have in np.unique(self.width[self.width >= width]).tolist():
                rows = np.flatnonzero(self.width == have)
                words = self.data[self.start[rows][:, None] + np.arange(have)].view(np.uint64)
                out[rows] = np.bitwise_xor.reduce(words.reshape(len(rows), have // width, width // 8), axis=1)
            self.folded[width] = out
        return self.folded[width]

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The least symmetric difference of the sets of rows a and b."""
        width, out = np.minimum(self.width[a], self.width[b]), np.zeros(len(a), np.int64)
        for w in np.unique(width).tolist():
            here = np.flatnonzero(width == w)
            maps = self._at(w)
            for k in range(0, len(here), max(1, PAIRS * 8 // w)):
                some = here[k : k + max(1, PAIRS * 8 // w)]
                out[some] = np.bitwise_count(maps[a[some]] ^ maps[b[some]]).sum(1, dtype=np.int64)
        return out


def candidates(tile: np.ndarray, size: np.ndarray, bits: Bitmaps, label: np.ndarray, main: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows a and b of pairs that may link: rows, sorted by tile and size, of one tile with different labels, not both of
    a main side, whose sizes and bitmaps allow it."""
    rows = len(tile)
    run = np.cumsum(np.concatenate([[0], (tile[1:] != tile[:-1]).astype(np.int64)]))
    scale = int(size.max()) * 100 // percent + 2
    upper = np.searchsorted(run * scale + size, run * scale + 100 * size // percent, "right")
    count = upper - np.arange(rows) - 1
    ends, i = np.cumsum(count), 0
    while i < rows:
        done = int(ends[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
        a = np.repeat(np.arange(i, j), count[i:j])
        b = _flat(np.arange(i, j) + 1, count[i:j])
        ok = (label[a] != label[b]) & ~(main[a] & main[b])
        a, b = a[ok], b[ok]
        overlap = (size[a] + size[b] - bits.apart(a, b)) // 2
        ok = 100 * overlap >= percent * (size[a] + size[b] - overlap)
        yield a[ok], b[ok]
        i = j


def forest(a: np.ndarray, b: np.ndarray, rows: int) -> np.ndarray:
    """Which of the edges (a, b) span the components; of a component's edges the first in order is taken (Boruvka)."""
    top, taken = np.arange(rows), np.zeros(len(a), bool)
    live = np.arange(len(a))
    while len(live):
        x, y = top[a[live]], top[b[live]]
        live, x, y = live[x != y], x[x != y], y[x != y]
        best = np.full(rows, len(a))
        np.minimum.at(best, x, live)
        np.minimum.at(best, y, live)
        chosen = np.flatnonzero(best < len(a))
        edge = best[chosen]
        taken[edge] = True
        to = np.where(top[a[edge]] == chosen, top[b[edge]], top[a[edge]])
        up = np.arange(rows)
        up[chosen] = to
        both = chosen[up[up[chosen]] == chosen]  # two components that chose one edge
        both = both[both < up[both]]
        up[both] = both
        while (up[up] != up).any():
            up = up[up]
        top = up[top]
    return taken


def _candidates(percent: int, span: bool):
    """Pairs that may link, of rows sorted by tile and size; with ``span`` a forest that spans what they join in a tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in wa.whole_runs(batches, "tile"):
            tile, size, rep, label = (part.column(c).to_numpy() for c in ("tile", "n", "rep", "label"))
            main = part.column("main").to_numpy(zero_copy_only=False)
            found = [x for x in candidates(tile, size, Bitmaps(part.column("bits")), label, main, percent)]
            a, b = (np.concatenate([x[k] for x in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
            low, high = np.minimum(rep[a], rep[b]), np.maximum(rep[a], rep[b])
            if span:
                order = np.lexsort((high, low))
                # a node of the forest is what has one label in one tile
                _, name = np.unique(label, return_inverse=True)
                run = np.cumsum(np.concatenate([[0], tile[1:] != tile[:-1]]))
                _, node = np.unique(run * (name.max() + 1) + name, return_inverse=True)
                order = order[forest(node[a[order]], node[b[order]], part.num_rows)]
                low, high = low[order], high[order]
            yield pa.RecordBatch.from_arrays([pa.array(low, pa.int64()), pa.array(high, pa.int64())], ["a", "b"])

    return run


def _alive(percent: int):
    """The rows, sorted by list and size, that may link to another of their list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in wa.whole_runs(batches, "list"):
            rows, names = part.num_rows, ("list", "rep", "members")
            seen = np.zeros(rows, bool)
            for a, b in candidates(part.column("list").to_numpy(), part.column("n").to_numpy(), Bitmaps(part.column("bits")), np.arange(rows), np.zeros(rows, bool), percent):
                seen[a] = seen[b] = True
            yield pa.RecordBatch.from_arrays([part.column(c) for c in names], list(names)).filter(pa.array(seen))

    return run


def _exact(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in wa.slices(batches, "x", 8 << 20):
            ok = []
            for x, y in zip(part.column("x"), part.column("y"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                both = int(np.count_nonzero(y[at] == x))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _verified(pairs: DataFrame, rows: DataFrame, n: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that link."""
    with passing(rows.sparkSession):
        pairs = cut(pairs.distinct(), "pairs")
        if pairs.isEmpty():
            return rows.sparkSession.createDataFrame([], "a long, b long")
        texts = _of(rows, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")))
        # rows that share a doc_id may have several sets; each is compared
        sets = cut(texts.mapInArrow(_sets(n), "doc_id long, grams binary").where("octet_length(grams) > 0").distinct(), "sets")
        x, y = sets.select(F.col("doc_id").alias("a"), F.col("grams").alias("x")), sets.select(F.col("doc_id").alias("b"), F.col("grams").alias("y"))
        return cut(pairs.join(x, "a").join(y, "b").mapInArrow(_exact(percent), "a long, b long").distinct(), "links", stays=True)


def _tiled(placed: DataFrame, maps: DataFrame, percent: int, span: bool) -> DataFrame:
    """Pairs of ``placed`` (tile, rep, label, main) that may link; ``maps`` (rep, n, bits) has their bitmaps."""
    full = placed.join(maps, "rep")
    dealt = full.repartition(F.col("tile")).sortWithinPartitions("tile", "n", "rep")
    return dealt.select("tile", "rep", "label", "main", "n", "bits").mapInArrow(_candidates(percent, span), "a long, b long")


def _lists(nodes: DataFrame, percent: int) -> DataFrame:
    """``list, rep, members``: for each node the lists in which it may have a link."""
    posts = nodes.select("rep", "n", F.explode("prefix").alias("key"))
    step = math.log(100 / percent) if percent < 100 else 1e-9
    band = lambda c: F.floor(F.log(F.col(c).cast("double")) / F.lit(step) + F.lit(1e-9)).cast("long")
    often = posts.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("key")
    with passing(nodes.sparkSession):
        shared = cut(posts.join(often, "key"), "shared")
        wide = shared.groupBy("key").agg(F.min("n").alias("low"), F.max("n").alias("high")).select("key", (band("high") - band("low")).alias("wide"))
        return _banded(shared.join(wide, "key").withColumn("band", band("n")), nodes, percent)


def _banded(shared: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    # sets that link are at most one band apart: each is in the pair of bands that begins with its own and in the one before
    pairs = F.when(F.col("wide") <= 1, F.array(F.lit(None).cast("long"))).otherwise(F.array(F.col("band") - 1, "band"))
    posts = shared.select("rep", "key", F.explode(pairs).alias("low_band")).select("rep", F.xxhash64("key", "low_band").alias("list"))
    posts = cut(posts, "posts")
    digest = posts.groupBy("list").agg(F.count(F.lit(1)).alias("members"), F.bit_xor(F.xxhash64("rep")).alias("x"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("y")).where("members > 1")
    once = digest.groupBy("members", "x", "y").agg(F.min("list").alias("list")).select("list", "members")
    lists = cut(posts.join(once, "list"), "lists")
    small = lists.where(F.col("members") <= TILE).join(nodes.select("rep", "n", "bits"), "rep").repartition(F.col("list")).sortWithinPartitions("list", "n", "rep")
    alive = small.select("list", "rep", "members", "n", "bits").mapInArrow(_alive(percent), "list long, rep long, members long")
    return cut(alive.unionByName(lists.where(F.col("members") > TILE)), "alive", stays=True)


def _salted(column: str, parts: Column, seed: int = 0) -> Column:
    return F.pmod(F.xxhash64(F.col(column), F.lit(seed)), parts)


def _first_tiles(lists: DataFrame) -> DataFrame:
    """Each node in the first of its lists, in a few random orders: near copies mostly choose the same."""
    choice = [F.min(F.struct(F.xxhash64("list", F.lit(i)).alias("order"), "list", "members")) for i in range(FIRST_LISTS)]
    chosen = lists.groupBy("rep").agg(F.array_distinct(F.array(*[F.struct(c.getField("list").alias("list"), c.getField("members").alias("members")) for c in choice])).alias("c"))
    each = chosen.select("rep", F.explode("c").alias("c")).select("rep", "c.list", F.ceil(F.col("c.members") / TILE).alias("parts"))
    deals = F.when(F.col("parts") > 1, F.array(*[_salted("rep", F.col("parts"), i) + F.lit(i) * F.col("parts") for i in range(DEALS)])).otherwise(F.array(F.lit(0).cast("long")))
    return each.select("rep", F.explode(deals).alias("part"), "list").select(F.xxhash64("list", "part").alias("tile"), "rep", F.col("rep").alias("label"), F.lit(False).alias("main"))


def _all_tiles(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """All lists whose members have several labels.  In a large one the members with its most frequent label are the main
    side; tiles hold two parts of the others, or one of them and one of the main side."""
    labelled = lists.join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    open_ = labelled.groupBy("list").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a < b").select("list")
    labelled = cut(labelled.join(open_, "list"), "open")
    small = labelled.where(F.col("members") <= TILE).select(F.xxhash64("list").alias("tile"), "rep", "label", F.lit(False).alias("main"))
    large = labelled.where(F.col("members") > TILE)
    most = large.groupBy("list", "label").agg(F.count(F.lit(1)).alias("k")).groupBy("list").agg(F.max(F.struct("k", "label")).alias("m"))
    large = large.join(most.select("list", F.col("m.label").alias("top"), F.col("m.k").alias("k")), "list").withColumn("main", F.col("label") == F.col("top"))
    others, mains = F.ceil((F.col("members") - F.col("k")) / TILE), F.ceil(F.col("k") / TILE)
    here = F.when(F.col("main"), _salted("rep", mains)).otherwise(_salted("rep", F.greatest(others, F.lit(1).cast("long"))))
    large = large.withColumns({"others": others, "mains": mains}).withColumn("here", here)
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    named = lambda side, x, y: F.xxhash64("list", F.lit(side), x, y)
    tiles = F.when(F.col("main"), F.transform(upto(F.col("others")), lambda t: named("main", F.col("here"), t))).otherwise(
        F.concat(F.transform(upto(F.col("others")), lambda t: named("rest", F.least(F.col("here"), t), F.greatest(F.col("here"), t))), F.transform(upto(F.col("mains")), lambda t: named("main", t, F.col("here"))))
    )
    return small.unionByName(large.select(F.explode(tiles).alias("tile"), "rep", "label", "main"))


def _nodes(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id and text, their signatures, the nodes)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    classes = rarity.common_classes(rows, n, lower=True)
    made = cut(rows.mapInArrow(_signatures(n, percent, classes), "doc_id long, n_shingles long, node binary, prefix array<long>, bits binary"), "signatures")
    full = made.where("n_shingles > 0 and doc_id is not null")
    nodes = full.groupBy("node").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.first("prefix", True).alias("prefix"), F.first("bits", True).alias("bits"))
    return rows, made, cut(nodes, "nodes")


def _members(made: DataFrame, nodes: DataFrame) -> DataFrame:
    own = made.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("rep"))
    full = made.where("n_shingles > 0 and doc_id is not null").select("doc_id", "n_shingles", "node").join(nodes.select("node", "rep"), "node")
    return full.select("doc_id", "n_shingles", "rep").unionByName(own)


def exact_links(docs: DataFrame, n: int = 4, percent: int = 85, spanning: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(links, members)`` of the Jaccard self-join.

    ``docs`` needs ``doc_id`` (long) and ``text``; other columns are ignored, so clashing names do no harm.
    ``links`` (a, b): links between class representatives, a < b: such as span every linked group, or without
    ``spanning`` all of them.  ``members`` (doc_id, n_shingles, rep): each row of ``docs`` with its set's size and the
    smallest doc_id that has the same set.  Null and empty texts and texts without words have an empty set and ``rep`` =
    their own doc_id.  A row with a null doc_id is a member whose ``rep`` is null, without links.  Rows repeated with one
    doc_id are one document; where their sets differ, the document has the links of each.  An empty table gives empty
    results.  A task needs memory for a few copies of the largest single text.
    """
    rows, made, nodes = _nodes(docs, n, percent)
    with passing(docs.sparkSession):
        return _links(rows, nodes, n, percent, spanning), _members(made, nodes)


def _links(rows: DataFrame, nodes: DataFrame, n: int, percent: int, spanning: bool) -> DataFrame:
    lists = _lists(nodes, percent)
    # rows that share a doc_id may have several sets; each has its bitmap
    maps = cut(_of(rows, lists.select(F.col("rep").alias("doc_id"))).mapInArrow(_bits(n), "rep long, n long, bits binary").where("n > 0").distinct(), "bitmaps")
    links = None
    labels = nodes.select("rep").limit(0).select("rep", F.col("rep").alias("label"))
    for tiles in (_first_tiles, lambda x: _all_tiles(x, labels)) if spanning else ():
        found = _verified(_tiled(tiles(lists), maps, percent, True), rows, n, percent)
        if found.isEmpty():
            continue
        links = links.unionByName(found) if links else found
        labels = cut(components(links).select(F.col("id").alias("rep"), F.col("component").alias("label")), "labels")
    found = _verified(_tiled(_all_tiles(lists, labels), maps, percent, False), rows, n, percent)
    return cut(links.unionByName(found) if links else found, "links", stays=True)


def exact_classes(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id``, the smallest doc_id reachable by links.  A row
    with a null doc_id has a null component_id.  For odd rows see :func:`exact_links`."""
    links, members = exact_links(docs, n, percent)
    groups = components(links).withColumnsRenamed({"id": "rep"})
    return members.join(groups, "rep", "left").select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))


def link_counts(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id, n_links``, a row per document with a doc_id: how many others it links to, equal sets among them.  Every
    link between different sets is found, which is more work than classes are."""
    links, members = exact_links(docs, n, percent, spanning=False)
    known = members.where("doc_id is not null").distinct()
    size = known.groupBy("rep").agg(F.count(F.lit(1)).alias("same"), F.max("n_shingles").alias("n"))
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    far = both.join(size.select(F.col("rep").alias("b"), F.col("same").alias("k")), "b").groupBy(F.col("a").alias("rep")).agg(F.sum("k").alias("far"))
    own = F.when(F.col("n") > 0, F.col("same") - 1).otherwise(F.lit(0))
    found = known.select("doc_id", "rep").join(size, "rep").join(far, "rep", "left")
    return found.groupBy("doc_id").agg(F.sum(own + F.coalesce("far", F.lit(0))).cast("long").alias("n_links"))
