"""Operator 4, n-gram Jaccard join: size-banded tiles with hashed bitmap signatures.

A text's set holds the hashes of its distinct word n-grams.  The steps:

1. One pass over the texts gives each its set size, a 128-bit digest of the set and minhash keys.  Texts with equal sets
   are one node from then on (a copy group costs one row per slice of text and key).
2. Nodes that share a key form families (connected components).  A key joins ``ROWS`` minhashes and there are enough
   keys that a pair exactly at the threshold shares none with a probability under 1e-10; this is the only step that
   isn't exact.
3. A family is cut into size bands, whose sizes differ by the threshold at most, and bands into tiles of bounded bytes.
   Only tiles of the same or of neighbouring bands can hold links; each such pair of tiles is one group.  A text would be copied
   to every tile near it; where that is more than it has keys, as in a family of texts that are only alike in a chain, the lists of
   texts that share a key are the tiles instead, if that makes fewer copies.
4. In a group, every text has a parity bitmap of its hashed n-grams.  The bits in which two bitmaps differ bound the
   symmetric difference from below and so the overlap from above; pairs that may still link are compared exactly as
   sorted arrays.  Pairs already linked through others are skipped, which loses no component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from silverbrook.llm import wordarrays as wa
from silverbrook.llm.components import components
from silverbrook.llm.storage import cut

ROWS = 4
MISS = 1e-10
#: Bounds of a tile: texts, and n-grams in all of them.
TILE_TEXTS, TILE_GRAMS = 512, 1_000_000


def bands(similarity: float) -> int:
    """The number of keys for which a pair at the threshold shares none with probability ``MISS`` at most."""
    return max(1, math.ceil(math.log(MISS) / math.log1p(-min(similarity, 0.999) ** ROWS)))


def gram_sets(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct n-gram hashes of each text end to end, offsets).  A text of fewer than ``n`` words has the hash
    of its whole sequence; one without words has none."""
    words = wa.Words(column, lower=True)
    hashes, counts = words.hashes(), words.counts()
    texts = len(counts)
    runs = wa.grams(hashes, n)
    ok = wa.inside(words.first, n, len(hashes))
    owner = np.repeat(np.arange(texts), counts)
    values, owners = runs[ok], owner[: len(runs)][ok]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        extra = np.array([wa.grams(hashes[words.first[d] : words.first[d + 1]], int(counts[d]))[0] ^ np.uint64(counts[d]) for d in short], np.uint64)
        values, owners = np.concatenate([values, extra]), np.concatenate([owners, short])
    order = np.lexsort((values, owners))
    values, owners = values[order], owners[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    values, owners = values[new], owners[new]
    return values, np.searchsorted(owners, np.arange(texts + 1))


_SEEDS = wa.mix(np.arange(1, 1025, dtype=np.uint64)) | np.uint64(1)


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[at[1:]] - total[at[:-1]]


def digests(values: np.ndarray, at: np.ndarray) -> list[bytes]:
    """128 bits for each set; sets with equal digests count as equal."""
    a, b = _sums(wa.mix(values ^ _SEEDS[0]), at), _sums(wa.mix(values * _SEEDS[1]), at)
    both = np.stack([a, b + np.diff(at).astype(np.uint64)], 1).tobytes()
    return [both[i : i + 16] for i in range(0, len(both), 16)]


def minhash_keys(values: np.ndarray, at: np.ndarray, count: int) -> np.ndarray:
    """``count`` keys for each nonempty set (rows of empty ones are meaningless)."""
    texts = len(at) - 1
    full = np.flatnonzero(np.diff(at))
    out = np.zeros((texts, count), np.uint64)
    if not len(full):
        return out
    for band in range(count):
        key = np.full(len(full), band + 1, np.uint64)
        for row in range(ROWS):
            key = wa.mix(key * np.uint64(31) + np.minimum.reduceat(values * _SEEDS[2 + band * ROWS + row], at[full]))
        out[full, band] = key
    return out


def _signatures(n: int, count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in wa.slices(batches, "text", 1 << 20):
            values, at = gram_sets(part.column("text"), n)
            node, keys, seen = digests(values, at), minhash_keys(values, at, count).view(np.int64), set()
            rows = []
            for i, (d, known) in enumerate(zip(node, part.column("doc_id").is_valid().to_pylist(), strict=True)):
                rows.append(keys[i] if known and at[i + 1] > at[i] and d not in seen else None)
                if known:
                    seen.add(d)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(at)), pa.array(node, pa.binary()), pa.array(rows, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "node", "keys"],
            )

    return run


def _arrays(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in wa.slices(batches, "text", 1 << 20):
            values, at = gram_sets(part.column("text"), n)
            raw = [values[at[i] : at[i + 1]].tobytes() for i in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("tiles"), pa.array(raw, pa.binary())], ["doc_id", "tiles", "grams"])

    return run


def tile_links(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that span the linked groups among the given sets, found through bitmaps and exact intersection."""
    size = np.array([len(s) for s in sets])
    order = np.argsort(size, kind="stable")
    ids, sets, size = ids[order], [sets[i] for i in order], size[order]
    bits = 1 << max(8, int(np.ceil(np.log2(max(1, int(np.median(size)))))))
    bits = min(bits, 1 << 14)
    maps = np.zeros((len(sets), bits // 64), np.uint64)
    for i, s in enumerate(sets):
        odd = np.flatnonzero(np.bincount((s >> np.uint64(40)).astype(np.int64) & (bits - 1), minlength=bits) & 1)
        np.bitwise_xor.at(maps[i], odd >> 6, np.uint64(1) << (odd & 63).astype(np.uint64))
    label, links = np.arange(len(sets)), []
    most = np.searchsorted(size * percent, 100 * size, "right")
    for i in range(len(sets)):
        other = np.arange(i + 1, most[i])
        other = other[label[other] != label[i]]
        if not len(other):
            continue
        apart = np.bitwise_count(maps[other] ^ maps[i]).sum(1, dtype=np.int64)
        total = size[i] + size[other]
        overlap = (total - apart) // 2
        for j in other[100 * overlap >= percent * (total - overlap)]:
            if label[i] == label[j]:
                continue
            x, y = sets[i], sets[j]
            at = np.searchsorted(y, x)
            at[at == len(y)] = 0
            both = int(np.count_nonzero(y[at] == x))
            if 100 * both >= percent * (len(x) + len(y) - both):
                label[label == label[j]] = label[i]
                links.append((int(ids[i]), int(ids[j])))
    return links


def _verify(percent: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(x, np.uint64) for x in group["grams"]]
        links = tile_links(group["doc_id"].to_numpy(), sets, percent)
        return pd.DataFrame({"a": np.array([x for x, _ in links], np.int64), "b": np.array([y for _, y in links], np.int64)})

    return run


def _name(*parts):
    return F.concat_ws("/", *[p.cast("string") for p in parts])


def _spread(tiles, name):
    """A name for each of so many tiles."""
    return F.when(tiles > 0, F.transform(F.sequence(F.lit(0).cast("long"), tiles - 1), name)).otherwise(F.array().cast("array<string>"))


def _tiles_for(texts, grams):
    """How many tiles hold so many texts and n-grams."""
    return F.greatest(F.ceil(texts / F.lit(TILE_TEXTS)), F.ceil(grams / F.lit(TILE_GRAMS)))


def placed_tiles(nodes: DataFrame, family: DataFrame, count: int, percent: int) -> DataFrame:
    """``doc_id, tiles``: the tiles to which each text goes, for ``nodes`` (rep, n, keys) with their ``family``."""
    step = math.log(100 / percent) if percent < 100 else 1e-9
    live = cut(
        nodes.select("rep", "n").join(family, "rep").withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.lit(step) + F.lit(1e-9)).cast("long")),
        "families",
    )
    whole = live.groupBy("family").agg(F.count(F.lit(1)).alias("all_n"), F.sum("n").alias("all_grams"))
    per_band = live.groupBy("family", "band").agg(F.count(F.lit(1)).alias("here_n"), _tiles_for(F.count(F.lit(1)), F.sum("n")).alias("tiles_here"))
    neighbours = (
        per_band.join(per_band.select("family", (F.col("band") - 1).alias("band"), F.col("tiles_here").alias("tiles_up")), ["family", "band"], "left")
        .join(per_band.select("family", (F.col("band") + 1).alias("band"), F.col("tiles_here").alias("tiles_down")), ["family", "band"], "left")
        .na.fill(0, ["tiles_up", "tiles_down"])
        .join(whole, "family")
    )
    small = (F.col("all_n") <= TILE_TEXTS) & (F.col("all_grams") <= TILE_GRAMS)
    here = F.col("family"), F.col("band")
    tiles = F.when(small, F.array(_name(F.col("family")))).otherwise(
        F.concat(
            _spread(F.col("tiles_here"), lambda t: _name(*here, F.col("band"), F.least(t, F.col("salt")), F.greatest(t, F.col("salt")))),
            _spread(F.col("tiles_up"), lambda t: _name(*here, F.col("band") + 1, F.col("salt"), t)),
            _spread(F.col("tiles_down"), lambda t: _name(F.col("family"), F.col("band") - 1, F.col("band"), t, F.col("salt"))),
        )
    )
    placed = live.join(neighbours, ["family", "band"]).withColumn("salt", F.pmod(F.xxhash64("rep"), F.col("tiles_here")))
    copies = F.sum(F.col("here_n") * (F.col("tiles_here") + F.col("tiles_up") + F.col("tiles_down")))
    wide = cut(neighbours.where(~small).groupBy("family").agg(copies.alias("copies"), F.first("all_n").alias("all_n")).where(F.col("copies") > F.lit(count) * F.col("all_n")), "wide")
    if wide.isEmpty():
        return placed.select(F.col("rep").alias("doc_id"), tiles.alias("tiles"))
    posts = nodes.select("rep", "n", "keys").join(live.select("rep", "family"), "rep").join(wide.select("family"), "family").select("family", "rep", "n", F.explode("keys").alias("key"))
    lists = posts.groupBy("family", "key").agg(F.count(F.lit(1)).alias("list_n"), _tiles_for(F.count(F.lit(1)), F.sum("n")).alias("parts")).where("list_n > 1")
    cheap = lists.groupBy("family").agg(F.sum(F.col("list_n") * F.col("parts")).alias("key_copies")).join(wide, "family").where("key_copies < copies").select("family")
    chosen = posts.join(cheap, "family", "left_semi").join(lists, ["family", "key"]).withColumn("salt", F.pmod(F.xxhash64("rep"), F.col("parts")))
    names = _spread(F.col("parts"), lambda t: _name(F.lit("key"), F.col("family"), F.col("key"), F.least(t, F.col("salt")), F.greatest(t, F.col("salt"))))
    by_key = chosen.select("rep", names.alias("tiles")).groupBy("rep").agg(F.flatten(F.collect_list("tiles")).alias("tiles"))
    by_band = placed.join(cheap, "family", "left_anti").select("rep", tiles.alias("tiles"))
    return by_band.unionByName(by_key).withColumnRenamed("rep", "doc_id")


def jaccard_links(docs: DataFrame, n: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """``(links, members)`` of the Jaccard self-join.

    ``docs`` needs ``doc_id`` (long) and ``text``; other columns are ignored, so clashing names do no harm.
    ``links`` (a, b): links between class representatives that span every linked group.  ``members`` (doc_id,
    n_shingles, rep): each row of ``docs`` with its set's size and the smallest doc_id that has the same set.
    Null and empty texts and texts without words have an empty set and ``rep`` = their own doc_id.  A row with a null
    doc_id is a member whose ``rep`` is null, without links.  Rows repeated with one doc_id count as one document if their
    sets are equal.  An empty table gives empty results.  A task needs memory for a few copies of the largest single text.
    For all links, or without the probability of a miss, see :mod:`silverbrook.llm.exact_join`.  Runs jobs while it is built: keys,
    families and tiles are written as tables.
    """
    count = bands(percent / 100)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = cut(rows.mapInArrow(_signatures(n, count), "doc_id long, n_shingles long, node binary, keys array<long>"), "signatures")
    full = made.where("n_shingles > 0 and doc_id is not null")
    nodes = cut(full.groupBy("node").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.first("keys", True).alias("keys")), "nodes")
    posts = nodes.select("rep", F.explode("keys").alias("key"))
    heads = posts.groupBy("key").agg(F.min("rep").alias("head"), F.max("rep").alias("tail")).where("head < tail").select("key", "head")
    family = components(posts.join(heads, "key").select("rep", "head"), "rep", "head").withColumnsRenamed({"id": "rep", "component": "family"})

    placed = placed_tiles(nodes, family, count, percent)
    texts = rows.where("doc_id is not null").join(placed.hint("shuffle_hash"), "doc_id").select("doc_id", "text", "tiles")
    sets = texts.mapInArrow(_arrays(n), "doc_id long, tiles array<string>, grams binary").select("doc_id", "grams", F.explode("tiles").alias("tile"))
    links = sets.groupBy("tile").applyInPandas(_verify(percent), "a long, b long").where("a <> b")
    alone = made.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("rep"))
    members = full.select("doc_id", "n_shingles", "node").join(nodes.select("node", "rep"), "node").select("doc_id", "n_shingles", "rep")
    return links, members.unionByName(alone)


def jaccard_classes(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id``, the smallest doc_id reachable by links.  A row
    with a null doc_id has a null component_id.  For other odd rows see :func:`jaccard_links`."""
    links, members = jaccard_links(docs, n, percent)
    groups = components(links).withColumnsRenamed({"id": "rep"})
    return members.join(groups, "rep", "left").select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
