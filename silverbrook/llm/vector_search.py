"""Operator 11, approximate nearest neighbours: an adaptive dimension scan within the probed lists of an inverted index.

Vectors are dealt to lists by their nearest centroid; each query probes some lists: as many as hold the share ``RECALL`` of the
nearest neighbours of a few queries that are compared with all rows.  (How many that takes depends on the vectors: few
where they lie in clusters, most lists where they are noise.)  A list's vectors are rotated by a random
orthogonal matrix and laid out in blocks of columns, so that after any number of columns the distance so far, times the
share of columns it leaves out, estimates the whole distance.  A hypothesis test after each block abandons the candidates
whose estimate exceeds the bound by more than chance allows (Gao and Long, 2023); the others go on to the next block, and
those that are left at the end are measured exactly, on the original vectors.  The bound is the distance of the ``k``-th nearest found so
far: a query first scans its nearest list, and the distance found there bounds the scan of its other lists, which run as
joins by list in their own tasks.

Equal vectors are one node with the smallest ids that a result can hold, and equal queries are searched once, so that copies cost no
more than their rows.  Lists are scanned in parts of bounded rows and queries.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from silverbrook.llm.storage import attach, cut
from silverbrook.llm.vectors import finite, matrix, packed, unpacked, usual_length

K = 10
#: The share of nearest neighbours that the probed lists must hold, the queries of a bounded sample by which the number of
#: probes is chosen for it, and the least number.
RECALL, TRIED, LEAST_PROBES = 0.97, 64, 8
#: Rows for each list, and the bounds of the centroids: how many, and numbers in all of them.
LIST_ROWS, MOST_LISTS, MOST_NUMBERS = 1000, 1 << 15, 1 << 22
#: Rows of the fit for each list, and in all: the only sample taken.  Every row is indexed.
FIT_ROWS, MOST_FIT, FIT_ROUNDS = 64, 1 << 17, 6
#: Rows that a query's lists hold together at least, as a multiple of ``k``.
ENOUGH = 20
#: The columns of a block, and how many times the usual error an estimate must exceed the bound by to be abandoned.
COLUMNS, ERROR = 16, 2.1
#: Rows and queries of a task's group.
PART_ROWS, PART_QUERIES = 4096, 1024
#: Rows measured in full where there is no bound yet.
OPENING = 64


def rotation(length: int, seed: int = 11) -> np.ndarray:
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(seed)).standard_normal((length, length)))
    return q * np.sign(np.diag(r))


class Part:
    """Rows of a list: rotated, in blocks of columns, and as they are."""

    def __init__(self, rows: np.ndarray, turn: np.ndarray):
        self.rows, self.length = rows, rows.shape[1]
        turned = rows @ turn
        self.blocks = [(i, np.ascontiguousarray(turned[:, i : i + COLUMNS].T)) for i in range(0, self.length, COLUMNS)]

    def scan(self, query: np.ndarray, turned: np.ndarray, bound: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(index, distance) of the ``k`` nearest rows within ``bound``; rows abandoned by the test are missing."""
        if not math.isfinite(bound) and len(self.rows) > OPENING >= k:
            bound = np.partition(self._measure(query, np.arange(OPENING)), k - 1)[k - 1]
        alive, so_far, limit = np.arange(len(self.rows)), np.zeros(len(self.rows)), bound * bound * (1 + 1e-9)
        for begin, block in self.blocks:
            columns = block if len(alive) == len(self.rows) else block[:, alive]
            apart = columns - turned[begin : begin + len(block), None]
            so_far = so_far + np.einsum("ij,ij->j", apart, apart)
            seen = begin + len(block)
            slack = (1 + ERROR / math.sqrt(seen)) ** 2 if seen < self.length else 1 + 1e-9
            keep = so_far * (self.length / seen) <= limit * slack
            alive, so_far = alive[keep], so_far[keep]
            if not len(alive):
                break
        far = self._measure(query, alive)
        if len(alive) > k:
            near = far <= np.partition(far, k - 1)[k - 1]
            alive, far = alive[near], far[near]
        return alive, far

    def _measure(self, query: np.ndarray, at: np.ndarray) -> np.ndarray:
        apart = self.rows[at] - query
        return np.sqrt((apart * apart).sum(1))


def _scan(kind: str, length: int, k: int):
    turn = rotation(length)
    empty = pd.DataFrame({"q": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})

    def run(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(queries):
            return empty
        read = lambda column: np.frombuffer(b"".join(column), kind).reshape(-1, length).astype(np.float64)
        part, asked = Part(read(rows["vector"]), turn), read(queries["vector"])
        ids, turned = rows["ids"].to_numpy(), asked @ turn
        out = []
        for i, bound in enumerate(queries["bound"].to_numpy(np.float64)):
            at, far = part.scan(asked[i], turned[i], bound, k)
            found = sorted((d, x) for j, d in zip(at, far, strict=True) for x in ids[j].tolist())[:k]
            out += [(queries["q"].iloc[i], x, d) for d, x in found]
        return pd.DataFrame(out, columns=["q", "vec_id", "score"]) if out else empty

    return run


def _fitted(sample: np.ndarray, lists: int) -> np.ndarray:
    """Centroids by Lloyd rounds over a sample; an empty list stays where it is."""
    rng = np.random.Generator(np.random.PCG64(1))
    centres = sample[rng.permutation(len(sample))[:lists]].astype(np.float32)
    sample = sample.astype(np.float32)
    for _ in range(FIT_ROUNDS):
        own = np.concatenate([nearest(sample[i : i + 4096], centres) for i in range(0, len(sample), 4096)])
        n = np.bincount(own, minlength=len(centres))
        order = np.argsort(own, kind="stable")
        used = np.flatnonzero(n)
        sums = np.add.reduceat(sample[order], (np.cumsum(n) - n)[used], axis=0)
        centres[used] = sums / n[used, None]
    return centres


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(1) - 2 * (rows @ centres.T)).argmin(1)


def _assign(centres, kind: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                own = nearest(unpacked(part.column("vector"), kind, length).astype(np.float32), centres.value)
                yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), part.column("ids"), part.column("vector")], ["list", "ids", "vector"])

    return run


def _probe(centres, sizes: np.ndarray, probes: int, enough: int, kind: str, length: int):
    """The lists of each query, nearest first: ``probes`` that hold rows, and more until they hold ``enough``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = np.flatnonzero(sizes)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows, c = unpacked(part.column("vector"), kind, length).astype(np.float32), centres.value[full]
                order = ((c * c).sum(1) - 2 * (rows @ c.T)).argsort(1, kind="stable")
                count = np.maximum(probes, 1 + (np.cumsum(sizes[full][order], 1) < enough).sum(1))
                take = np.arange(len(full)) < count[:, None]
                which, rank = np.nonzero(take)
                q = part.column("q").take(pa.array(which))
                yield pa.RecordBatch.from_arrays(
                    [q, part.column("vector").take(pa.array(which)), pa.array(full[order[take]].astype(np.int32)), pa.array(rank.astype(np.int32))], ["q", "vector", "list", "rank"]
                )

    return run


def _compare(tried: np.ndarray, k: int, kind: str, length: int):
    """The ``k`` nearest rows of a task for each tried query, with their lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        far, lists = np.zeros((len(tried), 0)), np.zeros((len(tried), 0), np.int32)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = unpacked(part.column("vector"), kind, length).astype(np.float64)
                d = (tried * tried).sum(1)[:, None] + (x * x).sum(1) - 2 * tried @ x.T
                far, lists = np.hstack([far, d]), np.hstack([lists, np.broadcast_to(part.column("list").to_numpy(), d.shape)])
                if far.shape[1] > k:
                    near = np.argpartition(far, k - 1, axis=1)[:, :k]
                    far, lists = np.take_along_axis(far, near, 1), np.take_along_axis(lists, near, 1)
        which = np.repeat(np.arange(len(tried), dtype=np.int32), far.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(which), pa.array(lists.ravel()), pa.array(far.ravel())], ["i", "list", "d"])

    return run


def _enough_probes(index: DataFrame, queries: DataFrame, centres: np.ndarray, sizes: np.ndarray, k: int, recall: float, kind: str, length: int) -> int:
    chosen = queries.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(TRIED).collect()
    tried = np.frombuffer(b"".join(bytes(r["vector"]) for r in chosen), kind).reshape(-1, length).astype(np.float64)
    full = np.flatnonzero(sizes)
    if len(full) <= LEAST_PROBES or not len(tried):
        return LEAST_PROBES
    found = index.select("list", "vector").mapInArrow(_compare(tried, k + 1, kind, length), "i int, list int, d double")
    place = F.row_number().over(Window.partitionBy("i").orderBy("d"))
    true = found.withColumn("place", place).where(f"place > 1 and place <= {k + 1}").select("i", "list").collect()  # without the query itself
    c = centres[full]
    order = full[((c * c).sum(1) - 2 * (tried.astype(np.float32) @ c.T)).argsort(1, kind="stable")]
    at = sorted(int(np.flatnonzero(order[r["i"]] == r["list"])[0]) for r in true)
    return max(LEAST_PROBES, at[min(len(at) - 1, math.ceil(recall * len(at)))] + 1) if at else LEAST_PROBES


def _clean(kind: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("vector"), length).astype(kind) + np.zeros(1, kind)  # -0.0 becomes 0.0
            keep = x.any(1)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").filter(pa.array(keep)), packed(x[keep])], ["vec_id", "vector"])

    return run


def _sampled(rows: DataFrame, share: float) -> DataFrame:
    """The rows whose vector's hash says so: all copies of a vector or none."""
    return rows if share >= 1 else rows.where(F.pmod(F.xxhash64("vector"), F.lit(1 << 40)) < math.ceil(share * (1 << 40)))


def search(vectors: DataFrame, asked: Column, k: int = K, recall: float = RECALL, probes: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each row of ``vectors`` (vec_id, embedding; other
    columns are ignored) for which ``asked``, an expression of vec_id, holds; nearest first, of equal distances the smaller id.

    Builds its index while the result is built: it counts, fits centroids on at most ``MOST_FIT`` vectors or so, writes
    the lists and chooses the number of ``probes``, unless it is given, by ``TRIED`` queries that are compared with all rows.  Rows with a null id, or a vector that is null, zero, not finite or of another length than the most frequent
    one, take no part.  A row isn't its own neighbour, nor is one of the same id.  Rows equal in id and vector are one
    candidate; each query row has a result of its own, whole unless fewer candidates exist than ``k``.  An empty table gives no rows.
    A task holds ``PART_ROWS`` vectors and ``PART_QUERIES`` queries of a list.  There are at most ``MOST_LISTS`` lists:
    beyond ``MOST_LISTS`` x ``LIST_ROWS`` rows lists grow with the table.
    """
    spark = vectors.sparkSession
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector")).where(F.col("vec_id").isNotNull() & finite(F.col("vector")))
    length = usual_length(given, "vector")
    if not length:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    kind = "<f4" if dict(given.dtypes)["vector"] == "array<float>" else "<f8"
    given = given.where(F.size("vector") == length)
    rows = given.mapInArrow(_clean(kind, length), "vec_id long, vector binary")
    count = given.count()
    lists = max(1, min(-(-count // LIST_ROWS), MOST_LISTS, MOST_NUMBERS // length))
    fit = _sampled(rows, min(MOST_FIT, lists * FIT_ROWS) / max(1, count)).select("vector").distinct().orderBy("vector")
    sample = [bytes(r["vector"]) for r in fit.collect()]
    if not sample:  # all rows are copies of a few vectors, none of which the hash has chosen
        sample = [bytes(r["vector"]) for r in rows.select("vector").limit(1).collect()] or [np.ones(length, kind).tobytes()]
    centres = spark.sparkContext.broadcast(_fitted(np.frombuffer(b"".join(sample), kind).reshape(-1, length), lists))

    order = Window.partitionBy("vector").orderBy("vec_id")
    nodes = rows.distinct().withColumn("copy", F.row_number().over(order)).where(F.col("copy") <= k + 1)
    nodes = nodes.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    index = cut(nodes.select("ids", "vector").mapInArrow(_assign(centres, kind, length), "list int, ids array<long>, vector binary"), "lists")
    sizes = np.zeros(len(centres.value), np.int64)
    for row in index.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect():
        sizes[row["list"]] = row["n"]

    asking = given.where(asked).mapInArrow(_clean(kind, length), "vec_id long, vector binary")
    queries = cut(asking.select("vector").distinct().withColumn("q", F.monotonically_increasing_id()), "queries")
    if probes is None:
        probes = _enough_probes(index, queries, centres.value, sizes, k, recall, kind, length)
    probed = cut(queries.mapInArrow(_probe(centres, sizes, probes, ENOUGH * (k + 1), kind, length), "q long, vector binary, list int, rank int"), "probes")

    def scanned(some: DataFrame) -> DataFrame:
        slices = some.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / F.lit(PART_QUERIES)).alias("slices")).collect()  # a row a list
        plan = F.broadcast(spark.createDataFrame([(r["list"], -(-int(sizes[r["list"]]) // PART_ROWS), int(r["slices"])) for r in slices], "list int, parts long, slices long"))
        each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        dealt = lambda n, by: F.pmod(F.xxhash64(by), F.col(n))
        left = index.join(plan, "list").withColumn("part", dealt("parts", "vector")).select("list", "part", each("slices").alias("slice"), "ids", "vector")
        right = some.join(plan, "list").withColumn("slice", dealt("slices", "q")).select("list", each("parts").alias("part"), "slice", "q", "vector", "bound")
        at = ["list", "part", "slice"]
        return left.groupBy(*at).cogroup(right.groupBy(*at)).applyInPandas(_scan(kind, length, k + 1), "q long, vec_id long, score double")

    opening = cut(scanned(probed.where("rank = 0").withColumn("bound", F.lit(math.inf))), "opening")
    place = F.row_number().over(Window.partitionBy("q").orderBy("score", "vec_id"))
    bounds = opening.withColumn("place", place).where(F.col("place") == k + 1).select("q", F.col("score").alias("bound"))
    others = probed.where("rank > 0").join(bounds, "q", "left").na.fill(math.inf, ["bound"])
    found = opening.unionByName(scanned(others)) if len(np.flatnonzero(sizes)) > 1 else opening
    best = found.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("q").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("best"))
    answers = queries.join(best, "q").select("vector", "best")
    own = attach(asking.withColumnRenamed("vec_id", "query_id"), answers, "vector", F.octet_length("vector") + 16 * F.size("best"), F.xxhash64("query_id"))
    left = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return own.select("query_id", F.posexplode(left).alias("rank", "x")).select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")
