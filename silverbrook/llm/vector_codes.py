"""Operator 12, vector code compression: product codes by Yinyang Lloyd rounds on integers.

Components become whole numbers, vectors are cut into parts, and each part position has a codebook.  A Lloyd round
assigns every part to the nearest entry and moves each entry to the floor of its parts' mean.  Only the first assignment
looks at all entries.  The entries of a codebook are clustered into ``GROUPS`` groups, and a part keeps one lower bound a
group: the least distance to the group's entries other than its own.  When entries have moved, a bound falls by the largest
move in its group; the distance to the own entry is computed anew, and only groups whose bound isn't beyond it are scanned.

Bounds are whole numbers, rounded down where distances are kept and up where moves are taken off, and a group is passed over
only if its bound is larger than the own distance, so entries at an equal distance are always compared, as integers.  The
codebooks, ``parts`` x ``entries`` integers a component, are all that reaches the driver, and so do the sums of a round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from silverbrook.llm.storage import attach, cut, delete, written
from silverbrook.llm.vectors import finite, matrix, packed, unpacked, usual_length

SCALE, PARTS, ENTRIES, ROUNDS, GROUPS = 256, 16, 64, 2, 8
#: The largest scaled component: beyond it squared distances don't fit 64 bits.
MOST = 1 << 29
#: Below this all terms of a squared distance are exact as doubles, so it may come from a matrix product.
EXACT = 1 << 23
#: Vectors handled at once.
BLOCK = 4096


def squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of each row of ``x`` to each entry, as integers."""
    if not x.size or max(np.abs(x).max(), np.abs(entries).max()) < EXACT:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)).astype(np.int64)
    out = np.zeros((len(x), len(entries)), np.int64)
    for i in range(x.shape[1]):
        out += (x[:, i, None] - entries[:, i]) ** 2
    return out


def floor_root(n: np.ndarray) -> np.ndarray:
    root = np.sqrt(n.astype(np.float64)).astype(np.int64)
    root -= root * root > n
    return root + ((root + 1) * (root + 1) <= n)


def ceil_root(n: np.ndarray) -> np.ndarray:
    root = floor_root(n)
    return root + (root * root < n)


class Bounds:
    """The entries of one part position, clustered, and how far each cluster has moved at most."""

    def __init__(self, entries: np.ndarray, group: np.ndarray, moved: np.ndarray):
        self.entries, self.group, self.moved = entries, group, moved
        self.members = [np.flatnonzero(group == g) for g in range(len(moved))]

    def first(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(nearest entry, its squared distance, bounds), by a full scan."""
        d = squares(x, self.entries)
        own, row = d.argmin(1), np.arange(len(x))
        best = d[row, own]
        d[row, own] = np.iinfo(np.int64).max
        return own, best, np.stack([self._kept(d[:, m].min(1)) if len(m) else np.full(len(x), 65535) for m in self.members], 1)

    @staticmethod
    def _kept(least: np.ndarray) -> np.ndarray:
        return np.minimum(floor_root(np.minimum(least, 1 << 32)), 65535)

    def again(self, x: np.ndarray, was: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """The same from the last round's entry and bounds, and the distances that were computed."""
        low = np.maximum(low.astype(np.int64) - self.moved, 0)
        own = was.astype(np.int64)
        start = ((x - self.entries[own]) ** 2).sum(1)
        best, work, seen = start.copy(), len(x), []
        fails = low * low <= start[:, None]
        for g, m in enumerate(self.members):
            at = np.flatnonzero(fails[:, g])
            if not len(at) or not len(m):
                continue
            d = squares(x[at], self.entries[m])
            work += d.size
            row, near = np.arange(len(at)), d.argmin(1)
            least, which = d[row, near], m[near]
            d[row, near] = np.iinfo(np.int64).max
            seen.append((g, at, least, which, d.min(1)))
            better = (least < best[at]) | ((least == best[at]) & (which < own[at]))
            best[at[better]], own[at[better]] = least[better], which[better]
        left = np.flatnonzero(own != was)
        low[left, self.group[was[left]]] = np.minimum(low[left, self.group[was[left]]], self._kept(start[left]))
        for g, at, least, which, second in seen:
            low[at, g] = self._kept(np.where(which == own[at], second, least))
        return own, best, low, work


def clustered(entries: np.ndarray, groups: int) -> np.ndarray:
    """A group for each entry: a few Lloyd rounds from entries spread over the codebook."""
    centres = entries[:: max(1, -(-len(entries) // groups))].astype(np.float64)
    for _ in range(5):
        group = ((entries[:, None] - centres) ** 2).sum(2).argmin(1)
        centres = np.stack([entries[group == g].mean(0) if (group == g).any() else centres[g] for g in range(len(centres))])
    return group


def _bounds(now: np.ndarray, before: np.ndarray, groups: list[np.ndarray]) -> list[Bounds]:
    out = []
    for entries, old, group in zip(now, before, groups, strict=True):
        move = ceil_root(((entries - old) ** 2).sum(1))
        out.append(Bounds(entries, group, np.array([move[group == g].max(initial=0) for g in range(group.max() + 1)])))
    return out


def _scaled(column: pa.Array, length: int, scale: int) -> np.ndarray:
    x = np.floor(matrix(column, length) * scale)
    if x.size and np.abs(x).max() > MOST:
        raise ArithmeticError(f"a component beyond {MOST / scale}")
    return x.astype(np.int32)


def _pack_state(own: list[np.ndarray], low: list[np.ndarray]) -> pa.Array:
    """An entry a part in one byte or two, and its bounds in two each."""
    return packed(np.concatenate([np.stack(own, 1), *low], 1).astype("<u2"))


def _assign(bounds: list[Bounds], length: int, scale: int, opening: bool, closing: bool):
    parts = len(bounds)
    width = length // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                part = whole.slice(at, BLOCK)
                x = _scaled(part.column("vector"), length, scale) if opening else unpacked(part.column("x"), "<i4", length)
                cuts = x.astype(np.int64).reshape(-1, parts, width)
                own, best, low = [], np.zeros(len(x), np.int64), []
                if opening:
                    done = [b.first(cuts[:, i]) for i, b in enumerate(bounds)]
                else:
                    state, done, j = unpacked(part.column("state"), "<u2", parts + sum(len(b.moved) for b in bounds)), [], parts
                    for i, b in enumerate(bounds):
                        done.append(b.again(cuts[:, i], state[:, i].astype(np.int64), state[:, j : j + len(b.moved)])[:3])
                        j += len(b.moved)
                for o, d, lo in done:
                    own.append(o)
                    low.append(lo)
                    best += d
                given = [part.column("id"), part.column("label")]
                if closing:
                    codes = np.stack(own, 1)
                    names = [bytes(c).hex() for c in codes.astype(np.uint8)]
                    yield pa.RecordBatch.from_arrays([*given, pa.array(names, pa.string()), pa.array(best)], ["id", "label", "code", "error"])
                else:
                    yield pa.RecordBatch.from_arrays([*given, packed(x), _pack_state(own, low)], ["id", "label", "x", "state"])

    return run


def _sum_parts(parts: int, entries: int, length: int, state_width: int):
    width = length // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, parts * entries), np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                part = whole.slice(at, BLOCK)
                x = unpacked(part.column("x"), "<i4", length).reshape(-1, width)
                own = unpacked(part.column("state"), "<u2", state_width)[:, :parts] + np.arange(parts) * entries
                place = own.ravel()
                total[0] += np.bincount(place, minlength=parts * entries)
                for i in range(width):  # sums of one block are far below 2**53
                    total[i + 1] += np.bincount(place, x[:, i], parts * entries).astype(np.int64)
        used = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(row[used]) for row in total)], ["place", *(f"s{i}" for i in range(width + 1))])

    return run


def _moved(state: DataFrame, entries: np.ndarray, state_width: int) -> np.ndarray:
    """The entries after one round: floors of their parts' means; an entry without parts stays."""
    parts, count, width = entries.shape
    names = [f"s{i}" for i in range(width + 1)]
    sums = state.select("x", "state").mapInArrow(_sum_parts(parts, count, parts * width, state_width), ", ".join(["place long", *(f"{n} long" for n in names)]))
    out = entries.reshape(-1, width).copy()
    for row in sums.groupBy("place").agg(*[F.sum(n).alias(n) for n in names]).collect():
        out[row["place"]] = [row[n] // row["s0"] for n in names[1:]]
    return out.reshape(entries.shape)


def encode(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, groups: int = GROUPS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of each row of ``vectors`` (vec_id, embedding, label; other
    columns are ignored) whose vector is there and finite.

    Runs its rounds while the result is built; two narrow tables are written a round, and the former one is deleted.
    Vectors of another length than the most frequent one are left out, and that length must be a multiple of ``parts``.
    The codebooks start from the ``entries`` smallest vec_ids, or all rows if there are fewer; rows that repeat a vec_id
    are rows like others, ordered by their vectors, and null ids come last.  Of entries at an equal distance the lower index
    counts.  Null labels are one label.  A component of more than ``MOST`` / ``scale`` raises ArithmeticError.  An empty
    table gives no rows.  A task holds ``BLOCK`` vectors at a time.
    """
    spark = vectors.sparkSession
    if entries > 256:
        raise ValueError("a code has two hex digits")
    rows = vectors.select(F.col("vec_id").alias("id"), F.col("label").alias("label"), F.col("embedding").alias("vector")).where(finite(F.col("vector")))
    length = usual_length(rows, "vector")
    kinds = dict(rows.dtypes)
    plain = f"id {kinds['id']}, label {kinds['label']}"
    shape = f"vec_id {kinds['id']}, code string, error long, label_error long, codebooks_sha256 string"
    if not length:
        return spark.createDataFrame([], shape)
    if length % parts:
        raise ValueError(f"vectors of {length} components in {parts} parts")
    rows = rows.where(F.size("vector") == length)
    seeds = rows.select("id", "vector").orderBy(F.asc_nulls_last("id"), "vector").limit(entries).collect()
    now = np.floor(np.array([r["vector"] for r in seeds], np.float64) * scale)
    if np.abs(now).max() > MOST:
        raise ArithmeticError(f"a component beyond {MOST / scale}")
    now = now.astype(np.int64).reshape(len(seeds), parts, -1).transpose(1, 0, 2)
    kept = [clustered(e, groups) for e in now]
    before, state, path = now, None, None
    state_width = parts + sum(int(g.max()) + 1 for g in kept)
    for _ in range(rounds):
        work = _assign(_bounds(now, before, kept), length, scale, state is None, False)
        old = path
        state, path = written((rows if state is None else state).mapInArrow(work, f"{plain}, x binary, state binary"), "assigned")
        if old:
            delete(spark, old)
        before, now = now, _moved(state, now, state_width)
    work = _assign(_bounds(now, before, kept), length, scale, state is None, True)
    codes = cut((rows if state is None else state).mapInArrow(work, f"{plain}, code string, error long"), "codes")
    if path:
        delete(spark, path)
    named = codes.withColumn("name", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("-")))
    labels = named.groupBy("name").agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, now.ravel().tolist())).encode()).hexdigest()
    out = attach(named, labels, "name", F.octet_length("name") + 8, F.xxhash64("id", "code"))
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


#: The same result in DuckDB's SQL, for vectors of 64 components.
_ASSIGN = """
d{r} AS (SELECT k, p.p, e, list_sum(list_transform(range(1, 5), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS d FROM parts p JOIN c{r} c ON c.p = p.p),
a{r} AS (SELECT k, p, CAST(arg_min(e, d * 64 + e) AS BIGINT) AS e, CAST(min(d) AS BIGINT) AS d FROM d{r} GROUP BY k, p)"""
_MOVE = """
m{s} AS (SELECT a.p, a.e, [CAST(floor(CAST(sum(x[1]) AS DOUBLE) / count(*)) AS BIGINT), CAST(floor(CAST(sum(x[2]) AS DOUBLE) / count(*)) AS BIGINT),
  CAST(floor(CAST(sum(x[3]) AS DOUBLE) / count(*)) AS BIGINT), CAST(floor(CAST(sum(x[4]) AS DOUBLE) / count(*)) AS BIGINT)] AS c
  FROM a{r} a JOIN parts p ON p.k = a.k AND p.p = a.p GROUP BY a.p, a.e),
c{s} AS (SELECT o.p, o.e, coalesce(m.c, o.c) AS c FROM c{r} o LEFT JOIN m{s} m ON m.p = o.p AND m.e = o.e)"""
ORACLE = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS k, vec_id, label, list_transform(embedding, lambda v: CAST(floor(256 * CAST(v AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
parts AS (SELECT k, p, q[4 * p + 1:4 * p + 4] AS x FROM kept, (SELECT unnest(range(16)) AS p)),
c0 AS (SELECT p, k - 1 AS e, x AS c FROM parts WHERE k <= 64),
{_ASSIGN.format(r=0)},
{_MOVE.format(r=0, s=1)},
{_ASSIGN.format(r=1)},
{_MOVE.format(r=1, s=2)},
{_ASSIGN.format(r=2)},
digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS h FROM c2),
coded AS (SELECT k, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY k)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM kept JOIN coded USING (k), digest
"""
