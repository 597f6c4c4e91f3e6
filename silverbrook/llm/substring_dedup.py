"""Operator 8, substring dedup: super-k-mer partitioning of word windows.

A window is ``WINDOW`` consecutive words of one document.  Its minimiser is the least of its word 3-grams in an order
that puts common 3-grams last (:mod:`~silverbrook.llm.rarity`) and is random otherwise.  Consecutive windows with
the same minimiser form a super-k-mer, which travels as one packed string to the bucket of that minimiser; all windows
with equal words meet there.  In the bucket windows are sorted by hash, runs of equal hashes are compared byte by byte,
and every window but the earliest of its run is marked.  The marks of a document come back as intervals of words.

Skew: equal super-k-mers of one slice of text are packed once, so a copy group costs one string per slice; strings that
merely touch a common passage are dealt by their rarer words.  Windows whose every 3-gram is common have two minimisers, the
second in an order of its own, and both together choose the bucket; so a passage that very many documents have is dealt to
as many buckets as it has second minimisers.  Their strings are held back and packed once per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from silverbrook.llm import rarity, wordarrays as wa
from silverbrook.llm.storage import partitions

#: Words in a gram of the minimiser order.
GRAM = 3
#: Text bytes that one bucket and one slice are meant for.
BUCKET_BYTES, SLICE = 3 << 20, 4 << 20
#: Bytes of common strings and of their occurrences that a task holds back before it sends them.
HELD_BYTES = 8 << 20
#: Bytes that are compared at once, each of which takes some 50 bytes of memory meanwhile.
COMPARED = 1 << 19
_LOWEST = -(1 << 63)


def _text(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _keyed(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id (null: the lowest), a check sum of the text and the text: the first two name a document.  Columns to carry
    along stand in a struct."""
    text = _text()
    more = [F.struct(*carry).alias("carried")] if carry else []
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST)).alias("doc_id"), F.crc32(text.cast("binary")).alias("tag"), text.alias("text"), *more)


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of ``width`` values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def _flat(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions of the ranges end to end."""
    if not len(size):
        return np.zeros(0, np.int64)
    ends = np.cumsum(size)
    return np.arange(ends[-1]) + np.repeat(start - (ends - size), size)


def _equal_ranges(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ranges from a and from b hold the same bytes; so many at once as hold ``COMPARED`` bytes, or one."""
    ok, ends, i = np.ones(len(a), bool), np.cumsum(size), 0
    while i < len(a):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + COMPARED, "right")))
        n = size[i:j]
        same = data[_flat(a[i:j], n)] == data[_flat(b[i:j], n)]
        ok[i:j] = np.logical_and.reduceat(same, np.cumsum(n) - n) if len(same) else True
        i = j
    return ok


def _gathered(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of the ranges end to end."""
    whole = memoryview(np.ascontiguousarray(data))
    return np.frombuffer(b"".join([whole[i : i + n] for i, n in zip(start.tolist(), size.tolist(), strict=True)]), np.uint8)


_ZSTD = pa.Codec("zstd", compression_level=5)


def _pack(texts: list[bytes], owner: np.ndarray, doc: np.ndarray, tag: np.ndarray, start: np.ndarray) -> bytes:
    head = np.array([len(texts), len(owner)], np.int64)
    parts = [head, np.array([len(x) for x in texts], np.int32), owner.astype(np.int32), doc.astype(np.int64), tag.astype(np.uint32), start.astype(np.int32)]
    raw = b"".join(p.tobytes() for p in parts) + b"".join(texts)
    return len(raw).to_bytes(8, "little") + _ZSTD.compress(raw, asbytes=True)


def _unpack(blob: bytes) -> list:
    raw = _ZSTD.decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)
    texts, seen = (int(x) for x in np.frombuffer(raw, np.int64, 2))
    at, out = 16, []
    for kind, n in ((np.int32, texts), (np.int32, seen), (np.int64, seen), (np.uint32, seen), (np.int32, seen)):
        out.append(np.frombuffer(raw, kind, n, at))
        at += out[-1].nbytes
    return [*out, np.frombuffer(raw, np.uint8, offset=at)]


def super_kmers(column: pa.Array, classes: np.ndarray, window: int):
    """Of a slice of texts: the words and their hashes, and (text, first word, last word + 1, key of its bucket, whether
    all its 3-grams are common) of each super-k-mer."""
    words = wa.Words(column)
    hashes = words.hashes()
    grams = wa.grams(hashes, GRAM)
    at = np.flatnonzero(wa.inside(words.first, window, len(hashes)))
    if not len(at):
        none = np.zeros(0, np.int64)
        return words, hashes, none, none, none, np.zeros(0, np.uint64), np.zeros(0, bool)
    least = _least(rarity.ranks(grams, classes), window - GRAM + 1)
    common = least >= np.uint64(1 << 56)
    second = _least(wa.mix(grams ^ np.uint64(0xD6E8FEB86659FD93)), window - GRAM + 1)
    least = np.where(common, wa.mix(least * np.uint64(0xA0761D6478BD642F) ^ second), least)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (least[at[1:]] != least[at[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    begin = at[first]
    return words, hashes, np.searchsorted(words.first, begin, "right") - 1, begin, at[last] + window, least[begin], common[begin]


class _Held:
    """Common strings of a task, each with all its occurrences (document, its check sum, first word)."""

    def __init__(self) -> None:
        self.strings: dict[tuple[int, bytes], list[np.ndarray]] = {}
        self.size = 0

    def add(self, bucket: int, string: bytes, seen: np.ndarray) -> None:
        have = self.strings.get((bucket, string))
        if have is None:
            have = self.strings[bucket, string] = []
            self.size += len(string) + 200
        have.append(seen)
        self.size += seen.nbytes + 100

    def sent(self) -> pa.RecordBatch:
        names, blobs = [], []
        by: dict[int, list[tuple[bytes, np.ndarray]]] = {}
        for (bucket, string), parts in self.strings.items():
            by.setdefault(bucket, []).append((string, np.concatenate(parts)))
        for bucket, found in by.items():
            owner = np.repeat(np.arange(len(found)), [len(x) for _, x in found])
            seen = np.concatenate([x for _, x in found])
            names.append(bucket)
            blobs.append(_pack([x for x, _ in found], owner, seen[:, 0], seen[:, 1], seen[:, 2]))
        self.__init__()
        return _blobs(names, blobs)


def _blobs(names: list[int], blobs: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "blob"])


def _travel(classes: np.ndarray, buckets: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held()
        for part in wa.slices(batches, "text", SLICE):
            words, hashes, text, begin, end, key, common = super_kmers(part.column("text"), classes, window)
            if not len(begin):
                continue
            up, down = wa.powers(len(hashes) + 1, 0xC2B2AE3D27D4EB4F)
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[: len(hashes)], dtype=np.uint64)])
            whole = wa.mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))
            data, start, stop = words.canonical()
            a, b = start[begin], stop[end - 1]
            order = np.argsort(whole, kind="stable")
            same = np.zeros(len(order), bool)
            o, p = order[1:], order[:-1]
            near = np.flatnonzero((whole[o] == whole[p]) & (b[o] - a[o] == b[p] - a[p]))
            same[1 + near] = _equal_ranges(data, a[o[near]], a[p[near]], b[o[near]] - a[o[near]])
            # the first of equal strings stands for them; strings keep the order of the text, which packs best
            head = order[~same]
            owner = np.empty(len(order), np.int64)
            owner[order] = head[np.cumsum(~same) - 1]
            head = np.sort(head)
            owner = np.searchsorted(head, owner)
            doc = part.column("doc_id").to_numpy()
            tag = part.column("tag").to_numpy()
            to = (wa.mix(key[head] ^ np.uint64(0xB0C4E7)) % np.uint64(buckets)).astype(np.int64)
            by = np.lexsort((to, common[head]))  # common strings last
            usual = int(np.count_nonzero(~common[head]))
            place = np.empty(len(head), np.int64)
            place[by] = np.arange(len(head))
            occ = np.argsort(place[owner], kind="stable")
            slot = place[owner[occ]]
            first_word = words.first[text]
            sorted_to = to[by[:usual]]
            bound = np.flatnonzero(np.concatenate([[True], sorted_to[1:] != sorted_to[:-1], [True]])) if usual else np.zeros(1, np.int64)
            blobs, names = [], []
            memory = data.tobytes()
            for lo, hi in zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True):
                here = head[by[lo:hi]]
                x, y = np.searchsorted(slot, [lo, hi])
                seen = occ[x:y]
                blobs.append(_pack([memory[i:j] for i, j in zip(a[here], b[here], strict=True)], slot[x:y] - lo, doc[text[seen]], tag[text[seen]], begin[seen] - first_word[seen]))
                names.append(int(sorted_to[lo]))
            if names:
                yield _blobs(names, blobs)
            edge = np.searchsorted(slot, np.arange(usual, len(head) + 1))
            for k, x, y in zip(range(usual, len(head)), edge[:-1].tolist(), edge[1:].tolist(), strict=False):
                h, seen = head[by[k]], occ[x:y]
                held.add(int(to[by[k]]), memory[a[h] : b[h]], np.stack([doc[text[seen]], tag[text[seen]], begin[seen] - first_word[seen]], 1))
            if held.size > HELD_BYTES:
                yield held.sent()
        if held.strings:
            yield held.sent()

    return run


def repeated_spans(blobs: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc, tag, first word, last word + 1) of what the windows of one bucket repeat."""
    parts = [_unpack(x) for x in blobs]
    size = np.concatenate([p[0] for p in parts]).astype(np.int64)
    base = np.cumsum([0] + [len(p[0]) for p in parts[:-1]])
    owner = np.concatenate([p[1] + n for p, n in zip(parts, base, strict=True)]).astype(np.int64)
    doc, tag, start = (np.concatenate([p[i] for p in parts]) for i in (2, 3, 4))
    tag, start = tag.astype(np.int64), start.astype(np.int64)
    data = np.concatenate([p[5] for p in parts])
    at = np.cumsum(size) - size
    count = np.add.reduceat(data == 0x20, at, dtype=np.int64) + 1
    # the earliest occurrence of each string; all windows of later ones repeat it
    order = np.lexsort((start, tag, doc, owner))
    head = np.ones(len(order), bool)
    head[1:] = owner[order][1:] != owner[order][:-1]
    later = order[~head]
    first_of = np.empty(len(size), np.int64)
    first_of[owner[order[head]]] = order[head]
    f = first_of[owner[later]]
    later = later[(doc[later] != doc[f]) | (tag[later] != tag[f]) | (start[later] != start[f])]
    out = [(doc[later], tag[later], start[later], start[later] + count[owner[later]])]
    # windows of the strings, in the order of their earliest occurrences
    first = first_of[np.lexsort((start[first_of], tag[first_of], doc[first_of]))]
    string = owner[first]
    n = size[string]
    data = _gathered(data, at[string], n)
    offsets = np.concatenate([[0], np.cumsum(n)])
    column = pa.Array.from_buffers(pa.large_string(), len(string), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
    words = wa.Words(column)
    hashes = words.hashes()
    where = np.flatnonzero(wa.inside(words.first, window, len(hashes)))
    grams = wa.grams(hashes, window)[where]
    order = np.argsort(grams, kind="stable")
    grams = grams[order]
    new = np.ones(len(order), bool)
    new[1:] = grams[1:] != grams[:-1]
    run = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    again = np.flatnonzero(~new)
    a, b = words.start[where[order[again]]], words.start[where[order[run[again]]]]
    n = words.end[where[order[again]] + window - 1] - a
    ok = (words.end[where[order[run[again]]] + window - 1] - b == n)
    ok[ok] = _equal_ranges(data, a[ok], b[ok], n[ok])
    text = np.searchsorted(words.first, where, "right") - 1
    spot = start[first][text] + where - words.first[text]
    id_, mark = doc[first][text], tag[first][text]
    if not ok.all():  # different windows with one hash: tell them apart by their words
        for r in np.unique(run[again[~ok]]):
            known: dict[bytes, int] = {}
            stop = r + 1
            while stop < len(order) and not new[stop]:
                stop += 1
            for k in range(r, stop):
                w = where[order[k]]
                name = data[words.start[w] : words.end[w + window - 1]].tobytes()
                if k > r:
                    ok[np.searchsorted(again, k)] = name in known
                known.setdefault(name, k)
    hit = order[again[ok]]
    lead = order[run[again[ok]]]
    hit = np.sort(hit[(id_[hit] != id_[lead]) | (mark[hit] != mark[lead]) | (spot[hit] != spot[lead])])
    if len(hit):
        cut = np.ones(len(hit), bool)
        cut[1:] = (hit[1:] != hit[:-1] + 1) | (text[hit[1:]] != text[hit[:-1]])
        i = np.flatnonzero(cut)
        j = np.append(i[1:], len(hit)) - 1
        out.append((id_[hit[i]], mark[hit[i]], spot[hit[i]], spot[hit[j]] + window))
    return tuple(np.concatenate([x[k] for x in out]) for k in range(4))


def _judge(window: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        doc, tag, start, end = repeated_spans(list(group["blob"]), window)
        order = np.lexsort((start, tag, doc))
        doc, tag = doc[order], tag[order]
        spans = np.stack([start[order], end[order]], 1).astype(np.int32)
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])
        at = np.flatnonzero(new)
        to = np.append(at, len(doc))[1:]
        return pd.DataFrame({"doc_id": doc[at], "tag": tag[at], "spans": [spans[i:j].tobytes() for i, j in zip(at, to, strict=True)]})

    return run


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in wa.slices(batches, "text"):
        given = [c for c in part.schema.names if c != "spans"]
        words = wa.Words(part.column("text"))
        change = np.zeros(len(words) + 1, np.int64)
        for d, spans in enumerate(part.column("spans").to_pylist()):
            if spans:
                at = np.frombuffer(b"".join(spans), np.int32).reshape(-1, 2) + words.first[d]
                np.add.at(change, at[:, 0], 1)
                np.add.at(change, at[:, 1], -1)
        gone = np.cumsum(change[:-1]) > 0
        counts = words.counts()
        lost = np.concatenate([[0], np.cumsum(gone)])
        removed = lost[words.first[1:]] - lost[words.first[:-1]]
        data, start, end = words.canonical()
        keep = np.repeat(~gone, end - start + 1)
        size = np.concatenate([[0], np.cumsum(np.where(gone, 0, end - start + 1))])[words.first]
        memory = data[keep].tobytes()
        kept = [memory[i : max(i, j - 1)] for i, j in zip(size[:-1], size[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*(part.column(c) for c in given), pa.array(counts), pa.array(removed), pa.array([hashlib.sha256(x).hexdigest() for x in kept]), pa.array([x if r else None for x, r in zip(kept, removed, strict=True)], pa.binary()).cast(pa.string())],
            [*given, "n_words", "n_removed", "kept_sha256", "kept"],
        )


def repeat_intervals(docs: DataFrame, window: int = 20) -> DataFrame:
    """``doc_id, tag, spans`` (int32 pairs of word bounds) for what repeats; ``docs`` as :func:`_keyed` gives it."""
    classes = rarity.common_classes(docs, GRAM)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(partitions(docs.sparkSession), int(size // BUCKET_BYTES) + 1)
    blobs = docs.mapInArrow(_travel(classes, buckets, window), "bucket int, blob binary")
    return blobs.groupBy("bucket").applyInPandas(_judge(window), "doc_id long, tag long, spans binary")


def remove_repeats(docs: DataFrame, window: int = 20, carry: tuple[str, ...] = ()) -> DataFrame:
    """Remove every word that a repeated window covers.

    Needs ``doc_id`` (long) and ``text``; of other columns those named in ``carry`` come back in the struct ``carried``.
    One row per row of ``docs``: ``doc_id, text, n_words, n_removed, kept_sha256, kept``; ``kept`` is null where nothing
    was removed.  Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  Earlier means a smaller doc_id (a null one comes
    first), then, where several texts carry one doc_id, the smaller check sum, then the position.  A row that stands
    twice in the table is one occurrence and doesn't repeat itself.  Null, empty and texts of fewer than ``window`` words
    lose nothing, and an empty table gives an empty result.  A task needs memory for some 20 copies of the largest single
    text.
    """
    keyed = _keyed(docs, carry)
    spans = repeat_intervals(keyed.select("doc_id", "tag", "text"), window).groupBy("doc_id", "tag").agg(F.collect_list("spans").alias("spans"))
    joined = keyed.join(spans, ["doc_id", "tag"], "left").select(*keyed.columns, "spans")
    kinds = ", ".join(f"{name} {kind}" for name, kind in keyed.dtypes)
    out = joined.mapInArrow(_apply, f"{kinds}, n_words long, n_removed long, kept_sha256 string, kept string").drop("tag")
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(_LOWEST)))
