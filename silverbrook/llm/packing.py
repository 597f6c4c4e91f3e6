"""Operator 10, packing: order-preserving dynamic programming over a stream of tokens.

Every partition of the input is one stream: its documents in order, each followed by an end token.  A stream is cut into
windows of at most ``LENGTH`` tokens.  Cuts may stand after documents (no penalty), after sentences (a small one) and,
inside long runs without either, every few tokens (a larger one).  With f(j) the least cost of the stream up to cut j,

    f(j) = penalty(j) + min over i of f(i) + padding(p(j) - p(i)) + a constant for each window,

and as padding is ``LENGTH`` minus the window's size, the minimum over the last ``LENGTH`` tokens is a sliding minimum
of f(i) + p(i), kept in a monotone queue.  Windows whose size is a power of two aren't padded; half a window is
tried everywhere, smaller powers at the end of a stream.  No data is shuffled and a task holds a bounded stretch of its stream.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from silverbrook.llm import wordarrays as wa

LENGTH, END = 2048, 1
#: In tokens: a cut after a sentence, one elsewhere, and a window.
SENTENCE, ELSEWHERE, WINDOW = 12, 40, 16
#: Inside runs without a sentence's end longer than GAP tokens a cut may stand every GAP tokens.
GAP = 48
#: Of the sentences that end in SPARSE tokens the first counts.
SPARSE = 16
#: Tokens of a stream that are laid out at once.
STRETCH = 1 << 18
CACHE_WORDS = 1_500_000
_MARKS, _PLAIN, _STOPS = b".,!?;:", b"abcdefghijklmnopqrstuvwxyz0123456789", b".!?"
_IS_PLAIN, _IS_STOP = (np.isin(np.arange(256), list(x)) for x in (_PLAIN, _STOPS))
#: Words of small Latin letters, and the characters by which byte-level vocabularies name bytes: printable ones of
#: Latin-1 themselves, the others by turns those from 256 on.
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_BYTE_NAMES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}


class WordIds:
    """Token ids by word.  The tokenizer lower-cases and drops white space, and no token spans it, so a text's ids are
    those of its words ``[^\\x20\\x09-\\x0D]+`` end to end; each distinct word is encoded once, until the cache is full.
    A mark after an ASCII letter or digit is a token run of its own, so ``word,`` has the ids of ``word`` and of ``,``.
    Words are known by two 64-bit hashes, sorted by the first: some 40 bytes a word."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        marks = self._encode([bytes([m]) for m in _MARKS])
        self.fixed = np.array([END, *chain.from_iterable(marks)], np.uint32)
        size = np.array([len(x) for x in marks])
        self.mark_start, self.mark_size = np.zeros(256, np.int64), np.zeros(256, np.int64)
        self.mark_start[list(_MARKS)], self.mark_size[list(_MARKS)] = 1 + np.cumsum(size) - size, size
        self.reset()

    def reset(self) -> None:
        self.key, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids = self.fixed

    def _encode(self, words: list[bytes]) -> list[list[int]]:
        found, rest, one = [], [], self.model.tokenize
        for i, w in enumerate(words):
            # neither the normaliser nor the splitting into runs does anything to small Latin letters
            if w.isalpha():  # ASCII alone
                found.append([t.id for t in one(w.decode())])
            elif _LETTERS.fullmatch(w):
                found.append([t.id for t in one(w.decode("latin-1").translate(_BYTE_NAMES))])
            else:
                found.append(None)
                rest.append(i)
        for i, x in zip(rest, self.tokenizer.encode_batch_fast([words[i].decode() for i in rest], add_special_tokens=False), strict=True):
            found[i] = x.ids
        return found

    def _look_up(self, words: wa.Words) -> tuple[np.ndarray, np.ndarray]:
        """(start in ``ids``, size) of each word; new words are encoded."""
        key, check = words.hashes(), words.hashes(0xC2B2AE3D27D4EB4F)
        distinct, first, which = np.unique(key, return_index=True, return_inverse=True)
        for i in np.flatnonzero(check != check[first][which]):  # two words with one hash: they stand for themselves
            which[i] = len(first)
            first = np.append(first, i)
        at = np.minimum(np.searchsorted(self.key, key[first]), max(0, len(self.key) - 1))
        known = (self.key[at] == key[first]) & (self.check[at] == check[first]) if len(self.key) else np.zeros(len(first), bool)
        start, size = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        start[known], size[known] = self.start[at[known]], self.size[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            memory, n = words.data.tobytes(), first[new]
            found = self._encode([memory[i:j] for i, j in zip(words.start[n].tolist(), words.end[n].tolist(), strict=True)])
            size[new] = np.fromiter(map(len, found), np.int64, len(found))
            start[new] = len(self.ids) + np.cumsum(size[new]) - size[new]
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), np.uint32)])
            new = new[new < len(distinct)]
            place = np.searchsorted(self.key, key[first[new]])
            free = np.ones(len(new), bool) if not len(self.key) else self.key[np.minimum(place, len(self.key) - 1)] != key[first[new]]
            new, place = new[free], place[free]
            self.key, self.check = np.insert(self.key, place, key[first[new]]), np.insert(self.check, place, check[first[new]])
            self.start, self.size = np.insert(self.start, place, start[new]), np.insert(self.size, place, size[new])
        return start[which], size[which]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, each followed by the end token; tokens of each text; where sentences end)."""
        if len(self.key) > CACHE_WORDS:
            self.reset()
        words = wa.Words(column, lower=True)
        last = words.data[words.end - 1]
        marked = (words.end - words.start > 1) & (self.mark_size[last] > 0) & _IS_PLAIN[words.data[words.end - 2]]
        words.end = words.end - marked
        start, size = self._look_up(words)
        texts = len(words.first) - 1
        owner = np.repeat(np.arange(texts), np.diff(words.first))
        # a text's units: its words, each with its mark, and the end token
        units = np.concatenate([[0], np.cumsum(1 + marked)])
        word_at, end_at = units[:-1] + owner, units[words.first[1:]] + np.arange(texts)
        mark_at = word_at[marked] + 1
        unit_start, unit_size = np.zeros(units[-1] + texts, np.int64), np.ones(units[-1] + texts, np.int64)
        unit_start[word_at], unit_size[word_at] = start, size
        unit_start[mark_at], unit_size[mark_at] = self.mark_start[last[marked]], self.mark_size[last[marked]]
        ids = self.ids[_flat(unit_start, unit_size)]
        bounds = np.cumsum(unit_size)
        length = np.diff(np.concatenate([[0], bounds[end_at]]))
        return ids, length, bounds[(word_at + marked)[_IS_STOP[last]]]


def _flat(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


def cut_places(length: int, documents: np.ndarray, sentences: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, penalties) of the cuts allowed in a stream, 0 and its end among them."""
    # one sentence's end in every few tokens is choice enough
    soft = np.unique(np.concatenate([[0], documents, sentences[np.unique(sentences // SPARSE, return_index=True)[1]]]))
    gap = np.diff(soft)
    wide = np.flatnonzero(gap > GAP)
    steps = (gap[wide] - 1) // GAP
    hard = (_flat(np.zeros(len(wide), np.int64), steps) + 1) * GAP + np.repeat(soft[wide], steps)
    at = np.concatenate([soft, hard])
    cost = np.concatenate([np.full(len(soft), SENTENCE), np.full(len(hard), ELSEWHERE)])
    cost[: len(soft)][np.isin(soft, documents)] = 0
    cost[0] = 0
    order = np.argsort(at, kind="stable")
    return at[order], cost[order]


def lay_out(at: list[int], cost: list[int], limit: int = LENGTH) -> list[int]:
    """The cheapest windows: their ends, as positions.  ``at`` must hold a place in every ``limit`` tokens."""
    best, back, key, queue = [0], [0], [0], deque([0])
    place = {0: 0}
    half = limit >> 1
    for j in range(1, len(at)):
        p = at[j]
        while at[queue[0]] < p - limit:
            queue.popleft()
        i = queue[0]
        least, origin = key[i] + limit - p, i
        i = place.get(p - half)
        if i is not None and best[i] < least:
            least, origin = best[i], i
        least += cost[j] + WINDOW
        best.append(least)
        back.append(origin)
        place[p] = j
        least += p
        key.append(least)
        while queue and key[queue[-1]] >= least:
            queue.pop()
        queue.append(j)
    out, j = [], len(at) - 1
    while j:
        out.append(at[j])
        j = back[j]
    return out[::-1]


class _Stream:
    def __init__(self, keep_ids: bool):
        self.docs, self.length, self.ids, self.sentences = [], [], [], []
        self.tokens = 0
        self.done = 0  # tokens of the first document that earlier windows hold
        self.sequence = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        self.keep_ids = keep_ids

    def add(self, docs: list, ids: np.ndarray, length: np.ndarray, sentences: np.ndarray) -> None:
        self.sentences.append(sentences + self.tokens)
        self.docs += docs
        self.length.append(length)
        self.ids.append(ids)
        self.tokens += len(ids)

    def flush(self, last: bool) -> pa.RecordBatch:
        length = np.concatenate(self.length)
        ids = np.concatenate(self.ids)
        sentences = np.concatenate(self.sentences)
        ends = np.cumsum(length) - self.done
        at, cost = cut_places(len(ids), ends, sentences)
        cuts = lay_out(at.tolist(), cost.tolist())
        if last:
            begin = cuts[-2] if len(cuts) > 1 else 0
            rest, cuts = cuts[-1] - begin, cuts[:-1]
            while rest:  # the end of a stream: powers of two, which need no padding
                begin += 1 << (rest.bit_length() - 1)
                rest ^= 1 << (rest.bit_length() - 1)
                cuts.append(begin)
        else:  # what the next stretch may lay out better stays
            cuts = [c for c in cuts if c <= len(ids) - 2 * LENGTH]
        stop = cuts[-1]
        bound = np.unique(np.concatenate([[0], ends[ends <= stop], cuts]))
        start, end = bound[:-1], bound[1:]
        doc = np.searchsorted(ends, start, "right")
        window = np.searchsorted(cuts, start, "right")
        window_start = np.concatenate([[0], cuts])[window]
        doc_start = ends - length
        memory = ids.tobytes()
        pieces = [memory[4 * i : 4 * j] for i, j in zip(start.tolist(), end.tolist(), strict=True)]
        columns = [
            pa.array([self.docs[d] for d in doc.tolist()], pa.int64()),
            pa.array(start - doc_start[doc]),
            pa.array(end - start),
            pa.array([zlib.crc32(x) for x in pieces], pa.int64()),
            pa.array(length[doc]),
            pa.array(window + self.sequence),
            pa.array(start - window_start),
        ]
        if self.keep_ids:
            columns.append(pa.array(pieces, pa.binary()))
        self.sequence += len(cuts)
        # documents that reach beyond the last window go on in the next stretch
        over = int(np.searchsorted(ends, stop, "right"))
        self.done = int(stop - doc_start[over]) if over < len(ends) else 0
        self.docs, self.length = self.docs[over:], [length[over:]]
        self.ids, self.sentences = [ids[stop:]], [sentences[sentences > stop] - stop]
        self.tokens = len(self.ids[0])
        return pa.RecordBatch.from_arrays(columns, _NAMES + ["ids"] * self.keep_ids)


_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
_known: dict[str, WordIds] = {}


def _pack(path: str, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _known.get(path)
        if words is None:
            words = _known[path] = WordIds(path)
        stream, some = _Stream(keep_ids), False
        for part in wa.slices(batches, "text"):
            stream.add(part.column("doc_id").to_pylist(), *words.encode(part.column("text")))
            some = True
            if stream.tokens > STRETCH:
                yield stream.flush(last=False)
        if some and stream.tokens:
            yield stream.flush(last=True)

    return run


def pack(docs: DataFrame, tokenizer: str, keep_ids: bool = False) -> DataFrame:
    """One row per piece of a document: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``, with
    ``keep_ids`` the ids too, as little-endian unsigned 32-bit numbers.

    Needs ``doc_id`` (long) and ``text``; other columns are ignored.  A null or empty text has the end token alone.
    Rows with a null doc_id and repeated rows are packed like others; each row is a document of its own.  An empty table
    gives no rows.  A task needs memory for some 30 copies of the largest single text.  ``tokenizer`` is the path of a tokenizer file on every machine, one that drops white space.
    """
    kinds = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * keep_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_pack(tokenizer, keep_ids), kinds)
