"""Operator 7, token counts: trie-shared dynamic programming over a unigram model.

The tokens of a text are the best segmentation of its words into pieces of a public vocabulary, where a piece has a
log-probability and a segmentation the sum of its pieces'.  Distinct words go into a trie.  A node stands for a prefix
and holds its forward score, the best over the pieces that may end there, computed once when the node is made; words
with a common prefix share those nodes.  The node where a word ends has its number of tokens and its score, and texts
are sums over their words.

The vocabulary file has merge ranks, not frequencies, and tokenizers are never trained here: a piece's probability is
taken from its rank by Zipf's law, which is the model's fixed prior.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from silverbrook.llm import wordarrays as wa

#: Shift of the rank in Zipf's law, and the log-probability of one byte of a character that no piece has.
SHIFT, BYTE_SCORE = 2.7, -14.0
#: A word begins with this mark, as in the vocabulary.
MARK = "▁"
#: Nodes and words of a trie before it is begun anew.
MOST_NODES, MOST_WORDS = 1_600_000, 700_000


def zipf_scores(pieces: list[str]) -> dict[str, float]:
    """Log-probabilities of pieces in the order of their ranks."""
    norm = math.log(math.fsum(1 / (r + SHIFT) for r in range(1, len(pieces) + 1))) if pieces else 0.0
    return {p: -math.log(r + SHIFT) - norm for r, p in enumerate(pieces, 1)}


def vocabulary(path: str) -> dict[str, float]:
    """The pieces of a sentencepiece file without control, unknown and byte pieces."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return zipf_scores([model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))])


class Trie(dict):
    """Forward scores of prefixes; as a mapping, the node at which a word ends.  ``count`` and ``score`` of a node are
    those of the best segmentation of its prefix; of segmentations with one score the one with the shortest last piece
    counts."""

    def __init__(self, scores: dict[str, float]):
        super().__init__()
        self.scores = scores
        # the pieces from their ends: (node, code of the character before) in one number, and the piece a node spells
        self.before: dict[int, int] = {}
        self.spells: list[float | None] = [None]
        for piece, value in scores.items():
            node = 0
            for char in reversed(piece):
                name = node << 21 | ord(char)
                node = self.before.get(name, 0)
                if not node:
                    node = self.before[name] = len(self.spells)
                    self.spells.append(None)
            self.spells[node] = value
        self.reset()

    def reset(self) -> None:
        self.clear()
        #: The child of a node by (node, character) in one number.
        self.child: dict[int, int] = {}
        self.score, self.count = array("d", [0.0]), array("q", [0])
        self.add(MARK)

    def add(self, word: str) -> int:
        """The node of a word; what is new of its path is scored."""
        child, node, path, score = self.child, 0, [0], self.score
        depth = 0
        for depth, char in enumerate(word, 1):  # as far as the trie knows it
            found = child.get(node << 21 | ord(char))
            if found is None:
                depth -= 1
                break
            node = found
            path.append(node)
        codes, before, spells = [*map(ord, word)], self.before.get, self.spells
        for depth in range(depth + 1, len(word) + 1):
            char, best, tokens, ending = word[depth - 1], -math.inf, 0, 0
            for begin in range(depth - 1, -1, -1):
                ending = before(ending << 21 | codes[begin])
                if ending is None:  # no piece ends like this
                    break
                piece = spells[ending]
                if piece is not None:
                    total = score[path[begin]] + piece
                    if total > best:
                        best, tokens = total, self.count[path[begin]] + 1
            if char not in self.scores:
                size = len(char.encode("utf-8", "surrogatepass"))
                total = score[node] + BYTE_SCORE * size
                if total > best:
                    best, tokens = total, self.count[node] + size
            child[node << 21 | ord(char)] = node = len(score)
            score.append(best)
            self.count.append(tokens)
            path.append(node)
        return node

    def __missing__(self, raw: bytes) -> int:
        node = self[raw] = self.add(MARK + raw.decode("utf-8", "replace"))
        return node

    def texts(self, memory: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words, tokens, score) of each text."""
        if len(self.score) > MOST_NODES or len(self) > MOST_WORDS:
            self.reset()
        nodes: list[int] = []
        ends, word = [0], self.__getitem__
        for i, j in zip(offsets[:-1], offsets[1:], strict=True):
            nodes.extend(map(word, memory[i:j].split()))
            ends.append(len(nodes))
        at = np.array(nodes, np.int64)
        text = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
        tokens = np.bincount(text, np.array(self.count)[at], len(ends) - 1).astype(np.int64)
        return np.diff(ends), tokens, np.bincount(text, np.array(self.score)[at], len(ends) - 1).astype(np.float64)


_known: dict[str, Trie] = {}


def _run(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _known.get(path)
        if trie is None:
            trie = _known[path] = Trie(vocabulary(path))
        for part in wa.slices(batches, "text", 1 << 20):
            data, offsets = wa.raw(part.column("text"))
            words, tokens, scores = trie.texts(data.tobytes(), offsets)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(words), pa.array(tokens), pa.array(scores)], ["doc_id", "n_words", "n_tokens", "log_score"])

    return run


def count_tokens(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; others are ignored): ``doc_id, n_words, n_tokens, log_score``.

    Words are ``[^\\x20\\x09-\\x0D]+``.  Null and empty texts have 0 of each.  A character that no piece has counts as its
    UTF-8 bytes.  doc_id may be null or repeated; an empty table gives no rows.  A task needs memory for some 20 copies of
    the largest single text, and some 160 bytes a character of its longest word.  ``vocabulary_path`` names the file on
    every machine.
    """
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(_run(vocabulary_path), "doc_id long, n_words long, n_tokens long, log_score double")
