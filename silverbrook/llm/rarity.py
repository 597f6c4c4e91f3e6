"""How common word n-grams are, by a count sketch of fixed size.

Operators that name texts by their rarest n-grams need one order of n-grams for the whole corpus.  The order here puts
common n-grams last: a slot of the sketch counts the n-grams whose hashes begin with its number, and slots with more than
the usual count have a class, higher the more there are.  Only the ``SLOTS`` sums reach the driver, however large the
input is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from silverbrook.llm import wordarrays as wa

SLOTS = 1 << 16


def _count(k: int, lower: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for part in wa.slices(batches, "text"):
            words = wa.Words(part.column("text"), lower)
            hashes = words.hashes()
            grams = wa.grams(hashes, k)[wa.inside(words.first, k, len(hashes))]
            total += np.bincount((grams >> np.uint64(48)).astype(np.int64), minlength=SLOTS)
        slot = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(total[slot])], ["slot", "n"])

    return run


def common_classes(docs: DataFrame, k: int, lower: bool = False) -> np.ndarray:
    """A class for each slot: 0 for ordinary ``k``-grams, more the more often those of a slot occur in ``docs.text``."""
    sums = docs.select("text").mapInArrow(_count(k, lower), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(SLOTS)
    total[sums["slot"]] = sums["n"]
    usual = float(np.median(total))
    excess = total / (usual + 8 * np.sqrt(usual) + 16)
    return np.where(excess > 1, 1 + np.log2(np.maximum(excess, 1)), 0).astype(np.uint8)


def ranks(grams: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """A number for each n-gram, the less the rarer; random within a class."""
    return (classes[(grams >> np.uint64(48)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (wa.mix(grams * np.uint64(0x9FB21C651E98DF25)) >> np.uint64(8))
