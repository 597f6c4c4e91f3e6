"""Operator 5, language ID by fusing evidence.

Hypotheses are the labelled languages and ``und``, anything else.  The evidence for each is combined as in Bayes' rule:

* text: log-likelihoods of hashed byte trigrams, one multinomial model a language and a flat one for ``und``, tempered
  because neighbouring trigrams aren't independent;
* declared language: how often texts of each language declare what they do, counted over the whole table;
* address: a prior for each host, smoothed towards that of its address suffix, which is smoothed towards that of all
  rows.  All three come from one grouped sum of text posteriors; a row's own share is taken out of its host's prior.

Texts are scored twice, once for those sums and once where a row's own evidence is fused, so that no text is shuffled or
written in between: hosts and declarations come to the rows.  Only the trigram models are fitted on a sample: about
``LABEL_ROWS`` rows of each label, or all it has, chosen by a hash.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from silverbrook.llm import wordarrays as wa
from silverbrook.llm.storage import attach, cut

LABEL_ROWS, SLOTS, TEMPER = 1000, 1 << 15, 0.2
#: Weights of the suffix's and of the whole table's distribution, as rows.
HOST_PULL, SUFFIX_PULL, DECLARED_PULL = 8.0, 8.0, 4.0
#: Part of the flat model in each language's, so that odd trigrams alone don't make a text unknown.
FLAT = 0.2
UNKNOWN = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[:32] = 32
_TAGS = re.compile(rb"(?is)<script\b.*?(?:</script\s*>|\Z)|<style\b.*?(?:</style\s*>|\Z)|<!--.*?(?:-->|\Z)|<[^<>]*>|&#?\w+;")


#: Trigrams times hypotheses that are scored at once.
BLOCK = 1 << 20


def _slots(data: np.ndarray, offsets: np.ndarray, block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(slot of each trigram that lies in one text and isn't punctuation only, its text), a block of bytes at a time."""
    for a in range(0, len(data) - 2, block):
        d = _FOLD[data[a : a + block + 2]].astype(np.uint32)
        code = (d[:-2] << 16) | (d[1:-1] << 8) | d[2:]
        letter = ((d >= 97) & (d <= 122)) | (d >= 128)
        ok = letter[:-2] | letter[1:-1] | letter[2:]
        ends = offsets[np.searchsorted(offsets, a) : np.searchsorted(offsets, a + len(d), "right")] - a
        for j in (1, 2):
            at = ends - j
            ok[at[(at >= 0) & (at < len(ok))]] = False
        where = np.flatnonzero(ok)
        slot = (code[where] * np.uint32(2654435761)) >> np.uint32(17)
        yield slot.astype(np.int64), np.searchsorted(offsets, where + a, "right") - 1


def _plain(column: pa.Array, markup: bool) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = wa.raw(column)
    if not markup:
        return data, offsets
    memory = data.tobytes()
    parts = [_TAGS.sub(b" ", memory[i:j]) for i, j in zip(offsets[:-1], offsets[1:], strict=True)]
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0] + [len(x) for x in parts])


def _count(languages: list[str]):
    place = {x: i for i, x in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in wa.slices(batches, "text", 1 << 20):
            label = np.array([place[x] for x in part.column("label").to_pylist()], np.int64)
            for slot, text in _slots(*wa.raw(part.column("text"))):
                at, n = np.unique(label[text] * SLOTS + slot, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n)], ["at", "n"])

    return run


class Model:
    """Log-probabilities of the trigram slots for each language, ``und`` last."""

    def __init__(self, languages: list[str], logs: np.ndarray):
        self.languages, self.logs = languages, logs

    @property
    def hypotheses(self) -> list[str]:
        return [*self.languages, UNKNOWN]

    def score(self, column: pa.Array, markup: bool) -> tuple[np.ndarray, np.ndarray]:
        """(tempered log-likelihoods of shape (texts, hypotheses), trigrams of each text)."""
        data, offsets = _plain(column, markup)
        texts, width = len(column), len(self.logs)
        by_slot = np.ascontiguousarray(self.logs.T, np.float64)
        out, n = np.zeros((texts, width)), np.zeros(texts, np.int64)
        for slot, text in _slots(data, offsets, max(1 << 12, BLOCK // width)):
            if len(slot):
                first = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
                out[text[first]] += np.add.reduceat(by_slot[slot], first, axis=0)
                n += np.bincount(text, minlength=texts)
        return out * TEMPER, n


def fit(labelled: DataFrame, rows: int = LABEL_ROWS) -> Model:
    """Fit on about ``rows`` rows of each label of ``labelled`` (id, text, label), or all it has, one at least.  Rows
    without a label or without a trigram are left out; without any other row the model knows ``und`` alone.  Every
    label has its model, of 4 bytes a slot."""
    known = labelled.where("label is not null and octet_length(text) >= 3").where(F.col("text").rlike(r"[A-Za-z]|[^\x00-\x7F]"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], np.full((1, SLOTS), -math.log(SLOTS), np.float32))
    known = known.withColumn("order", F.xxhash64("id", "text"))
    large = {x: math.ceil(rows / n * (1 << 40)) for x, n in counts.items() if n > rows}
    part = F.lit(True)
    if large:
        share = F.create_map(*[F.lit(y) for x in large.items() for y in x])
        part = F.pmod("order", F.lit(1 << 40)) < F.coalesce(F.try_element_at(share, F.col("label")), F.lit(1 << 40))
    count = lambda df: df.select("text", "label").mapInArrow(_count(languages), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    sums = count(known.where(part))
    missed = sorted(large.keys() - {languages[i] for i in np.unique(sums["at"] // SLOTS)})
    if missed:  # a label whose rows repeat a few texts: the hash may choose none
        least = known.where(F.col("label").isin(missed)).groupBy("label").agg(F.min_by("text", "order").alias("text"))
        sums = pd.concat([sums, count(least)])
    total = np.zeros(len(languages) * SLOTS)
    total[sums["at"]] = sums["n"]
    total = total.reshape(len(languages), SLOTS)
    pooled = (total.sum(0) + 0.01) / (total.sum() + 0.01 * SLOTS)
    smooth = total + 200.0 * pooled
    logs = np.log((1 - FLAT) * smooth / smooth.sum(1, keepdims=True) + FLAT / SLOTS)
    return Model(languages, np.vstack([logs, np.full(SLOTS, -math.log(SLOTS))]).astype(np.float32))


def _softmax(logs: np.ndarray) -> np.ndarray:
    raised = np.exp(logs - logs.max(1, keepdims=True))
    return raised / raised.sum(1, keepdims=True)


def _list(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)), pa.array(values.ravel()))


def _matrix(column: pa.Array, width: int, missing: float) -> np.ndarray:
    """The lists of a column as rows; a null is a row of ``missing``."""
    known = column.is_valid().to_numpy(zero_copy_only=False)
    out = np.full((len(column), width), missing)
    out[known] = column.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return out


def _evidence(model, markup: bool):
    """What the texts of each host and declaration say, a row for each of them and slice of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Model = model.value
        for part in wa.slices(batches, "text", 1 << 20):
            score, n = known.score(part.column("text"), markup)
            post = np.where(n[:, None] > 0, _softmax(score), 0.0)  # a text without trigrams says nothing of its host
            names = list(zip(part.column("host_key").to_pylist(), part.column("declared").to_pylist(), strict=True))
            place = {x: i for i, x in enumerate(dict.fromkeys(names))}
            sums = np.zeros((len(place), post.shape[1]))
            np.add.at(sums, [place[x] for x in names], post)
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in place], pa.string()), pa.array([d for _, d in place], pa.string()), _list(sums)], ["host_key", "declared", "c"])

    return run


def _fuse(model, markup: bool, given: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Model = model.value
        names, width = np.array(known.hypotheses, object), len(known.hypotheses)
        for part in wa.slices(batches, "text", 1 << 20):
            score, n = known.score(part.column("text"), markup)
            text_post = _softmax(score)
            own = np.where(n[:, None] > 0, text_post, 0.0)
            others = np.maximum(0.0, _matrix(part.column("c"), width, 0.0) - own)
            host = (others + HOST_PULL * _matrix(part.column("p_suffix"), width, 1 / width)) / (others.sum(1, keepdims=True) + HOST_PULL)
            post = _softmax(score + np.log(host) + np.log(_matrix(part.column("p_said"), width, 1.0)))
            blind = (n == 0) & part.column("declared").is_null().to_numpy(zero_copy_only=False) & part.column("host").is_null().to_numpy(zero_copy_only=False)
            language = np.where(blind, UNKNOWN, names[post.argmax(1)])
            by_text = np.where(n > 0, names[text_post.argmax(1)], UNKNOWN)
            found = [pa.array(language, pa.string()), pa.array(post.max(1)), pa.array(by_text, pa.string()), pa.array(n)]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in given), *found], [*given, *_FOUND])

    return run


_FOUND = {"language": StringType(), "posterior": DoubleType(), "text_language": StringType(), "trigrams": LongType()}


def _suffix(host: Column) -> Column:
    return F.element_at(F.split(host, r"\."), -1)


def _fused(rows: DataFrame, model: Model, markup: bool) -> DataFrame:
    """``rows`` (text, declared, host and others) with ``language, posterior, text_language, trigrams``."""
    width = len(model.hypotheses)
    sent = rows.sparkSession.sparkContext.broadcast(model)  # 128 KB a label
    keyed = rows.withColumn("host_key", F.coalesce("host", F.lit("")))
    kinds = StructType([StructField("host_key", StringType()), StructField("declared", StringType()), StructField("c", ArrayType(DoubleType()))])
    sums = lambda source, out: [F.sum(source(i)).alias(f"{out}{i}") for i in range(width)]
    evidence = keyed.select("host_key", "declared", "text").mapInArrow(_evidence(sent, markup), kinds)
    evidence = cut(evidence.groupBy("host_key", "declared").agg(*sums(lambda i: F.col("c")[i], "c")), "evidence")
    hosts = evidence.groupBy("host_key").agg(*sums(lambda i: f"c{i}", "c")).withColumn("suffix", _suffix(F.col("host_key")))
    suffixes = hosts.groupBy("suffix").agg(*sums(lambda i: f"c{i}", "s"))
    said = evidence.where("declared is not null").groupBy("declared").agg(*sums(lambda i: f"c{i}", "d"))
    all_ = np.array([x or 0.0 for x in evidence.agg(*sums(lambda i: f"c{i}", "c")).first()]) + 0.5
    base = all_ / all_.sum()
    spoken = [float(x or 0.0) for x in said.agg(*sums(lambda i: f"d{i}", "d")).first()]
    total = lambda name: sum((F.col(f"{name}{i}") for i in range(width)), F.lit(0.0))
    # P(declared | language), smoothed towards the declaration's share of all rows
    p_said = F.array(*[(F.col(f"d{i}") + DECLARED_PULL * (total("d") + 1) / (sum(spoken) + 10)) / (spoken[i] + DECLARED_PULL) for i in range(width)])
    p_suffix = F.array(*[(F.col(f"s{i}") + SUFFIX_PULL * float(base[i])) / (total("s") + SUFFIX_PULL) for i in range(width)])
    said = said.select("declared", p_said.alias("p_said"))
    priors = hosts.join(suffixes, "suffix").select("host_key", F.array(*[F.col(f"c{i}") for i in range(width)]).alias("c"), p_suffix.alias("p_suffix"))
    tie = F.xxhash64("text")
    joined = attach(attach(keyed, priors, "host_key", F.octet_length("host_key") + 16 * width, tie), said, "declared", F.octet_length("declared") + 8 * width, tie)
    given = rows.columns
    return joined.select(*given, "c", "p_suffix", "p_said").mapInArrow(_fuse(sent, markup, given), StructType([*rows.schema, *(StructField(c, k) for c, k in _FOUND.items())]))


def _evidence_rows(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"declared": F.lower("declared"), "host": F.lower("host")})


def identify(rows: DataFrame, model: Model, markup: bool = False) -> DataFrame:
    """``id, language, posterior, text_language, declared, host, trigrams`` for ``rows`` (id, text, declared, host; other
    columns are ignored).

    ``declared`` and ``host`` may be null: such a row has no evidence of that kind (null hosts share one prior).  A text
    without a letter, a null and an empty one have no text evidence; with nothing else known the language is ``und``.  Of
    languages with equal posteriors the first in the order of the labels counts, ``und`` last.  ``id`` may be of any type,
    null or repeated; repeated rows are rows like others.  An empty table gives an empty result.  A long text is scored in
    blocks, so a task needs memory for a few copies of its bytes.
    """
    found = _fused(_evidence_rows(rows.select("id", "text", "declared", "host")), model, markup)
    return found.select("id", "language", "posterior", "text_language", "declared", "host", "trigrams")


def document_model(documents: DataFrame) -> Model:
    return fit(documents.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"), F.lower("lang").alias("label")))


def identify_pages(pages: DataFrame, model: Model) -> DataFrame:
    """Language of web pages (page_id, url, html): declared in the html tag, host and suffix from the address."""
    host = F.nullif(F.regexp_extract("url", r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1), F.lit(""))
    lang = F.nullif(F.regexp_extract("html", r"(?i)<html\b[^<>]*?\blang\s*=\s*[\"']?([a-z]{2,8})", 1), F.lit(""))
    rows = pages.select(F.col("page_id").alias("id"), F.col("html").cast("string").alias("text"), lang.alias("declared"), host.alias("host"))
    return identify(rows, model, markup=True).withColumnRenamed("id", "page_id")


def accepted(documents: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents (doc_id, text, lang, source and any others) whose language is known, in ``lang``; other columns stay
    as they are.  Rejected are null and empty texts and those without a letter, texts that the flat model explains best
    and those whose best posterior is below ``threshold``.  Each row is judged by itself: a null or repeated doc_id and
    repeated rows change nothing, and an empty table gives an empty one."""
    others = [c for c in documents.columns if c != "text"]
    rows = documents.select(F.struct(*others).alias("carried"), F.col("text").cast("string").alias("text"), F.col("lang").alias("declared"), F.col("source").alias("host"))
    found = _fused(_evidence_rows(rows), document_model(documents), False)
    good = found.where(f"language <> '{UNKNOWN}' and text_language <> '{UNKNOWN}' and trigrams > 0 and posterior >= {threshold}")
    kind = dict(documents.dtypes)["text"]
    made = {"lang": F.col("language"), "text": F.col("text").cast(kind)}
    return good.select(*[made.get(c, F.col(f"carried.`{c}`")).alias(c) for c in documents.columns])
