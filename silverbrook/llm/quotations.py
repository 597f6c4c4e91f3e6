"""Operator 3, chat formatting: quotation linking.

Lines that begin with ``>`` are quotations, as deep as they have such marks.  Neighbouring lines of one depth are a
passage.  Units that can be quoted are the lines, the sentences of passages and whole passages, so that line breaks may
lie elsewhere in a quotation than in its origin.  Every unit is normalised (markers, case, white space at word bounds and
punctuation go) and hashed.  Units that some message says itself are reduced to one origin a hash and conversation and
one a hash, so a line that everyone says costs one row; quoted units join those, and the rows of a line that everyone
quotes are dealt to parts where those aren't few enough to be broadcast.  Short lines link only where there is no doubt: if one
earlier message of their own conversation says them, or else one message in all.
A message replies to the message that holds most of its shallowest linked quotations; links lead backwards only.
Conversations that quote each other form one thread.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from silverbrook.llm import wordarrays as wa
from silverbrook.llm.components import components
from silverbrook.llm.storage import attach, cut, delete, partitions, written
from silverbrook.operators.running import running

#: Letters and digits that a unit must have to be linked where several messages say it; sentences and passages have them at least.
LEAST = 12
# How a line that announces a quotation ends, in some languages of mail.
ATTRIBUTION = r"(?i)(?:^|[\s,>)])(?:wrote|writes|said|says|schrieb|schreibt|sagte|a écrit|écrit|a dit|escribió|ha scritto|schreef)(?:\s[^:]{0,80})?:[\x20\x09]*$"
_SENTENCE = re.compile(r".+?(?:[.!?…]+(?=\s)|[。！？]+|\Z)", re.S)
_OTHER = re.compile(r"[\W_]+")
_LINE = re.compile(r"\r\n|\r|\n")
_MARKS = r"^[\x20\x09]*(?:>[\x20\x09]?)+"
_MARK = re.compile(_MARKS)


def _units_of(text: str, quoted: bool) -> Iterator[tuple[int, int, int, int, str, bool]]:
    """``line_no, last_line, level, kind, hash, short`` of each unit: lines (kind 0), passages of several lines (1) and
    sentences of passages (2).  Only lines may be short."""

    def unit(first: int, last: int, level: int, kind: int, said: str):
        key = _OTHER.sub(" ", said.lower()).strip()
        n = len(key) - key.count(" ")
        if n >= LEAST or n and not kind:
            yield first, last, level, kind, hashlib.sha256(key.encode()).hexdigest(), n < LEAST

    passages: list[tuple[int, list[tuple[int, str]]]] = []
    before = None
    for i, whole in enumerate(_LINE.split(text)):
        mark = _MARK.match(whole)
        level, line = (mark[0].count(">"), whole[mark.end() :].strip()) if mark else (0, whole.strip())
        if not line:
            before = None
            continue
        if level != before:
            passages.append((level, []))
            before = level
        passages[-1][1].append((i, line))
    for level, lines in passages:
        if (level > 0) != quoted:
            continue
        for i, line in lines:
            yield from unit(i, i, level, 0, line)
        joined = " ".join(line for _, line in lines)
        if len(lines) > 1:
            yield from unit(lines[0][0], lines[-1][0], level, 1, joined)
        starts, at = [], 0
        for _, line in lines:
            starts.append(at)
            at += len(line) + 1
        for m in _SENTENCE.finditer(joined):
            if len(m[0]) < len(joined):
                first = m.end() - len(m[0].lstrip())
                yield from unit(lines[bisect_right(starts, first) - 1][0], lines[bisect_right(starts, m.end() - 1) - 1][0], level, 2, m[0])


def _units(quoted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in wa.slices(batches, "text"):
            found = [(i, *u) for i, text in enumerate(part.column("text").to_pylist()) for u in _units_of(text, quoted)]
            columns = list(zip(*found, strict=True)) if found else [()] * 7
            at = pa.array(columns[0], pa.int64())
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.bool_())
            arrays = [part.column(c).take(at) for c in ("conv_id", "turn", "tag")] + [pa.array(c, k) for c, k in zip(columns[1:], kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "turn", "tag", "line_no", "last_line", "level", "kind", "hash", "short"])

    return run


def split_units(messages: DataFrame, quoted: bool) -> DataFrame:
    """``conv_id, turn, tag, line_no, last_line, level, kind, hash, short``: the units of quoted or of other lines."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = messages.select("conv_id", "turn", F.xxhash64("text").alias("tag"), text.alias("text"))
    rows = rows.where(F.contains("text", F.lit(">"))) if quoted else rows
    kind = dict(rows.dtypes)
    return rows.mapInArrow(_units(quoted), f"conv_id {kind['conv_id']}, turn {kind['turn']}, tag long, line_no int, last_line int, level int, kind int, hash string, short boolean")


def unquoted(text: Column) -> Column:
    """A message without its quoted lines, the lines that announce them ("Ann wrote:", right before a quotation or with a blank line
    between) and blank lines at its ends."""
    lines = F.split(F.coalesce(text.cast("string"), F.lit("")), r"\r\n|\r|\n")
    quoted = lambda i: F.coalesce(F.get(lines, i).rlike(_MARKS), F.lit(False))
    blank = lambda i: F.coalesce(F.get(lines, i).rlike(r"^\s*$"), F.lit(False))
    announced = lambda x, i: x.rlike(ATTRIBUTION) & (quoted(i + 1) | blank(i + 1) & quoted(i + 2))
    own = F.array_join(F.filter(lines, lambda x, i: ~x.rlike(_MARKS) & ~announced(x, i)), "\n")
    plain = F.when(F.contains(text.cast("string"), F.lit(">")), own).otherwise(F.coalesce(text.cast("string"), F.lit("")))
    return F.regexp_replace(F.regexp_replace(plain, r"\r\n|\r", "\n"), r"^\s+|\s+$", "")


def link_quotations(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, line_no, level, hash, to_conv, to_turn``: a row per quoted line with a letter or digit, with the message that says it,
    or else its passage, or else a sentence that it is part of: the latest earlier one of the same conversation, else the first in
    the order of (conv_id, turn) if it comes before; null where no message does.  A line of fewer than ``LEAST`` letters and digits needs an
    only earlier one in its conversation, or an only one in all."""
    known = messages.where("conv_id is not null and turn is not null")
    quoted = cut(split_units(known, True).distinct(), "quoted")
    sought = quoted.select("hash").distinct().withColumn("sought", F.lit(True))
    tie, bytes_ = F.xxhash64("conv_id", "turn"), F.lit(80)
    said = attach(split_units(known, False).select("conv_id", "turn", "hash", "short"), sought, "hash", bytes_, tie).where("sought").distinct()
    said = cut(said.select("conv_id", "turn", "hash", "short"), "said")
    # the same conversation: of the turns that say a line, the last before the quoting one
    wanted = quoted.select("conv_id", "turn", "hash").distinct()
    here = said.join(quoted.select("conv_id", "hash").distinct(), ["conv_id", "hash"], "left_semi")
    events = wanted.select("conv_id", "hash", "turn", F.lit(1).alias("asks")).unionByName(here.select("conv_id", "hash", "turn", F.lit(0).alias("asks")))
    before = Window.partitionBy("conv_id", "hash").orderBy("turn", F.desc("asks")).rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.when(F.col("asks") == 0, F.col("turn"))
    near = events.withColumn("near_turn", F.max(earlier).over(before)).withColumn("first_turn", F.min(earlier).over(before)).where("asks = 1").drop("asks")
    place = F.struct("conv_id", "turn")
    far = said.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.max("short").alias("brief")).where("not brief or first = last").select("hash", "first")
    found = attach(quoted.join(near, ["conv_id", "turn", "hash"], "left"), far, "hash", bytes_, tie)
    usable = (F.col("first.conv_id") < F.col("conv_id")) | ((F.col("first.conv_id") == F.col("conv_id")) & (F.col("first.turn") < F.col("turn")))
    own = F.col("near_turn").isNotNull() & (~F.col("short") | (F.col("near_turn") == F.col("first_turn")))
    to_conv = F.when(own, F.col("conv_id")).when(usable, F.col("first.conv_id"))
    to_turn = F.when(own, F.col("near_turn")).when(usable, F.col("first.turn"))
    units = found.withColumn("to", F.when(to_conv.isNotNull(), F.struct("kind", F.col("line_no").alias("from"), to_conv.alias("conv"), to_turn.alias("turn"))))
    # each line of a unit, with its own link before that of its passage, and that before a sentence's
    lines = units.select("conv_id", "turn", "tag", "level", F.when(F.col("kind") == 0, F.col("hash")).alias("hash"), "to", F.explode(F.sequence("line_no", "last_line")).alias("line_no"))
    lines = lines.groupBy("conv_id", "turn", "tag", "line_no").agg(F.max("level").alias("level"), F.max("hash").alias("hash"), F.min("to").alias("to"))
    return lines.where("hash is not null or to is not null").select("conv_id", "turn", "line_no", "level", "hash", F.col("to.conv").alias("to_conv"), F.col("to.turn").alias("to_turn"))


def _depths(parents: DataFrame, most: int = 40) -> DataFrame:
    """``conv_id, turn, depth`` of messages that reply to another: links up to the first that doesn't, found by doubling
    (each round joins what is not settled with what its ancestor knows, so a chain of n takes log2(n) rounds)."""
    now, path = written(parents.select("conv_id", "turn", F.col("to_conv").alias("up_conv"), F.col("to_turn").alias("up_turn"), F.lit(1).cast("long").alias("depth")), "depths")
    for _ in range(most):
        up = now.select(F.col("conv_id").alias("up_conv"), F.col("turn").alias("up_turn"), F.col("up_conv").alias("next_conv"), F.col("up_turn").alias("next_turn"), F.col("depth").alias("more"))
        step = now.join(up, ["up_conv", "up_turn"], "left")
        step = step.select("conv_id", "turn", F.col("next_conv").alias("up_conv"), F.col("next_turn").alias("up_turn"), (F.col("depth") + F.coalesce("more", F.lit(0).cast("long"))).alias("depth"))
        old = path
        now, path = written(step, "depths")
        delete(now.sparkSession, old)
        if now.where("up_conv is not null").isEmpty():
            return now.select("conv_id", "turn", "depth")
    raise RuntimeError("reply links did not settle")


def reply_conversations(messages: DataFrame) -> DataFrame:
    """The messages (conv_id, turn, role, text; other columns are ignored) as threads without quotations.

    One row per message: ``conv_id, turn, role, body, n_quoted, n_linked, parent_conv, parent_turn, depth, thread_id``.
    ``n_quoted`` counts quoted lines with a letter or digit, linked or not.  A thread in reply order is its rows sorted by (thread_id,
    conv_id, turn): a message follows what it replies to.  :func:`write_conversations` writes them so.  Of messages with
    equal votes the last in the order of (conv_id, turn) is the parent.  ``conv_id`` and ``turn`` are of any types that have
    an order.  A null text is empty.  Messages with a null conv_id or turn keep their row but link to nothing; a repeated
    (conv_id, turn) is one message whose rows all get its links.  An empty table gives no rows.  A task needs memory for
    some 20 copies of the largest single text.
    """
    links = cut(link_quotations(messages), "quotations")
    per = links.groupBy("conv_id", "turn").agg(F.countDistinct("line_no").alias("n_quoted"), F.countDistinct(F.when(F.col("to_conv").isNotNull(), F.col("line_no"))).alias("n_linked"))
    votes = links.where("to_conv is not null").groupBy("conv_id", "turn", "level", "to_conv", "to_turn").agg(F.count(F.lit(1)).alias("n"))
    rank = F.struct(-F.col("level"), F.col("n"), F.col("to_conv"), F.col("to_turn"))
    parents = cut(votes.groupBy("conv_id", "turn").agg(F.max_by(F.struct("to_conv", "to_turn"), rank).alias("p")).select("conv_id", "turn", "p.to_conv", "p.to_turn"), "parents")
    depth = _depths(parents)
    threads = components(links.where("to_conv is not null and to_conv <> conv_id").select("conv_id", "to_conv"), "conv_id", "to_conv").withColumnsRenamed({"id": "conv_id", "component": "joined"})
    known = per.join(parents, ["conv_id", "turn"], "left").join(depth, ["conv_id", "turn"], "left")
    base = messages.select("conv_id", "turn", F.col("role").alias("role"), unquoted(F.col("text")).alias("body"))
    out = attach(base.join(known, ["conv_id", "turn"], "left"), threads, "conv_id", F.lit(64), F.xxhash64("turn"))
    zero = F.lit(0).cast("long")
    return out.select(
        "conv_id",
        "turn",
        "role",
        "body",
        F.coalesce("n_quoted", zero).alias("n_quoted"),
        F.coalesce("n_linked", zero).alias("n_linked"),
        F.col("to_conv").alias("parent_conv"),
        F.col("to_turn").alias("parent_turn"),
        F.coalesce("depth", zero).alias("depth"),
        F.coalesce("joined", "conv_id").alias("thread_id"),
    )


def write_conversations(messages: DataFrame, path: str, files: int | None = None) -> None:
    """Write the threads of ``messages`` as Parquet in reply order: each thread stands in one piece, with ``position`` from 1 in
    it, a message after those it may reply to.  Files are ranges of (thread, conversation, turn), so a thread of any length is
    neither gathered nor sorted in one task; it only may begin in one file and end in a later one."""
    rows = reply_conversations(messages)
    placed = rows.transform(running(["thread_id"], ["conv_id", "turn", "role", "body"], number="position"))
    order = ["thread_id", "conv_id", "turn", "position"]
    placed.repartitionByRange(files or partitions(messages.sparkSession), *order).sortWithinPartitions(*order).write.parquet(path)
