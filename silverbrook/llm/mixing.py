"""Operator 9, mixing sources to target weights: capped water-filling and seeded repetitions.

The targets of all sources share the words of the corpus by weight.  A source whose share exceeds ``EPOCHS`` times its
own size is clamped there; what it can't take is dealt to the others by weight until none exceeds its cap.  Sorted by
cap over weight, the sources that are clamped come first, so running sums find them without iteration.

A source then takes ``target div size`` whole repetitions of each document, and of one more repetition the part that is
left: its documents in a seeded order up to the target, the last of them in part.  The order's running sums are taken in
two levels, within hash buckets and over the buckets' totals, so that no task needs all of a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from silverbrook.llm.storage import cut

EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = "silverbrook"
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, epochs: int = EPOCHS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, target, clamped`` for the rows ``source, size``; one row per source, and only such rows
    are ever sorted together: one task sorts them all, which is meant for up to some ten million sources."""
    big = "decimal(38,0)"
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = per.withColumn("weight", weight.cast("long")).withColumn("cap", F.lit(epochs) * F.col("source_size"))
    level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    filled = (
        ranked.withColumn("all_size", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("caps_before", F.coalesce(F.sum("cap").over(level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("weights_from", F.sum("weight").over(level.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("clamped", (F.col("all_size") - F.col("caps_before")).cast(big) * F.col("weight") >= F.col("cap").cast(big) * F.col("weights_from"))
    )
    free = Window.partitionBy()
    filled = filled.withColumn("rest", F.col("all_size") - F.sum(F.when(F.col("clamped"), F.col("cap")).otherwise(0)).over(free)).withColumn(
        "free_weight", F.sum(F.when(F.col("clamped"), 0).otherwise(F.col("weight"))).over(free)
    )
    share = F.col("weight").cast("double") * F.try_divide(F.col("rest").cast("double"), F.col("free_weight").cast("double"))
    return filled.select("source", "source_size", F.when(F.col("clamped"), F.col("cap").cast("double")).otherwise(share).alias("target"), "clamped")


def mix(docs: DataFrame, epochs: int = EPOCHS, weights: tuple[int, ...] = WEIGHTS, seed: str = SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, source_size, target, taken``, and the columns ``carry`` as a struct
    ``carried`` if there are any.

    Needs ``doc_id, source, text``; other columns are ignored.  Sizes count words; a null or empty text has none.  Null
    is a source of its own, the last.  The seeded order goes by a hash of doc_id (null: of the text); rows that
    repeat a doc_id stand together in it, by size and then by a hash of their text and carried columns.  A source without words has a
    target of 0; an empty table gives no rows.  Texts are counted one at a time, by built-in functions.
    """
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.coalesce(F.xxhash64("text"), F.lit(0)).cast("string")))).cast("binary"))
    others = [F.col(f"`{c}`") for c in carry]
    tie = F.xxhash64("text", *others)
    sized = docs.select("doc_id", F.col("source").cast("string").alias("source"), words_of(F.col("text")).alias("size"), key.alias("order"), tie.alias("tie"), *([F.struct(*others).alias("carried")] if carry else []))
    # carried columns aren't written once more: the sums come from narrow rows, the counts from docs read again
    sizes = cut(sized.drop("carried"), "sizes")
    rows = sizes.count()
    digits = 1
    while rows > 1000 * 16**digits:
        digits += 1
    named = F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))
    keyed, narrow = ((df.withColumn("name", named).withColumn("bucket", F.substring("order", 1, digits))) for df in (sized if carry else sizes, sizes))
    totals = narrow.groupBy("name", "bucket").agg(F.sum("size").alias("here"))
    before = F.sum("here").over(Window.partitionBy("name").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    targets = source_targets(sizes, epochs, weights).withColumn("name", named).select("name", "source_size", "target")
    places = totals.withColumn("before", F.coalesce(before, F.lit(0))).join(targets, "name").select("name", "bucket", "before", "source_size", "target")
    inner = Window.partitionBy("name", "bucket").orderBy("order", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.join(places, ["name", "bucket"]).withColumn("ahead", F.col("before") + F.coalesce(F.sum("size").over(inner), F.lit(0)))
    goal = F.floor(F.col("target") + 0.5).cast("long")
    whole = F.coalesce(F.floor(F.try_divide(goal, F.col("source_size"))), F.lit(0)).cast("long")
    part = goal - whole * F.col("source_size")
    more = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), part - F.col("ahead")))
    return placed.select("doc_id", "size", "source_size", "target", (whole * F.col("size") + more).cast("long").alias("taken"), *(["carried"] if carry else []))


#: The same result in DuckDB's SQL.
ORACLE = rf"""
WITH sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('{SEED}:' || CAST(doc_id AS VARCHAR)) AS k FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
ranked AS (SELECT *, 1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS weight, 3 * source_size AS cap FROM per),
filled AS (
  SELECT *, sum(source_size) OVER () AS all_size,
    coalesce(sum(cap) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps_before,
    sum(weight) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights_from FROM ranked),
judged AS (SELECT *, (all_size - caps_before) * weight >= cap * weights_from AS clamped FROM filled),
shared AS (
  SELECT *, all_size - sum(CASE WHEN clamped THEN cap ELSE 0 END) OVER () AS rest,
    sum(CASE WHEN clamped THEN 0 ELSE weight END) OVER () AS free_weight FROM judged),
targets AS (
  SELECT source, source_size,
    CASE WHEN clamped THEN CAST(cap AS DOUBLE) ELSE CAST(weight AS DOUBLE) * (CAST(rest AS DOUBLE) / CAST(free_weight AS DOUBLE)) END AS target FROM shared),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS goal,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
parts AS (SELECT *, CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END AS whole FROM placed)
SELECT doc_id, size, source_size, target,
  CAST(whole * size + greatest(0, least(size, goal - whole * source_size - ahead)) AS BIGINT) AS taken FROM parts
"""
