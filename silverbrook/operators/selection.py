"""Exact quantiles by distributed selection: histograms that are refined around the ranks that are asked for."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from silverbrook.plans.pipeline import Operator
from silverbrook.sources.scratch import kept

#: Bins of a histogram, rows that may be ranked one by one, and targets up to which they are broadcast (some 100 bytes each).
BINS, FEW, BROADCAST_TARGETS = 1024, 4096, 100_000


def _near(rows: DataFrame, targets: DataFrame, count: int) -> DataFrame:
    """Each row beside the targets of its group in whose range it lies."""
    return rows.join(F.broadcast(targets) if count <= BROADCAST_TARGETS else targets, "_group").where("_v between low and high")


def exact_quantiles(keys: Sequence[str], column: str, quantiles: Mapping[str, float]) -> Operator:
    """One row a group, with the quantiles of a number column under the given names, interpolated between neighbours as SQL's
    percentile_cont is; without keys one row for all.

    Null and infinite values and NaN are left out; a group without others has nulls.  A round counts the values of each group in ``BINS``
    bins between the bounds of each rank, and takes the bin of the rank, bounded by the least and the largest value in it, for
    the next; counts combine before the shuffle.  When ``FEW`` values are left they are ranked.  So no task holds a group's
    values, however many and whatever they are.  The column is read once a round, some two to four times in all; ranks are written as small tables between rounds."""
    if not quantiles or any(not 0 <= p <= 1 for p in quantiles.values()):
        raise ValueError("quantiles from 0 to 1")

    def run(df: DataFrame) -> DataFrame:
        group = F.struct(*[F.col(f"`{k}`") for k in keys]) if keys else F.struct(F.lit(0).alias("all"))
        value = F.col(f"`{column}`").cast("double")
        named = df.select(F.to_json(group, {"ignoreNullFields": "false"}).alias("_group"), group.alias("_keys"), value.alias("_v"))
        rows = named.where("_v is not null and not isnan(_v) and abs(_v) < double('infinity')").select("_group", "_v")
        sizes = named.groupBy("_group").agg(F.first("_keys").alias("_keys"))
        whole = rows.groupBy("_group").agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high"))
        place = lambda p: F.lit(float(p)) * (F.col("n") - 1)
        ranks = F.array_distinct(F.concat(*[F.array(F.floor(place(p)), F.ceil(place(p))) for p in quantiles.values()]))
        start = {"rank": F.explode(ranks.cast("array<long>")), "before": F.lit(0).cast("long"), "inside": F.col("n")}
        targets = whole.select("_group", *[c.alias(n) for n, c in start.items()], "low", "high")
        done, left = [], kept(targets)
        while True:
            over = (F.col("low") == F.col("high")) | (F.col("inside") <= FEW)
            done.append(left.where(over))
            left = kept(left.where(~over))
            count = left.count()
            if not count:
                break
            half = lambda c: F.col(c) / 2  # noqa: E731  differences of large values stay finite
            bin_ = F.least(F.lit(BINS - 1), F.floor((half("_v") - half("low")) / (half("high") - half("low")) * BINS).cast("int"))
            found = _near(rows, left, count).groupBy("_group", "rank", "before", bin_.alias("bin")).agg(F.count(F.lit(1)).alias("inside"), F.min("_v").alias("low"), F.max("_v").alias("high"))
            upto = F.sum("inside").over(Window.partitionBy("_group", "rank").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)) + F.col("before")
            here = found.withColumn("upto", upto).where((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("inside") <= F.col("rank")))
            left = kept(here.select("_group", "rank", (F.col("upto") - F.col("inside")).alias("before"), "inside", "low", "high"))
        ends = done[0]
        for more in done[1:]:
            ends = ends.unionByName(more)
        plain = ends.where("low = high").select("_group", "rank", F.col("low").alias("v"))
        few = ends.where("low < high")
        order = Window.partitionBy("_group", "rank").orderBy("_v")
        ranked = _near(rows, few, few.count()).withColumn("at", F.row_number().over(order) - 1 + F.col("before")).where("at = rank").select("_group", "rank", F.col("_v").alias("v"))
        values = plain.unionByName(ranked).groupBy("_group").agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("values"))
        at = lambda p, side: F.element_at("values", side(place(p)).cast("long"))
        out = sizes.join(whole.select("_group", "n"), "_group", "left").join(values, "_group", "left")
        part = lambda p: place(p) - F.floor(place(p))
        made = [(at(p, F.floor) + (at(p, F.ceil) - at(p, F.floor)) * part(p)).alias(name) for name, p in quantiles.items()]
        return out.select(*[F.col(f"_keys.`{k}`").alias(k) for k in keys], *made)

    return run

