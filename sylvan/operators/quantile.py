"""Exact order statistics per group by range-partitioned rank lookup.

``RankIndex`` holds a frame's ``(group, value)`` pairs once, with their weights
added up (map-side first, so repeated values never travel), range-partitioned by
group and value.  A partition is a run of one or more groups' sorted values; a
group may span many partitions, so no task ever holds more than a partition of
a hot group.  Per partition and group the total weight is kept, with its prefix
over the group's earlier partitions.  The value at any rank of any group is then
an offset lookup: the prefix counts name the partition, and a running sum over
that partition's run finds the row.  The same sums give the weighted total up to
the rank, which is all that deviations from the median need.

There is one path, whatever the size of a group.  Interpolation is linear
between order statistics (numpy's default), with ranks ``h = (N - 1) p`` over
the summed weights.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sylvan.operators.joins import broadcast_if_small, materialize_small
from sylvan.session import cut_lineage


class RankIndex:
    """Rows with a null, NaN or weightless value are left out; a null group is a group of its own."""

    def __init__(self, df: DataFrame, keys: list[str], value: str, weight: str | None = None):
        self.keys = keys
        w = F.col(weight).cast("double") if weight else F.lit(1.0)
        # one non-null surrogate key, so null group values join like any other
        gk = F.to_json(F.struct(*[F.col(k) for k in keys])) if keys else F.lit("all")
        frame = df.select(gk.alias("_g"), *keys, F.col(value).cast("double").alias("_y"), w.alias("_w")).where(
            F.col("_y").isNotNull() & ~F.isnan("_y") & (F.col("_w") > 0))
        pairs = frame.groupBy("_g", *keys, "_y").agg(F.sum("_w").alias("_c"))
        #: group, value, weight and partition; the partition is fixed by writing the rows down
        self.rows = cut_lineage(pairs.repartitionByRange("_g", "_y").withColumn("_p", F.spark_partition_id()))
        mass = F.when(F.col("_y") != 0, F.col("_c") * F.col("_y")).otherwise(F.lit(0.0))
        totals = self.rows.groupBy("_g", *keys, "_p").agg(F.sum("_c").alias("_t"), F.sum(mass).alias("_s"),
                                                          F.min("_y").alias("_lo"), F.max("_y").alias("_hi"))
        group = Window.partitionBy("_g")
        before = group.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
        #: per group and partition: weight, weighted sum, and both before it and of the whole group
        self.parts, self.n_parts = materialize_small(totals.select(
            "_g", *keys, "_p", "_t", F.coalesce(F.sum("_t").over(before), F.lit(0.0)).alias("_before"),
            F.coalesce(F.sum("_s").over(before), F.lit(0.0)).alias("_before_s"),
            F.sum("_t").over(group).alias("_n"), F.sum("_s").over(group).alias("_total"),
            F.min("_lo").over(group).alias("_min"), F.max("_hi").over(group).alias("_max")))

    def _found(self, probs: list[float]) -> DataFrame:
        """One row per group, probability and rank: the value there, and the weight and sum up to it."""
        ranks = []
        for i, p in enumerate(probs):
            h = (F.col("_n") - 1) * F.lit(float(p))
            ranks += [F.struct(F.lit(i).alias("pi"), h.alias("h"), k(h).cast("double").alias("k")) for k in (F.floor, F.ceil)]
        hits = (self.parts.withColumn("_r", F.explode(F.array_distinct(F.array(*ranks))))
                .where((F.col("_r.k") >= F.col("_before")) & (F.col("_r.k") < F.col("_before") + F.col("_t"))))
        # at most two ranks for each probability of a group, and no more groups than parts
        n_hits = 2 * len(probs) * self.n_parts
        wanted = broadcast_if_small(hits.select("_g", "_p").distinct(), n_hits)
        run = Window.partitionBy("_g", "_p").orderBy("_y").rowsBetween(Window.unboundedPreceding, 0)
        mass = F.when(F.col("_y") != 0, F.col("_c") * F.col("_y")).otherwise(F.lit(0.0))
        runs = (self.rows.select("_g", "_p", "_y", "_c").join(wanted, ["_g", "_p"], "left_semi")
                .withColumn("_cum", F.sum("_c").over(run)).withColumn("_cum_s", F.sum(mass).over(run)))
        at = F.col("_r.k") - F.col("_before")
        return (runs.join(broadcast_if_small(hits, n_hits), ["_g", "_p"])
                .where((F.col("_cum") - F.col("_c") <= at) & (at < F.col("_cum")))
                .select("_g", *self.keys, "_r.*", F.col("_y").alias("x"), (F.col("_before") + F.col("_cum")).alias("upto"),
                        (F.col("_before_s") + F.col("_cum_s")).alias("upto_s"), "_n", "_total", "_min", "_max"))

    def _interpolated(self, probs: list[float]) -> DataFrame:
        """One row per group and probability."""
        of_group = ("_n", "_total", "_min", "_max")
        low = lambda c: F.min_by(c, "k").alias(c)
        q = self._found(probs).groupBy("_g", *self.keys, "pi").agg(
            F.min_by("x", "k").alias("x_lo"), F.max_by("x", "k").alias("x_hi"), F.first("h").alias("h"), F.min("k").alias("k_lo"),
            low("upto"), low("upto_s"), *(F.first(c).alias(c) for c in of_group))
        between = F.col("x_lo") + (F.col("h") - F.col("k_lo")) * (F.col("x_hi") - F.col("x_lo"))
        return q.withColumn("q", F.when(F.col("x_lo") == F.col("x_hi"), F.col("x_lo")).otherwise(between))

    def quantiles(self, probs: list[float], count: str | None = None, surrogate: bool = False) -> DataFrame:
        """keys.., q0, q1, ... (one column per probability, in order), the group's weight as ``count``, and the
        never-null surrogate key ``_g`` of ``rows``."""
        out = [F.max(F.when(F.col("pi") == i, F.col("q"))).alias(f"q{i}") for i in range(len(probs))]
        if count:
            out.append(F.first("_n").alias(count))
        found = self._interpolated(probs).groupBy("_g", *self.keys).agg(*out)
        return found if surrogate else found.drop("_g")

    def median_deviation(self) -> DataFrame:
        """keys.., N, median, AD (summed absolute deviations from the median), ymin, ymax."""
        below = F.col("q") * F.col("upto") - F.col("upto_s")
        above = (F.col("_total") - F.col("upto_s")) - F.col("q") * (F.col("_n") - F.col("upto"))
        deviation = F.when(F.col("_min") == F.col("_max"), F.lit(0.0)).otherwise(F.greatest(below + above, F.lit(0.0)))
        return self._interpolated([0.5]).select(
            *self.keys, F.col("_n").cast("long").alias("N"), F.col("q").alias("median"), deviation.alias("AD"), F.col("_min").alias("ymin"),
            F.col("_max").alias("ymax"))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float], weight: str | None = None) -> DataFrame:
    """keys.., q0, q1, ... (one column per probability, in order)."""
    return RankIndex(df, keys, value, weight).quantiles(probs)
