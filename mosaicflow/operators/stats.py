"""Temporal statistics in two levels: sums a cycle, then moments over cycles.

Sums are of integers, quantised where a mean is taken, so results do not depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cycle means are kept in so many parts of a unit.
PARTS = 100


def cycle_means(df: DataFrame, keys: list[str], cycle: str, value: str) -> DataFrame:
    """keys, cycle, mean (an integer, PARTS to a unit): all observations of one cycle, partial frames too, weigh alike."""
    sums = df.groupBy(*keys, cycle).agg(F.sum(value).alias("s__"), F.count(value).alias("n__")).filter("n__ > 0")
    mean = F.expr(f"(2 * s__ * {PARTS} + n__ - pmod(2 * s__ * {PARTS} + n__, 2 * n__)) div (2 * n__)")
    return sums.select(*keys, cycle, mean.alias("mean"))


def moments(cycles: DataFrame, keys: list[str], min_count: int) -> DataFrame:
    """keys, n, mean, sigma, cv over cycles, which weigh alike; statistics are null under min_count cycles.

    sigma has n - 1 in it, 1 at least, and no negative variance; one cycle alone has sigma 0.
    """
    agg = cycles.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("mean").cast("double").alias("s1"), F.sum(F.col("mean") * F.col("mean")).cast("double").alias("s2"))
    enough = F.col("n") >= min_count
    mean = F.col("s1") / F.col("n")
    sigma = F.sqrt(F.greatest(F.col("n") * F.col("s2") - F.col("s1") * F.col("s1"), F.lit(0.0)) / (F.col("n") * F.greatest(F.col("n") - 1, F.lit(1))))
    out = agg.withColumns({"mean": F.when(enough, mean), "sigma": F.when(enough, sigma)})
    return out.withColumn("cv", F.when(F.col("mean") != 0, F.col("sigma") / F.col("mean"))).select(*keys, "n", "mean", "sigma", "cv")


def temporal_statistics(df: DataFrame, keys: list[str], cycle: str, value: str, min_count: int = 3) -> DataFrame:
    """One scan, two shuffles: the second is on a prefix of the first's keys and far smaller."""
    return moments(cycle_means(df, keys, cycle, value), keys, min_count)


def weighted_mean(df: DataFrame, keys: list[str], value: str, weight: str) -> DataFrame:
    """Overlapping frames meet weighted by their number of cycles."""
    return df.filter(F.col(value).isNotNull() & (F.col(weight) > 0)).groupBy(*keys).agg((F.sum(F.col(value) * F.col(weight)) / F.sum(weight)).alias("mean"), F.sum(weight).alias("weight"))


def data_extent(df: DataFrame, keys: list[str], row: str, col: str, valid: Column) -> DataFrame:
    """The smallest rectangle of rows and columns that has all valid cells."""
    on = lambda f, c: f(F.when(valid, F.col(c)))
    return df.groupBy(*keys).agg(on(F.min, row).alias("r0"), (on(F.max, row) + 1).alias("r1"), on(F.min, col).alias("c0"), (on(F.max, col) + 1).alias("c1")).filter("r0 is not null")
