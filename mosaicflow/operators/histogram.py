"""Area-weighted histograms over stored decibels (100 times dB) and percentiles from their running shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The first bin's lower edge and a bin's width in stored decibels, and the number of bins.
LOW, STEP, BINS = -3000, 10, 400


def histogram(df: DataFrame, keys: list[str], stored: str, area: str) -> DataFrame:
    """keys, bin, area: bins of 0.1 dB by integers, so exact tenths fall in the bin that they open; ends take what is beyond."""
    b = F.least(F.greatest(F.expr(f"floor(({stored} - {LOW}) / {STEP})"), F.lit(0)), F.lit(BINS - 1)).cast("int")
    return df.groupBy(*keys, b.alias("bin")).agg(F.sum(area).alias("area"))


def percentiles(hist: DataFrame, keys: list[str], wanted: list[int]) -> DataFrame:
    """keys, q, db: where the running share of area reaches q percent, linear between bins' right edges.

    Empty bins do not move the share, so only bins with area are looked at; below the first one it is that bin's edge.
    """
    upto = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    edge = (F.lit(LOW) + (F.col("bin") + 1) * STEP) / 100.0
    cdf = hist.withColumn("share", F.sum("area").over(upto) / F.sum("area").over(whole)).withColumn("edge", edge)
    order = Window.partitionBy(*keys).orderBy("bin")
    # an interpolation runs from the bin before, which is the previous one of all bins, empty ones included
    cdf = cdf.withColumn("before", F.lag("share").over(order)).withColumn("from", F.when(F.col("before").isNotNull(), F.col("edge") - STEP / 100.0))
    rows = cdf.withColumn("q", F.explode(F.array(*[F.lit(q) for q in wanted]))).filter(F.col("share") >= F.col("q") / 100.0)
    hit = rows.groupBy(*keys, "q").agg(F.min_by(F.struct("share", "edge", "before", "from"), "bin").alias("h"))
    db = F.when(F.col("h.before").isNull(), F.col("h.edge")).otherwise(F.col("h.from") + (F.col("q") / 100.0 - F.col("h.before")) / (F.col("h.share") - F.col("h.before")) * (F.col("h.edge") - F.col("h.from")))
    return hit.select(*keys, "q", db.alias("db"))


def sampled_percentiles(df: DataFrame, keys: list[str], value: str, preferred: str, lo: float, hi: float, least: int = 1000) -> DataFrame:
    """keys, lo, hi: exact percentiles of preferred rows, of all rows where fewer than `least` are preferred, else 1, 255."""
    on = F.when(F.col(preferred) & (F.col(value) > 0), F.col(value))
    every = F.when(F.col(value) > 0, F.col(value))
    pick = lambda p: F.coalesce(F.when(F.count(on) >= least, F.percentile(on, F.lit(p / 100.0))).otherwise(F.percentile(every, F.lit(p / 100.0))), F.lit(1.0 if p == lo else 255.0))
    return df.groupBy(*keys).agg(pick(lo).alias("lo"), pick(hi).alias("hi"))
