"""Tables written between rounds, in the folder that all executors share, and ranks over whole tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def stored(df: DataFrame) -> DataFrame:
    """Write df under spark.checkpoint.dir and read it back: cuts the lineage.

    Where it is unset, a session of one process (master local) gets a folder of its own; on a cluster executors would
    write to disks of their own, so there it is an error.
    """
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="mosaicflow-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/round-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """df with each row's place from 1 in an order of the whole table.

    Rows are dealt by ranges of the order and numbered in their partition; only one row a partition is summed over.
    """
    at, part = f"{name}_at", f"{name}_part"
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(rows.withColumns({part: F.spark_partition_id(), at: F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}))
    sizes = rows.groupBy(part).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select(part, before.alias("before"))
    return rows.join(F.broadcast(offsets), part).withColumn(name, F.col("before") + F.col(at) + 1).drop(part, at, "before")
