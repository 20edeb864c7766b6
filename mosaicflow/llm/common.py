"""What the operators share: tables, the shared folder, stored intermediate tables."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes that an Arrow batch holds; the kernels cut longer ones again.
BATCH_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, read through Spark."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Bound what one Arrow batch holds by bytes, for whole texts are wide; narrow rows still come 10,000 at once.

    The setting is the session's, for it is read when a plan runs; a smaller one that the user has set stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name, None)
    if not (now and now.isdigit() and 0 < int(now) <= size):
        spark.conf.set(name, str(size))


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors and the driver see: spark.checkpoint.dir.

    Where it is unset, a session of one process (master local) gets a folder of its own; on a cluster that would leave
    each executor's rows on its own disk, so there it is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="mosaicflow-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of df has, whatever their case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


#: Spark's own setting to delete a query's shuffle files when it ends.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage, survives lost executors.

    What was shuffled for it is deleted when it is written, for nothing reads that again.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    with cleaned(spark):
        df.write.parquet(path)
    out = spark.read.schema(T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])).parquet(path)
    out.stored_at = path
    return out


@contextlib.contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """Queries that end in here leave no shuffle files."""
    before = spark.conf.get(CLEAN, None)
    spark.conf.set(CLEAN, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEAN)
        else:
            spark.conf.set(CLEAN, before)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """df with a number for each row as a column of this name, the same whenever and wherever the row is read.

    Rows of a plain file table are numbered by their split and place, which do not change while its DataFrame lives; any
    other plan might give its rows in another order the next time, so its rows are stored first.
    """
    out = df.withColumn(name, F.monotonically_increasing_id())
    plain = df._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation"
    return out if plain else stored(out, "numbered")


def drop_path(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def drop_stored(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for df in tables:
        drop_path(df.sparkSession, df.stored_at)
