"""Structured Streaming forms of what a mosaic run watches: stacks per cycle, logs, counters, results, rebuilding."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import runs as R


def cycle_windows(stream: DataFrame, time: str, keys: list[str], value: str, days: int = 12, start: str = "2 days", late: str = "12 days") -> DataFrame:
    """window, keys, total, n: tumbling cycles of observations; partial frames and late ones of a cycle meet in its window."""
    return stream.withWatermark(time, late).groupBy(F.window(time, f"{days} days", startTime=start), *keys).agg(F.sum(value).alias("total"), F.count(value).alias("n"))


#: Buckets of an upsert sink's table; a batch rewrites only those that its keys fall into.
UPSERT_BUCKETS = 64


def versions(spark, path: str) -> dict[int, dict[int, str]]:  # noqa: ANN001
    """bucket -> version -> folder of what an upsert sink has written."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out: dict[int, dict[int, str]] = {}
    for s in (system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v*/bucket=*")) or []) if system.exists(root) else []:
        at = s.getPath()
        out.setdefault(int(at.getName().removeprefix("bucket=")), {})[int(at.getParent().getName()[1:])] = at.toString()
    return out


def upsert_sink(spark_view: str, keys: list[str], path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that keeps the newest row of each key under path, in buckets of the keys' hash.

    Batch n writes folder v<n> with the buckets that its keys fall into: their newest rows before it and its own. A batch
    that comes twice writes the same again; no state is held between batches.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("batch__", F.lit(number)).withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(UPSERT_BUCKETS)).cast("int"))
        touched = [r[0] for r in rows.select("bucket").distinct().collect()]
        before = [max((v, f) for v, f in have.items() if v < number)[1] for b, have in versions(spark, path).items() if b in touched and min(have) < number]
        if before:
            rows = rows.unionByName(spark.read.schema(rows.drop("bucket").schema).parquet(*before).withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(UPSERT_BUCKETS)).cast("int")))
        newest = rows.groupBy("bucket", *keys).agg(F.max_by(F.struct(*rows.columns), "batch__").alias("r")).select("r.*")
        newest.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/v{number}")

    write.view = spark_view
    return write


def latest_version(spark, path: str) -> DataFrame:  # noqa: ANN001
    """The newest rows of all keys: each bucket's last version."""
    return spark.read.parquet(*[have[max(have)] for have in versions(spark, path).values()]).drop("batch__")


def job_states(lines: DataFrame) -> DataFrame:
    """run, tile, grp, status as a log (run, n, line) grows: a restart line forgets what came before it."""
    parsed = R.parse_log(lines).filter("kind <> 'other'").select("run", "n", "kind", "tile", "grp", "status")
    out = "run long, tile string, grp string, status string"

    def follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (jobs,) = state.get if state.exists else ({},)
        rows = pd.concat(list(batches)).sort_values("n")
        for r in rows.itertuples():
            if r.kind == "start":
                jobs = {}
            else:
                jobs[f"{r.tile}\t{r.grp}"] = r.status
        state.update((jobs,))
        pairs = [k.split("\t") for k in jobs]
        yield pd.DataFrame({"run": key[0], "tile": [p[0] for p in pairs], "grp": [p[1] for p in pairs], "status": list(jobs.values())})

    return parsed.groupBy("run").applyInPandasWithState(follow, out, "jobs map<string, string>", "update", GroupStateTimeout.NoTimeout)


def counter_totals(stream: DataFrame, key: str = "device") -> DataFrame:
    """key, steps since the first sample, peak and samples of counters (key, n, counter) as they arrive."""

    def follow(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, total, peak, n = state.get if state.exists else (-1, 0, 0, 0)
        for r in pd.concat(list(batches)).sort_values("n").itertuples():
            step = max(r.counter - last, 0) if last >= 0 else 0
            last, total, peak, n = int(r.counter), total + int(step), max(peak, int(step)), n + 1
        state.update((last, total, peak, n))
        yield pd.DataFrame({key: [k[0]], "total": [total], "peak": [peak], "samples": [n]})

    return stream.groupBy(key).applyInPandasWithState(follow, f"{key} string, total long, peak long, samples long", "last long, total long, peak long, samples long", "update", GroupStateTimeout.NoTimeout)


def on_results(stream: DataFrame, act: Callable[[DataFrame, int], None], checkpoint: str, every: str = "1 minute", once: bool = False) -> StreamingQuery:
    """Act on results as they come in, in batches of processing time; once takes what is there and ends."""
    writer = stream.writeStream.foreachBatch(act).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def rebuild(wanted: DataFrame, built: DataFrame, key: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows of what is new or whose inputs changed, built anew; what is the same is left alone."""
    return build(R.stale(wanted, built, key).filter("state <> 'same'").drop("state"))


def fill_gaps(plan: Callable[[DataFrame | None], DataFrame], gaps: Callable[[DataFrame], DataFrame], rounds: int = 3) -> DataFrame:
    """Plan, report gaps, plan again keeping the picks, until nothing is open or for so many rounds."""
    picks = plan(None)
    for _ in range(rounds):
        open_ = gaps(picks)
        if open_.limit(1).count() == 0:
            break
        picks = picks.unionByName(plan(open_)).distinct()
    return picks
