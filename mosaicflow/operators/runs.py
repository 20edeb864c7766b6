"""Run logs, byte ranges, counters and incremental rebuilding."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: A job's line and a (re)start's line of a run log.
JOB_LINE = r"^(\d\d-\d\d \d\d:\d\d:\d\d) (?:\[\d+/\d+, \d+ failed\] )?(\S+?)\.([AB][HV][HV]): ([\d.]+) min (OK|FAILED)(.*)"
START_LINE = r"^(\d\d-\d\d \d\d:\d\d:\d\d) \d+ tiles \("


def parse_log(lines: DataFrame, line: str = "line") -> DataFrame:
    """lines with kind (start, job or other), stamp, tile, grp, minutes, status, skipped."""
    c = F.col(line)
    job, start = c.rlike(JOB_LINE), c.rlike(START_LINE)
    part = lambda i: F.when(job, F.regexp_extract(c, JOB_LINE, i))
    return lines.withColumns(
        {
            "kind": F.when(start, "start").when(job, "job").otherwise("other"),
            "stamp": F.when(job, F.regexp_extract(c, JOB_LINE, 1)).when(start, F.regexp_extract(c, START_LINE, 1)),
            "tile": part(2), "grp": part(3), "minutes": part(4).cast("double"), "status": part(5), "skipped": F.contains(part(6), F.lit("skipped")),
        }
    )


def stamp_time(stamp: Column, year: Column) -> Column:
    """Logs have no year; the given one is taken."""
    return F.to_timestamp(F.concat(year.cast("string"), F.lit("-"), stamp), "yyyy-MM-dd HH:mm:ss")


def last_status(parsed: DataFrame, run: str, order: str) -> DataFrame:
    """run, tile, grp, status: each job's last outcome since its run's last (re)start."""
    start = parsed.filter("kind = 'start'").groupBy(run).agg(F.max(order).alias("since"))
    jobs = parsed.filter("kind = 'job'").join(start, run, "left").filter(F.col("since").isNull() | (F.col(order) > F.col("since")))
    return jobs.groupBy(run, "tile", "grp").agg(F.max_by("status", order).alias("status"))


def progress(parsed: DataFrame, run: str, order: str) -> DataFrame:
    """run, done, failed, minutes: over jobs' last outcomes since the last (re)start."""
    start = parsed.filter("kind = 'start'").groupBy(run).agg(F.max(order).alias("since"))
    jobs = parsed.filter("kind = 'job'").join(start, run, "left").filter(F.col("since").isNull() | (F.col(order) > F.col("since")))
    last = jobs.groupBy(run, "tile", "grp").agg(F.max_by(F.struct("status", "minutes"), order).alias("l"))
    return last.groupBy(run).agg(F.count_if(F.col("l.status") == "OK").alias("done"), F.count_if(F.col("l.status") == "FAILED").alias("failed"), F.sum("l.minutes").alias("minutes"))


def remaining(done: DataFrame, run: str, jobs: str, elapsed: str) -> DataFrame:
    """Of runs with jobs done, their number and the minutes since the start: jobs an hour and minutes to go (null before the first)."""
    rate = F.try_divide(F.col("done") * 60.0, F.col(elapsed))
    return done.withColumns({"per_hour": rate, "minutes_left": F.try_divide((F.col(jobs) - F.col("done")) * 60.0, rate)})


def merge_ranges(ranges: DataFrame, key: str, gap: int = 64 * 1024, piece: int = 16 * 1024 * 1024) -> DataFrame:
    """key, start, stop: byte ranges (offset, size) merged in order while gaps are small and the whole stays small.

    A gap wider than any merge allows ends an island for certain, which a running maximum tells. The size rule depends on
    every merge before it, so islands, dealt over all tasks, are streamed in order; what is held is one open range.
    """
    spans = ranges.select(key, F.col("offset").cast("long").alias("a"), (F.col("offset") + F.col("size")).cast("long").alias("b"))
    order = Window.partitionBy(key).orderBy("a", "b")
    far = F.col("a") - F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1)) > gap
    marked = spans.withColumn("far", F.coalesce(far, F.lit(True)).cast("long"))
    islands = marked.withColumn("island", F.sum("far").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    rows = islands.repartition(key, "island").sortWithinPartitions(key, "island", "a", "b").select(key, "island", "a", "b")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list | None = None  # key, island, start, stop
        for batch in batches:
            done = []
            for k, island, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now and (k, island) == (now[0], now[1]) and a - now[3] <= gap and max(b, now[3]) - now[2] <= piece:
                    now[3] = max(now[3], b)
                    continue
                if now:
                    done.append(now)
                now = [k, island, a, b]
            yield out(done, batch.schema.field(0).type)
        if now:
            yield out([now], batch.schema.field(0).type)

    def out(done: list[list], kind: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], kind), pa.array([x[2] for x in done], pa.int64()), pa.array([x[3] for x in done], pa.int64())], names=[key, "start", "stop"])

    return rows.mapInArrow(stream, T.StructType([ranges.schema[key], T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))


def chunks_of_window(windows: DataFrame, chunk: int) -> DataFrame:
    """windows (wid, r0, r1, c0, c1) exploded to the chunks (row0, col0) that they overlap."""
    seq = lambda a, b: F.sequence(F.expr(f"{a} div {chunk} * {chunk}"), F.col(b) - 1, F.lit(chunk))
    return windows.withColumn("row0", F.explode(seq("r0", "r1"))).withColumn("col0", F.explode(seq("c0", "c1")))


def rates(samples: DataFrame, key: str, order: str, counter: str) -> DataFrame:
    """samples with the counter's step since the sample before, the running peak and the running total."""
    w = Window.partitionBy(key).orderBy(order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    step = F.greatest(F.col(counter) - F.lag(counter).over(w), F.lit(0))
    out = samples.withColumn("step", step)
    return out.withColumns({"peak": F.max("step").over(upto), "total": F.sum("step").over(upto)})


def breaks(points: DataFrame, key: str, order: str, x: str, span: float = 180.0) -> DataFrame:
    """points with their step in x; a jump of more than span (the antimeridian) has none."""
    step = F.col(x) - F.lag(x).over(Window.partitionBy(key).orderBy(order))
    return points.withColumn("step", F.when(F.abs(step) <= span, step))


def fingerprint(df: DataFrame, key: str, name: str, setting: str) -> DataFrame:
    """key, fp: a hash of a job's sorted inputs and settings."""
    names = F.array_join(F.array_sort(F.collect_list(name)), "\n")
    settings = F.array_join(F.array_sort(F.collect_set(setting)), "\n")
    return df.groupBy(key).agg(F.sha2(F.concat_ws("\n\n", names, settings), 256).alias("fp"))


def stale(wanted: DataFrame, built: DataFrame, key: str) -> DataFrame:
    """wanted with state: new, changed or same against what is built."""
    b = built.select(F.col(key).alias("key__"), F.col("fp").alias("built__"))
    state = F.when(F.col("built__").isNull(), "new").when(F.col("built__") != F.col("fp"), "changed").otherwise("same")
    return wanted.join(b, F.col(key) == F.col("key__"), "left").withColumn("state", state).drop("key__", "built__")


def best_of(runs: DataFrame, variant: str, seconds: str) -> DataFrame:
    return runs.groupBy(variant).agg(F.min(seconds).alias("best"), F.count("*").alias("runs"))


def first_window(windows: DataFrame, key: str, share: str, order: str, least: float) -> DataFrame:
    """Of each key's probed windows the first with more than `least` valid, else the one with most."""
    rank = F.struct((F.col(share) > least).alias("a"), F.when(F.col(share) > least, -F.col(order).cast("double")).otherwise(F.col(share).cast("double")).alias("b"), (-F.col(order)).alias("c"))
    return windows.groupBy(key).agg(F.max_by(F.struct(order, share), rank).alias("w")).select(key, f"w.{order}", f"w.{share}")
