"""Views that let the driver's tables stand in for catalogues, rasters, boxes and logs.

Each has a DataFrame form and the same derivation as a DuckDB common table expression. Values are integers wherever a
sum follows, so results do not depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.runs import JOB_LINE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a time stack: cell, frame, cycle of three days, value in cents."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("cell"), F.col("event_type").alias("frame"), F.floor(F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) / 3.0).cast("long").alias("cycle"),
        F.round(F.col("value") * 100).cast("long").alias("v"), F.col("event_id").alias("id"),
    )


STACK = "stack as (select user_id as cell, event_type as frame, cast(floor(date_diff('day', date '2024-01-01', cast(ts as date)) / 3.0) as bigint) as cycle, cast(round(value * 100) as bigint) as v, event_id as id from events)"


def granules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as observations: a full name by the grammar, its address and its place in the catalogue."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_orderstatus").alias("st"))
    mode = F.expr("element_at(array('7705', '4005', '2005', '0505', '2020'), cast(c % 5 as int) + 1)")
    pol = F.expr("element_at(array('DHNA', 'SHNA', 'QPNA', 'NASV', 'DVNA', 'NADH', 'NANA'), cast(c % 7 as int) + 1)")
    name = F.format_string(
        "NISAR_L2_PR_GCOV_%03d_%03d_%s_%03d_%s_%s_%s_20260906T%06d_20260906T%06d_%s%05d_N_%s_J_%03d",
        F.expr("28 + c % 6"), F.expr("c % 173"), F.expr("if(c % 2 = 0, 'A', 'D')"), F.expr("c % 176"), mode, pol, F.expr("if(c % 11 = 0, 'M', 'N')"),
        F.expr("c % 900000"), F.expr("c % 900000 + 30"), F.expr("if(st = 'P', 'P', 'X')"), F.expr("k div 1000 % 100000"), F.expr("if(k % 13 = 0, 'P', 'F')"), F.expr("k % 1000"),
    )
    # worked out once, as a scanned name would be: conditions on it must not be pushed below and repeat it
    return o.withColumn("name", F.explode(F.array(name))).withColumn("url", F.concat(F.lit("https://data.example/"), "name", F.lit(".h5")))


GRANULES = """granules as (select k, c, st, name, 'https://data.example/' || name || '.h5' as url from (
  select o_orderkey as k, o_custkey as c, o_orderstatus as st,
    printf('NISAR_L2_PR_GCOV_%03d_%03d_%s_%03d_%s_%s_%s_20260906T%06d_20260906T%06d_%s%05d_N_%s_J_%03d', 28 + o_custkey % 6, o_custkey % 173, case when o_custkey % 2 = 0 then 'A' else 'D' end,
      o_custkey % 176, ['7705', '4005', '2005', '0505', '2020'][o_custkey % 5 + 1], ['DHNA', 'SHNA', 'QPNA', 'NASV', 'DVNA', 'NADH', 'NANA'][o_custkey % 7 + 1],
      case when o_custkey % 11 = 0 then 'M' else 'N' end, o_custkey % 900000, o_custkey % 900000 + 30, case when o_orderstatus = 'P' then 'P' else 'X' end, o_orderkey // 1000 % 100000,
      case when o_orderkey % 13 = 0 then 'P' else 'F' end, o_orderkey % 1000) as name from orders))"""

#: parse_name with allow_v, in SQL.
PARSED = r"""parsed as (select *, case when pa in ('SH', 'DH', 'QP') then 'A' when pb in ('SH', 'DH', 'QP') then 'B' when pa in ('SV', 'DV') then 'A' when pb in ('SV', 'DV') then 'B' end as freq from (
  select *, substr(name, 18, 3) as cycle, substr(name, 22, 3) as track, substr(name, 26, 1) as direction, substr(name, 28, 3) as frame,
    cast(substr(name, 32, 2) as integer) as ba, cast(substr(name, 34, 2) as integer) as bb, substr(name, 37, 2) as pa, substr(name, 39, 2) as pb, substr(name, 42, 1) = 'M' as mixed, right(name, 3) as version from granules)),
usable as (select k, c, st, name, url, cycle, track, direction, frame, freq, case when freq = 'A' then ba else bb end as bw, case when freq = 'A' then pa else pb end as pol, mixed, version from parsed where freq is not null)"""


def footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as boxes in whole degrees, some past the antimeridian."""
    o = table(spark, sf_dir, "orders").selectExpr("o_orderkey as k", "o_custkey as c", "cast(o_orderkey * 37 % 360 - 180 as double) as x0", "cast(o_orderkey * 53 % 150 - 75 as double) as y0")
    return o.withColumns({"x1": F.col("x0") + 3 + F.col("k") % 4, "y1": F.col("y0") + 3 + F.col("k") % 3})


FOOTPRINTS = "footprints as (select o_orderkey as k, o_custkey as c, cast(o_orderkey * 37 % 360 - 180 as double) as x0, cast(o_orderkey * 53 % 150 - 75 as double) as y0, cast(o_orderkey * 37 % 360 - 177 + o_orderkey % 4 as double) as x1, cast(o_orderkey * 53 % 150 - 72 + o_orderkey % 3 as double) as y1 from orders)"
#: Boxes split at the antimeridian.
PIECES = """pieces as (select k, c, greatest(x0 + s, -180) as x0, y0, least(x1 + s, 180) as x1, y1 from footprints, (select unnest([0, -360, 360]) as s) where greatest(x0 + s, -180) < least(x1 + s, 180))"""


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as a raster of four tiles of 64 x 64: like and cross in stored decibels, some without data."""
    line = table(spark, sf_dir, "lineitem")
    rows = line.selectExpr(
        "l_suppkey % 4 as tile", "l_orderkey % 64 as row", "l_partkey % 64 as col",
        "if(l_linenumber = 7, -3000, -cast(floor(l_extendedprice) as bigint) % 2900) as lk", "if(l_linenumber >= 6, -3000, -cast(floor(l_extendedprice) as bigint) % 2900 - 20 * cast(l_quantity as bigint)) as cr",
    )
    return rows.groupBy("tile", "row", "col").agg(F.max("lk").alias("like100"), F.max("cr").alias("cross100"))


PIXELS = """pixels as (select l_suppkey % 4 as tile, l_orderkey % 64 as row, l_partkey % 64 as col,
  max(case when l_linenumber = 7 then -3000 else -cast(floor(l_extendedprice) as bigint) % 2900 end) as like100,
  max(case when l_linenumber >= 6 then -3000 else -cast(floor(l_extendedprice) as bigint) % 2900 - 20 * cast(l_quantity as bigint) end) as cross100 from lineitem group by all)"""


def boxes_of_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation as land boxes in whole degrees, named, with the region as continent."""
    return table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey as id", "n_name as name", "n_regionkey as continent", "cast(n_nationkey * 29 % 340 - 180 as double) as u0", "cast(n_nationkey * 17 % 120 - 70 as double) as v0",
        "cast(n_nationkey * 29 % 340 - 180 + 12 + n_nationkey % 7 as double) as u1", "cast(n_nationkey * 17 % 120 - 70 + 10 + n_nationkey % 5 as double) as v1",
    )


NATIONS = "nations as (select n_nationkey as id, n_name as name, n_regionkey as continent, cast(n_nationkey * 29 % 340 - 180 as double) as u0, cast(n_nationkey * 17 % 120 - 70 as double) as v0, cast(n_nationkey * 29 % 340 - 168 + n_nationkey % 7 as double) as u1, cast(n_nationkey * 17 % 120 - 60 + n_nationkey % 5 as double) as v1 from nation)"


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr("s_suppkey as place_id", "s_name as place", "cast(s_suppkey * 97 % 360 - 180 as double) as px", "cast(s_suppkey * 41 % 160 - 80 as double) as py")


PLACES = "places as (select s_suppkey as place_id, s_name as place, cast(s_suppkey * 97 % 360 - 180 as double) as px, cast(s_suppkey * 41 % 160 - 80 as double) as py from supplier)"


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr("c_custkey as pid", "cast(c_custkey * 61 % 3600 as double) / 10 - 180 as x", "cast(c_custkey * 83 % 1600 as double) / 10 - 80 as y")


POINTS = "points as (select c_custkey as pid, cast(c_custkey * 61 % 3600 as double) / 10 - 180 as x, cast(c_custkey * 83 % 1600 as double) / 10 - 80 as y from customer)"


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as the log of one run a weekday: signups are restarts, errors failed jobs, the rest good ones."""
    e = table(spark, sf_dir, "events")
    job = F.format_string("%s %s.%s: %d.0 min %s%s", F.date_format("ts", "MM-dd HH:mm:ss"), F.expr("concat('T', user_id % 40)"), F.expr("if(user_id % 3 = 0, 'BVV', 'AHH')"), F.expr("event_id % 50"), F.expr("if(event_type = 'error', 'FAILED', 'OK')"), F.expr("if(event_id % 9 = 0, ' skipped', '')"))
    start = F.format_string("%s %d tiles (%d jobs)", F.date_format("ts", "MM-dd HH:mm:ss"), F.expr("user_id % 40"), F.expr("event_id % 50"))
    return e.select((F.col("event_id") % 5).alias("run"), F.col("event_id").alias("n"), F.when(F.expr("event_type = 'signup' and event_id % 40 = 1"), start).otherwise(job).alias("line"))


LOG = """log as (select event_id % 5 as run, event_id as n, case when event_type = 'signup' and event_id % 40 = 1 then printf('%s %d tiles (%d jobs)', strftime(ts, '%m-%d %H:%M:%S'), user_id % 40, event_id % 50)
  else printf('%s T%d.%s: %d.0 min %s%s', strftime(ts, '%m-%d %H:%M:%S'), user_id % 40, case when user_id % 3 = 0 then 'BVV' else 'AHH' end, event_id % 50, case when event_type = 'error' then 'FAILED' else 'OK' end,
    case when event_id % 9 = 0 then ' skipped' else '' end) end as line from events)"""
PARSED_LOG = rf"""parsed_log as (select run, n, line, case when regexp_matches(line, '^(\d\d-\d\d \d\d:\d\d:\d\d) \d+ tiles \(') then 'start' when regexp_matches(line, '{JOB_LINE}') then 'job' else 'other' end as kind,
  regexp_extract(line, '{JOB_LINE}', 2) as tile, regexp_extract(line, '{JOB_LINE}', 3) as grp, try_cast(regexp_extract(line, '{JOB_LINE}', 4) as double) as minutes, regexp_extract(line, '{JOB_LINE}', 5) as status from log),
since as (select run, max(n) as since from parsed_log where kind = 'start' group by run),
jobs as (select p.* from parsed_log p left join since using (run) where kind = 'job' and (since is null or n > since))"""


def byte_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr("l_suppkey as file", "l_orderkey * 90000 + l_linenumber * 1000 as offset", "1000 + l_partkey * 7 % 40000 as size")
