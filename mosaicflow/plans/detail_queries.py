"""Resampling, detail levels, blocks and jobs over lineitem, orders and customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import radiometry as D
from ..operators import catalogue as C
from ..operators import detail as T
from . import adapters as A
from .catalogue_queries import PICKS, picks, usable
from .registry import query


def skewed(x, y):  # noqa: ANN001, ANN201
    """A forward formula in integers' reach: a shear."""
    return F.struct((x * 2 + y).alias("x"), (y * 3).alias("y"))


@query(f"with {A.POINTS} select cast(floor(y * 3 / 20) as bigint) as row, cast(floor((x * 2 + y) / 20) as bigint) as col, cast(sum(pid) as double) / count(pid) as mean, count(pid) as n from points group by all")
def resampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.resample(A.points(spark, sf_dir), [], skewed, 20.0, "pid")


@query(f"with {A.NATIONS} select name, cast(floor((u0 * 2 + v0) / 5.0) - 2 as bigint) as c0, cast(ceil((u1 * 2 + v1) / 5.0) + 2 as bigint) as c1, cast(floor(v0 * 3 / 5.0) - 2 as bigint) as r0, cast(ceil(v1 * 3 / 5.0) + 2 as bigint) as r1 from nations")
def edge_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = A.boxes_of_nations(spark, sf_dir).selectExpr("name", "u0 as x0", "v0 as y0", "u1 as x1", "v1 as y1")
    return T.edge_window(b, skewed, 5.0).select("name", "c0", "c1", "r0", "r1")


@query("with g as (select unnest(range(0, 28)) as seq) select seq, case when seq < 5 then 360.0 + (-90 + seq * 45.0) when seq < 14 then 2 * (180 - (seq - 5) * 45.0) + 90 when seq < 19 then -360.0 + (90 - (seq - 14) * 45.0) else 2 * (-180 + (seq - 19) * 45.0) - 90 end::double as x, 3 * case when seq < 5 then -90 + seq * 45.0 when seq < 14 then 90 when seq < 19 then 90 - (seq - 14) * 45.0 else -90 end::double as y from g")
def world_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.map_boundary(spark, skewed, 5, 9)


LOD = f"with {A.PIXELS}, m as (select tile, row, col, case when like100 <> -3000 then like100 end as v, col < 40 as land, row < 30 as detail, case when (row + col) % 7 = 0 then 2 when (row + col) % 7 = 1 then 1 else 0 end as ice from pixels), d as (select *, coalesce(((detail and ice <> 2) or (ice = 1 and land)) and v is not null, false) as det from m)"


@query(f"{LOD}, x as (select 'detail' as source, * from d where det union all select 'rest', * from d where land and v is not null and not det and ice <> 2) select source, tile, count(*) as cells, cast(sum(v) as bigint) as total, min(row) as r0, max(row) + 1 as r1, min(col) as c0, max(col) + 1 as c1 from x group by source, tile")
def detail_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = A.pixels(spark, sf_dir).selectExpr("tile", "row", "col", f"if(like100 <> {D.NO_DATA}, like100, null) as v", "col < 40 as land", "row < 30 as detail", "case when (row + col) % 7 = 0 then 2 when (row + col) % 7 = 1 then 1 else 0 end as ice")
    _, full = T.level_of_detail(p, ["tile"], 1, 64, 64)
    spans = [F.min("row").alias("r0"), (F.max("row") + 1).alias("r1"), F.min("col").alias("c0"), (F.max("col") + 1).alias("c1")]
    return full.groupBy("source", "tile").agg(F.count("*").alias("cells"), F.sum("v").alias("total"), *spans)


@query(f"with {A.PIXELS} select tile, row, col, like100 as v from pixels where like100 <> -3000")
def blocks_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = A.pixels(spark, sf_dir).filter(F.col("like100") != D.NO_DATA).select("tile", "row", "col", F.col("like100").alias("v"))
    return T.from_blocks(T.to_blocks(p, ["tile"], 16), ["tile"], 16)


@query(f"with {A.GRANULES}, {A.PARSED}, g as (select *, array_to_string([track, frame, string_split(name, '_')[9]], '_') as fk, 'T' || (k % 60) as tile from usable), o as (select distinct fk from g where st = 'F'), t as (select distinct tile, fk from g where fk in (select fk from o)) select tile, md5(string_agg(fk, ',' order by fk)) as frames, count(*) as n from t group by tile")
def frames_of_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = usable(spark, sf_dir).withColumn("frame_key", N.frame_key(F.col("name"))).withColumn("tile", F.expr("concat('T', k % 60)"))
    out = T.tile_frames(g, g.filter("st = 'F'"))
    return out.select("tile", F.md5(F.array_join("frames", ",")).alias("frames"), F.size("frames").cast("long").alias("n"))


@query(f"with {A.GRANULES}, {A.PARSED}, {PICKS}, g as (select tile, freq, case when pol in ('SH', 'DH', 'QP') then 'HH' else 'VV' end as term, count(*) as n from picks group by all) select tile || '.' || freq || term as job, n from g where cast(substr(tile, 2) as int) % 3 <> 0")
def jobs_of_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = picks(spark, sf_dir)
    tiles = p.select("tile").distinct().filter("cast(substring(tile, 2) as int) % 3 <> 0")
    return T.jobs_of(tiles, C.job_groups(p)).select("job", F.size("files").cast("long").alias("n"))


@query("with q as (select event_type, quantile_cont(value, 0.99) as t from events group by 1) select event_id, round(value / t * 0.1, 9) as normal from events join q using (event_type)")
def normalised_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = A.table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return T.normalise(e, ["event_type"], "value").select("event_id", F.round("normal", 9).alias("normal"))


@query("select k, cast(trunc(v / 8.0::double) as bigint) as cut, cast(floor(v / 8.0::double) as bigint) as down, cast(round_even(v / 8.0::double, 0) as bigint) as near from (select o_orderkey as k, cast(o_orderkey * 7 % 401 - 200 as double) as v from orders)")
def pixel_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = A.table(spark, sf_dir, "orders").selectExpr("o_orderkey as k", "cast(o_orderkey * 7 % 401 - 200 as double) as v")
    return o.select("k", *[T.pixel_index(F.col("v"), F.lit(8.0), how).alias(n) for how, n in (("cut", "cut"), ("floor", "down"), ("round", "near"))])
