"""Statistics, radiometry, rasters, histograms, pyramids and regions over events, lineitem and embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import grids as G
from ..functions import radiometry as D
from ..operators import histogram as H
from ..operators import raster as X
from ..operators import regions as P
from ..operators import stats as S
from ..operators.tables import ranked
from . import adapters as A
from .registry import query

MEANS = "means as (select frame, cell, cycle, cast((2 * sum(v) * 100 + count(*)) // (2 * count(*)) as bigint) as mean, count(*) as k from stack group by all)"


@query(
    f"""with {A.STACK}, {MEANS}, m as (select frame, cell, count(*) as n, cast(sum(mean) as double) as s1, cast(sum(mean * mean) as double) as s2 from means group by all),
  s as (select *, case when n >= 3 then s1 / n end as mean, case when n >= 3 then sqrt(greatest(n * s2 - s1 * s1, 0) / (n * greatest(n - 1, 1))) end as sigma from m)
  select frame, cell, n, mean, sigma, case when mean <> 0 then sigma / mean end as cv from s"""
)
def frame_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.temporal_statistics(A.stack(spark, sf_dir), ["frame", "cell"], "cycle", "v")


@query(f"with {A.STACK} select frame, cast(floor(cell / 8.0) as bigint) as bx, cast(floor(id / 1000.0) as bigint) as by, cast(sum(v) as bigint) as total, count(v) as n from stack where v > 0 group by all")
def block_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = A.stack(spark, sf_dir).filter("v > 0").withColumn("b", F.floor(F.col("id") / 1000.0)).withColumn("c8", F.col("cell"))
    out = s.groupBy("frame", F.floor(F.col("cell") / 8.0).alias("bx"), F.col("b").alias("by")).agg(F.sum("v").alias("total"), F.count("v").alias("n"))
    return out


@query(f"with {A.STACK}, {MEANS}, f as (select frame, cell, max(mean) as m, count(*) as w from means group by all) select cell, cast(sum(m * w) as double) / sum(w) as mean, cast(sum(w) as bigint) as weight from f group by cell")
def weighted_frame_mosaic(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = S.cycle_means(A.stack(spark, sf_dir), ["frame", "cell"], "cycle", "v")
    frames = means.groupBy("frame", "cell").agg(F.max("mean").alias("m"), F.count("*").alias("w"))
    return S.weighted_mean(frames, ["cell"], "m", "w")


@query(f"with {A.STACK} select frame, cell, cast(round_even(cast(sum(v % 1000) as double) / (1000 * count(*)) * 10000, 0) as int) as coh from stack group by all")
def pair_coherence(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = A.stack(spark, sf_dir).groupBy("frame", "cell").agg((F.sum(F.col("v") % 1000).cast("double") / (1000 * F.count("*"))).alias("c"))
    return s.select("frame", "cell", D.encode_coherence(F.col("c")).alias("coh"))


@query(f"with {A.STACK} select frame, cast(sum((v > 10000)::int) as double) / count(*) as valid_frac, sum((v > 10000)::int)::bigint as valid, sum((v > 10000)::int) = 0 as none_valid, sum((v > 10000)::int) * 2 < count(*) as under_half from stack group by frame")
def valid_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = F.count_if(F.col("v") > 10000)
    return A.stack(spark, sf_dir).groupBy("frame").agg((ok.cast("double") / F.count("*")).alias("valid_frac"), ok.alias("valid"), (ok == 0).alias("none_valid"), (ok * 2 < F.count("*")).alias("under_half"))


@query(f"with {A.PIXELS} select tile, min(row) as r0, max(row) + 1 as r1, min(col) as c0, max(col) + 1 as c1 from pixels where like100 > -300 and like100 <> -3000 group by tile")
def data_extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.data_extent(A.pixels(spark, sf_dir), ["tile"], "row", "col", (F.col("like100") > -300) & (F.col("like100") != D.NO_DATA))


DB = "db as (select *, case when like100 <> -3000 then like100 / 100.0::double end as l, case when cross100 <> -3000 then cross100 / 100.0::double end as c from pixels)"


def db_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = A.pixels(spark, sf_dir)
    return p.withColumns({"l": D.to_db(F.col("like100")), "c": D.to_db(F.col("cross100"))})


@query(f"with {A.PIXELS}, {DB} select tile, row, col, l, round(pow(10.0, l / 10), 6) as power, coalesce(cast(round_even(10 * log10(pow(10.0, l / 10)) * 100, 0) as int), -3000) as back from db")
def decibel_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    power = D.db_to_linear(F.col("l"))
    return db_pixels(spark, sf_dir).select("tile", "row", "col", "l", F.round(power, 6).alias("power"), D.from_db(D.linear_to_db(power)).alias("back"))


@query(f"with {A.PIXELS}, {DB}, f as (select *, case when c > -25 then c end as cc from db) select tile, row, col, l - cc as d, round(pow(10.0, (l - cc) / 10), 5) as pwr, case when l is not null and cc is not null then cast(trunc(least(greatest(pow(10.0, (l - cc) / 20) * 1000, 1), 65535)) as int) end as amp from f")
def polarisation_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = db_pixels(spark, sf_dir).withColumn("cc", D.drop_noise(F.col("c"), -25.0))
    return p.select("tile", "row", "col", (F.col("l") - F.col("cc")).alias("d"), F.round(D.power_ratio(F.col("l"), F.col("cc")), 5).alias("pwr"), D.amplitude_ratio(F.col("l"), F.col("cc")).alias("amp"))


SCALED = "case when {0} is null then 0 else cast(round_even(least(greatest({0} * (254 / 38.1::double) + (1 - -31.0::double * (254 / 38.1::double)), 1), 255), 0) as int) end"
DN = f"dn as (select *, {SCALED.format('l')} as a, {SCALED.format('c')} as b from db)"


@query(f"with {A.PIXELS}, {DB}, {DN} select tile, row, col, a, b, case when a <> 0 and b <> 0 then least(greatest(a - b + 127, 1), 255) else 0 end as ratio from dn")
def digital_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = db_pixels(spark, sf_dir)
    return p.select("tile", "row", "col", D.db_to_dn(F.col("l")).alias("a"), D.db_to_dn(F.col("c")).alias("b"), D.dn_ratio(F.col("l"), F.col("c")).alias("ratio"))


@query(f"with {A.PIXELS}, {DB}, {DN} select tile, row, col, case when a <> 0 then a end as r, case when a <> 0 and b <> 0 then b when a <> 0 then a end as g, case when a <> 0 and b <> 0 then a - b + 127 when a <> 0 then a end as bl from dn")
def colour_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = db_pixels(spark, sf_dir).withColumn("s", D.composite(F.col("l"), F.col("c")))
    return p.select("tile", "row", "col", "s.r", "s.g", F.col("s.b").alias("bl"))


@query(f"with {A.PIXELS}, {DB}, {DN}, q as (select tile, quantile_cont(case when b <> 0 then a end, 0.02) as lo0, quantile_cont(case when b <> 0 then a end, 0.98) as hi0, count(case when b <> 0 and a > 0 then 1 end) as n, quantile_cont(a, 0.02) filter (a > 0) as lo1, quantile_cont(a, 0.98) filter (a > 0) as hi1, quantile_cont(a, 0.02) filter (a > 0 and b <> 0) as lo2, quantile_cont(a, 0.98) filter (a > 0 and b <> 0) as hi2 from dn group by tile), l as (select tile, case when n >= 1000 then lo2 else lo1 end as lo, case when n >= 1000 then hi2 else hi1 end as hi from q) select tile, row, col, round(least(greatest(case when hi <= lo then a else (a - lo) / (hi - lo) * 254 + 1 end, 1), 255), 6) as v from dn join l using (tile) where a > 0")
def stretched_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = db_pixels(spark, sf_dir).withColumn("a", D.db_to_dn(F.col("l")).cast("double")).withColumn("colour", D.db_to_dn(F.col("c")) != 0)
    limits = H.sampled_percentiles(p, ["tile"], "a", "colour", 2, 98)
    return p.filter("a > 0").join(limits, "tile").select("tile", "row", "col", F.round(D.clip(D.stretch(F.col("a"), F.col("lo"), F.col("hi")), 1, 255), 6).alias("v"))


@query(f"with {A.PIXELS}, {DB}, {DN} select tile, count(*) as total, sum((a <> 0)::int)::bigint as valid, sum((a <> 0 and b = 0)::int)::bigint as grey from dn group by tile")
def grey_pixel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = D.db_to_dn(F.col("l")), D.db_to_dn(F.col("c"))
    return db_pixels(spark, sf_dir).groupBy("tile").agg(F.count("*").alias("total"), F.count_if(a != 0).alias("valid"), F.count_if((a != 0) & (b == 0)).alias("grey"))


@query(f"with {A.PIXELS}, {DB} select tile, row, col, case when l is null then 0 else cast(trunc(least(greatest((l - -24.0) / (-1.0 - -24.0)::double * 254 + 1, 1), 255)) as int) end as g, case when l is not null then least(greatest((l - -24.0) / 23.0::double, 0), 1) end as u from db")
def quick_look_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return db_pixels(spark, sf_dir).select("tile", "row", "col", D.grey_byte(F.col("like100")).alias("g"), D.unit_grey(F.col("l")).alias("u"))


@query(f"with {A.STACK} select id, case when v % 9 = 0 then -3000 else cast(round_even(least(greatest(v / 10000.0::double, 0), 3) * 10000, 0) as int) end as cv from stack")
def variation_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.stack(spark, sf_dir).select("id", D.encode_variation(F.when(F.col("v") % 9 != 0, F.col("v") / 10000.0)).alias("cv"))


@query("with b as (select l_orderkey % 1000 as k, (l_partkey * 2654435761 + l_suppkey * 40503) % 4294967296 as bits from lineitem) select k, cast(sum(bits & 4294963200) as bigint) as kept, cast(avg(cast((bits & 4095) = 0 as int)) as double) as unused, sum((bits >> 22) & 1)::bigint as top_bit from b group by k")
def mantissa_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = A.table(spark, sf_dir, "lineitem").selectExpr("l_orderkey % 1000 as k", "(l_partkey * 2654435761 + l_suppkey * 40503) % 4294967296 as bits")
    return b.groupBy("k").agg(F.sum(D.keep_bits(F.col("bits"), 11)).alias("kept"), F.avg((F.col("bits").bitwiseAND(F.lit(4095)) == 0).cast("int")).alias("unused"), F.sum(F.shiftright("bits", 22).bitwiseAND(F.lit(1))).alias("top_bit"))


@query("with b as (select distinct o_orderkey % 31744 as h from orders) select h, case when h >> 10 = 0 then (h & 1023) * pow(2.0, -24) else ((h & 1023) / 1024.0::double + 1) * pow(2.0, (h >> 10) - 15) end as v from b")
def half_floats(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = A.table(spark, sf_dir, "orders").selectExpr("o_orderkey % 31744 as h").distinct()
    return b.select("h", D.half_to_float(F.col("h")).alias("v"))


@query(f"with {A.PIXELS} select tile, row // 2 as row, col // 2 as col, cast(sum(v) as double) / count(v) as v, cast(sum(v) as bigint) as v_sum, count(v) as v_n from (select tile, row, col, case when like100 <> -3000 then like100 end as v from pixels where row < 62 and col < 62) group by all")
def block_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = A.pixels(spark, sf_dir).withColumn("v", F.when(F.col("like100") != D.NO_DATA, F.col("like100")))
    return X.block_mean(p, 2, ["tile"], ["v"], 62, 62)


@query(f"with {A.PIXELS} select tile, row // 4 as row, col // 4 as col, like100 as v from pixels where row % 4 = 0 and col % 4 = 0")
def decimated_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.decimate(A.pixels(spark, sf_dir), 4).select("tile", "row", "col", F.col("like100").alias("v"))


@query(f"with {A.PIXELS}, r as (select tile, unnest(range(0, 64)) as row from (select distinct tile from pixels)), g as (select tile, row, unnest(range(0, 64)) as col from r), d as (select g.*, case when like100 <> -3000 then like100 end as v from g left join pixels using (tile, row, col)) select a.tile, a.row, a.col, cast(sum(b.v) as double) / count(b.v) as smooth from d a join d b on a.tile = b.tile and b.row between a.row - 2 and a.row + 2 and b.col between a.col - 2 and a.col + 2 where a.v is not null group by all")
def smoothed(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = A.pixels(spark, sf_dir).select("tile", "row", "col", F.when(F.col("like100") != D.NO_DATA, F.col("like100")).alias("v"))
    grid = p.select("tile").distinct().withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(63).cast("long")))).withColumn("col", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(63).cast("long"))))
    return X.smooth(grid.join(p, ["tile", "row", "col"], "left"), ["tile"], 5).filter("v is not null").select("tile", "row", "col", "smooth")


@query(f"with {A.PIXELS}, z as (select row, col, like100 as v, tile as z from pixels where like100 <> -3000) select row, col, arg_max(v, z) as v from z group by all")
def painted_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = A.pixels(spark, sf_dir).withColumn("v", F.when(F.col("like100") != D.NO_DATA, F.col("like100")))
    return X.paint_stack(p, [], "tile")


@query(f"with {A.PIXELS}, o as (select tile, row + 3 as row, col - 2 as col, cross100 as other from pixels) select tile, row, col, like100, other from pixels left join o using (tile, row, col)")
def aligned_rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = A.pixels(spark, sf_dir)
    return X.align(p.select("tile", "row", "col", "like100"), p.withColumnRenamed("cross100", "other"), ["tile"], 3, -2, "other")


@query(f"with {A.PIXELS} select tile, row - 8 as row, col - 8 as col, like100 from pixels where row between 8 and 55 and col between 8 and 55")
def cropped_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.crop(A.pixels(spark, sf_dir).select("tile", "row", "col", "like100"), 8, 56, 8, 56)


@query(f"with {A.PIXELS}, w as (select row, col, -like100 as p, least(least(row, 63 - row), 8) as w from pixels where like100 <> -3000) select row, col, sum(p * (cast(w as double) / 8)) / sum(cast(w as double) / 8) as p, count(*) as inputs from w where w > 0 group by all")
def feathered_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = A.pixels(spark, sf_dir).select("row", "col", F.when(F.col("like100") != D.NO_DATA, -F.col("like100")).alias("p"), F.least("row", 63 - F.col("row")).alias("edge"))
    return X.feather_blend(p, [], "p", "edge", 8)


TILES = "tiles as (select o_orderkey % 64 as x, o_orderkey * 3 % 32 as y, count(*) as area from orders group by all), levels as (select z, x >> (6 - z) as x, y >> (6 - z) as y, cast(sum(area) as bigint) as area, count(*) as tiles from tiles, (select unnest([3, 4, 5, 6]) as z) group by all)"


def quad_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = A.table(spark, sf_dir, "orders").selectExpr("o_orderkey % 64 as x", "o_orderkey * 3 % 32 as y").groupBy("x", "y").agg(F.count("*").alias("area"))
    return X.pyramid(t, 6, 3)


@query(f"with {TILES} select * from levels")
def pyramid_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quad_tiles(spark, sf_dir)


@query(f"with {TILES} select z, cast(sum(area) as bigint) as area from levels where y >= 1 << (z - 3) group by z")
def area_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quad_tiles(spark, sf_dir).filter("y >= shiftleft(1, z - 3)").groupBy("z").agg(F.sum("area").alias("area"))


@query(f"with {TILES} select z, x, y, case when z = 6 then area end as area, tiles from levels")
def stripped_pyramid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.strip_coarse(quad_tiles(spark, sf_dir))


@query("with c as (select l_suppkey as t, l_orderkey % 5 <> 0 as data, (l_suppkey % 3 = 0 or (l_suppkey % 3 = 1 and l_partkey % 2 = 0)) as land from lineitem) select t, case when bool_or(data and land) and bool_or(data and not land) then 'split' when bool_or(data and not land) then 'sea' when bool_or(data and land) then 'land' else 'empty' end as kind from c group by t")
def ocean_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = A.table(spark, sf_dir, "lineitem").selectExpr("l_suppkey as t", "l_orderkey % 5 <> 0 as data", "(l_suppkey % 3 = 0 or (l_suppkey % 3 = 1 and l_partkey % 2 = 0)) as land")
    return X.ocean_kind(c, ["t"])


@query(f"with {A.PIXELS}, m as (select tile, least(greatest(cast(floor((like100 + 3000) / 10.0) as int), 0), 399) as bin from pixels where like100 <> -3000), g as (select 'global' as region, bin from m union all select 'tile ' || tile, bin from m) select region, bin, count(*) * 4 as area from g group by all")
def area_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histograms(spark, sf_dir)


def histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = A.pixels(spark, sf_dir).filter(F.col("like100") != D.NO_DATA).withColumn("region", F.explode(F.array(F.lit("global"), F.concat(F.lit("tile "), F.col("tile"))))).withColumn("area", F.lit(4).cast("long"))
    return H.histogram(p, ["region"], "like100", "area")


@query(
    f"""with {A.PIXELS}, m as (select tile, least(greatest(cast(floor((like100 + 3000) / 10.0) as int), 0), 399) as bin from pixels where like100 <> -3000), g as (select 'global' as region, bin from m union all select 'tile ' || tile, bin from m),
  h as (select region, bin, count(*) * 4 as area from g group by all), c as (select region, bin, cast(sum(area) over (partition by region order by bin) as double) / sum(area) over (partition by region) as share, (-3000 + (bin + 1) * 10) / 100.0::double as edge from h),
  p as (select *, lag(share) over (partition by region order by bin) as before from c), q as (select unnest([5, 25, 50, 75, 95]) as q),
  r as (select region, q, share, edge, before, row_number() over (partition by region, q order by bin) as rn from p, q where share >= q / 100.0::double)
  select region, q, case when before is null then edge else (edge - 0.1::double) + (q / 100.0::double - before) / (share - before) * (edge - (edge - 0.1::double)) end as db from r where rn = 1"""
)
def backscatter_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.percentiles(histograms(spark, sf_dir), ["region"], [5, 25, 50, 75, 95])


@query(f"with {A.PIXELS} select tile, sum((col < 40)::int)::bigint as land, sum((col < 40 and like100 = -3000)::int)::bigint as gap, round(100.0 * sum((col < 40 and like100 = -3000)::int) / sum((col < 40)::int), 6) as pct, row_number() over (order by sum((col < 40 and like100 = -3000)::int) desc, tile desc) as rank from pixels group by tile")
def land_gaps_by_tile(spark: SparkSession, sf_dir: str) -> DataFrame:
    land, gap = F.col("col") < 40, F.col("like100") == D.NO_DATA
    g = A.pixels(spark, sf_dir).groupBy("tile").agg(F.count_if(land).alias("land"), F.count_if(land & gap).alias("gap"))
    return ranked(g.withColumn("pct", F.round(F.lit(100.0) * F.col("gap") / F.col("land"), 6)), "rank", F.desc("gap"), F.desc("tile"))


@query(f"with {A.PIXELS} select case when row < 20 then 'south' when row < 44 then 'middle' else 'north' end as zone, count(*) as cells, sum((like100 = -3000)::int)::bigint as gaps from pixels group by rollup (zone)")
def coverage_by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = A.pixels(spark, sf_dir).withColumn("zone", F.when(F.col("row") < 20, "south").when(F.col("row") < 44, "middle").otherwise("north"))
    return p.rollup("zone").agg(F.count("*").alias("cells"), F.count_if(F.col("like100") == D.NO_DATA).alias("gaps"))


def region_sql(eight: bool) -> str:
    near = "abs(a.row - b.row) <= 1 and abs(a.col - b.col) <= 1" if eight else "abs(a.row - b.row) + abs(a.col - b.col) = 1"
    return f"""with recursive {A.PIXELS}, c as (select tile, row, col, row * 4294967296 + col as id from pixels where like100 < -2450 and like100 <> -3000),
  e as (select a.tile, a.id as a, b.id as b from c a join c b on a.tile = b.tile and a.id <> b.id and {near}),
  w as (select tile, id as node, id as seen from c union select w.tile, w.node, e.b from w join e on e.tile = w.tile and e.a = w.seen)
  select cast(tile as varchar) as tile, region, count(*) as cells, cast(count(*) as double) as area, min(row) as r0, max(row) as r1, min(col) as c0, max(col) as c1 from (select tile, node, min(seen) as region from w group by all) m join (select tile as t, row, col, id from c) x on x.t = m.tile and x.id = m.node group by all having count(*) >= 2"""


def dark_regions(spark: SparkSession, sf_dir: str, eight: bool) -> DataFrame:
    cells = A.pixels(spark, sf_dir).filter((F.col("like100") < -2450) & (F.col("like100") != D.NO_DATA))
    return P.region_summary(P.regions(cells, "tile", eight, block=16), "tile", least=2)


@query(region_sql(True))
def regions_by_corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dark_regions(spark, sf_dir, True)


@query(region_sql(False))
def regions_by_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dark_regions(spark, sf_dir, False)


@query(f"with {A.PIXELS}, c as (select tile, row, col from pixels where like100 < -1500), s as (select unnest([-1, 0, 1]) as d), n as (select distinct tile, row + a.d as row, col + b.d as col from c, s a, s b), k as (select tile, row, col from n where (select count(*) from n m where m.tile = n.tile and abs(m.row - n.row) <= 1 and abs(m.col - n.col) <= 1) = 9) select tile, row, col from k")
def closed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.close(A.pixels(spark, sf_dir).filter("like100 < -1500"), ["tile"])


@query("with b as (select vec_id, [cast(floor(x * 100) as bigint) for x in embedding] as q from embeddings) select vec_id, cast(list_sum(q[1:8]) as bigint) as first_row, cast(list_max(q) as bigint) as top, cast(list_sum(list_filter(q, lambda x, i: (i - 1) % 8 < 2 and i - 1 < 16)) as bigint) as corner from b")
def array_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products are in the vectors' own precision; sums leave out nulls, and of nothing are null."""
    q = F.transform("embedding", lambda x: F.floor(x * F.lit(100).cast("float")))
    total = lambda a: F.aggregate(a, F.lit(None).cast("long"), lambda s, x: F.coalesce(s + x, s, x))
    b = A.table(spark, sf_dir, "embeddings").select("vec_id", q.alias("q"))
    return b.select("vec_id", total(F.slice("q", 1, 8)).alias("first_row"), F.array_max("q").alias("top"), total(F.filter("q", lambda x, i: (i % 8 < 2) & (i < 16))).alias("corner"))


@query("with c as (select distinct o_orderkey % 160 - 80 as lat from orders) select lat, round(pow(0.25 * 111.32, 2) * cos(radians(lat)), 6) as km2, round(least(10 / (111.32 * greatest(cos(radians(lat)), 0.02)), 30), 6) as margin from c")
def cell_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = A.table(spark, sf_dir, "orders").selectExpr("o_orderkey % 160 - 80 as lat").distinct()
    return c.select("lat", F.round(G.cell_area_deg(F.col("lat"), 0.25), 6).alias("km2"), F.round(G.lon_margin(F.col("lat"), 10.0), 6).alias("margin"))
