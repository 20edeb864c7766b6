"""Catalogue, names, paths and job queries over orders and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as N
from ..operators import catalogue as C
from ..operators import runs as R
from ..sources.sinks import resolved_jobs
from . import adapters as A
from .registry import query


def usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.parse_name(A.granules(spark, sf_dir), allow_v=True)


@query(f"with {A.GRANULES}, {A.PARSED} select name, cycle, track, direction, frame, freq, bw, pol, mixed, version from usable")
def parse_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usable(spark, sf_dir).select("name", "cycle", "track", "direction", "frame", "freq", "bw", "pol", "mixed", "version")


BEST = "ranked as (select *, row_number() over (partition by array_to_string(string_split(name, '_')[1:13], '_') order by st = 'P' desc, k // 1000 % 100000 desc, version desc, k) as rn from usable), best as (select * exclude (rn) from ranked where rn = 1)"


@query(f"with {A.GRANULES}, {A.PARSED}, {BEST} select name, k, bw, direction from best")
def best_version_per_scene(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.best_versions(usable(spark, sf_dir), "k").select("name", "k", "bw", "direction")


@query(f"with {A.GRANULES}, {A.PARSED} select direction, mixed, count(*) as n from usable where direction = 'A' and not mixed group by all")
def direction_and_mode_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.filter_direction(usable(spark, sf_dir), "A").filter(~F.col("mixed")).groupBy("direction", "mixed").agg(F.count("*").alias("n"))


@query(f"with {A.GRANULES}, {A.PARSED} select name, pol, case pol when 'DV' then 'VH' else 'HV' end as cross_term from usable where pol in ('DH', 'DV', 'QP')")
def cross_polarised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usable(spark, sf_dir).filter(N.has_cross_term(F.col("pol"))).select("name", "pol", N.term(F.col("pol"), True).alias("cross_term"))


@query(
    f"with {A.GRANULES}, {A.PARSED} select name, case when k % 4 = 0 then 'valid' else 'raw' end as geom from usable where k % 4 <> 0 or (k % 3 <> 0 and k % 10 / 10.0 >= 0.5)"
)
def valid_footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(spark, sf_dir).withColumn("geom", F.lit("raw"))
    valid = rows.filter("k % 4 = 0").selectExpr("name", "if(k % 3 <> 0, 'valid', null) as geom", "k % 10 / 10.0 as valid_frac")
    return C.apply_footprints(rows, valid, 0.5, False).select("name", "geom")


@query(f"with {A.GRANULES}, {A.PARSED} select name, bw from usable where not (bw = 5 and abs(k % 150 - 75) < 60 and (k % 100) / 1000.0 < 0.05)")
def narrow_band_ocean_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.drop_narrow_ocean(usable(spark, sf_dir), F.expr("cast(k % 100 as double)"), F.lit(1000.0), F.expr("k % 150 - 75")).select("name", "bw")


@query(f"with {A.GRANULES} select name, array_to_string([string_split(name, '_')[6], string_split(name, '_')[8], string_split(name, '_')[9]], '_') as frame_key, array_to_string(string_split(name, '_')[1:13], '_') as scene from granules where string_split(name, '_')[16] = 'P'")
def partial_frames_and_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = A.granules(spark, sf_dir).filter(N.is_partial(F.col("name")))
    return g.select("name", N.frame_key(F.col("name")).alias("frame_key"), N.scene_key(F.col("name")).alias("scene"))


@query("select distinct c, cast(date '2026-09-06' + cast((c - 30) * 12 as integer) as varchar) as first_day, cast(date '2026-09-03' + cast((c - 30) * 12 as integer) as varchar) as search_from, cast(date '2026-09-21' + cast((c - 30) * 12 as integer) as varchar) as search_to, cast(30 + floor(date_diff('day', date '2026-09-06', d) / 12.0) as integer) as back from (select 20 + o_orderkey % 40 as c, date '2026-09-06' + cast((o_orderkey % 40 - 10) * 12 + 5 as integer) as d from orders)")
def cycle_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = A.table(spark, sf_dir, "orders").selectExpr("20 + o_orderkey % 40 as c").distinct()
    lo, hi = N.search_window(F.col("c"))
    return o.select("c", N.cycle_start(F.col("c")).cast("string").alias("first_day"), lo.cast("string").alias("search_from"), hi.cast("string").alias("search_to"), N.cycle_of(F.date_add(N.cycle_start(F.col("c")), 5)).alias("back"))


@query(f"with {A.GRANULES} select '/vsicurl/' || url as curl, '/vsis3/bucket/' || name || '.h5' as s3, '/data/' || name || '.h5' as dir, 'm:' || name || '@' || url as tmpl, name as stem from granules")
def observation_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = A.granules(spark, sf_dir)
    name, url = F.col("name"), F.col("url")
    p = lambda spec: N.resolve_path(spec, name, url, "https://data.example/", "bucket")
    return g.select(p("vsicurl").alias("curl"), p("s3").alias("s3"), p("/data").alias("dir"), p("m:{name}@{url}").alias("tmpl"), N.stem(url).alias("stem"))


@query("with f as (select distinct 'T' || user_id || case when user_id % 2 = 0 then '.AHH.' else '.BVV.' end || 'tif' as f from events where event_type = 'view' union select distinct 'T' || user_id || case when user_id % 2 = 0 then '.AHV.' else '.BVH.' end || 'tif' from events where event_type = 'error') select c.f as crossed, l.f as likef, string_split(c.f, '.')[2] as grp from f c join f l on l.f = replace(replace(c.f, '.AHV.', '.AHH.'), '.BVH.', '.BVV.') and c.f <> l.f")
def like_cross_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = A.table(spark, sf_dir, "events")
    like = e.filter("event_type = 'view'").selectExpr("concat('T', user_id, if(user_id % 2 = 0, '.AHH.', '.BVV.'), 'tif') as likef").distinct()
    cross = e.filter("event_type = 'error'").selectExpr("concat('T', user_id, if(user_id % 2 = 0, '.AHV.', '.BVH.'), 'tif') as crossed").distinct()
    return cross.withColumn("likef", N.like_name(F.col("crossed"))).join(like, "likef").select("crossed", "likef", N.group_suffix(F.col("crossed")).alias("grp"))


@query(f"with {A.GRANULES}, {A.PARSED}, t as (select *, case when k % 3 = 0 then 0 when k % 3 = 1 then 1 else 2 end as fill from usable) select fill, bw, count(*) as n, dense_rank() over (order by fill, bw desc) as tier from t group by fill, bw")
def fill_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql.window import Window

    u = usable(spark, sf_dir)
    rows = C.union_catalogues(*[u.filter(f"k % 3 = {i}") for i in range(3)])
    return rows.groupBy("fill", "bw").agg(F.count("*").alias("n")).withColumn("tier", F.dense_rank().over(Window.orderBy("fill", F.desc("bw"))).cast("long"))


@query(f"with {A.GRANULES}, {A.PARSED}, keep as (select 'T' || (k % 50) as tile, k as seq, name, -1 as bw from granules where k % 5 = 0) select tile, seq, name, case when u.name is null then keep.bw else u.bw end as bw, case when u.name is null then 3 when u.k % 10 = 0 then 1 else 2 end as source from keep left join usable u using (name)")
def forced_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = usable(spark, sf_dir)
    keep = A.granules(spark, sf_dir).filter("k % 5 = 0").selectExpr("concat('T', k % 50) as tile", "k as seq", "name", "-1 as bw")
    candidates = u.filter("k % 10 = 0").selectExpr("concat('T', k % 50) as tile", "name", "bw")
    return C.forced_picks(keep, candidates, u.select("name", "bw"), ["bw"])


PICKS = "picks as (select 'T' || (k % 60) as tile, k as seq, name, freq, pol, bw, st from usable)"


def picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usable(spark, sf_dir).selectExpr("concat('T', k % 60) as tile", "k as seq", "name", "freq", "pol", "bw")


@query(f"with {A.GRANULES}, {A.PARSED}, {PICKS} select tile, freq, case when pol in ('SH', 'DH', 'QP') then 'HH' else 'VV' end as term, cast(count(*) as bigint) as n, md5(string_agg(name || '.h5', ',' order by seq)) as files from picks group by all")
def job_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.job_groups(picks(spark, sf_dir)).select("tile", "freq", "term", F.size("files").cast("long").alias("n"), F.md5(F.array_join("files", ",")).alias("files"))


@query(f"with {A.GRANULES}, {A.PARSED}, {PICKS} select tile, freq, case when pol in ('SH', 'DH', 'QP') then 'HH' else 'VV' end as term, md5(string_agg('/vsicurl/' || case when st <> 'O' then 'https://data.example/' || name || '.h5' else '' end, ',' order by seq)) as paths from picks group by all")
def job_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all picks; those whose order is open are not in the catalogue any more and have no address."""
    urls = A.granules(spark, sf_dir).filter("st <> 'O'")
    out = resolved_jobs(C.job_groups(picks(spark, sf_dir)), urls, "vsicurl")
    return out.select("tile", "freq", "term", F.md5(F.array_join("paths", ",")).alias("paths"))


@query(f"with {A.GRANULES}, {A.PARSED}, {PICKS} select tile, count(*) as work, row_number() over (order by count(*) desc, tile) as rank from picks group by tile")
def longest_jobs_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.longest_first(picks(spark, sf_dir).groupBy("tile").agg(F.count("*").alias("n")), F.col("n"), "tile").select("tile", "work", F.col("rank").cast("long").alias("rank"))


@query(f"with {A.GRANULES}, {A.PARSED}, {PICKS} select tile, sum(case when bw = 5 then 1 else 0 end)::bigint as bw5, sum(case when bw = 20 then 1 else 0 end)::bigint as bw20, sum(case when bw = 40 then 1 else 0 end)::bigint as bw40, sum(case when bw = 77 then 1 else 0 end)::bigint as bw77, count(distinct name) as used, sum(case when bw >= 40 then 1 else 0 end)::bigint as wide from picks group by tile")
def picks_by_bandwidth(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = picks(spark, sf_dir).groupBy("tile", "bw").agg(F.count("*").alias("n"), F.countDistinct("name").alias("u"))
    out = per.groupBy("tile").agg(F.map_from_entries(F.collect_list(F.struct("bw", "n"))).alias("m"), F.sum("u").alias("used"), F.coalesce(F.sum(F.when(F.col("bw") >= 40, F.col("n"))), F.lit(0)).alias("wide"))
    get = lambda b: F.coalesce(F.try_element_at("m", F.lit(b)), F.lit(0)).alias(f"bw{b}")
    return out.select("tile", get(5), get(20), get(40), get(77), "used", "wide")


@query(f"with {A.GRANULES}, {A.PARSED}, f as (select distinct array_to_string([track, frame, string_split(name, '_')[9]], '_') as fk, direction as d from usable where st = 'P'), g as (select *, array_to_string([track, frame, string_split(name, '_')[9]], '_') as fk from usable) select g.fk as frame_key, direction, cycle, count(*) as n, md5(string_agg(name, ',' order by name)) as names from g join f on g.fk = f.fk and direction = d group by all")
def frame_stacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = usable(spark, sf_dir).withColumn("frame_key", N.frame_key(F.col("name")))
    return C.stack_frames(g.filter("st = 'P'"), g).withColumn("names", F.md5(F.array_join("names", ",")))


@query(f"with {A.GRANULES} select name, case when k % 3 = 0 then 'valid' when k % 2 = 0 then 'main' else 'fill' end as geom from granules where k % 3 = 0 or k % 2 = 0 or k % 5 = 0")
def geometry_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = A.granules(spark, sf_dir)
    layer = lambda cond, v: g.filter(cond).select("name", F.lit(v).alias("geom"))
    first = C.first_by_priority([layer("k % 2 = 0", "main"), layer("k % 5 = 0", "fill")], "name", "geom")
    return C.by_priority([first, layer("k % 3 = 0", "valid")], "name", "geom")


@query(f"with {A.GRANULES}, {A.PARSED}, p as (select *, case when direction <> 'A' then 1 when mixed then 2 when bw = 5 and k % 3 = 0 then 3 else 0 end as r from usable) select count(*) as loaded, sum((r = 1)::int)::bigint as direction, sum((r = 2)::int)::bigint as mixed_mode, sum((r = 3)::int)::bigint as ocean, sum((r = 0)::int)::bigint as usable from p")
def drop_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.drop_counts(usable(spark, sf_dir), {"direction": F.col("direction") != "A", "mixed_mode": F.col("mixed"), "ocean": F.expr("bw = 5 and k % 3 = 0")})


@query(f"with {A.LOG}, e as (select run, n, line, row_number() over (partition by run order by n desc) as rn from log where regexp_matches(lower(line), 'error|fail|denied|http')) select run, n, line from e where rn <= 3")
def last_error_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = A.log_lines(spark, sf_dir).filter(F.lower("line").rlike("error|fail|denied|http"))
    return C.last_per_group(bad, ["run"], [F.desc("n")], 3)


@query("select event_id, case event_id % 4 when 0 then true when 1 then false when 2 then true else false end as again from events")
def retryable_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = A.table(spark, sf_dir, "events")
    message = F.expr("concat('job ', event_id, element_at(array(': CURL error 7', ': no such tile', ': x H5Dread() failed', ': done'), cast(event_id % 4 as int) + 1))")
    return e.select("event_id", N.is_retryable(message).alias("again"))


@query(f"with {A.GRANULES} select name from granules where name not in (select name from granules where st = 'F')")
def resume_todo(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = A.granules(spark, sf_dir)
    return g.select("name").join(g.filter("st = 'F'").select("name"), "name", "left_anti")


@query(f"with {A.GRANULES}, {A.PARSED}, {PICKS} select tile, case when cast(substr(tile, 2) as int) % 5 = 0 then 'new' when max((seq % 400 = 0)::int) = 1 then 'changed' else 'same' end as state from picks group by tile")
def stale_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = picks(spark, sf_dir).withColumn("setting", F.lit("useMask: true"))
    built = p.filter("seq % 400 <> 0 and cast(substring(tile, 2) as int) % 5 <> 0")
    return R.stale(R.fingerprint(p, "tile", "name", "setting"), R.fingerprint(built, "tile", "name", "setting"), "tile").select("tile", "state")


@query(f"with {A.LOG}, {A.PARSED_LOG} select run, kind, count(*) as n, coalesce(sum(minutes), 0.0) as minutes, sum((status = 'FAILED')::int)::bigint as failed from parsed_log group by run, kind")
def run_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = R.parse_log(A.log_lines(spark, sf_dir))
    return p.groupBy("run", "kind").agg(F.count("*").alias("n"), F.coalesce(F.sum("minutes"), F.lit(0.0)).alias("minutes"), F.count_if(F.col("status") == "FAILED").alias("failed"))


@query(f"with {A.LOG}, {A.PARSED_LOG} select run, tile, grp, arg_max(status, n) as status from jobs group by all")
def job_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.last_status(R.parse_log(A.log_lines(spark, sf_dir)), "run", "n")


@query(f"with {A.LOG}, {A.PARSED_LOG}, l as (select run, tile, grp, arg_max(status, n) as status, arg_max(minutes, n) as minutes from jobs group by all) select run, sum((status = 'OK')::int)::bigint as done, sum((status = 'FAILED')::int)::bigint as failed, sum(minutes) as minutes from l group by run")
def run_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.progress(R.parse_log(A.log_lines(spark, sf_dir)), "run", "n")


@query(f"with {A.LOG} select run, n, strptime('2024-' || substr(line, 1, 14), '%Y-%m-%d %H:%M:%S') as at from log")
def log_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.log_lines(spark, sf_dir).select("run", "n", R.stamp_time(F.substring("line", 1, 14), F.lit(2024)).alias("at"))


@query("select event_id, case when v < 1024 then printf('%7.2f B/s', v) when v < 1048576 then printf('%7.2f KB/s', v / 1024) when v < 1073741824 then printf('%7.2f MB/s', v / 1048576) else printf('%7.2f GB/s', v / 1073741824) end as rate from (select event_id, cast(event_id * event_id * 37 + 11.3 as double) as v from events)")
def human_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.table(spark, sf_dir, "events").select("event_id", N.human_rate(F.expr("cast(event_id * event_id * 37 + 11.3 as double)")).alias("rate"))


@query("select page_id, regexp_extract(html, '<title>(.*?)</title>', 1) as title, regexp_replace(html, '<title>.*?</title>', '<title>New &amp; best</title>') = html as same, len(regexp_extract_all(html, '<a href=')) as n_links from pages")
def document_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.kml import element, retitle

    p = A.table(spark, sf_dir, "pages")
    return p.select("page_id", element(F.col("html"), "title").alias("title"), (retitle(F.col("html"), "New & best", "title") == F.col("html")).alias("same"), F.regexp_count("html", F.lit("<a href=")).cast("long").alias("n_links"))


@query("select o_orderkey as k, greatest(lo - 1, 0) as lo, hi - 1 as hi from (select o_orderkey, cast(o_orderkey % 3 as int) as lo, cast(o_orderkey % 3 + 4 as int) as hi from orders)")
def zoom_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = A.table(spark, sf_dir, "orders").selectExpr("o_orderkey as k", "concat(o_orderkey % 3, '-', o_orderkey % 3 + 4) as z")
    lo, hi = N.zoom_range(F.col("z"), 512)
    return o.select("k", lo.alias("lo"), hi.alias("hi"))


@query("select event_type as variant, min(value) as best, count(*) as runs from events group by 1")
def best_of_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.best_of(A.table(spark, sf_dir, "events").withColumnRenamed("event_type", "variant"), "variant", "value")


@query("with s as (select user_id as dev, event_id as n, cast(round(value * 100) as bigint) as c from events), d as (select *, greatest(c - lag(c) over (partition by dev order by n), 0) as step from s) select dev, n, step, max(step) over (partition by dev order by n rows unbounded preceding) as peak, cast(sum(step) over (partition by dev order by n rows unbounded preceding) as bigint) as total from d")
def counter_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = A.table(spark, sf_dir, "events").select(F.col("user_id").alias("dev"), F.col("event_id").alias("n"), F.round(F.col("value") * 100).cast("long").alias("c"))
    return R.rates(s, "dev", "n", "c").drop("c")


@query("with p as (select user_id as line, event_id as n, cast(event_id * 71 % 360 - 180 as double) as x from events), d as (select *, x - lag(x) over (partition by line order by n) as step from p) select line, n, case when abs(step) <= 180 then step end as step from d")
def track_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = A.table(spark, sf_dir, "events").selectExpr("user_id as line", "event_id as n", "cast(event_id * 71 % 360 - 180 as double) as x")
    return R.breaks(p, "line", "n", "x").drop("x")


@query("with w as (select o_custkey as key, o_orderkey as n, (o_orderkey * 7 % 100) / 100.0 as share from orders), r as (select *, row_number() over (partition by key order by share > 0.5 desc, case when share > 0.5 then n end, share desc, n) as rn from w) select key, n, cast(share as double) as share from r where rn = 1")
def probe_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = A.table(spark, sf_dir, "orders").selectExpr("o_custkey as key", "o_orderkey as n", "cast((o_orderkey * 7 % 100) / 100.0 as double) as share")
    return R.first_window(w, "key", "share", "n", 0.5)


MERGED = """with recursive r as (select l_suppkey as file, l_orderkey * 90000 + l_linenumber * 1000 as a, l_orderkey * 90000 + l_linenumber * 1000 + 1000 + l_partkey * 7 % 40000 as b from lineitem),
s as (select file, a, b, row_number() over (partition by file order by a, b) as n from r),
m as (select file, n, a as start, b as stop, false as opened, a as s0, b as e0 from s where n = 1
  union all select s.file, s.n, case when s.a - m.stop <= 65536 and s.b - m.start <= 16777216 then m.start else s.a end, case when s.a - m.stop <= 65536 and s.b - m.start <= 16777216 then greatest(m.stop, s.b) else s.b end, true, 0, 0 from m join s on s.file = m.file and s.n = m.n + 1)
select file, start, max(stop) as stop from m group by file, start"""


@query(MERGED)
def merged_byte_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.merge_ranges(A.byte_ranges(spark, sf_dir), "file")


@query("with w as (select o_orderkey as wid, o_orderkey % 3000 as r0, o_orderkey % 3000 + 1 + o_orderkey % 900 as r1, o_orderkey * 3 % 3000 as c0, o_orderkey * 3 % 3000 + 1 + o_orderkey % 700 as c1 from orders) select row0, col0, count(*) as windows from (select wid, unnest(range(r0 // 512 * 512, r1, 512)) as row0, c0, c1 from w) t, unnest(range(c0 // 512 * 512, c1, 512)) as u(col0) group by all")
def chunks_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = A.table(spark, sf_dir, "orders").selectExpr("o_orderkey as wid", "o_orderkey % 3000 as r0", "o_orderkey % 3000 + 1 + o_orderkey % 900 as r1", "o_orderkey * 3 % 3000 as c0", "o_orderkey * 3 % 3000 + 1 + o_orderkey % 700 as c1")
    return R.chunks_of_window(w, 512).groupBy("row0", "col0").agg(F.count("*").alias("windows"))


@query(f"with {A.GRANULES}, {A.PARSED}, {PICKS} select count(distinct name) as granules, count(distinct tile) as tiles, count(*) as picks from picks")
def granules_used(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many different granules and tiles the picks have."""
    return picks(spark, sf_dir).agg(F.countDistinct("name").alias("granules"), F.countDistinct("tile").alias("tiles"), F.count("*").alias("picks"))


@query(f"with {A.GRANULES}, {A.PARSED}, {PICKS} select distinct tile from picks")
def distinct_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return picks(spark, sf_dir).select("tile").distinct()


@query(f"with {A.GRANULES}, {A.PARSED}, {PICKS}, n as (select tile, count(*) as n from picks group by tile) select tile, n, 60.0::double * n / (n + 30) as per_hour, (100 - n) * 60.0::double / (60.0::double * n / (n + 30)) as minutes_left from n")
def jobs_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate and time to go of runs that have n jobs done, n + 30 minutes gone and 100 jobs in all."""
    from ..operators import runs as R

    n = picks(spark, sf_dir).groupBy("tile").agg(F.count("*").alias("n")).withColumns({"done": F.col("n"), "jobs": F.lit(100), "minutes": F.col("n") + 30})
    return R.remaining(n, "tile", "jobs", "minutes").select("tile", "n", "per_hour", "minutes_left")
