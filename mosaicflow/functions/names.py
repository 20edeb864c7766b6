"""Columns parsed out of observation names, and path templates; expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The two grammars of observation names, polarisation modes and their cross terms.
SINGLE = r"^NISAR_L2_PR_GCOV_(\d{3})_(\d{3})_([AD])_(\d{3})_(\d{2})(\d{2})_([A-Z]{2})([A-Z]{2})_([A-Z])_.*_(\d{3})$"
PAIR = r"^NISAR_L2_PR_GUNW_(\d{3})_(\d{3})_([AD])_(\d{3})_(\d{3})_(\d{2})(\d{2})_([A-Z]{2})_.*_([PX]\d{5})_[A-Z]_([FP])_[A-Z]_(\d{3})$"
H_MODES, V_MODES = ("SH", "DH", "QP"), ("SV", "DV")
CROSS_TERM = {"DH": "HV", "DV": "VH", "QP": "HV"}
FIRST_CYCLE, FIRST_DAY, CYCLE_DAYS = 30, "2026-09-06", 12


def is_pair(name: Column) -> Column:
    return F.contains(name, F.lit("_GUNW_"))


def parse_name(df: DataFrame, name: str = "name", allow_v: bool = False) -> DataFrame:
    """df with cycle, track, direction, frame, freq, bw, pol, mixed, version; names of neither grammar or without a
    usable channel go. The H channel comes first (A before B), then with allow_v the V channel; pairs use channel A.
    """
    n = F.col(name)
    h, v = list(H_MODES), list(V_MODES)
    # the pattern is matched once; what it fixes stands at fixed tokens, so the parts come from one split. Exploding one
    # array keeps the optimizer from working the name and its tokens out again for every condition on them
    tokens = F.when(n.rlike(SINGLE) | n.rlike(PAIR), F.split(n, "_"))
    out = df.withColumn("t__", F.explode(F.array(tokens))).filter("t__ is not null").withColumn("pair__", F.get("t__", F.lit(3)) == "GUNW")
    t = lambda i: F.get("t__", F.lit(i))
    pair = F.col("pair__")
    a, b = F.substring(t(9), 1, 2), F.substring(t(9), 3, 2)
    usable = t(10).isin(h + (v if allow_v else []))
    channel = F.when(pair, F.when(usable, "A")).when(a.isin(h), "A").when(b.isin(h), "B")
    if allow_v:
        channel = channel.when(a.isin(v), "A").when(b.isin(v), "B")
    out = out.withColumn("freq", channel).filter("freq is not null")
    in_a = F.col("freq") == "A"
    return out.withColumns(
        {
            "cycle": t(4), "track": t(5), "direction": t(6), "frame": t(7),
            "bw": F.when(pair, F.substring(t(9), 1, 2)).when(in_a, F.substring(t(8), 1, 2)).otherwise(F.substring(t(8), 3, 2)).cast("int"),
            "pol": F.when(pair, t(10)).when(in_a, a).otherwise(b),
            "mixed": ~pair & (t(10) == "M"),
            "version": F.element_at("t__", -1),
        }
    ).drop("t__", "pair__")


def token(name: Column, i: int) -> Column:
    """The i-th token between underscores, null where there are fewer."""
    return F.get(F.split(name, "_"), F.lit(i))


def scene_key(name: Column) -> Column:
    """What names of one acquisition have in common, whatever their processing version."""
    return F.when(is_pair(name), F.substring_index(name, "_", 15)).otherwise(F.substring_index(name, "_", 13))


def version_rank(name: Column) -> Column:
    """struct(production, release, counter): production before experimental, then release number, then counter text."""
    crid = F.regexp_extract(name, r"_([PX]\d{5})(_|$)", 1)
    release = F.when(crid == "", 0).otherwise(F.try_to_number(F.substring(crid, 2, 5), F.lit("99999")).cast("int"))
    return F.struct((F.substring(crid, 1, 1) == "P").alias("production"), release.alias("release"), F.substring_index(name, "_", -1).alias("counter"))


def frame_key(name: Column) -> Column:
    """track_frame_mode; of a pair the mode stands one token later, behind the second cycle."""
    mode = F.when(is_pair(name), token(name, 9)).otherwise(token(name, 8))
    return F.concat_ws("_", token(name, 5), token(name, 7), mode)


def is_partial(name: Column) -> Column:
    """Partial frames carry P as token 15; False where the token is missing."""
    return F.coalesce(token(name, 15) == "P", F.lit(False))


def term(pol: Column, cross: bool = False) -> Column:
    """HH or VV by the mode's basis; with cross HV or VH."""
    h = pol.isin(list(H_MODES))
    return F.when(h, "HV" if cross else "HH").otherwise("VH" if cross else "VV")


def has_cross_term(pol: Column) -> Column:
    return pol.isin(list(CROSS_TERM))


def cycle_start(cycle: Column) -> Column:
    """First day of a 12-day cycle."""
    return F.date_add(F.lit(FIRST_DAY).cast("date"), ((cycle - FIRST_CYCLE) * CYCLE_DAYS).cast("int"))


def search_window(cycle: Column) -> tuple[Column, Column]:
    """From three days before a cycle, eighteen days."""
    return F.date_sub(cycle_start(cycle), 3), F.date_add(cycle_start(cycle), 15)


def cycle_of(day: Column) -> Column:
    return (F.lit(FIRST_CYCLE) + F.floor(F.datediff(day, F.lit(FIRST_DAY).cast("date")) / CYCLE_DAYS)).cast("int")


def resolve_path(spec: str, name: Column, url: Column, https: str = "https://", bucket: str = "") -> Column:
    """Where an observation is read from: a range-reading prefix, a bucket key, a template, or a folder."""
    if spec == "vsicurl":
        return F.concat(F.lit("/vsicurl/"), url)
    if spec == "s3":
        key = F.substring(url, len(https) + 1, 100_000)
        return F.when(url.startswith(https), F.concat(F.lit(f"/vsis3/{bucket}/"), key)).otherwise(F.raise_error(F.concat(F.lit("not a known address: "), url)))
    if "{" in spec:
        return F.replace(F.replace(F.lit(spec), F.lit("{name}"), name), F.lit("{url}"), url)
    return F.concat(F.lit(spec.rstrip("/") + "/"), name, F.lit(".h5"))


def stem(path: Column) -> Column:
    return F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")


def group_suffix(path: Column) -> Column:
    """The last part but one between dots: the job group of `<tile>.<group>.yaml`."""
    return F.element_at(F.split(path, r"\."), -2)


def like_name(cross: Column) -> Column:
    """The co-polarised tile's name of a cross-polarised one."""
    return F.replace(F.replace(cross, F.lit(".AHV."), F.lit(".AHH.")), F.lit(".BVH."), F.lit(".BVV."))


def tile_name(lon: Column, lat: Column, height: Column, width: Column) -> Column:
    return F.format_string("%s%02d%s%03d_%dx%d", F.when(lat >= 0, "N").otherwise("S"), F.abs(lat), F.when(lon >= 0, "E").otherwise("W"), F.abs(lon), height, width)


def box_name(i: Column, j: Column) -> Column:
    return F.format_string("X%+03dY%+03d", i, j)


def zoom_range(text: Column, tile_size: int = 256) -> tuple[Column, Column]:
    """Lowest and highest level of `lo-hi`; tiles of 512 pixels hold a level more, so both are one less, lo at least 0."""
    lo, hi = F.split(text, "-")[0].cast("int"), F.element_at(F.split(text, "-"), -1).cast("int")
    return (F.greatest(lo - 1, F.lit(0)), hi - 1) if tile_size == 512 else (lo, hi)


def human_rate(value: Column) -> Column:
    """Bytes a second in the largest unit of 1024 that leaves a whole."""
    units = ("B/s", "KB/s", "MB/s", "GB/s")
    out = F.format_string(f"%7.2f {units[3]}", value / 1024.0**3)
    for k in (2, 1, 0):
        out = F.when(value < 1024.0 ** (k + 1), F.format_string(f"%7.2f {units[k]}", value / 1024.0**k)).otherwise(out)
    return out


#: Messages after which a job is tried again.
RETRYABLE = ("could not open remote input", "CURL error", "Could not resolve host", "HTTP response code", "HTTP error code", "ExpiredToken", "AccessDenied", "InvalidAccessKeyId", "H5Dread() failed")


def is_retryable(message: Column) -> Column:
    out = F.lit(False)
    for m in RETRYABLE:
        out = out | F.contains(message, F.lit(m))
    return F.coalesce(out, F.lit(False))
