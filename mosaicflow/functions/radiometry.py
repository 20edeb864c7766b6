"""Backscatter arithmetic on columns. No data is NULL here; sentinels are turned at scans and sinks.

Rounding is to even (`bround`) where values are rounded, and towards zero where they are cut.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Stored decibels are 100 times, with a sentinel; byte range of stretched decibels.
SCALE, NO_DATA = 100.0, -3000
MIN_DB, MAX_DB, MIN_DN, MAX_DN = -31.0, 7.1, 1, 255


def to_db(stored: Column) -> Column:
    return F.when(stored != NO_DATA, stored / SCALE)


def from_db(db: Column) -> Column:
    return F.coalesce(F.bround(db * SCALE).cast("int"), F.lit(NO_DATA))


def linear_to_db(power: Column) -> Column:
    return F.when(power > 0, 10 * F.log10(power))


def db_to_linear(db: Column) -> Column:
    return F.pow(F.lit(10.0), db / 10)


def clip(v: Column, lo: float, hi: float) -> Column:
    return F.when(v.isNotNull(), F.least(F.greatest(v, F.lit(lo)), F.lit(hi)))


def drop_noise(cross: Column, floor_db: float | None) -> Column:
    """Null at or under the noise floor."""
    return cross if floor_db is None else F.when(cross > floor_db, cross)


def amplitude_ratio(like: Column, cross: Column) -> Column:
    """1000 times the amplitude ratio, cut to 1..65535."""
    return clip(F.pow(F.lit(10.0), (like - cross) / 20) * 1000, 1, 65535).cast("int")


def power_ratio(like: Column, cross: Column) -> Column:
    return F.pow(F.lit(10.0), (like - cross) / 10)


def db_to_dn(db: Column, lo: float = MIN_DB, hi: float = MAX_DB) -> Column:
    """1..255 over lo..hi, clamped; 0 where there is no data."""
    scale = (MAX_DN - MIN_DN) / (hi - lo)
    raw = db * scale + (MIN_DN - lo * scale)
    return F.coalesce(F.bround(clip(raw, MIN_DN, MAX_DN)).cast("int"), F.lit(0))


def dn_ratio(like: Column, cross: Column) -> Column:
    """Difference of the clamped DNs about 127; 0 unless both are there. Validity comes before the clip."""
    a, b = db_to_dn(like), db_to_dn(cross)
    return F.when((a != 0) & (b != 0), F.least(F.greatest(a - b + 127, F.lit(1)), F.lit(255))).otherwise(0)


def composite(like: Column, cross: Column, base: Column | None = None) -> Column:
    """struct(r, g, b) of DNs: like, cross, ratio; grey from like, else base, where there is no cross; null without any."""
    a, c = db_to_dn(like), db_to_dn(cross)
    grey = a if base is None else F.when(a != 0, a).otherwise(db_to_dn(base))
    both = (a != 0) & (c != 0)
    return F.when(both, F.struct(a.alias("r"), c.alias("g"), (a - c + 127).alias("b"))).when(grey != 0, F.struct(grey.alias("r"), grey.alias("g"), grey.alias("b")))


def stretch(v: Column, lo: Column, hi: Column, least: float = 1, most: float = 255) -> Column:
    """Linear onto least..most; as it is where hi <= lo."""
    return F.when(hi <= lo, v).otherwise((v - lo) / (hi - lo) * (most - least) + least)


def grey_byte(stored: Column, lo_db: float = -24.0, hi_db: float = -1.0) -> Column:
    """1..255, cut towards zero; 0 for no data."""
    v = (to_db(stored) - lo_db) / (hi_db - lo_db) * 254 + 1
    return F.coalesce(clip(v, 1, 255).cast("int"), F.lit(0))


def unit_grey(db: Column, lo: float = -24.0, hi: float = -1.0) -> Column:
    return clip((db - lo) / (hi - lo), 0, 1)


def encode_variation(cv: Column) -> Column:
    """10000 times the coefficient of variation clipped to 0..3, as a small integer with the sentinel."""
    return F.coalesce(F.bround(clip(cv, 0, 3) * 10000).cast("int"), F.lit(NO_DATA))


def encode_coherence(c: Column) -> Column:
    return F.coalesce(F.bround(c * 10000).cast("int"), F.lit(NO_DATA))


def keep_bits(bits: Column, mantissa: int, width: int = 23) -> Column:
    """Of a 32-bit float's pattern (as a non-negative long) the sign, the exponent and the top mantissa bits."""
    return bits.bitwiseAND(F.lit(0xFFFFFFFF ^ ((1 << (width - mantissa)) - 1)))


def half_to_float(bits: Column) -> Column:
    """Value of an IEEE half's pattern (0..65535)."""
    sign = F.when(F.shiftright(bits, 15) == 1, -1.0).otherwise(1.0)
    e, m = F.shiftright(bits, 10).bitwiseAND(F.lit(31)), bits.bitwiseAND(F.lit(1023))
    special = F.when(m == 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    return sign * F.when(e == 31, special).when(e == 0, m * (2.0**-24)).otherwise((m / 1024.0 + 1.0) * F.pow(F.lit(2.0), e - 15))


def saved_share(plain: Column, packed: Column) -> tuple[Column, Column]:
    """What a packed layer takes of its plain size, and the share that is saved; null where there was nothing."""
    ratio = F.try_divide(packed.cast("double"), plain.cast("double"))
    return ratio, 1 - ratio
