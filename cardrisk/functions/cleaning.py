"""Column expressions that turn dirty transaction text into typed values.

Every cast is a ``try_`` form on purpose: a bad value becomes a sentinel, never an error
and never a lost row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardrisk.schemas import device_schema

# ---- fixed values: sentinels and accepted spellings ------------------------------------
TRUE_WORDS = ("yes", "1", "true")
UNKNOWN = "UNKNOWN"
NO_ERROR = "NONE"
NO_ZIP = "00000"
NO_IP = "0.0.0.0"
NO_DISTANCE = -1.0
INT_SENTINELS = {"user": -1, "card": -1, "year": 2000, "month": 1, "day": 1, "mcc": -1}
EARTH_RADIUS_KM = 6371.0
# ----------------------------------------------------------------------------------------


def _flag(condition: Column) -> Column:
    """1 when true, 0 when false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def _finite(c: Column) -> Column:
    """The number, or 0 where it is missing, infinite or not a number."""
    return F.when(F.abs(c) < float("inf"), c).otherwise(0.0)


def clean_amount(c: Column) -> Column:
    digits = F.translate(F.trim(c), "$,", "")
    return _finite(digits.try_cast("double"))


def clean_label(c: Column) -> Column:
    return _flag(F.lower(F.trim(c)).isin(*TRUE_WORDS))


def int_or(c: Column, default: int) -> Column:
    """Integer text, or decimal text cut to an integer, or the default."""
    return F.coalesce(c.try_cast("int"), c.try_cast("double").try_cast("int"), F.lit(default))


def time_parts(c: Column) -> tuple[Column, Column]:
    pieces = F.split(F.coalesce(c, F.lit("00:00")), ":")
    return int_or(F.get(pieces, F.lit(0)), 0), int_or(F.get(pieces, F.lit(1)), 0)


def imputed_flag(c: Column) -> Column:
    return _flag(blank(c))


def impute_category(c: Column, upper: bool = True) -> Column:
    text = F.trim(c)
    return F.when(blank(c), F.lit(UNKNOWN)).otherwise(F.upper(text) if upper else text)


def clean_zip(c: Column) -> Column:
    whole = F.substring_index(F.trim(c), ".", 1)
    return F.when(blank(c), F.lit(NO_ZIP)).otherwise(F.lpad(whole, 5, "0"))


def error_flag(c: Column) -> Column:
    return _flag(~blank(c))


def error_type(c: Column) -> Column:
    return F.when(blank(c), F.lit(NO_ERROR)).otherwise(F.trim(c))


def parse_device(c: Column) -> Column:
    """One struct parsed once; its fields are picked out by :func:`device_fields`."""
    return F.from_json(c, device_schema())


def device_fields(device: Column) -> dict[str, Column]:
    return {
        "vpn_flag": _flag(device["network"]["vpn"]),
        "device_ip": F.coalesce(device["network"]["ip"], F.lit(NO_IP)),
        "device_os": F.coalesce(device["hardware"]["os"], F.lit(UNKNOWN)),
        "device_lat": device["geo"]["lat"],
        "device_lon": device["geo"]["lon"],
        "geo_missing": _flag(device["geo"].isNull()),
        "hw_missing": _flag(device["hardware"].isNull()),
    }


def amount_features(amount: Column) -> dict[str, Column]:
    size = F.abs(amount)
    return {
        "amount_abs": size,
        "amount_log": F.log1p(size),
        "is_refund": _flag(amount < 0),
    }


def outlier_features(amount: Column, threshold: Column) -> dict[str, Column]:
    """The cap lives beside the amount; the amount itself is never changed."""
    size = F.abs(amount)
    return {
        "is_outlier": _flag(size > threshold),
        "amount_capped": F.least(size, threshold),
    }


def channel_flags(city: Column, state: Column, hour: Column) -> dict[str, Column]:
    return {
        "is_online": _flag(city == "ONLINE"),
        "is_foreign_or_unknown": _flag(F.length(state) != 2),
        "is_night": _flag((hour < 6) | (hour >= 22)),
    }


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance, 2 decimals; -1 when a coordinate is missing."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    # Rounding can push the chord just past 1, where asin is NaN. Not least(): it skips nulls.
    arc = F.asin(F.when(chord > 1, F.lit(1.0)).otherwise(F.sqrt(chord)))
    return F.coalesce(F.round(F.lit(2 * EARTH_RADIUS_KM) * arc, 2), F.lit(NO_DISTANCE))


def assemble_date(year: Column, month: Column, day: Column) -> Column:
    """The real date, else the first of its month, else the first day of 2000.

    Built from numbers: formatting and parsing text costs several times as much.
    """

    def midnight(d: Column) -> Column:
        zero = F.lit(0)
        return F.try_make_timestamp_ntz(year, month, d, zero, zero, zero).cast("date")

    dated = F.coalesce(midnight(day), midnight(F.lit(1)))
    four_digits = year.between(0, 9999)
    return F.coalesce(F.when(four_digits, dated), F.lit("2000-01-01").cast("date"))


def assemble_timestamp(date: Column, hour: Column, minute: Column) -> Column:
    """Null for an hour or minute that no clock shows."""
    return F.try_make_timestamp(
        F.year(date), F.month(date), F.dayofmonth(date), hour, minute, F.lit(0)
    )


def calendar_parts(date: Column) -> dict[str, Column]:
    return {
        "day_of_week": F.dayofweek(date),
        "is_weekend": _flag(F.dayofweek(date).isin(1, 7)),
        "day_of_year": F.dayofyear(date),
    }


def coerce_int(c: Column) -> Column:
    """Typed message field: number text cut to an integer, anything else 0."""
    return F.coalesce(c.try_cast("double").try_cast("int"), F.lit(0))


def coerce_double(c: Column) -> Column:
    return _finite(c.try_cast("double"))


def coerce_text(c: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(UNKNOWN))
