"""Scalar expressions used by the marts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 2)
MONEY_TOTAL = DecimalType(28, 2)
EARTH_RADIUS_KM = 6371.0

# Control characters that cannot occur in source text: field separator and the
# stand-in for null, so that ("a", null) and ("a", "") hash differently.
KEY_SEPARATOR = "\u001f"
KEY_NULL = "\u001e"


def money(col: Column | str) -> Column:
    """Fixed-point amount. Cast each row before summing: doubles do not add up."""
    return F.col(col).cast(MONEY) if isinstance(col, str) else col.cast(MONEY)


def total(col: Column | str) -> Column:
    return F.sum(col).cast(MONEY_TOTAL)


def week_start(ts: Column | str) -> Column:
    """Monday of the week as a date."""
    return F.date_trunc("week", ts).cast("date")


def month_start(ts: Column | str) -> Column:
    return F.date_trunc("month", ts).cast("date")


def ratio(part: Column, whole: Column) -> Column:
    """Part of whole as double; null where the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def stable_key(*cols: str) -> Column:
    """Surrogate key that depends on the values alone, so reruns agree.

    The outer coalesce never applies. It tells the optimizer that the key is not
    null; otherwise joins on it would hash every row once more to filter nulls.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(KEY_NULL)) for c in cols]
    return F.coalesce(F.sha2(F.concat_ws(KEY_SEPARATOR, *parts), 256), F.lit(""))


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance (Sinnott, 1984)."""
    half_dlat = (F.radians(lat2) - F.radians(lat1)) / 2
    half_dlon = (F.radians(lon2) - F.radians(lon1)) / 2
    h = (
        F.sin(half_dlat) * F.sin(half_dlat)
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(half_dlon) * F.sin(half_dlon)
    )
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def bounded(col: Column, lo: Column | None = None, hi: Column | None = None) -> Column:
    """Clamp to the given bounds; a null bound means none."""
    if lo is not None:
        col = F.greatest(col, lo)
    if hi is not None:
        col = F.least(col, hi)
    return col


def message(*cols: str) -> Column:
    """One JSON object holding the named columns; times keep their microseconds."""
    return F.to_json(F.struct(*cols), {
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    })


def unique_list(col: Column | str) -> Column:
    """Sorted distinct values of a group."""
    return F.array_sort(F.collect_set(col))
