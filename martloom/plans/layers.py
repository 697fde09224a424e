"""Promotion between warehouse layers and date-parameterised refresh."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StructField, StructType

from martloom.operators.joins import only_known, without_known
from martloom.operators.quality import bag_digests, differing_digests
from martloom.operators.rows import conform
from martloom.session import stored
from martloom.sources.files import lake_window
from martloom.sources.sinks import drop_periods, insert_new, read_or_empty, write_mart


@dataclass(frozen=True)
class LayerTable:
    """How one staged table reaches the next layer.

    With ``period_col`` whole periods are replaced, otherwise rows with new
    ``keys`` are added, into ``buckets`` of the target if given. ``shape`` turns staged
    rows (``staged`` is their schema) into target columns.
    """

    staging: str
    staged: StructType
    target: str
    schema: StructType
    shape: Callable[[DataFrame], DataFrame]
    keys: Sequence[str] = ()
    order_cols: Sequence[str] = ()
    period_col: str | None = None
    buckets: int | None = None

    def shaped(self, rows: DataFrame) -> DataFrame:
        return conform(self.shape(rows), self.schema)


def promote(spark: SparkSession, tables: Sequence[LayerTable], day: dt.date) -> None:
    """Carry the rows staged on ``day`` into the next layer.

    A period that the day touches is rebuilt from all staged rows, not from the
    day's alone: other loads may hold rows of it too.
    """
    for table in tables:
        if table.period_col:
            _promote_periods(spark, table, day)
        else:
            staged = spark.read.schema(table.staged).parquet(table.staging).filter(F.col("load_date") == F.lit(day))
            insert_new(table.shaped(staged), table.target, list(table.keys), list(table.order_cols), table.schema, table.buckets)


_STAGED = "staged_day"


def _promote_periods(spark: SparkSession, table: LayerTable, day: dt.date) -> None:
    """Which staged days hold rows of which period is kept beside the target, so that only
    the staged days of the touched periods are opened. Touched are the periods that the
    day holds, and those that it held when it was promoted before."""
    period = table.period_col
    index = f"{table.target}_days"
    staged = spark.read.schema(table.staged).parquet(table.staging)
    held = read_or_empty(spark, index, StructType([table.schema[period], StructField(_STAGED, DateType())]))
    indexed = {r[0] for r in held.select(_STAGED).distinct().collect()}
    # The day itself, and days that were landed without being promoted.
    missing = [r[0] for r in staged.select("load_date").distinct().collect() if r[0] not in indexed]
    found = None
    for load_date in sorted({*missing, day}):
        periods = table.shaped(staged.filter(F.col("load_date") == F.lit(load_date))).select(period).distinct()
        periods = periods.withColumn(_STAGED, F.lit(load_date))
        found = periods if found is None else found.unionByName(periods)
    known = stored(held.unionByName(found).distinct(), "period-days")
    touched = known.filter(F.col(_STAGED) == F.lit(day)).select(period)
    days = [r[0] for r in only_known(known, touched, [period]).select(_STAGED).distinct().collect()]
    whole = stored(only_known(table.shaped(staged.filter(F.col("load_date").isin(days))), touched, [period]), "periods")
    write_mart(whole, table.target, period)
    gone = without_known(touched, whole, [period]).collect()
    drop_periods(spark, table.target, period, [r[0] for r in gone])
    without_known(known, held, [period, _STAGED]).write.mode("append").parquet(index)


@dataclass(frozen=True)
class Mart:
    """A mart computed from the lake, stored and replaced period by period."""

    lake: str
    schema: StructType
    day_col: str
    build: Callable[[DataFrame], DataFrame]
    path: str
    period_col: str
    period: str = "day"


def period_bounds(first: dt.date, last: dt.date, period: str) -> tuple[dt.date, dt.date]:
    """Smallest span of whole periods that holds both days."""
    if period == "day":
        return first, last
    if period == "week":
        return first - dt.timedelta(days=first.weekday()), last + dt.timedelta(days=6 - last.weekday())
    if period == "month":
        next_month = (last.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
        return first.replace(day=1), next_month - dt.timedelta(days=1)
    raise ValueError(f"unknown period {period}")


Span = tuple[dt.date, dt.date]


def _rebuild(spark: SparkSession, mart: Mart, spans: Sequence[Span], undated: bool = False) -> None:
    """Compute the periods of ``spans`` again, those of rows without a day if ``undated``,
    and remove stored ones that have no rows any more."""
    def within(col: str) -> Column:
        wanted = F.col(col).isNull() if undated else F.lit(False)
        for first, last in spans:
            wanted = wanted | F.col(col).between(F.lit(first), F.lit(last))
        return wanted

    rows = spark.read.schema(mart.schema).parquet(mart.lake).filter(within(mart.day_col))
    built = stored(mart.build(rows), "mart")
    write_mart(built, mart.path, mart.period_col)
    held = spark.read.schema(built.schema).parquet(mart.path).filter(within(mart.period_col))
    # A few periods, whatever the size of the mart.
    empty = without_known(held.select(mart.period_col).distinct(), built, [mart.period_col])
    drop_periods(spark, mart.path, mart.period_col, [r[0] for r in empty.collect()])


def refresh(spark: SparkSession, mart: Mart, day: dt.date, depth: int = 1) -> None:
    """Rebuild every period touched by the last ``depth`` days up to ``day``.

    Periods are always read whole, so a refresh in the middle of a week never
    replaces that week by a part of it, and days may be refreshed in any order. A
    stored period of the span that has no rows any more is removed.
    """
    _rebuild(spark, mart, [period_bounds(*lake_window(day, depth), mart.period)])


def merged(spans: Iterable[Span]) -> list[Span]:
    """Spans that meet or overlap are one."""
    out: list[Span] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + dt.timedelta(days=1):
            out[-1] = out[-1][0], max(out[-1][1], last)
        else:
            out.append((first, last))
    return out


def refresh_by_digest(spark: SparkSession, mart: Mart) -> list[Span]:
    """Rebuild the periods of all days whose rows are not those that the mart was built
    from, however old, and tell which.

    A digest of every source day is kept beside the mart. One scan of the lake, merged
    map-side to a row per day, finds late refunds without a look-back. The digests are
    saved after the mart: a run that fails in between does the same work again.
    """
    saved = f"{mart.path}_digests"
    lake = spark.read.schema(mart.schema).parquet(mart.lake)
    now = stored(bag_digests(lake, [mart.day_col], lake.columns), "digests")
    before = read_or_empty(spark, saved, now.schema)
    # One row per day of the calendar at most.
    days = [r[0] for r in differing_digests(now, before, [mart.day_col]).collect()]
    spans = merged(period_bounds(day, day, mart.period) for day in days if day is not None)
    if days:
        _rebuild(spark, mart, spans, undated=None in days)
        now.write.mode("overwrite").parquet(saved)
    return spans


def stored_days(spark: SparkSession, mart: Mart) -> tuple[dt.date, dt.date] | None:
    """First and last day of the lake, read from its folders."""
    lake = spark.read.schema(mart.schema).parquet(mart.lake)
    first, last = lake.agg(F.min(mart.day_col), F.max(mart.day_col)).first()
    return None if first is None else (first, last)


def backfill(spark: SparkSession, mart: Mart, first: dt.date, last: dt.date) -> None:
    """All periods between two days in one run."""
    refresh(spark, mart, last, (last - first).days + 1)
