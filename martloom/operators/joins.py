"""Joins. None carries a broadcast hint on a table that grows: Spark broadcasts a
side when its size, planned or measured at run time, is below
``spark.sql.autoBroadcastJoinThreshold``, and shuffles with skew splitting
otherwise."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from martloom.functions.scalars import great_circle_km
from martloom.session import stored


def with_dimensions(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Inner join to each dimension on its key column."""
    for key, dim in dims.items():
        fact = fact.join(dim, key, "inner")
    return fact


#: A fact of fewer rows than twice this is joined dimension by dimension.
ROWS_A_TASK = 100_000


def shares(sizes: Mapping[str, int], most: int, copies: int) -> dict[str, int]:
    """Into how many parts each dimension is cut, its share of at most ``most`` cells, so
    that no more than ``copies`` rows of dimensions are sent. The one of which most is sent
    is cut next."""
    parts = dict.fromkeys(sizes, 1)
    while True:
        for key in sorted(parts, key=lambda k: sizes[k] / parts[k], reverse=True):
            grown = {**parts, key: parts[key] + 1}
            cells = math.prod(grown.values())
            if cells <= most and sum(sizes[k] * cells // grown[k] for k in grown) <= copies:
                parts = grown
                break
        else:
            return parts


def _broadcastable(df: DataFrame) -> bool:
    """Whether Spark will broadcast ``df`` by its size."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def star_join(fact: DataFrame, dims: Mapping[str, DataFrame], rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """``with_dimensions`` with one shuffle of the fact for all dimensions (Afrati & Ullman,
    Optimizing Joins in a Map-Reduce Environment, EDBT 2010).

    Each dimension is cut into parts by hash of its key, and a cell is one part of each. A
    fact row belongs to one cell, a dimension row to all cells of its part. A cell with more
    rows than twice the mean, where a key is hot, is dealt to several tasks, each of which
    gets the cell's dimension rows. Cells are so few that what is sent of dimensions is at
    most half as many rows as the fact has; the fact is not sorted. Dimensions that are too
    large for that are joined one by one, and so are those that Spark broadcasts.
    """
    spark = fact.sparkSession
    n_rows = fact.count()
    most = min(int(spark.conf.get("spark.sql.shuffle.partitions")), n_rows // rows_a_task)
    if most < 2:
        return with_dimensions(fact, dims)
    every = {key: stored(dim, "dimension") for key, dim in dims.items()}
    small = {key: dim for key, dim in every.items() if _broadcastable(dim)}
    dims = {key: dim for key, dim in every.items() if key not in small}
    parts = shares({key: dim.count() for key, dim in dims.items()}, most, n_rows // 2)
    cells = math.prod(parts.values())
    if len(dims) < 2 or cells < 2:
        return with_dimensions(fact, {**dims, **small})

    def part(key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(parts[key])).cast("int")

    strides, cell = {}, F.lit(0)
    for key in dims:
        strides[key] = math.prod(parts[k] for k in strides)
        cell = cell + part(key) * strides[key]
    placed = fact.withColumn("_cell", cell)
    # At most one row per cell.
    held = dict(placed.groupBy("_cell").agg(F.count(F.lit(1))).collect())
    tasks, n_tasks = {}, 0
    for c in range(cells):
        split = max(1, math.ceil(held.get(c, 0) * cells / (2 * n_rows)))
        tasks[c], n_tasks = range(n_tasks, n_tasks + split), n_tasks + split
    first, split = (F.array(*[F.lit(f(tasks[c])) for c in range(cells)]) for f in (min, len))
    turn = F.pmod(F.monotonically_increasing_id(), F.get(split, F.col("_cell"))).cast("int")
    out = placed.withColumn("_task", F.get(first, F.col("_cell")) + turn).drop("_cell").repartitionById(n_tasks, F.col("_task"))
    for key, dim in dims.items():
        of_part = F.array(*[F.array(*[F.lit(t) for c in range(cells) if c // strides[key] % parts[key] == p for t in tasks[c]])
                            for p in range(parts[key])])
        sent = dim.select(F.explode(F.get(of_part, part(key))).alias("_task"), *dim.columns)
        out = out.join(sent.repartitionById(n_tasks, F.col("_task")).hint("shuffle_hash"), ["_task", key])
    return with_dimensions(out.drop("_task"), small)


def keep_all(left: DataFrame, right: DataFrame, keys: list[str], defaults: Mapping[str, object]) -> DataFrame:
    """Left outer join; the named columns get a default where nothing matched."""
    joined = left.join(right, keys, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def enrich(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Add the columns of a lookup; rows with an unknown key stay, with nulls."""
    return df.join(lookup, key, "left")


def _by_key(df: DataFrame, known: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join to the distinct keys of ``known``. Null is a key like any other."""
    other = known.select(*[F.col(k).alias(f"_known_{k}") for k in keys]).distinct()
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_known_{k}"))
    return df.join(other, same, how)


def without_known(df: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not in ``known``. The known keys are reduced before the
    shuffle, so a key repeated there many times is one row."""
    return _by_key(df, known, keys, "left_anti")


def only_known(df: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is in ``known``."""
    return _by_key(df, known, keys, "left_semi")


def block_join(left: DataFrame, right: DataFrame, group: list[str], left_id: str, right_id: str,
               block_rows: int = 2000) -> DataFrame:
    """Inner join on ``group`` for keys that repeat very often on both sides.

    Adaptive skew splitting goes by input bytes and does not see that a million
    rows meeting a million rows is a trillion results. Here each side of a key is
    cut into blocks of about ``block_rows`` rows, by hash of its id, and every
    pair of blocks is a join key of its own: no task makes more than about
    ``block_rows`` squared results for one key. A row is copied once per block of
    the other side. Columns other than ``group`` must differ between the sides.
    """
    def counted(df: DataFrame, name: str) -> DataFrame:
        blocks = F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int")
        return df.groupBy(*group).agg(blocks.alias(name))

    blocks = counted(left, "_rows").join(counted(right, "_cols"), group)

    def cut(df: DataFrame, row_id: str, own: str, own_blocks: str, other: str, other_blocks: str) -> DataFrame:
        return df.join(blocks, group).select(
            *group,
            F.pmod(F.xxhash64(row_id), F.col(own_blocks).cast("bigint")).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.col(other_blocks) - 1)).alias(other),
            *[c for c in df.columns if c not in group],
        )

    a = cut(left, left_id, "_i", "_rows", "_j", "_cols")
    b = cut(right, right_id, "_j", "_cols", "_i", "_rows")
    return a.join(b, [*group, "_i", "_j"]).drop("_i", "_j")


def block_pairs(df: DataFrame, group: list[str], row_id: str, block_rows: int = 2000) -> DataFrame:
    """Every unordered pair of rows of one ``group`` with different ids, once: ``block_join``
    of a table with itself. Of two blocks only one order is made. The columns of the second
    row, but for ``group``, are called ``other_...``; rows without an id have no pair."""
    blocks = df.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int").alias("_n"))
    rest = [c for c in df.columns if c not in group]
    own = F.pmod(F.xxhash64(row_id), F.col("_n").cast("bigint")).cast("int")
    placed = df.join(blocks, group)
    a = placed.select(*group, own.alias("_i"), F.explode(F.sequence(own, F.col("_n") - 1)).alias("_j"), *rest)
    b = placed.select(*group, own.alias("_j"), F.explode(F.sequence(F.lit(0), own)).alias("_i"),
                      *[F.col(c).alias(f"other_{c}") for c in rest])
    once = (F.col("_i") < F.col("_j")) & (F.col(row_id) != F.col(f"other_{row_id}")) | (F.col(row_id) < F.col(f"other_{row_id}"))
    return a.join(b, [*group, "_i", "_j"]).filter(once).drop("_i", "_j")


#: A cell with at most so many candidate centres is not cut further, nor is one of the
#: last level (a world of 2^LEVELS by 2^LEVELS cells, two metres by one at the equator).
LEAF, LEVELS = 32, 24
#: Levels that one round goes down.
STEP = 4
#: In radians: distances that differ by less than two metres may tie once rounded.
MARGIN = 4e-7


def _spread(bits: Column) -> Column:
    """The bits of a number of up to 32 bits, with a zero in front of each."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        bits = (bits.bitwiseOR(F.shiftleft(bits, shift))).bitwiseAND(F.lit(mask))
    return bits


def cell_path(lat: Column, lon: Column) -> Column:
    """Digits 0 to 3 of the cells that hold a point, from the whole world down: each
    level halves latitude and longitude."""
    size = 1 << LEVELS
    row = F.least(F.floor((lat + 90) / 180 * float(size)), F.lit(size - 1)).cast("bigint")
    col = F.pmod(F.floor((lon + 180) / 360 * float(size)), F.lit(size)).cast("bigint")
    code = F.shiftleft(_spread(row), 1).bitwiseOR(_spread(col))
    return F.lpad(F.conv(code.cast("string"), 10, 4), LEVELS, "0")


def _middle(path: Column, level: int) -> tuple[Column, Column]:
    """Latitude and longitude of the middle of a cell of ``level`` digits."""
    row = col = F.lit(0.0)
    for k in range(1, level + 1):
        digit = F.substring(path, k, 1).cast("int")
        row, col = row * 2 + F.floor(digit / 2), col * 2 + digit % 2
    size = float(1 << level)
    return (row + 0.5) / size * 180 - 90, (col + 0.5) / size * 360 - 180


def _unit(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """A place on the unit sphere."""
    lat, lon = F.radians(lat), F.radians(lon)
    return (F.cos(lat) * F.cos(lon)).alias("x"), (F.cos(lat) * F.sin(lon)).alias("y"), F.sin(lat).alias("z")


def _dot(a: str, b: str) -> Column:
    return sum((F.col(f"{a}.{k}") * F.col(f"{b}.{k}") for k in "yz"), F.col(f"{a}.x") * F.col(f"{b}.x"))


def zone_cells(points: DataFrame, centres: DataFrame) -> DataFrame:
    """``(cell, options)``: for cells that together hold every point, the centres that
    can be nearest to a point in them.

    Centres in one place are one, that of the smallest id. The world is cut again and
    again where candidates are many, and only where there are points. On the unit sphere,
    a point P is nearer to C0 than to C when P . (C0 - C) is positive. Over a cell with
    middle M, whose points lie within r of it, that is at least M . (C0 - C) - r |C0 - C|.
    With C0 the centre nearest to the middle, a centre is dropped where this is positive;
    the margin covers rounded distances. A cell's parts start from its own candidates, and
    a round goes down ``STEP`` levels at once, to the occupied parts alone.
    """
    placed = points.filter("lat IS NOT NULL AND lon IS NOT NULL")
    deepest = stored(placed.select(cell_path(F.col("lat"), F.col("lon")).alias("path")).distinct(), "occupied")
    open_ = centres.filter("lat IS NOT NULL AND lon IS NOT NULL").groupBy(F.col("lat").alias("c_lat"), F.col("lon").alias("c_lon")).agg(
        F.min("zone_id").alias("zone_id")).select(
        F.lit("").alias("cell"), "zone_id", "c_lat", "c_lon", F.struct(*_unit(F.col("c_lat"), F.col("c_lon"))).alias("c"))
    leaves = None
    for level in range(STEP, LEVELS + 1, STEP):
        held = deepest.select(F.substring("path", 1, level - STEP).alias("cell"), F.substring("path", 1, level).alias("part")).distinct()
        if level == STEP:  # the world has 4 ** STEP parts at most
            held = F.broadcast(held)
        parts = open_.join(held, "cell").select(F.col("part").alias("cell"), "zone_id", "c_lat", "c_lon", "c")
        # Half a cell of latitude plus half a cell of equator reaches any of its points.
        radius = math.radians(90.0 / (1 << level)) + math.radians(180.0 / (1 << level))
        measured = parts.withColumn("m", F.struct(*_unit(*_middle(F.col("cell"), level))))
        best = measured.groupBy("cell").agg(F.max_by("c", _dot("m", "c")).alias("c0"))
        ahead = _dot("m", "c0") - _dot("m", "c")
        apart = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * _dot("c", "c0")))
        away = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * _dot("m", "c"))) + radius
        near = measured.join(best, "cell").filter(ahead - radius * apart <= MARGIN * away + 1e-15)
        sizes = near.groupBy("cell").agg((F.count(F.lit(1)) <= LEAF).alias("leaf"))
        cut = stored(near.select("cell", "zone_id", "c_lat", "c_lon", "c").join(sizes, "cell"), "cells")
        done = cut.filter("leaf" if level < LEVELS else "true").drop("leaf")
        leaves = done if leaves is None else leaves.unionByName(done)
        open_ = cut.filter("NOT leaf").drop("leaf")
        if level < LEVELS and open_.isEmpty():
            break
    return leaves.groupBy("cell").agg(F.collect_list(F.struct("zone_id", "c_lat", "c_lon")).alias("options"))


def nearest_zone(points: DataFrame, point_key: str, centres: DataFrame, decimals: int = 3) -> DataFrame:
    """Nearest centre of every point, by an equi join on cells.

    ``points`` has ``lat`` and ``lon``; equal rows stay, and rows without a place have no
    zone. Distances are compared after rounding and ties go to the smallest zone id. Both
    sides of the join are stored tables or scans, so a cell that holds very many points
    can be split.
    """
    cells = stored(zone_cells(points, centres), "zone-cells").withColumnRenamed("cell", "_cell")
    used = [r[0] for r in cells.select(F.length("_cell").alias("n")).distinct().collect()]

    def choice(c_lat: Column, c_lon: Column, zone: Column) -> Column:
        km = F.round(great_circle_km(F.col("lat"), F.col("lon"), c_lat, c_lon), decimals)
        return F.struct(km.alias("km"), zone.alias("zone_id"))

    nearest = F.array_min(F.transform("options", lambda o: choice(o["c_lat"], o["c_lon"], o["zone_id"])))
    # A point lies in one cell of each level, and one of these is a leaf.
    if not used:  # no centre at all
        return points.select(point_key, F.lit(None).cast(centres.schema["zone_id"].dataType).alias("zone_id"),
                             F.lit(None).cast("double").alias("distance_km"))
    levels = sorted(used)
    has_place = F.col("lat").isNotNull() & F.col("lon").isNotNull()  # least() passes over nulls
    placed = points.select(point_key, "lat", "lon", F.when(has_place, cell_path(F.col("lat"), F.col("lon"))).alias("_path"))
    inside = placed.filter("_path IS NOT NULL").select(
        point_key, "lat", "lon", F.explode(F.array(*[F.substring("_path", 1, n) for n in levels])).alias("_cell"))
    found = inside.join(cells, "_cell").select(point_key, nearest.alias("best"))
    placeless = placed.filter("_path IS NULL").select(point_key, F.lit(None).cast(found.schema["best"].dataType).alias("best"))
    return found.unionByName(placeless).select(
        point_key, F.col("best.zone_id").alias("zone_id"), F.col("best.km").alias("distance_km"))
