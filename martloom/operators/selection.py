"""Exact quantile groups of several measures at once, by distributed selection.

The groups of ``NTILE(n)`` begin at known ranks. Instead of sorting, the row at each of
these ranks is looked for: values are whole numbers, an interval that holds the wanted rank
is cut into equal parts, one pass over the rows counts the parts of all intervals of all
measures, and the part with the rank is the next interval. Among rows of the value found
the search goes on by the tie-break. Each pass multiplies the resolution, so the number of
passes grows with the digits of the values, not with the rows, and what a pass sends to the
driver is bounded by ``PARTS``. The score of a row is then a comparison with the cut rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, DateType, DecimalType, IntegralType, TimestampNTZType, TimestampType

from martloom.session import stored

#: Counted parts of a pass, over all intervals.
PARTS = 16384
_WIDE = DecimalType(38, 0)


def whole_number(col: Column, kind: DataType) -> Column:
    """The same order as whole numbers: days, microseconds, units of the last decimal."""
    if isinstance(kind, DateType):
        return F.unix_date(col).cast("bigint")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(col.cast("timestamp"))
    if isinstance(kind, DecimalType):
        return (col * F.lit(10 ** kind.scale).cast(DecimalType(kind.scale + 1, 0))).cast(_WIDE)
    if isinstance(kind, IntegralType):
        return col.cast("bigint")
    raise ValueError(f"{kind.simpleString()} has no whole-number order")


@dataclass(frozen=True)
class _Cut:
    """A wanted row: number ``group`` of a measure begins with it. ``rank`` counts from the
    first row of the interval ``lo..hi`` of the values, or, once ``value`` is known, of the
    tie-breaks of its rows."""

    measure: int
    group: int
    rank: int
    lo: int
    hi: int
    value: int | None = None
    found: bool = False
    tie: int = 0

    def interval(self) -> tuple:
        return self.measure, self.value, self.lo, self.hi


def group_starts(rows: int, n: int) -> list[tuple[int, int]]:
    """(group, rank of its first row from 0) for groups 2..n that have rows."""
    small, larger = divmod(rows, n)
    starts = [(g, (g - 1) * small + min(g - 1, larger)) for g in range(2, n + 1)]
    return [(g, at) for g, at in starts if at < rows]


def _literal(value: int, wide: bool) -> str:
    return f"CAST('{value}' AS DECIMAL(38,0))" if wide else f"{value}L"


def _pass(df: DataFrame, cuts: list[_Cut], wide: Mapping[str, bool], tie_span: int) -> list[_Cut]:
    """All open cuts one step further."""
    intervals = list(dict.fromkeys(c.interval() for c in cuts))
    parts = max(2, PARTS // len(intervals))
    cases: dict[int, list[str]] = {}
    widths = []
    for i, (m, value, lo, hi) in enumerate(intervals):
        width = -(-(hi - lo + 1) // parts)
        widths.append(width)
        name = f"_x{m}" if value is None else "_tie"
        within = f"{name} BETWEEN {_literal(lo, wide[name])} AND {_literal(hi, wide[name])}"
        if value is not None:
            within += f" AND _x{m} = {_literal(value, wide[f'_x{m}'])}"
        part = f"CAST(({name} - {_literal(lo, wide[name])}) div {_literal(width, wide[name])} AS INT)"
        cases.setdefault(m, []).append(f"WHEN {within} THEN struct({i} AS i, {part} AS part)")
    hits = [f"CASE {' '.join(c)} END" for c in cases.values()]
    found = df.select(F.explode(F.expr(f"filter(array({', '.join(hits)}), h -> h IS NOT NULL)")).alias("h"))
    counts: dict[int, dict[int, int]] = {}
    for i, part, n in found.groupBy("h.i", "h.part").count().collect():
        counts.setdefault(i, {})[part] = n
    out = []
    for cut in cuts:
        i = intervals.index(cut.interval())
        rank = cut.rank
        for part in sorted(counts[i]):
            if rank < counts[i][part]:
                break
            rank -= counts[i][part]
        lo = cut.lo + part * widths[i]
        cut = replace(cut, rank=rank, lo=lo, hi=min(cut.hi, lo + widths[i] - 1))
        if cut.lo == cut.hi and cut.value is not None:
            cut = replace(cut, found=True, tie=cut.lo)
        elif cut.lo == cut.hi:
            # The first row of its value needs no tie-break.
            cut = replace(cut, value=cut.lo, lo=0, hi=tie_span, found=rank == 0)
        out.append(cut)
    return out


def with_quantiles(df: DataFrame, measures: Mapping[str, str], tie: str, n: int) -> DataFrame:
    """``df`` with the groups 1..n of NTILE(n) over each measure (measure -> name of the
    group column), nulls first, ties by ``tie``. Measures and ``tie`` are dates, times,
    integers or decimals. Rows that are equal in a measure and in ``tie`` share the later
    group when a cut falls between them.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    named = {f"_x{k}": c for k, c in enumerate(measures)} | {"_tie": tie}
    numbers = df.withColumns({x: whole_number(F.col(c), kinds[c]) for x, c in named.items()})
    held = stored(numbers, "measures")
    bounds = held.agg(F.count(F.lit(1)).alias("rows"), *[f(x).alias(f"{f.__name__}{x}") for x in named for f in (F.min, F.max)]).first()
    least = {x: int(bounds[f"min{x}"] or 0) for x in named}
    span = {x: int(bounds[f"max{x}"] or 0) - least[x] + 1 for x in named}
    wide = {x: span[x] >= 1 << 62 for x in named}
    # From 0 for null, then from 1 up.
    moved = {x: F.coalesce((F.col(x).cast(_WIDE) - F.lit(str(least[x] - 1)).cast(_WIDE)).cast(_WIDE if wide[x] else "bigint"),
                           F.lit(0).cast(_WIDE if wide[x] else "bigint")) for x in named}
    placed = held.withColumns(moved)
    todo = [_Cut(m, g, at, 0, span[f"_x{m}"]) for m in range(len(measures)) for g, at in group_starts(bounds["rows"], n)]
    done: list[_Cut] = []
    while todo:
        after = _pass(placed, todo, wide, span["_tie"])
        done += [c for c in after if c.found]
        todo = [c for c in after if not c.found]

    def passed(cut: _Cut) -> str:
        x = f"_x{cut.measure}"
        value = _literal(cut.value, wide[x])
        return f"CASE WHEN {x} > {value} OR {x} = {value} AND _tie >= {_literal(cut.tie, wide['_tie'])} THEN 1 ELSE 0 END"

    scores = {name: F.expr(" + ".join(["1", *[passed(c) for c in done if c.measure == m]])).cast("int")
              for m, name in enumerate(measures.values())}
    return placed.withColumns(scores).drop(*named)
