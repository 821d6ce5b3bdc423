"""Cell -> wide metrics at the finest resolution, rolled up level by level.

Metrics are data: conditional counts, sums, maxima, and ratios of carried sums. Levels are
always rolled up from the finer level, never encoded anew (a point's direct coarse cell is not
always the parent of its fine cell).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexloom.functions import cells

FINEST, COARSEST = 10, 1


@dataclass(frozen=True)
class Ratio:
    """Exported quotient of two carried columns; null where the divisor is 0."""

    top: str
    under: str
    type: str


@dataclass(frozen=True)
class Spec:
    """``counts``: column -> SQL predicate; ``sums`` and ``maxima``: column -> (SQL expression, type).

    ``ratios`` are worked out at export from carried columns, so that every level has the
    exact quotient; ``hidden`` columns are carried but not exported. ``order``: exported columns.
    """

    total: str
    counts: dict[str, str]
    sums: dict[str, tuple[str, str]] = field(default_factory=dict)
    maxima: dict[str, tuple[str, str]] = field(default_factory=dict)
    ratios: dict[str, Ratio] = field(default_factory=dict)
    hidden: tuple[str, ...] = ()
    order: tuple[str, ...] = ()

    def exported(self) -> list[str]:
        every = [self.total, *self.counts, *self.sums, *self.maxima, *self.ratios]
        return list(self.order) or [c for c in every if c not in self.hidden]


def base_level(features: DataFrame, spec: Spec, cell: str = "h3_index") -> DataFrame:
    """One row for each cell with all metrics; one scan, one shuffle of partial aggregates."""
    aggs = [F.count("*").cast("int").alias(spec.total)]
    aggs += [F.count_if(F.expr(p)).cast("int").alias(c) for c, p in spec.counts.items()]
    aggs += [F.sum(F.expr(e)).cast(t).alias(c) for c, (e, t) in spec.sums.items()]
    aggs += [F.max(F.expr(e)).cast(t).alias(c) for c, (e, t) in spec.maxima.items()]
    return features.groupBy(cell).agg(*aggs)


def _sums(spec: Spec) -> list[Column]:
    aggs = [F.sum(c).cast("int").alias(c) for c in (spec.total, *spec.counts)]
    aggs += [F.sum(c).cast(t).alias(c) for c, (_, t) in spec.sums.items()]
    return aggs + [F.max(c).alias(c) for c in spec.maxima]


def roll_up(level: DataFrame, spec: Spec, res: int, cell: str = "h3_index") -> DataFrame:
    """The next coarser level: counts and sums added, maxima taken. Null cells form one group."""
    return level.groupBy(cells.parent(F.col(cell), res).alias(cell)).agg(*_sums(spec))


def export(level: DataFrame, spec: Spec, cell: str = "h3_index", *more: str) -> DataFrame:
    def value(c: str) -> Column:
        if c in spec.ratios:
            r = spec.ratios[c]
            return F.when(F.col(r.under) > 0, F.col(r.top) / F.col(r.under)).cast(r.type).alias(c)
        return F.col(c)

    return level.select(cell, *(value(c) for c in spec.exported()), *more)


def levels(finest: DataFrame, spec: Spec, coarsest: int = COARSEST, cell: str = "h3_index") -> Iterator[tuple[int, DataFrame]]:
    """(resolution, carried level) from fine to coarse; a level is kept only until the next is made from it."""
    level, held = finest.persist(StorageLevel.MEMORY_AND_DISK), []
    for res in range(FINEST, coarsest - 1, -1):
        yield res, level
        held.append(level)
        if len(held) > 2:
            held.pop(0).unpersist()
        if res > coarsest:
            level = roll_up(level, spec, res - 1, cell).persist(StorageLevel.MEMORY_AND_DISK)
    for x in held:
        x.unpersist()


def all_levels(finest: DataFrame, spec: Spec, coarsest: int = COARSEST, cell: str = "h3_index") -> DataFrame:
    """All exported levels in one frame, with their resolution in ``res``.

    The second level is rolled up from the finest; all coarser ones come from the second in one
    aggregate over (resolution, cell), each of whose rows goes to every coarser level. That is one more
    pass over about as many rows as the finest level has, instead of a chain of nine plans.
    """
    second = roll_up(finest, spec, FINEST - 1, cell)
    out = export(finest, spec, cell).withColumn("res", F.lit(FINEST))
    if coarsest < FINEST:
        out = out.unionByName(export(second, spec, cell).withColumn("res", F.lit(FINEST - 1)))
    if coarsest < FINEST - 1:
        dealt = second.withColumn("res", F.explode(F.sequence(F.lit(coarsest), F.lit(FINEST - 2))))
        rest = dealt.groupBy(cells.parent_at(F.col(cell), F.col("res")).alias(cell), "res").agg(*_sums(spec))
        out = out.unionByName(export(rest, spec, cell, "res"))
    return out


def each_level(finest: DataFrame, spec: Spec, write: Callable[[int, DataFrame], None], coarsest: int = COARSEST) -> dict[int, int]:
    """Writes every exported level; returns the number of cells by resolution."""
    made = {}
    for res, level in levels(finest, spec, coarsest):
        write(res, export(level, spec))
        made[res] = level.count()
    return made


def merge_outer(parts: list[tuple[DataFrame, Spec]], cell: str = "h3_index") -> DataFrame:
    """Full outer merge of several bases on the cell; absent counts become 0.

    Rows whose cell is null never match, and stay a row for each side.
    """
    out = parts[0][0]
    for other, _ in parts[1:]:
        out = out.join(other, cell, "full_outer")
    names = [c for _, s in parts for c in (s.total, *s.counts)]
    return out.select(cell, *(F.coalesce(c, F.lit(0)).alias(c) for c in names))
