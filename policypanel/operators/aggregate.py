"""Additive aggregation helpers shared by the analytic operators.

A *measure spec* is an ordered mapping ``{output_name: input column}`` of values
that are summed. Event counts are either ``count(*)`` over raw rows or, when the
input was pre-aggregated, ``sum(count_col)``; both give the same bigint. Because
every measure is additive, an operator gives the same answer on raw events and
on facts that were grouped at a finer grain first (``collapse_by_key`` then
``unpivot_periods``): that is what lets the plans collapse big fact tables (and
hot keys) map-side before any join or shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from policypanel.functions.columns import ColumnOrName, as_col


def count_expr(count_col: ColumnOrName | None) -> Column:
    """Row count, or the sum of a pre-aggregated count column."""
    if count_col is None:
        return F.count(F.lit(1))
    return F.sum(as_col(count_col)).cast("long")


def sum_exprs(measures: Mapping[str, ColumnOrName]) -> list[Column]:
    return [F.sum(as_col(src)).alias(name) for name, src in measures.items()]


def measure_aggs(count_name: str | None, measures: Mapping[str, ColumnOrName],
                 count_col: ColumnOrName | None = None) -> list[Column]:
    aggs = [] if count_name is None else [count_expr(count_col).alias(count_name)]
    return aggs + sum_exprs(measures)


def _q(name: str) -> str:
    """Backtick-quoted identifier for a SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def _lit(value) -> str:
    if isinstance(value, bool) or not isinstance(value, (int, float, str)):
        raise TypeError(f"unsupported period value {value!r}")
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(value)


def collapse_by_key(df: DataFrame, key: str, period: str, periods: Sequence,
                    measures: Mapping[str, ColumnOrName], count_prefix: str = "n") -> DataFrame:
    """One row per ``key`` with, for every period value ``p`` of a bounded list
    (the years of an analysis window), the event count ``n_<p>`` and the sums
    ``<measure>_<p>``.

    Spark runs it as a partial (map-side) plus final hash aggregation, so a key
    holding a third of all rows leaves every map task as one row, and the result
    is hash-partitioned on ``key``: a join on ``key`` that follows reuses that
    partitioning and only the other side is shuffled. (The per-period aggregates
    are written as one SQL expression each: the same plan, fewer driver calls.)
    """
    if isinstance(period, str) and all(isinstance(v, str) for v in measures.values()):
        aggs = []
        for p in periods:
            cond = f"{_q(period)} = {_lit(p)}"
            aggs.append(F.expr(f"count_if({cond}) AS {_q(f'{count_prefix}_{p}')}"))
            for name, src in measures.items():
                aggs.append(F.expr(f"sum(CASE WHEN {cond} THEN {_q(src)} END) "
                                   f"AS {_q(f'{name}_{p}')}"))
        return df.groupBy(key).agg(*aggs)
    aggs = []
    for p in periods:
        in_p = as_col(period) == F.lit(p)
        aggs.append(F.count_if(in_p).alias(f"{count_prefix}_{p}"))
        for name, src in measures.items():
            aggs.append(F.sum(F.when(in_p, as_col(src))).alias(f"{name}_{p}"))
    return df.groupBy(key).agg(*aggs)


#: Bits of a year mask: years lo to lo + 62 fit a bigint without its sign.
MASK_YEARS = 63


def year_bit(year: ColumnOrName, lo: int) -> Column:
    """The bit of ``year`` in a mask that starts at year ``lo``. Years outside lo .. lo + 62 have no bit (null),
    so the caller bounds the window first (``check_mask``)."""
    offset = as_col(year) - F.lit(lo)
    return F.when(offset.between(0, MASK_YEARS - 1), F.call_function("shiftleft", F.lit(1).cast("long"), offset.cast("int")))


def check_mask(lo: int, hi: int) -> None:
    if not 0 <= hi - lo < MASK_YEARS:
        raise ValueError(f"years {lo} to {hi} do not fit one mask of {MASK_YEARS} years")


def collapse_by_era(df: DataFrame, key: str, era: str, year: str, lo: int, hi: int, measures: Mapping[str, str],
                    eras: Sequence[str] = ("pre", "post"), mask: str = "years_mask") -> DataFrame:
    """One row per ``key`` (null included) with, for every era ``e``, the event count ``n_<e>``, the
    sums ``<measure>_<e>`` and ``<mask>_<e>``, a bit per year of [lo, hi] that had an event.

    The mask is a ``bit_or`` of single bits, a partial aggregate like the sums and mergeable like them, so
    the years behind an annualised value need no cell per year and no second pass: a row has
    one cell per era and measure, whatever the length of the window.
    """
    check_mask(lo, hi)
    aggs = []
    for e in eras:
        here = F.col(era) == F.lit(e)
        aggs.append(F.count_if(here).alias(f"n_{e}"))
        aggs += [F.sum(F.when(here, F.col(src))).alias(f"{m}_{e}") for m, src in measures.items()]
        aggs.append(F.bit_or(F.when(here, year_bit(year, lo))).alias(f"{mask}_{e}"))
    return df.groupBy(key).agg(*aggs)


def years_from_masks(cells: DataFrame, era: str = "era", mask: str = "years_mask") -> DataFrame:
    """``era, years_in_era``: distinct years with an event per era, from the masks of additive cells."""
    return cells.groupBy(era).agg(F.bit_count(F.bit_or(mask)).cast("long").alias("years_in_era"))


def unpivot_periods(df: DataFrame, ids: Sequence[str], periods: Sequence, measures: Sequence[str],
                    period: str = "year", count_prefix: str = "n", count_name: str = "n"
                    ) -> DataFrame:
    """Rows ``ids..., period, n, measures...`` back from ``collapse_by_key``
    columns (one ``inline(array(struct))``, JVM-side); cells without events are
    dropped, so a (label, period) with no events has no row."""
    structs = []
    for p in periods:
        fields = [f"{_lit(p)} AS {_q(period)}",
                  f"{_q(f'{count_prefix}_{p}')} AS {_q(count_name)}"]
        fields += [f"{_q(f'{m}_{p}')} AS {_q(m)}" for m in measures]
        structs.append(f"struct({', '.join(fields)})")
    long = df.select(*[F.col(i) for i in ids], F.expr(f"inline(array({', '.join(structs)}))"))
    return long.filter(F.col(count_name) > 0)
