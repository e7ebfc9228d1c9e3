"""Stored, mergeable sketches: quantiles and distinct sets of any window without reading events again.

One pass over the events leaves one small row per period and column. A window of periods (an era, a
quarter, all years) is answered by merging those rows: quantiles from KLL sketches, distinct counts
with union, intersection and difference from theta sketches. Both are partial aggregates, so a
period that holds a third of all rows leaves each map task as one sketch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Size of a KLL sketch: 8192 keeps the rank error below 1/1000 (about 200 KB a period and column).
KLL_SIZE = 8192
#: log2 of a theta sketch's entries: 2^16 entries (512 KB) give about 0.4 % standard error, and exact counts below 2^16.
THETA_LOG = 16
#: Standard errors within which a theta estimate is taken to lie.
THETA_SIGMAS = 4.0

Windows = Mapping[str, tuple]


def _stack(df: DataFrame, period: str, parts: Sequence[tuple[str, Mapping[str, Column]]]) -> DataFrame:
    structs = [F.struct(F.lit(c).alias("column"), *[x.alias(n) for n, x in fields.items()]) for c, fields in parts]
    return df.select(F.col(period).alias("period"), F.inline(F.array(*structs)))


def _in(windows: Windows) -> Column:
    """The windows a period falls in, as an array: a period may count for several."""
    names = [F.when(F.col("period").between(lo, hi), F.lit(name)) for name, (lo, hi) in windows.items()]
    return F.array_compact(F.array(*names))


def quantile_sketches(df: DataFrame, period: str, columns: Sequence[str], size: int = KLL_SIZE) -> DataFrame:
    """``period, column, rows, sketch``: a KLL sketch of each numeric column per period (as double; nulls are left
    out and not counted in ``rows``). A null period is a period of its own, in no window."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.kll_sketch_agg_double(x, size).alias(f"{c}__s")]
    wide = df.groupBy(period).agg(*aggs)
    return _stack(wide, period, [(c, {"rows": F.col(f"{c}__n"), "sketch": F.col(f"{c}__s")}) for c in columns])


def window_quantiles(sketches: DataFrame, windows: Windows, qs: Sequence[float], size: int = KLL_SIZE) -> DataFrame:
    """``window, column, rows, q, value`` for closed period windows ``{name: (lo, hi)}``, from stored sketches alone.

    The value's rank is within 1.33 % of the rows at the smallest sketch size of 200 and within 1/1000 at 8192. A
    window or column without values has no row.
    """
    merged = (sketches.where("rows > 0").select("*", F.explode(_in(windows)).alias("window"))
              .groupBy("window", "column")
              .agg(F.sum("rows").alias("rows"), F.kll_merge_agg_double("sketch", size).alias("sketch")))
    values = F.array(*[F.struct(F.lit(float(q)).alias("q"),
                                F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias("value")) for q in qs])
    return merged.select("window", "column", "rows", F.inline(values)).orderBy("window", "column", "q")


def _hashable(df: DataFrame, c: str) -> Column:
    """A type theta sketches take: integers as bigint, floats as double with one zero, the rest as text behind a
    mark, since the sketches skip empty text."""
    dtype, x = df.schema[c].dataType, F.col(c)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return x.cast("long")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(x == 0, F.lit(0.0)).otherwise(x.cast("double"))
    return F.concat(F.lit("="), x.cast("string"))


def distinct_sketches(df: DataFrame, period: str, columns: Sequence[str], log_size: int = THETA_LOG) -> DataFrame:
    """``period, column, has_null, sketch``: a theta sketch of each column's values per period; null is kept apart as a flag."""
    aggs = []
    for c in columns:
        aggs += [F.bool_or(F.col(c).isNull()).alias(f"{c}__z"),
                 F.theta_sketch_agg(_hashable(df, c), log_size).alias(f"{c}__s")]
    wide = df.groupBy(period).agg(*aggs)
    return _stack(wide, period, [(c, {"has_null": F.col(f"{c}__z"), "sketch": F.col(f"{c}__s")}) for c in columns])


def distinct_sets(sketches: DataFrame, first: tuple, second: tuple, log_size: int = THETA_LOG,
                  names: tuple[str, str] = ("pre", "post")) -> DataFrame:
    """``column, <first>, <second>, either, both, <first>_only, <second>_only``: distinct values (null counts as one) of
    two closed period windows and of their union, intersection and differences, from stored sketches alone.

    Exact while a window has fewer values than 2^log_size; beyond that a union is within 4 / sqrt(2^log_size) of
    the truth, and an intersection or difference within that share of the union (``set_error``).
    """
    a, b = names

    def side(window: tuple) -> tuple[Column, Column]:
        here = F.col("period").between(*window)
        return (F.theta_union_agg(F.when(here, F.col("sketch")), log_size), F.coalesce(F.bool_or(F.when(here, F.col("has_null"))), F.lit(False)))

    (sa, za), (sb, zb) = side(first), side(second)
    m = sketches.groupBy("column").agg(sa.alias("a"), za.alias("za"), sb.alias("b"), zb.alias("zb"))

    def count(sketch: Column, null: Column) -> Column:
        return F.theta_sketch_estimate(sketch) + null.cast("long")

    x, y, zx, zy = F.col("a"), F.col("b"), F.col("za"), F.col("zb")
    return m.select(
        "column", count(x, zx).alias(a), count(y, zy).alias(b),
        count(F.theta_union(x, y, log_size), zx | zy).alias("either"),
        count(F.theta_intersection(x, y), zx & zy).alias("both"),
        count(F.theta_difference(x, y), zx & ~zy).alias(f"{a}_only"),
        count(F.theta_difference(y, x), zy & ~zx).alias(f"{b}_only"),
    ).orderBy("column")


def set_error(log_size: int = THETA_LOG) -> float:
    """Largest error to expect of ``distinct_sets``, as a share of the distinct values of both windows together."""
    return THETA_SIGMAS / 2 ** (log_size / 2)
