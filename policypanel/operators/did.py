"""Cross-unit difference-in-differences (treated unit vs control units).

The whole estimate is one Spark plan: a unit x era aggregate (tiny: units x 2),
then one global aggregate with conditional expressions per role. The control
level of an era is the *unweighted mean over control units* of each unit's
per-year value, not the pooled total. If the treated unit or every control is
missing, the estimate row is returned with nulls instead of failing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from policypanel.functions.columns import ColumnOrName, as_col, flag, pct_change
from policypanel.operators.aggregate import count_expr

# Default fixed divisors for eras coded 0 (pre) / 1 (post).
Divisors = Mapping[int, int] | str


def unit_filter(df: DataFrame, codes: Mapping[tuple, str], keys: Sequence[str]) -> Column:
    """OR of composite-key equalities, e.g. (STATE = 36 AND CITY = 4170) OR ...;
    simple enough to be pushed into a Parquet scan."""
    preds = [reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in zip(keys, code)])
             for code in codes]
    return reduce(lambda a, b: a | b, preds)


def label_units(df: DataFrame, codes: Mapping[tuple, str], keys: Sequence[str],
                label: str = "unit", keep_unmatched: bool = False) -> DataFrame:
    """Code pair -> unit name through a CASE chain; rows matching no code are
    dropped (or kept with a null label when ``keep_unmatched``)."""
    expr = None
    for code, name in codes.items():
        cond = reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in zip(keys, code)])
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    out = df if keep_unmatched else df.filter(unit_filter(df, codes, keys))
    return out.withColumn(label, expr)


def did_flags(df: DataFrame, unit: str, treated: str, year: str, cut: int,
              treatment: str = "TREATMENT", post: str = "POST",
              interaction: str = "TREAT_POST") -> DataFrame:
    """0/1 columns: treated unit, post period, and their product."""
    return (df.withColumns({treatment: flag(F.col(unit) == F.lit(treated)),
                            post: flag(F.col(year) >= F.lit(cut))})
            .withColumn(interaction, F.col(treatment) * F.col(post)))


def unit_panel(df: DataFrame, unit: str, year: str, measure: ColumnOrName | None = None,
               total_name: str = "total_fatalities", count_name: str = "num_crashes",
               count_col: ColumnOrName | None = None) -> DataFrame:
    """Unit x year totals for a parallel-trend check, ordered by unit, year."""
    aggs = []
    if measure is not None:
        aggs.append(F.sum(as_col(measure)).alias(total_name))
    aggs.append(count_expr(count_col).alias(count_name))
    return df.groupBy(unit, year).agg(*aggs).orderBy(unit, year)


def unit_era(df: DataFrame, unit: str, year: str, cut: int, measure: ColumnOrName | None = None,
             divisors: Divisors = "observed", post: str = "POST",
             total_name: str = "fatalities", count_name: str = "crashes",
             per_year_name: str | None = None, count_col: ColumnOrName | None = None) -> DataFrame:
    """Unit x era (POST 0/1) totals and the per-year value used by ``did``.

    ``measure=None`` uses the event count as the outcome. ``divisors`` is either a
    mapping ``{0: pre_years, 1: post_years}`` (fixed, even if a unit lacks a year)
    or ``"observed"``: distinct years of the era present in the whole input.
    """
    per_year_name = per_year_name or f"{total_name}_per_year"
    tagged = df.withColumn(post, flag(F.col(year) >= F.lit(cut)))
    outcome = count_expr(count_col) if measure is None else F.sum(as_col(measure))
    aggs = [outcome.alias(total_name)]
    if measure is not None or count_name != total_name:
        aggs.append(count_expr(count_col).alias(count_name))
    table = tagged.groupBy(unit, post).agg(*aggs)
    if isinstance(divisors, Mapping):
        div = None
        for code, n in divisors.items():
            cond = F.col(post) == F.lit(int(code))
            div = F.when(cond, F.lit(int(n))) if div is None else div.when(cond, F.lit(int(n)))
        table = table.withColumn("years_in_era", div)
    else:
        years = tagged.groupBy(post).agg(F.count_distinct(F.col(year)).alias("years_in_era"))
        # two rows (POST = 0 / 1): bounded, broadcast.
        table = table.join(F.broadcast(years), [post], "left")
    return (table.withColumn(per_year_name,
                             F.try_divide(F.col(total_name).cast("double"),
                                          F.col("years_in_era").cast("double")))
            .drop("years_in_era"))


def did(table: DataFrame, unit: str, treated: str, value: str = "fatalities_per_year",
        post: str = "POST") -> DataFrame:
    """One-row DiD from a unit x era table: treated and control levels, changes,
    the estimate (treated change - control change) and % changes."""
    is_t = F.col(unit) == F.lit(treated)
    is_c = F.col(unit) != F.lit(treated)
    pre = F.col(post) == F.lit(0)
    postc = F.col(post) == F.lit(1)
    v = F.col(value).cast("double")
    levels = table.agg(
        F.max(F.when(is_t & pre, v)).alias("treated_pre"),
        F.max(F.when(is_t & postc, v)).alias("treated_post"),
        F.avg(F.when(is_c & pre, v)).alias("control_pre"),
        F.avg(F.when(is_c & postc, v)).alias("control_post"),
    )
    return (levels
            .withColumn("treated_change", F.col("treated_post") - F.col("treated_pre"))
            .withColumn("control_change", F.col("control_post") - F.col("control_pre"))
            .withColumn("did_estimate", F.col("treated_change") - F.col("control_change"))
            .withColumn("treated_pct_change", pct_change("treated_post", "treated_pre"))
            .withColumn("control_pct_change", pct_change("control_post", "control_pre")))


def did_estimate(df: DataFrame, unit: str, year: str, treated: str, controls: Sequence[str],
                 cut: int, measure: ColumnOrName | None = None, divisors: Divisors = "observed",
                 window: tuple[int, int] | None = None, count_col: ColumnOrName | None = None
                 ) -> DataFrame:
    """Filter to the treated and control units (and an optional closed year
    window), build the unit x era table and estimate."""
    scoped = df.filter(F.col(unit).isin([treated, *controls]))
    if count_col is not None:
        # pre-aggregated cells without events stand for "no rows"
        scoped = scoped.filter(as_col(count_col) > F.lit(0))
    if window is not None:
        scoped = scoped.filter(F.col(year).between(*window))
    table = unit_era(scoped, unit, year, cut, measure=measure, divisors=divisors,
                     count_col=count_col, total_name="outcome", count_name="events",
                     per_year_name="outcome_per_year")
    return did(table, unit, treated, value="outcome_per_year")


def did_summary(estimates: Mapping[str, DataFrame], column: str = "did_estimate") -> DataFrame:
    """(analysis, did_estimate_per_year) rows, one per named estimate."""
    parts = [est.select(F.lit(name).alias("analysis"),
                        F.col(column).alias("did_estimate_per_year"))
             for name, est in estimates.items()]
    return reduce(DataFrame.unionByName, parts)
