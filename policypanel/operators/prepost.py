"""Within-unit before/after summaries (one event log, one policy year).

All operators take a *prepared* frame (see ``clean.prepare_events``): one row per
event, or pre-aggregated additive facts (pass ``count_col``), with an integer
year column and an era column holding ``pre`` / ``post``.

Annualisation divides by the number of distinct years of the era observed in the
*whole* input frame (not per segment), or by fixed divisors when ``years`` is a
mapping ``{"pre": 9, "post": 11}``. The per-era year table has exactly one row per
era label, so joining it back is a broadcast with a proven bound; nothing is
pulled to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from policypanel.functions.columns import (
    ColumnOrName,
    as_col,
    era,
    is_missing_token,
    is_present,
    normalise_key,
    pct_change,
    per_scale,
    safe_ratio,
)
from policypanel.operators.aggregate import count_expr, measure_aggs
from policypanel.operators.joins import join_small

# The output names of the summaries (``crashes``, ``years_in_era``, ``*_per_year``,
# ``*_per_100k_per_year``, ``unspecified_share`` and the like) are those of the study's own tables.
Years = str | Mapping[str, int] | DataFrame


def tag_era(df: DataFrame, year_col: str, cut: int, era_col: str = "era") -> DataFrame:
    """Era label ``post`` if year >= cut else ``pre``."""
    return df.withColumn(era_col, era(year_col, cut))


def years_per_era(df: DataFrame, era_col: str = "era", year_col: str = "year") -> DataFrame:
    """Distinct years observed per era in the whole frame (one row per era)."""
    return df.groupBy(era_col).agg(F.count_distinct(as_col(year_col)).alias("years_in_era"))


def _fixed_years(era_col: str, years: Mapping[str, int]) -> Column:
    expr = None
    for label, n in years.items():
        cond = F.col(era_col) == F.lit(label)
        expr = F.when(cond, F.lit(int(n))) if expr is None else expr.when(cond, F.lit(int(n)))
    return expr.cast("long")


def with_years(agg: DataFrame, source: DataFrame, years: Years = "observed",
               era_col: str = "era", year_col: str = "year") -> DataFrame:
    """Attach ``years_in_era`` to an era-keyed aggregate: fixed divisors, a
    precomputed ``(era, years_in_era)`` table, or the distinct years per era
    observed in ``source``."""
    if isinstance(years, Mapping):
        return agg.withColumn("years_in_era", _fixed_years(era_col, years))
    table = years if isinstance(years, DataFrame) else years_per_era(source, era_col, year_col)
    # One row per era label: bounded by construction, safe to broadcast.
    return join_small(agg, table.select(era_col, "years_in_era"), [era_col], "left",
                      proven_small=True)


def annualise(df: DataFrame, columns: Mapping[str, str], years_col: str = "years_in_era") -> DataFrame:
    """``{out: total}`` -> ``out = total / years`` (double; null when years is 0)."""
    return df.withColumns({out: safe_ratio(src, years_col) for out, src in columns.items()})


def period_summary(df: DataFrame, period: str, measures: Mapping[str, ColumnOrName],
                   count_name: str = "crashes", count_col: ColumnOrName | None = None) -> DataFrame:
    """Counts and sums per period (year, ``yyyy-MM`` month, ...), ascending."""
    return (df.groupBy(period).agg(*measure_aggs(count_name, measures, count_col))
            .orderBy(period))


def pre_post_summary(df: DataFrame, measures: Mapping[str, ColumnOrName],
                     count_name: str = "crashes_total", count_col: ColumnOrName | None = None,
                     era_col: str = "era", year_col: str = "year", years: Years = "observed",
                     per_year_suffix: str = "_per_year", total_suffix: str = "_total") -> DataFrame:
    """Headline per era: totals, ``years_in_era`` and annualised values.

    With observed years the era group *is* the whole era, so the distinct-year
    count is one more aggregate in the same pass (no join, no driver round trip).
    """
    aggs = measure_aggs(count_name, measures, count_col)
    if isinstance(years, Mapping):
        out = df.groupBy(era_col).agg(*aggs).withColumn("years_in_era", _fixed_years(era_col, years))
    else:
        out = df.groupBy(era_col).agg(
            *aggs, F.count_distinct(as_col(year_col)).alias("years_in_era"))
    names = ([count_name] if count_name else []) + list(measures)
    per_year = {}
    for name in names:
        base = name[: -len(total_suffix)] if total_suffix and name.endswith(total_suffix) else name
        per_year[base + per_year_suffix] = name
    return annualise(out, per_year).orderBy(era_col)


def _labelled_totals(df: DataFrame, label: str, label_out: str, valid: Column,
                     measures: Mapping[str, ColumnOrName], count_name: str,
                     count_col: ColumnOrName | None, era_col: str) -> DataFrame:
    """Totals per ``upper(trim(label))`` and era, without the labels that are not ``valid``.

    Whether a label counts depends on the label alone, so it is decided once per group, as an
    aggregate: the filter stays above the aggregation and does not reach the (outer) label join and
    the collapsed facts below it, which the years of the whole input share. The key is
    never null for the same reason.
    """
    key = F.coalesce(normalise_key(label), F.lit(""))
    agg = (df.withColumn(label_out, key).withColumn("__valid", valid)
           .groupBy(label_out, era_col)
           .agg(*measure_aggs(count_name, measures, count_col), F.bool_and("__valid").alias("__valid")))
    return agg.filter("__valid").drop("__valid")


def segment_pre_post(df: DataFrame, segment: str, measures: Mapping[str, ColumnOrName],
                     population: DataFrame | None = None, pop_key: str | None = None,
                     pop_col: str = "population", segment_out: str = "segment",
                     count_name: str = "crashes", count_col: ColumnOrName | None = None,
                     era_col: str = "era", year_col: str = "year", years: Years = "observed",
                     per_capita: Sequence[str] | None = None, scale: float = 100000.0) -> DataFrame:
    """Segment x era totals, per-year values and per-capita rates.

    Rows without a segment (null or blank) are left out; other values are grouped
    on ``upper(trim(segment))``. Years come from the whole input (rows without a
    segment included). A segment missing from ``population`` keeps null rates.
    """
    agg = _labelled_totals(df, segment, segment_out, is_present(segment), measures, count_name, count_col, era_col)
    agg = with_years(agg, df, years, era_col, year_col)
    names = ([count_name] if count_name else []) + list(measures)
    agg = annualise(agg, {f"{n}_per_year": n for n in names})
    if population is not None:
        key = pop_key or segment_out
        pop = population.select(F.col(key).alias(segment_out), F.col(pop_col))
        agg = join_small(agg, pop, [segment_out], "left")
        rates = per_capita if per_capita is not None else list(measures)
        agg = agg.withColumns({
            f"{m}_per_100k_per_year" if scale == 100000.0 else f"{m}_per_{int(scale)}_per_year":
                per_scale(f"{m}_per_year", pop_col, scale)
            for m in rates
        })
    return agg.orderBy(segment_out, era_col)


def topk_shift(df: DataFrame, factor: str, measures: Mapping[str, ColumnOrName],
               k: int = 15, rank_era: str = "post", exclude: Sequence[str] = ("UNSPECIFIED",),
               factor_out: str = "factor", count_name: str = "crashes",
               count_col: ColumnOrName | None = None, era_col: str = "era",
               year_col: str = "year", years: Years = "observed") -> DataFrame:
    """Factor x era counts for the ``k`` factors with most events per year in
    ``rank_era`` (ties: factor ascending). Both eras of the chosen factors are
    returned, ordered by factor then era; a chosen factor absent in the other era
    has one row only.

    The top-k is a ``TakeOrderedAndProject`` (no full sort) and has at most ``k``
    rows, so the semi-join back is a bounded broadcast.
    """
    agg = _labelled_totals(df, factor, factor_out, ~is_missing_token(factor, exclude), measures,
                           count_name, count_col, era_col)
    agg = with_years(agg, df, years, era_col, year_col)
    agg = annualise(agg, {f"{count_name}_per_year": count_name})
    top = (agg.filter(F.col(era_col) == F.lit(rank_era))
           .orderBy(F.desc(f"{count_name}_per_year"), F.asc(factor_out))
           .limit(k)
           .select(factor_out))
    return (agg.join(F.broadcast(top), [factor_out], "left_semi")
            .orderBy(factor_out, era_col))


def window_rate(df: DataFrame, year_col: str, lo: int, hi: int,
                measures: Mapping[str, ColumnOrName], numerator: str, denominator: str,
                rate_name: str, per: float = 1000.0, count_name: str = "crashes",
                count_col: ColumnOrName | None = None) -> DataFrame:
    """Per-year totals inside the closed window [lo, hi] plus ``numerator * per /
    denominator`` (e.g. killed per 1,000 crashes)."""
    return (df.filter(F.col(year_col).between(lo, hi))
            .groupBy(year_col).agg(*measure_aggs(count_name, measures, count_col))
            .withColumn(rate_name, per_scale(numerator, denominator, per))
            .orderBy(year_col))


def missing_share(df: DataFrame, segment: str, value: str | None = None,
                  tokens: Sequence[str] = ("UNSPECIFIED",), segment_out: str = "segment",
                  count_col: ColumnOrName | None = None, missing_col: ColumnOrName | None = None
                  ) -> DataFrame:
    """Per segment: total events, events whose ``value`` is null / blank / a
    missing token, and their share; highest share first (ties: segment asc).

    Pre-aggregated input passes ``count_col`` and ``missing_col`` instead of
    ``value``.
    """
    seg_df = df.filter(is_present(segment)).withColumn(segment_out, normalise_key(segment))
    if missing_col is None:
        missing = F.sum(F.when(is_missing_token(value, tokens), F.lit(1)).otherwise(F.lit(0)))
    else:
        missing = F.sum(as_col(missing_col))
    return (seg_df.groupBy(segment_out)
            .agg(count_expr(count_col).alias("total"), missing.cast("long").alias("unspecified"))
            .withColumn("unspecified_share", safe_ratio("unspecified", "total"))
            .orderBy(F.desc("unspecified_share"), F.asc(segment_out)))


def pre_post_change(annual: DataFrame, year_col: str, measures: Sequence[str], cut: int) -> DataFrame:
    """Mean of an annual series before and from ``cut`` and the percentage drop,
    one row per measure: ``measure, pre_mean, post_mean, pct_drop``."""
    year = F.col(year_col)
    rows = []
    for m in measures:
        pre = F.avg(F.when(year < F.lit(cut), F.col(m).cast("double")))
        post = F.avg(F.when(year >= F.lit(cut), F.col(m).cast("double")))
        rows += [pre.alias(f"{m}__pre"), post.alias(f"{m}__post")]
    wide = annual.agg(*rows)
    structs = [F.struct(F.lit(m).alias("measure"), F.col(f"{m}__pre").alias("pre_mean"),
                        F.col(f"{m}__post").alias("post_mean")) for m in measures]
    long = wide.select(F.inline(F.array(*structs)))
    return long.withColumn("pct_drop", -pct_change("post_mean", "pre_mean"))
