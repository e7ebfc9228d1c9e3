"""Cleaning and preparation jobs.

Each step is one projection or one filter; chained ``withColumn`` calls are
replaced by a single ``withColumns`` so the plan has one Project per step.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from policypanel.functions.columns import (
    era,
    event_date,
    flag,
    is_missing_token,
    is_present,
    month_key,
    normalise_key,
    null_if_equal,
    null_outside,
)


def zero_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null counts -> 0 (column types kept)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType))
                           for c in columns})


def null_sentinels(df: DataFrame, sentinels: Mapping[str, Sequence]) -> DataFrame:
    """``{"HOUR": [99]}``: listed codes become null."""
    return df.withColumns({c: null_if_equal(c, vals) for c, vals in sentinels.items()})


def null_ranges(df: DataFrame, ranges: Mapping[str, Mapping]) -> DataFrame:
    """``{"LATITUDE": {"lo": 17, "hi": 77, "zero_is_missing": True}}``."""
    return df.withColumns({c: null_outside(c, **spec) for c, spec in ranges.items()})


def drop_missing(df: DataFrame, column: str, tokens: Sequence[str] = ("NULL", "0")) -> DataFrame:
    """Drop rows whose ``column`` is null, blank or a missing token (any case)."""
    return df.filter(~is_missing_token(column, tokens))


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    """Drop rows whose ``column`` is null or blank."""
    return df.filter(is_present(column))


def snake_case(name: str) -> str:
    return re.sub(r"[^0-9a-zA-Z]+", "_", name.strip()).strip("_").lower()


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Table-friendly names: ``CRASH DATE`` -> ``crash_date``."""
    return df.withColumnsRenamed({c: snake_case(c) for c in df.columns if snake_case(c) != c})


def clean_panel(df: DataFrame, year_col: str, window: tuple[int, int],
                critical: Sequence[str], sentinels: Mapping[str, Sequence] | None = None,
                ranges: Mapping[str, Mapping] | None = None) -> DataFrame:
    """Register cleaning: closed year window, drop rows null in a critical column,
    then sentinel and out-of-range values to null. Column set and order kept."""
    out = df.filter(F.col(year_col).between(*window))
    out = out.na.drop(subset=list(critical))
    if sentinels:
        out = null_sentinels(out, sentinels)
    if ranges:
        out = null_ranges(out, ranges)
    return out


@dataclass
class ObservedClean:
    """A cleaned panel whose counts are taken by whatever job first runs it to the end; they wait for that job."""

    cleaned: DataFrame
    _raw: Observation
    _clean: Observation
    _columns: Sequence[str]

    def stages(self) -> dict[str, int]:
        """Rows read, in the year window, and with all critical values."""
        got = self._raw.get
        return {k: got[k] for k in ("raw", "year_window", "critical_not_null")}

    def rows(self) -> int:
        return self._clean.get["rows"]

    def nulls(self) -> dict[str, int]:
        got = self._clean.get
        return {c: got[f"nulls_{i}"] for i, c in enumerate(self._columns)}


def clean_panel_observed(df: DataFrame, year_col: str, window: tuple[int, int], critical: Sequence[str],
                         sentinels: Mapping[str, Sequence] | None = None, ranges: Mapping[str, Mapping] | None = None,
                         nulls_of: Sequence[str] = ()) -> ObservedClean:
    """``clean_panel`` with its stage audit (rows raw, in the window, complete), the nulls left in ``nulls_of`` and the row
    count as by-products of the job that writes the result: one scan instead of one per question."""
    in_window = F.col(year_col).between(*window)
    complete = in_window
    for c in critical:
        complete = complete & F.col(c).isNotNull()
    raw, clean = Observation(), Observation()
    count = lambda cond: F.count_if(F.coalesce(cond, F.lit(False)))
    watched = df.observe(raw, F.count(F.lit(1)).alias("raw"), count(in_window).alias("year_window"), count(complete).alias("critical_not_null"))
    out = clean_panel(watched, year_col, window, critical, sentinels, ranges)
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(nulls_of)]
    return ObservedClean(out.observe(clean, F.count(F.lit(1)).alias("rows"), *nulls), raw, clean, list(nulls_of))


def clean_events(df: DataFrame, date_col: str, segment_col: str, keep: Sequence[str],
                 counts: Sequence[str], missing_tokens: Sequence[str] = ("NULL", "0"),
                 parsed_date: str | None = None, date_pattern: str = "MM/dd/yyyy",
                 rename: bool = True) -> DataFrame:
    """Event-log cleaning: drop rows without a date text, drop rows whose segment
    is null / blank / a missing token, normalise the segment, zero-fill counts,
    keep ``date, segment, *keep, *counts`` and rename to snake case.

    Rows whose date text does not parse are kept (the raw text is the output); set
    ``parsed_date`` to also emit a real DATE column.
    """
    out = drop_blank(df, date_col)
    out = drop_missing(out, segment_col, missing_tokens)
    out = out.withColumns({segment_col: normalise_key(segment_col),
                           **{c: F.coalesce(F.col(c), F.lit(0)) for c in counts}})
    cols = [F.col(date_col)]
    if parsed_date:
        cols.append(event_date(date_col, df.schema[date_col].dataType, date_pattern)
                    .alias(parsed_date))
    cols += [F.col(segment_col)] + [F.col(c) for c in keep] + [F.col(c) for c in counts]
    out = out.select(*cols)
    return snake_case_columns(out) if rename else out


def clean_events_wide(df: DataFrame, date_col: str, segment_col: str, keep: Sequence[str], counts: Sequence[str],
                      occurred: str, occurred_out: str = "INJURY_OCCURRED", missing_tokens: Sequence[str] = ("NULL", "0"),
                      date_pattern: str = "MM/dd/yyyy") -> DataFrame:
    """The filters of ``clean_events`` with each raw column beside its cleaned form: the date text and the parsed
    date (null if it does not parse), the segment and its key, the zero-filled counts, and a 0/1 flag of
    ``occurred`` being above zero. New columns are named after their source, ``CRASH DATE`` -> ``CRASH_DATE_FORMATTED``."""
    base = {c: re.sub(r"\s+", "_", c) for c in (date_col, segment_col, *counts)}
    out = drop_missing(drop_blank(df, date_col), segment_col, missing_tokens)
    filled = {c: F.coalesce(F.col(c), F.lit(0)) for c in counts}
    return out.select(
        F.col(date_col), event_date(date_col, df.schema[date_col].dataType, date_pattern).alias(f"{base[date_col]}_FORMATTED"),
        F.col(segment_col), normalise_key(segment_col).alias(f"{base[segment_col]}_CLEAN"), *[F.col(c) for c in keep],
        *[x.alias(f"{base[c]}_CLEAN") for c, x in filled.items()], flag(filled[occurred] > 0).alias(occurred_out))


def prepare_events(df: DataFrame, date_col: str, counts: Sequence[str], cut: int,
                   year_min: int | None = None, year_max: int | None = None,
                   date_pattern: str = "MM/dd/yyyy", date_out: str = "event_date",
                   year_out: str = "year", month_out: str = "month",
                   era_out: str = "era") -> DataFrame:
    """Analysis preparation: parse the date (text with ``date_pattern`` or a
    date/timestamp), drop rows whose date is missing, add year / ``yyyy-MM`` /
    era, keep years in [year_min, year_max] and zero-fill the counts.

    ``year_max=None`` keeps a trailing partial year, as the original job did; pass
    the last complete year to avoid counting it as a full post year.
    """
    dtype = df.schema[date_col].dataType
    if not isinstance(dtype, T.StringType):
        # Same window on the raw date/timestamp column: a plain range the Parquet
        # reader can use to skip row groups (year(...) itself is not pushable).
        if year_min is not None:
            df = df.filter(F.col(date_col) >= F.lit(f"{year_min}-01-01").cast(dtype))
        if year_max is not None:
            df = df.filter(F.col(date_col) < F.lit(f"{year_max + 1}-01-01").cast(dtype))
    parsed = df.withColumn(date_out, event_date(date_col, dtype, date_pattern))
    # A null date has a null year and fails the predicate as well.
    year = F.year(date_out)
    if year_min is not None and year_max is not None:
        keep = year.between(year_min, year_max)
    elif year_min is not None:
        keep = year >= F.lit(year_min)
    elif year_max is not None:
        keep = year <= F.lit(year_max)
    else:
        keep = F.col(date_out).isNotNull()
    parsed = parsed.filter(keep)
    parsed = parsed.withColumns({year_out: F.year(date_out), month_out: month_key(date_out)})
    parsed = parsed.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in counts})
    return parsed.withColumn(era_out, era(year_out, cut))
