"""Column-level building blocks.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen. ANSI mode is on by default in Spark 4, so
parsing and division use the ``try_*`` forms: a bad cell becomes null instead of
failing the job.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- text keys and missing tokens ------------------------------------------------

def normalise_key(c: ColumnOrName) -> Column:
    """``upper(trim(x))``: one group for 'Brooklyn', 'BROOKLYN ', 'brooklyn'."""
    return F.upper(F.trim(as_col(c)))


def is_present(c: ColumnOrName) -> Column:
    """Non-null and not blank after trimming spaces (null input -> false)."""
    c = as_col(c)
    return F.coalesce(c.isNotNull() & (F.trim(c) != F.lit("")), F.lit(False))


def is_missing_token(c: ColumnOrName, tokens: Iterable[str] = ()) -> Column:
    """True when the value is null, blank, or one of ``tokens`` after upper(trim).

    Never null, so it can be negated safely inside a filter.
    """
    key = normalise_key(c)
    cond = key.isNull() | (key == F.lit(""))
    toks = [t.strip().upper() for t in tokens]
    if toks:
        cond = cond | key.isin(toks)
    return F.coalesce(cond, F.lit(True))


# -- flags and eras ----------------------------------------------------------------

def flag(predicate: Column) -> Column:
    """0/1 integer flag; a null predicate counts as 0."""
    return F.when(predicate, F.lit(1)).otherwise(F.lit(0))


def era(year: ColumnOrName, cut: int, pre: str = "pre", post: str = "post") -> Column:
    """``post`` when year >= cut, else ``pre`` (a null year falls to ``pre``)."""
    return F.when(as_col(year) >= F.lit(cut), F.lit(post)).otherwise(F.lit(pre))


# -- dates -------------------------------------------------------------------------

def event_date(c: ColumnOrName, data_type: T.DataType | None = None,
               pattern: str = "MM/dd/yyyy") -> Column:
    """A DATE from text (parsed with ``pattern``, unparsable -> null) or from a
    date/timestamp column (truncated to its calendar day)."""
    c = as_col(c)
    if isinstance(data_type, T.StringType):
        return F.try_to_date(c, pattern)
    if isinstance(data_type, T.DateType):
        return c
    return F.to_date(c)


def date_from_parts(y: ColumnOrName, m: ColumnOrName, d: ColumnOrName) -> Column:
    """``yyyy-M-d`` assembled from integer parts; day 99, 30 February or a null
    part gives null (``concat_ws`` skips nulls, so the pattern no longer fits)."""
    text = F.concat_ws("-", as_col(y).cast("string"), as_col(m).cast("string"),
                       as_col(d).cast("string"))
    return F.try_to_date(text, "yyyy-M-d")


def month_key(date_col: ColumnOrName) -> Column:
    """``yyyy-MM`` period key."""
    return F.date_format(as_col(date_col), "yyyy-MM")


# -- cleaning ----------------------------------------------------------------------

def null_if_equal(c: ColumnOrName, sentinels: Iterable) -> Column:
    """Sentinel codes (e.g. HOUR = 99) become null; other values and nulls pass."""
    c = as_col(c)
    return F.when(c.isin(list(sentinels)), F.lit(None)).otherwise(c)


def null_outside(c: ColumnOrName, lo: float | None = None, hi: float | None = None,
                 zero_is_missing: bool = False, absolute: bool = False) -> Column:
    """Null when outside the closed range [lo, hi] (bounds kept), or exactly 0 when
    ``zero_is_missing``. ``absolute`` applies the range to ``abs(x)``."""
    c = as_col(c)
    x = F.abs(c) if absolute else c
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (x < F.lit(lo))
    if hi is not None:
        bad = bad | (x > F.lit(hi))
    if zero_is_missing:
        bad = bad | (c == F.lit(0))
    return F.when(bad, F.lit(None)).otherwise(c)


def clean_int(c: ColumnOrName) -> Column:
    """Text count -> int; anything that is not an integer becomes null."""
    return F.trim(as_col(c).cast("string")).try_cast("int")


# -- ratios ------------------------------------------------------------------------

def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den as double; null when den is 0 or null."""
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))


def per_scale(num: ColumnOrName, den: ColumnOrName, scale: float) -> Column:
    """num * scale / den (per 1,000 events, per 100k people, ...)."""
    return F.try_divide(as_col(num).cast("double") * F.lit(float(scale)),
                        as_col(den).cast("double"))


def pct_change(new: ColumnOrName, old: ColumnOrName) -> Column:
    """(new - old) / old * 100."""
    new, old = as_col(new).cast("double"), as_col(old).cast("double")
    return F.try_divide(new - old, old) * F.lit(100.0)
