"""Data profiling in a few passes.

The original jobs ran one action per column and statistic (73 jobs for one
profile). Here every statistic over many columns is one aggregate, and results
come back in long form (one row per column) through ``inline(array(struct))``,
which stays JVM-side. Distinct counts and modes go through an unpivot to
``(column, value)`` followed by two grouped aggregations: both are partial
(map-side) aggregations, so a value that holds a third of all rows collapses
before the shuffle, and no column's values are gathered into one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from policypanel.functions.columns import is_present
from policypanel.operators.ranks import exact_quantiles
from policypanel.sources.tables import inline_table

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _long_form(wide: DataFrame, columns: Sequence[str], fields: Mapping[str, str]) -> DataFrame:
    """Wide one-row aggregate ``{col}__{stat}`` -> rows ``column, stat...``."""
    structs = [F.struct(F.lit(c).alias("column"),
                        *[F.col(f"{c}__{stat}").alias(out) for stat, out in fields.items()])
               for c in columns]
    return wide.select(F.inline(F.array(*structs)))


def _unpivot(df: DataFrame, columns: Sequence[str], value_type: str = "string") -> DataFrame:
    """``column, value`` rows; -0.0 becomes 0.0, which it equals, before it turns to text."""
    def value(c: str) -> Column:
        dtype = df.schema[c].dataType
        x = F.col(c)
        if isinstance(dtype, (T.FloatType, T.DoubleType)):
            x = F.when(x == 0, F.lit(0).cast(dtype)).otherwise(x)
        return x.cast(value_type)

    structs = [F.struct(F.lit(c).alias("column"), value(c).alias("value")) for c in columns]
    return df.select(F.inline(F.array(*structs)))


#: The fields of a typed value.
_KINDS = {"i": "bigint", "d": "double", "t": "string"}


def _kind(df: DataFrame, c: str) -> tuple[str, Column]:
    """The field that holds the values of column ``c``, and the value: bigint, double (one zero) or text."""
    dtype, x = df.schema[c].dataType, F.col(c)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "i", x.cast("long")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "d", F.when(x == 0, F.lit(0.0)).otherwise(x.cast("double"))
    return "t", x.cast("string")


def _cell(place: int, kind: str, value: Column) -> Column:
    """``c, i, d, t`` of one value: its column's place, the value in the field of its kind, the others null."""
    fields = [(value if n == kind else F.lit(None)).cast(t).alias(n) for n, t in _KINDS.items()]
    return F.struct(F.lit(place).alias("c"), *fields)


def _unpivot_typed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``c`` (place in ``columns``), ``i, d, t``: every value in its own type, so that numbers are neither printed nor compared as text."""
    return df.select(F.inline(F.array(*[_cell(k, *_kind(df, c)) for k, c in enumerate(columns)])))


def _name(columns: Sequence[str], c: str = "c") -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in columns]), F.col(c) + 1).alias("column")


def row_audit(df: DataFrame, stages: Mapping[str, Column]) -> DataFrame:
    """Rows surviving each cleaning stage, from one scan: ``stage, rows``.

    ``stages`` maps a stage name to the cumulative predicate of that stage
    (``F.lit(True)`` for the raw count).
    """
    wide = df.agg(*[F.count_if(F.coalesce(pred, F.lit(False))).alias(f"s{i}")
                    for i, pred in enumerate(stages.values())])
    structs = [F.struct(F.lit(i).alias("step"), F.lit(name).alias("stage"),
                        F.col(f"s{i}").alias("rows"))
               for i, name in enumerate(stages)]
    return wide.select(F.inline(F.array(*structs)))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keyed counts for several columns in one shuffle: ``column, value, count``
    (values as text, null kept as its own group)."""
    return (_unpivot(df, columns).groupBy("column", "value")
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy("column", "value"))


def distinct_values(df: DataFrame, column: str, n: int = 30) -> DataFrame:
    """The first ``n`` distinct values in ascending order (a listing, limit is the feature)."""
    return df.select(column).distinct().orderBy(column).limit(n)


def key_counts_lexical(df: DataFrame, key: str) -> DataFrame:
    """Counts per key with the key as text, in text order ("1", "10", "2");
    a null key is its own group."""
    k = F.col(key).cast("string").alias(key)
    return df.groupBy(k).agg(F.count(F.lit(1)).alias("count")).orderBy(key)


def distinct_counts(df: DataFrame, columns: Sequence[str], approx: bool = False,
                    rsd: float = 0.01) -> DataFrame:
    """Distinct values per column with null counted as a value: ``column,
    distinct_values``. Exact: two partial aggregations over an unpivot instead of
    one job per column. ``approx=True``: one pass of HyperLogLog++ sketches
    (``approx_count_distinct`` with relative error ``rsd``), whose memory does not
    grow with the data, for very high-cardinality columns."""
    if approx:
        aggs = []
        for c in columns:
            has_null = F.max(F.col(c).isNull().cast("long"))
            aggs.append((F.approx_count_distinct(c, rsd) + has_null).alias(f"{c}__distinct"))
        return _long_form(df.agg(*aggs), columns, {"distinct": "distinct_values"})
    return (_unpivot_typed(df, columns).groupBy("c", "i", "d", "t").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("c").agg(F.count(F.lit(1)).alias("distinct_values"))
            .select(_name(columns), "distinct_values")
            .orderBy("column"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column, and nulls-or-blank for text columns, in one scan."""
    columns = list(columns or df.columns)
    texts = set(string_columns(df))
    aggs = []
    for c in columns:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"))
        blank = ~is_present(c) if c in texts else F.col(c).isNull()
        aggs.append(F.count_if(blank).alias(f"{c}__blank"))
    return _long_form(df.agg(*aggs), columns, {"nulls": "nulls", "blank": "null_or_blank"})


def range_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Numeric min / max per column (as double), one scan."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    return _long_form(df.agg(*aggs), columns, {"min": "min_value", "max": "max_value"})


def length_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text length (characters) min / max / avg over non-null values, one scan."""
    aggs = []
    for c in columns:
        n = F.length(F.col(c))
        aggs += [F.min(n).alias(f"{c}__min"), F.max(n).alias(f"{c}__max"),
                 F.avg(n).alias(f"{c}__avg")]
    return _long_form(df.agg(*aggs), columns,
                      {"min": "min_len", "max": "max_len", "avg": "avg_len"})


def modes(df: DataFrame, columns: Sequence[str], value_type: str = "double") -> DataFrame:
    """Most frequent value per column (null is eligible), ties to the smallest
    value: ``column, mode, mode_count``. ``min(struct(-count, value))`` keeps it a
    plain aggregate (no window over all values of a column)."""
    counted = (_unpivot(df, columns, value_type).groupBy("column", "value")
               .agg(F.count(F.lit(1)).alias("n")))
    best = counted.groupBy("column").agg(
        F.min(F.struct((-F.col("n")).alias("neg"), F.col("value").alias("value"))).alias("b"))
    return best.select("column", F.col("b.value").alias("mode"),
                       (-F.col("b.neg")).alias("mode_count"))


def summary_stats(df: DataFrame, columns: Sequence[str], accuracy: int = 10000,
                  exact_median: bool = False) -> DataFrame:
    """Mean, median (an actual element), mode with its count, and sample standard
    deviation per column: ``column, mean, median, mode, mode_count, stddev``.

    The median is approximate (``percentile_approx``, one pass) or, with ``exact_median``, found
    by rank selection in a few more scans of the column alone (``ranks.exact_quantiles``).
    """
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__stddev")]
        if not exact_median:
            aggs.append(F.percentile_approx(x, 0.5, accuracy).alias(f"{c}__median"))
    fields = {"mean": "mean", "stddev": "stddev"} | ({} if exact_median else {"median": "median"})
    moments = _long_form(df.agg(*aggs), columns, fields)
    if exact_median:
        median = exact_quantiles(df, columns, [0.5], accuracy).select("column", F.col("value").alias("median"))
        moments = moments.join(F.broadcast(median), ["column"], "left")
    # both sides have one row per column: a bounded broadcast.
    return (moments.join(F.broadcast(modes(df, columns)), ["column"], "left")
            .select("column", "mean", "median", "mode", "mode_count", "stddev")
            .orderBy("column"))


def quantile_rank_check(df: DataFrame, columns: Sequence[str], q: float,
                        accuracy: int) -> DataFrame:
    """The approximate quantile held against its own guarantee: ``column, rows,
    within_error``, true if the reported value's ranks meet ``q`` +- 1 / ``accuracy``
    of the non-null rows. A column without values is within the error."""
    quantiles = df.agg(*[F.percentile_approx(F.col(c).cast("double"), q, accuracy).alias(f"{c}__q")
                         for c in columns])
    aggs = []
    for c in columns:
        # scalar subqueries, which Spark answers by one aggregate
        x, v = F.col(c).cast("double"), quantiles.select(f"{c}__q").scalar()
        aggs += [F.count(c).alias(f"{c}__rows"), F.count_if(x < v).alias(f"{c}__below"),
                 F.count_if(x <= v).alias(f"{c}__upto")]
    ranks = df.agg(*aggs)
    ranks = ranks.withColumns({f"{c}__ok": (F.col(f"{c}__below") <= F.col(f"{c}__rows") * (q + 1 / accuracy))
                               & (F.col(f"{c}__upto") >= F.col(f"{c}__rows") * (q - 1 / accuracy))
                               for c in columns})
    return _long_form(ranks, columns, {"rows": "rows", "ok": "within_error"})


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Typed ``describe()``: ``column, count, mean, stddev, min, max``."""
    columns = list(columns or numeric_columns(df))
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    return _long_form(df.agg(*aggs), columns,
                      {"count": "count", "mean": "mean", "stddev": "stddev",
                       "min": "min", "max": "max"})


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Raw profile per column: rows, nulls, distinct values (null counted),
    numeric min / max and text min / max length, from one read.

    The table is unpivoted once to typed values and grouped to one row per distinct
    value with its count; every statistic of the profile is an aggregate of those.
    """
    columns = list(columns or df.columns)
    nums, texts = set(numeric_columns(df)), set(string_columns(df))
    places = lambda names: [k for k, c in enumerate(columns) if c in names]
    counted = _unpivot_typed(df, columns).groupBy("c", "i", "d", "t").agg(F.count(F.lit(1)).alias("n"))
    empty = F.coalesce(F.col("i").isNull() & F.col("d").isNull() & F.col("t").isNull(), F.lit(True))
    number = F.when(F.col("c").isin(places(nums)), F.coalesce(F.col("i").cast("double"), F.col("d"), F.col("t").try_cast("double")))
    length = F.when(F.col("c").isin(places(texts)), F.length("t"))
    stats = counted.groupBy("c").agg(
        F.sum("n").alias("rows"), F.sum(F.when(empty, F.col("n")).otherwise(0)).alias("nulls"),
        F.count(F.lit(1)).alias("distinct_values"), F.min(number).alias("min_value"), F.max(number).alias("max_value"),
        F.min(length).alias("min_len"), F.max(length).alias("max_len"))
    # one row per column on both sides: a bounded broadcast. A table without rows still has its columns.
    listed = inline_table(df.sparkSession, [(k, c) for k, c in enumerate(columns)], "c int, column string")
    zero = F.lit(0).cast("long")
    return (listed.join(F.broadcast(stats), ["c"], "left")
            .select("column", *[F.coalesce(x, zero).alias(x) for x in ("rows", "nulls", "distinct_values")],
                    "min_value", "max_value", "min_len", "max_len")
            .orderBy("column"))


def frequent_values(df: DataFrame, columns: Sequence[str], share: float) -> DataFrame:
    """``column, value, count``: every value (null included, as text) that holds at least ``share`` of the rows, with its exact count.

    Pass one keeps a bounded table of candidates per column (a frequent-items sketch, merged like a partial
    sum), sized so that no value with that share can be missing: a sketch of m places errs by at most 3.5 / m
    of the rows and names all that exceed twice its error. Pass two joins the rows with the candidates,
    which are broadcast as their number is bounded by ``share`` alone, and counts only those: of a key column nothing but candidates is shuffled.
    """
    if not 0 < share <= 1:
        raise ValueError(f"share {share} is not in (0, 1]")
    columns = list(columns)
    places = 1
    while places < 8 / share:
        places *= 2
    tracked = max(1, places * 3 // 4)
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.call_function("approx_top_k", _kind(df, c)[1], F.lit(tracked), F.lit(tracked)).alias(f"k{i}") for i, c in enumerate(columns)]

    def candidates(i: int, c: str) -> Column:
        return F.transform(f"k{i}", lambda x: _cell(i, _kind(df, c)[0], x["item"]))

    lists = [candidates(i, c) for i, c in enumerate(columns)]
    found = df.agg(*aggs).select("rows", F.inline(F.concat(*lists)))
    found = found.select("rows", *[F.col(n).alias(f"w{n}") for n in "cidt"])
    cells = _unpivot_typed(df, columns)
    same = F.lit(True)
    for n in "cidt":
        same = same & F.col(n).eqNullSafe(F.col(f"w{n}"))
    counted = cells.join(F.broadcast(found), same).groupBy("c", "i", "d", "t").agg(F.count(F.lit(1)).alias("count"), F.first("rows").alias("rows"))
    text = F.coalesce(F.col("i").cast("string"), F.col("d").cast("string"), F.col("t"))
    return (counted.where(F.col("count") >= F.lit(float(share)) * F.col("rows"))
            .select(_name(columns), text.alias("value"), "count").orderBy("column", F.desc("count"), "value"))


def frequent_modes(df: DataFrame, columns: Sequence[str], share: float) -> DataFrame:
    """``column, mode, mode_count``: the exact mode (ties: smallest text) of each column whose mode holds at least ``share``
    of the rows; null for the others, a key column for instance, which ``modes`` counts whole."""
    top = frequent_values(df, columns, share).groupBy("column").agg(
        F.min(F.struct((-F.col("count")).alias("m"), F.col("value").alias("value"))).alias("b"))
    listed = inline_table(df.sparkSession, [(c,) for c in columns], "column string")
    return (listed.join(F.broadcast(top), ["column"], "left")
            .select("column", F.col("b.value").alias("mode"), (-F.col("b.m")).alias("mode_count")).orderBy("column"))
