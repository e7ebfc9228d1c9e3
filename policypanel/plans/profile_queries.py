"""Registered profiling queries (one or two aggregate passes each)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from policypanel.operators import profiling as Pr
from policypanel.operators import sketches as Sk
from policypanel.operators.ranks import exact_quantiles as exact
from policypanel.plans import facts as X
from policypanel.plans import roles as R
from policypanel.session import scratch_path
from policypanel.sinks import write_parts

# Statistics from floating-point sums depend on summation order in the last
# bits; results are reported to 9 decimal places.
DIGITS = 9

LINE_CODES = ["l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax", "l_suppkey"]
LINE_STATS = ["l_quantity", "l_discount", "l_tax"]


def _rounded(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.round(c, DIGITS) for c in cols})


def row_audit(spark: SparkSession, d: str) -> DataFrame:
    panel = X.line_panel(spark, d)
    lo, hi = R.EVENT_WINDOW
    in_window = F.col("year").between(lo, hi)
    complete = in_window
    for c in R.PANEL_CRITICAL:
        complete = complete & F.col(c).isNotNull()
    return Pr.row_audit(panel, {"raw": F.lit(True), "year_window": in_window,
                                "critical_not_null": complete})


def value_counts(spark: SparkSession, d: str) -> DataFrame:
    return Pr.value_counts(X.table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


def distinct_listing(spark: SparkSession, d: str) -> DataFrame:
    return Pr.distinct_values(X.table(spark, d, "part"), "p_brand")


def quantile_1000(spark: SparkSession, d: str) -> DataFrame:
    return Pr.quantile_rank_check(X.table(spark, d, "lineitem"), LINE_STATS, 0.5, 1000)


#: Quantiles of the exact entry, and columns of small integers, exact prices and rates.
QUARTILES = [0.01, 0.25, 0.5, 0.75, 0.99]


def exact_quantiles(spark: SparkSession, d: str) -> DataFrame:
    return exact(X.table(spark, d, "lineitem"), ["l_extendedprice", "l_partkey", *LINE_STATS], QUARTILES)


#: Quantiles away from the steps of the coarse columns, so that a rank error below 1/1000 still gives the exact value.
WINDOW_QUANTILES = [0.21, 0.51, 0.89]


def _by_year(spark: SparkSession, d: str) -> DataFrame:
    return X.table(spark, d, "lineitem").withColumn("year", F.year("l_shipdate"))


def _eras() -> dict[str, tuple[int, int]]:
    lo, hi = R.EVENT_WINDOW
    return {"pre": (lo, R.EVENT_CUT - 1), "post": (R.EVENT_CUT, hi)}


def quantile_windows(spark: SparkSession, d: str) -> DataFrame:
    path = write_parts(Sk.quantile_sketches(_by_year(spark, d), "year", LINE_STATS), scratch_path(spark, "quantile_sketches"))
    stored = spark.read.parquet(path)
    lo, hi = R.EVENT_WINDOW
    return Sk.window_quantiles(stored, _eras() | {"all": (lo, hi)}, WINDOW_QUANTILES)


DISTINCT_SET_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"]


def distinct_sets(spark: SparkSession, d: str) -> DataFrame:
    path = write_parts(Sk.distinct_sketches(_by_year(spark, d), "year", DISTINCT_SET_COLUMNS), scratch_path(spark, "distinct_sketches"))
    eras = _eras()
    return Sk.distinct_sets(spark.read.parquet(path), eras["pre"], eras["post"])


#: Share of the rows from which a value is frequent.
FREQUENT_SHARE = 0.015
FREQUENT_COLUMNS = ["l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_returnflag"]


def frequent_values(spark: SparkSession, d: str) -> DataFrame:
    return Pr.frequent_values(X.table(spark, d, "lineitem"), FREQUENT_COLUMNS, FREQUENT_SHARE)


def frequent_modes(spark: SparkSession, d: str) -> DataFrame:
    return Pr.frequent_modes(X.table(spark, d, "lineitem"), FREQUENT_COLUMNS, FREQUENT_SHARE)


def key_counts_lexical(spark: SparkSession, d: str) -> DataFrame:
    return Pr.key_counts_lexical(X.table(spark, d, "customer"), "c_nationkey")


def distinct_counts(spark: SparkSession, d: str) -> DataFrame:
    return Pr.distinct_counts(X.table(spark, d, "lineitem"), LINE_CODES)


def null_counts(spark: SparkSession, d: str) -> DataFrame:
    return Pr.null_counts(X.line_panel(spark, d))


def range_stats(spark: SparkSession, d: str) -> DataFrame:
    return Pr.range_stats(X.table(spark, d, "lineitem"),
                          ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


def length_stats(spark: SparkSession, d: str) -> DataFrame:
    return Pr.length_stats(X.table(spark, d, "documents"), ["text", "lang", "source"])


def summary_stats(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(Pr.summary_stats(X.table(spark, d, "lineitem"), LINE_STATS, exact_median=True),
                    ["mean", "stddev"])


def describe_numeric(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(Pr.describe_numeric(X.table(spark, d, "lineitem"), LINE_STATS),
                    ["mean", "stddev"])


def profile_all(spark: SparkSession, d: str) -> DataFrame:
    # text lengths are null for numeric columns; reported as double so the
    # nullable column has one representation in every engine
    out = Pr.profile(X.table(spark, d, "part"))
    return out.withColumns({c: F.col(c).cast("double") for c in ("min_len", "max_len")})


PROFILE_QUERIES = {
    "row_audit": row_audit,
    "value_counts": value_counts,
    "distinct_listing": distinct_listing,
    "quantile_1000": quantile_1000,
    "exact_quantiles": exact_quantiles,
    "quantile_windows": quantile_windows,
    "distinct_sets": distinct_sets,
    "frequent_values": frequent_values,
    "frequent_modes": frequent_modes,
    "key_counts_lexical": key_counts_lexical,
    "distinct_counts": distinct_counts,
    "null_counts": null_counts,
    "range_stats": range_stats,
    "length_stats": length_stats,
    "summary_stats": summary_stats,
    "describe_numeric": describe_numeric,
    "profile_all": profile_all,
}
