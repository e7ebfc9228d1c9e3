"""The registered queries: each is ``(spark, sf_dir) -> DataFrame`` over the
shared tables, built only from the library's operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import policypanel.operators.did as D  # noqa: E402  (module, not the did() function)
import policypanel.operators.prepost as P
from policypanel.plans import facts as X
from policypanel.plans import roles as R

Query = Callable[[SparkSession, str], DataFrame]

# -- cross-unit difference-in-differences ------------------------------------------


# The control level is a mean of a few doubles; its last bits depend on the
# summation order (partitioning), so estimates are reported to 9 decimals.
DIGITS = 9


# Levels of summed prices are millions, so their estimates keep fewer decimals.
SUM_DIGITS = 4


def _did(facts: DataFrame, cut: int, divisors, count_col: str, measure: str | None = None) -> DataFrame:
    est = D.did_estimate(facts, "unit", "year", R.TREATED, R.CONTROLS, cut, measure=measure,
                         divisors=divisors, count_col=count_col)
    digits = DIGITS if measure is None else SUM_DIGITS
    return est.select(*[F.round(c, digits).alias(c) for c in est.columns])


def did_total(spark: SparkSession, d: str) -> DataFrame:
    return _did(X.order_unit_facts(spark, d), R.DID_CUT, R.DID_DIVISORS, "n")


def did_subgroup(spark: SparkSession, d: str) -> DataFrame:
    return _did(X.order_unit_facts(spark, d), R.DID_CUT, R.DID_DIVISORS, "n_sub")


def did_placebo(spark: SparkSession, d: str) -> DataFrame:
    facts = X.order_unit_facts(spark, d).filter(F.col("year") < R.DID_CUT)
    return _did(facts, R.PLACEBO_CUT, R.PLACEBO_DIVISORS, "n")


def did_summary(spark: SparkSession, d: str) -> DataFrame:
    # One fact table feeds all three estimates; Spark reuses its exchange.
    facts = X.order_unit_facts(spark, d)
    return D.did_summary({
        "real_total": _did(facts, R.DID_CUT, R.DID_DIVISORS, "n"),
        "real_subgroup": _did(facts, R.DID_CUT, R.DID_DIVISORS, "n_sub"),
        "placebo_total": _did(facts.filter(F.col("year") < R.DID_CUT), R.PLACEBO_CUT,
                              R.PLACEBO_DIVISORS, "n"),
    })


def did_total_sum(spark: SparkSession, d: str) -> DataFrame:
    return _did(X.order_unit_facts(spark, d), R.DID_CUT, R.DID_DIVISORS, "n", "price")


def did_subgroup_sum(spark: SparkSession, d: str) -> DataFrame:
    facts = X.order_unit_facts(spark, d, only_subgroup=True)
    return _did(facts, R.DID_CUT, R.DID_DIVISORS, "n", "price")


def did_placebo_sum(spark: SparkSession, d: str) -> DataFrame:
    facts = X.order_unit_facts(spark, d).filter(F.col("year") < R.DID_CUT)
    return _did(facts, R.PLACEBO_CUT, R.PLACEBO_DIVISORS, "n", "price")


def unit_era(spark: SparkSession, d: str) -> DataFrame:
    facts = X.order_unit_facts(spark, d).filter(F.col("n") > 0)
    table = D.unit_era(facts, "unit", "year", R.DID_CUT, measure="price",
                       divisors=R.DID_DIVISORS, count_col="n")
    per_year = F.round("fatalities_per_year", SUM_DIGITS)
    return table.withColumns({"fatalities": F.col("fatalities").cast("double"),
                              "fatalities_per_year": per_year})


def unit_year_panel(spark: SparkSession, d: str) -> DataFrame:
    panel = D.unit_panel(X.order_unit_facts(spark, d), "unit", "year", measure="price",
                         count_col="n")
    return panel.withColumn("total_fatalities", F.col("total_fatalities").cast("double"))


def did_flags(spark: SparkSession, d: str) -> DataFrame:
    orders = X.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = X.table(spark, d, "customer").select("c_custkey", "c_nationkey")
    nation = X.table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    coded = cust.join(nation, cust.c_nationkey == nation.n_nationkey)
    units = D.label_units(coded, R.UNIT_CODES, ["n_regionkey", "n_nationkey"], "unit")
    rows = orders.join(units.select("c_custkey", "unit"), orders.o_custkey == units.c_custkey)
    rows = rows.select("o_orderkey", "unit", F.year("o_orderdate").alias("year"))
    return D.did_flags(rows, "unit", R.TREATED, "year", R.DID_CUT)


# -- within-unit pre/post on the event log -----------------------------------------

def annual_summary(spark: SparkSession, d: str) -> DataFrame:
    # totals, not annualised rates: every year from the first on
    ev = X.prepared_lines(spark, d, window=(R.EVENT_WINDOW[0], None))
    return P.period_summary(ev, "year", {
        "persons_killed": "persons_killed", "persons_injured": "persons_injured",
        "ped_killed": "ped_killed", "cyc_killed": "cyc_killed", "mot_killed": "mot_killed",
    }, count_name="crashes")


def pre_post_summary(spark: SparkSession, d: str) -> DataFrame:
    ev = X.prepared_lines(spark, d)
    return P.pre_post_summary(ev, {
        "killed_total": "persons_killed", "injured_total": "persons_injured",
        "ped_killed_total": "ped_killed", "cyc_killed_total": "cyc_killed",
        "mot_killed_total": "mot_killed",
    }, count_name="crashes_total")


def category_pre_post(spark: SparkSession, d: str) -> DataFrame:
    ev = X.prepared_lines(spark, d)
    cats = ["ped_injured", "ped_killed", "cyc_injured", "cyc_killed", "mot_injured", "mot_killed"]
    return P.pre_post_summary(ev, {c: c for c in cats}, count_name=None, total_suffix="")


def segment_pre_post(spark: SparkSession, d: str) -> DataFrame:
    facts, years = X.line_label_facts(spark, d, "l_suppkey", X.supplier_nations(spark, d),
                                      "s_suppkey", "segment", ["persons_killed", "persons_injured"])
    return P.segment_pre_post(
        facts, "segment", {"killed": "persons_killed", "injured": "persons_injured"},
        population=X.nation_population(spark, d), pop_key="segment", count_col="n", years=years)


def topk_shift(spark: SparkSession, d: str) -> DataFrame:
    facts, years = X.line_label_facts(spark, d, "l_partkey", X.part_brands(spark, d),
                                      "p_partkey", "factor_raw", ["persons_killed"])
    return P.topk_shift(facts, "factor_raw", {"killed": "persons_killed"}, k=R.TOP_K,
                        count_col="n", years=years)


def segment_pre_post_hostile(spark: SparkSession, d: str) -> DataFrame:
    labels = X.hostile_label(X.supplier_nations(spark, d), "s_suppkey", "segment")
    facts, years = X.line_label_facts(spark, d, "l_suppkey", labels, "s_suppkey", "segment", ["persons_killed", "persons_injured"],
                                      X.hostile_lines(spark, d, "l_suppkey"))
    return P.segment_pre_post(
        facts, "segment", {"killed": "persons_killed", "injured": "persons_injured"},
        population=X.nation_population(spark, d), pop_key="segment", count_col="n", years=years)


def topk_shift_hostile(spark: SparkSession, d: str) -> DataFrame:
    labels = X.hostile_label(X.part_brands(spark, d), "p_partkey", "factor_raw")
    facts, years = X.line_label_facts(spark, d, "l_partkey", labels, "p_partkey", "factor_raw", ["persons_killed"],
                                      X.hostile_lines(spark, d, "l_partkey"))
    return P.topk_shift(facts, "factor_raw", {"killed": "persons_killed"}, k=R.TOP_K,
                        count_col="n", years=years)


def monthly_series(spark: SparkSession, d: str) -> DataFrame:
    ev = X.prepared_lines(spark, d, window=(None, None))
    return P.period_summary(ev, "month", {"killed": "persons_killed",
                                          "injured": "persons_injured"}, count_name="crashes")


def window_rate(spark: SparkSession, d: str) -> DataFrame:
    ev = X.prepared_lines(spark, d)
    lo, hi = R.ANOMALY_WINDOW
    return P.window_rate(ev, "year", lo, hi, {"killed": "persons_killed",
                                              "injured": "persons_injured"},
                         "killed", "crashes", "fatality_rate_per_1k_crashes")


def missing_share(spark: SparkSession, d: str) -> DataFrame:
    facts = X.order_segment_missing(spark, d)
    return P.missing_share(facts, "segment", count_col="n", missing_col="missing")


def pre_post_change(spark: SparkSession, d: str) -> DataFrame:
    return P.pre_post_change(annual_summary(spark, d), "year",
                             ["ped_killed", "persons_killed"], R.EVENT_CUT)


QUERIES: dict[str, Query] = {
    "did_total": did_total,
    "did_subgroup": did_subgroup,
    "did_placebo": did_placebo,
    "did_summary": did_summary,
    "did_total_sum": did_total_sum,
    "did_subgroup_sum": did_subgroup_sum,
    "did_placebo_sum": did_placebo_sum,
    "unit_era": unit_era,
    "unit_year_panel": unit_year_panel,
    "did_flags": did_flags,
    "annual_summary": annual_summary,
    "pre_post_summary": pre_post_summary,
    "segment_pre_post": segment_pre_post,
    "category_pre_post": category_pre_post,
    "topk_shift": topk_shift,
    "segment_pre_post_hostile": segment_pre_post_hostile,
    "topk_shift_hostile": topk_shift_hostile,
    "monthly_series": monthly_series,
    "window_rate": window_rate,
    "missing_share": missing_share,
    "pre_post_change": pre_post_change,
}

from policypanel.plans.etl_queries import ETL_QUERIES  # noqa: E402
from policypanel.plans.profile_queries import PROFILE_QUERIES  # noqa: E402

QUERIES.update(ETL_QUERIES)
QUERIES.update(PROFILE_QUERIES)

COVERS: dict[str, str] = {
    "did_total": "N1 N2 N3 F5 F11 P15 P19 J3",
    "did_total_sum": "C11",
    "did_subgroup_sum": "C12",
    "did_placebo_sum": "C13",
    "unit_era": "C10",
    "did_subgroup": "F6",
    "did_placebo": "F7",
    "did_summary": "C14 U1",
    "unit_year_panel": "C9 A4 O1",
    "did_flags": "P5 P6 P7 F5",
    "annual_summary": "C1 A3",
    "pre_post_summary": "C2 P8 P15 J3 U2",
    "segment_pre_post": "C3 P16 P11 N4 N5",
    "segment_pre_post_hostile": "J1 J3 F1 N10",
    "topk_shift_hostile": "F10",
    "events_clean_hostile": "F1 F2 P4",
    "events_prepare_hostile": "F4 F9 P4 P12 N9",
    "events_wide": "P6 P12",
    "panel_clean_hostile": "F8",
    "panel_date_flag": "P6 P13",
    "table_artefact_scan": "N7",
    "category_pre_post": "C4",
    "topk_shift": "C5 O3 J2 F11 N6",
    "monthly_series": "C6 P14",
    "window_rate": "C7 F3 P17",
    "missing_share": "C8 A5 P18 O2 N12",
    "pre_post_change": "C15 P19",
    "panel_clean": "C18 P9 P10 N8",
    "events_clean": "C19 P1 P2 P11",
    "events_prepare": "C20 P3 P12 P14",
    "date_from_parts": "P13",
    "yearly_union": "S2 S3 S4 U1",
    "csv_permissive": "S1",
    "csv_rejects": "S1",
    "csv_good_rows": "S1",
    "csv_ctrl_a_roundtrip": "K3",
    "csv_single_part": "K1",
    "csv_parts_verify": "K2 S6",
    "write_audit": "A1 A15 A18 S6",
    "table_publish": "K2 K4",
    "table_keep": "K4",
    "table_register_scan": "K4 S5",
    "inline_dim": "S7",
    "row_audit": "A1 A18",
    "value_counts": "A2",
    "distinct_listing": "A13",
    "quantile_1000": "A10",
    "exact_quantiles": "A9 A20",
    "quantile_windows": "A10",
    "distinct_sets": "A14 U2",
    "frequent_values": "A11 A13",
    "frequent_modes": "A11",
    "catalog_check": "K5 O5",
    "key_counts_lexical": "A19 O6",
    "distinct_counts": "A14 U2",
    "null_counts": "A15 A16",
    "range_stats": "A6",
    "length_stats": "A17",
    "summary_stats": "A7 A8 A9 A10 A11 A20 C17 O4",
    "describe_numeric": "A12",
    "profile_all": "C16",
}
