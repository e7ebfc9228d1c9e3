"""Fact derivations over the shared tables, shaped for scale.

Labels that live in another table (a customer's nation, a supplier's nation, a
part's brand) are attached *after* the big table has been collapsed to one row
per join key: ``groupBy(key)`` with one conditional aggregate per year of the
analysis window, or per era with the years as a bit mask. Spark runs that as a
partial (map-side) aggregation, so a key holding a third of all rows leaves each
map task as one row; the aggregate is hash-partitioned on the key, so the join
to the dimension reuses that partitioning and only the dimension side moves. The
wide rows are then turned back into ``(label, year, counts...)`` with
``inline(array(struct))`` and every operator consumes them through
``count_col`` (all measures are additive, so results are exact).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from policypanel.functions.columns import flag, is_missing_token
from policypanel.operators.aggregate import collapse_by_era, collapse_by_key, unpivot_periods, years_from_masks
from policypanel.operators.clean import prepare_events
from policypanel.operators.did import label_units
from policypanel.plans import roles
from policypanel.sources.tables import parquet_table

# Event-level count columns derived from a lineitem row.
LINE_MEASURES = ["persons_injured", "persons_killed", "ped_injured", "ped_killed",
                 "cyc_injured", "cyc_killed", "mot_injured", "mot_killed"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return parquet_table(spark, sf_dir, name)


def in_years(df: DataFrame, column: str, lo: int, hi: int) -> DataFrame:
    """Closed year window as a plain range on the raw date/timestamp column, so
    the Parquet reader can skip row groups."""
    dtype = df.schema[column].dataType
    return df.filter((F.col(column) >= F.lit(f"{lo}-01-01").cast(dtype))
                     & (F.col(column) < F.lit(f"{hi + 1}-01-01").cast(dtype)))


def nation_names(spark: SparkSession, sf_dir: str, names: Sequence[str] | None = None) -> DataFrame:
    """nationkey -> name (optionally only ``names``). No hint: the scan's size
    statistics decide (broadcast below ``spark.sql.autoBroadcastJoinThreshold``,
    sort-merge join above it)."""
    nation = table(spark, sf_dir, "nation")
    if names is not None:
        nation = nation.filter(F.col("n_name").isin(list(names)))
    return nation.select("n_nationkey", "n_name")


def customer_units(spark: SparkSession, sf_dir: str,
                   codes: Mapping[int, str] | None = None) -> DataFrame:
    """c_custkey -> unit for customers of the study nations, selected and
    labelled by nation code (a pushable ``IN`` filter plus a CASE chain).

    A literal filter over the customer scan is what lets Spark, at scale, build
    a runtime Bloom filter of the selected customer keys and apply it to the
    orders scan below the per-customer aggregate, so orders of other nations
    never reach the shuffle.
    """
    codes = codes if codes is not None else roles.UNIT_NATION_KEYS
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    labelled = label_units(cust, {(k,): u for k, u in codes.items()}, ["c_nationkey"], "unit")
    return labelled.select("c_custkey", "unit")


def customer_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """c_custkey -> nation name, all customers."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nat = nation_names(spark, sf_dir)
    return (cust.join(nat, cust.c_nationkey == nat.n_nationkey)
            .select("c_custkey", F.col("n_name").alias("segment")))


def supplier_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """s_suppkey -> nation name."""
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = nation_names(spark, sf_dir)
    return (sup.join(nat, sup.s_nationkey == nat.n_nationkey)
            .select("s_suppkey", F.col("n_name").alias("segment")))


def nation_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation name -> number of customers (the per-capita denominator)."""
    counts = (table(spark, sf_dir, "customer").groupBy("c_nationkey")
              .agg(F.count(F.lit(1)).alias("population")))
    nat = nation_names(spark, sf_dir)
    return (counts.join(nat, counts.c_nationkey == nat.n_nationkey)
            .select(F.col("n_name").alias("segment"), "population"))


# -- pivot by year, label, unpivot -------------------------------------------------

def per_key_by_year(df: DataFrame, key: str, year_col: str, years: Sequence[int],
                    measures: Mapping[str, str]) -> DataFrame:
    """One row per key: ``n_<y>`` events and ``<m>_<y>`` sums for every year."""
    return collapse_by_key(df, key, year_col, years, measures)


def by_year_long(df: DataFrame, ids: Sequence[str], years: Sequence[int],
                 measures: Sequence[str], count_name: str = "n") -> DataFrame:
    """Wide per-year columns back to rows ``ids..., year, n, measures...``."""
    return unpivot_periods(df, ids, years, measures, period="year", count_name=count_name)


# -- cross-unit panel on orders ----------------------------------------------------

def order_unit_facts(spark: SparkSession, sf_dir: str, units: Sequence[str] = roles.UNITS,
                     window: tuple[int, int] = roles.DID_WINDOW,
                     subgroup: str = roles.SUBGROUP_PRIORITY,
                     only_subgroup: bool = False) -> DataFrame:
    """``unit, year, n, n_sub, price``: orders per study unit and year, with the
    subgroup count and the exact (decimal) price total. ``only_subgroup`` reads
    the orders of the subgroup alone (a filter pushed into the scan)."""
    years = list(range(window[0], window[1] + 1))
    orders = in_years(table(spark, sf_dir, "orders"), "o_orderdate", *window)
    if only_subgroup:
        orders = orders.filter(F.col("o_orderpriority") == F.lit(subgroup))
    ev = orders.select(
        "o_custkey",
        F.year("o_orderdate").alias("year"),
        flag(F.col("o_orderpriority") == F.lit(subgroup)).alias("sub"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
    )
    wide = per_key_by_year(ev, "o_custkey", "year", years, {"n_sub": "sub", "price": "price"})
    cu = customer_units(spark, sf_dir, {k: u for k, u in roles.UNIT_NATION_KEYS.items()
                                        if u in units})
    labelled = wide.join(cu, wide.o_custkey == cu.c_custkey)
    return by_year_long(labelled, ["unit"], years, ["n_sub", "price"])


# -- within-unit event log on lineitem ----------------------------------------------

def line_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem rows with the event-log count columns."""
    li = table(spark, sf_dir, "lineitem")
    injured = F.col("l_quantity").cast("int")
    killed = flag(F.col("l_linestatus") == F.lit(roles.FATAL_STATUS))
    cols = {"persons_injured": injured, "persons_killed": killed}
    for cat, code in roles.CATEGORY_FLAGS.items():
        is_cat = F.col("l_returnflag") == F.lit(code)
        cols[f"{cat}_injured"] = F.when(is_cat, injured).otherwise(F.lit(0))
        cols[f"{cat}_killed"] = F.when(is_cat, killed).otherwise(F.lit(0))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                     *[c.alias(n) for n, c in cols.items()])


def prepared_lines(spark: SparkSession, sf_dir: str,
                   window: tuple[int | None, int | None] = roles.EVENT_WINDOW) -> DataFrame:
    """The prepared event log; ``window=(None, None)`` keeps every year."""
    lo, hi = window
    return prepare_events(line_events(spark, sf_dir), "l_shipdate", LINE_MEASURES,
                          cut=roles.EVENT_CUT, year_min=lo, year_max=hi)


def line_label_facts(spark: SparkSession, sf_dir: str, key: str, mapping: DataFrame,
                     map_key: str, label: str, measures: Sequence[str],
                     lines: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``label, era, n, measures...`` from lineitem collapsed per ``key`` to one cell per
    era and joined (left: events without a key, or with one that ``mapping`` lacks, keep a
    null label), plus ``era, years_in_era`` of the whole event log.

    Both come from the one collapsed aggregate: the years from its masks, before any label.
    """
    lo, hi = roles.EVENT_WINDOW
    eras = ("pre", "post")
    lines = prepared_lines(spark, sf_dir) if lines is None else lines
    wide = collapse_by_era(lines, key, "era", "year", lo, hi,
                           {m: m for m in measures}, eras)
    labelled = wide.join(mapping, wide[key] == mapping[map_key], "left")
    # the same cells for both, so that they read one shared aggregate exchange
    cells = [*measures, "years_mask"]
    return (unpivot_periods(labelled, [label], eras, cells, period="era"),
            years_from_masks(unpivot_periods(wide, [], eras, cells, period="era")))


def part_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("factor_raw"))


def order_segment_missing(spark: SparkSession, sf_dir: str,
                          tokens: Sequence[str] = roles.UNSPECIFIED_TOKENS) -> DataFrame:
    """``segment, n, missing`` per customer (collapsed before the join), for the
    unspecified-value audit of ``o_orderpriority`` over all orders."""
    per_cust = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(is_missing_token("o_orderpriority", tokens)).alias("missing"))
    cn = customer_nations(spark, sf_dir)
    return (per_cust.join(cn, per_cust.o_custkey == cn.c_custkey, "left")
            .select("segment", "n", "missing"))


# -- register-style panel and raw text events on lineitem ------------------------------

def line_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register-like panel: integer keys and date parts plus coded values."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"),
        "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


# Raw event-log view: text date and spaced column names, as a CSV extract has them.
TEXT_DATE = "SHIP DATE"
TEXT_SEGMENT = "RETURN FLAG"
TEXT_KEEP = ["LINE STATUS", "SUPPLIER"]
TEXT_COUNTS = ["QUANTITY", "FATAL"]


def line_text_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem as a raw text extract would deliver it: the date as
    ``MM/dd/yyyy`` text, codes as text, counts as integers."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.date_format("l_shipdate", "MM/dd/yyyy").alias(TEXT_DATE),
        F.col("l_returnflag").alias(TEXT_SEGMENT),
        F.col("l_linestatus").alias("LINE STATUS"),
        F.col("l_suppkey").cast("string").alias("SUPPLIER"),
        F.col("l_quantity").cast("int").alias("QUANTITY"),
        flag(F.col("l_linestatus") == F.lit(roles.FATAL_STATUS)).alias("FATAL"))


# -- hostile cells: what messy extracts hold, made from the rows' own keys ---------------------

def _every(n: int, key: str = "l_orderkey") -> Column:
    return F.col(key) % n == 0


def hostile_text_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``line_text_events`` with missing and blank dates, dates that do not exist, missing tokens,
    blanks and case drift in the segment, and null counts: every filter has rows to drop."""
    df = line_text_events(spark, sf_dir)
    date, seg, (qty, fatal) = F.col(TEXT_DATE), F.col(TEXT_SEGMENT), TEXT_COUNTS
    return df.withColumns({
        TEXT_DATE: F.when(_every(17), F.lit(None)).when(_every(19), F.lit("  ")).when(_every(23), F.lit("not a date"))
                    .when(_every(29), F.lit("02/30/1996")).otherwise(date),
        TEXT_SEGMENT: F.when(_every(31), F.lit(None)).when(_every(37), F.lit(" ")).when(_every(11), F.lit(" null"))
                       .when(_every(13), F.lit("0 ")).when(_every(7), F.concat(F.lit(" "), F.lower(seg), F.lit(" "))).otherwise(seg),
        qty: F.when(_every(5), F.lit(None)).otherwise(F.col(qty)),
        fatal: F.when(_every(3), F.lit(None)).otherwise(F.col(fatal)),
    })


def hostile_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``line_panel`` with null keys, years and months."""
    gaps = {"l_partkey": 7, "l_suppkey": 11, "l_quantity": 13, "year": 17, "month": 5}
    return line_panel(spark, sf_dir).withColumns({c: F.when(~_every(n), F.col(c)) for c, n in gaps.items()})


def hostile_lines(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """Prepared events whose ``key`` is null (all of one year, which then counts for the years per era alone) or unknown."""
    lines = prepared_lines(spark, sf_dir)
    return lines.withColumn(key, F.when(F.col("year") == roles.EVENT_CUT - 1, F.lit(None)).when(_every(6), F.lit(-1)).otherwise(F.col(key)))


def hostile_label(df: DataFrame, key: str, label: str) -> DataFrame:
    """Labels with gaps, blanks, missing tokens and case drift."""
    x = F.col(label)
    return df.withColumn(label, F.when(_every(10, key), F.lit(None)).when(_every(9, key), F.lit("  "))
                         .when(_every(8, key), F.lit(" unspecified")).when(_every(3, key), F.concat(F.lower(x), F.lit(" "))).otherwise(x))
