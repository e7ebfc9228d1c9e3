"""Registered cleaning, source and sink queries.

The sink / source round trips write under the session's shared checkpoint folder
(``spark.checkpoint.dir``), never to a machine-local temporary directory, and
read the written data back as the query result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from policypanel import sinks
from policypanel.functions.columns import date_from_parts as make_date
from policypanel.functions.columns import flag
from policypanel.operators import clean as C
from policypanel.operators.joins import join_small
from policypanel.plans import facts as X
from policypanel.plans import roles as R
from policypanel.session import scratch_path
from policypanel.sources import csv as S
from policypanel.sources.tables import inline_table, scan_table


def panel_clean(spark: SparkSession, d: str) -> DataFrame:
    return C.clean_panel(X.line_panel(spark, d), "year", R.EVENT_WINDOW, R.PANEL_CRITICAL,
                         sentinels=R.PANEL_SENTINELS, ranges=R.PANEL_RANGES)


def events_clean(spark: SparkSession, d: str) -> DataFrame:
    return C.clean_events(X.line_text_events(spark, d), X.TEXT_DATE, X.TEXT_SEGMENT,
                          X.TEXT_KEEP, X.TEXT_COUNTS)


def events_prepare(spark: SparkSession, d: str) -> DataFrame:
    # rows, not annualised rates: a trailing partial year stays
    lo, _ = R.EVENT_WINDOW
    prepared = C.prepare_events(X.line_text_events(spark, d), X.TEXT_DATE, X.TEXT_COUNTS,
                                cut=R.EVENT_CUT, year_min=lo)
    return prepared.select(
        "l_orderkey", "l_linenumber",
        F.date_format("event_date", "yyyy-MM-dd").alias("event_date"),
        "year", "month", "era",
        F.col("QUANTITY").alias("quantity"), F.col("FATAL").alias("fatal"))


def events_clean_hostile(spark: SparkSession, d: str) -> DataFrame:
    return C.clean_events(X.hostile_text_events(spark, d), X.TEXT_DATE, X.TEXT_SEGMENT, X.TEXT_KEEP, X.TEXT_COUNTS)


def events_prepare_hostile(spark: SparkSession, d: str) -> DataFrame:
    # a bound inside the data, so that it has years to drop
    prepared = C.prepare_events(X.hostile_text_events(spark, d), X.TEXT_DATE, X.TEXT_COUNTS, cut=R.EVENT_CUT,
                                year_min=R.EVENT_WINDOW[0] + 1)
    return prepared.select(
        "l_orderkey", "l_linenumber", F.date_format("event_date", "yyyy-MM-dd").alias("event_date"),
        "year", "month", "era", F.col("QUANTITY").alias("quantity"), F.col("FATAL").alias("fatal"))


def events_wide(spark: SparkSession, d: str) -> DataFrame:
    wide = C.clean_events_wide(X.hostile_text_events(spark, d), X.TEXT_DATE, X.TEXT_SEGMENT, X.TEXT_KEEP, X.TEXT_COUNTS, "QUANTITY")
    named = C.snake_case_columns(wide)
    return named.withColumn("ship_date_formatted", F.date_format("ship_date_formatted", "yyyy-MM-dd"))


def panel_clean_hostile(spark: SparkSession, d: str) -> DataFrame:
    return C.clean_panel(X.hostile_panel(spark, d), "year", R.EVENT_WINDOW, R.PANEL_CRITICAL,
                         sentinels=R.PANEL_SENTINELS, ranges=R.PANEL_RANGES)


def panel_date_flag(spark: SparkSession, d: str) -> DataFrame:
    panel = X.hostile_panel(spark, d).select("l_orderkey", "l_linenumber", "year", "month")
    day = F.date_format(make_date("year", "month", "l_linenumber"), "yyyy-MM-dd")
    return panel.withColumns({"crash_date": day, "post": flag(F.col("year") >= R.EVENT_CUT)})


def date_from_parts(spark: SparkSession, d: str) -> DataFrame:
    li = X.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.year("l_shipdate").alias("y"), F.month("l_shipdate").alias("m"),
        (F.dayofmonth("l_shipdate") + F.col("l_linenumber")).alias("d"))
    return li.withColumn("event_date",
                         F.date_format(make_date("y", "m", "d"), "yyyy-MM-dd"))


# -- yearly extracts with drifting headers -----------------------------------------

# Canonical register-style columns of the yearly extracts and their types.
YEARLY_COLUMNS = {
    "ORDERKEY": "bigint", "LINENUMBER": "int", "YEAR": "int", "MONTH": "int",
    "QUANTITY": "double", "DISCOUNT": "double", "TAX": "double", "RETURNFLAG": "string",
}


def _header_variant(year: int, first: int, last: int) -> dict[str, str]:
    """How a year's extract names its columns (drift by era of the extract)."""
    names = {c: c for c in YEARLY_COLUMNS}
    if year < first + 2:                      # early files: lower-case measures
        names["DISCOUNT"], names["TAX"] = "discount", "tax"
    if year == last - 1:                      # a true UTF-8 byte-order mark
        names["ORDERKEY"] = "\ufeffORDERKEY"
    if year == last:                          # the same mark decoded as Latin-1
        names["ORDERKEY"] = "\u00ef\u00bb\u00bfORDERKEY"
    return names


def write_yearly_extracts(spark: SparkSession, d: str, root: str) -> dict[int, str]:
    """One CSV folder per year of lineitem, from its first to its last, each with its
    own header drift, extra columns and column order."""
    from concurrent.futures import ThreadPoolExecutor

    li = X.table(spark, d, "lineitem")
    ends = li.agg(F.year(F.min("l_shipdate")), F.year(F.max("l_shipdate"))).first()
    lo, hi = R.EVENT_WINDOW if ends[0] is None else ends

    def write(year: int) -> str:
        names = _header_variant(year, lo, hi)
        rows = X.in_years(li, "l_shipdate", year, year)
        cols = {
            "ORDERKEY": F.col("l_orderkey"), "LINENUMBER": F.col("l_linenumber"),
            "YEAR": F.year("l_shipdate"), "MONTH": F.month("l_shipdate"),
            "QUANTITY": F.col("l_quantity"), "DISCOUNT": F.col("l_discount"),
            "TAX": F.col("l_tax"), "RETURNFLAG": F.col("l_returnflag"),
        }
        order = list(YEARLY_COLUMNS)
        if year % 2 == 1:                     # odd years: measures before date parts
            order = order[:2] + order[4:] + order[2:4]
        select = [cols[c].alias(names[c]) for c in order]
        if year >= lo + 3:                    # later files carry extra columns
            select.append(F.col("l_linestatus").alias("LINESTATUS"))
        path = f"{root}/extract_{year}"
        rows.select(*select).write.mode("overwrite").option("header", True).csv(path)
        return path

    years = list(range(lo, hi + 1))
    # independent write jobs, submitted together
    with ThreadPoolExecutor(max_workers=len(years)) as pool:
        return dict(zip(years, pool.map(write, years)))


def yearly_union(spark: SparkSession, d: str) -> DataFrame:
    paths = write_yearly_extracts(spark, d, scratch_path(spark, "yearly"))
    return S.read_yearly(spark, paths, YEARLY_COLUMNS)


# -- CSV sources and sinks -------------------------------------------------------------

ORDERS_TEXT_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()),
    # declared numeric; the text values do not fit and read as null, row kept
    T.StructField("o_orderpriority", T.DoubleType()),
])


def csv_permissive(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "orders_csv")
    X.table(spark, d, "orders").write.mode("overwrite").option("header", True).csv(path)
    back = S.read_csv(spark, path, ORDERS_TEXT_SCHEMA)
    # the parsed timestamp is reported as ISO text (engine-neutral precision)
    return back.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


# Every misfit is made from the row's own key, so that the SQL can name it.
DIRTY_SCHEMA = "o_orderkey bigint, o_custkey int, o_orderstatus string, o_orderdate date, o_shippriority int"


def _write_dirty_orders(spark: SparkSession, d: str, path: str) -> None:
    """Orders as text, with cells that do not fit: customer keys with a letter, days that do not exist, words for numbers."""
    key = F.col("o_orderkey")
    X.table(spark, d, "orders").select(
        key.cast("string").alias("o_orderkey"),
        F.when(key % 7 == 0, F.concat(F.lit("C"), F.col("o_custkey"))).otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        "o_orderstatus",
        F.when(key % 11 == 0, F.lit("1996-02-31")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("o_orderdate"),
        F.when(key % 5 == 0, F.lit(None)).when(key % 13 == 0, F.lit("high")).otherwise(F.lit("1")).alias("o_shippriority"),
    ).write.mode("overwrite").option("header", True).csv(path)


def _split_orders(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    root = scratch_path(spark, "orders_dirty")
    _write_dirty_orders(spark, d, f"{root}/in")
    return S.split_rejects(spark, f"{root}/in", DIRTY_SCHEMA, f"{root}/split")


def csv_rejects(spark: SparkSession, d: str) -> DataFrame:
    _, rejects = _split_orders(spark, d)
    return rejects.select(F.contains("file", F.lit("orders_dirty")).alias("file_known"), "column", "value", "line")


def csv_good_rows(spark: SparkSession, d: str) -> DataFrame:
    good, _ = _split_orders(spark, d)
    return good.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


EVENTS_CLEAN_DDL = ("return_flag string, line_status string, supplier string, "
                    "quantity int, fatal int")
EVENTS_CLEAN_SCHEMA = "ship_date string, " + EVENTS_CLEAN_DDL


def csv_ctrl_a_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = sinks.write_ctrl_a(events_clean(spark, d), scratch_path(spark, "events_ctrl_a"))
    return sinks.read_ctrl_a(spark, path, EVENTS_CLEAN_SCHEMA)


ANNUAL_SCHEMA = ("year int, crashes bigint, persons_killed bigint, persons_injured bigint, "
                 "ped_killed bigint, cyc_killed bigint, mot_killed bigint")


def csv_single_part(spark: SparkSession, d: str) -> DataFrame:
    from policypanel.plans.queries import annual_summary
    path = sinks.write_single_csv(annual_summary(spark, d), scratch_path(spark, "annual"))
    return S.read_csv(spark, path, ANNUAL_SCHEMA)


PANEL_SCHEMA = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "year int, month int, l_quantity double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string")


def csv_parts_verify(spark: SparkSession, d: str) -> DataFrame:
    return sinks.write_verified(spark, panel_clean(spark, d), scratch_path(spark, "panel_csv"), PANEL_SCHEMA)


def write_audit(spark: SparkSession, d: str) -> DataFrame:
    """Stage counts, nulls after cleaning and the read-back of a cleaning write, all but the last taken in the write."""
    found = C.clean_panel_observed(X.line_panel(spark, d), "year", R.EVENT_WINDOW, R.PANEL_CRITICAL, R.PANEL_SENTINELS,
                                   R.PANEL_RANGES, nulls_of=["l_quantity", "l_discount", "l_tax"])
    path = sinks.write_parts(found.cleaned, scratch_path(spark, "panel_audit"), fmt="csv")
    counts = {**found.stages(), **{f"nulls {c}": n for c, n in found.nulls().items()}, "written": found.rows()}
    items = inline_table(spark, list(counts.items()), "item string, value bigint")
    back = sinks.rows_match(spark, found.rows(), path, PANEL_SCHEMA)
    return items.unionByName(back.select(F.lit("read back").alias("item"), F.col("rows_read").alias("value")))


TABLE_NAME = "policypanel_db.events_clean"


def _register_events(spark: SparkSession, d: str) -> str:
    root = scratch_path(spark, "catalog")
    data = sinks.write_ctrl_a(events_clean(spark, d), f"{root}/events_clean")
    # one table per call (the folder name is unique), so concurrent runs never
    # drop each other's table
    table = f"{TABLE_NAME}_{root.rsplit('-', 1)[-1]}"
    sinks.register_csv_table(spark, table, EVENTS_CLEAN_SCHEMA, data, header=False,
                             sep=sinks.CTRL_A, replace=True, database_location=f"{root}/db")
    return table


def table_register_scan(spark: SparkSession, d: str) -> DataFrame:
    return scan_table(spark, _register_events(spark, d), not_null=["ship_date"])


def table_artefact_scan(spark: SparkSession, d: str) -> DataFrame:
    """A text table registered without regard to its files' header lines: each shows as a row whose typed key is null."""
    root = scratch_path(spark, "artefacts")
    sinks.write_parts(panel_clean(spark, d), f"{root}/panel", fmt="csv")
    table = f"policypanel_db.panel_{root.rsplit('-', 1)[-1]}"
    sinks.register_csv_table(spark, table, PANEL_SCHEMA, f"{root}/panel", header=False, database_location=f"{root}/db")
    return scan_table(spark, table, not_null=["l_orderkey"])


def catalog_check(spark: SparkSession, d: str) -> DataFrame:
    table = _register_events(spark, d)
    found = sinks.catalog_check(spark, table, sample=5)
    count = lambda df, item: df.agg(F.lit(item).alias("item"), F.count(F.lit(1)).alias("value"))
    return (count(found["describe"], "columns")
            .unionByName(found["count"].select(F.lit("rows").alias("item"), F.col("total").alias("value")))
            .unionByName(count(found["sample"], "sample_rows")))


def table_publish(spark: SparkSession, d: str) -> DataFrame:
    """The rows of a table after two versions were published and a third was written but never switched to."""
    root = scratch_path(spark, "published")
    table = f"policypanel_db.events_{root.rsplit('-', 1)[-1]}"
    events = events_clean(spark, d)
    sinks.publish(spark, events.where("fatal = 1"), table, root, ["line_status"])
    sinks.publish(spark, events, table, root, ["line_status"])
    sinks.publish(spark, events.where("quantity > 25"), table, root, ["line_status"], switch=False)
    return spark.table(table)


def table_keep(spark: SparkSession, d: str) -> DataFrame:
    """The rows of a table that exists when it is to be created if absent."""
    root = scratch_path(spark, "kept")
    table = f"policypanel_db.kept_{root.rsplit('-', 1)[-1]}"
    events = events_clean(spark, d)
    sinks.publish(spark, events.where("fatal = 1"), table, root, replace=False)
    sinks.publish(spark, events, table, root, replace=False)
    return spark.table(table)


def inline_dim(spark: SparkSession, d: str) -> DataFrame:
    codes = inline_table(spark, [(r, k, u) for (r, k), u in R.UNIT_CODES.items()],
                         "n_regionkey int, n_nationkey int, unit string")
    nation = X.table(spark, d, "nation").select("n_nationkey", "n_regionkey", "n_name")
    labelled = join_small(nation, codes, ["n_regionkey", "n_nationkey"], "inner")
    customers = (X.table(spark, d, "customer").groupBy("c_nationkey")
                 .agg(F.count(F.lit(1)).alias("customers")))
    out = labelled.join(customers, labelled.n_nationkey == customers.c_nationkey, "left")
    return out.select("unit", "n_name", F.coalesce("customers", F.lit(0)).alias("customers"))


ETL_QUERIES = {
    "panel_clean": panel_clean,
    "events_clean": events_clean,
    "events_prepare": events_prepare,
    "events_clean_hostile": events_clean_hostile,
    "events_prepare_hostile": events_prepare_hostile,
    "events_wide": events_wide,
    "panel_clean_hostile": panel_clean_hostile,
    "panel_date_flag": panel_date_flag,
    "table_artefact_scan": table_artefact_scan,
    "date_from_parts": date_from_parts,
    "yearly_union": yearly_union,
    "csv_permissive": csv_permissive,
    "csv_rejects": csv_rejects,
    "csv_good_rows": csv_good_rows,
    "csv_ctrl_a_roundtrip": csv_ctrl_a_roundtrip,
    "csv_single_part": csv_single_part,
    "csv_parts_verify": csv_parts_verify,
    "write_audit": write_audit,
    "table_publish": table_publish,
    "table_keep": table_keep,
    "table_register_scan": table_register_scan,
    "catalog_check": catalog_check,
    "inline_dim": inline_dim,
}
