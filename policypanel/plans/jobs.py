"""End-to-end jobs: the original study's batch jobs, re-expressed with the
library's operators and parameterised by presets (``policypanel.schemas``).

Each job returns its outputs as DataFrames (already written where the job
writes), instead of printing them. A prepared frame that feeds several outputs is
written once as Parquet under the shared checkpoint folder and read back (a
lineage cut that survives executor loss), with only the needed columns, instead
of being cached whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from policypanel import schemas as SC
from policypanel import sinks
from policypanel.functions.columns import is_missing_token, normalise_key
from policypanel.operators import clean as C
from policypanel.operators import did as D
from policypanel.operators import prepost as P
from policypanel.operators import profiling as Pr
from policypanel.session import scratch_path
from policypanel.sources.csv import read_csv, read_yearly
from policypanel.sources.tables import inline_table


# Fixed value: the analysed factor column of the collision log.
FACTOR = "CONTRIBUTING FACTOR VEHICLE 1"


def materialise(spark: SparkSession, df: DataFrame, name: str,
                partition_by: Sequence[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder, read it back."""
    path = sinks.write_parts(df, scratch_path(spark, name), "parquet", partition_by=partition_by)
    return spark.read.parquet(path)


# -- register: clean, write, register -----------------------------------------------------

def clean_register_job(spark: SparkSession, yearly_paths: Mapping[int, str], out_path: str,
                       table: str | None = None, partition_by: Sequence[str] = ("YEAR",)
                       ) -> dict[str, DataFrame]:
    """Yearly extracts -> one scan -> cleaned panel written as CSV parts (one folder per year, so year
    windows prune folders), with the stage audit and the nulls left observed in that write -> read-back
    check -> optional external table + catalog check."""
    canonical = dict(SC.REGISTER_COLUMNS)
    raw = read_yearly(spark, yearly_paths, canonical)
    found = C.clean_panel_observed(raw, "YEAR", SC.REGISTER_WINDOW, SC.REGISTER_CRITICAL, SC.REGISTER_SENTINELS,
                                   SC.REGISTER_RANGES, nulls_of=["HOUR", "MINUTE", "LATITUDE", "LONGITUD"])
    parts = list(partition_by)
    # files are of one year each, so a task writes few folders without a shuffle, and the counts are those of the write
    sinks.write_parts(found.cleaned, out_path, fmt="csv", partition_by=parts or None)
    # partition columns live in the folder names and come last in the table
    cols = [(n, t) for n, t in SC.REGISTER_COLUMNS if n not in parts] + \
           [(n, t) for n, t in SC.REGISTER_COLUMNS if n in parts]
    ddl = ", ".join(f"{n} {t}" for n, t in cols)
    out = {"audit": inline_table(spark, [(i, k, n) for i, (k, n) in enumerate(found.stages().items())], "step int, stage string, rows bigint"),
           "nulls_after": inline_table(spark, list(found.nulls().items()), "column string, nulls bigint"),
           "verify": sinks.rows_match(spark, found.rows(), out_path, ddl)}
    if table:
        sinks.register_csv_table(spark, table, ddl, out_path, header=True, replace=True,
                                 partition_by=parts or None)
        out.update(sinks.catalog_check(spark, table))
    return out


# -- collision log: clean, write with 0x01, register ---------------------------------------

CLEAN_EVENTS_DDL = ("crash_date string, borough string, contributing_factor_vehicle_1 string, "
                    "vehicle_type_code_1 string, number_of_persons_injured int, "
                    "number_of_persons_killed int")


def clean_events_job(spark: SparkSession, csv_path: str, out_path: str,
                     table: str | None = None) -> dict[str, DataFrame]:
    raw = read_csv(spark, csv_path, SC.collision_schema())
    cleaned = C.clean_events(raw, "CRASH DATE", "BOROUGH",
                             ["CONTRIBUTING FACTOR VEHICLE 1", "VEHICLE TYPE CODE 1"],
                             ["NUMBER OF PERSONS INJURED", "NUMBER OF PERSONS KILLED"],
                             missing_tokens=SC.BOROUGH_MISSING_TOKENS)
    sinks.write_ctrl_a(cleaned, out_path)
    out = {"cleaned": sinks.read_ctrl_a(spark, out_path, CLEAN_EVENTS_DDL)}
    if table:
        sinks.register_csv_table(spark, table, CLEAN_EVENTS_DDL, out_path, header=False,
                                 sep=sinks.CTRL_A, replace=True)
        out.update(sinks.catalog_check(spark, table))
    return out


def enrich_events_job(spark: SparkSession, csv_path: str, out_path: str) -> dict[str, DataFrame]:
    """Collision log -> cleaned columns beside the raw ones, with a parsed date and an injury flag -> CSV parts
    with a header -> count, statistics of the cleaned counts and read-back check."""
    raw = read_csv(spark, csv_path, SC.collision_schema())
    injured, killed = SC.COLLISION_COUNTS[:2]
    wide = C.clean_events_wide(raw, "CRASH DATE", "BOROUGH", [FACTOR, "VEHICLE TYPE CODE 1"], [injured, killed], injured,
                               missing_tokens=SC.BOROUGH_MISSING_TOKENS)
    check = sinks.write_verified(spark, wide, out_path, wide.schema)
    written = read_csv(spark, out_path, wide.schema)
    numbers = [f.name for f in wide.schema.fields if f.dataType.typeName() == "integer"]
    return {"verify": check, "sample": written.limit(20), "describe": Pr.describe_numeric(written, numbers),
            "stats": Pr.summary_stats(written, numbers[:1])}


# -- profiling ---------------------------------------------------------------------------------

def profile_job(df: DataFrame, keys: Sequence[str], numeric: Sequence[str],
                text: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Raw profile in a handful of passes: per-key counts (text order), distinct
    counts (null counted), ranges, typed describe, null counts, text lengths."""
    out = {
        "distinct": Pr.distinct_counts(df, list(keys) + list(numeric)),
        "ranges": Pr.range_stats(df, numeric),
        "describe": Pr.describe_numeric(df, numeric),
        "nulls": Pr.null_counts(df),
        "profile": Pr.profile(df),
    }
    for k in keys:
        out[f"counts_{k}"] = Pr.key_counts_lexical(df, k)
    if text:
        out["lengths"] = Pr.length_stats(df.filter(F.col(text[0]).isNotNull()), text)
    return out


def stats_job(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, median, mode (with count) and standard deviation per column."""
    return Pr.summary_stats(df, columns)


# -- within-city pre/post: eight outputs -----------------------------------------------------

#: The grains of ``prepost_cells``: per month, per borough and year, per factor and year.
GRAINS = ("month", "borough", "factor")


def prepost_cells(prepared: DataFrame) -> DataFrame:
    """Additive cells that all eight summaries are sums of, from one scan: event count ``n``, the eight counts and the
    events with an unspecified factor, per (year, month), per (year, borough) and per (year, factor).

    One aggregation with three grouping sets: each map task folds its rows to one cell per key and grain,
    so the shuffle carries cells, whatever share of the events one borough or factor holds. Rows without a
    borough or factor have cells too (null), so each grain holds all events and their years.
    """
    keyed = prepared.select("year", "era", "month", normalise_key("BOROUGH").alias("BOROUGH"), normalise_key(FACTOR).alias(FACTOR),
                            is_missing_token(FACTOR, SC.FACTOR_MISSING_TOKENS).alias("__unspecified"), *SC.COLLISION_COUNTS)
    base = [F.col("year"), F.col("era")]
    keys = [F.col("month"), F.col("BOROUGH"), F.col(f"`{FACTOR}`")]
    cells = keyed.groupingSets([[*base, k] for k in keys], *base, *keys).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).cast("long").alias(c) for c in SC.COLLISION_COUNTS],
        F.count_if("__unspecified").alias("unspecified"),
        *[F.grouping(k).alias(f"__without_{g}") for g, k in zip(GRAINS, keys)])
    grain = F.coalesce(*[F.when(F.col(f"__without_{g}") == 0, F.lit(g)) for g in GRAINS])
    return cells.withColumn("grain", grain).drop(*[f"__without_{g}" for g in GRAINS])


def prepost_job(spark: SparkSession, raw: DataFrame, out_base: str | None = None,
                cut: int = SC.POLICY_YEAR, year_min: int | None = SC.COLLISION_YEAR_MIN,
                year_max: int | None = None, population: DataFrame | None = None,
                top_k: int = SC.TOP_FACTORS, anomaly: tuple[int, int] = SC.ANOMALY_WINDOW
                ) -> dict[str, DataFrame]:
    """The eight summary tables of the collision log, from one pass over it (``prepost_cells``)."""
    needed = ["CRASH DATE", "BOROUGH", FACTOR, *SC.COLLISION_COUNTS]
    prepared = C.prepare_events(raw.select(*needed), "CRASH DATE", SC.COLLISION_COUNTS, cut=cut,
                                year_min=year_min, year_max=year_max)
    cells = materialise(spark, prepost_cells(prepared), "prepost_cells")
    by_month, by_borough, by_factor = (cells.filter(F.col("grain") == g) for g in GRAINS)
    if population is None:
        population = inline_table(spark, SC.BOROUGH_POPULATION, "segment string, population long")
    injured, killed = SC.COLLISION_COUNTS[0::2], SC.COLLISION_COUNTS[1::2]
    everyone = {"killed": killed[0], "injured": injured[0]}
    # pedestrians, cyclists and motorists, in the order of the log's columns
    cat = {f"{k}_{kind}": names[1:][i] for i, k in enumerate(("ped", "cyc", "mot"))
           for kind, names in (("killed", killed), ("injured", injured))}
    deaths = {k: cat[k] for k in ("ped_killed", "cyc_killed", "mot_killed")}
    lo, hi = anomaly
    out = {
        "annual_summary": P.period_summary(by_month, "year", {
            "persons_killed": killed[0], "persons_injured": injured[0], **deaths}, count_col="n"),
        "pre_post_summary": P.pre_post_summary(by_month, {
            "killed_total": killed[0], "injured_total": injured[0],
            **{f"{k}_total": c for k, c in deaths.items()}}, count_col="n"),
        "borough_pre_post": P.segment_pre_post(by_borough, "BOROUGH", everyone, population=population,
                                               pop_key="segment", count_col="n"),
        "road_user_pre_post": P.pre_post_summary(by_month, cat, count_name=None, total_suffix=""),
        "factor_pre_post": P.topk_shift(by_factor, FACTOR, {"killed": killed[0]}, k=top_k,
                                        exclude=SC.FACTOR_MISSING_TOKENS, count_col="n"),
        "monthly_time_series": P.period_summary(by_month, "month", everyone, count_col="n"),
        "anomaly_window": P.window_rate(by_month, "year", lo, hi, everyone, "killed", "crashes",
                                        "fatality_rate_per_1k_crashes", count_col="n"),
        "unspecified_rate": P.missing_share(by_borough, "BOROUGH", count_col="n", missing_col="unspecified"),
    }
    if out_base:
        for name, df in out.items():
            sinks.write_single_csv(df, f"{out_base.rstrip('/')}/{name}")
    return out


# -- cross-city difference-in-differences ---------------------------------------------------

def did_job(spark: SparkSession, panel: DataFrame, out_base: str | None = None,
            codes: Mapping[tuple, str] = SC.CITY_CODES, treated: str = SC.TREATED_CITY,
            controls: Sequence[str] = SC.CONTROL_CITIES, cut: int = SC.POLICY_YEAR,
            divisors: Mapping[int, int] = SC.DID_DIVISORS, placebo_cut: int = SC.PLACEBO_YEAR,
            placebo_divisors: Mapping[int, int] = SC.PLACEBO_DIVISORS,
            subgroup: str = "PEDS > 0", measure: str = "FATALS",
            labels: Sequence[str] = SC.DID_LABELS) -> dict[str, DataFrame]:
    """Yearly unit panel, total / subgroup / placebo estimates and their summary
    (one row per analysis, labelled with its cut year)."""
    units = D.label_units(panel.filter(F.col("ST_CASE").isNotNull()), codes, ["STATE", "CITY"],
                          "CITY_NAME")
    flagged = D.did_flags(units, "CITY_NAME", treated, "YEAR", cut)

    def estimate(df: DataFrame, c: int, div: Mapping[int, int]) -> DataFrame:
        return D.did_estimate(df, "CITY_NAME", "YEAR", treated, controls, c, measure=measure,
                              divisors=div)

    total = estimate(flagged, cut, divisors)
    sub = estimate(flagged.filter(F.expr(subgroup)), cut, divisors)
    placebo = estimate(flagged.filter(F.col("YEAR") < cut), placebo_cut, placebo_divisors)
    out = {
        "yearly_trends": D.unit_panel(flagged, "CITY_NAME", "YEAR", measure=measure),
        "did_total": total, "did_subgroup": sub, "did_placebo": placebo,
        "did_summary": D.did_summary({
            name.format(cut=cut, placebo_cut=placebo_cut): estimated
            for name, estimated in zip(labels, (total, sub, placebo))}),
    }
    if out_base:
        for name in ("yearly_trends", "did_summary"):
            sinks.write_single_csv(out[name], f"{out_base.rstrip('/')}/{name}")
    return out
