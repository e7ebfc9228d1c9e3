"""Sinks and catalog registration.

* ``write_single_csv``: one CSV part with header, for *aggregated* results only
  (``coalesce(1)`` funnels the data through one task).
* ``write_parts``: a large frame as many parts (Parquet by default, CSV on request).
* ``write_ctrl_a``: headerless text with the 0x01 separator, so commas in free text
  survive without quoting.
* ``register_csv_table``: ``CREATE TABLE ... USING csv LOCATION`` in Spark's own
  catalog (no metastore service needed); ``replace=True`` drops and re-creates,
  ``replace=False`` keeps an existing definition.
* ``catalog_check``: DESCRIBE, row count and a 5-row sample as DataFrames.
* ``write_observed``: metrics of the rows of a write, taken in that write.
* ``write_verified`` / ``verify_sink``: read a written folder back and compare the row count
  with that of the write, or with a frame that is computed again.
* ``publish``: a new version of a table beside the old one, then one switch of its name.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CTRL_A = "\x01"

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _ident(name: str) -> str:
    for part in name.split("."):
        if not _IDENT.match(part):
            raise ValueError(f"not a plain identifier: {name!r}")
    return name


def write_single_csv(df: DataFrame, path: str, header: bool = True) -> str:
    """Small (aggregated) result -> one CSV part with header, overwrite."""
    df.coalesce(1).write.mode("overwrite").option("header", header).csv(path)
    return path


def write_parts(df: DataFrame, path: str, fmt: str = "parquet", header: bool = True,
                partition_by: list[str] | None = None) -> str:
    """Large frame -> many parts, one per task; optional directory partitioning
    (e.g. by year) so later scans prune whole folders."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", header)
    w.format(fmt).save(path)
    return path


#: Null has a mark of its own, so that empty text stays empty text.
CTRL_A_FORMAT = {"header": False, "sep": CTRL_A, "nullValue": "\\N",
                 "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_ctrl_a(df: DataFrame, path: str) -> str:
    """Headerless CSV with the 0x01 separator that keeps line ends, outer blanks and empty text."""
    df.write.mode("overwrite").options(**CTRL_A_FORMAT).csv(path)
    return path


def read_ctrl_a(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).options(multiLine=True, **CTRL_A_FORMAT).csv(path)


def register_csv_table(spark: SparkSession, table: str, schema_ddl: str, location: str,
                       header: bool = True, sep: str = ",", replace: bool = True,
                       database_location: str | None = None,
                       partition_by: list[str] | None = None) -> str:
    """External CSV table over ``location`` in the session catalog. With
    ``partition_by`` the folder holds ``col=value`` sub-folders (as written by
    ``write_parts(partition_by=...)``): they are registered, so filters on those
    columns prune whole folders."""
    _ident(table)
    for c in partition_by or []:
        _ident(c)
    if "." in table:
        db = table.split(".")[0]
        where = f" LOCATION '{database_location}'" if database_location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{where}")
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    exists = "" if replace else "IF NOT EXISTS "
    sep_sql = "\\u0001" if sep == CTRL_A else sep.replace("'", "\\'")
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE {exists}{table} ({schema_ddl}) USING csv "
        f"OPTIONS (header '{str(header).lower()}', sep '{sep_sql}'){parts} LOCATION '{location}'")
    if partition_by:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return table


def catalog_check(spark: SparkSession, table: str, sample: int = 5) -> dict[str, DataFrame]:
    """DESCRIBE, ``count(*) AS total`` and a small sample, returned as frames."""
    _ident(table)
    return {
        "describe": spark.sql(f"DESCRIBE {table}"),
        "count": spark.sql(f"SELECT COUNT(*) AS total FROM {table}"),
        "sample": spark.sql(f"SELECT * FROM {table} LIMIT {int(sample)}"),
    }


def write_observed(df: DataFrame, path: str, metrics: Mapping[str, Column], fmt: str = "parquet",
                   header: bool = True, partition_by: list[str] | None = None) -> dict[str, Any]:
    """Writes ``df`` and returns aggregate ``metrics`` of the rows written, computed in the writing tasks
    themselves: neither ``df`` nor the result is scanned for them.

    Metrics are exact when ``df`` reaches the writer without a shuffle after the observed place, as every
    partition is then counted by the one task that commits its file.
    """
    seen = Observation()
    write_parts(df.observe(seen, *[c.alias(n) for n, c in metrics.items()]), path, fmt, header, partition_by)
    return seen.get


def _read_back(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str, header: bool) -> DataFrame:
    reader = spark.read.schema(schema)
    return (reader.option("header", header) if fmt == "csv" else reader).format(fmt).load(path)


def write_verified(spark: SparkSession, df: DataFrame, path: str, schema: T.StructType | str, fmt: str = "csv",
                   header: bool = True, partition_by: list[str] | None = None) -> DataFrame:
    """Writes ``df`` and checks the result as one row: ``rows_written, rows_read, matches``.

    The rows written are counted by the write (``write_observed``); only the written files are read.
    """
    written = write_observed(df, path, {"rows": F.count(F.lit(1))}, fmt, header, partition_by)["rows"]
    return rows_match(spark, written, path, schema, fmt, header)


def rows_match(spark: SparkSession, written: int, path: str, schema: T.StructType | str, fmt: str = "csv",
               header: bool = True) -> DataFrame:
    """``rows_written, rows_read, matches`` for a folder that ``written`` rows were written to."""
    back = _read_back(spark, path, schema, fmt, header).agg(F.count(F.lit(1)).alias("rows_read"))
    return (back.select(F.lit(written).cast("long").alias("rows_written"), "rows_read")
            .withColumn("matches", F.col("rows_written") == F.col("rows_read")))


def publish(spark: SparkSession, df: DataFrame, table: str, root: str, partition_by: Sequence[str] = (),
            replace: bool = True, switch: bool = True) -> str:
    """Writes ``df`` as a new version of ``table`` and makes it the current one; returns the version's own table name.

    ``table`` is a view over one version, each a table of its own in a folder of its own below ``root``. The
    new version is written whole before the view is replaced, in one catalog step: readers see the old or
    the new rows, never some of both, and a job that dies on the way leaves the old version
    current. A query that runs during the switch goes on reading the version it began with. With ``replace=False`` an existing
    table is kept and nothing is written. ``switch=False`` writes a version without making it current (``switch_to`` does).

    Partitioned versions are rebalanced by their partition columns: Spark splits a value that holds
    much of the data over as many tasks as its size needs and puts small ones together, so
    a version has files of a bounded size rather than one per task and value.
    """
    for c in partition_by:
        _ident(c)
    _ident(table)
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.split('.')[0]}")
    if not replace and spark.catalog.tableExists(table):
        return table
    version = f"{table}__{uuid.uuid4().hex[:12]}"
    path = f"{root.rstrip('/')}/{version.rsplit('.', 1)[-1]}"
    out = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
    write_parts(out, path, "parquet", partition_by=list(partition_by) or None)
    spark.sql(f"CREATE TABLE {version} ({df.schema.toDDL()}) USING parquet"
              f"{f' PARTITIONED BY ({chr(44).join(partition_by)})' if partition_by else ''} LOCATION '{path}'")
    if partition_by:
        spark.sql(f"ALTER TABLE {version} RECOVER PARTITIONS")
    if switch:
        switch_to(spark, table, version)
    return version


def switch_to(spark: SparkSession, table: str, version: str) -> None:
    """Makes ``version`` (a name that ``publish`` returned) the rows of ``table``: a step forward, or back to an older version."""
    spark.sql(f"CREATE OR REPLACE VIEW {_ident(table)} AS SELECT * FROM {_ident(version)}")


def verify_sink(spark: SparkSession, source: DataFrame, path: str, schema: T.StructType | str,
                fmt: str = "csv", header: bool = True) -> DataFrame:
    """Write-then-read check as one row: ``rows_written, rows_read, matches``.

    Both sides are tagged and unioned, then one global aggregate counts each
    tag, so the check is a single job with no join.
    """
    back = _read_back(spark, path, schema, fmt, header)
    tagged = (source.select(F.lit(1).alias("w"), F.lit(0).alias("r"))
              .unionByName(back.select(F.lit(0).alias("w"), F.lit(1).alias("r"))))
    return (tagged.agg(F.count_if(F.col("w") == 1).alias("rows_written"),
                       F.count_if(F.col("r") == 1).alias("rows_read"))
            .withColumn("matches", F.col("rows_written") == F.col("rows_read")))
