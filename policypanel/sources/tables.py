"""Table sources: the shared Parquet tables, catalog scans, inline dimensions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of an inline table up to which joins are told to broadcast it; beyond it Spark decides by its size.
BROADCAST_ROWS = 100_000


def parquet_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``{sf_dir}/{name}.parquet``; projections and filters reach the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scan_table(spark: SparkSession, name: str, not_null: Sequence[str] = ()) -> DataFrame:
    """Catalog table scan; ``not_null`` drops header artefact rows (a text table
    read without header handling shows each file header as an all-null row)."""
    df = spark.table(name)
    for c in not_null:
        df = df.filter(F.col(c).isNotNull())
    return df


def inline_table(spark: SparkSession, rows: Iterable[tuple], ddl: str) -> DataFrame:
    """A small literal table (a code table, a population table) as a SQL
    ``VALUES`` list with bound parameters: Spark plans it as a LocalTableScan with
    exact size statistics (no Python RDD behind it). It is held on the driver, so
    it carries a broadcast hint for any join it takes part in."""
    schema = T._parse_datatype_string(ddl)
    args: dict[str, object] = {}
    tuples = []
    for i, row in enumerate(rows):
        if len(row) != len(schema.fields):
            raise ValueError(f"row {i} has {len(row)} values, schema has {len(schema.fields)}")
        marks = []
        for j, value in enumerate(row):
            args[f"v{i}_{j}"] = value
            marks.append(f":v{i}_{j}")
        tuples.append("(" + ", ".join(marks) + ")")
    if not tuples:
        return spark.createDataFrame([], schema)
    cols = ", ".join(f"c{j}" for j in range(len(schema.fields)))
    df = spark.sql(f"SELECT * FROM VALUES {', '.join(tuples)} AS t({cols})", args=args)
    typed = df.select(*[F.col(f"c{j}").cast(f.dataType).alias(f.name)
                        for j, f in enumerate(schema.fields)])
    return F.broadcast(typed) if len(tuples) <= BROADCAST_ROWS else typed
