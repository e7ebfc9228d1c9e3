"""Helpers shared by the training-data operators: tables, scratch folders, components."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words: runs of anything but ASCII white space (space and code points 9 to 13).
WORD = r"[^\x20\x09-\x0D]+"


def on_workers(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package from where the driver has it, if it is not installed there."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which driver and executors share.

    Only a local session may lack the setting; it then gets a temporary folder.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="scratch-")
        sc.setCheckpointDir(root)
    return f"{root.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


@contextmanager
def run_once(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is run inside are removed when it ends, and not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage, survives lost executors. The write's shuffle files go with its end."""
    spark = df.sparkSession
    path = scratch(spark, name)
    with run_once(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes the folders of ``stored`` tables that nothing reads any more: what was made of them is stored itself."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._stored_at)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def dealt(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` over at least as many tasks as the session shuffles into, dealt by a hash of ``cols``."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *cols)


def connected_components(edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """Distributed union-find over ``edges`` (u, v): rows (node, component), component the smallest node.

    Alternating large-star and small-star rounds: every node hangs its neighbours on the
    smallest node it knows until each component is one star. Each round is two grouped minima and
    two joins on the edges, so no component is ever gathered in one task. Self-loops are allowed and
    give a node its own component; null ends are ignored. Ends when a round changes nothing.
    """
    pair = edges.select(F.col("u"), F.col("v")).where("u IS NOT NULL AND v IS NOT NULL")
    cur = stored(pair.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    seen = _print(cur)
    for _ in range(max_rounds):
        both = cur.where("u <> v").select("u", "v").unionByName(cur.where("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = (
            both.join(low, F.col("u") == F.col("k"))
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(cur.where("u = v"))
        )
        large = large.distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        small = large.join(low2, F.col("u") == F.col("k")).select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v")
        last, cur = cur, stored(small.distinct(), name)
        discard(last)
        now = _print(cur)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return cur.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))


def _print(edges: DataFrame) -> tuple:
    """Count and order-free checksum of an edge set."""
    with run_once(edges.sparkSession):
        row = edges.where("u <> v").agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")
        ).first()
    return row["n"], row["x"]
