"""Sharding by fixed virtual slots and a versioned slot-to-shard map."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from policypanel.llm.common import dealt, stored

#: Virtual slots. The map has one row per slot, so its size does not grow with the data.
SLOTS = 4096
#: Equal rows dealt out together.
BLOCK = 4096


def virtual_slot(*cols: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(slots)).cast("int")


def slot_sizes(rows: DataFrame, slots: int = SLOTS) -> list[tuple[int, int, int]]:
    """(virtual slot, bytes, rows) of every slot, in use or not."""
    got = rows.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    used = {r["virtual_slot"]: (r["b"], r["n"]) for r in got}
    return [(s, *used.get(s, (0, 0))) for s in range(slots)]


def first_map(sizes: list[tuple[int, int, int]], shards: int) -> dict[int, int]:
    """Largest slot first, each to the shard with the fewest bytes so far; empty slots in turn."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for slot, size, _ in sorted(sizes, key=lambda x: (-x[1], x[0])):
        if not size:
            out[slot] = slot % shards
            continue
        used, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (used + size, shard))
    return out


def rebalanced(old: dict[int, int], sizes: list[tuple[int, int, int]], shards: int) -> dict[int, int]:
    """``old`` edited for ``shards`` shards, moving few slots: only those off removed or overfull shards.

    Slots of shards that are gone, slots without a shard, and from each shard over the new mean the smallest
    slots that bring it down to the mean, go to the shard with the fewest bytes. A shard under the mean loses nothing.
    """
    by = {slot: size for slot, size, _ in sizes}
    mean = sum(by.values()) / shards
    load = dict.fromkeys(range(shards), 0)
    homeless = []
    for slot in sorted(by, key=lambda s: (-by[s], s)):
        shard = old.get(slot, -1)
        if 0 <= shard < shards and load[shard] + by[slot] <= mean:
            load[shard] += by[slot]
        elif 0 <= shard < shards and load[shard] == 0:
            load[shard] += by[slot]
        else:
            homeless.append(slot)
    out = {s: old[s] for s in by if s not in set(homeless)}
    heap = [(b, s) for s, b in load.items()]
    heapq.heapify(heap)
    for slot in homeless:
        used, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (used + by[slot], shard))
    return out


def write_map(spark: SparkSession, path: str, version: int, slot_map: dict[int, int], sizes: list[tuple[int, int, int]]) -> None:
    """One version of the map as a folder of its own; earlier versions stay as they are."""
    rows = [(slot, slot_map[slot], b, n) for slot, b, n in sizes]
    df = spark.createDataFrame(rows, "virtual_slot int, shard int, slot_bytes long, slot_rows long")
    df.coalesce(1).write.parquet(f"{path}/version={version}")


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema("virtual_slot int, shard int, slot_bytes long, slot_rows long").parquet(f"{path}/version={version}")


def place(rows: DataFrame, slot_map: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``shard`` and ``slot``, the row's place in its shard, gapless from 0.

    Virtual slots follow each other inside a shard in the order of their numbers; the map's row counts give where each one
    begins, and rows are numbered within a virtual slot, so the numbering runs over thousands of tasks. The map is broadcast: one row per slot.
    A row whose virtual slot the map lacks is an error.
    """
    w = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.select("virtual_slot", "shard", F.coalesce(F.sum("slot_rows").over(w), F.lit(0)).alias("begins"))
    inside = Window.partitionBy("virtual_slot").orderBy(*order)
    numbered = rows.withColumn("nth", F.row_number().over(inside) - 1)
    lost = F.raise_error(F.concat(F.lit("the slot map lacks virtual slot "), F.col("virtual_slot").cast("string"))).cast("int")
    placed = numbered.join(F.broadcast(starts), "virtual_slot", "left").withColumn("shard", F.coalesce("shard", lost))
    return placed.withColumn("slot", (F.col("begins") + F.col("nth")).cast("long")).drop("begins", "nth")


def slotted(docs: DataFrame, slots: int, block: int = BLOCK) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot), a row per document. Rows that are equal in the first three are told apart by a number from
    0 on, which goes into the slot's hash, so that they spread like others. They are counted, not gathered, and
    dealt out again in blocks of ``block``, which no task or array exceeds."""
    text = F.coalesce(F.col("text"), F.lit(""))
    facts = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    key = ["doc_id", "size", "text_crc32"]
    counted = facts.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    blocks = counted.select(*key, "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / block).cast("long"))).alias("b"))
    nth = F.explode(F.sequence(F.col("b") * block, F.least((F.col("b") + 1) * block, F.col("n")) - 1)).alias("copy")
    spread = dealt(blocks, *key, "b").select(*key, nth)
    return spread.withColumn("virtual_slot", virtual_slot(F.col("doc_id"), F.col("text_crc32"), F.col("copy"), slots=slots))


def reshard_documents(docs: DataFrame, path: str, version: int, shards: int, slots: int = SLOTS) -> DataFrame:
    """Documents, earlier and later ones, placed by the map of ``version`` under ``path`` edited for ``shards`` shards and their present
    sizes; writes it as the next version.

    Rows, null and repeated ones too, as in ``shard_documents``; of an empty table none, and the next version has empty slots.
    """
    spark = docs.sparkSession
    rows = stored(slotted(docs, slots), "slotted")
    old = {r["virtual_slot"]: r["shard"] for r in read_map(spark, path, version).collect()}
    sizes = slot_sizes(rows, slots)
    write_map(spark, path, version + 1, rebalanced(old, sizes, shards), sizes)
    return place(rows, read_map(spark, path, version + 1), ["doc_id", "text_crc32", "size", "copy"]).drop("copy")


def shard_documents(docs: DataFrame, path: str, shards: int = 16, slots: int = SLOTS) -> DataFrame:
    """Documents dealt to ``shards`` so that bytes are near equal; writes version 1 of the map under ``path``.

    A row goes to a virtual slot by a hash of doc_id, of its text's checksum and of its number among equal rows, so rows that
    share an id (null ones too) and repeated rows still spread. Size: UTF-8 bytes of the text plus 1. Null text: size 1,
    checksum of the empty text. Repeated rows are all kept. Extra columns are left out. Empty table: no rows.
    """
    spark = docs.sparkSession
    rows = stored(slotted(docs, slots), "slotted")
    sizes = slot_sizes(rows, slots)
    write_map(spark, path, 1, first_map(sizes, shards), sizes)
    return place(rows, read_map(spark, path, 1), ["doc_id", "text_crc32", "size", "copy"]).drop("copy")
