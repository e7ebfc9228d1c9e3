"""N-gram Jaccard self-join: rare-first prefixes with length, positional and suffix filters."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from policypanel.llm.common import connected_components, dealt, discard, run_once, stored

#: Counters that order shingles by how often they occur: a fixed number, so what is broadcast does not grow.
#: They only set the order; any order gives the same links, a coarser one more candidates.
COUNTERS, CHUNK = 1 << 22, 1 << 12
#: Bits that say which rows may hold a candidate (8 MB). False positives cost time, never a result.
BITS = 1 << 26
#: Words of 64 parity bits of a set: its shingles fall into 64 cells a word by their last bits, and a bit says whether a cell holds an odd number.
WORDS = 8
#: Bytes of text hashed, and shingles counted, at a time.
SLICE = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: An odd base for word hashes, and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each; products wrap modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(20, (n - 1).bit_length())
        _POWERS[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)])) for b in (_BASE, _INVERSE)]
    return _POWERS


def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser; arithmetic wraps."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of ``raw`` begins, and its hash: a polynomial in its bytes, from one running sum over all of them."""
    b = np.frombuffer(raw, dtype=np.uint8)
    edge = np.diff(np.concatenate([[True], _SPACE[b], [True]]).astype(np.int8))
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _powers(len(b) + 1)
    sums = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)], out=sums[1:])
    return begin, _mix((sums[end] - sums[begin]) * down[begin])


def _chained(h: np.ndarray, take: int) -> np.ndarray:
    """58-bit hashes of all runs of ``take`` words."""
    x = np.full(max(0, len(h) - take + 1), take, dtype=np.uint64)
    for i in range(take):
        x = _mix(x * np.uint64(_BASE) + h[i : i + len(x)])
    return x >> np.uint64(6)


def shingle_runs(texts: list[str], n: int) -> Iterator[np.ndarray]:
    """Per text the hashes of its ``n``-word shingles in order, A-Z in lower case; with fewer words the whole sequence is one."""
    raws = [t.encode("utf-8", "replace").lower() for t in texts]
    first = 0
    while first < len(raws):
        last, size = first, 0
        while last < len(raws) and (last == first or size + len(raws[last]) < SLICE):
            size += len(raws[last]) + 1
            last += 1
        begin, h = word_hashes(b"\n".join(raws[first:last]))
        starts = np.cumsum([0] + [len(r) + 1 for r in raws[first:last]])
        at = np.searchsorted(begin, starts)
        x = _chained(h, n)
        for s, e in zip(at, at[1:]):
            yield x[s : e - n + 1] if e - s >= n else _chained(h[s:e], e - s) if e > s else x[:0]
        first = last


def shingles(text: str, n: int) -> np.ndarray:
    """The distinct shingles of one text, sorted."""
    return np.unique(next(shingle_runs([text], n)))


def overlap_needed(a, b, num: int, den: int):
    """Least intersection of sets of sizes a and b with den * intersection >= num * union."""
    return -((-num * (a + b)) // (num + den))


def shingle_counts(docs: DataFrame, n: int) -> bytes:
    """Counts of all shingles of all documents, hashed into ``COUNTERS`` counters, as one byte (log2) each."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(COUNTERS, dtype=np.uint32)
        for p in parts:
            found, size = [], 0
            for last, run in enumerate(shingle_runs(list(p["text"]), n), 1):
                found.append((run & np.uint64(COUNTERS - 1)).astype(np.uint32))
                size += len(run)
                if size >= SLICE or last == len(p):
                    sums += np.bincount(np.concatenate(found), minlength=COUNTERS).astype(np.uint32)
                    found, size = [], 0
        for at in range(0, COUNTERS, CHUNK):
            part = sums[at : at + CHUNK]
            if part.any():
                yield pd.DataFrame({"chunk": [at // CHUNK], "counts": [zlib.compress(part.tobytes(), 1)]})

    def add(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for p in parts:
            for chunk, raw in zip(p["chunk"], p["counts"]):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(zlib.decompress(raw), dtype=np.uint32).astype(np.uint64)
        for chunk, s in sums.items():
            yield pd.DataFrame({"chunk": [chunk], "level": [np.ceil(np.log2(s + 1.0)).astype(np.uint8).tobytes()]})

    parts = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInPandas(count, "chunk int, counts binary")
    levels = np.zeros(COUNTERS, dtype=np.uint8)
    # at most COUNTERS bytes in COUNTERS / CHUNK rows
    with run_once(docs.sparkSession):
        rows = parts.repartition(16, "chunk").mapInPandas(add, "chunk int, level binary").collect()
    for r in rows:
        levels[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = np.frombuffer(bytes(r["level"]), dtype=np.uint8)
    return levels.tobytes()


def rare_first(x: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The distinct shingles with their frequency level as top bits, sorted: rare ones first, the same order in every document."""
    y = np.sort((levels[(x & np.uint64(COUNTERS - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(57)) | (x >> np.uint64(1)))
    return y[np.concatenate([[True], y[1:] != y[:-1]])] if len(y) else y


def row_key(*cols: Column | str) -> Column:
    return F.xxhash64(*cols)


def document_sets(docs: DataFrame, n: int, num: int, den: int, levels) -> DataFrame:
    """One row per document: doc_id, row_key, n_shingles, node (a hash of the set; null without words), its prefix and its parity bits."""

    def sets(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lv = np.frombuffer(levels.value, dtype=np.uint8)
        for p in parts:
            sizes, nodes, prefixes, bits = [], [], [], []
            for run in shingle_runs(list(p["text"]), n):
                x = rare_first(run, lv)
                size = len(x)
                sizes.append(size)
                nodes.append(xxhash.xxh64_intdigest(x.tobytes()) - (1 << 63) if size else None)
                prefixes.append(x[: size - -(-num * size // den) + 1].astype(np.int64) if size else None)
                odd = np.bincount((x & np.uint64(64 * WORDS - 1)).astype(np.int64), minlength=64 * WORDS) & 1
                bits.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            out = pd.DataFrame({"n_shingles": sizes, "node": pd.array(nodes, dtype="Int64"), "prefix": prefixes, "bits": bits})
            out.insert(0, "row_key", p["row_key"])
            out.insert(0, "doc_id", p["doc_id"].astype("Int64"))
            yield out

    return docs.mapInPandas(sets, "doc_id long, row_key long, n_shingles long, node long, prefix array<long>, bits array<long>")


def candidate_sets(docs: DataFrame, nodes: DataFrame, n: int, levels) -> DataFrame:
    """(node, tokens) of the given ``nodes`` (node, row_key): the texts are read again and only rows that a bitmap of the
    wanted row keys lets through are shingled, so no text is shuffled."""
    bit = F.pmod("row_key", F.lit(BITS))
    # buckets of Spark's bitmaps are numbered from 1 and hold the values from 1 on
    maps = nodes.select((bit + 1).alias("b")).groupBy(F.bitmap_bucket_number("b").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("m"))
    with run_once(docs.sparkSession):
        maps = maps.collect()
    bitmap = np.zeros(BITS // 8, dtype=np.uint8)
    for r in maps:
        at = (r["k"] - 1) * 4096
        got = np.frombuffer(bytes(r["m"]), dtype=np.uint8)
        bitmap[at : at + len(got)] = got
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap.tobytes())

    def sets(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lv = np.frombuffer(levels.value, dtype=np.uint8)
        bits = np.frombuffer(wanted.value, dtype=np.uint8)
        for p in parts:
            b = p["bit"].to_numpy()
            p = p[((bits[b >> 3] >> (b & 7)) & 1).astype(bool)]
            rows = []
            for run in shingle_runs(list(p["text"]), n):
                x = rare_first(run, lv)
                if len(x):
                    rows.append((xxhash.xxh64_intdigest(x.tobytes()) - (1 << 63), x.tobytes()))
            yield pd.DataFrame(rows, columns=["node", "tokens"])

    return docs.select("text", bit.alias("bit")).mapInPandas(sets, "node long, tokens binary")


def _suffix_bound(x: np.ndarray, y: np.ndarray) -> int:
    """Upper bound of the overlap of two sorted arrays: split both at the middle of x, and again in each half."""

    def bound(a: np.ndarray, b: np.ndarray, depth: int) -> int:
        if not depth or not len(a) or not len(b):
            return min(len(a), len(b))
        i = len(a) // 2
        j = int(np.searchsorted(b, a[i]))
        return bound(a[:i], b[:j], depth - 1) + bound(a[i:], b[j:], depth - 1)

    return bound(x, y, 2)


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (u, v) whose sets reach the threshold; each is verified once, after the suffix filter."""
    withsets = (
        pairs.join(sets.select(F.col("node").alias("v"), F.col("tokens").alias("tv")), "v")
        .join(sets.select(F.col("node").alias("u"), F.col("tokens").alias("tu")), "u")
    )

    def check(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            keep = []
            for a, b in zip(p["tu"], p["tv"]):
                x, y = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
                need = overlap_needed(len(x), len(y), num, den)
                ok = _suffix_bound(x, y) >= need
                if ok:
                    at = np.searchsorted(x, y)
                    at[at == len(x)] = 0
                    ok = int((x[at] == y).sum()) >= need
                keep.append(ok)
            yield p.loc[keep, ["u", "v"]]

    return withsets.mapInPandas(check, "u long, v long")


def _passes(na: Column, pa: Column, nb: Column, pb: Column, num: int, den: int) -> Column:
    """Length filter, then the positional filter for two sets that meet at places pa and pb of their orders."""
    return (F.least(na, nb) * den >= F.greatest(na, nb) * num) & (F.least(na - pa, nb - pb) * (num + den) >= (na + nb) * num)


def _may_link(bits_a: Column, bits_b: Column, sizes: Column, num: int, den: int) -> Column:
    """The suffix filter on parity bits: every cell of unequal parity holds a shingle that only one of the sets has, and linked
    sets of ``sizes`` together have no more such shingles than the threshold leaves. Never false for linked sets."""
    odd = sum((F.bit_count(F.get(bits_a, i).bitwiseXOR(F.get(bits_b, i))) for i in range(WORDS)), F.lit(0))
    return odd * (num + den) <= sizes * (den - num)


def near_duplicates(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Links documents whose sets of ``n``-word shingles have den * intersection >= num * union, and their components.

    Result, a row per document: doc_id, row_key (hash of doc_id and text), n_shingles, component_id (smallest doc_id reachable
    by links, itself included) and is_head (the one row that stands for its component; identical rows share it).

    Equal sets are one node. A prefix of each set, the rarest shingles first, is joined in two rounds: first each prefix shingle's
    nodes with the smallest and the largest of them, then, among nodes that are still in different components, every
    pair that meets in a prefix shingle. Each pair passes the length, positional and suffix filters, is made distinct, and is verified
    once. Pairs inside a component need no check, as they cannot change it, so a group of near copies
    does not give all its pairs.

    Null text, or text without words: empty set, linked with nothing. Null doc_id: counts as a row; it is never the smallest
    unless the component has no other. Repeated rows: linked as equal sets. Extra columns are left out. Empty table: no rows.
    """
    src = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("row_key", row_key("doc_id", "text"))
    levels = src.sparkSession.sparkContext.broadcast(shingle_counts(src, n))
    found = stored(document_sets(src, n, num, den, levels), "ngram-sets")

    wide = stored(
        found.where("node IS NOT NULL").groupBy("node").agg(F.min_by(F.struct("row_key", "n_shingles", "prefix", "bits"), "row_key").alias("r")).select(
            "node", "r.row_key", F.col("r.n_shingles").alias("n"), "r.prefix", "r.bits"),
        "ngram-nodes",
    )
    first, found = found, stored(found.drop("prefix", "bits"), "ngram-rows")
    nodes = stored(wide.drop("prefix"), "ngram-nodes")
    discard(first)

    # most prefix shingles are in one set only: they are left out before anything else is made of them
    tokens = dealt(wide.select("node", "n", F.posexplode("prefix").alias("p", "token")), "token")
    shared = tokens.groupBy("token").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("token")
    tokens = stored(tokens.join(shared, "token", "left_semi"), "ngram-shared")
    discard(wide)

    # round 1: a prefix shingle's nodes against the smallest and the largest of them
    row = F.struct("node", "n", "p")
    ends = tokens.groupBy("token").agg(F.min(row).alias("lo"), F.max(row).alias("hi"))
    heads = tokens.join(ends, "token")
    star = heads.select("node", "n", "p", F.explode(F.array("lo", "hi")).alias("h")).where(
        (F.col("node") != F.col("h.node")) & _passes(F.col("n"), F.col("p"), F.col("h.n"), F.col("h.p"), num, den)
    )
    star = star.select(F.least("node", "h.node").alias("u"), F.greatest("node", "h.node").alias("v")).distinct()
    of = lambda end: nodes.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("bits").alias(f"bits_{end}"))
    may = _may_link(F.col("bits_u"), F.col("bits_v"), F.col("n_u") + F.col("n_v"), num, den)
    pairs = stored(star.join(of("u"), "u").join(of("v"), "v").where(may).select("u", "v"), "ngram-pairs")
    links = stored(verified(pairs, sets_of(src, nodes, pairs, n, levels), num, den), "ngram-links")
    comps = stored(connected_components(links), "ngram-components")
    discard(links)

    # round 2: pairs across components
    placed = tokens.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ends = placed.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    mixed = placed.join(ends.select("token"), "token", "left_semi").select("token", "node", "n", "p", "component")
    mixed = stored(mixed.join(nodes.select("node", "bits"), "node"), "ngram-mixed")
    discard(tokens)
    a, b = mixed.alias("a"), mixed.alias("b")
    across = a.join(
        b,
        (F.col("a.token") == F.col("b.token")) & (F.col("a.node") < F.col("b.node")) & (F.col("a.component") != F.col("b.component"))
        & _passes(F.col("a.n"), F.col("a.p"), F.col("b.n"), F.col("b.p"), num, den)
        & _may_link(F.col("a.bits"), F.col("b.bits"), F.col("a.n") + F.col("b.n"), num, den),
    )
    more = stored(across.select(F.col("a.node").alias("u"), F.col("b.node").alias("v")).distinct().join(pairs, ["u", "v"], "left_anti"), "ngram-across")
    discard(mixed, pairs)
    links = stored(verified(more, sets_of(src, nodes, more, n, levels), num, den), "ngram-links")
    first, comps = comps, stored(connected_components(links.unionByName(comps.select(F.col("node").alias("u"), F.col("component").alias("v")))), "ngram-components")
    discard(first, links, more, nodes)

    heads = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")
    by_node = found.where("node IS NOT NULL").groupBy("node").agg(F.min(heads).alias("h")).join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    by_comp = by_node.groupBy("component").agg(F.min("h").alias("head"))
    of_node = by_node.select("node", "component").join(by_comp, "component").select("node", "head")
    return found.join(of_node, "node", "left").select(
        "doc_id", "row_key", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"),
        F.when(F.col("node").isNull(), True).otherwise(F.col("row_key") == F.col("head.row_key")).alias("is_head"),
    )


def sets_of(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, n: int, levels) -> DataFrame:
    """(node, tokens) of the nodes in ``pairs`` (u, v)."""
    ends = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    met = stored(ends.join(nodes.select("node", "row_key"), "node"), "ngram-met")
    sets = stored(candidate_sets(docs, met, n, levels).join(met.select("node"), "node", "left_semi").dropDuplicates(["node"]), "ngram-tokens")
    discard(met)
    return sets


def one_per_group(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one document of each component left: the one with the smallest doc_id. Identical rows leave one,
    unless they have no words: such rows are linked with nothing and all stay."""
    keep = near_duplicates(docs, n, num, den).where("is_head").select(F.col("row_key").alias("__head")).distinct()
    keyed = docs.withColumn("__key", row_key("doc_id", F.coalesce("text", F.lit(""))))
    wordless = ~F.coalesce(F.col("text").rlike(r"\S"), F.lit(False))
    salted = keyed.withColumn("__salt", F.when(wordless, F.monotonically_increasing_id()))
    return salted.join(keep, F.col("__key") == F.col("__head"), "left_semi").dropDuplicates(["__key", "__salt"]).drop("__key", "__salt")
