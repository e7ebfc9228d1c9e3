"""Fuzzy line dedup by MinHash, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from policypanel.llm.common import connected_components, dealt, discard, stored

#: Characters of a shingle; there is one at every position.
CHARS = 5
#: Hashes per band key. Lines with fewer shingles than ``SHORT`` have a key from every run of ``FEW`` sorted hashes, others
#: one of ``ROWS`` from the start of each of 16 equal ranges of hashes; lines that may link with both kinds have both.
ROWS, FEW, SHORT, RANGES = 5, 3, 24, 16
#: Words of 64 parity bits by which lines that share a key are told apart without an error.
WORDS = 16
THRESHOLD = (80, 100)
#: Hashes in a line's sketch, and how many of them two lines must share before their texts are compared.
BOTTOM, AGREE = 16, 6
#: Bits that say which lines are wanted again, in words of 64: a table of at most 2**18 rows is broadcast.
BITS = 1 << 24


def doc_key() -> Column:
    return F.xxhash64("doc_id", F.coalesce("text", F.lit("")))


def exploded(docs: DataFrame) -> DataFrame:
    """(doc_id, doc_key, line_no, line) of the lines with a word."""
    keyed = docs.select("doc_id", doc_key().alias("doc_key"), "text")
    lines = keyed.select("doc_id", "doc_key", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.where(F.col("line").rlike(r"\S"))


def runs(low: Column) -> Column:
    """Hashes of the runs of ``CHARS`` characters (code points) at every position of a line in lower case; a shorter line is one run.

    Runs are cut from four bytes for each character, where a place is found in constant time, and hashed as they are.
    """
    size = 4 * CHARS
    at = lambda raw: F.sequence(F.lit(1), F.greatest(F.lit(1), F.octet_length(raw) - (size - 1)), F.lit(4))
    cut = lambda raw: F.transform(at(raw), lambda i: F.xxhash64(F.substring(raw, i, F.lit(size))))
    # in an array of one, so that the bytes are made once for a line
    return F.get(F.transform(F.array(F.encode(low, "UTF-32")), cut), 0)


def shingles(low: Column) -> Column:
    """The sorted distinct ``runs`` of a line."""
    return F.sort_array(F.array_distinct(runs(low)))


def with_ranges(rows: DataFrame, n: int) -> DataFrame:
    """``rows`` (h, sorted hashes, ...) with columns s0 to s<n>: at which place of h each of ``n`` equal ranges of hashes begins, and its size.

    The ranges' bounds are sorted in among the hashes, and their places are looked up.
    """
    bounds = [(r - n // 2) * ((1 << 64) // n) for r in range(1, n)]
    marked = rows.withColumn("marked", F.sort_array(F.concat("h", F.array(*map(F.lit, bounds)))))
    starts = {f"s{r}": (F.array_position("marked", F.lit(b)) - r).cast("int") for r, b in enumerate(bounds, 1)}
    return marked.withColumns({"s0": F.lit(0), f"s{n}": F.size("h")} | starts).drop("marked")


def band_keys() -> Column:
    """Band keys of sorted hashes h ``with_ranges``: a hash of ``ROWS`` neighbours (``FEW`` in short lines), the last ones followed by the first.

    The smallest hashes of a range are minima of a one-permutation MinHash, so two sets agree on a key with about
    their similarity to the power ``ROWS``.
    """
    h, (num, den) = F.col("h"), THRESHOLD
    run = lambda i, rows=ROWS: F.xxhash64(*(F.get(h, (i + k) % F.size(h)) for k in range(rows)))
    # an empty range has null: ``array_compact`` and other functions with a lambda would take all below them out of generated code
    starts = F.array(*(F.when(F.col(f"s{r}") < F.col(f"s{r + 1}"), run(F.col(f"s{r}"))) for r in range(RANGES)))
    few, all_of = F.transform(h, lambda x, i: run(i, FEW)), F.transform(h, lambda x, i: run(i))
    # from ``SHORT`` on, up to the largest size that links with a shorter line, lines are met by either kind of key
    return F.when(F.size(h) * num >= SHORT * den, starts).when(F.size(h) >= SHORT, F.concat(all_of, few)).otherwise(few)


def parity_bits() -> list[Column]:
    """Of sorted hashes h ``with_ranges``, a bit for each of 64 cells of each of ``WORDS`` ranges: whether it holds an odd number of hashes."""
    bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(63).cast("int"))
    part = lambda r: F.slice("h", F.col(f"s{r}") + 1, F.col(f"s{r + 1}") - F.col(f"s{r}"))
    return [F.aggregate(part(r), F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(bit(x))).alias(f"bits{r}") for r in range(WORDS)]


def _may_link(a: str, b: str) -> Column:
    """Whether two sets can be linked: every cell of unequal parity holds a hash that only one of them has. Never false for linked sets."""
    num, den = THRESHOLD
    odd = sum((F.bit_count(F.col(f"{a}.bits{r}").bitwiseXOR(F.col(f"{b}.bits{r}"))) for r in range(WORDS)), F.lit(0))
    return odd * (num + den) <= (F.col(f"{a}.n") + F.col(f"{b}.n")) * (den - num)


def node_of(line: Column) -> Column:
    return F.unhex(F.md5(line))


def short_id(node: Column) -> Column:
    """64 bits stand for a line where candidates are sought; equal lines are told by the whole digest."""
    return F.xxhash64(node)


def _near(a: Column, b: Column) -> Column:
    """Sizes that a similarity at the threshold allows."""
    num, den = THRESHOLD
    return F.least(a, b) * den >= F.greatest(a, b) * num


def _linked(a: Column, b: Column, sizes: Column) -> Column:
    """Exact Jaccard similarity of two lines' ``runs``, of ``sizes`` distinct ones together, at or over the threshold."""
    num, den = THRESHOLD
    return F.size(F.array_intersect(a, b)) * (num + den) >= num * sizes


def sketch(h: Column) -> Column:
    """The ``BOTTOM`` smallest of sorted hashes, 31 bits of each."""
    short = lambda x: x.bitwiseAND((1 << 31) - 1).cast("int")
    return F.when(F.size(h) >= BOTTOM, F.array(*(short(F.get(h, i)) for i in range(BOTTOM)))).otherwise(F.transform(h, short))


def _likely(a: Column, b: Column) -> Column:
    """Whether two sketches share ``AGREE`` of ``BOTTOM`` hashes, in proportion if a set has fewer. Of two sets at the threshold's similarity of 0.8
    this fails about once in 300,000 times (a binomial of 16 draws with at most 5 hits), far more seldom than the bands do."""
    return F.size(F.array_intersect(a, b)) * BOTTOM >= AGREE * F.least(F.size(a), F.size(b))


def let_through(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The ``rows`` whose ``key`` a bitmap of the keys of ``wanted`` lets through: all that have such a key, and few others."""
    slot = F.pmod(key, F.lit(BITS))
    bits = wanted.select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("bits")
    )
    at = rows.withColumn("s", slot).withColumn("word", F.shiftright("s", 6))
    return at.join(F.broadcast(bits), "word").where(F.expr("shiftrightunsigned(bits, cast(s & 63 as int)) & 1") == 1).select(*rows.columns)


def wanted_lines(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (node, place, ...) with the lines at its places. The lines are read again, those that a
    bitmap of the places lets through, so neither all lines nor any shingles, eight times their size, are stored or shuffled."""
    at = lines.select(F.xxhash64("doc_key", "line_no").alias("place"), "line")
    return let_through(at, "place", wanted).join(wanted, "place").dropDuplicates(["node"]).drop("place")


def line_nodes(docs: DataFrame) -> DataFrame:
    """One row per different line: node, copies, its first place (order, then doc_key), size, sketch and band keys."""
    lines = exploded(docs)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "line_no", "doc_key")
    low = lines.select(node_of(F.col("line")).alias("node"), order.alias("first"), F.lower("line").alias("low"))
    h = low.select("node", "first", shingles(F.col("low")).alias("h"))
    keyed = with_ranges(h, RANGES).select("node", "first", F.size("h").alias("n"), sketch(F.col("h")).alias("sketch"), band_keys().alias("keys"))
    return keyed.groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("first", "n", "sketch", "keys")).alias("r")).select(
        "node", "copies", "r.first", "r.n", "r.sketch", "r.keys"
    )


def met_keys(nodes: DataFrame) -> DataFrame:
    """(key, node, n) of the band keys of several nodes, with the smallest and the largest of them, lo and hi."""
    keys = dealt(nodes.select(F.explode(F.array_distinct("keys")).alias("key"), short_id(F.col("node")).alias("node"), "n").where("key IS NOT NULL"), "key")
    ends = keys.groupBy("key").agg(F.min(F.struct("node", "n")).alias("lo"), F.max(F.struct("node", "n")).alias("hi")).where(F.col("lo.node") != F.col("hi.node"))
    return keys.join(ends, "key")


def line_components(docs: DataFrame, nodes: DataFrame, met: DataFrame) -> DataFrame:
    """node (its short id) and component (the smallest short id) of each node with a link. ``met``, a stored table of ``met_keys``, is removed.

    Band keys are met in three rounds: first each key's nodes with the smallest and the largest of them; then its other nodes, if they are
    still in different components, with two of those; then what is left of a key, if still mixed, all pairs across components. So every two nodes of
    a key are compared or in one component, and pairs inside a component, which cannot change it, are not made. The lines with a key that
    is met are read again once and stored. Pairs are told apart by size and sketch before any text is fetched. In the last round, where a group
    of lines that are alike but not linked would give all its pairs, they are first told apart by the bits of ``_may_link``.
    """
    texts = stored(texts_of(docs, nodes, met.select("node").distinct()), "line-texts")
    links = compared(texts, pairs_with(met, "lo", "hi"))
    comps = stored(connected_components(links), "line-components")

    turn = F.struct(F.xxhash64("key", "node").alias("turn"), "node", "n", "component")
    rest = still_mixed(placed(without(met, "lo", "hi"), comps))
    # the heads come from grouped minima, so a frequent key is not gathered in one task
    heads = rest.groupBy("key").agg(F.min(turn).alias("lo"), F.max(turn).alias("hi"))
    first, met = met, stored(rest.join(heads, "key"), "line-met")
    discard(first, links)
    links = compared(texts, pairs_with(met.where("component <> lo.component OR component <> hi.component"), "lo", "hi"))
    first, comps = comps, stored(connected_components(links.unionByName(comps.select(F.col("node").alias("u"), F.col("component").alias("v")))), "line-components")
    discard(first, links)

    apart = stored(still_mixed(placed(without(met, "lo", "hi"), comps)).join(texts.select("node", "sketch"), "node"), "line-apart")
    discard(met)
    # only nodes that share a key with a likely one need bits, for which their texts are read
    some = stored(apart.alias("a").join(apart.alias("b"), apart_pair(F.col("a.node") != F.col("b.node")), "left_semi"), "line-some")
    discard(apart)
    few = let_through(texts.select("node", "low"), "node", some)
    bits = with_ranges(few.select("node", shingles(F.col("low")).alias("h")), WORDS).select("node", *parity_bits())
    apart = stored(some.join(bits, "node"), "line-apart")
    discard(some)
    across = apart.alias("a").join(apart.alias("b"), apart_pair(F.col("a.node") < F.col("b.node"), _may_link("a", "b"))).select(
        F.col("a.node").alias("u"), F.col("b.node").alias("v"), (F.col("a.n") + F.col("b.n")).alias("sizes")
    )
    links = linked(stored(across.distinct(), "line-pairs"), texts)
    discard(apart, texts)
    return connected_components(links.unionByName(comps.select(F.col("node").alias("u"), F.col("component").alias("v"))))


def apart_pair(order: Column, *also: Column) -> Column:
    """Rows a and b of one key whose nodes, told apart by ``order``, are in different components and likely linked."""
    apart = (F.col("a.key") == F.col("b.key")) & order & (F.col("a.component") != F.col("b.component")) & _near(F.col("a.n"), F.col("b.n"))
    for x in also:
        apart = apart & x
    return apart & _likely(F.col("a.sketch"), F.col("b.sketch"))


def pairs_with(met: DataFrame, *heads: str) -> DataFrame:
    """Pairs (u, v) of each row's node and the heads of its key that are of similar size."""
    both = met.select("node", "n", F.explode(F.array(*(F.struct(f"{h}.node", f"{h}.n") for h in heads))).alias("head"))
    both = both.where((F.col("node") != F.col("head.node")) & _near(F.col("n"), F.col("head.n")))
    return both.select(F.least("node", "head.node").alias("u"), F.greatest("node", "head.node").alias("v")).distinct()


def without(met: DataFrame, *heads: str) -> DataFrame:
    """The rows whose node is none of the heads, which have met all of its key."""
    rows = met
    for h in heads:
        rows = rows.where(F.col("node") != F.col(f"{h}.node"))
    return rows.select("key", "node", "n")


def placed(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """``rows`` with each node's component, itself if it has none."""
    return rows.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))


def compared(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (u, v) that are linked: those of likely sketches, verified on their texts."""
    of = lambda end: texts.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("sketch").alias(f"sketch_{end}"))
    likely = pairs.join(of("u"), "u").join(of("v"), "v").where(_likely(F.col("sketch_u"), F.col("sketch_v")))
    return linked(stored(likely.select("u", "v", (F.col("n_u") + F.col("n_v")).alias("sizes")), "line-pairs"), texts)


def linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The ``verified`` ones of a stored table of pairs (u, v, sizes), which is removed."""
    few = let_through(texts.select("node", "low"), "node", pairs.select(F.explode(F.array("u", "v")).alias("node")))
    links = stored(verified(pairs, few), "line-links")
    discard(pairs)
    return links


def texts_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, n, sketch, low) of the ``nodes`` whose short ids are ``wanted``."""
    ids = nodes.select(short_id(F.col("node")).alias("node"), "n", "sketch", F.xxhash64("first.doc_key", "first.line_no").alias("place"))
    found = wanted_lines(exploded(docs), ids.join(wanted, "node", "left_semi"))
    return found.select("node", "n", "sketch", F.lower("line").alias("low"))


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (u, v) of nodes whose shingle sets, of ``sizes`` together, are similar enough, by ``texts`` (node, low)."""
    of = lambda end: texts.select(F.col("node").alias(end), F.col("low").alias(f"low_{end}"))
    both = pairs.join(of("v"), "v").join(of("u"), "u")
    return both.where(_linked(runs(F.col("low_u")), runs(F.col("low_v")), F.col("sizes"))).select("u", "v")


def still_mixed(placed: DataFrame) -> DataFrame:
    """The rows of ``placed`` (key, component, ...) whose key has nodes of different components."""
    ends = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    return placed.join(ends.select("key"), "key", "left_semi")


def line_decisions(docs: DataFrame) -> DataFrame:
    """Every line of ``docs`` (doc_id, text): doc_id, doc_key, line_no (from 0), component (hex) and kept.

    Lines without a word have no row. Equal lines, and lines whose shingle sets have a Jaccard similarity
    of at least ``THRESHOLD`` are linked; of each component the first line, by doc_id then line number, is kept. Null text: no
    lines. Null doc_id: comes last. Identical rows share their decisions, so each of them has the kept line; ``without_near_copies``
    leaves one. Extra columns are left out. Empty table: no rows.
    """
    wide = stored(line_nodes(docs), "line-nodes")
    met = stored(met_keys(wide), "line-met")
    nodes = stored(wide.drop("keys"), "line-nodes")
    discard(wide)
    comps = stored(line_components(docs, nodes, met), "line-components")
    ids = nodes.select("node", "copies", "first", short_id(F.col("node")).alias("id"))
    some = ids.join(comps.toDF("id", "component"), "id", "left").where("copies > 1 OR component IS NOT NULL")
    some = some.withColumn("component", F.coalesce("component", "id"))
    heads = some.groupBy("component").agg(F.min("first").alias("head"))
    repeated = some.select("node", "component").join(heads, "component").select("node", "component", "head.doc_key", "head.line_no")
    repeated = stored(repeated.toDF("node", "component", "head_key", "head_line"), "line-repeated")
    discard(nodes, comps)
    lines = exploded(docs).select("doc_id", "doc_key", "line_no", node_of(F.col("line")).alias("node"))
    return lines.join(repeated, "node", "left").select(
        "doc_id", "doc_key", "line_no", F.lower(F.hex(F.coalesce("component", short_id(F.col("node"))))).alias("component"),
        (F.col("head_key").isNull() | (F.col("head_key") == F.col("doc_key")) & (F.col("head_line") == F.col("line_no"))).alias("kept"),
    )


def without_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the lines that are not kept; n_chars, if there is one, counts the new text.

    All other columns stay. A document that had words and has none left is dropped; one that had none stays as it is.
    Identical rows (doc_id and text) count as one document, of which one row is left.
    """
    gone = line_decisions(docs).where("NOT kept").groupBy(F.col("doc_key").alias("__doc")).agg(F.collect_set("line_no").alias("__gone"))
    keyed = docs.withColumn("__key", doc_key())
    worded = F.coalesce(F.col("text").rlike(r"\S"), F.lit(False))
    joined = keyed.where(worded).join(gone, F.col("__key") == F.col("__doc"), "left").dropDuplicates(["__key"])
    left = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("__gone", i)), "\n")
    cut = joined.withColumn("text", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(left)).where(F.col("__gone").isNull() | F.col("text").rlike(r"\S"))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("__gone").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns).unionByName(docs.where(~worded))
