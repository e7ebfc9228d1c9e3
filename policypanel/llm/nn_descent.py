"""Embedding near-duplicates by NN-descent on a neighbour graph kept as a Spark table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from policypanel.llm.common import connected_components, stored

THRESHOLD = 0.98
#: Neighbours per list inside a component and outside, random cells' size and number, rows of a list or cell that one task compares at a time.
K, CELL, TABLES, BLOCK = 10, 128, 6, 256
#: Query vectors of the recall audit in a label (the square root of its size if that is more), and rows they meet at a time.
AUDIT, CHUNK = 256, 2048
#: Single precision is off by less than this; pairs so near the threshold are decided in double precision.
SLACK = 1e-4


def node_key() -> Column:
    """A hash of label and vector; null for vectors that link with nothing."""
    e = F.col("embedding")
    ok = (
        F.col("label").isNotNull() & e.isNotNull() & (F.size(e) > 0)
        & ~F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(e, lambda x: x != 0)
    )
    # adding 0.0 makes -0.0 equal to 0.0
    return F.when(ok, F.xxhash64(F.col("label").cast("long"), F.transform(e, lambda x: x.cast("double") + F.lit(0.0))))


def usable(vectors: DataFrame) -> DataFrame:
    """(node, label, dim, copies, vec, v32): the different usable vectors per label, as unit vectors in both precisions."""
    keyed = vectors.select(node_key().alias("node"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("e")).where("node IS NOT NULL")
    one = keyed.groupBy("node").agg(F.min("label").alias("label"), F.count(F.lit(1)).alias("copies"), F.first("e").alias("e"))

    def unit(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            vec = []
            for e in p["e"]:
                x = np.asarray(e, dtype=np.float64)
                x = x / np.abs(x).max()
                vec.append(x / np.sqrt((x * x).sum()))
            yield pd.DataFrame({
                "node": p["node"], "label": p["label"], "dim": [len(x) for x in vec], "copies": p["copies"],
                "vec": [x.tobytes() for x in vec], "v32": [x.astype(np.float32).tobytes() for x in vec],
            })

    return one.mapInPandas(unit, "node long, label long, dim int, copies long, vec binary, v32 binary")


def _matrix(raw, dtype=np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(raw), dtype=dtype).reshape(len(raw), -1)


def _top(ids: np.ndarray, sim: np.ndarray, k: int, own: bool, rows: list) -> None:
    """The k nearest of each row of a similarity matrix, without itself and masked ones (under -1.5)."""
    np.fill_diagonal(sim, -2)
    k = min(k, len(ids) - 1)
    if k > 0:
        near = np.argpartition(-sim, k - 1, axis=1)[:, :k]
        for i in range(len(ids)):
            to = near[i][sim[i, near[i]] > -1.5]
            if len(to):
                rows.append((np.full(len(to), ids[i]), ids[to], sim[i, to], np.full(len(to), own), np.zeros(len(to), bool)))


def _forest(ids: np.ndarray, comp: np.ndarray, sim: np.ndarray, threshold: float, rows: list) -> None:
    """Links that join whatever components the links of a similarity matrix join: a spanning forest of the sure ones between
    components, and between its trees all pairs that only double precision can decide."""
    hit = (sim >= threshold - SLACK) & (comp[:, None] != comp)
    some = np.flatnonzero(hit.any(axis=1))
    if not len(some):
        return
    ids, comp, sim, hit = ids[some], comp[some], sim[np.ix_(some, some)], hit[np.ix_(some, some)]
    sure = hit & (sim >= threshold + SLACK)
    tree = np.full(len(ids), -1)
    us, vs = [], []
    for s in range(len(ids)):
        if tree[s] >= 0:
            continue
        todo = np.flatnonzero(comp == comp[s]).tolist()
        tree[todo] = s
        while todo:
            i = todo.pop()
            for j in np.flatnonzero(sure[i] & (tree < 0)):
                if tree[j] < 0:
                    us.append(i)
                    vs.append(j)
                    new = np.flatnonzero(comp == comp[j])
                    tree[new] = s
                    todo.extend(new.tolist())
    i, j = np.nonzero(np.triu(hit & (tree[:, None] != tree)))
    i, j = np.concatenate([np.array(us, int), i]), np.concatenate([np.array(vs, int), j])
    rows.append((ids[i], ids[j], sim[i, j], np.ones(len(i), bool), np.ones(len(i), bool)))


def _edges(rows: list) -> pd.DataFrame:
    if not rows:
        return pd.DataFrame({"u": np.empty(0, np.int64), "v": np.empty(0, np.int64), "sim": np.empty(0, np.float64), "own": np.empty(0, bool), "link": np.empty(0, bool)})
    u, v, s, own, link = (np.concatenate(x) for x in zip(*rows))
    return pd.DataFrame({"u": u, "v": v, "sim": s.astype(np.float64), "own": own, "link": link})


#: ``link``: an edge of a block's spanning forest; the others are neighbours for the lists.
EDGE = "u long, v long, sim double, link boolean"


def placed(nodes: DataFrame, comps: DataFrame | None) -> DataFrame:
    """(node, component, v32); a node without a link is its own component."""
    if comps is None:
        return nodes.select("node", F.col("node").alias("component"), "v32")
    return nodes.join(comps, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "v32")


def first_graph(nodes: DataFrame, comps: DataFrame | None, groups: DataFrame, tables: range, k: int, threshold: float) -> DataFrame:
    """Neighbours and links inside random cells: one cell per table and sign pattern of random projections.

    Each label and length (``groups``) has as many sign bits as its own size asks for. One that fits a block is one cell, compared completely
    in table 0. Cells over ``BLOCK`` rows are dealt into blocks at random; later rounds join what a cell's blocks part.
    """
    bits = F.when(F.col("n") <= BLOCK, 0).otherwise(F.ceil(F.log2(F.col("n") / CELL))).cast("int")
    sized = nodes.join(groups.select("label", "dim", bits.alias("bits")), ["label", "dim"])

    def cells(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for (dim, bits), q in p.groupby(["dim", "bits"]):
                x = _matrix(q["vec"]) if bits else None
                for t in tables if bits else [t for t in tables if t == 0]:
                    sign = np.zeros(len(q), np.int64)
                    if bits:
                        plane = np.random.default_rng([t, int(dim)]).standard_normal((int(bits), int(dim))).T
                        sign = ((x @ plane) > 0) @ (1 << np.arange(int(bits), dtype=np.int64))
                    yield pd.DataFrame({"node": q["node"], "label": q["label"], "dim": q["dim"], "t": t, "cell": sign})

    keyed = stored(sized.mapInPandas(cells, "node long, label long, dim int, t int, cell long"), "vector-cells")
    sizes = keyed.groupBy("label", "dim", "t", "cell").agg(F.count(F.lit(1)).alias("n"))
    dealt = keyed.join(sizes, ["label", "dim", "t", "cell"]).withColumn("block", F.pmod(F.xxhash64("node", "t"), F.ceil(F.col("n") / BLOCK)))
    dealt = dealt.join(placed(nodes, comps), "node").groupBy("label", "dim", "t", "cell", "block")
    blocks = dealt.agg(F.sort_array(F.collect_list(F.struct("node", "component", "v32"))).alias("m"))

    def near(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            rows: list = []
            for m in p["m"]:
                ids = np.array([r["node"] for r in m], dtype=np.int64)
                x = _matrix([r["v32"] for r in m], np.float32)
                sim = x @ x.T
                _forest(ids, np.array([r["component"] for r in m], dtype=np.int64), sim, threshold, rows)
                _top(ids, sim, k, False, rows)
            yield _edges(rows).drop(columns="own")

    return blocks.select("m").mapInPandas(near, EDGE)


def shortened(edges: DataFrame, comps: DataFrame, k: int) -> DataFrame:
    """Each node's list: its ``k`` nearest in its own component and its ``k`` nearest outside.

    Links join components, so a list cannot be filled up by links: those found are inside, and what is outside has its own places.
    """
    one = edges.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.max("old").alias("old"))
    cu, cv = comps.select(F.col("node").alias("u"), F.col("component").alias("cu")), comps.select(F.col("node").alias("v"), F.col("component").alias("cv"))
    sided = one.join(cu, "u", "left").join(cv, "v", "left").withColumn("own", F.coalesce("cu", "u") == F.coalesce("cv", "v"))
    ranked = sided.withColumn("r", F.row_number().over(Window.partitionBy("u", "own").orderBy(F.desc("sim"), "v")))
    return ranked.where(F.col("r") <= k).select("u", "v", "sim", "old")


def descended(graph: DataFrame, nodes: DataFrame, comps: DataFrame, turn: int, k: int, threshold: float) -> DataFrame:
    """New edges from one round of neighbours of neighbours.

    At every node its neighbours both ways are compared with one another, pairs with at least one
    end new to the node. Nodes with more than ``BLOCK`` neighbours compare them in blocks that are dealt anew each round, old ones too. Returned
    are, for each compared node, its best new neighbours in the block inside and outside its component, and links between components.
    """
    both = graph.select("u", "v", "old").unionByName(graph.select(F.col("v").alias("u"), F.col("u").alias("v"), "old")).groupBy("u", "v").agg(F.min("old").alias("old"))
    sized = both.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("u")))
    dealt = sized.withColumn("block", F.pmod(F.xxhash64("v", F.lit(turn)), F.ceil(F.col("n") / BLOCK))).withColumn("old", F.col("old") & (F.col("n") <= BLOCK))
    ends = placed(nodes, comps).withColumnRenamed("node", "v")
    local = dealt.join(ends, "v").groupBy("u", "block").agg(F.collect_list(F.struct("v", "component", "v32", "old")).alias("m")).select("m")

    def join(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            rows: list = []
            for m in p["m"]:
                old = np.array([r["old"] for r in m], dtype=bool)
                if len(m) < 2 or old.all():
                    continue
                ids = np.array([r["v"] for r in m], dtype=np.int64)
                comp = np.array([r["component"] for r in m], dtype=np.int64)
                x = _matrix([r["v32"] for r in m], np.float32)
                sim = x @ x.T
                _forest(ids, comp, sim, threshold, rows)
                sim[np.ix_(old, old)] = -2
                own = comp[:, None] == comp
                for side in (True, False):
                    if (own == side).any():
                        _top(ids, np.where(own == side, sim, -2), k, side, rows)
            e = _edges(rows).sort_values(["link", "sim"], ascending=False).drop_duplicates(["u", "v"])
            # a list takes no more than k of either side; links always leave
            near = e[~e["link"]]
            yield pd.concat([e[e["link"]], near[near.groupby(["u", "own"]).cumcount() < k]]).drop(columns="own")

    return local.mapInPandas(join, EDGE)


def compared(nodes: DataFrame, comps: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """Links that join whatever is joined in ``groups`` (label, dim, n): all their vectors are compared, block by block."""
    sizes = groups.select("label", "dim", F.ceil(F.col("n") / (2 * BLOCK)).cast("int").alias("blocks"))
    members = nodes.select("node", "label", "dim").join(sizes, ["label", "dim"]).join(placed(nodes, comps), "node").withColumn("b", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    tiles = members.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("b <> o OR blocks = 1")
    tiles = tiles.groupBy("label", "dim", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j")).agg(F.collect_list(F.struct("node", "component", "v32")).alias("m"))

    def near(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            rows: list = []
            for m in p["m"]:
                x = _matrix([r["v32"] for r in m], np.float32)
                ids, comp = (np.array([r[c] for r in m], dtype=np.int64) for c in ("node", "component"))
                _forest(ids, comp, x @ x.T, threshold, rows)
            yield _edges(rows).drop(columns="own")

    return tiles.select("m").mapInPandas(near, EDGE)


def joined(comps: DataFrame | None, found: DataFrame, nodes: DataFrame, threshold: float) -> tuple[DataFrame, bool]:
    """Components after the links of ``found``, each between two of ``comps``, and whether there were any."""
    links = stored(linked(found.where("link"), nodes, threshold), "vector-links")
    if comps is not None:
        if links.isEmpty():
            return comps, False
        links = links.unionByName(comps.select(F.col("node").alias("u"), F.col("component").alias("v")))
    return stored(connected_components(links), "vector-components"), True


def linked(edges: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Edges (u, v), u < v, at or over ``threshold`` in double precision."""
    near = edges.where(F.col("sim") >= threshold - SLACK).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    both = near.join(nodes.select(F.col("node").alias("u"), F.col("vec").alias("xu")), "u").join(nodes.select(F.col("node").alias("v"), F.col("vec").alias("xv")), "v")

    def exact(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            keep = [float(np.dot(np.frombuffer(a), np.frombuffer(b))) >= threshold for a, b in zip(p["xu"], p["xv"])]
            yield p.loc[keep, ["u", "v"]]

    return both.mapInPandas(exact, "u long, v long")


def counted(comps: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(node, links): the copies-weighted number of vectors linked with each node of a component, itself included.

    Lists are not asked, as they hold only the nearest: a component's members are compared block by block in double
    precision, and only the sums leave a task, not the pairs.
    """
    sizes = comps.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / (2 * BLOCK)).cast("int").alias("blocks"))
    members = comps.join(sizes, "component").join(nodes.select("node", "copies", "vec"), "node")
    members = members.withColumn("b", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    tiles = members.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "b", "node", "copies", "vec"
    )
    grouped = tiles.groupBy("component", "i", "j").agg(F.collect_list(F.struct("b", "node", "copies", "vec")).alias("m"))

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            nodes_out, links_out = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for i, j, m in zip(p["i"], p["j"], p["m"]):
                b = np.array([r["b"] for r in m])
                ids = np.array([r["node"] for r in m], dtype=np.int64)
                copies = np.array([r["copies"] for r in m], dtype=np.int64)
                x = _matrix([r["vec"] for r in m])
                left, right = np.flatnonzero(b == i), np.flatnonzero(b == j)
                hit = x[left] @ x[right].T >= threshold
                if i == j:
                    np.fill_diagonal(hit, True)
                else:
                    nodes_out.append(ids[right])
                    links_out.append(hit.T @ copies[left])
                nodes_out.append(ids[left])
                links_out.append(hit @ copies[right])
            yield pd.DataFrame({"node": np.concatenate(nodes_out), "links": np.concatenate(links_out)})

    return grouped.mapInPandas(count, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))


def below_recall(comps: DataFrame, nodes: DataFrame, groups: DataFrame, threshold: float, recall: float) -> DataFrame:
    """The ``groups`` (label, dim, n) in which too few links of the query vectors have both ends in one component.

    Query vectors are drawn in every group that is not compared completely anyway, more in larger ones, and compared with the whole group.
    """
    asked = F.greatest(F.lit(float(AUDIT)), F.sqrt("n"))
    big = groups.where(F.col("n") > BLOCK).select("label", "dim", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"), F.ceil(asked / F.col("n") * 1_000_000).alias("share"))
    members = nodes.join(big, ["label", "dim"]).join(comps, "node", "left").select(
        "label", "dim", "chunks", "share", "node", F.coalesce("component", "node").alias("component"), "vec"
    )
    queries = members.where(F.pmod(F.xxhash64("node", F.lit(17)), F.lit(1_000_000)) < F.col("share")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = members.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")).withColumn("ask", F.lit(False)).unionByName(queries.withColumn("ask", F.lit(True)))
    chunks = rows.groupBy("label", "dim", "chunk").agg(F.collect_list(F.struct("ask", "node", "component", "vec")).alias("m"))

    def compare(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = []
            for label, dim, m in zip(p["label"], p["dim"], p["m"]):
                ask = np.array([r["ask"] for r in m], dtype=bool)
                ids = np.array([r["node"] for r in m], dtype=np.int64)
                comp = np.array([r["component"] for r in m], dtype=np.int64)
                if ask.any() and not ask.all():
                    x = _matrix([r["vec"] for r in m])
                    hit = (x[ask] @ x[~ask].T >= threshold) & (ids[ask][:, None] != ids[~ask])
                    out.append((label, dim, hit.sum(), (hit & (comp[ask][:, None] == comp[~ask])).sum()))
            yield pd.DataFrame(out, columns=["label", "dim", "links", "hits"])

    shares = chunks.mapInPandas(compare, "label long, dim int, links long, hits long").groupBy("label", "dim").agg(F.sum("links").alias("links"), F.sum("hits").alias("hits"))
    return groups.join(shares.where(F.col("hits") < recall * F.col("links")), ["label", "dim"], "left_semi")


def near_duplicate_vectors(vectors: DataFrame, threshold: float = THRESHOLD, k: int = K, rounds: int = 3, recall: float = 0.995, more: int = 3) -> DataFrame:
    """Per vector: vec_id, n_links, component_id and kept, over links with equal label and cosine at or over ``threshold``.

    Exactly equal vectors of a label are one node with a count. A first graph joins neighbours inside random cells; each round
    then compares every node's neighbours with one another and keeps the nearest, as many inside the node's component as outside.
    Every comparison of a block also returns links that join all components its links join, however many neighbours are closer. Rounds end when one joins no components and is the ``rounds``-th or finds fewer than a thousandth new list entries. The audit
    then compares query vectors of each label with the whole label; below ``recall``, further random cells and rounds are added, ``more`` times
    at most, and labels still below it are compared completely. Links are counted over each component in double precision.

    Vectors that are null, empty, zero or hold null or non-finite components, or have a null label, link with nothing: n_links 0 and
    their own component. Vectors of different lengths never link. Null vec_id: counts as a vector, never the smallest unless
    alone (its component_id is then null, and kept true). Repeated rows: equal vectors. Extra columns are left out. Empty table: no rows.
    """
    nodes = stored(usable(vectors), "vector-nodes")
    groups = stored(nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")), "vector-groups")
    found = stored(first_graph(nodes, None, groups, range(TABLES), k, threshold), "vector-found")
    comps, _ = joined(None, found, nodes, threshold)
    graph = stored(shortened(found.withColumn("old", F.lit(False)), comps, k), "vector-graph")

    def longer() -> DataFrame:
        both = graph.withColumn("old", F.lit(True)).unionByName(found.select("u", "v", "sim", F.lit(False).alias("old")))
        return stored(shortened(both, comps, k), "vector-graph")

    turn = extra = 0
    while True:
        turn += 1
        found = stored(descended(graph, nodes, comps, turn, k, threshold), "vector-found")
        comps, moved = joined(comps, found, nodes, threshold)
        graph = longer()
        if moved or turn < rounds and graph.where("NOT old").count() * 1000 >= graph.count():
            continue
        low = stored(below_recall(comps, nodes, groups, threshold, recall), "vector-low")
        if low.isEmpty():
            break
        if extra == more:
            comps, _ = joined(comps, compared(nodes, comps, low, threshold), nodes, threshold)
            break
        extra += 1
        found = stored(first_graph(nodes, comps, groups, range(TABLES * extra, TABLES * (extra + 1)), k, threshold), "vector-found")
        comps, _ = joined(comps, found, nodes, threshold)
        graph = longer()
    links = counted(comps, nodes, threshold)
    alone = nodes.select("node", "copies").join(comps, "node", "left").join(links, "node", "left")
    of_node = alone.select("node", F.coalesce("component", "node").alias("component"), (F.coalesce("links", "copies") - 1).alias("n_links"))

    ids = vectors.select("vec_id", node_key().alias("node"), F.col("label").isNotNull().alias("labelled"))
    low = F.struct(F.col("vec_id").isNull().alias("none"), "vec_id")
    by_node = ids.groupBy("node").agg(F.min(low).alias("low")).join(of_node, "node")
    head = by_node.groupBy("component").agg(F.min("low.vec_id").alias("component_id"))
    per_node = by_node.join(head, "component").select("node", "n_links", "component_id")
    out = ids.join(per_node, "node", "left")
    own = F.col("n_links").isNull()
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(own, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(own, True).otherwise(F.col("vec_id").eqNullSafe(F.col("component_id"))).alias("kept"),
    )
