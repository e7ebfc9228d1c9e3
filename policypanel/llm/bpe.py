"""Byte-level BPE encoding in overlapping chunks, and decoding."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from policypanel.llm.common import stored

#: Characters of text a chunk owns, and characters it reads beyond them.
CHUNK, OVERLAP = 16_384, 1_024


@lru_cache(maxsize=4)
def encoder(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def token_bytes(ranks_path: str) -> dict[int, bytes]:
    with open(ranks_path, "rb") as f:
        return {int(b): base64.b64decode(a) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=4)
def splitter(pattern: str):
    # white space as the Unicode property, which leaves out the four ASCII separators
    return regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))


def boundaries(chunk: str, pattern: str, last: bool) -> list[int]:
    """Ends of the pre-tokens of ``chunk`` that the text after it cannot change and that follow a character
    other than white space. A cut there keeps both sides' pre-tokens, as the pattern only looks ahead past white space."""
    ends = [m.end() for m in splitter(pattern).finditer(chunk)]
    if not last:
        ends = [e for e in ends if e < len(chunk)]
    return [e for e in ends if not chunk[e - 1].isspace()]


def stitch_points(texts: DataFrame, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(row, cuts): for every text of (row, text) longer than a chunk, where its pieces begin, sorted, 0 first.

    Chunks are pre-tokenised as rows of their own. Two neighbours resynchronise at the first place in
    their overlap where both have a boundary: from there on they agree, as a pre-token depends only on what follows it.
    Neighbours without such a place (a pre-token longer than the overlap) stay one piece.
    """
    long = texts.where(F.length("text") > chunk)
    chunks = long.select(
        "row", F.posexplode(F.transform(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / chunk).cast("int")), lambda i: F.substr(F.col("text"), i * chunk + 1, F.lit(chunk + overlap)))).alias("n", "part"),
        F.floor((F.length("text") - 1) / chunk).cast("int").alias("last"),
    ).repartition(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "row", "n")

    def split(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            heads, tails = [], []
            for text, n, last in zip(p["part"], p["n"], p["last"]):
                ends = boundaries(text, pattern, n == last)
                heads.append([n * chunk + e for e in ends if e <= overlap])
                tails.append([n * chunk + e for e in ends if e > chunk])
            yield pd.DataFrame({"row": p["row"], "n": p["n"], "head": heads, "tail": tails})

    found = chunks.mapInPandas(split, "row long, n int, head array<long>, tail array<long>")
    nxt = F.lead("head").over(Window.partitionBy("row").orderBy("n"))
    met = found.select("row", F.array_min(F.array_intersect("tail", nxt)).alias("cut"))
    return met.groupBy("row").agg(F.sort_array(F.concat(F.array(F.lit(0).cast("long")), F.collect_list("cut"))).alias("cuts"))


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP, keep_ids: bool = False) -> DataFrame:
    """Encodes the column ``text`` of ``docs`` (doc_id, text); then decodes the ids by joining their raw bytes.

    Result, a row per input row: doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit), decoded_sha256 and, with
    ``keep_ids``, ids (binary, the same little-endian numbers). Texts beyond ``chunk`` characters are pre-tokenised
    in overlapping chunks and cut where neighbours resynchronise; their pieces are encoded as rows of their own and put
    together by position. Null text: empty, no tokens. Null or repeated doc_ids and repeated rows each keep their own
    result row. Extra columns are left out. Empty table: no rows.
    """
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ids_t = ", ids binary" if keep_ids else ""
    schema = f"doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string{ids_t}"

    def result(doc_id, ids: np.ndarray) -> tuple:
        raw = ids.astype("<u4").tobytes()
        back = token_bytes(ranks_path)
        decoded = b"".join([back[i] for i in ids.tolist()])
        return (doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded).hexdigest(), *([raw] if keep_ids else []))

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if keep_ids else [])]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=names)
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    def short(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(ranks_path, pattern)
        for p in parts:
            yield frame([result(None if pd.isna(d) else int(d), np.array(enc.encode_ordinary(t), dtype=np.uint32)) for d, t in zip(p["doc_id"], p["text"])])

    whole = base.where(F.length("text") <= chunk).mapInPandas(short, schema)

    # two plans read the numbered rows, so the numbers are written with them: a frame that is computed anew may come in another order
    long = stored(docs.where(F.length("text") > chunk).select("doc_id", "text").withColumn("row", F.monotonically_increasing_id()), "bpe-long")
    cuts = stitch_points(long.select("row", "text"), pattern, chunk, overlap)
    pieces = long.join(cuts, "row").select(
        "row", "doc_id",
        F.posexplode(F.transform("cuts", lambda c, i: F.substr(F.col("text"), (c + 1).cast("int"), (F.coalesce(F.get("cuts", i + 1), F.length("text").cast("long")) - c).cast("int")))).alias("n", "piece"),
    )

    # pieces travel with two bytes an id where the vocabulary allows it
    narrow = "<u2" if max(token_bytes(ranks_path), default=0) < 1 << 16 else "<u4"

    def encode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(ranks_path, pattern)
        for p in parts:
            ids = [np.array(enc.encode_ordinary(t), dtype=narrow).tobytes() for t in p["piece"]]
            yield pd.DataFrame({"row": p["row"], "doc_id": p["doc_id"].astype("Int64"), "n": p["n"], "ids": ids})

    encoded = pieces.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "row", "n").mapInPandas(encode, "row long, doc_id long, n int, ids binary")
    joined = encoded.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct("n", "ids"))).alias("ps")).select("doc_id", F.col("ps.ids").alias("ps"))

    def put_together(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            yield frame([result(None if pd.isna(d) else int(d), np.frombuffer(b"".join(ps), dtype=narrow)) for d, ps in zip(p["doc_id"], p["ps"])])

    return whole.unionByName(joined.mapInPandas(put_together, schema))
