"""Best-fit packing of tokenised documents under several capacities at once."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from policypanel.llm.common import stored

MAX_TOKENS = 2048
#: Pieces that one task packs together. Each such block leaves about one sequence unfilled.
BLOCK = 8192
#: Words a worker remembers with their ids before it starts anew.
REMEMBERED = 1_000_000

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECE + ", sequence_id long, offset long"


class WordIds(dict):
    """Word (bytes without ASCII white space) -> its ids as little-endian unsigned 32-bit bytes.

    For a BPE tokenizer that drops white space and marks word ends, so that words can be encoded one by one: a merge
    table keyed by bytes, with the byte 255 (never part of UTF-8) as the end mark, gives the same ids as the tokenizer in less time.
    Words with letters beyond the Latin blocks go through the tokenizer itself.
    """

    #: The tokenizer's pre-token pattern.
    PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

    def __init__(self, tokenizer_path: str):
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.encode_special_tokens = True
        special = set(self.tokenizer.get_added_tokens_decoder())
        byte_of = _byte_of_character()
        ranks = {}
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            if i not in special:
                body = token.removesuffix("</w>")
                ranks[bytes(byte_of[c] for c in body) + b"\xff" * (body != token)] = i
        self.merges = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, raw: bytes) -> bytes:
        word = raw.decode("utf-8", "replace")
        if word.isascii():
            word = word.lower()
        elif max(word) <= "\u024f":
            word = self.tokenizer.normalizer.normalize_str(word)
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            got = self[raw] = struct.pack(f"<{len(ids)}I", *ids)
            return got
        ids = []
        for piece in self.PRETOKEN.findall(word):
            ids += self.merges._encode_single_piece(piece.encode() + b"\xff")
        got = self[raw] = struct.pack(f"<{len(ids)}I", *ids)
        return got

    def encode(self, text: str) -> bytes:
        if len(self) > REMEMBERED:
            self.clear()
        return b"".join(map(self.__getitem__, text.encode("utf-8", "replace").split()))


def _byte_of_character() -> dict[str, int]:
    """Byte-level BPE writes printable Latin-1 bytes as themselves and the others, in order, from code point 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(others)}


@lru_cache(maxsize=2)
def word_ids(tokenizer_path: str) -> WordIds:
    return WordIds(tokenizer_path)


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS, end_id: int = 0) -> DataFrame:
    """The pieces of every document: its ids, then ``end_id``, cut every ``max_tokens``."""
    step = 4 * max_tokens
    end = np.array([end_id], dtype="<u4").tobytes()

    def pieces(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = word_ids(tokenizer_path)
        for p in parts:
            rows = []
            for doc_id, text in zip(p["doc_id"], p["text"]):
                raw = words.encode(text) + end
                for i, at in enumerate(range(0, len(raw), step)):
                    cut = raw[at : at + step]
                    rows.append((None if pd.isna(doc_id) else int(doc_id), i, at // 4, len(cut) // 4, zlib.crc32(cut)))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(pieces, PIECE)


def vector_best_fit(lengths: np.ndarray, capacity: np.ndarray, weights: np.ndarray, score: str = "norm") -> np.ndarray:
    """Bin of each item. Items come largest first; each goes to the best open bin that has room in every dimension.

    An item of n tokens takes (n, 1, n * n) of the capacities (tokens, documents, attention cost), all scaled by the capacity.
    ``norm``: the bin whose weighted residual after the item has the smallest norm. ``dot``: the bin
    whose residual has the largest weighted dot product with the item. Ties: the oldest bin.
    Without a bin that fits, a new one is opened. An item that exceeds a capacity by itself gets a bin of its own.
    """
    n = len(lengths)
    need = np.stack([lengths, np.ones(n), lengths.astype(float) ** 2], axis=1)
    left = np.empty((n, 3))
    bins = np.empty(n, dtype=np.int64)
    made = 0
    # bins with too little room for the smallest item are no longer looked at
    smallest = need.min(axis=0) if n else np.zeros(3)
    live = np.empty(0, dtype=np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        room = left[live]
        fits = (room >= need[i]).all(axis=1)
        at = np.flatnonzero(fits)
        if len(at):
            rest = (room[at] - need[i]) / capacity
            s = -(weights * rest * rest).sum(axis=1) if score == "norm" else (weights * (room[at] / capacity) * (need[i] / capacity)).sum(axis=1)
            b = live[at[np.argmax(s)]]
            left[b] -= need[i]
        else:
            b, made = made, made + 1
            left[b] = capacity - need[i]
            if (left[b] >= smallest).all():
                live = np.append(live, b)
        bins[i] = b
        if (left[b] < smallest).any():
            live = live[live != b]
    return bins


def pack_pieces(
    pieces: DataFrame,
    max_tokens: int = MAX_TOKENS,
    max_docs: int | None = None,
    max_attention: float | None = None,
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3),
    score: str = "norm",
    block: int = BLOCK,
) -> DataFrame:
    """``pieces`` with sequence_id and offset.

    Pieces are dealt at random into blocks of about ``block``, so each block has the same mix of lengths, and each block is
    packed in one task. No sequence exceeds ``max_tokens``, ``max_docs`` pieces or a sum of squared lengths of ``max_attention``
    (None: as many documents as tokens, the square of ``max_tokens``: then only tokens bind).
    """
    held = stored(pieces, "pieces")
    blocks = max(1, -(-held.count() // block))
    capacity = np.array([max_tokens, max_docs or max_tokens, max_attention or float(max_tokens) ** 2], dtype=float)
    w = np.array(weights)
    # dealt by place in the stored table, so that repeated rows spread
    dealt = held.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)))

    def pack(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(["length", "ids_crc32", "doc_id", "piece"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        bins = vector_best_fit(p["length"].to_numpy(), capacity, w, score)
        p["sequence_id"] = (int(key[0]) << 24) + bins
        p["offset"] = p.groupby("sequence_id")["length"].cumsum() - p["length"]
        p["doc_id"] = p["doc_id"].astype("Int64")
        return p[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    return dealt.groupBy("block").applyInPandas(pack, PACKED)


def pack_documents(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS, **kw) -> DataFrame:
    """Tokenises ``docs`` (doc_id, text) and packs them; one row per piece.

    Null text: empty, that is the end id alone. Only documents longer than ``max_tokens`` are cut. Null
    and repeated doc_ids and repeated rows each keep their own pieces. Extra columns are left out. Empty table: no rows.
    """
    return pack_pieces(tokenised_pieces(docs, tokenizer_path, max_tokens), max_tokens, **kw)
