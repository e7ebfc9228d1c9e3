"""Spelling variant grouping by blocked Gram matrices of letter counts."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from policypanel.llm.common import dealt, stored

#: Shortest word, and occurrences a word needs.
MIN_LENGTH, MIN_COUNT = 6, 5
#: A form is so many times as frequent as its variant.
RATIO = 5
#: One run in so many, by its hash, loses a code point.
SLIP = 199
#: Letters fall into so many classes by code point; a word's class counts name its block.
CLASSES = 5
#: Bytes of words in a tile, and rows of a product made at a time.
TILE, STRIP = 32_768, 512
#: Distinct words a task counts before it passes them on.
COUNTED = 500_000


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, slip: int = SLIP) -> DataFrame:
    """(word, n): the words of all whole texts with at least ``min_length`` code points and ``min_count`` occurrences.

    Runs of ASCII and Latin-1 letters, A-Z lower-cased. Where ``slip`` divides the crc32 of ``doc_id:run``, the run loses the
    code point at crc32 % length. Tasks count in bounded dictionaries before the shuffle, so a frequent word leaves each as a few rows.
    """
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{min_length},}}")

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[bytes, int] = {}

        def out() -> pd.DataFrame:
            rows = pd.DataFrame({"word": [w.decode("latin-1") for w in seen], "n": list(seen.values())})
            seen.clear()
            return rows.astype({"word": object, "n": "int64"})

        for p in parts:
            for doc_id, text in zip(p["doc_id"], p["text"]):
                head = zlib.crc32(f"{doc_id}:".encode())
                for m in runs.finditer(text):
                    word = m.group().encode("latin-1").lower()
                    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), head)
                    if h % slip == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < min_length:
                            continue
                    seen[word] = seen.get(word, 0) + 1
                if len(seen) >= COUNTED:
                    yield out()
        if seen:
            yield out()

    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text").where("text IS NOT NULL")
    counts = texts.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= min_count)


def class_counts(classes: int):
    """A word's letters per class: code point % ``classes``, over a to z and U+00C0 to U+00FF."""
    letters = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
    of = ["".join(chr(c) for c in letters if c % classes == k) for k in range(classes)]
    return F.array(*[F.length("word") - F.length(F.translate("word", x, "")) for x in of])


def tiles(words: DataFrame, classes: int = CLASSES, tile_bytes: int = TILE) -> DataFrame:
    """(block, tile, letters, ns): words of equal class counts, hence of equal length, in tiles of about ``tile_bytes``, sorted, their letters in one string."""
    keyed = words.select("word", "n", class_counts(classes).alias("block"))
    sizes = keyed.groupBy("block").agg(F.ceil(F.sum(F.length("word")) / tile_bytes).alias("tiles"))
    return (
        keyed.join(sizes, "block")
        .groupBy("block", F.pmod(F.xxhash64("word"), F.col("tiles")).alias("tile"))
        .agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("ws"))
        .select("block", "tile", F.array_join("ws.word", "").alias("letters"), F.col("ws.n").alias("ns"))
    )


def tile_pairs(held: DataFrame, classes: int = CLASSES) -> DataFrame:
    """(block, tile, block2, tile2): every two tiles that can hold words one edit apart, once; a tile and itself included.

    A replaced letter moves one count from a class to another or leaves all; an added letter adds one. The second block is the own one, a later one of the same
    length with one count moved, or one of the next length with one count more. Rows grow with the tiles of neighbouring blocks, not with pairs of words.
    """
    def changed(up: int, down: int | None):
        return F.transform("block", lambda x, i: x + F.when(i == up, 1).otherwise(0) - (F.when(i == down, 1).otherwise(0) if down is not None else F.lit(0)))

    near = [F.col("block"), *[changed(k, None) for k in range(classes)]]
    near += [F.when(F.get("block", F.lit(j)) > 0, changed(i, j)) for i in range(classes) for j in range(i + 1, classes)]
    ids = held.select("block", "tile")
    seek = ids.select("block", "tile", F.explode(F.array(*near)).alias("block2")).where("block2 IS NOT NULL")
    there = ids.select(F.col("block").alias("block2"), F.col("tile").alias("tile2"))
    return seek.join(there, "block2").where("block <> block2 OR tile <= tile2").select("block", "tile", "block2", "tile2")


def codes(letters: str, n: int) -> np.ndarray:
    return np.frombuffer(letters.encode("latin-1"), dtype=np.uint8).reshape(n, -1)


def letter_counts(a: np.ndarray, used: np.ndarray) -> np.ndarray:
    n = len(a)
    at = np.searchsorted(used, a) + np.arange(n)[:, None] * len(used)
    return np.bincount(at.ravel(), minlength=n * len(used)).reshape(n, len(used)).astype(np.float64 if a.shape[1] > 1000 else np.float32)


def near_pairs(a: np.ndarray, b: np.ndarray, strip: int = STRIP) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (i, j) of the words ``a`` and the words ``b``, as long or one longer, that differ by exactly one replaced or inserted code point.

    One product of letter counts, with the squared norms as two more columns, gives all squared distances: 1 for an inserted letter, 2 for a replaced one.
    Pairs at most at two are verified, letter by letter.
    """
    longer = b.shape[1] - a.shape[1]
    used = np.union1d(a, b)
    ca, cb = letter_counts(a, used), letter_counts(b, used)
    left = np.column_stack([ca, (ca * ca).sum(axis=1), np.ones_like(ca[:, 0])])
    right = np.column_stack([-2 * cb, np.ones_like(cb[:, 0]), (cb * cb).sum(axis=1)]).T
    width = max(1, (1 << 22) // max(1, b.shape[1]))
    for at in range(0, len(a), strip):
        square = left[at:at + strip] @ right
        i, j = np.divmod(np.flatnonzero(square < 2.5), len(b))
        for k in range(0, len(i), width):
            x, y = a[at + i[k:k + width]], b[j[k:k + width]]
            if longer:
                before = np.cumprod(x == y[:, :-1], axis=1, dtype=np.uint8).sum(axis=1)
                after = np.cumprod((x == y[:, 1:])[:, ::-1], axis=1, dtype=np.uint8).sum(axis=1)
                good = before + after >= x.shape[1]
            else:
                good = (x != y).sum(axis=1) == 1
            yield at + i[k:k + width][good], j[k:k + width][good]


def neighbours(words: DataFrame, classes: int = CLASSES, tile_bytes: int = TILE) -> DataFrame:
    """(word, n_near, near, near_n): for each word of (word, n) with near words their number and the most frequent of them, ties to the smallest.

    Tiles meet tiles in one product; each meeting returns one row per word with near words, so their sums are all that is shuffled.
    """
    held = stored(tiles(words, classes, tile_bytes), "spelling-tiles")
    a = held.select("block", "tile", F.col("letters").alias("a"), F.col("ns").alias("an"))
    b = held.select(F.col("block").alias("block2"), F.col("tile").alias("tile2"), F.col("letters").alias("b"), F.col("ns").alias("bn"))
    # few bytes, much arithmetic: dealt to as many tasks as the session shuffles into
    met = dealt(
        tile_pairs(held, classes).join(a, ["block", "tile"]).join(b, ["block2", "tile2"])
        .select("block", "tile", "block2", "tile2", "a", "an", "b", "bn"),
        "block", "tile", "block2", "tile2",
    ).select(((F.col("block") == F.col("block2")) & (F.col("tile") == F.col("tile2"))).alias("same"), "a", "an", "b", "bn")

    def best(of: np.ndarray, i: np.ndarray, j: np.ndarray, other: np.ndarray, other_n: np.ndarray) -> Iterator[tuple]:
        """A row for each of the words ``of`` with near words among ``other``; i and j are the places of both in the near pairs."""
        hits = np.bincount(i, minlength=len(of))
        order = np.lexsort((np.arange(len(other_n)), -other_n))
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        low = np.full(len(of), len(order), dtype=np.int64)
        np.minimum.at(low, i, rank[j])
        for k in np.flatnonzero(hits).tolist():
            top = order[low[k]]
            yield of[k].tobytes().decode("latin-1"), int(hits[k]), other[top].tobytes().decode("latin-1"), int(other_n[top])

    def compare(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        names = ["word", "n_near", "near", "near_n"]
        for p in parts:
            for same, x, xn, y, yn in zip(p["same"], p["a"], p["an"], p["b"], p["bn"]):
                u, v = codes(x, len(xn)), codes(y, len(yn))
                i, j = (np.concatenate(k) for k in zip(*[(np.empty(0, np.int64),) * 2, *near_pairs(u, v)]))
                if len(i):
                    rows.extend(best(u, i, j, v, np.asarray(yn)))
                    if not same:
                        rows.extend(best(v, j, i, u, np.asarray(xn)))
                if len(rows) >= 50_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
        if rows:
            yield pd.DataFrame(rows, columns=names)

    rows = met.mapInPandas(compare, "word string, n_near long, near string, near_n long")
    top = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near")))
    return rows.groupBy("word").agg(F.sum("n_near").alias("n_near"), top.alias("t")).select(
        "word", "n_near", F.col("t.near").alias("near"), (-F.col("t.m")).alias("near_n"))


def roots(forms: DataFrame, name: str = "spelling-roots") -> DataFrame:
    """(word, root) of (word, form): where the forms lead in the end, by doubling the steps. Forms grow in frequency, so there are no rings."""
    cur = stored(forms.select("word", F.col("form").alias("root")), name)
    while True:
        ahead = cur.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(cur.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), name)
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        cur = step.select("word", "root")


def spelling_variants(docs: DataFrame, ratio: int = RATIO, classes: int = CLASSES, tile_bytes: int = TILE, **kw) -> DataFrame:
    """Groups the words of ``docs`` (doc_id, text) that are spelled alike under the most frequent spelling.

    Two words are near if one inserted, deleted or replaced code point makes one the other. A word's form is its most frequent near word, ties to
    the smallest, if at least ``ratio`` times as frequent; root follows the forms to the last. Words are blocked by length and letter-class counts; blocks
    that one edit can link meet tile by tile in matrix products of letter counts, and pairs at squared distance 1 or 2 are verified.

    Result, a row per word: word, form (or null), root (the word itself without form), n, n_near, form_n (or null). Null text: no words.
    Null doc_id: an empty string where it is hashed. Repeated rows each count. Extra columns are ignored. Empty table: no rows.
    """
    words = stored(word_counts(docs, **kw), "spelling-words")
    known = words.join(neighbours(words, classes, tile_bytes), "word", "left")
    formed = F.col("near_n") >= ratio * F.col("n")
    held = stored(known.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(formed, F.col("near")).alias("form"), F.when(formed, F.col("near_n")).alias("form_n"),
    ), "spelling-forms")
    last = roots(held.where("form IS NOT NULL"))
    return held.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
