"""Token counts by a map-side lookup in two tiers: a broadcast table of frequent words, then each worker's own cache."""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import filterfalse, repeat

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: Documents, about, whose words are counted to choose the frequent ones. The choice changes the speed, never a count.
SAMPLE = 4096
#: Words in the broadcast table at most, and bytes of a word there or in a cache at most: 2 MB.
FREQUENT, WORD_BYTES = 32_768, 64
#: Words a worker remembers before it starts anew.
REMEMBERED = 500_000
#: Bytes of a text split at a time.
WINDOW = 1 << 20

SPACE = re.compile(rb"[ \t\n\r\x0b\x0c]")
COUNTED = "doc_id long, n_bytes long, n_tokens long"


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(maxsize=4)
def pieces(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=4)
def words_apart(path: str) -> bool:
    """Whether the tokenizer drops white space and never looks across it, so that a text has the tokens of its words."""
    if path.endswith(".model"):
        return False
    t = tokenizer(path)
    if t.normalizer is None or t.pre_tokenizer is None:
        return False
    probe = "aé \t'x 1\n\x0b<\x0c|\r z"
    got = [w for w, _ in t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(probe))]
    apart = [w for x in probe.split() for w, _ in t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(x))]
    return got == apart and not any(re.search(r"\s", k) for k in (a.content for a in t.get_added_tokens_decoder().values()))


def count_whole(path: str, text: str) -> int:
    """Tokens of ``text`` as the library counts them: special strings as its default has them, no begin, end, padding or truncation."""
    if path.endswith(".model"):
        return len(pieces(path).encode(text))
    return len(tokenizer(path).encode(text, add_special_tokens=False).ids)


class Cache(dict):
    """Second tier: word (UTF-8 bytes) -> its tokens. Words are learned many at a time; the cache is emptied when it
    would hold more than ``REMEMBERED`` words. A word it lacks, such as one of over ``WORD_BYTES`` bytes, is encoded each time it is met."""

    def __init__(self, path: str):
        self.path = path

    def __missing__(self, word: bytes) -> int:
        return count_whole(self.path, word.decode("utf-8", "replace"))

    def learn(self, words: set[bytes]) -> None:
        new = [w for w in words if len(w) <= WORD_BYTES and w not in self]
        if len(self) + len(new) > REMEMBERED:
            self.clear()
        encoded = tokenizer(self.path).encode_batch_fast([w.decode("utf-8", "replace") for w in new], add_special_tokens=False)
        self.update(zip(new, map(len, encoded)))


@lru_cache(maxsize=2)
def cache(path: str) -> Cache:
    return Cache(path)


def packed(lengths: dict[bytes, int]) -> bytes:
    """The first tier as it travels: two bytes a word for its tokens, then the words, compressed together."""
    words = sorted(lengths)
    counts = np.array([lengths[w] for w in words], dtype="<u2").tobytes()
    return zlib.compress(len(words).to_bytes(4, "little") + counts + b"\n".join(words))


@lru_cache(maxsize=2)
def unpacked(blob: bytes) -> dict[bytes, int]:
    raw = zlib.decompress(blob)
    n = int.from_bytes(raw[:4], "little")
    return dict(zip(raw[4 + 2 * n:].split(b"\n"), np.frombuffer(raw[4:4 + 2 * n], dtype="<u2").tolist())) if n else {}


def windows(raw: bytes, size: int = WINDOW) -> Iterator[bytes]:
    """``raw`` in parts of about ``size`` bytes, cut at white space only."""
    at = 0
    while at < len(raw):
        cut = SPACE.search(raw, at + size) if len(raw) - at > size else None
        end = cut.start() if cut else len(raw)
        yield raw[at:end]
        at = end


def frequent_words(docs: DataFrame, sample: int = SAMPLE, size: int = FREQUENT) -> Counter:
    """The ``size`` most frequent words of about ``sample`` documents drawn from all of ``docs``, with their counts there.

    Each of eight tasks returns one row, its ``size`` most frequent words at most, so the driver receives a few MB at any scale.
    """
    total = docs.count()
    drawn = docs.select("text").where("text IS NOT NULL")
    if total > sample:
        drawn = drawn.sample(False, sample / total, seed=1)

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for p in parts:
            for text in p["text"]:
                for part in windows(text.encode("utf-8", "replace")):
                    seen.update(w for w in part.split() if len(w) <= WORD_BYTES)
                if len(seen) > 8 * size:
                    seen = Counter(dict(seen.most_common(4 * size)))
        top = seen.most_common(size)
        yield pd.DataFrame({"words": [b"\n".join(w for w, _ in top)], "counts": [[n for _, n in top]]})

    out: Counter = Counter()
    for row in drawn.repartition(8).mapInPandas(count, "words binary, counts array<long>").collect():
        if row["counts"]:
            out.update(dict(zip(bytes(row["words"]).split(b"\n"), row["counts"])))
    return Counter(dict(out.most_common(size)))


def count_tokens(docs: DataFrame, path: str, sample: int = SAMPLE, size: int = FREQUENT) -> DataFrame:
    """Counts the tokens of every whole text of ``docs`` (doc_id, text), as the library of ``path`` (.json: tokenizers, .model: sentencepiece) gives them.

    Where the tokenizer drops white space, a text has the tokens of its words. A compact table of the frequent words' lengths is broadcast (at most ``size`` words);
    a word beyond it is looked up in the worker's cache, which outlives the task; those that it lacks too are encoded together, about a MB of text at a time. Rows are only mapped: no word is
    shuffled. Other tokenizers' texts are encoded whole.

    Result, a row per input row: doc_id, n_bytes (UTF-8), n_tokens. Null text: empty, no tokens. Null and repeated doc_ids and repeated
    rows each keep their own row. Extra columns are left out. Empty table: no rows.
    """
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    if not words_apart(path):

        def whole(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for p in parts:
                sizes = [len(t.encode("utf-8", "replace")) for t in p["text"]]
                yield pd.DataFrame({"doc_id": p["doc_id"].astype("Int64"), "n_bytes": sizes, "n_tokens": [count_whole(path, t) for t in p["text"]]})

        return base.mapInPandas(whole, COUNTED)

    words = list(frequent_words(docs, sample, size))
    encoded = tokenizer(path).encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)
    table = docs.sparkSession.sparkContext.broadcast(packed(dict(zip(words, map(len, encoded)))))

    def look_up(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        first, second = unpacked(table.value), cache(path)
        for p in parts:
            sizes = [0] * len(p)
            counts = [0] * len(p)
            held: list[tuple[int, list[bytes]]] = []
            waiting = 0

            def count_held() -> None:
                second.learn(set().union(*(rest for _, rest in held)))
                for k, rest in held:
                    counts[k] += sum(map(second.__getitem__, rest))
                held.clear()

            for k, text in enumerate(p["text"]):
                raw = text.encode("utf-8", "replace")
                sizes[k] = len(raw)
                for part in windows(raw):
                    found = part.split()
                    counts[k] += sum(map(first.get, found, repeat(0)))
                    held.append((k, list(filterfalse(first.__contains__, found))))
                    waiting += len(part)
                    if waiting >= WINDOW:
                        count_held()
                        waiting = 0
            count_held()
            yield pd.DataFrame({"doc_id": p["doc_id"].astype("Int64"), "n_bytes": sizes, "n_tokens": counts})

    return base.mapInPandas(look_up, COUNTED)
