"""Quality rules as a short-circuit cascade, ordered by rejections per cost."""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SYMBOLS = b"#*$%&|<>"
#: UTF-8 bytes that continue a code point.
_CONTINUATION = bytes(range(0x80, 0xC0))


class Doc:
    """One text with its measures, each computed when a rule first asks for it."""

    def __init__(self, text: str | None):
        self.raw = (text or "").encode("utf-8", "surrogatepass")

    def __getattr__(self, name: str):
        if name not in MEASURES:
            raise AttributeError(name)
        value = MEASURES[name](self)
        setattr(self, name, value)
        return value


def _word_chars(d: Doc) -> int:
    # white space is ASCII, so every continuation byte is inside a word
    return sum(map(len, d.words)) - (len(d.raw) - len(d.raw.translate(None, _CONTINUATION)))


def _n_dup_lines(d: Doc) -> int:
    seen: set[bytes] = set()
    n = 0
    for line in d.worded_lines:
        n += line in seen
        seen.add(line)
    return n


def _n_repeat_words(d: Doc) -> int:
    w = d.words
    windows = list(zip(w, w[1:], w[2:]))
    twice = {k for k, n in Counter(windows).items() if n > 1}
    covered = upto = 0
    for i, k in enumerate(windows if twice else ()):
        if k in twice:
            covered += i + 3 - max(i, upto)
            upto = i + 3
    return covered


MEASURES: dict[str, Callable[[Doc], object]] = {
    "words": lambda d: d.raw.split(),
    "worded_lines": lambda d: [x for x in d.raw.split(b"\n") if x.split(None, 1)],
    "n_words": lambda d: len(d.words),
    "word_chars": _word_chars,
    "n_symbols": lambda d: len(d.raw) - len(d.raw.translate(None, SYMBOLS)),
    "n_dup_lines": _n_dup_lines,
    "n_repeat_words": _n_repeat_words,
}

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``rejects(doc)`` is true for documents that go."""

    name: str
    rejects: Callable[[Doc], bool]


#: The base rules of the contract, then the method's own, set wide so that ordinary prose passes.
RULES = [
    Rule("few_words", lambda d: d.n_words < 50),
    Rule("repeated_windows", lambda d: 100 * d.n_repeat_words > 50 * d.n_words),
    Rule("symbols", lambda d: 10 * d.n_symbols > 3 * d.n_words),
    Rule("dup_lines", lambda d: 2 * d.n_dup_lines > len(d.worded_lines)),
    Rule("word_length", lambda d: not 2 * d.n_words <= d.word_chars <= 15 * d.n_words),
]
BASE_RULES = ("few_words", "repeated_windows")


def rule_stats(docs: DataFrame, rules: list[Rule] = RULES, sample_rows: int = 2000, seed: int = 7) -> list[tuple[str, float, float]]:
    """(rule, seconds per document, share rejected), measured over a random sample.

    The sample has about ``sample_rows`` rows whatever the size of the table; the executors measure it and only
    one row per rule reaches the driver. It sets the order of the rules, never a verdict.
    """
    n = docs.count()
    if not n:
        return [(r.name, 0.0, 0.0) for r in rules]
    texts = docs.select("text").sample(fraction=min(1.0, sample_rows / n), seed=seed)

    def measure(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for r in rules:
                fresh = [Doc(t) for t in part["text"]]
                began = time.perf_counter()
                hits = sum(bool(r.rejects(d)) for d in fresh)
                rows.append((r.name, time.perf_counter() - began, hits, len(fresh)))
            yield pd.DataFrame(rows, columns=["rule", "s", "hits", "n"])

    got = texts.mapInPandas(measure, "rule string, s double, hits long, n long").groupBy("rule").agg(F.sum("s"), F.sum("hits"), F.sum("n")).collect()
    by = {r[0]: (r[1] / max(r[3], 1), r[2] / max(r[3], 1)) for r in got}
    return [(r.name, *by.get(r.name, (0.0, 0.0))) for r in rules]


def ordered(rules: list[Rule], stats: list[tuple[str, float, float]]) -> list[Rule]:
    """Most rejections per second first; ties by name."""
    gain = {name: share / max(cost, 1e-9) for name, cost, share in stats}
    return sorted(rules, key=lambda r: (-gain.get(r.name, 0.0), r.name))


def apply_rules(docs: DataFrame, rules: list[Rule] = RULES, measures: tuple[str, ...] = (), sample_rows: int = 2000) -> DataFrame:
    """``docs`` with ``kept`` (no rule rejects) and the named ``measures`` as long columns.

    Rules run in the order of rejections per cost on a sample and stop at the first that rejects,
    so later measures are only computed for documents still in (unless ``measures`` asks for them). The verdict does not depend on the order.
    Columns of ``docs`` named like a result column are replaced; all others stay. Null
    text: the empty text. Repeated rows are judged alike and all stay. Empty table: no rows.
    """
    chain = ordered(rules, rule_stats(docs, rules, sample_rows))

    @F.pandas_udf("struct<kept:boolean" + "".join(f",{m}:bigint" for m in measures) + ">")
    def judge(text: pd.Series) -> pd.DataFrame:
        rows = []
        for t in text:
            d = Doc(t)
            rows.append((not any(r.rejects(d) for r in chain), *(getattr(d, m) for m in measures)))
        return pd.DataFrame(rows, columns=["kept", *measures])

    new = {"kept", *measures}
    return docs.select("*", judge(F.col("text")).alias("__judged")).select(
        *(F.col(c) for c in docs.columns if c not in new), "__judged.kept", *(f"__judged.{m}" for m in measures)
    )


def quality_report(docs: DataFrame, sample_rows: int = 2000) -> DataFrame:
    """doc_id, the base measures, base_failed and kept, one row per document."""
    judged = apply_rules(docs.select("doc_id", "text"), RULES, BASE, sample_rows)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select("doc_id", *BASE, failed.alias("base_failed"), "kept")
