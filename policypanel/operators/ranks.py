"""Exact order statistics by repeated rank selection, in bounded memory.

A quantile of a distributed column needs no global sort: a quantile sketch brackets it
between two values, one scan counts exactly how many rows lie below, on and between
them, and only the rows strictly inside the bracket can still matter. The bracket's next
sketch is taken in the same scan that counts it, so each further scan narrows the
remaining rows by the sketch's accuracy; once few enough remain they are grouped and
ranked. Values are compared in their own type, so decimals and large integers stay exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from policypanel.sources.tables import inline_table

#: Relative rank error of the sketch that brackets a value: 1 / ACCURACY.
ACCURACY = 10_000
#: Rows strictly inside a bracket that are ranked at the end, rather than narrowed once more.
FEW = 100_000


@dataclass
class _Search:
    """One wanted rank (from 1) of one column: it lies among the ``inside`` rows strictly between ``lo``
    and ``hi`` (None: open), after ``below`` rows, unless ``found``."""

    column: str
    q: float
    rank: int
    inside: int
    below: int = 0
    lo: Any = None
    hi: Any = None
    found: bool = False
    value: Any = None

    def within(self) -> Column:
        c = F.col(self.column)
        cond = c.isNotNull()
        if self.lo is not None:
            cond = cond & (c > F.lit(self.lo))
        if self.hi is not None:
            cond = cond & (c < F.lit(self.hi))
        return cond


def _sketch(s: _Search, accuracy: int) -> Column:
    """The values just below and above the wanted rank among the rows inside."""
    at, err = (s.rank - s.below) / max(1, s.inside), 2.0 / accuracy
    ends = [F.lit(max(0.0, at - err)), F.lit(min(1.0, at + err))]
    return F.percentile_approx(F.when(s.within(), F.col(s.column)), F.array(*ends), F.lit(accuracy))


def _narrow(df: DataFrame, open_: list[_Search], bounds: list[tuple], accuracy: int) -> list[tuple | None]:
    """One scan: moves every search into its bracket or ends it, and sketches what stays inside.

    Returns the next brackets, in the order of ``open_`` (None where the search ended).
    """
    aggs = []
    trial = []
    for i, (s, (a, b)) in enumerate(zip(open_, bounds)):
        c = F.col(s.column)
        inner = _Search(s.column, s.q, s.rank, s.inside, s.below, a, b)
        aggs += [F.count_if(s.within() & (c < F.lit(a))).alias(f"b{i}"),
                 F.count_if(c == F.lit(a)).alias(f"a{i}"),
                 F.count_if(inner.within()).alias(f"i{i}"),
                 F.count_if(c == F.lit(b)).alias(f"t{i}"),
                 _sketch(inner, accuracy).alias(f"k{i}")]
        trial.append(inner)
    row = df.agg(*aggs).first()
    nxt: list[tuple | None] = []
    for i, (s, inner) in enumerate(zip(open_, trial)):
        a, b = inner.lo, inner.hi
        at_a = s.below + row[f"b{i}"]
        inside = at_a + row[f"a{i}"]
        after = inside + row[f"i{i}"]
        if s.rank <= at_a:                       # the sketch placed the bracket too high
            s.hi, s.inside = a, row[f"b{i}"]
        elif s.rank <= inside:
            s.found, s.value = True, a
        elif s.rank <= after:
            s.lo, s.hi, s.below, s.inside = a, b, inside, row[f"i{i}"]
        elif s.rank <= after + (row[f"t{i}"] if a != b else 0):
            s.found, s.value = True, b
        else:                                    # too low
            end = after + (row[f"t{i}"] if a != b else 0)
            s.inside, s.below, s.lo = s.inside - (end - s.below), end, b
        nxt.append(tuple(row[f"k{i}"]) if not s.found and (s.lo, s.hi) == (a, b) and row[f"k{i}"] else None)
    return nxt


def _first(df: DataFrame, columns: Sequence[str], qs: Sequence[float], accuracy: int) -> tuple[dict, dict]:
    """Rows per column and the first brackets, from one scan."""
    aggs = []
    for c in columns:
        ends = [F.lit(min(1.0, max(0.0, q + d))) for q in qs for d in (-2.0 / accuracy, 2.0 / accuracy)]
        aggs += [F.count(c).alias(f"n_{c}"), F.percentile_approx(F.col(c), F.array(*ends), F.lit(accuracy)).alias(f"k_{c}")]
    row = df.agg(*aggs).first()
    return {c: row[f"n_{c}"] for c in columns}, {c: row[f"k_{c}"] for c in columns}


def exact_quantiles(df: DataFrame, columns: Sequence[str], qs: Sequence[float] = (0.5,),
                    accuracy: int = ACCURACY, few: int = FEW) -> DataFrame:
    """``column, q, rows, value``: for each column and each ``q`` the smallest value that at least
    ``q`` of the non-null rows do not exceed (an element of the column; reported as double).

    Scans: one to count and bracket, one per narrowing, and one that ranks what few rows remain. The driver holds two values
    per wanted quantile; no task holds more than a sketch, or in the last scan ``few`` rows per quantile. With
    an accuracy of 10,000 a scan leaves about 1 row in 2,500, so 10^12 rows take four scans.
    A column without values gives null. Numeric columns; nulls are left out; -0.0 equals 0.0, NaN is the largest.
    """
    if not all(0.0 <= q <= 1.0 for q in qs):
        raise ValueError(f"quantiles outside 0 to 1: {list(qs)}")
    df = df.select(*dict.fromkeys(columns))
    rows, first = _first(df, columns, qs, accuracy)
    searches = [_Search(c, q, max(1, math.ceil(Fraction(repr(q)) * rows[c])), rows[c]) for c in columns for q in qs]
    bounds: dict[int, tuple | None] = {}
    for s, k in zip(searches, range(len(searches))):
        if rows[s.column] == 0:
            s.found = True
        else:
            i = 2 * list(qs).index(s.q)
            bounds[k] = tuple(first[s.column][i:i + 2])
    while True:
        todo = [k for k, s in enumerate(searches) if not s.found and (s.inside > few or bounds.get(k) is not None and s.lo is None and s.hi is None)]
        if not todo:
            break
        lost = [k for k in todo if bounds.get(k) is None]
        if lost:                                 # a bracket that missed: sketch the part that holds the rank
            row = df.agg(*[_sketch(searches[k], accuracy).alias(f"k{k}") for k in lost]).first()
            bounds.update({k: tuple(row[f"k{k}"]) for k in lost})
        nxt = _narrow(df, [searches[k] for k in todo], [bounds[k] for k in todo], accuracy)
        bounds.update(dict(zip(todo, nxt)))
    return _ranked(df, searches, rows)


def _ranked(df: DataFrame, searches: list[_Search], rows: dict[str, int]) -> DataFrame:
    """The found values, and those of the remaining brackets ranked in one scan: a few rows each, after the filter."""
    left = [(k, s) for k, s in enumerate(searches) if not s.found]
    if left:
        hits = F.array_compact(F.array(*[
            F.when(s.within(), F.struct(F.lit(k).alias("k"), F.col(s.column).cast("double").alias("value"))) for k, s in left]))
        counted = (df.where(_any([s.within() for _, s in left])).select(F.inline(hits))
                   .groupBy("k", "value").agg(F.count(F.lit(1)).alias("n")))
        upto = F.sum("n").over(Window.partitionBy("k").orderBy("value"))
        ranked = counted.select("k", "value", upto.alias("upto"))
        want = F.element_at(F.create_map(*[x for k, s in left for x in (F.lit(k), F.lit(s.rank - s.below))]), F.col("k"))
        found = {r["k"]: r["value"] for r in ranked.where(F.col("upto") >= want).groupBy("k").agg(F.min("value").alias("value")).collect()}
        for k, s in left:
            s.found, s.value = True, found[k]
    out = [(s.column, float(s.q), rows[s.column], None if s.value is None else float(s.value) + 0.0) for s in searches]
    return inline_table(df.sparkSession, out, "column string, q double, rows bigint, value double")


def _any(conds: Sequence[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out

