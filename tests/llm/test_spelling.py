"""Spelling variant groups against brute force."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

from policypanel.llm import spelling

SCHEMA = "doc_id long, text string, word string, block string, n long"


def frame(spark, rows):
    """Documents with extra columns whose names the operator uses inside."""
    return spark.createDataFrame([(i, t, "x", "x", -1) for i, t in rows], SCHEMA)


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(rows):
    counts = collections.Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 6:
                counts[w] += 1
    n = {w: k for w, k in counts.items() if k >= 5}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        top = min(near[w], key=lambda x: (-n[x], x), default=None)
        if top is not None and n[top] >= 5 * n[w]:
            form[w] = top

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n}


def hostile():
    rng = random.Random(11)
    out = []
    base = ["harbour", "colour-", "Élégance", "aaaaaa", "aaaaaaa", "anagram", "margana", "×÷×÷×÷", "z" * 400, "straße", "ÀÀÀÀÀÀ", "short", "listen", "silent", "tinsel"]
    for b in base:
        b = b.strip("-") + ("s" if b.endswith("-") else "")
        out += [b] * 150
        for _ in range(8):
            k = rng.randrange(len(b))
            out += [rng.choice((b[:k] + b[k + 1:], b[:k] + rng.choice("abzé") + b[k + 1:], b[:k] + rng.choice("abzé") + b[k:]))] * rng.choice((4, 5, 6, 25, 30, 150))
    chain = ["bbbbbb", "bbbbbc", "bbbbcc", "bbbccc"]
    for k, w in enumerate(chain):
        out += [w] * (5 * 5 ** k)
    out += ["ABCdef", "abcDEF"] * 40 + ["ÉABCDE", "éabcde"] * 10
    rng.shuffle(out)
    rows = [(i, rng.choice((" ", "\n", "1", "_")).join(out[i * 40:i * 40 + 40])) for i in range(len(out) // 40 + 1)]
    return rows + [(5000, None), (5001, ""), (None, "listen " * 30), (None, None), rows[0], rows[0]]


def rows_of(df):
    got = df.collect()
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got}
    assert len(out) == len(got)
    return out


@pytest.mark.parametrize("classes, tile", [(spelling.CLASSES, spelling.TILE), (1, 50), (3, 20)])
def test_words_forms_and_roots_equal_brute_force(spark, classes, tile):
    rows = hostile()
    want = brute(rows)
    assert rows_of(spelling.spelling_variants(frame(spark, rows), classes=classes, tile_bytes=tile)) == want
    assert any(f is not None and r != f for f, r, *_ in want.values()) and any(k > 1 for _, _, _, k, _ in want.values())


def test_products_find_every_pair_at_one_edit():
    rng = random.Random(2)
    for long, longer in ((6, 6), (6, 7), (9, 9), (9, 10), (1200, 1201)):
        a = ["".join(rng.choice("ab") for _ in range(long)) for _ in range(60)]
        b = ["".join(rng.choice("ab") for _ in range(longer)) for _ in range(60)] + [x + "b" * (longer - long) for x in a]
        u, v = (np.frombuffer("".join(x).encode("latin-1"), dtype=np.uint8).reshape(len(x), -1) for x in (a, b))
        got = {(int(i), int(j)) for x, y in spelling.near_pairs(u, v, strip=7) for i, j in zip(x, y)}
        assert got == {(i, j) for i in range(len(a)) for j in range(len(b)) if one_edit(a[i], b[j])}


def test_tiles_meet_once(spark):
    words = spark.createDataFrame([(w, 9) for w in ("listen", "silent", "tinsel", "listens", "enlist", "glisten")], "word string, n long")
    held = spelling.tiles(words, 3, 6)
    pairs = [(tuple(r[0]), r[1], tuple(r[2]), r[3]) for r in spelling.tile_pairs(held, 3).collect()]
    assert len({frozenset((p[:2], p[2:])) for p in pairs}) == len(pairs)


def test_many_tasks_counting_in_small_dictionaries(spark, monkeypatch):
    monkeypatch.setattr(spelling, "COUNTED", 2)
    rows = hostile()
    got = {r["word"]: r["n"] for r in spelling.word_counts(frame(spark, rows).repartition(5)).collect()}
    assert got == {w: x[2] for w, x in brute(rows).items()}


def test_no_words_and_empty_table(spark):
    assert spelling.spelling_variants(frame(spark, [(1, "too short"), (2, None)])).collect() == []
    assert spelling.spelling_variants(frame(spark, [])).collect() == []
