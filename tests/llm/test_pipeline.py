"""The whole pipeline on a small hostile table, against brute force."""

import itertools
import random
import re

import public_tokenizers as P
from pyspark.sql import functions as F

import corpus_pipeline
from policypanel.llm import packing
from tests.llm.test_operators import character_links, documents, union

WORDS = [a + b + c for a, b, c in itertools.product(("ka", "lo", "mir", "tes"), ("bun", "dor", "el", "fi"), ("g", "han", "ist", "jo", "k"))]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(n))


def corpus():
    """Clean documents, exact and near copies, shared and nearly shared lines, and documents that no rule lets through."""
    rng = random.Random(4)
    rows = [(i, "\n".join(prose(rng, rng.randint(20, 40)) for _ in range(4))) for i in range(24)]
    shared = prose(rng, 60)
    rows += [(100 + i, prose(rng, 70) + "\n" + shared + "\n" + prose(rng, 20)) for i in range(6)]
    rows += [(200 + i, rows[i][1].replace(" ", "  ", 1)) for i in range(5)]
    one = [prose(rng, 4) for _ in range(40)]
    # copies and near copies of few words: what is left of the later documents has other lines only
    rows += [(300 + i, "\n".join(one[: 40 - i]) + "\n" + prose(rng, 55)) for i in range(3)]
    # near copies with a word changed in every line, which only the five-character rule of the line dedup tells from other lines
    for i in range(3):
        w = prose(rng, 60).split()
        rows += [(310 + i, " ".join(w)), (320 + i, " ".join(w[:10] + [w[10] + "x"] + w[11:]))]
    # near copies of documents whose lines are too different to be near copies: left to the document join
    for i in range(3):
        w = prose(rng, 150).split()
        rows += [(330 + i, "\n".join(" ".join(w[k:k + 30]) for k in range(0, 150, 30))), (340 + i, "\n".join(" ".join(w[k:k + 20]) for k in range(0, 150, 20)))]
    long = prose(rng, 60).split()
    for i in range(4):
        rows.append((400 + i, " ".join(long[:50] + [f"other{i}"] + long[51:])))
    rows += [(500, None), (501, ""), (502, "few words"), (503, "a b c " * 60), (504, "# $ % & " * 30), (3, rows[3][1]), (None, rows[5][1]), (None, None)]
    return rows


def clean(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    wins = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    again = {k + j for k, x in enumerate(wins) if wins.count(x) > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if x.split()]
    chars = sum(map(len, w))
    return not (
        len(w) < 50 or 100 * len(again) > 50 * len(w) or 10 * sum(c in "#*$%&|<>" for c in t) > 3 * len(w)
        or 2 * (len(lines) - len(set(lines))) > len(lines) or not 2 * len(w) <= chars <= 15 * len(w)
    )


def place(i):
    return i is None, i or 0


def without_repeated_lines(rows):
    rows = sorted(set(rows), key=lambda r: place(r[0]))
    lines = [(d, k, x) for d, (_, t) in enumerate(rows) for k, x in enumerate(t.split("\n")) if x.split()]
    ids = range(len(lines))
    comp = character_links([x for *_, x in lines])
    gone = {lines[k][:2] for k in ids if comp[k] != k}
    out = []
    for d, (i, t) in enumerate(rows):
        left = "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in gone)
        if left.split():
            out.append((i, left))
    return out


def one_of_each_group(rows):
    rows = sorted(set(rows), key=lambda r: place(r[0]))
    sets = []
    for _, t in rows:
        w = t.lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))})
    ids = range(len(rows))
    comp = union([(a, b) for a, b in itertools.combinations(ids, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])], ids)
    return [rows[k] for k in ids if comp[k] == k]


def test_pipeline_against_brute_force(spark, tmp_path):
    rows = corpus()
    documents(spark, rows).withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    kept = [r for r in rows if clean(r[1])]
    deduped = without_repeated_lines(kept)
    final = one_of_each_group(deduped)
    assert len(rows) > len(kept) > len(deduped) > len(final)
    tok = packing.Tokenizer.from_file(P.path("word_bpe_49k.json"))
    tok.encode_special_tokens = True
    want = sorted((-1 if i is None else i, len(tok.encode(t, add_special_tokens=False).ids) + 1) for i, t in final)
    got["doc_id"] = got["doc_id"].fillna(-1).astype(int)
    assert sorted(map(tuple, got.groupby("doc_id")["length"].sum().reset_index().values.tolist())) == want
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g["length"].sum() <= 2048 and list(g["offset"]) == [0, *g["length"].cumsum()[:-1]]


def test_pipeline_of_an_empty_table(spark, tmp_path):
    documents(spark, corpus()).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
