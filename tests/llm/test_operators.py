"""The training-data operators on small hostile tables, against brute force."""

import hashlib
import inspect
import itertools
import random
import re
import struct
import time
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from policypanel.llm import bpe, chat, common, html_extract, line_dedup, ngram_join, nn_descent, packing, quality, sharding, warc
from policypanel.llm.common import connected_components, scratch

DOCS = "doc_id long, text string, lang string, row_key string, node long"


def documents(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", "x", 1) for i, t in rows], DOCS)


def some_texts(seed=1, n=40):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(2, 6))) for _ in range(300)]
    out = []
    for i in range(n):
        lines = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 30))) for _ in range(rng.randint(1, 6))]
        out.append((i, "\n".join(lines)))
        if i % 5 == 0:
            out.append((1000 + i, out[-1][1] + " tail"))
    return out + [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "one"), (2003, "one"), (None, out[0][1]), (None, None)]


def union(pairs, items):
    root = {i: i for i in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in items}


def test_components_of_a_chain_a_star_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 120)] + [(7000, 7000), (None, 3)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(31), 0), **dict.fromkeys(range(100, 120), 100), 7000: 7000}


# packing

def test_packing_keeps_every_token_and_every_capacity(spark):
    rows = some_texts() + [(5000, "word " * 5000), (5001, "<|endoftext|> İ ǰ J̌ 中文")]
    path = P.path("word_bpe_49k.json")
    got = packing.pack_documents(documents(spark, rows), path, max_tokens=256, max_docs=5, max_attention=40_000.0).toPandas()
    tok = packing.Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    want = []
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 256)):
            cut = ids[at : at + 256]
            want.append((-1 if i is None else i, k, at, len(cut), zlib.crc32(struct.pack(f"<{len(cut)}I", *cut))))
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got[cols].fillna(-1).astype(int).values)) == sorted(want)
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert list(g["offset"]) == [0, *np.cumsum(g["length"])[:-1]]
        assert g["length"].sum() <= 256 and len(g) <= 5
        assert len(g) == 1 or (g["length"] ** 2).sum() <= 40_000


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_vector_best_fit_fills_perfect_bins(score):
    lengths = np.array([60, 40, 70, 30, 50, 50])
    bins = packing.vector_best_fit(lengths, np.array([100.0, 10, 1e9]), np.array([1.0, 0, 0]), score)
    assert max(np.bincount(bins, lengths)) <= 100
    assert score == "dot" or len(set(bins)) == 3


# chat

def test_chat_round_trip_of_control_strings(spark):
    texts = ["", None, "~", "~1", "<s>", "a</s>b", "[INST]", "[[/INST]", "</s", "~0<[", "plain é", "x" * 50_000]
    turns = [(c, t, r, x) for c, (r, x) in enumerate(itertools.product(["user", "assistant", "~odd", None, "a[INST]"], texts)) for t in (0, 1)]
    turns += [(None, None, "user", "z"), (None, 0, "assistant", "y")]
    df = spark.createDataFrame([(*t, "extra") for t in turns], "conv_id long, turn long, role string, text string, formatted string")
    out = chat.format_conversations(df)
    assert out.where("NOT verified").count() == 0
    got = {r["conv_id"]: r for r in chat.digests(out).collect()}
    for c in {t[0] for t in turns}:
        own = [(r or "", x or "") for k, _, r, x in turns if k == c]
        loss = "".join(x for r, x in own if r == "assistant")
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in own).encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.format_conversations(df.limit(0)).count() == 0


# vectors

def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    rows = []
    for g in range(12):
        centre = rng.standard_normal(16)
        for k in range(g * 3 + 1):
            rows.append((len(rows), [float(x) for x in centre + 0.08 * rng.standard_normal(16)], g % 3))
    rows += [(len(rows) + k, rows[5][1], rows[5][2]) for k in range(20)]
    odd = [(9000, None, 1), (9001, [0.0] * 16, 1), (9002, [float("nan")] + [1.0] * 15, 1), (9003, [None] + [1.0] * 15, 1), (9004, rows[0][1], None), (9005, [], 1), (9006, [float("inf")] * 16, 0)]
    df = spark.createDataFrame([(*r, 0) for r in rows + odd], "vec_id long, embedding array<float>, label int, node int")
    got = {r["vec_id"]: r for r in nn_descent.near_duplicate_vectors(df).collect()}
    x = np.array([np.float32(r[1]).astype(float) for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    lab = np.array([r[2] for r in rows])
    hit = (x @ x.T >= 0.98) & (lab[:, None] == lab)
    comp = union([(i, j) for i, j in np.argwhere(hit) if i < j], range(len(rows)))
    for i in range(len(rows)):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (hit[i].sum() - 1, comp[i], comp[i] == i)
    for i, *_ in odd:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert nn_descent.near_duplicate_vectors(df.limit(0)).count() == 0


def test_vectors_with_more_close_neighbours_than_a_list(spark):
    """Sub-groups of 20 whose links to other sub-groups all lie behind closer neighbours, in one block and over several."""
    for groups, dim in ((12, 64), (40, 64)):
        rng = np.random.default_rng(groups)
        centre = rng.standard_normal(dim)
        centre /= np.linalg.norm(centre)
        rows = []
        for _ in range(groups):
            off = rng.standard_normal(dim)
            off -= off @ centre * centre
            mid = centre + 0.115 * off / np.linalg.norm(off)
            rows += [(len(rows) + k, [float(x) for x in mid + 0.0005 * rng.standard_normal(dim)], 1) for k in range(20)]
        x = np.array([np.float32(r[1]).astype(float) for r in rows])
        x /= np.linalg.norm(x, axis=1)[:, None]
        hit = x @ x.T >= 0.98
        comp = union([(i, j) for i, j in np.argwhere(hit) if i < j], range(len(rows)))
        assert set(comp.values()) == {0} and hit.sum() > 30 * len(rows)
        got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in nn_descent.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
        assert got == {i: (hit[i].sum() - 1, 0) for i in range(len(rows))}


def test_vectors_of_a_small_label_beside_a_hot_one(spark, monkeypatch):
    """Isolated pairs of a label that fits one block, beside a label large enough for 18 sign bits."""
    monkeypatch.setattr(nn_descent, "CELL", 1 / 64)
    rng = np.random.default_rng(8)
    rows = []
    for _ in range(300):
        centre = rng.standard_normal(48)
        rows += [(len(rows) + k, [float(x) for x in centre + 0.001 * rng.standard_normal(48)], 0) for k in range(10)]
    for i in range(100):
        x, y = rng.standard_normal((2, 48))
        x /= np.linalg.norm(x)
        y -= y @ x * x
        y *= 0.195 / np.linalg.norm(y)
        rows += [(10_000 + 2 * i, [float(a) for a in x], 1), (10_001 + 2 * i, [float(a) for a in x + y], 1)]
    got = {r["vec_id"]: r["component_id"] for r in nn_descent.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    assert [i for i in range(10_000, 10_200) if got[i] != i // 2 * 2] == []


# n-grams

def test_ngram_links_against_all_pairs(spark):
    rows = some_texts(2, 60)
    base = rows[0][1].split()
    rows += [(3000 + k, " ".join(base[: len(base) - k])) for k in range(12)]
    got = ngram_join.near_duplicates(documents(spark, rows), 3, 90, 100).toPandas()
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[k : k + 3]) for k in range(max(1, len(w) - 2))} if w else set())
    ids = range(len(rows))
    comp = union([(a, b) for a, b in itertools.combinations(ids, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])], ids)
    low = {}
    for k in ids:
        if rows[k][0] is not None:
            low[comp[k]] = min(low.get(comp[k], 10**9), rows[k][0])
    want = sorted((rows[k][0] or -1, len(sets[k]), low.get(comp[k], -1)) for k in ids)
    assert sorted((-1 if r.doc_id != r.doc_id or r.doc_id is None else int(r.doc_id) or -1, r.n_shingles, -1 if r.component_id != r.component_id else int(r.component_id)) for r in got.itertuples()) == want
    left = ngram_join.one_per_group(documents(spark, rows), 3, 90, 100)
    assert left.columns == documents(spark, rows).columns
    assert left.where("text = 'one'").count() == 1 and left.where("text IS NULL").count() == 2
    assert ngram_join.near_duplicates(documents(spark, rows).limit(0)).count() == 0


# byte-level BPE

def test_bpe_equals_the_library_on_texts_cut_anywhere(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab é'st 12\n\t .,中 \x1c") for _ in range(rng.randint(0, 900))) for _ in range(60)]
    texts += ["a" * 700, " " * 700, "\n\n  x" * 100, "", None, "don't " * 90]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(None, "x y " * 60, 0)], "doc_id long, text string, row int")
    ranks = P.path("byte_bpe_multi_50k.tiktoken")
    got = {r["doc_id"]: r for r in bpe.encode_documents(df, ranks, P.PATTERN, chunk=64, overlap=16).collect()}
    enc = bpe.encoder(ranks, P.PATTERN)
    for i, t in [*enumerate(texts), (None, "x y " * 60)]:
        ids = enc.encode_ordinary(t or "")
        assert got[i]["n_tokens"] == len(ids), t
        assert got[i]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


# sharding

def test_shards_are_even_and_rebalancing_moves_little(spark):
    rows = [(i, "x" * (i % 97)) for i in range(3000)] + [(None, None), (1, "x"), (1, "x")]
    path = scratch(spark, "test-map")
    got = sharding.shard_documents(documents(spark, rows), path).toPandas()
    assert len(got) == len(rows)
    sizes = got.groupby("shard")["size"].sum()
    assert len(sizes) == 16 and sizes.max() - sizes.min() <= 2 * got["size"].max()
    for _, g in got.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    table = [(r["virtual_slot"], r["slot_bytes"], r["slot_rows"]) for r in sharding.read_map(spark, path, 1).collect()]
    old = {r["virtual_slot"]: r["shard"] for r in sharding.read_map(spark, path, 1).collect()}
    new = sharding.rebalanced(old, table, 17)
    sharding.write_map(spark, path, 2, new, table)
    assert {r["virtual_slot"]: r["shard"] for r in sharding.read_map(spark, path, 2).collect()} == new
    moved = sum(b for s, b, _ in table if new[s] != old[s])
    assert 0 < moved <= 2.5 * sum(b for _, b, _ in table) / 17
    assert sharding.shard_documents(documents(spark, rows).limit(0), scratch(spark, "test-map")).count() == 0


def test_repeated_rows_spread_over_shards(spark, monkeypatch):
    """A third of all rows is one row; sizes and checksums against Python, for blocks smaller than the group too."""
    rows = [(i, "é" * (i % 50)) for i in range(2000)] + [(7, "the same row")] * 1000 + [(None, None)] * 20
    for block in (sharding.BLOCK, 7):
        monkeypatch.setattr(sharding.slotted, "__defaults__", (block,))
        got = sharding.shard_documents(documents(spark, rows), scratch(spark, "test-map")).toPandas()
        want = sorted((-1 if i is None else i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
        assert sorted(zip(got["doc_id"].fillna(-1).astype(int), got["size"], got["text_crc32"])) == want
        sizes = got.groupby("shard")["size"].sum()
        assert len(sizes) == 16 and sizes.max() - sizes.min() <= 2 * got["size"].max()
        for _, g in got.groupby("shard"):
            assert sorted(g["slot"]) == list(range(len(g)))


def test_later_rows_are_placed_by_the_stored_map(spark):
    rows = [(i, "x" * (i % 97)) for i in range(300)]
    path = scratch(spark, "test-map")
    first = sharding.shard_documents(documents(spark, rows), path, shards=4).toPandas()
    assert sharding.read_map(spark, path, 1).count() == sharding.SLOTS
    rows += [(i, "y" * (i % 89)) for i in range(300, 2000)]
    assert sharding.place(sharding.slotted(documents(spark, rows), sharding.SLOTS), sharding.read_map(spark, path, 1), ["doc_id"]).count() == 2000
    got = sharding.reshard_documents(documents(spark, rows), path, 1, 5).toPandas()
    assert len(got) == 2000 and len(first) == 300
    new = {r["virtual_slot"]: r["shard"] for r in sharding.read_map(spark, path, 2).collect()}
    assert len(new) == sharding.SLOTS and all(new[r.virtual_slot] == r.shard for r in got.itertuples())
    for _, g in got.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    short = sharding.read_map(spark, path, 2).where("virtual_slot % 2 = 0")
    with pytest.raises(Exception, match="lacks virtual slot"):
        sharding.place(sharding.slotted(documents(spark, rows), sharding.SLOTS), short, ["doc_id"]).collect()


# quality

def test_quality_measures_and_cascade(spark):
    rows = some_texts() + [(1, "a b c a b c a b c x"), (2, "# $ |"), (3, "x y\nx y\n \n \nx y"), (4, ("w" * 40 + " ") * 60)]
    got = sorted((r.doc_id if r.doc_id == r.doc_id else -1, *map(int, r[2:7])) for r in quality.quality_report(documents(spark, rows)).toPandas().itertuples())
    want = []
    for i, t in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        win = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        covered = {k + j for k, x in enumerate(win) if win.count(x) > 1 for j in range(3)}
        seen, dup = set(), 0
        for line in t.split("\n"):
            if line.strip(" \t\r\x0b\x0c"):
                dup += line in seen
                seen.add(line)
        want.append((-1 if i is None else i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(covered)))
    assert got == sorted(want)
    order = [r.name for r in quality.ordered(quality.RULES, [("symbols", 1.0, 0.5), ("few_words", 0.1, 0.2), ("dup_lines", 1.0, 0.0)])]
    assert order[:2] == ["few_words", "symbols"]
    assert quality.quality_report(documents(spark, rows).limit(0)).count() == 0


# lines

def test_lines_against_all_pairs(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    base = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(10)]
    rows = []
    for i in range(40):
        line = base[i % 10].split()
        if i >= 10:
            line[rng.randrange(40)] = "changed"
        rows.append((i, "short line\n" + " ".join(line) + "\n" + " ".join(rng.choice(words) for _ in range(12))))
    rows += [(50, None), (51, ""), (52, base[0]), (None, base[0]), (53, " \n\t"), (52, base[0])]
    df = documents(spark, rows)
    got = {(r["doc_id"], r["line_no"]): r["kept"] for r in line_dedup.line_decisions(df).collect()}
    lines = [(i, k, line) for i, t in rows for k, line in enumerate((t or "").split("\n")) if line.split()]
    ids = range(len(lines))
    comp = character_links([x for *_, x in lines])
    order = lambda k: (lines[k][0] is None, lines[k][0] or 0, lines[k][1])
    first = {c: min((k for k in ids if comp[k] == c), key=order) for c in set(comp.values())}
    assert got == {lines[k][:2]: order(k) == order(first[comp[k]]) for k in ids}
    out = line_dedup.without_near_copies(df)
    assert out.columns == df.columns
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert 52 not in texts and texts[53] == " \n\t" and texts[0] == rows[0][1]
    # the short line and the near copy of the long one are gone
    assert "\n" not in texts[15] and texts[15] == rows[15][1].split("\n")[2]
    assert line_dedup.line_decisions(df.limit(0)).count() == 0


def character_links(lines):
    """Line numbers by component, over brute-force Jaccard similarity of the sets of five characters at every position."""
    low = [x.lower() for x in lines]
    sets = [{x[k : k + 5] for k in range(max(1, len(x) - 4))} for x in low]
    ids = range(len(lines))
    return union([(a, b) for a, b in itertools.combinations(ids, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])], ids)


def test_lines_by_character_shingles(spark):
    """Lines under 18 words with one edited character or word, tabs between words, characters beyond the basic plane."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(4, 8)))
    lines = []
    for n in (6, 8, 10, 12, 16):
        for _ in range(4):
            w = [word() for _ in range(n)]
            edited = [*w]
            edited[n // 2] = edited[n // 2][:2] + "z" + edited[n // 2][3:]
            lines += [" ".join(w), " ".join(edited), "\t".join(w), "\t".join(edited), " ".join([*w[:2], "other", *w[3:]])]
    lines += ["😀😁😂 a b c d e f", "😃😄😅 a b c d e f", "A B C D E F G H", "a b c d e f g h"]
    got = {r["doc_id"]: r["kept"] for r in line_dedup.line_decisions(documents(spark, list(enumerate(lines)))).collect()}
    comp = character_links(lines)
    assert len(set(comp.values())) < len(lines)
    assert got == {i: comp[i] == i for i in range(len(lines))}


def test_lines_of_few_words(spark):
    """Copies and near copies of lines with one to four words, or without spaces, count like any other."""
    texts = ["Read more\nShare this article", "Read more\nonly here\n \n", "x\nShare this articles", "中文的一行没有空格的文字很长\nx", "中文的一行没有空格的文字很长啊\nX\nxy", None, "", " \n\t"]
    df = documents(spark, list(enumerate(texts)))
    got = {(r["doc_id"], r["line_no"]): r["kept"] for r in line_dedup.line_decisions(df).collect()}
    lines = [(i, k, x) for i, t in enumerate(texts) for k, x in enumerate((t or "").split("\n")) if x.strip()]
    comp = character_links([x for *_, x in lines])
    assert got == {(i, k): comp[n] == n for n, (i, k, _) in enumerate(lines)}
    assert {r["doc_id"]: r["text"] for r in line_dedup.without_near_copies(df).collect()} == {0: texts[0], 1: "only here\n \n", 2: "x", 3: "中文的一行没有空格的文字很长", 4: "xy", 5: None, 6: "", 7: " \n\t"}


def test_keys_and_tokens_are_not_gathered_in_one_task():
    for module in (line_dedup, ngram_join):
        assert not re.search(r"partitionBy\(\"(key|token)\"", inspect.getsource(module))


# html

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><a href=/>Site</a></header><nav><ul><li>Home<li>About</ul></nav>
<div class="cookie-notice">We use cookies.</div><article><h1>Head &amp; tail</h1><p>First  paragraph<br>with <b>bold</b> text.<p>Second.
<aside>Side note</aside><form><label>Name</label><input></form><script>var x = "</p><p>no";</script></article>
<section id="comments"><article>Nice post, really a very long comment that looks like text.</article></section><footer>&copy; Me</footer></body></html>"""


def test_html_main_text():
    assert html_extract.main_text(PAGE) == "Head & tail\nFirst paragraph with bold text.\nSecond."
    assert html_extract.main_text(None) == html_extract.main_text("") == html_extract.main_text("<p></p>") == ""
    assert html_extract.main_text("<p>Not closed <a href='x>y'>link</a> &lt;b&gt; &#233;") == "Not closed link <b> é"
    assert html_extract.main_text("<!-- never closed <p>text") == ""


def test_html_names_do_not_decide_alone():
    prose = "A paragraph of some length, with a few words in it, that ends like a sentence does."
    page = f"<body><div id=page class='site has-sidebar'><div class=sidebar><ul><li><a href=/a>Home</a><li><a href=/b>More</a></ul></div>{{}}</div>"
    assert html_extract.main_text(page.format(f"<p>{prose}</p><p>{prose}</p>")) == f"{prose}\n{prose}"
    assert html_extract.main_text(page.format(f"<article><p>{prose}</p></article>")) == prose
    assert html_extract.main_text(f"<form class='search-page'><main><p>{prose}</p></main></form>") == prose
    inside = f"<h2 id='legal-history'>Legal history</h2><section id='search-methods'><h3>Methods</h3><p>{prose}</p></section><p class='side-note'>A side note.</p><table id='register-data'><tr><td>12<td>ab</table><p>See <span class='alert'>this</span> too."
    want = f"{prose}\nLegal history\nMethods\n{prose}\nA side note.\n12\nab\nSee this too."
    furniture = "<div class='share-buttons'><a href=/x>Share on one</a> <a href=/y>Share on two</a></div><div class='newsletter-signup'>Subscribe to our weekly letter.</div>"
    assert html_extract.main_text(f"<article><p>{prose}</p>{inside}{furniture}</article>") == want
    comments = f"<div id=comments class='comments-area'><article><p>{prose}</p></article><article><p>{prose}</p></article></div>"
    assert html_extract.main_text(f"<div class='page comments-open'><article><p>Its own text, short.</p></article>{comments}</div>") == "Its own text, short."


def test_html_minimum_cut_is_minimal():
    rng = random.Random(4)
    for _ in range(50):
        n = rng.randint(1, 7)
        cost = [rng.randint(-9, 9) for _ in range(n)]
        edges = {}
        for a, b in itertools.combinations(range(n), 2):
            if rng.random() < 0.5:
                c = rng.randint(1, 6)
                edges.setdefault(a, {})[b] = c
                edges.setdefault(b, {})[a] = c

        def price(side):
            return sum(c if c > 0 and not s else -c if c < 0 and s else 0 for c, s in zip(cost, side)) + sum(
                c for a, e in edges.items() for b, c in e.items() if side[a] and not side[b])

        assert price(html_extract.min_cut(cost, edges)) == min(price(s) for s in itertools.product([True, False], repeat=n))


def test_html_rows(spark):
    df = spark.createDataFrame([(1, "u", PAGE, 5), (1, "u", PAGE, 5), (None, None, None, 5)], "page_id long, url string, html string, text int")
    rows = html_extract.extract_main_text(df).collect()
    assert sorted(r["n_chars"] for r in rows) == [0, 51, 51]
    assert html_extract.extract_main_text(df.limit(0)).count() == 0


# WARC

def test_warc_reads_back_what_was_written(spark):
    big, other = "é" * 600, "b" * 1000
    pages = [(1, "http://a/\r\nX: y", big), (2, None, big), (3, "u", big), (3, "u", big), (4, "u", other), (5, "u", "small"), (6, "u", "small"), (7, "u", None), (None, "u", big)]
    path = scratch(spark, "test-warc")
    warc.write_archive(spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, key int"), path)
    assert spark.read.parquet(f"{path}/payloads").count() == 4
    got = sorted((r["page_id"] or -1, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.archive_report(spark, path).collect())
    want = []
    for i, _, h in pages:
        b = (h or "").encode()
        again = h == big and i != 3
        want.append((i or -1, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", 3 if again else None))
    assert got == sorted(want)
    records = warc.read_records(spark, path).collect()
    assert len(records) == len(pages)
    for r in records:
        head, _, body = bytes(r["record"]).partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: ") and b"\nX: y" not in head
        assert body == (bytes(r["payload"]) if r["record_type"] == "response" else b"") + b"\r\n\r\n"
    ids = [re.search(rb"WARC-Record-ID: (\S+)", bytes(r["record"])).group(1) for r in records]
    assert len(set(ids)) == len(ids)
    heads = {i for i, r in zip(ids, records) if r["record_type"] == "response" and r["page_id"] == 3}
    refs = {re.search(rb"WARC-Refers-To: (\S+)", bytes(r["record"])).group(1) for r in records if r["record_type"] == "revisit"}
    assert len(refs) == 1 and refs < heads
    empty = scratch(spark, "test-warc")
    warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), empty)
    assert warc.archive_report(spark, empty).count() == 0


# byte BPE on frames that are not plain scans

def test_bpe_of_shuffled_and_grouped_frames(spark):
    from pyspark.sql import functions as F
    rng = random.Random(8)
    texts = [" ".join(rng.choice(("word", "écrit", "  gap", "12345", "\n")) + str(rng.randrange(999)) for _ in range(rng.randint(5, 900))) for _ in range(80)]
    df = documents(spark, list(enumerate(texts)))
    enc = bpe.encoder(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    want = sorted((i, hashlib.sha256(struct.pack(f"<{len(x)}I", *x)).hexdigest()) for i, x in ((i, enc.encode_ordinary(t)) for i, t in enumerate(texts)))
    for frame in (df.repartition(8), df.repartition(3).groupBy("doc_id").agg(F.max("text").alias("text")), df.orderBy(F.rand(1))):
        got = bpe.encode_documents(frame, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, chunk=700, overlap=60)
        assert sorted((r["doc_id"], r["ids_sha256"]) for r in got.collect()) == want
    assert bpe.encode_documents(df.limit(0), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).count() == 0


def test_alike_but_unlinked_lines_are_not_all_verified(spark, monkeypatch):
    """A group of lines at a similarity of about 0.65: all pairs share keys and sketches, none is linked; only a few may reach their texts."""
    rng = random.Random(3)
    base = [rng.choice("abcdefghijklmnopqrstuvwxyz é") for _ in range(300)]

    def edited(n):
        line = list(base)
        for at in rng.sample(range(5, 295), n):
            line[at] = rng.choice("ABCDEFGHIJ0123456789ß")
        return "".join(line)

    lines = [edited(7) for _ in range(60)]
    near = lines[7][:150] + "#" + lines[7][151:]
    sent = []
    verified = line_dedup.verified
    monkeypatch.setattr(line_dedup, "verified", lambda pairs, texts: sent.append(pairs.count()) or verified(pairs, texts))
    got = {r["doc_id"]: r["kept"] for r in line_dedup.line_decisions(documents(spark, list(enumerate([*lines, near])))).collect()}

    def runs(x):
        return {x.lower()[i : i + 5] for i in range(len(x) - 4)}

    a = [runs(x) for x in lines]
    assert max(len(x & y) / len(x | y) for i, x in enumerate(a) for y in a[:i]) < 0.8
    assert got == {**{i: True for i in range(60)}, 60: False}
    assert sent[-1] < 60, sent


def test_alike_but_unlinked_documents_are_not_all_verified(spark, monkeypatch):
    """A group of documents at a similarity of about 0.85 to each other, where 0.9 links: their pairs are told apart before their sets are fetched."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(800)]

    def edited(n):
        words = list(base)
        for at in rng.sample(range(3, 797), n):
            words[at] = f"x{rng.randrange(10**6)}"
        return " ".join(words)

    texts = [edited(11) for _ in range(40)]
    sent = []
    verified = ngram_join.verified
    monkeypatch.setattr(ngram_join, "verified", lambda pairs, *a: sent.append(pairs.count()) or verified(pairs, *a))
    got = ngram_join.near_duplicates(documents(spark, list(enumerate(texts))), 3, 90, 100).collect()

    def sets(x):
        w = x.split()
        return {tuple(w[i : i + 3]) for i in range(len(w) - 2)}

    a = [sets(x) for x in texts]
    assert max(len(x & y) / len(x | y) for i, x in enumerate(a) for y in a[:i]) < 0.9
    assert all(r["doc_id"] == r["component_id"] for r in got)
    assert sum(sent) < 40, sent


def test_parity_bits_keep_every_linked_pair(spark):
    """Pairs right at the threshold pass the bits, whatever their size."""
    rng = random.Random(5)
    rows = []
    for k, n in enumerate((9, 18, 90, 450, 1800)):
        a = sorted(rng.getrandbits(64) - 2**63 for _ in range(n + n // 9))
        rows += [(k, 0, a[:n]), (k, 1, a[n // 9 :])]
    h = spark.createDataFrame(rows, "k int, side int, h array<bigint>")
    bits = line_dedup.with_ranges(h, line_dedup.WORDS).select("k", "side", F.size("h").alias("n"), *line_dedup.parity_bits())
    a, b = bits.where("side = 0").alias("a"), bits.where("side = 1").alias("b")
    assert a.join(b, F.col("a.k") == F.col("b.k")).where(line_dedup._may_link("a", "b")).count() == 5


def shuffle_files(spark):
    return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ").count("shuffle_")


def test_a_stored_table_leaves_no_shuffle_files(spark, monkeypatch):
    """The shuffles of a stored table and of component rounds go when they end, not when the driver collects its garbage; settings stay."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def left(make):
        before = shuffle_files(spark)
        out = make()
        for _ in range(50):  # the files are removed in the background
            if shuffle_files(spark) <= before:
                break
            time.sleep(0.1)
        return out, shuffle_files(spark) - before

    counts = spark.range(5000).groupBy((F.col("id") % 700).alias("k")).count()
    out, files = left(lambda: common.stored(counts, "counts"))
    assert files <= 0 and out.count() == 700 and counts.count() == 700
    edges = spark.range(400).select(F.col("id").alias("u"), (F.col("id") - F.col("id") % 20).alias("v"))
    comps, files = left(lambda: common.connected_components(edges))
    assert files <= 0 and comps.select("component").distinct().count() == 20
    levels, files = left(lambda: ngram_join.shingle_counts(documents(spark, [(1, "a b c d"), (2, "b c d e")]), 3))
    assert files <= 0 and sum(x > 0 for x in levels) == 3
    assert spark.conf.get(key, None) is None
    spark.conf.set(key, "false")
    common.stored(counts, "counts")
    assert spark.conf.get(key) == "false"
    spark.conf.unset(key)


def test_line_hashes_are_cut_in_generated_code(spark):
    """Characters are not decoded one by one, and band keys and sketches of long lines are not read below a lambda; a run has one hash in lines of any characters."""
    lines = ["abcdefg", "\u00e9abcdefg", "abcdefg\u4e2d", "abcdefg\U0001f600", "ab", "", "\u4e2dx", "\u00e4\u00b8\u00adx"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, low string").repartition(1)
    h = {r["i"]: r["h"] for r in df.select("i", line_dedup.runs(F.col("low")).alias("h")).collect()}
    assert [len(h[i]) for i in range(8)] == [3, 4, 4, 4, 1, 1, 1, 1]
    assert all(set(h[0]) <= set(h[i]) for i in (1, 2, 3)) and len({x for v in h.values() for x in v}) == 3 + 3 + 4
    long = "".join(chr(97 + k % 23) + str(k) for k in range(60))
    rows = line_dedup.line_nodes(documents(spark, [(1, long), (2, "a short line")]))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "decode" not in plan.lower() and "filter(array" not in plan and "transform(slice" not in plan
    got = {r["first"]["doc_id"]: r for r in rows.collect()}
    assert len(got[1]["keys"]) == line_dedup.RANGES and len(got[1]["sketch"]) == line_dedup.BOTTOM
    assert got[2]["n"] == len(got[2]["keys"]) == len(got[2]["sketch"]) == 8 and min(got[2]["sketch"]) >= 0


def test_unrelated_lines_meet_in_few_keys_and_are_read_again_once(spark, monkeypatch):
    """Lines of the same few syllables share many shingles without being near copies; those with a key that is met are fetched once, not in each round."""
    rng = random.Random(17)
    parts = "tion the an er in re on at en nd or es ed th of ing ou ea st ha".split()
    lines = ["".join(rng.choice(parts) + rng.choice(("", " ")) for _ in range(rng.randint(120, 200))) for _ in range(300)]
    lines += [x[:90] + "#" + x[91:] for x in lines[:5]]
    df = documents(spark, list(enumerate(lines)))
    pairs = line_dedup.pairs_with(line_dedup.met_keys(line_dedup.line_nodes(df)), "lo", "hi").count()
    assert 5 <= pairs < 150, pairs
    read, again = [], line_dedup.wanted_lines
    monkeypatch.setattr(line_dedup, "wanted_lines", lambda *a: read.append(1) or again(*a))
    got = {r["doc_id"]: r["kept"] for r in line_dedup.line_decisions(df).collect()}
    assert len(read) == 1 and got == {i: i < 300 for i in range(305)}


def test_lines_around_the_short_size_meet(spark):
    """Lines with a band key from every hash meet those of similar size with a key for each range."""
    base = "abcdefghijklmnopqrstuvwxyz0123456789"
    sizes = [(x, y) for x in range(line_dedup.SHORT - 4, line_dedup.SHORT + 1) for y in range(line_dedup.SHORT, 31) if x < y and 100 * x >= 80 * y]
    # the k-th pair shares its shingles with no other pair: its letters are shifted in code points
    shift = lambda text, k: "".join(chr(0x4E00 + 40 * k + base.index(c)) for c in text)
    rows = [(2 * k + j, shift(base[: n + 4], k)) for k, pair in enumerate(sizes) for j, n in enumerate(pair)]
    got = {r["doc_id"]: r["kept"] for r in line_dedup.line_decisions(documents(spark, rows)).collect()}
    assert got == {i: i % 2 == 0 for i, _ in rows} and len(sizes) > 10
