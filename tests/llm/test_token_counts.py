"""Token counts against the libraries on whole texts."""

import random

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from policypanel.llm import token_counts as tc

SCHEMA = "doc_id long, text string, n_bytes string, words string"
PATH = P.path("word_bpe_49k.json")


def frame(spark, rows):
    """Documents with extra columns whose names the operator uses inside."""
    return spark.createDataFrame([(i, t, "x", "x") for i, t in rows], SCHEMA)


def hostile():
    rng = random.Random(3)
    spaces = [chr(c) for c in (*range(9, 14), 32, 28, 29, 30, 31, 0x85, 0xA0, 0x2003, 0x3000, 0)]
    words = ["it's", "Don'T", "ΑΣ", "Σας", "é", "́", "x" * 70, "ab" * 200, "1234", "漢字", "😀😀", "<|endoftext|>", "a<|startoftext|>b", "<|ENDOFTEXT|>", "...", "'", "s", "İI", "ﬁne", "naïve"]
    rows = []
    for i in range(200):
        rows.append((i, "".join(rng.choice(words) + rng.choice(spaces) * rng.randint(0, 2) for _ in range(rng.randint(0, 60)))))
    return rows + [(900, None), (901, ""), (902, " \n\t"), (None, "no id"), (None, None), (903, "again and again"), (903, "again and again"), (904, "word " * 300_000), (905, "y" * 100_000)]


def as_rows(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in df.collect()), key=lambda r: (r[0] is None, r))


def wanted(rows, count):
    return sorted(((i, len((t or "").encode()), count(t or "")) for i, t in rows), key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("size, sample", [(tc.FREQUENT, tc.SAMPLE), (3, 20), (0, 1)])
def test_equal_to_the_library(spark, size, sample):
    t = Tokenizer.from_file(PATH)
    rows = hostile()
    got = as_rows(tc.count_tokens(frame(spark, rows), PATH, sample=sample, size=size))
    assert got == wanted(rows, lambda x: len(t.encode(x, add_special_tokens=False).ids))


def test_other_tokenizers(spark):
    rows = hostile()[:60] + [(900, None), (901, "")]
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    assert as_rows(tc.count_tokens(frame(spark, rows), P.path("byte_bpe_50k.json"))) == wanted(rows, lambda x: len(t.encode(x, add_special_tokens=False).ids))
    s = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    assert as_rows(tc.count_tokens(frame(spark, rows), P.path("piece_bpe_32k.model"))) == wanted(rows, lambda x: len(s.encode(x)))


def test_only_a_tokenizer_of_separate_words_is_looked_up_by_word():
    assert tc.words_apart(PATH)
    assert not tc.words_apart(P.path("byte_bpe_50k.json")) and not tc.words_apart(P.path("piece_bpe_32k.model"))


def test_caches_start_anew_and_keep_no_long_words(monkeypatch):
    monkeypatch.setattr(tc, "REMEMBERED", 3)
    c = tc.Cache(PATH)
    t = Tokenizer.from_file(PATH)
    for words in ({"one", "two"}, {"three", "four", "z" * 100}, {"one"}, set(), {"a b", "five", "six", "seven", "eight"}):
        c.learn({w.encode() for w in words})
        for w in words:
            assert c[w.encode()] == len(t.encode(w, add_special_tokens=False).ids)
        assert len(c) <= 5 and all(len(k) <= tc.WORD_BYTES for k in c)


def test_windows_cut_at_white_space_only():
    raw = b"aa bb\ncc " + b"d" * 50 + b" e"
    for size in range(1, 20):
        parts = list(tc.windows(raw, size))
        assert b"".join(parts) == raw
        assert [w for p in parts for w in p.split()] == raw.split()


def test_packed_table_travels_whole():
    table = {b"a": 1, "é".encode(): 2, b"zz": 300}
    assert tc.unpacked(tc.packed(table)) == table and tc.unpacked(tc.packed({})) == {}


def test_no_shuffle_behind_the_count_and_empty_table(spark):
    df = tc.count_tokens(frame(spark, hostile()), PATH)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert tc.count_tokens(frame(spark, []), PATH).collect() == []
