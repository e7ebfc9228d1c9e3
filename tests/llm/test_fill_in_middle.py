"""The fill-in-middle transformation against slicing in Python."""

import hashlib
import random

import pytest

from policypanel.llm import fill_in_middle as fim

SCHEMA = "doc_id long, text string, n long, form string, blocks long, h1 string"


def frame(spark, rows):
    """Documents with extra columns whose names the operator uses inside."""
    return spark.createDataFrame([(i, t, -1, "x", -1, "x") for i, t in rows], SCHEMA)


def expected(doc_id, text, units):
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def hostile():
    rng = random.Random(5)
    letters = "ab \n\r\t$\\é漢😀<>PSM \x00́"
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    rows += [(1000 + i, "x" * 4 + t) for i, t in enumerate(("<P>", "<S>", "<M>", "<p>", "<<P", "$1", "\\E", "\\"))]
    rows += [(2000 + i, "<" * i + "P" + ">" * i) for i in range(1, 12) if i != 1] + [(2100 + i, ">S<" * i) for i in range(12)]
    rows += [(3000 + i, "😀\n" * k) for i, k in enumerate((511, 512, 513, 1024, 150_000))]
    return rows + [(7, None), (8, ""), (None, "no id"), (None, None), (9, "again"), (9, "again")]


def test_every_cut_and_the_text_rebuilt(spark):
    rows = hostile()
    got = fim.fill_in_middle(frame(spark, rows)).collect()
    want = [expected(i, t or "", list(t or "")) for i, t in rows]
    key = lambda r: (r[0] is None, r[0] or 0, r[5])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert {r["form"] for r in got} == {"plain", "spm", "psm"}
    back = fim.digests(fim.fill_in_middle(frame(spark, rows)))
    assert back.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted((r["restored_sha256"], r["output_sha256"]) for r in back.collect()) == sorted((digest(t or ""), digest(w[5])) for (_, t), w in zip(rows, want))


@pytest.mark.parametrize("stride", [1, 3, 64])
def test_the_stride_of_the_count_changes_nothing(spark, stride):
    rows = hostile()[:150]
    df = frame(spark, rows)
    assert sorted(map(str, fim.fill_in_middle(df, stride=stride).collect())) == sorted(map(str, fim.fill_in_middle(df).collect()))


def test_lines_as_units(spark):
    rows = [(i, "".join(f"line {k}\n" for k in range(i))) for i in range(40)]
    got = fim.fill_in_middle(frame(spark, rows), unit=r"(?:[^\n]*+\n)").collect()
    want = [expected(i, t, t.splitlines(keepends=True)) for i, t in rows]
    assert sorted(map(tuple, got)) == sorted(want)


def test_empty_table(spark):
    assert fim.digests(fim.fill_in_middle(frame(spark, []))).collect() == []


def test_no_python_in_the_plan(spark):
    plan = fim.digests(fim.fill_in_middle(frame(spark, [(1, "a")])))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Exchange" not in plan
