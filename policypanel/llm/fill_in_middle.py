"""Fill-in-middle transformation by counted-quantifier regular expressions, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One unit of text: a code point, line ends included.
UNIT = r"(?s:.)"
#: Marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: Units counted at a time, so that counting holds one string per so many units and not one per unit.
STRIDE = 1024


def counted(text: Column, unit: str, stride: int = STRIDE) -> tuple[Column, Column]:
    """(blocks, rest): how many runs of ``stride`` units regexp_count finds, and an expression of ``blocks`` for the text after them.

    Both quantifiers are possessive, so neither pass steps back. The caller keeps ``blocks`` as a column
    of its own before it uses the second expression.
    """
    blocks = F.regexp_count(text, F.lit(f"{unit}{{{stride}}}+")).cast("long")
    rest = F.call_function("regexp_extract", text, F.concat(F.lit(rf"\A{unit}{{"), F.col("blocks") * stride, F.lit(r"}+((?s:.*+))\z")), F.lit(1))
    return blocks, rest


def fill_in_middle(docs: DataFrame, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20, unit: str = UNIT, marks: tuple[str, str, str] = MARKS, stride: int = STRIDE) -> DataFrame:
    """Cuts each text of ``docs`` (doc_id, text) at two hashed places and reorders the three parts around ``marks``.

    regexp_count gives the number n of units. With h1 to h4 the first 8-digit groups of the sha256 of ``seed:doc_id``, prefix ends after the smaller and
    middle after the larger of h1 % (n + 1) and h2 % (n + 1) units: a pattern of the row's own, ``(unit{a}+)(unit{b-a}+)(rest)``,
    captures all three in one match, and its replacement puts them in order. Form: ``plain`` (text unchanged)
    if the text is empty or holds a mark or h3 % 100 is among the last ``plain_percent``; else ``spm`` if h4 % 100 < ``spm_percent``, else ``psm``.

    ``unit`` is a pattern of one node or a group of fixed form that matches no empty string and, repeated, covers every text.

    Result, a row per input row: doc_id, n (units), form, prefix_units, middle_units (null if plain), output. Null text: empty. Null
    doc_id: hashed as the empty string. Repeated rows each keep a row. Extra columns are left out. Empty table: no rows.
    """
    p, s, m = marks
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    blocks, rest = counted(F.col("text"), unit, stride)
    sha = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    words = [F.conv(F.substring(sha, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    sized = (
        base.select("*", blocks.alias("blocks"), *words)
        .select("*", (F.col("blocks") * stride + F.regexp_count(rest, F.lit(unit))).alias("n"))
    )
    ends = [F.col(h) % (F.col("n") + 1) for h in ("h1", "h2")]
    marked = F.contains("text", F.lit(p)) | F.contains("text", F.lit(s)) | F.contains("text", F.lit(m))
    form = (
        F.when((F.col("text") == "") | marked | (F.col("h3") % 100 >= 100 - plain_percent), "plain")
        .when(F.col("h4") % 100 < spm_percent, "spm")
        .otherwise("psm")
    )
    cut = sized.select("doc_id", "text", "n", F.least(*ends).alias("a"), F.greatest(*ends).alias("b"), form.alias("form"))
    pattern = F.concat(F.lit(rf"\A({unit}{{"), "a", F.lit(rf"}}+)({unit}{{"), F.col("b") - F.col("a"), F.lit(r"}+)((?s:.*+))\z"))
    order = F.when(F.col("form") == "spm", f"{s}$3{p}$1{m}$2").otherwise(f"{p}$1{s}$3{m}$2")
    cutting = F.col("form") != "plain"
    return cut.select(
        "doc_id", "n", "form",
        F.when(cutting, F.col("a")).alias("prefix_units"),
        F.when(cutting, F.col("b") - F.col("a")).alias("middle_units"),
        F.when(cutting, F.regexp_replace("text", pattern, order)).otherwise(F.col("text")).alias("output"),
    )


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that ``fill_in_middle`` made ``output`` of. The parts hold no mark, and no mark can arise across the border of a part and a mark."""
    parts = F.split(output, "|".join(rf"\Q{k}\E" for k in marks), -1)
    return (
        F.when(form == "plain", output)
        .when(form == "spm", F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1))))
        .otherwise(F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2))))
    )


def digests(formatted: DataFrame) -> DataFrame:
    """Digest columns of ``fill_in_middle``'s rows: the output's and the rebuilt text's sha256."""
    return formatted.select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
