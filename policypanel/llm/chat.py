"""Chat formatting by a grammar round trip, in DataFrame functions only.

Grammar of a formatted conversation::

    conversation := turn*
    turn         := '<s>' flag role '[INST]' text '[/INST]' '</s>'
    flag         := '' (content as it is) | '~' (content escaped)

The control strings are ``<s>``, ``</s>``, ``[INST]`` and ``[/INST]``. Escaped content writes ``~`` as
``~0``, ``<`` as ``~1`` and ``[`` as ``~2``, so it holds no control string. No control string
starts inside another, so the parser, which cuts at every control string, is deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROL = r"</?s>|\[/?INST\]"
OPEN, MID, CLOSE = "<s>", "[INST]", "[/INST]</s>"


def escape(c: Column) -> Column:
    for raw, code in (("~", "~0"), ("<", "~1"), ("[", "~2")):
        c = F.replace(c, F.lit(raw), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    for raw, code in (("<", "~1"), ("[", "~2"), ("~", "~0")):
        c = F.replace(c, F.lit(code), F.lit(raw))
    return c


def render(role: Column, text: Column, escaped: bool) -> Column:
    if escaped:
        return F.concat(F.lit(OPEN + "~"), escape(role), F.lit(MID), escape(text), F.lit(CLOSE))
    return F.concat(F.lit(OPEN), role, F.lit(MID), text, F.lit(CLOSE))


def parse(formatted: Column) -> Column:
    """The turns of a formatted text, array<struct<role, text>>; null where it breaks the grammar."""
    cut = F.split(formatted, CONTROL, -1)

    def turns(p: Column) -> Column:
        n = F.floor((F.size(p) - 1) / 4).cast("int")
        at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

        def one(i: Column) -> Column:
            role, text = F.get(p, i * 4 + 1), F.get(p, i * 4 + 2)
            coded = role.startswith("~")
            return F.struct(
                F.when(coded, unescape(F.substr(role, F.lit(2)))).otherwise(role).alias("role"),
                F.when(coded, unescape(text)).otherwise(text).alias("text"),
            )

        return F.when((F.size(p) - 1) % 4 == 0, F.transform(at, one))

    # one element, so that the cut is made once and then used many times
    return F.get(F.transform(F.array(cut), turns), F.lit(0))


def format_conversations(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text).

    Each turn is rendered as it is and parsed back; only where that does not give back exactly this
    turn is its content escaped. The turns are joined in turn order and the
    whole text is parsed once more. Result: conv_id, formatted, turns (parsed back), spans (the loss mask:
    array<struct<start, length>> of the code points that hold text of ``loss_role``, start
    from 0) and verified (the parsed turns equal the source).

    Null text or role: empty. Null conv_id: a conversation of its own. Turn order: null first, ties
    by role then text; repeated rows stay. Columns beyond the four are ignored. Empty table: no rows. A
    conversation is one output record, so its turns meet in one task; all work on single turns
    (rendering, round trip) is done before they meet.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    src = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    raw = src.withColumn("raw", render(F.col("role"), F.col("text"), False))
    back = raw.withColumn("back", parse(F.col("raw")))
    same = F.coalesce((F.size("back") == 1) & (F.get("back", F.lit(0)) == F.struct("role", "text")), F.lit(False))
    done = back.select(
        "conv_id",
        F.struct(
            "turn", "role", "text", F.when(same, F.col("raw")).otherwise(render(F.col("role"), F.col("text"), True)).alias("out"),
            F.when(same, F.length("role") + F.length(F.lit(OPEN + MID))).otherwise(F.length(escape(F.col("role"))) + F.length(F.lit(OPEN + MID)) + 1).alias("lead"),
        ).alias("t"),
    )
    conv = done.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    whole = conv.select("conv_id", "ts", F.array_join(F.col("ts.out"), "").alias("formatted"))
    tail = len(CLOSE)
    spans = F.aggregate(
        "ts",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda a, t: F.struct(
            (a["at"] + F.length(t["out"])).alias("at"),
            F.when(
                t["role"] == loss_role,
                F.concat(a["spans"], F.array(F.struct((a["at"] + t["lead"]).alias("start"), (F.length(t["out"]) - t["lead"] - tail).alias("length")))),
            ).otherwise(a["spans"]).alias("spans"),
        ),
    )["spans"]
    out = whole.select("conv_id", "ts", "formatted", parse(F.col("formatted")).alias("turns"), spans.alias("spans"))
    source = F.transform("ts", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return out.select("conv_id", "formatted", "turns", "spans", F.coalesce(F.col("turns") == source, F.lit(False)).alias("verified"))


def digests(formatted: DataFrame) -> DataFrame:
    """The digest columns, all read back from ``formatted`` and its mask.

    A masked span keeps the escapes of its turn; whether it has any shows in the flag
    after the turn's ``<s>``, the last one before the span.
    """
    f = F.col("formatted")

    def masked(s: Column) -> Column:
        body = F.substr(f, s["start"] + 1, s["length"])
        head = F.substring_index(F.substr(f, F.lit(1), s["start"]), OPEN, -1)
        return F.when(head.startswith("~"), unescape(body)).otherwise(body)

    loss = F.array_join(F.transform("spans", masked), "")
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return formatted.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "verified",
    )
