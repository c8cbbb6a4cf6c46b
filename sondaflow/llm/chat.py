"""Conversations as one marked text each, with the spans a model is trained on.

Relational formatting by Spark expressions only: the turns of a conversation are
collected as structs and sorted, adjacent turns of one role are merged into a
block by array functions, and the blocks are concatenated:

    <|role:user|>⏎first text<|turn|>second text<|end|>⏎<|role:assistant|>⏎…<|end|>⏎

Control strings inside texts and roles are escaped: a percent sign becomes
``%25`` and the first character of a control string its own code, so ``<|``
becomes ``%3C|``. No escaped text holds ``<|``, hence only marks do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Control strings of common chat templates, besides the marks used here.
CONTROLS = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
            "<start_of_turn>", "<end_of_turn>")
NO_ROLE = "%0"
TURN, END = "<|turn|>", "<|end|>\n"
SPANS = 64


def _code(control: str) -> str:
    return f"%{ord(control[0]):02X}"


def escape(text: Column, controls: Sequence[str] = CONTROLS) -> Column:
    out = F.replace(text, F.lit("%"), F.lit("%25"))
    for control in controls:
        out = F.replace(out, F.lit(control), F.lit(_code(control) + control[1:]))
    return out


def unescape(text: Column, controls: Sequence[str] = CONTROLS) -> Column:
    for code, char in sorted({(_code(c), c[0]) for c in controls}):
        text = F.replace(text, F.lit(code), F.lit(char))
    return F.replace(text, F.lit("%25"), F.lit("%"))


def format_conversations(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", trained: Sequence[str] = ("assistant",),
                         controls: Sequence[str] = CONTROLS) -> DataFrame:
    """Per conversation: its id, ``formatted``, and ``loss``, the spans (start, length) in code points
    of the texts of the trained roles, in order.

    Turns are ordered by turn, ties by role and text; a null turn comes first, and
    a repeated row is a turn of its own. A null text is empty; a null role is a
    role without a name, which is never trained. A null id is one conversation. A very long text
    or conversation is formatted whole, in one row. No rows
    give no rows; other columns are ignored.
    """
    marks = (*controls, "|>")
    turns = (rows.select(
                F.col(conversation).alias("id"), F.col(turn).alias("turn"), F.col(role).alias("role"),
                escape(F.coalesce(F.col(text), F.lit("")), controls).alias("text"),
                F.col(text).alias("plain"))
             .groupBy("id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "plain", "text"))).alias("turns")))
    # The places at which another role begins, and the blocks between them.
    turns = turns.withColumn("begins", F.expr(
        "filter(sequence(0, size(turns) - 1), i -> i = 0 or not (turns[i].role <=> turns[i - 1].role))"))
    blocks = turns.withColumn("blocks", F.expr(
        "transform(begins, (b, k) -> struct(turns[b].role as role, transform("
        "slice(turns, b + 1, coalesce(get(begins, k + 1), size(turns)) - b), t -> t.text) as texts))"))

    def head(name: Column) -> Column:
        return F.concat(F.lit("<|role:"), F.coalesce(escape(name, marks), F.lit(NO_ROLE)), F.lit("|>\n"))

    blocks = blocks.withColumn("parts", F.transform("blocks", lambda b: F.struct(
        head(b["role"]).alias("head"), b["texts"].alias("texts"),
        F.coalesce(b["role"].isin(*trained), F.lit(False)).alias("loss"))))
    formatted = F.array_join(F.transform("parts", lambda b: F.concat(
        b["head"], F.array_join(b["texts"], TURN), F.lit(END))), "")
    # Text lengths with what stands before each text, then one running sum per conversation.
    steps = F.flatten(F.transform("parts", lambda b, k: F.transform(b["texts"], lambda t, j: F.struct(
        F.when(j > 0, F.lit(len(TURN))).otherwise(
            F.length(b["head"]) + F.when(k > 0, len(END)).otherwise(0)).alias("gap"),
        F.length(t).alias("length"), b["loss"].alias("loss")))))
    spans = F.aggregate(
        "steps", F.expr("struct(0 as at, cast(array() as array<struct<start:int,length:int>>) as spans)"),
        lambda acc, s: F.struct(
            (acc["at"] + s["gap"] + s["length"]).alias("at"),
            F.when(s["loss"], F.array_append(acc["spans"], F.struct(
                (acc["at"] + s["gap"]).alias("start"), s["length"].alias("length"))))
            .otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    return (blocks.withColumn("steps", steps)
            .select(F.col("id").alias(conversation), formatted.alias("formatted"), spans.alias("loss")))


def read_back(formatted: DataFrame, controls: Sequence[str] = CONTROLS) -> DataFrame:
    """Adds ``turns``, the (role, text) structs that the text was made of, and ``loss_text``, all text
    under the loss spans, unescaped. A null role reads back as null."""
    marks = (*controls, "|>")
    ends = r"<\|end\|>\n"

    def part_text(spans: Column) -> Column:
        # A place is found by walking to it, so a few spans share one walk through the whole text.
        first, last = F.get(spans, F.lit(0)), F.element_at(spans, -1)
        part = F.substring("formatted", first["start"] + 1, last["start"] + last["length"] - first["start"])
        return F.get(F.transform(F.array(part), lambda whole: F.transform(spans, lambda s: unescape(
            F.substring(whole, s["start"] - first["start"] + 1, s["length"]), controls))), F.lit(0))

    block = F.split("formatted", ends, -1)
    return (formatted
            .withColumn("__blocks", F.slice(block, 1, F.size(block) - 1))
            .withColumn("turns", F.flatten(F.transform("__blocks", lambda b: F.transform(
                F.split(F.regexp_replace(b, r"^(?s)<\|role:.*?\|>\n", ""), r"<\|turn\|>", -1),
                lambda t: F.struct(
                    F.nullif(F.regexp_extract(b, r"^(?s)<\|role:(.*?)\|>\n", 1), F.lit(NO_ROLE)).alias("role"),
                    t.alias("text"))))))
            .withColumn("turns", F.transform("turns", lambda t: F.struct(
                unescape(t["role"], marks).alias("role"), unescape(t["text"], controls).alias("text"))))
            .withColumn("__parts", F.transform(
                F.filter(F.transform("loss", lambda s, i: F.when(i % SPANS == 0, F.slice("loss", i + 1, SPANS))),
                         lambda part: part.isNotNull()), part_text))
            .withColumn("loss_text", F.array_join(F.flatten("__parts"), ""))
            .drop("__blocks", "__parts"))


def digests(read: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """Counts and digests of what was read back."""
    script = F.array_join(F.transform("turns", lambda t: F.concat(
        F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        conversation, F.size("turns").cast("long").alias("n_turns"), F.sha2(script, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
