"""Chat formatting of typed message parts into one training string with a loss mask."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>"
#: Control strings of this and other templates that a text must not contain as they are.
CONTROL = ("<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
#: What the first letter of a control string, a line end in a role, and the mark itself turn into.
MARKS = {"<": "&lt;", "[": "&lb;", "\n": "&nl;", "&": "&amp;"}
#: Tokens that a part expands to where the part does not say.
EXPANDED = {"image": 576, "audio": 750, "document": 1024}

PARTS = "array<struct<kind:string,text:string,ref:string,tokens:bigint>>"


def escaped(text: Column, control: tuple[str, ...] = CONTROL) -> Column:
    """The text without any control string; ``unescaped`` gives it back exactly."""
    steps = [("&", MARKS["&"]), *((c, MARKS[c[0]] + c[1:]) for c in control)]
    return reduce(lambda done, step: F.replace(done, F.lit(step[0]), F.lit(step[1])), steps, text)


def unescaped(text: Column) -> Column:
    """The mark's own form goes last, so that nothing is undone twice."""
    return reduce(lambda done, step: F.replace(done, F.lit(step[1]), F.lit(step[0])), MARKS.items(), text)


def text_part(text: Column) -> Column:
    """A message that is plain text, as its only part."""
    return F.array(F.struct(
        F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("bigint").alias("tokens")
    ))


def _visited(parts: Column, before: Column, expanded: Mapping[str, int], control: tuple[str, ...]) -> Column:
    """Walk over the parts: ``body`` with numbered placeholders, ``attachments`` in order.

    Neighbouring texts are joined before they are escaped, so that no control string
    can come about at their seam.
    """
    attachments = "array<struct<kind:string,ref:string,tokens:bigint>>"
    start = F.struct(F.lit("").alias("body"), F.lit("").alias("text"), F.array().cast(attachments).alias("attachments"))
    default = F.create_map(*[F.lit(x) for pair in expanded.items() for x in pair])

    def step(seen: Column, part: Column) -> Column:
        kind = F.coalesce(part["kind"], F.lit("text"))
        number = (before + F.size(seen["attachments"])).cast("string")
        tokens = F.coalesce(part["tokens"], default[kind].cast("bigint"), F.lit(0).cast("bigint"))
        placed = F.concat(seen["body"], escaped(seen["text"], control), F.lit("<|"), escaped(kind, control), F.lit(" "), number, F.lit("|>"))
        return F.when(
            kind == "text",
            F.struct(
                seen["body"].alias("body"), F.concat(seen["text"], F.coalesce(part["text"], F.lit(""))).alias("text"),
                seen["attachments"].alias("attachments"),
            ),
        ).otherwise(F.struct(
            placed.alias("body"), F.lit("").alias("text"),
            F.concat(seen["attachments"], F.array(F.struct(kind.alias("kind"), part["ref"].alias("ref"), tokens.alias("tokens")))).alias("attachments"),
        ))

    return F.aggregate(parts, start, step, lambda seen: F.struct(
        F.concat(seen["body"], escaped(seen["text"], control)).alias("body"), seen["attachments"].alias("attachments")
    ))


def format_conversations(
    messages: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    parts: str | None = None,
    text: str = "text",
    *,
    loss_roles: tuple[str, ...] = ("assistant",),
    expanded: Mapping[str, int] = EXPANDED,
    control: tuple[str, ...] = CONTROL,
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``loss``, ``attachments``, ``attachment_tokens``.

    A message's content is the column ``parts`` (``PARTS``: kind ``text``, or an
    attachment of kind ``image``, ``audio``, ``document`` or any other with its
    reference and token count), else its ``text`` as the only part. A turn becomes
    the turn mark, the role, a line end, the body, the end mark and a line end.
    Attachments turn into placeholders that count through the conversation;
    ``attachments`` has their kind, reference and expanded tokens in that order, an
    unknown kind without a count expanding to 0. ``loss`` has the spans (``start``,
    ``end`` exclusive, in code points) of the bodies of ``loss_roles``.

    Turns go by ``turn``, NULL first, then role and content. NULL roles, texts, parts
    and kinds count as empty or text; a NULL conversation is one of its own; repeated
    rows are turns of their own; other columns are not read. Rows are sorted outside
    of the collected list, and offsets are a running sum, so a long conversation
    costs no more than its length. An empty table gives an empty result.
    """
    content = F.coalesce(F.col(parts).cast(PARTS), F.array().cast(PARTS)) if parts else text_part(F.col(text).cast("string"))
    rows = messages.select(
        F.col(conversation).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), content.alias("parts"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "parts")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    if parts:
        is_attachment = lambda p: F.coalesce(p["kind"], F.lit("text")) != "text"
        before = F.coalesce(F.sum(F.size(F.filter("parts", is_attachment))).over(earlier), F.lit(0))
    else:
        before = F.lit(0).cast("bigint")
    rows = rows.withColumn("before", before).withColumn("seen", _visited(F.col("parts"), F.col("before"), expanded, control))
    head = F.concat(F.lit(TURN), F.replace(escaped(F.col("role"), control), F.lit("\n"), F.lit(MARKS["\n"])), F.lit("\n"))
    piece = F.concat("head", F.col("seen.body"), F.lit(END + "\n"))
    rows = rows.withColumn("head", head).withColumn("piece", piece)
    rows = rows.withColumn("at", F.coalesce(F.sum(F.length("piece")).over(earlier), F.lit(0)))
    start = F.col("at") + F.length("head")
    span = F.struct(start.alias("start"), (start + F.length("seen.body")).alias("end"))
    turns = F.array_sort(F.collect_list(F.struct(
        "at", "piece", F.when(F.col("role").isin(*loss_roles), span).alias("span"), F.col("seen.attachments").alias("attachments")
    )))
    each = rows.groupBy("conv_id").agg(turns.alias("turns"))
    attachments = F.flatten(F.col("turns.attachments"))
    return each.select(
        "conv_id",
        F.array_join(F.col("turns.piece"), "").alias("formatted"),
        F.filter(F.col("turns.span"), lambda s: s.isNotNull()).alias("loss"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]).alias("attachment_tokens"),
    )


def turns_of(formatted: Column) -> Column:
    """Read a formatted conversation back: an array of ``role`` and ``text`` (placeholders included)."""
    pieces = F.split(formatted, r"<\|turn\|>", -1)
    pieces = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        body = F.substr(piece, F.length(role) + 2, F.length(piece) - F.length(role) - 2 - F.lit(len(END)))
        return F.struct(unescaped(role).alias("role"), unescaped(body).alias("text"))

    return F.transform(pieces, turn)


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between the spans."""
    cut = lambda s: unescaped(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    return F.array_join(F.transform(loss, cut), "")
