"""Chat formatting: messages of typed parts become marked strings, with a loss mask and the places of attachments.

A visitor turns each part of a message, in order, into a mark and a body: a text's body is the text, an image, a sound or
a document has none and leaves a reference with the number of tokens that its mark stands for.  Marks are control strings;
in texts and roles every control string gets a backslash behind its first letter (and one that has backslashes there gets
one more), which the reader takes away again, so a text can hold anything.  A message is formatted by itself, wherever its
row lies; only what needs a whole conversation groups it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import fresh

#: Marks of this template: a message, its parts, and its end.
TURN, END = "<|turn|>", "<|end|>"
KINDS = ("text", "image", "audio", "document")
#: Control strings of this and of other public templates (fixed values): any <|, <s>, </s>, [INST], [/INST], <<SYS>>, <</SYS>>.
CONTROL = r"([<\[]){slashes}(\||/?s>|/?INST\]|</?SYS>>)"
#: Tokens of an attachment: a patch of an image's pixels a side, a second of sound, a page of a document.
PATCH, PER_SECOND, PER_PAGE = 28, 25, 256
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
LOSS_ROLES = ("assistant",)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL.format(slashes=r"(\\*)"), r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL.format(slashes=r"\\(\\*)"), "$1$2$3")


def text_part(text: Column) -> Column:
    """The content of a message that is one text."""
    none = {k: F.lit(None) for k in ("ref", "width", "height", "seconds", "pages")}
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *(v.alias(k) for k, v in none.items()))).cast(f"array<{PART}>")


def _mark(kind: Column) -> Column:
    return F.concat(F.lit("<|"), kind, F.lit("|>"))


def visited(part: Column) -> Column:
    """A part as (kind, mark, body, ref, tokens); a kind that isn't known is an empty document."""
    kind = F.when(part["kind"].isin(*KINDS), part["kind"]).otherwise("document")
    sides = [F.greatest(F.ceil(F.coalesce(part[x], F.lit(0)) / PATCH), F.lit(0)) for x in ("width", "height")]
    tokens = (
        F.when(kind == "image", sides[0] * sides[1])
        .when(kind == "audio", F.ceil(F.greatest(F.coalesce(part["seconds"], F.lit(0.0)), F.lit(0.0)) * PER_SECOND))
        .when(kind == "document", F.greatest(F.coalesce(part["pages"], F.lit(0)), F.lit(0)).cast("long") * PER_PAGE)
    )
    body = F.when(kind == "text", escaped(F.coalesce(part["text"], F.lit("")))).otherwise("")
    return F.struct(kind.alias("kind"), _mark(kind).alias("mark"), body.alias("body"), part["ref"].alias("ref"), tokens.cast("long").alias("tokens"))


def format_turns(df: DataFrame, role: str, content: str, loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """df with formatted (string), loss (array of start and length, code points from 0, of the texts to learn) and
    attachments (array of part, kind, ref, at, tokens: part and place in the message, and the tokens the mark expands to).

    content is an array of PART structs; a null one is empty, as are a null role and a null text.  Any number of parts, in
    any order, may be of any kind; texts may be of any length that fits a row.  Columns of df with the new names are
    replaced.  No row moves.
    """
    new = ("formatted", "loss", "attachments")
    old = [c for c in df.columns if c.lower() not in new]
    pieces, head, starts = fresh(df, "_pieces"), fresh(df, "_head"), fresh(df, "_starts")
    parts = F.coalesce(F.transform(content, visited), F.array().cast("array<struct<kind:string,mark:string,body:string,ref:string,tokens:bigint>>"))
    df = df.withColumns({pieces: parts, head: F.concat(F.lit(TURN), escaped(F.coalesce(F.col(role), F.lit(""))))})
    size = lambda p: F.length(p["mark"]) + F.length(p["body"])
    df = df.withColumn(starts, F.aggregate(pieces, F.array(F.length(head)), lambda s, p: F.concat(s, F.array(F.element_at(s, -1) + size(p)))))
    formatted = F.concat(F.col(head), F.array_join(F.transform(pieces, lambda p: F.concat(p["mark"], p["body"])), ""), F.lit(END))

    def placed(p: Column, i: Column) -> Column:
        return F.struct(i.alias("part"), p["kind"].alias("kind"), p["ref"].alias("ref"), F.get(starts, i).alias("at"), p["tokens"].alias("tokens"))

    def learnt(p: Column, i: Column) -> Column:
        return F.struct((F.get(starts, i) + F.length(p["mark"])).alias("start"), F.length(p["body"]).alias("length"), (p["kind"] == "text").alias("is_text"))

    spans = F.transform(F.filter(F.transform(pieces, learnt), lambda x: x["is_text"]), lambda x: F.struct(x["start"], x["length"]))
    none = F.array().cast("array<struct<start:int,length:int>>")
    return df.select(
        *old,
        formatted.alias("formatted"),
        F.when(F.col(role).isin(*loss_roles), spans).otherwise(none).alias("loss"),
        F.filter(F.transform(pieces, placed), lambda x: x["kind"] != "text").alias("attachments"),
    )


def read_turn(formatted: Column) -> Column:
    """A formatted message as (role, parts), parts an array of (kind, text)."""
    # Texts hold no <| any more, so it parts a message at its marks: nothing, the role, the parts, the end.
    segments = F.transform(F.split(formatted, r"<\|"), lambda s: F.struct(F.substring_index(s, "|>", 1).alias("kind"), s.alias("all")))
    plain = F.transform(segments, lambda s: F.struct(s["kind"].alias("kind"), unescaped(F.substr(s["all"], F.length(s["kind"]) + 3)).alias("text")))

    def told(x: Column) -> Column:
        return F.struct(F.get(x, F.lit(1))["text"].alias("role"), F.slice(x, F.lit(3), F.greatest(F.size(x) - 3, F.lit(0))).alias("parts"))

    return F.get(F.transform(F.array(plain), told), F.lit(0))


def learnt_text(formatted: Column, loss: Column) -> Column:
    """All that stands under a message's mask, unescaped, with nothing between."""
    return F.array_join(F.transform(loss, lambda x: unescaped(F.substr(formatted, x["start"] + 1, x["length"]))), "")


def conversations(df: DataFrame, conv: str, turn: str, role: str, content: str) -> DataFrame:
    """(conv_id, turns): a row for each conversation, turns an array of (turn, formatted, loss, attachments) in order.

    Messages stand by turn, nulls first, then by their formatted strings; repeated ones stay.  A null conv is a conversation of its
    own.  A conversation must fit a row; its messages are gathered by partial aggregation.  An empty table has none.
    Other columns of df are left out.
    """
    rows = df.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(content).alias("content"))
    rows = format_turns(rows, "role", "content")
    turns = F.array_sort(F.collect_list(F.struct("turn", "formatted", "loss", "attachments")))
    return rows.groupBy("conv_id").agg(turns.alias("turns"))
