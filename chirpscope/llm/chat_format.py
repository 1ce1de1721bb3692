"""Chat formatting of typed content parts, in DataFrame functions only.

A message is a list of parts.  A visitor - one expression per kind of part - flattens them in
order: a run of text becomes escaped text; an image, audio or document part becomes a numbered placeholder
``<|kind:i|>``, its reference is recorded, and the tokens it will expand to are counted.

    <|im_start|>ROLE \\n CONTENT<|im_end|> \\n        for each turn

Escaping is reversible: ``<``, any number of backslashes, ``|`` gets one backslash more, so no
escaped text holds ``<|`` and every control string in the output is the template's own.  A newline
in a role is written ``<|nl|>``.

The loss mask lists the spans (code points, start and end) of assistant texts in the output.

A conversation is one row of output, so one task holds the turns of one conversation.

Cases: null text or role is empty; turns are ordered by turn (null first), then role, then
content; repeated rows stay; a null conversation id is a conversation of its own; unknown kinds of
part get a placeholder of 0 tokens; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, NEWLINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
#: Side of the square patch of an image that makes one token, tokens of a second of audio and of
#: a page of a document.
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 25, 1024

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def text_part(text: Column) -> Column:
    """A message of one text part."""
    null = lambda kind: F.lit(None).cast(kind)
    return F.array(F.struct(F.lit("text").alias("kind"), text.cast("string").alias("text"), null("string").alias("ref"),
                            null("int").alias("width"), null("int").alias("height"), null("double").alias("seconds"),
                            null("int").alias("pages")))


def tokens_of(part: Column) -> Column:
    """Tokens that a placeholder expands to, by kind."""
    side = lambda c: F.ceil(F.coalesce(part[c], F.lit(0)) / PATCH)
    return (F.when(part["kind"] == "image", side("width") * side("height"))
            .when(part["kind"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_RATE))
            .when(part["kind"] == "document", F.coalesce(part["pages"], F.lit(0)).cast("long") * PAGE_TOKENS)
            .otherwise(F.lit(0)).cast("long"))


def flatten_parts(messages: DataFrame, parts: str = "parts") -> DataFrame:
    """Adds content, attachments (ordinal, kind, ref, tokens) and expanded_tokens."""
    p = F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>"))
    is_text = lambda x: F.coalesce(x["kind"], F.lit("text")) == "text"
    others = F.filter(p, lambda x: ~is_text(x))
    attachments = F.transform(others, lambda x, i: F.struct(
        i.alias("ordinal"), x["kind"].alias("kind"), x["ref"].alias("ref"), tokens_of(x).alias("tokens")))
    kind = lambda x: F.regexp_replace(x["kind"], r"[<|>\\:]", "_")
    # neighbouring text parts are one run, escaped as a whole: a control string can't be pieced together
    visit = lambda acc, x: F.when(is_text(x), F.struct(
        acc["s"].alias("s"), F.concat(acc["run"], F.coalesce(x["text"], F.lit(""))).alias("run"), acc["n"].alias("n"))).otherwise(F.struct(
            F.concat(acc["s"], escape(acc["run"]), F.lit("<|"), kind(x), F.lit(":"), acc["n"].cast("string"), F.lit("|>")).alias("s"),
            F.lit("").alias("run"), (acc["n"] + 1).alias("n")))
    one_text = (F.size(p) == 1) & is_text(F.get(p, F.lit(0)))
    content = F.when(one_text, escape(F.coalesce(F.get(p, F.lit(0))["text"], F.lit("")))).otherwise(
        F.aggregate(p, F.struct(F.lit("").alias("s"), F.lit("").alias("run"), F.lit(0).alias("n")), visit,
                    lambda acc: F.concat(acc["s"], escape(acc["run"]))))
    return (messages.withColumn("content", content).withColumn("attachments", attachments)
            .withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda acc, x: acc + x["tokens"])))


def format_chats(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 parts: str = "parts", assistant: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans, attachments, expanded_tokens."""
    rows = flatten_parts(messages.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.col(parts).alias("parts"))).drop("parts")
    named = F.regexp_replace(escape(F.col("role")), "\n", NEWLINE)
    rows = rows.withColumn("head", F.concat(F.lit(START), named, F.lit("\n")))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "turn", "role", "content", "head", "attachments", "expanded_tokens"))).alias("t"))
    whole = lambda x: F.concat(x["head"], x["content"], F.lit(END + "\n"))
    span = lambda acc, x: F.struct(
        (acc["at"] + F.length(x["head"]) + F.length(x["content"]) + len(END) + 1).alias("at"),
        F.when(x["role"] == assistant, F.concat(acc["spans"], F.array(F.struct(
            (acc["at"] + F.length(x["head"])).alias("start"),
            (acc["at"] + F.length(x["head"]) + F.length(x["content"])).alias("end"))))).otherwise(acc["spans"]).alias("spans"))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    return turns.select(
        "conv_id", F.array_join(F.transform("t", whole), "").alias("formatted"),
        F.aggregate("t", F.struct(F.lit(0).alias("at"), empty.alias("spans")), span, lambda acc: acc["spans"]).alias("loss_spans"),
        F.flatten(F.transform("t", lambda x: F.transform(x["attachments"], lambda a: F.struct(
            x["turn"].alias("turn"), a["ordinal"].alias("ordinal"), a["kind"].alias("kind"), a["ref"].alias("ref"),
            a["tokens"].alias("tokens"))))).alias("attachments"),
        F.aggregate("t", F.lit(0).cast("long"), lambda acc, x: acc + x["expanded_tokens"]).alias("expanded_tokens"))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    pieces = F.split(formatted, r"<\|im_start\|>")
    bodies = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))

    def one(x: Column) -> Column:
        cut = F.instr(x, "\n")
        return F.struct(
            unescape(F.replace(F.substring(x, F.lit(1), cut - 1), F.lit(NEWLINE), F.lit("\n"))).alias("role"),
            unescape(F.substring(x, cut + 1, F.length(x) - cut - (len(END) + 1))).alias("text"))

    return F.transform(bodies, one)


def digest(chats: DataFrame) -> DataFrame:
    """What the output itself says: turns, masked text and lengths, read back from ``formatted``."""
    turns = F.transform("t", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    masked = F.transform("loss_spans", lambda s: unescape(F.substring("formatted", s["start"] + 1, s["end"] - s["start"])))
    return chats.withColumn("t", read_back(F.col("formatted"))).withColumn("_loss", F.array_join(masked, "")).select(
        "conv_id", F.size("t").cast("long").alias("n_turns"), F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"), F.sha2(F.col("_loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
