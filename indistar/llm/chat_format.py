"""Chat formatting: typed content parts flattened into one marked-up text per conversation.

A turn's content is a list of parts. A visitor renders every part in order: a text part is
escaped; an image, audio or document part becomes a numbered placeholder, its reference is
recorded among the conversation's attachments, and the tokens that a model will spend on it
are counted from its size. The template is

    <|turn|>ROLE<|says|>CONTENT<|over|>        for each turn, nothing between turns.

Every mark starts with ``<``. Inside roles and texts ``\\`` becomes ``\\e``, ``<`` becomes
``\\l`` and ``[`` becomes ``\\b``, so no control string of this or a bracketed template can
appear in a payload, and undoing the three in reverse order gives the text back. The loss
mask covers the content of assistant turns as code point spans of the formatted text.

Everything is built-in expressions. One shuffle by conversation; a conversation is one value
by contract, so its turns must meet, but nothing larger does.

Nulls: a null text, role or list of parts is empty; a null turn sorts first; rows with a null
conversation id form one conversation of their own. Turns with equal numbers are ordered by
role, then text; repeated rows are repeated turns. Parts of unknown type render as their
escaped text. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TURN, SAYS, OVER = "<|turn|>", "<|says|>", "<|over|>"
#: Plain character and its escape, in the order of escaping.
ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\b"))
LOSS_ROLE = "assistant"
#: Fixed parameters of the expansion: pixels per image token edge, audio tokens per second, tokens per page.
IMAGE_PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 25, 256

PART_TYPE = ("struct<type:string,text:string,uri:string,width:int,height:int,"
             "seconds:double,pages:int>")


def escape(c: Column) -> Column:
    for plain, code in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def text_part(text: Column) -> Column:
    """A one-part content list holding only text."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("uri"),
                            F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
                            F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages")))


def _is_media(p: Column) -> Column:
    return F.coalesce(p["type"].isin("image", "audio", "document"), F.lit(False))


def expanded_tokens(p: Column) -> Column:
    """Tokens that a part's placeholder stands for (0 for text or unknown sizes)."""
    edge = lambda c: F.ceil(F.coalesce(c, F.lit(0)) / IMAGE_PATCH)
    n = (F.when(p["type"] == "image", edge(p["width"]) * edge(p["height"]))
         .when(p["type"] == "audio", F.ceil(F.coalesce(p["seconds"], F.lit(0.0)) * AUDIO_RATE))
         .when(p["type"] == "document", F.coalesce(p["pages"], F.lit(0)) * PAGE_TOKENS))
    return F.coalesce(n, F.lit(0)).cast("long")


def render(parts: Column) -> Column:
    """Parts to text; a turn's media are numbered in order by their place among its parts."""
    def visit(p: Column, i: Column) -> Column:
        mark = F.concat(F.lit("<|"), p["type"], F.lit(":"), i.cast("string"), F.lit("|>"))
        return F.when(_is_media(p), mark).otherwise(escape(F.coalesce(p["text"], F.lit(""))))
    return F.array_join(F.transform(parts, visit), "")


def attachments(parts: Column) -> Column:
    """(part, type, uri, tokens) of every media part, in order."""
    def visit(p: Column, i: Column) -> Column:
        return F.struct(i.alias("part"), p["type"].alias("type"), p["uri"].alias("uri"),
                        expanded_tokens(p).alias("tokens"), _is_media(p).alias("media"))
    return F.filter(F.transform(parts, visit), lambda a: a["media"])


def format_conversations(turns: DataFrame, parts: str | None = None) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans, attachments, expanded_tokens.

    ``parts`` names a column of type array<PART_TYPE>; without it the column ``text`` is the
    content. ``loss_spans`` holds (start, length) in code points, start counted from 0.
    """
    content = (F.coalesce(F.col(parts), F.array().cast(f"array<{PART_TYPE}>")) if parts
               else text_part(F.col("text").cast("string")))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    t = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                     role.alias("role"), escape(role).alias("shown_role"), content.alias("parts"))
    t = t.withColumn("said", render(F.col("parts")))
    if parts:
        t = t.withColumn("attached", attachments(F.col("parts")))
    else:
        t = t.withColumn("attached", F.array().cast("array<struct<part:int,type:string,uri:string,tokens:bigint,media:boolean>>"))
    piece = F.concat(F.lit(TURN), "shown_role", F.lit(SAYS), "said", F.lit(OVER))
    t = t.select("conv_id", "turn", "role", "said", "attached", piece.alias("piece"),
                 (F.length("shown_role") + len(TURN) + len(SAYS)).alias("lead"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", unescape(F.col("said")))
    before = F.sum(F.length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    t = t.withColumn("rn", F.row_number().over(order)).withColumn("at", F.coalesce(before, F.lit(0)) + F.col("lead"))
    entry = F.struct("rn", "piece", (F.col("role") == LOSS_ROLE).alias("loss"), "at",
                     F.length("said").cast("long").alias("chars"), "attached")
    g = t.groupBy("conv_id").agg(F.sort_array(F.collect_list(entry)).alias("e"))
    spans = F.transform(F.filter("e", lambda x: x["loss"]),
                        lambda x: F.struct(x["at"].alias("start"), x["chars"].alias("length")))
    attached = F.flatten(F.transform("e", lambda x: F.transform(
        x["attached"], lambda a: F.struct((x["rn"] - 1).alias("turn"), a["part"].alias("part"),
                                          a["type"].alias("type"), a["uri"].alias("uri"),
                                          a["tokens"].alias("tokens")))))
    return g.select("conv_id", F.array_join(F.transform("e", lambda x: x["piece"]), "").alias("formatted"),
                    spans.alias("loss_spans"), attached.alias("attachments")) \
        .withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"),
                                                   lambda s, a: s + a["tokens"]))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds, unescaped."""
    split = F.split(formatted, r"<\|turn\|>")  # what stands before the first mark is empty
    pieces = F.slice(split, F.lit(2), F.size(split))

    def parse(p: Column) -> Column:
        role = F.substring_index(p, SAYS, 1)
        start = F.length(role) + len(SAYS)
        body = F.substring(p, start + 1, F.length(p) - start - len(OVER))
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))
    return F.transform(pieces, parse)


def under_mask(formatted: Column, spans: Column) -> Column:
    """What the loss mask covers, unescaped, in order and with nothing between."""
    cut = F.transform(spans, lambda s: F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
    return unescape(F.array_join(cut, ""))


def digests(formatted: DataFrame) -> DataFrame:
    """The contract's figures, all read back from the output: turns from ``formatted``, loss by ``loss_spans``."""
    t = formatted.select("*", read_turns(F.col("formatted")).alias("t"))
    whole = F.array_join(F.transform("t", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return (t.select("conv_id", F.size("t").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
                     under_mask(F.col("formatted"), F.col("loss_spans")).alias("loss"),
                     F.length("formatted").cast("long").alias("formatted_chars"),
                     F.size("attachments").cast("long").alias("n_attachments"), "expanded_tokens")
            .select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
                    F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars", "n_attachments", "expanded_tokens"))
