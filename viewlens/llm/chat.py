r"""Chat formatting with one training example per assistant turn (built-in functions only).

A turn becomes ``### role: text</turn>\n``. Inside texts and roles ``\``, ``<`` and ``#`` are written ``\b``, ``\l``
and ``\h`` (roles also ``:`` as ``\c`` and a line feed as ``\n``), so no control string can occur in them and the
original is read back exactly. The examples of a conversation are prefixes of its one formatted text: example k is
the text up to the end of its k-th assistant turn, of which only that reply is trainable. Between tasks prefixes are
lengths; their texts are cut out row by row where they are read, so no prefix is shuffled or held beside another.

Defined cases: null text or role is empty; a null conv_id is a conversation of its own; turns are ordered by turn
(null first), role, text, so ties and repeated rows have a fixed order and are all kept; a conversation without
assistant turns has no example and an empty loss; an empty table gives an empty result; other columns are ignored.
The digest of a conversation is one hash of all its turns, so its turns meet in one row by contract.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRAINED = "assistant"
END = "</turn>\n"
_TEXT = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))
_ROLE = (*_TEXT, (":", "\\c"), ("\n", "\\n"))


def escape(c: Column, pairs=_TEXT) -> Column:
    for raw, code in pairs:
        c = F.replace(c, F.lit(raw), F.lit(code))
    return c


def unescape(c: Column, pairs=_TEXT) -> Column:
    for raw, code in reversed(pairs):  # the backslash last
        c = F.replace(c, F.lit(code), F.lit(raw))
    return c


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos, trained, head, body, start, start_byte: each turn rendered, with its offset in the formatted text."""
    t = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    t = t.withColumns({"head": F.concat(F.lit("### "), escape(F.col("role"), _ROLE), F.lit(": ")), "body": escape(F.col("text"))})
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)

    def upto(length) -> Column:
        return F.coalesce(F.sum(length("head") + length("body") + F.lit(len(END))).over(before), F.lit(0))

    return t.select("conv_id", F.row_number().over(order).alias("pos"), (F.col("role") == TRAINED).alias("trained"), "head", "body",
                    upto(F.length).alias("start"), upto(F.octet_length).alias("start_byte"))


def formatted(rendered: DataFrame) -> DataFrame:
    """conv_id, formatted: the whole text of each conversation."""
    blocks = F.sort_array(F.collect_list(F.struct("pos", F.concat("head", "body", F.lit(END)).alias("block"))))
    return rendered.groupBy("conv_id").agg(F.array_join(F.transform(blocks, lambda x: x["block"]), "").alias("formatted"))


def prefix_targets(rendered: DataFrame) -> DataFrame:
    """conv_id, example, pos, prefix_end, target_start, target_end, mask_from, mask_to, target: a row per assistant turn.

    The example's text is formatted[0:prefix_end]; its loss mask is [target_start, target_end), or in bytes of UTF-8 [mask_from, mask_to).
    """
    order = Window.partitionBy("conv_id").orderBy("pos")
    return (rendered.filter("trained").withColumn("example", F.row_number().over(order) - 1)
            .select("conv_id", "example", "pos", *[c.alias(name) for name, c in _spans().items()], F.col("body").alias("target")))


def _spans() -> dict[str, Column]:
    """Where a trained turn's prefix ends and its reply lies: in characters, and for the mask in bytes too."""
    at, byte = F.col("start") + F.length("head"), F.col("start_byte") + F.octet_length("head")
    return {"prefix_end": at + F.length("body") + len(END), "target_start": at, "target_end": at + F.length("body"),
            "mask_from": byte, "mask_to": byte + F.octet_length("body")}


def example_texts(examples: DataFrame, texts: DataFrame) -> DataFrame:
    """The examples with their whole text cut out; writes every prefix, for training files."""
    texts = texts.withColumnRenamed("conv_id", "text_id")
    return (examples.join(texts, F.col("conv_id").eqNullSafe(F.col("text_id"))).drop("text_id")
            .withColumn("text", F.expr("substring(formatted, 1, prefix_end)")).drop("formatted"))


def read_turns(text: Column) -> Column:
    """The turns of a formatted text: array of (role, text)."""
    parts = F.slice(F.split(text, END, -1), F.lit(1), F.size(F.split(text, END, -1)) - 1)
    mark = ": "

    def turn(p: Column) -> Column:
        at = F.instr(p, mark)
        return F.struct(unescape(p.substr(F.lit(5), at - 5), _ROLE).alias("role"),
                        unescape(p.substr(at + len(mark), F.length(p))).alias("text"))
    return F.transform(parts, turn)


def formatted_examples(rendered: DataFrame) -> DataFrame:
    """conv_id, formatted, masks: each conversation's text, with the loss masks (byte spans of the text) of its examples in order.

    Turns are placed by conversation already, so this needs no shuffle of its own."""
    spans = _spans()
    blocks = F.sort_array(F.collect_list(F.struct("pos", F.concat("head", "body", F.lit(END)).alias("block"))))
    mask = F.when(F.col("trained"), F.struct("pos", spans["mask_from"].alias("mask_from"), spans["mask_to"].alias("mask_to")))
    return rendered.groupBy("conv_id").agg(F.array_join(F.transform(blocks, lambda x: x["block"]), "").alias("formatted"),
                                           F.sort_array(F.collect_list(mask)).alias("masks"))


def prefix_examples(whole: DataFrame, *carried: str) -> DataFrame:
    """``carried``, example, text, mask_from, mask_to: a row per loss mask of (formatted, masks), in their order from 0.

    The example's text is the prefix that ends with the masked turn; its loss mask is the byte span [mask_from, mask_to) of that text.
    A conversation without masks has one row, without example and text. Rows stay where their conversation is."""
    rows = whole.select(*carried, "formatted", F.posexplode_outer("masks").alias("example", "mask"))
    prefix = _bytes(F.col("formatted"), F.lit(0), F.col("mask.mask_to") + len(END))
    return rows.select(*carried, "example", prefix.alias("text"), "mask.mask_from", "mask.mask_to")


def _bytes(text: Column, start: Column, end: Column) -> Column:
    """The text's bytes [start, end)."""
    return F.substring(text.cast("binary"), (start + 1).cast("int"), (end - start).cast("int")).cast("string")


def reply() -> Column:
    """The original text under an example's loss mask: cut out of the example's text, unescaped."""
    return unescape(_bytes(F.col("text"), F.col("mask_from"), F.col("mask_to")))


def digests(conversations: DataFrame) -> DataFrame:
    """What is read back from the formatted texts and their examples: a row per conversation."""
    return digests_of(formatted_examples(turns(conversations)))


def digests_of(whole: DataFrame) -> DataFrame:
    """The digests of (conv_id, formatted, masks): turns from the formatted text, the loss from the prefix examples; only these columns are read."""
    whole = whole.withColumn("turns", read_turns(F.col("formatted")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    own = whole.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"), "formatted", "masks")
    per_conversation = ("conv_id", "n_turns", "turns_sha256", "formatted_chars")
    replies = F.sort_array(F.collect_list(F.when(F.col("example").isNotNull(), F.struct("example", reply().alias("reply")))))
    read = (prefix_examples(own, *per_conversation).groupBy(*per_conversation)
            .agg(F.array_join(F.transform(replies, lambda x: x["reply"]), "").alias("loss"), F.count("example").alias("n_examples")))
    return read.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
                       F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars", "n_examples")
