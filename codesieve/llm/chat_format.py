"""Chat formatting with Spark expressions only: sorted turn structs, merged neighbours, one concatenation.

A conversation's rows are collected as structs (turn, role, text), sorted, and folded into blocks: turns of one role
that follow each other share a block. A block is written as

    <|im_start|>role\\ntext<|im_next|>text<|im_end|>\\n

where <|im_next|> stands between merged turns, so that reading back gives the single turns again. Inside texts and roles
`\\` becomes `\\b` and `<|` becomes `<\\p`, in roles also a line feed `\\n`; so no text can hold a mark, and three plain
replacements undo it. `loss` lists the spans (start, length; code points of `formatted`) of the texts of assistants, one
per text, without marks.

A conversation of up to PART_TURNS rows is one row (part 0) after one shuffle. A longer one never meets in one task: its
rows are sorted by range over all tasks and delivered as parts of at most PART_TURNS turns, in the order of `part`. The
parts joined in that order are the text that the conversation has as one row: a block that is cut ends without its <|im_end|>, and
the next part begins with <|im_next|> and names the block's role in `open_role`. With that `read_back` parses any part; `digests`
puts the parts of a conversation together.

Nulls: a null text or role is empty; a null turn comes first; rows without conv_id are one conversation without id.
Rows of equal turn are ordered by role and text, and repeated rows are turns of their own. Empty and very long texts are
formatted whole. Other columns are left out, so their names cannot clash. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codesieve.llm.common import stored, whole

START, NEXT, END = "<|im_start|>", "<|im_next|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"
PART_BITS = 10
PART_TURNS = 1 << PART_BITS
BLOCKS = "array<struct<role string, texts array<string>>>"
WRITTEN = "struct<at int, loss array<struct<start int, length int>>>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<|"), F.lit("<\\p"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\p"), F.lit("|")), F.lit("\\b"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("\\n"), F.lit("\n")))


def _merged(turns: Column) -> Column:
    """Blocks of escaped role and texts: turns that follow one of their own role join its block."""

    def add(blocks: Column, turn: Column) -> Column:
        last = F.try_element_at(blocks, F.lit(-1))
        grown = F.struct(last["role"].alias("role"), F.concat(last["texts"], F.array(turn["text"])).alias("texts"))
        fresh = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
        joins = F.coalesce(last["role"] == turn["role"], F.lit(False))
        return F.when(joins, F.concat(F.slice(blocks, 1, F.size(blocks) - 1), F.array(grown))).otherwise(F.concat(blocks, F.array(fresh)))

    return F.aggregate(turns, F.array().cast(BLOCKS), add)


def _block(block: Column) -> Column:
    return F.concat(F.lit(START), block["role"], F.lit("\n"), F.array_join(block["texts"], NEXT), F.lit(END))


def _loss(blocks: Column) -> Column:
    """Spans of the assistants' texts, by folding the lengths of all that is written."""

    def write(state: Column, block: Column) -> Column:
        first = state["at"] + len(START) + 1 + F.length(block["role"])

        def text(inner: Column, t: Column) -> Column:
            span = F.struct(inner["at"].alias("start"), F.length(t).alias("length"))
            spans = F.when(block["role"] == LOSS_ROLE, F.concat(inner["loss"], F.array(span))).otherwise(inner["loss"])
            return F.struct((inner["at"] + F.length(t) + len(NEXT)).cast("int").alias("at"), spans.alias("loss"))

        done = F.aggregate(block["texts"], F.struct(first.cast("int").alias("at"), state["loss"].alias("loss")).cast(WRITTEN), text)
        return F.struct((done["at"] - len(NEXT) + len(END)).cast("int").alias("at"), done["loss"].alias("loss"))

    start = F.struct(F.lit(0).alias("at"), F.array().alias("loss")).cast(WRITTEN)
    return F.aggregate(blocks, start, write)["loss"]


def _formatted(rows: DataFrame, *key: str) -> DataFrame:
    """One row per key: its turns sorted, escaped, merged, written; key columns, formatted and loss."""
    sorted_ = rows.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    turns = F.transform("turns", lambda t: F.struct(escaped_role(t["role"]).alias("role"), escaped(t["text"]).alias("text")))
    blocks = sorted_.select(*key, _merged(turns).alias("blocks"))
    return blocks.select(*key, F.array_join(F.transform("blocks", _block), "").alias("formatted"), _loss(F.col("blocks")).alias("loss"))


def _joined(parts: DataFrame, numbered: DataFrame) -> DataFrame:
    """The parts with blocks that go on from part to part, by the roles at their edges."""
    edges = numbered.groupBy("conv_id", "part").agg(F.min_by("role", "id").alias("first"), F.max_by("role", "id").alias("last"))
    along = Window.partitionBy("conv_id").orderBy("part")
    edges = edges.select(
        F.col("conv_id").alias("_conv"), F.col("part").alias("_part"),
        F.when(F.lag("last").over(along) == F.col("first"), escaped_role(F.col("first"))).alias("open_role"),
        F.coalesce(F.lead("first").over(along) == F.col("last"), F.lit(False)).alias("_goes_on"),
    )
    rows = parts.join(edges, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")))
    text, opened = F.col("formatted"), F.col("open_role").isNotNull()
    head = len(START) + F.length("open_role") + 1
    end = F.length(text) - F.when(F.col("_goes_on"), len(END)).otherwise(0)
    written = F.when(opened, F.concat(F.lit(NEXT), F.substring(text, head + 1, end - head))).otherwise(F.substring(text, F.lit(1), end))
    shift = F.when(opened, len(NEXT) - head).otherwise(0)
    loss = F.transform("loss", lambda s: F.struct((s["start"] + shift).alias("start"), s["length"].alias("length")))
    return rows.select("conv_id", "part", written.alias("formatted"), loss.alias("loss"), "open_role")


def format_chats(rows: DataFrame, part_bits: int = PART_BITS) -> tuple[DataFrame, DataFrame | None]:
    """(whole conversations, parts of long ones or None): conv_id, part, formatted, loss; parts also open_role.

    rows has conv_id, turn, role and text. The parts of a long conversation follow each other by `part`, and joined give its whole text.
    """
    turns = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), whole(F.col("role")).alias("role"), whole(F.col("text")).alias("text"))
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n")).where(F.col("n") > (1 << part_bits))
    long_ = stored(sizes.select(F.col("conv_id").alias("long_id")))
    if long_.isEmpty():
        return _formatted(turns, "conv_id").withColumn("part", F.lit(0).cast("long")), None
    is_long = F.col("conv_id").eqNullSafe(F.col("long_id"))  # the size of the written ids decides how they are joined
    short = _formatted(turns.join(long_, is_long, "left_anti"), "conv_id").withColumn("part", F.lit(0).cast("long"))
    order = ["conv_id", "turn", "role", "text"]
    sorted_ = turns.join(long_, is_long, "left_semi").repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = stored(sorted_.withColumn("id", F.monotonically_increasing_id())).withColumn("part", F.shiftright("id", part_bits))
    return short, _joined(_formatted(numbered, "conv_id", "part"), numbered)


def read_back(formatted: Column, open_role: Column | None = None) -> Column:
    """array<struct<role, text>>: the turns of a formatted conversation or part, unescaped. `open_role` is that of the part."""
    role = F.lit("") if open_role is None else whole(open_role)
    begun = F.concat(F.lit(START), role, F.lit("\n"), F.substring(formatted, F.lit(len(NEXT) + 1), F.length(formatted)))
    formatted = F.when(F.startswith(formatted, F.lit(NEXT)), begun).otherwise(formatted)
    formatted = F.when(F.endswith(formatted, F.lit(END)), formatted).otherwise(F.concat(formatted, F.lit(END)))
    blocks = F.transform(F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 1 << 30), lambda b: F.substring(b, F.lit(1), F.length(b) - len(END)))

    def turns(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        texts = F.split(F.substring(block, F.length(role) + 2, F.length(block)), r"<\|im_next\|>")
        return F.transform(texts, lambda t: F.struct(unescaped_role(role).alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescaped(F.substring(formatted, s["start"] + 1, s["length"]))), "")


def digests(chats: DataFrame, parts: DataFrame | None) -> DataFrame:
    """Per conversation what is read back from its output, as counts and digests.

    Here a long conversation's text is put together in one value, since a digest is of all of it (up to 2 GB).
    """

    def read(rows: DataFrame) -> DataFrame:
        role = F.col("open_role") if "open_role" in rows.columns else None
        rows = rows.select("conv_id", "part", read_back(F.col("formatted"), role).alias("turns"), loss_text(F.col("formatted"), F.col("loss")).alias("lost"), F.length("formatted").cast("long").alias("n"))
        said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
        return rows.select("conv_id", "part", F.size("turns").cast("long").alias("n_turns"), said.alias("said"), "lost", "n")

    rows = read(chats)
    if parts is not None:
        one = read(parts).groupBy("conv_id").agg(
            F.sum("n_turns").alias("n_turns"), F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("part", "said", "lost"))).alias("every")
        )
        one = one.select("conv_id", F.lit(0).cast("long").alias("part"), "n_turns", *(F.array_join(F.col(f"every.{c}"), "").alias(c) for c in ("said", "lost")), "n")
        rows = rows.unionByName(one)
    return rows.select(
        "conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"),
        F.length("lost").cast("long").alias("loss_chars"), F.sha2("lost", 256).alias("loss_sha256"), F.col("n").alias("formatted_chars"),
    )
