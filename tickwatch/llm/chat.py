"""Chat formatting (operator 11): conversations as training texts with a loss mask, in DataFrame functions only.

A conversation's turns are collected as structs and sorted, adjacent turns of one role are merged
into one block, and the blocks are concatenated:

    <|im_start|>role\\ntext<|im_sep|>text of the next turn of that role<|im_end|>\\n

Texts can't forge the marks: between ``<`` and ``|`` (with any number of ``\\`` between them already)
one more ``\\`` is put in, so a formatted text holds ``<|`` only where a mark begins, and taking one
``\\`` away gives the text back.  In roles ``%`` and line feeds are written ``%25`` and ``%0A`` as well.

``format_chats`` gives per conversation ``formatted``, ``loss`` (a flag for each turn, in order: is its
text learnt?) and ``loss_spans`` (the code points of those texts in ``formatted``, end exclusive).
``read_chats`` gets the turns and the text under the mask back from these columns alone.

Defined results: a null role or text is empty; turns are ordered by turn, null first, ties by role, then
text; equal rows are turns of their own; rows without a conversation's id form one conversation, whose
id is null; a conversation without rows doesn't exist, so an empty table gives no rows; columns other
than those named are ignored.  A conversation becomes one string, so it has to fit one value (2 GB);
all steps on it are linear in its turns and characters but for the running totals of lengths, which
copy a block of 512 numbers a turn.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Marks of the template.
START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
HEAD_END, TAIL = "\n", "\n"
#: Turns whose running totals are formed at once.
STEP = 512


@dataclass(frozen=True)
class ChatParams:
    """Names of the input columns, and the roles whose texts are learnt."""

    conv_id: str = "conv_id"
    turn: str = "turn"
    role: str = "role"
    text: str = "text"
    loss_roles: tuple[str, ...] = ("assistant",)


def escaped(text: Column) -> Column:
    """The text with one more backslash between each ``<`` and ``|`` that would begin a mark."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def running_totals(lengths: str) -> Column:
    """0, l1, l1 + l2, ... of an array column of longs: one element more than the column has.

    The totals are formed in blocks, as an accumulator array is copied at each of its elements."""
    def summed(xs: Column) -> Column:
        return F.aggregate(xs, F.array(F.lit(0).cast("long")),
                           lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    pieces = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(lengths) - 1).cast("int"), F.lit(STEP)),
                         lambda at: summed(F.slice(lengths, at + 1, F.lit(STEP))))
    bases = summed(F.transform(pieces, lambda p: F.element_at(p, -1)))
    shifted = F.zip_with(pieces, F.slice(bases, F.lit(1), F.size(bases) - 1), lambda p, base: F.transform(p, lambda x: x + base))
    # each piece begins with the total at which the one before ends
    rest = F.flatten(F.transform(shifted, lambda p: F.slice(p, F.lit(2), F.size(p) - 1)))
    return F.concat(F.array(F.lit(0).cast("long")), rest)


def collected(chats: DataFrame, p: ChatParams) -> DataFrame:
    """conv_id and its sorted ``turns`` (turn, role, text)."""
    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    turn = F.struct(F.col(p.turn).alias("turn"), filled(p.role).alias("role"), filled(p.text).alias("text"))
    rows = chats.select(F.col(p.conv_id).alias("conv_id"), turn.alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def merged(conversations: DataFrame) -> DataFrame:
    """Adds ``blocks``: role and texts of each longest run of turns of one role."""
    n = F.size("turns")
    role_before = F.concat(F.array(F.lit(None).cast("string")), F.slice(F.transform("turns", lambda t: t["role"]), F.lit(1), n - 1))
    opens = F.zip_with("turns", role_before, lambda t, before: ~t["role"].eqNullSafe(before))
    first = conversations.withColumn("firsts", F.filter(
        F.transform(opens, lambda is_first, i: F.when(is_first, i + 1)), lambda i: i.isNotNull()))
    ends = F.concat(F.slice("firsts", F.lit(2), F.size("firsts") - 1), F.array(n + 1))
    runs = first.withColumn("runs", F.zip_with("firsts", ends, lambda a, b: F.struct(a.alias("first"), (b - a).alias("n"))))
    return runs.withColumn("blocks", F.transform("runs", lambda r: F.struct(
        F.element_at("turns", r["first"])["role"].alias("role"),
        F.transform(F.slice("turns", r["first"], r["n"]), lambda t: t["text"]).alias("texts")))).drop("firsts", "runs")


def format_chats(chats: DataFrame, p: ChatParams = ChatParams()) -> DataFrame:
    """conv_id, formatted, loss, loss_spans of every conversation (see the module)."""
    def written_block(b: Column) -> Column:
        return F.concat(F.lit(START), escaped_role(b["role"]), F.lit(HEAD_END),
                        F.array_join(F.transform(b["texts"], escaped), SEPARATOR), F.lit(END + TAIL))

    def span_lengths(b: Column) -> Column:
        """Per turn of a block: the code points before its text (marks and the like), and its text's."""
        head = F.length(escaped_role(b["role"])) + F.lit(len(START) + len(HEAD_END))
        return F.transform(b["texts"], lambda text, i: F.struct(
            F.when(i == 0, head).otherwise(F.lit(len(SEPARATOR))).cast("long").alias("gap"),
            F.length(escaped(text)).cast("long").alias("chars"),
            F.when(i == F.size(b["texts"]) - 1, F.lit(len(END + TAIL))).otherwise(F.lit(0)).cast("long").alias("tail"),
            b["role"].isin(*p.loss_roles).alias("loss")))

    blocks = merged(collected(chats, p))
    out = blocks.select("conv_id", F.array_join(F.transform("blocks", written_block), "").alias("formatted"),
                        F.flatten(F.transform("blocks", span_lengths)).alias("parts"))
    out = out.withColumn("lengths", F.transform("parts", lambda x: x["gap"] + x["chars"] + x["tail"]))
    out = out.withColumn("begins", running_totals("lengths"))
    spans = F.zip_with("parts", F.slice("begins", F.lit(1), F.size("parts")), lambda x, at: F.struct(
        x["loss"].alias("loss"), (at + x["gap"]).alias("start"), (at + x["gap"] + x["chars"]).alias("end")))
    return out.select("conv_id", "formatted", F.transform("parts", lambda x: x["loss"]).alias("loss"),
                      F.transform(F.filter(spans, lambda s: s["loss"]), lambda s: s.dropFields("loss")).alias("loss_spans"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """``turns`` (role, text) and ``loss_text`` (the texts under the mask) read from formatted and loss.

    Columns other than formatted, loss and loss_spans are passed on."""
    def quoted(mark: str) -> str:
        return mark.replace("|", r"\|")

    # what stands before the first mark is empty; a block ends with the end mark, which splits off its tail
    blocks = F.slice(F.split("formatted", quoted(START), -1), F.lit(2), F.size(F.split("formatted", quoted(START), -1)) - 1)

    def turns_of(block: Column) -> Column:
        head = F.substring_index(block, HEAD_END, 1)
        body = F.substring(block, F.length(head) + 2, F.length(block) - F.length(head) - F.lit(1 + len(END + TAIL)))
        return F.transform(F.split(body, quoted(SEPARATOR), -1),
                           lambda text: F.struct(unescaped_role(head).alias("role"), unescaped(text).alias("text")))

    kept = [c for c in formatted.columns if c not in ("formatted", "loss", "loss_spans", "turns", "loss_text")]
    turns = formatted.select(*kept, "loss", F.flatten(F.transform(blocks, turns_of)).alias("turns"))
    learnt = F.filter(F.zip_with("turns", "loss", lambda t, on: F.when(on, t["text"])), lambda t: t.isNotNull())
    return turns.select(*kept, "turns", F.array_join(learnt, "").alias("loss_text"))
