"""Chat formatting in budgeted windows.

Turns become segments of one line format; prefix sums of their token counts place every turn in
a cell of ``stride`` tokens. The turns that lie inside a cell form a window; a turn that crosses
a cell's end has a window of its own, so no window's new turns pass the stride unless a single
turn does. Each later window begins with the retained system turn and with as many earlier
turns as fit ``history`` tokens. Only new assistant turns are targets: repeated ones are masked.

Everything is DataFrame operations. All turns are sorted into ranges of even size; the turns that
a conversation has in a range are a block. Prefix sums add up blocks first and then the turns of
a block, and cells spread a conversation after that, so no task ever holds a whole conversation,
whatever its turn numbers are.

Defined results: null texts and roles are empty, a null turn sorts first, a null conversation
is a conversation like others; equal turns are ordered by the first ``HEAD`` code points of role
and text and then by a hash of both, repeated rows are repeated turns; other columns are ignored,
whatever their names; an empty table has no windows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from wirecount.llm.common import stored, text_of

# The control strings of common chat templates.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>",
           "<|im_sep|>", "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>")
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
#: Code points of role and text that order equal turns: bounds of ranges pass the driver.
HEAD = 128


@dataclass(frozen=True)
class Budget:
    """Tokens of a window, of the turns repeated in it, and the least left for new turns."""

    window: int = 2048
    history: int = 512
    least: int = 256


def _quoted(literal: str) -> str:
    return "".join("\\" + c if not c.isalnum() and c != "_" else c for c in literal)


def _alternatives() -> str:
    return "|".join(_quoted(c[1:]) for c in sorted(CONTROL, key=len, reverse=True))


def escape(text: Column) -> Column:
    """Put a backslash behind the first sign of every control string, however many it has."""
    return F.regexp_replace(text, rf"([<\[])(\\*)({_alternatives()})", r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)\\({_alternatives()})", "$1$2$3")


def token_count(text: Column) -> Column:
    """Words and single signs of a text."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]"))


def segment(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), escape(role), F.lit(SEP), escape(text), F.lit(END))


def placed_turns(turns: DataFrame, budget: Budget) -> DataFrame:
    """Turns with the tokens before (``a``) and up to (``b``) each, and the cell they are in."""
    rows = turns.select(
        F.col("conv_id").alias("conv"), F.col("turn").alias("at"),
        text_of("role").alias("role"), text_of("text").alias("text"))
    # A turn has at least the tokens of its marks, so no two begin at the same place.
    rows = rows.withColumn("piece", segment(F.col("role"), F.col("text")))
    rows = rows.withColumn("tokens", token_count(F.col("piece")).cast("long"))
    # No two rows are equal in this order, so any number of equal turns can be split. The number
    # of a row and its range must not change when they are read again: they are written.
    order = ["at", "role_head", "text_head", "hash", "nth"]
    rows = (
        rows.withColumn("role_head", F.substr("role", F.lit(1), F.lit(HEAD)))
        .withColumn("text_head", F.substr("text", F.lit(1), F.lit(HEAD)))
        .withColumn("hash", F.xxhash64("role", "text"))
        .withColumn("nth", F.monotonically_increasing_id()))
    rows = stored(rows.repartitionByRange("conv", *order).withColumn(
        "block", F.spark_partition_id()))
    sums = rows.groupBy("conv", "block").agg(
        F.sum("tokens").alias("sum"),
        F.min(F.when(F.col("role") == "system", F.struct(*order, "tokens"))).alias("sys"))
    over = Window.partitionBy("conv")
    running = over.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("conv").alias("conv_"), F.col("block").alias("block_"),
        F.coalesce(F.sum("sum").over(running), F.lit(0)).alias("offset"),
        F.min("sys").over(over).alias("sys"))
    here = Window.partitionBy("conv", "block").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0)
    placed = (
        rows.join(sums, rows["conv"].eqNullSafe(sums["conv_"])
                  & (rows["block"] == sums["block_"]))
        .withColumn("b", F.col("offset") + F.sum("tokens").over(here))
        .withColumn("a", F.col("b") - F.col("tokens"))
        .withColumn("stride", F.greatest(
            F.lit(budget.least).cast("long"),
            budget.window - budget.history - F.coalesce("sys.tokens", F.lit(0)))))
    return placed.select(
        "conv", "role", "text", "piece", "a", "b", "tokens", "stride",
        F.coalesce(F.col("nth") == F.col("sys.nth"), F.lit(False)).alias("retained"),
        F.floor(F.col("a") / F.col("stride")).alias("cell"),
        (F.floor((F.col("b") - 1) / F.col("stride"))
         != F.floor(F.col("a") / F.col("stride"))).alias("alone"))


def windows(turns: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """One row per window of each conversation.

    ``conv_id``; ``start``: tokens of the conversation before the window's first new turn,
    which orders the windows; ``repeats``: segments at the head that other windows hold as new;
    ``text``; ``tokens``; ``targets``: place and length in ``text``, in code points and from 0,
    of the escaped text of each new assistant turn.
    """
    # Turns take part as new ones, as history and as system turns: they are placed once.
    placed = stored(placed_turns(turns, budget))
    found = placed.groupBy("conv", "cell", "alone").agg(
        F.min("a").alias("start"), F.min("stride").alias("stride"))
    named = found.select(*(F.col(c).alias(f"{c}_") for c in found.columns))
    role, text = F.col("role"), F.col("text")
    part = [
        "piece", "tokens",
        F.length(F.concat(F.lit(START), escape(role), F.lit(SEP))).alias("lead"),
        F.length(escape(text)).alias("body"),
    ]
    new = placed.select(
        "conv", "cell", "alone", F.lit(2).alias("part"), "a", *part,
        (role == "assistant").alias("target"))

    def repeated(number, rows, condition):
        joined = rows.join(named, rows["conv"].eqNullSafe(named["conv_"]) & condition)
        return joined.select(
            F.col("conv"), F.col("cell_").alias("cell"), F.col("alone_").alias("alone"),
            F.lit(number).alias("part"), "a", *part, F.lit(False).alias("target"))

    system = repeated(0, placed.where("retained"), F.col("start_") > F.col("a"))
    reach = F.col("a") + budget.history
    # A turn reaches into two cells at most, as the history is no longer than a stride.
    near = placed.where(~F.col("retained") & (F.col("b") <= reach)).withColumn(
        "met", F.explode(F.sequence(F.floor(F.col("b") / F.col("stride")),
                                    F.floor(reach / F.col("stride")))))
    history = repeated(1, near, (F.col("met") == F.col("cell_"))
                       & F.col("start_").between(F.col("b"), reach))
    gathered = (
        new.unionByName(system).unionByName(history)
        .groupBy("conv", "cell", "alone")
        .agg(F.sort_array(F.collect_list(F.struct(
            "part", "a", "piece", "tokens", "lead", "body", "target"))).alias("p")))
    ends = F.aggregate(
        "p", F.expr("named_struct('at', 0, 'targets', "
                    "cast(array() as array<struct<start: int, length: int>>))"),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["piece"])).alias("at"),
            F.when(x["target"], F.concat(acc["targets"], F.array(F.struct(
                (acc["at"] + x["lead"]).alias("start"), x["body"].alias("length")))))
            .otherwise(acc["targets"]).alias("targets")),
        lambda acc: acc["targets"])
    return gathered.select(
        F.col("conv").alias("conv_id"),
        F.array_min(F.transform(F.filter("p", lambda x: x["part"] == 2), lambda x: x["a"]))
        .alias("start"),
        F.size(F.filter("p", lambda x: x["part"] < 2)).alias("repeats"),
        F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("text"),
        F.aggregate("p", F.lit(0).cast("long"), lambda n, x: n + x["tokens"]).alias("tokens"),
        ends.alias("targets"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Windows with what their texts hold: ``turns`` (role and text of the new turns, in order)
    and ``learned`` (text under the loss mask), both without escapes."""
    pieces = F.split("text", _quoted(END.rstrip("\n")) + "\\n")
    new = F.slice(pieces, F.col("repeats") + 1, F.size(pieces) - 1 - F.col("repeats"))

    def turn(piece):
        halves = F.split(F.substr(piece, F.lit(len(START) + 1)), _quoted(SEP))
        return F.struct(unescape(halves[0]).alias("role"), unescape(halves[1]).alias("text"))

    return formatted.select(
        "*", F.transform(new, turn).alias("turns"),
        F.transform("targets", lambda t: unescape(
            F.substr("text", t["start"] + 1, t["length"]))).alias("learned"))
