"""Chat formatting: one training example per assistant turn, with all turns before it as context.

Each turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n``. A control string inside a text gets
one backslash after its first character (one more if it has some already), and losing one
backslash restores it, so escaping is reversible and leaves all other text alone.

``expand`` gives one row per assistant turn. Its context would repeat all earlier turns, which
for one long conversation is its length squared; so a row holds only what it adds to the
example before (``delta``) and how many characters of earlier deltas stand before it
(``context_chars``). ``materialise`` writes each example out with its whole context, and ``read_back`` reads
the examples so written. Turns after the
last assistant turn form a last row without a target, so that nothing of a conversation is lost.

Order: by turn, then role, then text; null turns come first. A null role counts as empty, so
does a null text. Repeated rows are repeated turns. A null ``conv_id`` is a conversation of its own.
Other columns are not used. Only built-in functions run here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordertide.llm.common import durable

START, END = "<|im_start|>", "<|im_end|>\n"
#: Control strings of this and of other common templates, without their first character.
REST = r"((?:\|im_start\||\|im_end\||\|endoftext\||/?s)>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + REST, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + REST, "$1$2$3")


def escape_role(role: Column) -> Column:
    """As a text, and on one line."""
    return F.replace(F.replace(escape(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    # A doubled backslash is set aside as a character that the line break can't be part of.
    parts = F.split(role, r"\\\\", -1)
    return unescape(F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\"))


def expand(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, example, n_context_turns, context_chars, delta, target_start, target_chars).

    ``target_start`` counts the characters of ``delta`` before the reply, ``target_chars`` the
    reply's; both are null in a last row without a target.
    """
    filled = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    marked = filled.withColumns({
        "head": F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")), "body": escape(F.col("text")),
    })
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("head") + F.length("body") + len(END)
    reply = F.col("role") == "assistant"
    placed = marked.select(
        "conv_id", F.row_number().over(order).alias("at"), "head", "body", reply.alias("reply"),
        # A turn belongs to the next assistant turn, or to the rest behind the last.
        F.coalesce(F.count_if(reply).over(before), F.lit(0)).cast("int").alias("example"),
        F.coalesce(F.sum(size).over(before), F.lit(0)).cast("long").alias("earlier"),
    )
    grouped = placed.groupBy("conv_id", "example").agg(
        F.array_sort(F.collect_list(F.struct("at", "head", "body"))).alias("own"),
        F.bool_or("reply").alias("has_target"), F.min("earlier").alias("context_chars"), F.max("at").alias("last_at"),
    )
    last = F.element_at("own", -1)
    delta = F.array_join(F.transform("own", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    return grouped.select(
        "conv_id", "example", (F.col("last_at") - F.col("has_target").cast("int")).alias("n_context_turns"), "context_chars",
        delta.alias("delta"),
        F.when(F.col("has_target"), F.length(delta) - F.length(last["body"]) - len(END)).alias("target_start"),
        F.when(F.col("has_target"), F.length(last["body"])).alias("target_chars"),
    )


def materialise(examples: DataFrame) -> DataFrame:
    """Examples with their whole context written out: (conv_id, example, context, target), then the example's
    pointers (``target_start``, ``context_chars``, ``n_context_turns``) and whether it is its conversation's ``last``.

    Each example meets the deltas of the examples before it by a join, so no row holds more than one
    example; the text written out grows as the square of a conversation's length, as contexts do.
    """
    last = F.col("example") == F.max("example").over(Window.partitionBy("conv_id"))
    targets = examples.where("target_start is not null").select(
        "conv_id", "example", F.col("delta").alias("_own"), "target_start", "target_chars", "context_chars", "n_context_turns",
        last.alias("last"),
    )
    deltas = examples.select(F.col("conv_id").alias("_conv"), F.col("example").alias("_at"), F.col("delta").alias("_delta"))
    met = targets.join(deltas, targets["conv_id"].eqNullSafe(deltas["_conv"]) & (F.col("_at") < F.col("example")), "left")
    keys = ["conv_id", "example", "_own", "target_start", "target_chars", "context_chars", "n_context_turns", "last"]
    grouped = met.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.when(F.col("_at").isNotNull(), F.struct("_at", "_delta")))).alias("_all")
    )
    earlier = F.array_join(F.transform("_all", lambda d: d["_delta"]), "")
    d = F.col("_own")
    return grouped.select(
        "conv_id", "example",
        F.concat(earlier, F.substring(d, F.lit(1), F.col("target_start"))).alias("context"),
        F.substring(d, F.col("target_start") + 1, F.col("target_chars")).alias("target"),
        "target_start", "context_chars", "n_context_turns", "last",
    )


def read_back(examples: DataFrame) -> DataFrame:
    """What the formatted examples of each conversation say: its turns and the text under the loss mask.

    Examples are read as written out by ``materialise``, each with its whole context. A reply is read only behind
    a whole context: one of as many characters as its example points to, and of as many turns. The turns are read
    from the last example and the turns after its reply; of the other examples only replies go on.
    """
    examples = durable(examples)
    full = materialise(examples)
    ends = F.size(F.split("context", r"<\|im_end\|>\n", -1)) - 1
    whole = (F.length("context") == F.col("context_chars") + F.col("target_start")) & (ends == F.col("n_context_turns"))
    checked = full.select(
        "conv_id", "example", F.when(whole, unescape(F.col("target"))).otherwise(F.lit("")).alias("target"),
        F.when(F.col("last"), F.concat("context", "target", F.lit(END))).alias("_said"),
    )
    read = checked.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("example", "target"))).alias("e"), F.max("_said").alias("_said"),
    )
    rest = examples.where("target_start is null").select(F.col("conv_id").alias("_conv"), F.col("delta").alias("_rest"))
    joined = read.join(rest, read["conv_id"].eqNullSafe(rest["_conv"]), "full").select(
        F.when(F.col("e").isNotNull(), F.col("conv_id")).otherwise(F.col("_conv")).alias("conv_id"),
        F.concat(F.coalesce("_said", F.lit("")), F.coalesce("_rest", F.lit(""))).alias("formatted"),
        F.coalesce(F.array_join(F.transform("e", lambda x: x["target"]), ""), F.lit("")).alias("loss"),
    )
    parts = F.slice(F.split("formatted", r"<\|im_end\|>\n", -1), 1, F.size(F.split("formatted", r"<\|im_end\|>\n", -1)) - 1)

    def read(part: Column) -> Column:
        line = F.substring_index(part, "\n", 1)
        role = F.substring(line, F.lit(len(START) + 1), F.length(line))
        return F.struct(unescape_role(role).alias("role"), unescape(F.substring(part, F.length(line) + 2, F.length(part))).alias("text"))

    return joined.select("conv_id", F.transform(parts, read).alias("turns"), "loss", "formatted")


def digest(examples: DataFrame) -> DataFrame:
    """One row per conversation: counts and digests of what ``read_back`` finds."""
    back = read_back(examples)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
