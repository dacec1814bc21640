"""Chat formatting by a grammar round trip, in DataFrame functions only.

Grammar of the output::

    conversation = turn*
    turn         = "<|im_start|>" role "\\n" content "<|im_end|>\\n"

``<|`` starts a marker and nothing else. The parser cuts at the markers and undoes
the escapes of role and content. A turn is rendered as it is, parsed again and
compared with its source; where the two differ, its content is escaped, after which
they are equal for every text: an escape puts one backslash between ``<`` and ``|``
(in front of those that stand there already), the parser takes one away.

Null roles and texts count as empty; turns are ordered by turn, role and text, so
repeated numbers have one order; repeated rows are turns of their own; a null
conv_id is a conversation of its own; an empty table gives no conversation; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

START, END = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """Roles end at a line break, so that is escaped too."""
    role = F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))
    return F.replace(role, F.lit("<"), F.lit("%3C"))


def unescape_role(role: Column) -> Column:
    role = F.replace(F.replace(role, F.lit("%3C"), F.lit("<")), F.lit("%0A"), F.lit("\n"))
    return F.replace(role, F.lit("%25"), F.lit("%"))


def _render(role: Column, content: Column) -> Column:
    return F.concat(F.lit(START), escape_role(role), F.lit("\n"), content, F.lit(END), F.lit("\n"))


def parse(formatted: Column) -> Column:
    """Array of (role, text) of a formatted conversation; null where it breaks the grammar."""
    pieces = F.split(formatted, r"<\|im_end\|>")
    bodies = F.slice(pieces, 1, F.size(pieces) - 1)
    opening = lambda i: F.when(i == 0, F.lit(START)).otherwise(F.lit("\n" + START))
    markers = lambda x: (F.length(x) - F.length(F.replace(x, F.lit("<|"), F.lit("")))) / 2
    fits = F.forall(
        F.transform(bodies, lambda b, i: b.startswith(opening(i)) & (markers(b) == 1) & (F.instr(F.ltrim(b), "\n") > 0)),
        lambda ok: ok,
    ) & F.element_at(pieces, -1).isin("", "\n")

    def turn(body: Column, i: Column) -> Column:
        rest = F.substring(body, F.length(opening(i)) + 1, F.length(body))
        role = F.substring_index(rest, "\n", 1)
        return F.struct(
            unescape_role(role).alias("role"),
            unescape(F.substring(rest, F.length(role) + 2, F.length(rest))).alias("text"),
        )

    return F.when(fits, F.transform(bodies, turn))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_mask (spans in code points
    of the assistant's contents), n_escaped, identical (the parsed turns equal the
    source)."""
    w = Window.partitionBy("conv_id").orderBy("place")
    turns = (
        conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("place", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")))
        .withColumn("source", F.struct("role", "text"))
        .withColumn("plain", F.equal_null(parse(_render(F.col("role"), F.col("text"))), F.array("source")))
        .withColumn("content", F.when(F.col("plain"), F.col("text")).otherwise(escape(F.col("text"))))
        .withColumn("shown", _render(F.col("role"), F.col("content")))
        .withColumn("at", F.coalesce(F.sum(F.length("shown")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("from", F.col("at") + F.length(F.lit(START)) + F.length(escape_role(F.col("role"))) + 1)
    )
    whole = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("place", "shown", "source", "from", F.length("content").alias("length")))).alias("turns"),
        F.sum(F.when(F.col("plain"), 0).otherwise(1)).cast("bigint").alias("n_escaped"),
    )
    learned = F.filter("turns", lambda t: t["source"]["role"] == LEARNED_ROLE)
    return whole.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["shown"]), "").alias("formatted"),
        F.transform(learned, lambda t: F.struct(t["from"].alias("start"), t["length"].cast("bigint").alias("length"))).alias("loss_mask"),
        "n_escaped",
        F.transform("turns", lambda t: t["source"]).alias("source"),
    ).withColumn("identical", F.coalesce(parse(F.col("formatted")) == F.col("source"), F.lit(False))).drop("source")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the output holds: the parsed turns and the text under the mask."""
    spans = F.transform("loss_mask", lambda s: unescape(F.substring(F.col("formatted"), s["start"].cast("int") + 1, s["length"].cast("int"))))
    return (
        formatted.withColumn("turns", parse(F.col("formatted")))
        .withColumn("learned", F.array_join(spans, ""))
        .select(
            "conv_id",
            F.size("turns").cast("bigint").alias("n_turns"),
            F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
            F.length("learned").cast("bigint").alias("loss_chars"),
            F.sha2("learned", 256).alias("loss_sha256"),
            F.length("formatted").cast("bigint").alias("formatted_chars"),
            "n_escaped",
            "identical",
        )
    )
