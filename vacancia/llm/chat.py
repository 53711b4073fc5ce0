"""Chat formatting in budgeted windows, with a loss mask.

Running sums of turn tokens cut a conversation into spans of whole turns. Every window is the
conversation's system turn, then as many turns before the span as the history budget holds,
then the span itself. Repeated turns are masked: the loss covers each assistant text in the
window where it is new, so over all windows each is learned from once. Only window functions
and expressions run, over one shuffle by conversation; no row holds more than a window.

A turn is written ``### role: text</turn>`` and a new line. Inside texts and roles ``#``, ``<``
and the backslash (in roles ``:`` too) are written as a backslash and a letter, so a marker
can't occur in them, and ``read_turns`` undoes it.

Tokens are words plus ``TURN_TOKENS`` for the markers. A span takes turns while their sum
starts in the same half of the budget left by system turn and history, which keeps it within
the budget; a turn longer than that half is a window of its own and stays whole.

Defined cases: a null text or role is empty; turns with one number are ordered by role and
text; a null conversation id is one conversation; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 1024
HISTORY = 192
SYSTEM = 256  # of the budget kept for a system turn; a longer one is repeated all the same
TURN_TOKENS = 4

# Fixed template: the codes that stand for characters of the markers.
CODES = [("\\", "\\s"), ("#", "\\h"), ("<", "\\l")]
ROLE_CODES = [*CODES, (":", "\\c")]
END = "</turn>\n"


def escaped(text: Column, codes=CODES) -> Column:
    for plain, code in codes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column, codes=CODES) -> Column:
    for plain, code in reversed(codes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def rendered(turn: Column) -> Column:
    return F.concat(F.lit("### "), turn["role"], F.lit(": "), turn["text"], F.lit(END))


def chat_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, system: int = SYSTEM) -> DataFrame:
    """One row per window: its text, how many turns at its head are repeated, and the loss spans (code points)."""
    half = max(1, (budget - history - system) // 2)
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    df = turns.select(
        "conv_id", "turn", role.alias("plain_role"), text.alias("plain"),
        F.struct(escaped(role, ROLE_CODES).alias("role"), escaped(text).alias("text")).alias("t"),
        (F.size(F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")) + TURN_TOKENS).cast("bigint").alias("tokens"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "plain_role", "plain")
    df = df.withColumn("before", F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    df = df.withColumn("span", 2 * F.floor(F.col("before") / half) + (F.col("tokens") > half).cast("int"))
    by_sum = Window.partitionBy("conv_id").orderBy("before")
    first = F.first(F.struct("plain_role", "t")).over(by_sum.rowsBetween(Window.unboundedPreceding, 0))
    df = df.withColumn("first", first).withColumn("past", F.collect_list(F.struct("before", "t")).over(by_sum.rangeBetween(-history, -1)))
    in_span = Window.partitionBy("conv_id", "span").orderBy("before")
    size = F.length(rendered(F.col("t")))
    df = df.withColumn("at", F.coalesce(F.sum(size).over(in_span.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    windows = df.groupBy("conv_id", "span").agg(
        F.min_by("past", "before").alias("past"), F.first("first").alias("first"), F.min("before").alias("start"),
        F.array_sort(F.collect_list(F.struct("before", "at", "plain_role", "t"))).alias("new"), F.sum("tokens").alias("tokens"),
    )
    # the system turn is repeated unless the span or the history has it anyway
    past = F.array_sort("past")
    lacks = (F.col("first.plain_role") == "system") & (F.col("start") > 0) & F.coalesce(F.get(past, F.lit(0))["before"] > 0, F.lit(True))
    head = F.when(lacks, rendered(F.col("first.t"))).otherwise(F.lit(""))
    windows = windows.select(
        "conv_id", "span", "new", "tokens", (F.size("past") + lacks.cast("int")).alias("repeated"),
        F.concat(head, F.array_join(F.transform(past, lambda x: rendered(x["t"])), "")).alias("head"),
    )
    lead = F.length("head")
    loss = F.transform(
        F.filter("new", lambda x: x["plain_role"] == "assistant"),
        lambda x: F.struct(
            (lead + x["at"] + F.length(x["t"]["role"]) + 6).alias("start"),
            (lead + x["at"] + F.length(x["t"]["role"]) + 6 + F.length(x["t"]["text"])).alias("stop"),
        ),
    )
    body = F.array_join(F.transform("new", lambda x: rendered(x["t"])), "")
    return windows.select("conv_id", F.col("span").alias("window"), F.concat("head", body).alias("text"), "repeated", "tokens", loss.alias("loss"))


def read_turns(text: Column) -> Column:
    """The turns of a window's text, roles and texts as they were."""
    pieces = F.filter(F.split(text, "</turn>\n", -1), lambda x: x != "")
    body = F.transform(pieces, lambda x: F.substring(x, F.lit(5), F.length(x)))
    return F.transform(
        body,
        lambda x: F.struct(
            unescaped(F.substring_index(x, ":", 1), ROLE_CODES).alias("role"),
            unescaped(F.substring(x, F.length(F.substring_index(x, ":", 1)) + 3, F.length(x))).alias("text"),
        ),
    )


def loss_text(text: Column, loss: Column) -> Column:
    """What the mask covers, as it was: the texts of the spans, nothing between."""
    return F.array_join(F.transform(loss, lambda x: unescaped(F.substring(text, (x["start"] + 1).cast("int"), (x["stop"] - x["start"]).cast("int")))), "")


def window_digest(windows: DataFrame) -> DataFrame:
    """One row per conversation, read back from its windows."""
    turns = read_turns(F.col("text"))
    new = F.slice(turns, F.col("repeated") + 1, F.greatest(F.size(turns) - F.col("repeated"), F.lit(0)))
    read = windows.select(
        "conv_id", "window", F.length("text").cast("bigint").alias("chars"), new.alias("new"), loss_text(F.col("text"), F.col("loss")).alias("learned")
    )
    read = read.select(
        "conv_id", "window", "chars", "learned", F.size("new").cast("bigint").alias("n"),
        F.array_join(F.transform("new", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "").alias("said"),
    )
    whole = read.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("window", "said", "learned"))).alias("w"),
    )
    said, learned = F.array_join(F.col("w.said"), ""), F.array_join(F.col("w.learned"), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(said, 256).alias("turns_sha256"), F.length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"), "formatted_chars",
    )
