"""Chat transcripts as budgeted training windows, with DataFrame functions only.

Template: a window is a sequence of turns, each ``<|turn|>role`` LF text ``<|end|>`` LF. Inside roles and texts each
``<|`` becomes ``<|\\|`` and each backslash run after such a ``<|`` grows by one, so a marker can only stand where the
template put it, and reading back takes one backslash away. A line feed in a role is ``<|line|>``.

Sizes are in tokens by a documented estimate. Running sums of them, made in two levels so that no conversation's rows
meet in one task, cut each conversation into turn-aligned windows: the sum is divided by the budget, turns that lie
inside one multiple form a window, a turn that crosses a multiple is a window of its own. So a window's new turns hold
at most the budget, or are one turn. Each window begins with the conversation's opening system turns before it, the
first one and what fits ``retained`` beside it, then repeats the latest turns before it that fit ``history``; only new assistant turns are under the loss mask, so each is a target once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indexloom.sources.store import written

BUDGET, HISTORY, STRIDE = 512, 128, 256
TURN, END, LINE = "<|turn|>", "<|end|>\n", "<|line|>"


def escaped(text: Column) -> Column:
    """A text in which no marker can be read: every ``<|`` gets a backslash, or one more."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def tokens(text: Column) -> Column:
    """The size of a turn: a token for each four bytes begun, and four for its frame."""
    return (4 + F.ceil(F.octet_length(text) / 4)).cast("long")


def numbered(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns with ``before``, the tokens of all turns before them in their conversation, and ``place``, their number.

    Turns are in order of ``turn`` (nulls first), then role, then text. Sums are made by (conversation, stride of turn
    numbers) and then inside each, so a long conversation is spread over many tasks.
    """
    own = turns.select(F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    own = own.withColumn("tokens", tokens(F.col("text"))).withColumn("stride", F.floor(F.col("turn") / STRIDE))
    sums = own.groupBy("conv_id", "stride").agg(F.sum("tokens").alias("s"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy(F.col("stride").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("conv_id").alias("c"), F.col("stride").alias("b"), F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("s"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n"))
    joined = own.join(sums, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("stride").eqNullSafe(F.col("b")))
    inside = Window.partitionBy("conv_id", "stride").orderBy(F.col("turn").asc_nulls_first(), "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("s") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))
    place = F.col("n") + F.coalesce(F.count("tokens").over(inside), F.lit(0))
    return joined.select("conv_id", "turn", "role", "text", "tokens", before.alias("before"), place.alias("place"))


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, retained: int | None = None, **columns) -> DataFrame:
    """(conv_id, window, formatted, n_repeated, loss): one row per window.

    ``formatted`` is the text to train on, ``n_repeated`` how many of its turns stand in an earlier window already,
    ``loss`` the spans [start, end) in code points of ``formatted`` that are targets. ``window`` orders the windows of
    a conversation. New turns hold at most ``budget`` tokens or are one turn, repeated ones ``history`` tokens, and the
    opening system turns ``retained`` tokens (half the budget if not given) or are the first one. Null texts and roles are empty; a null conversation is one more; repeated turns are all kept. An
    empty table gives no rows. Other columns are left out.
    """
    if not 0 < history <= budget:
        raise ValueError("history must be positive and at most the budget")
    rows = numbered(turns, **columns)
    cell = F.floor(F.col("before") / budget)
    crosses = (F.floor((F.col("before") + F.col("tokens") - 1) / budget) > cell).cast("long")
    rows = written(rows.withColumn("window", cell * 2 + crosses), "turns")
    starts = rows.groupBy("conv_id", "window").agg(F.min("before").alias("start"), F.min("place").alias("first"))
    starts = written(starts, "window-starts")
    # The system turns before a conversation's first other turn open it; each later window retains the first, and the
    # next ones as far as they fit. The rest are history.
    others = rows.filter(F.col("role") != "system").groupBy("conv_id").agg(F.min("place").alias("stop")).withColumnRenamed("conv_id", "o")
    system = rows.filter(F.col("role") == "system").join(others, F.col("conv_id").eqNullSafe(F.col("o")), "left").drop("o")
    fits = (F.col("place") == 0) | (F.col("before") + F.col("tokens") <= (budget // 2 if retained is None else retained))
    opens = (F.col("stop").isNull() | (F.col("place") < F.col("stop"))) & fits
    spoken = rows.filter(F.col("role") != "system").unionByName(system.filter(~opens).drop("stop"))
    # A turn is history of the windows that start at most ``history`` tokens after it began; those lie in its own and the next cells.
    near = F.explode(F.sequence(F.col("window") + 1, F.col("window") + 2 * (history // budget + 2) + 1))
    past = spoken.filter(F.col("tokens") <= history).withColumn("w", near).alias("t").join(starts.alias("s"), F.col("t.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.col("w") == F.col("s.window")))
    past = past.filter((F.col("place") < F.col("first")) & (F.col("start") - F.col("before") <= history)).select("t.conv_id", F.col("s.window").alias("window"), "place", "role", "text", F.lit(True).alias("old"))
    system = system.filter(opens).select(F.col("conv_id").alias("c"), F.col("window").alias("of"), "place", "role", "text")
    retained = starts.join(system, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("window") > F.col("of"))).select("conv_id", "window", "place", "role", "text", F.lit(True).alias("old"))
    new = rows.select("conv_id", "window", "place", "role", "text", F.lit(False).alias("old"))
    every = new.unionByName(past).unionByName(retained)
    head = F.concat(F.lit(TURN), F.replace(escaped(F.col("role")), F.lit("\n"), F.lit(LINE)), F.lit("\n"))
    body = escaped(F.col("text"))
    pieces = every.select("conv_id", "window", F.struct("place", F.concat(head, body, F.lit(END)).alias("piece"), F.length(head).alias("lead"), F.length(body).alias("size"), (~F.col("old") & (F.col("role") == "assistant")).alias("target"), "old").alias("p"))
    # A window's turns are bounded by the budget, for each costs four tokens at least.
    grouped = pieces.groupBy("conv_id", "window").agg(F.sort_array(F.collect_list("p")).alias("ps"))
    total = lambda i: F.aggregate(F.slice("ps", 1, i), F.lit(0), lambda a, p: a + F.length(p["piece"]))
    spans = F.transform("ps", lambda p, i: F.struct((total(i) + p["lead"]).alias("start"), (total(i) + p["lead"] + p["size"]).alias("end"), p["target"].alias("target")))
    loss = F.transform(F.filter(spans, lambda s: s["target"]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    repeated = F.size(F.filter("ps", lambda p: p["old"]))
    return grouped.select("conv_id", "window", F.array_join(F.transform("ps", lambda p: p["piece"]), "").alias("formatted"), repeated.alias("n_repeated"), loss.alias("loss"))


def read_turns(formatted: DataFrame) -> DataFrame:
    """(conv_id, window, turns, targets) of each window, from its text alone: its new turns and the texts under the mask.

    ``turns`` are (role, text) without the repeated ones, ``targets`` the unescaped texts, both in order.
    """
    parts = F.filter(F.split("formatted", r"<\|turn\|>"), lambda x: x != "")
    parts = F.slice(parts, F.col("n_repeated") + 1, F.greatest(F.lit(1), F.size(parts)))
    role = lambda x: unescaped(F.replace(F.substring_index(x, "\n", 1), F.lit(LINE), F.lit("\n")))
    text = lambda x: unescaped(F.substring(x, F.instr(x, F.lit("\n")) + 1, F.length(x) - F.instr(x, F.lit("\n")) - len(END)))
    turns = F.transform(parts, lambda x: F.struct(role(x).alias("role"), text(x).alias("text")))
    targets = F.transform("loss", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return formatted.select("conv_id", "window", F.length("formatted").cast("long").alias("n_chars"), turns.alias("turns"), targets.alias("targets"))


def conversations(read: DataFrame) -> DataFrame:
    """Per conversation: its turns and targets whole, and how long its windows are.

    A conversation's text comes together only here, as a digest of all of it needs; what moves is one row per window.
    """
    rows = read.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("window", "turns", "targets"))).alias("w"), F.sum("n_chars").alias("formatted_chars"))
    return rows.select("conv_id", F.flatten(F.transform("w", lambda x: x["turns"])).alias("turns"), F.array_join(F.flatten(F.transform("w", lambda x: x["targets"])), "").alias("loss_text"), "formatted_chars")
