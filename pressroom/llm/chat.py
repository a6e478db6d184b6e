"""Chat conversations as budgeted training windows, with column functions only.

Prefix sums of turn tokens cut a conversation at turns, as late as they can: a window's own turns end with the last one whose prefix is within
``budget`` less ``history`` less the system turn, if the conversation opens with one. A window is its own turns, before them the turns that lie
whole within the last ``history`` tokens, and before those the system turn. A turn too long for that makes a window alone and leaves less
room for history, so a window exceeds the budget only where one turn with the system turn does. Only own assistant turns carry
loss; repeated history and the repeated system turn are masked, so each assistant text is a target once.

Prefix sums run over pieces of conversations and then over piece totals, and cuts are made in blocks of ``BLOCK`` windows' tokens, each of which begins
a window, so one endless conversation is not one task. A window is numbered by its first turn, counted from 0 without the system turn.

A turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside role and text a backslash is doubled and ``<|`` becomes ``<\\|``
(in a role a line break becomes ``\\n``), so no control string can come from a text, and reading back gives the exact text.

Null roles and texts are empty, null turns come first, rows with equal turn are ordered by role and text, repeated rows are repeated
turns. A null conv_id is a conversation of its own. No rows give no windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressroom.operators.running import balanced_buckets, running

START, END = "<|im_start|>", "<|im_end|>\n"
#: Tokens that the markup of a turn counts.
MARKUP = 4
#: Tokens of a block, in windows' own tokens: cuts inside a block depend on the turns before them, those between blocks do not.
BLOCK = 16


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))
    return F.replace(out, F.lit("\n"), F.lit("\\n")) if role else out


def unescape(text: Column, role: bool = False) -> Column:
    def plain(part):
        part = F.replace(part, F.lit("\\|"), F.lit("|"))
        return F.replace(part, F.lit("\\n"), F.lit("\n")) if role else part

    # what a doubled backslash leaves between has single ones only
    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def estimated_tokens(text: Column) -> Column:
    """A token for every four bytes, and the markup."""
    return F.floor((F.octet_length(text) + 3) / 4).cast("bigint") + MARKUP


def _cuts(room: Column) -> Column:
    """The turns (by ``at``) of a block's ``turns`` that begin a window, when windows hold ``room`` tokens or one turn."""
    kind = "struct<begins:bigint,cuts:array<bigint>>"
    nothing = F.struct(F.lit(None).alias("begins"), F.array().alias("cuts")).cast(kind)

    def step(state, t):
        fits = F.coalesce(t["before"] + t["n"] - state["begins"] <= room, F.lit(False))
        cut = F.struct(t["before"].alias("begins"), F.array_append(state["cuts"], t["at"]).alias("cuts")).cast(kind)
        return F.when(fits, state).otherwise(cut)

    return F.aggregate("turns", nothing, step, lambda state: state["cuts"])


def format_windows(conversations: DataFrame, budget: int, history: int, tokens=estimated_tokens) -> DataFrame:
    """conv_id, window, formatted and spans, one row per window.

    ``spans`` has for every turn in the window, in order, where its text stands in ``formatted`` (``start`` from 0 and ``length``, in code
    points), whether it carries ``loss``, and whether it is ``repeated``.
    """
    if not 0 <= history < budget:
        raise ValueError("history must be smaller than the budget")
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("n", tokens(F.col("text")))
    order = ["turn", "role", "text"]
    bucketed = balanced_buckets(turns, ["conv_id"], order)
    counted = running(bucketed, ["conv_id"], ["_bucket"], order, {"seq": ("sum", F.lit(1)), "upto": ("sum", F.col("n"))})
    opening = (F.col("role") == "system") & (F.col("seq") == 1)
    counted = counted.withColumn("opens", opening).drop("_bucket")
    system = counted.where("opens")

    # the opening turn counts in nobody's prefix: the others' prefixes are moved by it, as one value a conversation
    heads = system.select(F.col("conv_id").alias("_c"), F.col("n").alias("_head"))
    body = counted.where("not opens").join(heads, F.col("conv_id").eqNullSafe(F.col("_c")), "left").drop("_c")
    head = F.coalesce("_head", F.lit(0)).cast("bigint")
    turn = F.struct(
        (F.col("seq") - 1 - F.col("_head").isNotNull().cast("int")).alias("at"), (F.col("upto") - F.col("n") - head).alias("before"),
        F.col("n").cast("bigint").alias("n"), "seq", "role", "text",
    )
    blocks = body.withColumns({"turn": turn, "head": head}).groupBy("conv_id", "head", F.floor(F.col("turn.before") / (BLOCK * (budget - history))).alias("block"))
    blocks = blocks.agg(F.sort_array(F.collect_list("turn")).alias("turns")).withColumn("cuts", _cuts(F.lit(budget - history) - F.col("head")))
    body = blocks.select("conv_id", "head", "cuts", F.explode("turns").alias("turn")).select("conv_id", "head", "cuts", "turn.*")
    body = body.withColumn("window", F.array_max(F.filter("cuts", lambda at: at <= F.col("at")))).drop("cuts")
    windows = body.groupBy("conv_id", "head", "window").agg(F.min("before").alias("begins"), F.sum("n").alias("own"))
    keys = windows.select(F.col("conv_id").alias("_c"), F.col("window").alias("_w"), "begins", F.least(F.lit(history), budget - F.col("head") - F.col("own")).alias("room"))

    own = body.select("conv_id", "window", "seq", "role", "text", F.lit(False).alias("repeated"))
    # windows meet the turns before them in cells as long as the history, of which a history touches two
    wide = max(history, 1)
    cells = F.sequence(F.floor((F.col("begins") - F.col("room")) / wide), F.floor(F.col("begins") / wide))
    reach = keys.where("_w > 0 and room > 0").withColumn("_cell", F.explode(cells))
    near = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.floor(F.col("before") / wide) == F.col("_cell"))
    past = body.join(reach, near & (F.col("at") < F.col("_w")) & (F.col("begins") - F.col("before") <= F.col("room")))
    past = past.select("conv_id", F.col("_w").alias("window"), "seq", "role", "text", F.lit(True).alias("repeated"))
    first = system.select("conv_id", F.lit(0).cast("bigint").alias("window"), "seq", "role", "text", F.lit(False).alias("repeated"))
    again = system.join(keys.where("_w > 0"), F.col("conv_id").eqNullSafe(F.col("_c")))
    again = again.select("conv_id", F.col("_w").alias("window"), "seq", "role", "text", F.lit(True).alias("repeated"))

    rows = own.unionByName(past).unionByName(first).unionByName(again)
    role, text = escape(F.col("role"), role=True), escape(F.col("text"))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    part = F.struct(
        "seq", head.alias("head"), text.alias("text"), "repeated", ((F.col("role") == "assistant") & ~F.col("repeated")).alias("loss")
    )
    grouped = rows.groupBy("conv_id", "window").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    formatted = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["text"], F.lit(END))), "")
    kind = "struct<at:int,spans:array<struct<start:int,length:int,loss:boolean,repeated:boolean>>>"
    nothing = F.struct(F.lit(0).alias("at"), F.array().alias("spans")).cast(kind)

    def step(state, p):
        start, size = state["at"] + F.length(p["head"]), F.length(p["text"])
        span = F.struct(start.alias("start"), size.alias("length"), p["loss"].alias("loss"), p["repeated"].alias("repeated"))
        return F.struct((start + size + len(END)).alias("at"), F.array_append(state["spans"], span).alias("spans")).cast(kind)

    spans = F.aggregate("parts", nothing, step, lambda state: state["spans"])
    return grouped.select("conv_id", "window", formatted.alias("formatted"), spans.alias("spans"))


def read_windows(windows: DataFrame) -> DataFrame:
    """The windows' turns as read from ``formatted`` and ``spans``: conv_id, window, chars of the window, and ``turns``,
    an array of (role, text, loss_text, repeated); ``loss_text`` is what stands under the loss mask, unescaped, else null."""
    written = F.split("formatted", r"<\|im_end\|>\n", -1)
    together = F.arrays_zip(F.slice(written, 1, F.size("spans")).alias("part"), F.col("spans").alias("span"))

    def turn(x):
        part, span = F.substring(x["part"], len(START) + 1, 2**31 - 1), x["span"]
        under = F.when(span["loss"], unescape(F.substr(F.col("formatted"), span["start"] + 1, span["length"])))
        role = F.substring_index(part, "\n", 1)
        text = F.substr(part, F.length(role) + 2, F.length(part))
        return F.struct(unescape(role, role=True).alias("role"), unescape(text).alias("text"), under.alias("loss_text"), span["repeated"].alias("repeated"))

    return windows.select("conv_id", "window", F.length("formatted").cast("bigint").alias("chars"), F.transform(together, turn).alias("turns"))


def conversation_digest(windows: DataFrame) -> DataFrame:
    """Checksums of each whole conversation and of its loss texts, from what is read back. A conversation has to fit in a row."""
    own = F.filter("turns", lambda t: ~t["repeated"])
    spoken = F.array_join(F.transform(own, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    under = F.array_join(F.transform(F.filter("turns", lambda t: t["loss_text"].isNotNull()), lambda t: t["loss_text"]), "")
    each = read_windows(windows).select("conv_id", "chars", F.size(own).cast("bigint").alias("n"), F.struct("window", spoken.alias("spoken"), under.alias("loss")).alias("w"))
    whole = each.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.sort_array(F.collect_list("w")).alias("w"))
    loss = F.array_join(F.transform("w", lambda w: w["loss"]), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.array_join(F.transform("w", lambda w: w["spoken"]), "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )
