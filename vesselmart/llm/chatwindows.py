"""Chat formatting in budgeted windows, built-in functions only.

Prefix sums of turn tokens choose the windows. With a room of ``budget`` less
the system turn and the history, a turn that ends within a multiple of the room
belongs to that multiple's window; a turn that straddles a multiple is a window
of its own. Windows are therefore made of whole turns, found without walking
through the conversation, and none is over the budget unless a single turn is.

Every window starts with the conversation's system turn (its first turn, if the
role is ``system``), then repeats up to ``history_turns`` turns before it, as
many as ``history`` tokens hold, then has its own turns. The loss mask covers
the texts of its own assistant turns; repeated ones are masked out. So each
assistant text is a target once.

Template: ``<|start|>role<|says|>text<|end|>``. Inside roles and texts ``&``
becomes ``&amp;`` and the first character of every control string becomes an
entity (``<`` is ``&lt;``, ``[`` is ``&#91;``), which ``parse`` undoes exactly.

Defined results: null roles and texts are empty; turns of one number are taken
in order of role and text, a null number first; a conversation of a system turn
alone is one window without targets. A conversation is one output record of
``digests``, so its turns meet in one row there; ``windows`` never needs that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SAYS, END = "<|start|>", "<|says|>", "<|end|>"
#: Strings that mean something to this template or to common tokenizers.
CONTROL = (
    START, SAYS, END, "<<SYS>>", "<</SYS>>", "<s>", "</s>", "<|", "[INST]", "[/INST]",
)
_ENTITIES = {"<": "&lt;", "[": "&#91;"}
#: Tokens that a turn's marks and role count for, besides its words.
MARKS = 4


def escape(text: Column) -> Column:
    """Text in which no control string is left."""
    text = F.replace(text, F.lit("&"), F.lit("&amp;"))
    for control in CONTROL:
        text = F.replace(text, F.lit(control), F.lit(_ENTITIES[control[0]] + control[1:]))
    return text


def unescape(text: Column) -> Column:
    for plain, entity in [*_ENTITIES.items(), ("&", "&amp;")]:
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return text


def tokens(text: Column) -> Column:
    """Words of a text plus its marks."""
    words = F.split(text, r"[\x20\x09-\x0D]+")
    return (F.size(F.array_remove(words, "")) + MARKS).cast("long")


def _head(turn: Column) -> Column:
    return F.concat(F.lit(START), escape(turn["role"]), F.lit(SAYS))


def _formatted(turn: Column) -> Column:
    return F.concat(_head(turn), escape(turn["text"]), F.lit(END))


def windows(
    conversations: DataFrame, budget: int = 1024, history: int = 256, history_turns: int = 8
) -> DataFrame:
    """(conv_id, window, n_repeated, formatted, loss) of every window.

    ``loss`` holds the (start, end) offsets of the targets within ``formatted``;
    the first ``n_repeated`` turns are repeated ones.
    """
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("tokens", tokens(F.col("text")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    # whole rows, as equal turns are peers
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = turns.withColumn("place", F.row_number().over(order))
    is_system = (F.col("place") == 1) & (F.col("role") == "system")
    turns = turns.withColumn("is_system", is_system)
    turns = turns.withColumn(
        "room",
        F.greatest(
            F.lit(budget - history)
            - F.first(F.when(F.col("is_system"), F.col("tokens")).otherwise(0)).over(so_far),
            F.lit(1),
        ),
    )
    size = F.when(F.col("is_system"), F.lit(0)).otherwise(F.col("tokens"))
    turns = turns.withColumn("size", size).withColumn("ends", F.sum("size").over(so_far))
    starts = F.col("ends") - F.col("size")
    into = F.greatest(F.floor((F.col("ends") - 1) / F.col("room")), F.lit(0))
    straddles = ~F.col("is_system") & (F.floor(starts / F.col("room")) < into)
    turns = turns.withColumn("starts", starts).withColumn(
        "span", into * 2 + F.when(straddles, 0).otherwise(1)
    )
    one = F.struct("role", "text")
    opens = F.coalesce(F.lag("span").over(order) != F.col("span"), F.lit(True))
    recent = F.collect_list(
        F.struct("role", "text", "starts", "is_system")
    ).over(order.rowsBetween(-history_turns, -1))
    turns = turns.withColumn("opens", opens).withColumn(
        "repeated", F.when(F.col("opens") & (F.col("place") > 1), recent)
    ).withColumn(
        "system", F.when(F.col("opens") & ~F.col("is_system"), F.first(F.when(F.col("is_system"), one)).over(so_far))
    ).withColumn("opened_at", F.when(F.col("opens"), F.col("starts")))
    grouped = turns.groupBy("conv_id", "span").agg(
        F.array_sort(F.collect_list(F.struct("place", "role", "text"))).alias("own"),
        F.first("repeated", True).alias("repeated"), F.first("system", True).alias("system"),
        F.min("opened_at").alias("opened_at"),
    )
    kept = F.filter(
        F.coalesce("repeated", F.array()),
        lambda t: ~t["is_system"] & (F.col("opened_at") - t["starts"] <= history),
    )
    plain = F.transform(kept, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    system = F.when(F.col("system").isNotNull(), F.array("system")).otherwise(F.array())
    parts = grouped.select(
        "conv_id", "span", F.concat(system, plain).alias("again"), "own",
    ).select(
        "conv_id", "span", F.size("again").cast("long").alias("n_repeated"),
        F.array_join(F.transform("again", _formatted), "").alias("front"),
        F.transform(
            "own",
            lambda t: F.struct(
                t["role"].alias("role"), F.length(_head(t)).alias("head"),
                F.length(escape(t["text"])).alias("body"), _formatted(t).alias("formatted"),
            ),
        ).alias("own"),
    )
    start = F.struct(
        F.length("front").alias("at"),
        F.array().cast("array<struct<start:int,end:int>>").alias("loss"),
    )

    def add(state: Column, turn: Column) -> Column:
        begin = state["at"] + turn["head"]
        target = F.array(F.struct(begin.alias("start"), (begin + turn["body"]).alias("end")))
        return F.struct(
            (state["at"] + F.length(turn["formatted"])).alias("at"),
            F.when(turn["role"] == "assistant", F.concat(state["loss"], target))
            .otherwise(state["loss"]).alias("loss"),
        )

    return parts.select(
        "conv_id", F.col("span").alias("window"), "n_repeated",
        F.concat("front", F.array_join(F.transform("own", lambda t: t["formatted"]), "")).alias("formatted"),
        F.aggregate("own", start, add)["loss"].alias("loss"),
    )


def parse(formatted: Column) -> Column:
    """Turns (role, text) of a formatted window, as they were before escaping."""
    ends = F.split(formatted, F.lit(r"\Q" + END + r"\E"))
    turns = F.slice(ends, F.lit(1), F.size(ends) - 1)  # nothing follows the last end
    return F.transform(
        turns,
        lambda t: F.struct(
            unescape(
                F.substring_index(F.substring_index(t, SAYS, 1), START, -1)
            ).alias("role"),
            unescape(F.substring_index(t, SAYS, -1)).alias("text"),
        ),
    )


def targets(formatted: Column, loss: Column) -> Column:
    """Texts under the loss mask, unescaped, in order."""
    return F.transform(
        loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))
    )


def digests(out: DataFrame) -> DataFrame:
    """What the windows of each conversation say when read back."""
    parsed = parse(F.col("formatted"))
    read = out.select(
        "conv_id", "window", F.length("formatted").cast("long").alias("chars"),
        F.col("n_repeated").cast("int").alias("n_repeated"), parsed.alias("turns"),
        F.array_join(targets(F.col("formatted"), F.col("loss")), "").alias("loss"),
    )
    own = F.slice("turns", F.col("n_repeated") + 1, F.greatest(F.size("turns"), F.lit(1)))
    lines = F.array_join(
        F.transform(own, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    each = read.select(
        "conv_id", "window", "chars", "loss", lines.alias("said"), F.size(own).alias("n"),
    )
    whole = each.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("window", "said", "loss"))).alias("w"),
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.count(F.lit(1)).alias("n_windows"),
    )
    said = F.array_join(F.transform("w", lambda w: w["said"]), "")
    loss = F.array_join(F.transform("w", lambda w: w["loss"]), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"), "formatted_chars", "n_windows",
    )
