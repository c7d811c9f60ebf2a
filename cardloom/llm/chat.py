"""Chat formatting by perspective: every speaker of a dialogue is the assistant once.

For each speaker the whole dialogue is rendered with that speaker's turns as the
assistant's and all others as turns of named users, and a mask names the
characters to be learned. Long dialogues come in parts of ``TURNS`` turn numbers:
their texts, in order, are the dialogue, and offsets count from its beginning, so
that no dialogue has to fit into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import staged

TURNS = 256
# Turns of this role are instructions: rendered as they are, nobody's perspective.
SYSTEM = "system"
START, END = "<|im_start|>", "<|im_end|>\n"


def _clean(text: Column) -> Column:
    """Marks inside a text would read as turns; they lose their bars."""
    return F.replace(
        F.replace(text, F.lit("<|im_start|>"), F.lit("<im_start>")),
        F.lit("<|im_end|>"),
        F.lit("<im_end>"),
    )


def perspectives(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv_id, speaker, part, n_turns, start, text, mask, target_chars``.

    One row for every part of a dialogue and speaker of the dialogue. ``mask``
    lists ``(start, length)`` in the dialogue's characters of what the speaker says, with
    the mark that ends the turn, in order; ``target_chars`` is their sum.

    Turns are in the order of their number, then of role and text; equal ones
    are rendered as often as they occur. A null role is a speaker called ``unknown``, a null
    text an empty one. Turns without a conversation or number have no place
    and are left out. A dialogue of system turns only has no speaker and no row.
    Marks inside texts and names lose their bars, line ends in names become
    spaces. Other columns are not read.
    """
    rows = turns.select(
        F.col(f"`{conv_col}`").alias("conv_id"),
        F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.translate(
            _clean(F.coalesce(F.col(f"`{role_col}`"), F.lit("unknown"))), "\r\n", "  "
        ).alias("role"),
        _clean(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("said"),
    ).where("conv_id is not null and turn is not null")
    rows = rows.withColumn("part", F.expr(f"cast(floor(turn / {TURNS}) as bigint)"))
    # Lengths of a turn as somebody else's and as the speaker's own.
    rows = (
        rows.withColumn(
            "as_user",
            F.when(F.col("role") == SYSTEM, F.lit(f"{START}{SYSTEM}\n")).otherwise(
                F.concat(F.lit(f"{START}user name="), F.col("role"), F.lit("\n"))
            ),
        )
        .withColumn("size", F.length("as_user") + F.length("said") + len(END))
        .withColumn(
            "gain", F.lit(len(f"{START}assistant\n")) - F.length("as_user")
        )
    )
    # Lengths of the parts before each part, for every speaker.
    by_role = rows.groupBy("conv_id", "part", "role").agg(
        F.sum("size").alias("size"), F.sum("gain").alias("gain")
    )
    by_role = staged(by_role, "part_sizes")
    speakers = by_role.where(F.col("role") != SYSTEM).select(
        "conv_id", F.col("role").alias("speaker")
    )
    speakers = staged(speakers.distinct(), "speakers")
    parts = by_role.groupBy("conv_id", "part").agg(F.sum("size").alias("size"))
    begins = (
        parts.join(speakers, "conv_id")
        .join(
            by_role.select("conv_id", "part", F.col("role").alias("speaker"), "gain"),
            ["conv_id", "part", "speaker"],
            "left",
        )
        .withColumn("long", F.expr("size + coalesce(gain, 0)"))
        .withColumn(
            "start",
            F.expr(
                "sum(long) over (partition by conv_id, speaker order by part"
                " rows between unbounded preceding and current row) - long"
            ),
        )
        .select("conv_id", "speaker", "part", "start")
    )
    # The turns of a part lie together; each speaker reads them in one pass.
    held = rows.groupBy("conv_id", "part").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "said", "as_user", "size"))).alias("turns")
    )
    own = lambda t: t["role"] == F.col("speaker")
    text = F.concat_ws(
        "",
        F.transform(
            "turns",
            lambda t: F.concat(
                F.when(own(t), F.lit(f"{START}assistant\n")).otherwise(t["as_user"]),
                t["said"],
                F.lit(END),
            ),
        ),
    )
    head = len(f"{START}assistant\n")
    first = F.struct(
        F.col("start").alias("at"),
        F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"),
    )
    step = lambda a, t: F.when(
        own(t),
        F.struct(
            (a["at"] + head + F.length(t["said"]) + len(END)).alias("at"),
            F.concat(
                a["spans"],
                F.array(
                    F.struct(
                        (a["at"] + head).alias("start"),
                        (F.length(t["said"]) + len(END)).cast("long").alias("length"),
                    )
                ),
            ).alias("spans"),
        ),
    ).otherwise(F.struct((a["at"] + t["size"]).alias("at"), a["spans"].alias("spans")))
    mask = F.aggregate("turns", first, step, lambda a: a["spans"])
    return (
        begins.join(held, ["conv_id", "part"])
        .withColumn("text", text)
        .withColumn("mask", mask)
        .select(
            "conv_id",
            "speaker",
            "part",
            F.size("turns").cast("long").alias("n_turns"),
            "start",
            "text",
            "mask",
            F.aggregate("mask", F.lit(0).cast("long"), lambda a, m: a + m["length"]).alias(
                "target_chars"
            ),
        )
    )
