"""Chat formatting: every participant's view of a dialogue, with training masks.

Method. For each participant of a conversation the dialogue is rendered with that
participant's turns as ``assistant`` and all others as named users; context roles (system)
stay what they are in every view and are no participants. The mask lists the character
spans of the participant's own turns, end marker included.

Scale. Conversations of up to ``whole_turns`` turns (or a ten-thousandth of all turns, if
that is more) are numbered and cut into parts after one shuffle by conversation, the only
one that moves their texts. Longer ones, of which there are fewer than 10,000, are numbered
by a range sort with offsets for those that reach over several partitions, so that one with
a third of all turns is dealt out too. Views come in parts of at most ``part_turns``
consecutive turns; the parts of a view in order are the whole dialogue. Only built-in
functions are used, but for the numbering inside a sorted range.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.shared import batches_of, over_batches, session
from lakeloom.session import materialize

START, END = "<|im_start|>", "<|im_end|>"
PART_TURNS = 64
WHOLE_TURNS = 4096
LONG_TALKS = 10_000
CONTEXT_ROLES = ("system",)


def numbered(turns: DataFrame) -> DataFrame:
    """The rows with ``pos``, their place in their conversation from 0.

    Order: turn (null first), role, text; equal rows are interchangeable.
    """
    # The row number keeps equal rows apart, so that the range sort can deal them out.
    rows = materialize(turns.withColumn("row", F.monotonically_increasing_id()), "turns")
    spark = session(rows)
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = ["conv_id", "turn", "role", "text", "row"]
    ordered = (
        rows.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("part_id", F.spark_partition_id())
    )
    schema = T.StructType([*ordered.schema.fields, T.StructField("place", T.LongType())])

    def run(batches):
        last, count = None, 0
        for batch in batches_of(batches):
            ids = batch.column("conv_id").to_numpy(zero_copy_only=False)
            new = np.r_[last is None or ids[0] != last, ids[1:] != ids[:-1]]
            at = np.arange(len(ids))
            begin = np.maximum.accumulate(np.where(new, at, -1))
            place = np.where(begin >= 0, at - begin, at + count)
            last, count = ids[-1], int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(place, pa.int64())], names=[*batch.schema.names, "place"]
            )

    placed = materialize(over_batches(ordered, run, schema), "placed")
    counts = placed.groupBy("conv_id", "part_id").agg(F.count("*").alias("n"))
    # At most one row for each partition that a conversation reaches.
    offsets = counts.select(
        "conv_id",
        "part_id",
        F.expr(
            "coalesce(sum(n) over (partition by conv_id order by part_id"
            " rows between unbounded preceding and 1 preceding), 0)"
        ).alias("before"),
    ).where("before > 0")
    return placed.join(offsets, ["conv_id", "part_id"], "left").select(
        "conv_id",
        "role",
        "text",
        (F.col("place") + F.coalesce("before", F.lit(0))).alias("pos"),
    )


def positions(rows: DataFrame, whole_turns: int = WHOLE_TURNS) -> list[DataFrame]:
    """``conv_id, role, text, pos`` of all rows: those of whole conversations, then of long ones.

    The order within a conversation is that of ``numbered``. The first table is partitioned
    by conversation. Which are long is counted by a job over the conversation ids.
    """
    limit = max(whole_turns, rows.count() // LONG_TALKS)
    sizes = rows.groupBy("conv_id").agg(F.count("*").alias("n"))
    # Each has more than a ten-thousandth of all turns, so there are fewer than 10,000.
    long = [r["conv_id"] for r in sizes.where(F.col("n") > limit).select("conv_id").collect()]
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    columns = ["conv_id", "role", "text", (place.cast("bigint") - 1).alias("pos")]
    if not long:
        return [rows.select(*columns)]
    ids = F.broadcast(session(rows).createDataFrame([(i,) for i in long], "conv_id bigint"))
    return [
        rows.join(ids, "conv_id", "left_anti").select(*columns),
        numbered(rows.join(ids, "conv_id", "left_semi")),
    ]


def perspectives(
    turns: DataFrame,
    part_turns: int = PART_TURNS,
    context_roles: tuple[str, ...] = CONTEXT_ROLES,
    whole_turns: int = WHOLE_TURNS,
) -> DataFrame:
    """``conv_id, participant, part, n_turns, text, mask`` for every view.

    ``mask`` lists ``start:length`` of the trained spans in the part's text, in characters,
    joined by commas. A null role is the participant ``unknown``, a null text is empty, a
    null turn comes first; markers in texts lose their meaning by a blank. Rows without a
    conversation id belong to no dialogue and are left out; a conversation of context roles
    only has no view. Repeated rows are repeated turns; other columns are ignored.
    """
    session(turns)
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        F.replace(
            F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit("<|im_"), F.lit("<| im_")
        ).alias("text"),
    )
    speakers = (
        rows.where(~F.col("role").isin(*context_roles))
        .select("conv_id", F.col("role").alias("participant"))
        .distinct()
    )
    part = F.floor(F.col("pos") / part_turns).cast("bigint").alias("part")
    listed = F.sort_array(F.collect_list(F.struct("pos", "role", "text"))).alias("turns")
    cut = [p.groupBy("conv_id", part).agg(listed).join(speakers, "conv_id") for p in positions(rows, whole_turns)]

    own = lambda t: t["role"] == F.col("participant")

    def head(t):
        return (
            F.when(t["role"].isin(*context_roles), F.concat(F.lit(START), t["role"], F.lit("\n")))
            .when(own(t), F.lit(f"{START}assistant\n"))
            .otherwise(F.concat(F.lit(f"{START}user name="), t["role"], F.lit("\n")))
        )

    parts = cut[0] if len(cut) == 1 else cut[0].unionByName(cut[1])
    views = parts.select(
        "conv_id",
        "participant",
        "part",
        F.transform(
            "turns",
            lambda t: F.struct(
                head(t).alias("head"),
                F.concat(t["text"], F.lit(END)).alias("body"),
                own(t).alias("own"),
            ),
        ).alias("turns"),
    )
    end = F.aggregate(
        "turns",
        F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("spans")),
        lambda s, t: F.struct(
            (s["at"] + F.length(t["head"]) + F.length(t["body"]) + 1).cast("bigint").alias("at"),
            F.when(
                t["own"],
                F.concat(
                    s["spans"],
                    F.array(
                        F.concat_ws(
                            ":",
                            (s["at"] + F.length(t["head"])).cast("string"),
                            F.length(t["body"]).cast("string"),
                        )
                    ),
                ),
            )
            .otherwise(s["spans"])
            .alias("spans"),
        ),
    )
    return views.select(
        "conv_id",
        "participant",
        "part",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join(
            F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit("\n"))), ""
        ).alias("text"),
        F.array_join(end["spans"], ",").alias("mask"),
    )


ORACLE = f"""
with rows_ as (
    select conv_id, coalesce(role, 'unknown') as role,
           replace(coalesce(text, ''), '<|im_', '<| im_') as text,
           row_number() over (partition by conv_id
               order by turn nulls first, coalesce(role, 'unknown'),
                        replace(coalesce(text, ''), '<|im_', '<| im_')) - 1 as pos
    from conversations where conv_id is not null),
speakers as (
    select distinct conv_id, role as participant from rows_ where role <> 'system'),
pieces as (
    select r.conv_id, participant, pos // {PART_TURNS} as part, pos,
           '{START}' || case when role = 'system' then role
               when role = participant then 'assistant' else 'user name=' || role end
               || chr(10) as head,
           text || '{END}' as body, role = participant as own
    from rows_ r join speakers s on r.conv_id = s.conv_id),
placed as (
    select *, sum(length(head) + length(body) + 1) over (
        partition by conv_id, participant, part order by pos) - length(body) - 1 as begins
    from pieces)
select conv_id, participant, cast(part as bigint) as part, count(*) as n_turns,
       string_agg(head || body || chr(10), '' order by pos) as text,
       coalesce(string_agg(case when own then cast(cast(begins as bigint) as varchar) || ':'
           || cast(length(body) as varchar) end, ',' order by pos), '') as mask
from placed group by conv_id, participant, part
"""
