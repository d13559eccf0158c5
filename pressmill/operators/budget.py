"""Token budgets: usage roll-ups, running usage, admission under daily and monthly caps."""
from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .layout import GROUP_LIMIT, chunked, join_groups, running_over_chunks, running_sum


def usage(ledger: DataFrame) -> DataFrame:
    """Tokens per month, per day and per month and kind, in one aggregation."""
    return ledger.groupingSets(
        [[F.col("month")], [F.col("month"), F.col("day")], [F.col("month"), F.col("kind")]],
        F.col("month"), F.col("day"), F.col("kind"),
    ).agg(
        F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("calls"),
        F.when(F.grouping("day") == 0, "day").when(F.grouping("kind") == 0, "kind").otherwise("month").alias("level"),
    )


def running_usage(ledger: DataFrame, keys: list[str], order: list[str], cap: int, **limits) -> DataFrame:
    """Usage up to and with each call, and whether it is past the cap (an upper bound of refusals)."""
    used = running_sum(ledger, keys, order, F.col("tokens"), "used", **limits)
    return used.withColumn("over_cap", F.col("used") > cap)


def _fill_in_order(rows: pd.DataFrame) -> pd.DataFrame:
    """Ordered admission within one bounded group."""
    rows = rows.sort_values("pos")
    left = int(rows["room"].iloc[0]) if len(rows) else 0
    taken = []
    for tokens in rows["tokens"].tolist():
        fits = tokens <= left
        left -= tokens if fits else 0
        taken.append(fits)
    return rows.assign(admitted=taken)[["pos", "admitted"]]


def fill(
    ledger: DataFrame, keys: list[str], order: list[str], room: str,
    group_limit: int = GROUP_LIMIT, chunks: int | None = None,
) -> DataFrame:
    """Adds ``admitted``: in order, a call is taken iff it fits into what is left of ``room``.

    ``room`` is the cap of the row's group. A refused call is not charged, so later smaller ones may
    fit. Groups that are small enough (counted first) are folded in one task. Larger ones are worked
    off in phases: with room r in (h, 2h], calls up to h are all taken until room falls to h, and at
    most one larger call is taken before that. So one running sum finds the end of the phase, room
    halves at least, and there are log2(cap) phases at most.
    """
    slim = chunked(
        ledger.select(F.struct(*keys).alias("grp"), F.struct(*order).alias("at"), "tokens",
                      F.col(room).cast("long").alias("room")),
        ["grp"], ["at"], chunks)
    state = slim.groupBy("grp").agg(F.max("room").alias("room")).withColumn("after", F.lit(-1).cast("long"))
    state = materialize(state, "room")
    phases: list[DataFrame] = []
    total = slim.count()  # no group is larger than this
    while True:
        # ``slim`` meets the state on (group, chunk): no hot group lands in one task
        open_rows = _beside(slim.drop("room"), state).filter(
            (F.col("pos") > F.col("after")) & (F.col("tokens") <= F.col("room")))
        if total <= group_limit:
            break
        sizes = open_rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
        big = materialize(sizes.filter(F.col("n") > group_limit).select("grp"), "big")
        if big.isEmpty():
            break
        step = materialize(_phase(_beside_grp(open_rows, big)), "phase")
        phases.append(step)
        moved = step.select("grp", F.col("to").alias("_to"), F.col("left").alias("_left"))
        state = materialize(
            state.join(moved, "grp", "left").select(
                "grp", F.coalesce("_left", "room").alias("room"), F.coalesce("_to", "after").alias("after")),
            "room")
    folded = open_rows.select("grp", "pos", "tokens", "room").groupBy("grp").applyInPandas(
        _fill_in_order, "pos long, admitted boolean")
    taken = folded.filter("admitted").select("pos")
    for step in phases:
        span = _beside(slim.drop("room"), step.drop("left"))
        taken = taken.unionByName(span.filter(
            (F.col("pos") > F.col("from")) & (F.col("pos") <= F.col("to"))
            & ((F.col("tokens") <= F.col("half")) | (F.col("pos") == F.col("big_pos")))).select("pos"))
    marks = slim.select("grp", "at", "pos").join(taken.withColumn("admitted", F.lit(True)), "pos", "left")
    marks = marks.select(
        *[F.col(f"grp.{k}").alias(k) for k in keys], *[F.col(f"at.{o}").alias(o) for o in order],
        F.coalesce(F.col("admitted"), F.lit(False)).alias("admitted"))
    return join_groups(ledger, marks, list(dict.fromkeys([*keys, *order])))


def _beside(rows: DataFrame, per_group: DataFrame) -> DataFrame:
    """Joins group facts to rows by (group, chunk)."""
    spread = rows.select("grp", "chunk").distinct().join(per_group, "grp")
    return rows.join(spread, ["grp", "chunk"])


def _beside_grp(rows: DataFrame, groups: DataFrame) -> DataFrame:
    spread = rows.select("grp", "chunk").distinct().join(groups, "grp", "left_semi")
    return rows.join(spread, ["grp", "chunk"], "left_semi")


def _phase(rows: DataFrame) -> DataFrame:
    """One phase per group: (grp, from, to, half, big_pos, left)."""
    # half: the largest power of two below room, from the number of binary digits (0 for room 1)
    digits = F.length(F.bin(F.col("room") - 1))
    half = F.when(F.col("room") <= 1, F.lit(0)).otherwise(F.pow(F.lit(2.0), digits - 1)).cast("long")
    sized = rows.withColumn("half", half).withColumn(
        "light", F.when(F.col("tokens") <= F.col("half"), F.col("tokens")).otherwise(F.lit(0)))
    run = running_over_chunks(sized, ["grp"], F.col("light"), "run")
    rest = F.col("room") - F.col("run")
    heavy_fits = (F.col("tokens") > F.col("half")) & (F.col("tokens") <= rest)
    ends = heavy_fits | ((F.col("light") > 0) & (rest <= F.col("half")))
    left = F.when(heavy_fits, rest - F.col("tokens")).otherwise(rest)
    end = F.min_by(F.struct(
        F.col("pos"), F.when(heavy_fits, F.col("pos")).alias("big_pos"), left.alias("left")),
        F.when(ends, F.col("pos")))
    per_group = run.groupBy("grp").agg(
        F.max("after").alias("from"), F.max("half").alias("half"), F.max("pos").alias("last"),
        F.min(rest).alias("low"), end.alias("end"))
    return per_group.select(
        "grp", "from", F.coalesce("end.pos", "last").alias("to"), "half", F.col("end.big_pos").alias("big_pos"),
        F.coalesce("end.left", "low").alias("left"))


def admitted(
    ledger: DataFrame, order: list[str], daily: int | None, monthly: int | None, **limits,
) -> DataFrame:
    """Admission under a cap per (month, day) and a cap per month; ``order`` is unique in a month.

    Days are filled side by side under the daily cap. From the first day on which the month's total
    would pass the monthly cap, less room is left in the month than any later day could use, so the
    rest of the month is one sequence filled from that remainder.
    """
    if not daily and not monthly:
        return ledger.withColumn("admitted", F.lit(True))
    if not daily:
        return fill(ledger.withColumn("_room", F.lit(monthly)), ["month"], ["day", *order], "_room", **limits).drop("_room")
    by_day = fill(ledger.withColumn("_room", F.lit(daily)), ["month", "day"], order, "_room", **limits).drop("_room")
    if not monthly:
        return by_day
    by_day = materialize(by_day, "by-day")
    days = by_day.groupBy("month", "day").agg(
        F.sum(F.when(F.col("admitted"), F.col("tokens")).otherwise(0)).alias("taken"))
    upto = Window.partitionBy("month").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tight = (
        days.withColumn("total", F.sum("taken").over(upto)).filter(F.col("total") > monthly)
        .groupBy("month").agg(F.min("day").alias("_from"),
                              (F.lit(monthly) - F.min_by(F.col("total") - F.col("taken"), "day")).alias("_room"))
    )
    tight = materialize(tight, "tight")
    if tight.isEmpty():
        return by_day
    tight_days = days.select("month", "day").join(tight, "month").filter(F.col("day") >= F.col("_from"))
    late = ledger.join(tight_days.drop("_from"), ["month", "day"])
    early = by_day.join(tight_days.select("month", "day"), ["month", "day"], "left_anti")
    refilled = fill(late, ["month"], ["day", *order], "_room", **limits).drop("_room")
    return early.unionByName(refilled)
