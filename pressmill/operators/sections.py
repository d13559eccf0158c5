"""Section quotas: best rows per section, then backfill of thin sections."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..params import Settings
from ..session import materialize
from .keyed import top_per_key


def section_table(spark, cfg: Settings) -> DataFrame:
    rows = [(i, s[0], s[1], s[2]) for i, s in enumerate(cfg.sections)]
    return spark.createDataFrame(rows, "position int, id string, icon string, label string")


def placed(articles: DataFrame, cfg: Settings, by: list[str]) -> DataFrame:
    """Rows of the edition(s): ``placed_section``, ``slot`` (1, 2, ...) and the row's own columns.

    ``by`` names the columns that tell editions apart (none: one edition). Overflow for backfill
    comes from the first ``max + sections x min`` rows of a section, which always hold enough, so no
    section is ranked as a whole.
    """
    ids = [s[0] for s in cfg.sections]
    slots = len(ids) * cfg.per_section_min
    home = F.when(F.col("section").isin(ids), F.col("section")).otherwise(cfg.default_section)
    best_first = [F.col("final_score").desc(), F.col("arrival")]
    edition = [*by, "_all"]

    rows = articles.withColumns({"placed_section": home, "_all": F.lit(1)})
    # a few rows per section, used four times below: written once, so the articles are read once
    head = materialize(
        top_per_key(rows, [*edition, "placed_section"], best_first, cfg.per_section_max + slots, "slot"), "sections")
    picked = head.filter(F.col("slot") <= cfg.per_section_max)
    overflow = head.filter(F.col("slot") > cfg.per_section_max).drop("slot", "placed_section")
    spare = top_per_key(overflow, edition, best_first, slots, "_turn")

    sizes = picked.groupBy(*edition, "placed_section").agg(F.count(F.lit(1)).alias("n"))
    grid = picked.select(*edition).distinct().select(
        *edition, F.posexplode(F.array(*[F.lit(i) for i in ids])).alias("position", "placed_section"))
    gaps = (
        grid.join(sizes, [*edition, "placed_section"], "left")
        .withColumn("n", F.coalesce(F.col("n"), F.lit(0)))
        .filter(F.col("n") < cfg.per_section_min)
        .select(*edition, "position", "placed_section",
                F.explode(F.sequence(F.col("n") + 1, F.lit(cfg.per_section_min).cast("long"))).alias("slot"))
    )
    turn = Window.partitionBy(*edition).orderBy("position", "slot")
    filled = gaps.withColumn("_turn", F.row_number().over(turn)).join(spare, [*edition, "_turn"])
    return (
        picked.withColumn("slot", F.col("slot").cast("long")).withColumn("backfilled", F.lit(False))
        .unionByName(filled.drop("_turn", "position").withColumn("backfilled", F.lit(True)))
        .drop("_all")
    )
