"""Run ledger: append-only status rows, the latest row of a run wins."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keyed import first_per_key


def current_status(ledger: DataFrame) -> DataFrame:
    """The latest row of each run: rows of one instant are told apart by their number in the run."""
    return first_per_key(ledger, ["run_id"], [F.col("ts").desc(), F.col("seq").desc()])


def last_success(ledger: DataFrame) -> DataFrame:
    """The newest successful run (no row when there is none); run ids grow with the time of the start."""
    return ledger.filter(F.col("status") == "success").orderBy(F.col("ts").desc(), F.col("run_id").desc()).limit(1)


def pending_candidates(candidates: DataFrame) -> DataFrame:
    return candidates.filter(F.col("status") == "pending").orderBy(F.col("score").desc(), "url")
