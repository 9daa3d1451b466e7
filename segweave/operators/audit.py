"""Audit of recorded files: outliers against the same stem elsewhere, totals, bit rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranks import ranks

_VALID = "error IS NULL AND duration_seconds > 0"


def find_outliers(probes: DataFrame, factor: float = 3.0, least: int = 3) -> DataFrame:
    """Findings: unreadable, empty, and too long or too short by `factor` against the stem's median."""
    middle = ranks(probes.where(_VALID), ["stem"], "duration_seconds", {"expected_seconds": (0.5, "median")}).where((F.col("n") >= least) & (F.col("expected_seconds") > 0)).drop("n")
    ratio = F.when(F.expr(_VALID), F.col("duration_seconds") / F.col("expected_seconds"))
    kind = F.when(F.col("error").isNotNull(), "unreadable").when(~F.coalesce(F.col("duration_seconds") > 0, F.lit(False)), "empty").when(ratio >= factor, "too long").when(ratio <= 1 / factor, "too short")
    return probes.join(middle, "stem", "left").select("source_id", kind.alias("kind"), "duration_seconds", F.when(F.expr(_VALID), F.col("expected_seconds")).alias("expected_seconds"), F.round(ratio, 9).alias("ratio")).where("kind IS NOT NULL")


def in_order(findings: DataFrame) -> DataFrame:
    rank = F.when(F.col("kind") == "unreadable", 0).when(F.col("kind") == "empty", 1).when(F.col("kind") == "too long", 2).otherwise(3)
    return findings.orderBy(rank, F.desc_nulls_last("ratio"), "source_id")


def summary(probes: DataFrame) -> DataFrame:
    ok = F.expr(_VALID)
    return probes.agg(F.count(F.lit(1)).alias("files"), F.count(F.when(ok, 1)).alias("readable"), F.round(F.sum(F.when(ok, F.col("duration_seconds"))) / 3600, 2).alias("hours"), F.round(F.sum("size_bytes") / 1e9, 2).alias("gigabytes"))


def bitrates(probes: DataFrame) -> DataFrame:
    rate = probes.select("reciter_slug", F.expr("try_divide(size_bytes, nullif(duration_seconds, 0D))").alias("rate"))
    return ranks(rate, ["reciter_slug"], "rate", {"bytes_per_second": (0.5, "median")}).select("reciter_slug", "n", F.round("bytes_per_second", 6).alias("bytes_per_second"))
