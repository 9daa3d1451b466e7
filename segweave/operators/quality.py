"""Tables of label and pause quality for each group, and verdicts relative to the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranks import ranks
from ..functions.scalars import filled, share, tokens

SHORT_BY_WORDS, UNLABELLED_OVER = 2, 30.0


def _count(when):
    return F.count(F.when(when, F.lit(1)))


def label_fit(rows: DataFrame) -> DataFrame:
    """Match (1 - distance) of scored rows by group, and shares of short, missing and unlabelled ones."""
    r = rows.select(F.coalesce(filled("reciter_slug"), F.lit("?")).alias("reciter"), filled("asr").alias("asr"), filled("label").alias("label"), "align_distance")
    scored = F.col("align_distance").isNotNull() & F.col("asr").isNotNull()
    r = r.withColumn("match", F.when(scored, 1 - F.col("align_distance")))
    both = F.col("asr").isNotNull() & F.col("label").isNotNull()
    short = both & (F.size(tokens(F.col("label"))) - F.size(tokens(F.col("asr"))) >= SHORT_BY_WORDS)
    n = F.count("match")
    table = r.groupBy("reciter").agg(
        F.count(F.lit(1)).alias("segments"), n.alias("scored"), F.coalesce(F.round(F.avg("match"), 9), F.lit(0.0)).alias("mean"),
        share(_count(F.col("match") <= 0.65), n).alias("under_065"), share(_count(F.col("match") <= 0.5), n).alias("under_050"),
        share(_count(short), _count(both)).alias("transcript_short"), share(_count(F.col("asr").isNull()), F.count(F.lit(1))).alias("no_transcript"), share(_count(F.col("label").isNull()), F.count(F.lit(1))).alias("no_label"),
    )
    at = ranks(r, ["reciter"], "match", {"p50": (0.5, "nearest"), "p10": (0.1, "nearest"), "p01": (0.01, "nearest")}).drop("n")
    return table.join(at, "reciter", "left").fillna(0.0, ["p50", "p10", "p01"])


def waqf_fit(rows: DataFrame) -> DataFrame:
    """Durations of each group's segments: quantiles, shares of long ones, long ones without a label."""
    r = rows.select(F.coalesce(filled("reciter_slug"), F.lit("?")).alias("reciter"), filled("label").alias("label"), "duration_seconds")
    d, n = F.col("duration_seconds"), F.count("duration_seconds")
    table = r.groupBy("reciter").agg(
        F.count(F.lit(1)).alias("segments"), F.round(F.max(d), 9).alias("longest"), share(_count(d > 20), n).alias("over_20"), share(_count(d > 30), n).alias("over_30"),
        _count((d > UNLABELLED_OVER) & F.col("label").isNull()).alias("unlabelled_long"), F.round(F.sum(d) / 3600, 6).alias("hours"),
    ).where("longest IS NOT NULL")
    at = ranks(r, ["reciter"], "duration_seconds", {"p50": (0.5, "nearest"), "p95": (0.95, "nearest"), "p99": (0.99, "nearest")}).drop("n")
    return table.join(at, "reciter").select(*table.columns, *[F.round(c, 9).alias(c) for c in ("p50", "p95", "p99")])


def verdicts(labels: DataFrame, waqf: DataFrame) -> DataFrame:
    """Notes on groups that stand out: label notes first (section 1), then pauses (section 2).

    The corpus's middle is one row, joined by a key that all rows share.
    """
    m = labels.withColumn("all", F.lit(1))
    middle = ranks(m, ["all"], "mean", {"middle": (0.5, "nearest")}).drop("n").join(ranks(m, ["all"], "p50", {"middle_p50": (0.5, "nearest")}).drop("n"), "all")
    far = (F.col("middle") != 0) & (1 - F.col("mean") >= 2.0 * (1 - F.col("middle"))) & (1 - F.col("p50") >= 1.5 * (1 - F.col("middle_p50")))
    first = m.join(F.broadcast(middle), "all").select("reciter", F.lit(1).alias("section"), F.when(far, "labels far from the corpus").when(F.col("transcript_short") >= 0.10, "transcripts cut short").alias("note"))
    holes = waqf.select("reciter", F.lit(2).alias("section"), F.when((F.col("unlabelled_long") > 0) & (F.col("over_20") >= 0.08), "long segments without labels").alias("note"))
    return first.unionByName(holes).where("note IS NOT NULL")


def stats(rows: DataFrame, by_group: bool) -> DataFrame:
    """Counts, hours and floor-rank quantiles, of all rows or of each group."""
    r = rows.select(*rows.columns) if by_group else rows.withColumn("reciter_slug", F.lit("all"))
    d = F.col("duration_seconds")
    table = r.groupBy("reciter_slug").agg(
        F.count(F.lit(1)).alias("segments"), F.count_distinct("source_id").alias("sources"), F.round(F.sum(d) / 3600, 6).alias("hours"), F.round(F.min(d), 9).alias("shortest"), F.round(F.max(d), 9).alias("longest"),
        _count(~F.col("source_is_complete") & F.col("is_last_of_source")).alias("cut_off"), share(_count(d < 1.0), F.count(F.lit(1))).alias("under_1"), share(_count(d > 20.0), F.count(F.lit(1))).alias("over_20"),
    )
    at = ranks(r, ["reciter_slug"], "duration_seconds", {"p05": (0.05, "floor"), "p50": (0.5, "floor"), "p95": (0.95, "floor")}).drop("n")
    return table.join(at, "reciter_slug").select(*table.columns, *[F.round(c, 9).alias(c) for c in ("p05", "p50", "p95")])


def suspects(stats_by_group: DataFrame) -> DataFrame:
    flags = F.array_compact(F.array(F.when(F.col("under_1") > 0.10, "over-segmented"), F.when(F.col("over_20") > 0.10, "missed stops")))
    return stats_by_group.select("reciter_slug", F.explode(flags).alias("suspect"))
