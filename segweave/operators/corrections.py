"""Keyed corrections applied to segments: adjust, drop, split, merge, with a reconciliation report.

Of several corrections with one key the last wins. Segments that a merge names
are taken out even where that merge is refused, as the data model has it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import letters, thousandths

ACTIONS = ("adjust", "drop", "split", "merge")
DRIFT = 0.05


def _latest(corrections: DataFrame) -> DataFrame:
    w = Window.partitionBy("segment_id").orderBy(F.desc("c_ord"))
    return corrections.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def _absorbed(latest: DataFrame) -> DataFrame:
    return latest.where("action = 'merge'").select(F.explode("with_ids").alias("segment_id")).distinct()


def decided(segments: DataFrame, corrections: DataFrame, strict_drift: bool = False) -> DataFrame:
    """segments with their correction, what a merge found, drifted and the outcome."""
    latest = _latest(corrections)
    wanted = latest.where("action = 'merge'").select(F.col("segment_id").alias("survivor"), F.explode("with_ids").alias("segment_id"))
    parts = wanted.join(segments.select("segment_id", "source_id", "start_seconds", "end_seconds", "is_last_of_source"), "segment_id").groupBy("survivor")
    parts = parts.agg(F.count(F.lit(1)).alias("found"), F.min("start_seconds").alias("low"), F.max("end_seconds").alias("high"), F.bool_or("is_last_of_source").alias("any_last"), F.collect_set("segment_id").alias("found_ids"), F.min("source_id").alias("s0"), F.max("source_id").alias("s1"))
    r = segments.join(latest, "segment_id", "left").join(_absorbed(latest).withColumn("absorbed", F.lit(True)), "segment_id", "left").join(parts.withColumnRenamed("survivor", "segment_id"), "segment_id", "left")
    moved = lambda a, b: F.coalesce(F.abs(F.col(a) - F.col(b)) > DRIFT, F.lit(False))
    drifted = moved("orig_start", "start_seconds") | moved("orig_end", "end_seconds")
    cuts = F.array_sort(F.filter("at_seconds", lambda t: (t > F.col("start_seconds")) & (t < F.col("end_seconds"))))
    foreign = F.coalesce((F.col("s0") != F.col("source_id")) | (F.col("s1") != F.col("source_id")), F.lit(False))
    r = r.withColumn("drifted", drifted).withColumn("cuts", cuts)
    outcome = (
        F.when(F.col("absorbed"), "merged_away")
        .when(F.col("action").isNull(), "unchanged")
        .when(~F.col("action").isin(*ACTIONS), "unknown_action")
        .when(F.lit(strict_drift) & F.col("drifted"), "drifted")
        .when(F.col("action") == "drop", "dropped")
        .when((F.col("action") == "merge") & foreign, "refused")
        .when(F.col("action") == "merge", "merged")
        .when((F.col("action") == "adjust") & (F.coalesce("new_end", "end_seconds") <= F.coalesce("new_start", "start_seconds")), "inverted")
        .when(F.col("action") == "adjust", "adjusted")
        .when(F.size("cuts") > 0, "split")
        .otherwise("no_cut")
    )
    return r.withColumn("outcome", outcome)


def apply(segments: DataFrame, corrections: DataFrame, strict_drift: bool = False) -> DataFrame:
    """The corrected segments; child_ord orders the parts of a split.

    What was corrected has bounds and duration to three decimals, samples of
    the exact bounds, and its note; the rest is as it was. A clip that no longer
    fits (merged or split) loses its audio_path.
    """
    r = decided(segments if "audio_path" in segments.columns else segments.withColumn("audio_path", F.lit(None).cast("string")), corrections if "note" in corrections.columns else corrections.withColumn("note", F.lit("")), strict_drift)
    r = r.where("outcome NOT IN ('merged_away', 'dropped')")
    o = F.col("outcome")
    start = F.when(o == "adjusted", F.coalesce("new_start", "start_seconds")).when(o == "merged", F.least("start_seconds", "low")).otherwise(F.col("start_seconds"))
    end = F.when(o == "adjusted", F.coalesce("new_end", "end_seconds")).when(o == "merged", F.greatest("end_seconds", "high")).otherwise(F.col("end_seconds"))
    edges = F.when(o == "split", F.concat(F.array("start_seconds"), F.col("cuts"), F.array("end_seconds"))).otherwise(F.array(start, end))
    child = r.select("*", F.posexplode(F.transform(F.slice(edges, 2, F.size(edges)), lambda e, i: F.struct(F.get(edges, i).alias("a"), e.alias("b")))).alias("child_ord", "part"))
    child = child.withColumn("corrected", o.isin("adjusted", "merged", "split"))
    new = F.col("corrected")
    a, b = F.col("part.a"), F.col("part.b")
    sample = lambda c, own: F.when(new, F.rint(c * F.col("sample_rate")).cast("long")).otherwise(F.col(own) if own in segments.columns else F.rint(c * F.col("sample_rate")).cast("long"))
    duration = F.col("duration_seconds") if "duration_seconds" in segments.columns else b - a
    return child.select(
        F.when(o == "split", F.concat("segment_id", F.lit("_"), letters(F.col("child_ord")))).otherwise(F.col("segment_id")).alias("segment_id"),
        "source_id", "index", "ord", "child_ord", "outcome",
        F.when(new, thousandths(a)).otherwise(a).alias("start_seconds"), F.when(new, thousandths(b)).otherwise(b).alias("end_seconds"), F.when(new, thousandths(b - a)).otherwise(duration).alias("duration_seconds"),
        sample(a, "start_sample").alias("start_sample"), sample(b, "end_sample").alias("end_sample"),
        F.when(o == "merged", F.col("is_last_of_source") | F.coalesce("any_last", F.lit(False))).otherwise(F.col("is_last_of_source")).alias("is_last_of_source"),
        F.when(o == "merged", F.concat(F.array("segment_id"), F.filter("with_ids", lambda i: F.coalesce(F.array_contains("found_ids", i), F.lit(False))))).alias("merged_from"), F.when(o == "split", F.col("segment_id")).alias("parent_segment_id"),
        F.when(~o.isin("merged", "split"), F.col("audio_path")).alias("audio_path"), "corrected", F.when(new, F.coalesce("note", F.lit(""))).alias("correction_note"),
    )


def report(segments: DataFrame, corrections: DataFrame, strict_drift: bool = False) -> DataFrame:
    """One row: what was applied (adjusted, split, merged), dropped, split into and merged away."""
    r = decided(segments, corrections, strict_drift)
    n = lambda *names: F.count(F.when(F.col("outcome").isin(*names), 1))
    return r.agg(n("adjusted", "split", "merged").alias("applied"), n("dropped").alias("dropped"), F.coalesce(F.sum(F.when(F.col("outcome") == "split", F.size("cuts") + 1)), F.lit(0)).cast("long").alias("split_into"), n("merged_away").alias("merged_away"))


def exceptions(segments: DataFrame, corrections: DataFrame, strict_drift: bool = False) -> DataFrame:
    """segment_id and problem: unmatched keys, refused or invalid actions, drift, merge partners that aren't there."""
    r = decided(segments, corrections, strict_drift)
    latest = _latest(corrections)
    odd = r.where(F.col("outcome").isin("unknown_action", "refused", "inverted", "no_cut")).select("segment_id", F.col("outcome").alias("problem"))
    drift = r.where("drifted AND outcome IN ('adjusted', 'dropped', 'split', 'merged', 'inverted', 'no_cut', 'refused', 'drifted')").select("segment_id", F.lit("drifted").alias("problem"))
    missing = r.where("outcome IN ('merged', 'refused') AND size(array_except(with_ids, coalesce(found_ids, array()))) > 0").select("segment_id", F.lit("missing_part").alias("problem"))
    lost = latest.join(segments, "segment_id", "left_anti").join(_absorbed(latest), "segment_id", "left_anti").select("segment_id", F.lit("unmatched").alias("problem"))
    return odd.unionByName(drift).unionByName(missing).unionByName(lost)
